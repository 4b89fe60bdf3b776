"""Personal data: patterns for identifiers, and terms that disclose them.

Identifiers (e-mail, IP address, payment card, phone) are found by pattern, leftmost and
non-overlapping per kind; a match that fails its check is dropped and not tried again.

Other words can give an identifier away. How strongly is estimated from the corpus: a term's
disclosure of an identifier is their pointwise mutual information over the information content
of the identifier,

    PMI = log2(n(id, term) * D / (n(id) * n(term)))      IC = log2(D / n(id))

with D different texts, n(id) those that hold the identifier, n(id, term) those that hold both,
n(term) those that hold the term, at any distance. Texts that have the identifier only in contexts
(the characters around it) of another text count as that one. 0 says nothing, 1 gives it away.
Terms that reach ``REMOVE`` are removed wherever they stand in texts that hold the identifier,
from ``GENERALISE`` on they are replaced by a general word; texts without the identifier keep
them. At least ``SUPPORT`` texts must agree, so a copied passage with the identifier proves nothing.

Defined results: null text is empty and has no spans. Offsets count code points, ends are
exclusive. Repeated rows give a row each and count once as evidence. A term that overlaps an
identifier is no term. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.llm.common import free_name, join_counted, nullable_key, stored

# Kinds in the order in which spans at one place are listed.
KINDS = ("email", "ip", "card", "phone", "term")
#: What stands in for a span. A removed term leaves nothing.
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
GENERAL = "[TERM]"

#: Characters of context on either side of an identifier.
CONTEXT = 160
SUPPORT = 3
GENERALISE = 0.6
REMOVE = 0.8
#: Shorter words are no terms.
TERM = r"\p{L}{4,}"

# The matches of the plain patterns, found without trying a long run from each of its
# characters: a match begins where its run begins, or where the match before it ended.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def located(text: Column, pattern: str, keep: Callable[[Column], Column]) -> Column:
    """An array of (start, end, value): the matches of a pattern that pass ``keep``."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    none = F.expr(
        "named_struct('at', 0, 'out', cast(array() as array<struct<start:int,end:int,value:string>>))"
    )

    def follow(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        match = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(
            end.alias("at"),
            F.when(keep(pair["value"]), F.array_append(state["out"], match)).otherwise(state["out"]).alias("out"),
        )

    pairs = F.zip_with(
        found, F.slice(between, F.lit(1), F.size(found)), lambda v, g: F.struct(v.alias("value"), g.alias("gap"))
    )
    return F.aggregate(pairs, none, follow)["out"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _small_parts(value: Column) -> Column:
    """Whether all parts of an address are at most 255."""
    return F.forall(
        F.split(value, r"\."),
        lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"),
    )


def _luhn(value: Column) -> Column:
    """14 to 19 digits with a valid check digit."""
    digits = F.reverse(_digits(value))
    places = F.sequence(F.lit(0), F.length(digits) - 1)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    valid = F.aggregate(places, F.lit(0), add) % 10 == 0
    return F.when(F.length(digits).between(14, 19), valid).otherwise(F.lit(False))


#: Per kind: pattern, a cheap test that a text may hold a match, the check, the identity.
_RULES: dict[str, tuple] = {
    "email": (_EMAIL, lambda t: F.contains(t, F.lit("@")), lambda v: F.lit(True), F.lower),
    "ip": (_IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), _small_parts, lambda v: v),
    "card": (_CARD, lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), _luhn, _digits),
    "phone": (_PHONE, lambda t: F.contains(t, F.lit("+")), lambda v: F.length(_digits(v)).between(10, 15), _digits),
}


def _overlaps(spans: Column, start: Column, end: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < end) & (s["end"] > start))


def identifiers(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, text, spans: (start, kind, end, entity) by start and kind."""
    text = F.col("text")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    empty = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")
    for kind, (pattern, may, keep, _) in _RULES.items():
        rows = rows.withColumn(kind, F.when(may(text), located(text, pattern, keep)).otherwise(empty))

    def tagged(kind: str) -> Column:
        number, identity = KINDS.index(kind), _RULES[kind][3]
        return F.transform(
            kind,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(number).alias("kind"),
                s["end"].alias("end"),
                F.concat(F.lit(f"{kind}:"), identity(s["value"])).alias("entity"),
            ),
        )

    spans = F.sort_array(F.concat(*[tagged(kind) for kind in _RULES]))
    return rows.select("doc_id", "text_hash", "text", spans.alias("spans"))


def _contexts(found: DataFrame) -> DataFrame:
    """text_hash, entity, context: a hash of the characters around each identifier."""
    own = found.where(F.size("spans") > 0).select("text_hash", "text", F.explode("spans").alias("s"))
    begin = F.greatest(F.col("s.start") - CONTEXT, F.lit(0))
    around = F.substring("text", begin + 1, F.col("s.end") - begin + CONTEXT)
    return own.select("text_hash", F.col("s.entity").alias("entity"), F.xxhash64(around).alias("context"))


def _holders(contexts: DataFrame, support: int) -> DataFrame:
    """text_hash, entity, n_id, counts_as for the identifiers that ``support`` texts have.

    A text counts as itself if one of its contexts is not in a text with a smaller hash.
    """
    owners = stored(contexts.groupBy("entity", "context").agg(F.min("text_hash").alias("owner")), "pii-owners")
    per_entity = owners.select("entity", "owner").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_id"))
    often = stored(per_entity.where(F.col("n_id") >= support), "pii-entities")
    owned = stored(join_counted(owners, often, ["entity"]), "pii-owned")
    own = F.max(F.col("owner") == F.col("text_hash"))
    held = join_counted(contexts, owned, ["entity", "context"]).groupBy("text_hash", "entity", "n_id")
    return held.agg(F.when(own, F.col("text_hash")).otherwise(F.min("owner")).alias("counts_as"))


def _terms(text: Column) -> Column:
    """The different terms of a text. Of the identifiers, only e-mail addresses have letters."""
    # A word that runs into an address overlaps it: the address leaves its first and last character.
    head, begin, rest = _EMAIL.partition(r"|\G)")
    ends = f"{head}{begin}(?=(.)){rest}(?<=(.))"
    marked = F.regexp_replace(F.translate(text, "\x01", " "), ends, "$1\x01$2")
    apart = F.regexp_replace(marked, r"(?<!\p{L})\p{L}*+\x01\p{L}*+", " ")
    plain = F.when(F.contains(text, F.lit("@")), apart).otherwise(text)
    return F.array_distinct(F.transform(F.regexp_extract_all(plain, F.lit(TERM), F.lit(0)), F.lower))


def _disclosure(texts: int, n_term: str) -> Column:
    """PMI over IC, from columns n_both, n_id and a count of the term."""
    pmi = F.log2(F.col("n_both") * F.lit(float(texts)) / (F.col("n_id") * F.greatest(n_term, "n_both")))
    content = F.log2(F.lit(float(texts)) / F.col("n_id"))
    return F.when(content > 0, pmi / content).otherwise(F.lit(0.0))


def _texts_with(rows: DataFrame) -> DataFrame:
    """term, n_term: the different texts that hold each word of four letters or more.

    Words are counted row by row, so that tasks add them up before anything is shuffled; what rows
    that repeat a text count too much is taken off.
    """
    lower = F.array_distinct(F.transform(F.split("text", r"[^\p{L}]+"), F.lower))
    words = F.explode(F.filter(lower, lambda w: F.length(w) >= 4)).alias("term")
    repeated = rows.groupBy("text_hash").agg((F.count(F.lit(1)) - 1).alias("more")).where(F.col("more") > 0)
    copies = join_counted(rows.select("text_hash", "text"), stored(repeated, "pii-repeated"), ["text_hash"])
    once = copies.select("text_hash", "more", words).distinct()
    taken_off = once.groupBy("term").agg((-F.sum("more")).alias("n"))
    in_rows = rows.select(words).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return in_rows.unionByName(taken_off).groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosures(docs: DataFrame, holders: DataFrame, texts: int, support: int = SUPPORT, least: float = GENERALISE) -> DataFrame:
    """entity, term, disclosure for the pairs that reach ``least``."""
    # An identifier that all texts hold is given away by nothing.
    holders = holders.where(F.col("n_id") < texts)
    # The most frequent identifier of a text bounds what any term of it may disclose there.
    some = stored(holders.groupBy("text_hash").agg(F.max("n_id").alias("most")), "pii-holding")
    n_some = some.count()
    if n_some == 0:
        return holders.select("entity", F.lit("").alias("term"), F.lit(0.0).alias("disclosure")).limit(0)
    everywhere = docs.where(F.col("text").isNotNull()).withColumn("text_hash", F.xxhash64("text"))
    holding = join_counted(everywhere.select("text_hash", "text"), some, ["text_hash"], rows=n_some)
    held = stored(holding.select("text_hash", "most", F.explode(_terms(F.col("text"))).alias("term")).distinct(), "pii-held")
    # Texts that hold an identifier and the term are some of those that hold it: a bound on
    # n(term), and so on the disclosure, even if all texts with the identifier had the term.
    # Common words fall under it before pairs are made or the corpus is searched for them: first
    # the terms that reach no identifier, then each where it stands beside rarer ones.
    near = held.groupBy("term").agg(F.count(F.lit(1)).alias("n_near"), F.max("most").alias("n_id"))
    near = near.where(F.col("n_near") >= support).withColumn("n_both", F.col("n_id"))
    near = stored(near.where(_disclosure(texts, "n_near") >= least).select("term", "n_near"), "pii-near")
    met = join_counted(held, near, ["term"]).withColumn("n_id", F.col("most")).withColumn("n_both", F.col("most"))
    met = met.where(_disclosure(texts, "n_near") >= least).select("text_hash", "term", "n_near")
    pairs = join_counted(met, holders, ["text_hash"]).withColumn("n_both", F.col("n_id"))
    possible = pairs.where(_disclosure(texts, "n_near") >= least)
    reached = (
        possible.select("entity", "term", "n_id", "n_near", "counts_as")
        .distinct()
        .groupBy("entity", "term", "n_id", "n_near")
        .agg(F.count(F.lit(1)).alias("n_both"))
        .where((F.col("n_both") >= support) & (_disclosure(texts, "n_near") >= least))
    )
    often = stored(reached.select("entity", "term", "n_both", "n_id"), "pii-pairs")
    if often.isEmpty():
        return often.select("entity", "term", F.lit(0.0).alias("disclosure")).limit(0)
    counted = join_counted(_texts_with(everywhere), often, ["term"])
    return counted.withColumn("disclosure", _disclosure(texts, "n_term")).where(F.col("disclosure") >= least).select(
        "entity", "term", "disclosure"
    )


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, spans: (start, kind, end, removed) of identifiers and terms."""
    found = identifiers(docs)
    compact = stored(
        found.select("doc_id", "text_hash", F.transform("spans", lambda s: F.struct(s["start"], s["kind"], s["end"])).alias("base")),
        "pii-identifiers",
    )
    contexts = stored(_contexts(found), "pii-contexts")
    texts = compact.select("text_hash").distinct().count()
    holders = stored(_holders(contexts, SUPPORT), "pii-holders")
    told = stored(disclosures(docs, holders, texts), "pii-disclosures")
    # Whatever identifier of a text it is that a term discloses most.
    per_text = join_counted(holders, told, ["entity"]).groupBy("text_hash", "term").agg(F.max("disclosure").alias("d"))
    wanted = stored(
        per_text.groupBy("text_hash").agg(F.map_from_entries(F.collect_list(F.struct("term", "d"))).alias("wanted")),
        "pii-wanted",
    )
    n_wanted = wanted.agg(F.coalesce(F.sum(1 + F.size("wanted")), F.lit(0))).first()[0]
    rows = docs.where(F.col("text").isNotNull()).select(
        nullable_key(F.col("doc_id").cast("long")).alias("k"), F.xxhash64("text").alias("text_hash"), "text"
    )
    placed = join_counted(rows, wanted, ["text_hash"], rows=n_wanted).dropDuplicates(["k", "text_hash"])
    met = located(F.col("text"), TERM, lambda v: F.map_contains_key("wanted", F.lower(v)))
    terms = F.transform(
        met,
        lambda t: F.struct(
            t["start"].alias("start"),
            F.lit(KINDS.index("term")).alias("kind"),
            t["end"].alias("end"),
            (F.element_at("wanted", F.lower(t["value"])) >= REMOVE).alias("removed"),
        ),
    )
    per_document = placed.select("k", "text_hash", terms.alias("terms"))
    base = F.transform(
        "base",
        lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(False).alias("removed")
        ),
    )
    keyed = compact.withColumn("k", nullable_key(F.col("doc_id")))
    apart = F.filter("terms", lambda t: ~_overlaps(F.col("base"), t["start"], t["end"]))
    spans = F.when(F.col("terms").isNull(), base).otherwise(F.sort_array(F.concat(base, apart)))
    return keyed.join(per_document, ["k", "text_hash"], "left").select("doc_id", "text_hash", spans.alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with its spans replaced; overlapping spans are one, masked as the first."""
    masks = F.array(*[F.lit(MASKS.get(k, GENERAL)) for k in KINDS])
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def follow(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        mask = F.when(s["removed"], F.lit("")).otherwise(F.element_at(masks, s["kind"] + 1))
        fresh = s["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], gap, mask)).otherwise(state["out"]).alias("out"),
        )

    done = F.aggregate(spans, begin, follow)
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))


def sanitise(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with personal data replaced in their text."""
    found = find(docs.select("doc_id", "text")).where(F.size("spans") > 0)
    hashed, key, spans = (free_name(docs, n) for n in ("text_hash", "doc_key", "spans"))
    wanted = stored(
        found.select(nullable_key(F.col("doc_id")).alias(key), F.col("text_hash").alias(hashed), F.col("spans").alias(spans))
        .dropDuplicates([key, hashed]),
        "pii-spans",
    )
    keyed = docs.withColumn(hashed, F.xxhash64(F.coalesce("text", F.lit("")))).withColumn(
        key, nullable_key(F.col("doc_id").cast("long"))
    )
    # A row has all spans of a document, so spans count towards the bound of the broadcast.
    n_spans = wanted.agg(F.coalesce(F.sum(1 + F.size(spans)), F.lit(0))).first()[0]
    joined = join_counted(keyed, wanted, [key, hashed], "left", n_spans)
    changed = F.when(F.col(spans).isNull(), F.col("text")).otherwise(masked(F.col("text"), F.col(spans)))
    return joined.withColumn("text", changed).select(*docs.columns)
