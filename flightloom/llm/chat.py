"""Chat formatting by prefix-target expansion.

A conversation becomes one formatted text, turn after turn:

    <s>[INST] role [/INST] text</s>

Every assistant turn then becomes an example of its own: the formatted text up to the end of
that turn, with only the reply trainable. Control strings inside roles and texts get a
backslash after their first character (one more if they already carry some), so a formatted
text can be read back exactly.

Defined results: null role, text: empty. Turns are ordered by turn, role, text, nulls first;
repeated rows are all kept. Null conv_id is a conversation of its own. A conversation without
an assistant turn has a formatted text and no example. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
TURN = "<s>[INST] "
REPLY = " [/INST] "
END = "</s>"
TRAINED_ROLE = "assistant"

_CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, replies.

    ``replies`` lists the assistant turns as (start, end) in code points of ``formatted``;
    the reply is what lies between, still escaped.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    parts = turns.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.struct(
                (t.role == TRAINED_ROLE).alias("trained"),
                F.concat(F.lit(TURN), escape(t.role), F.lit(REPLY)).alias("head"),
                escape(t.text).alias("body"),
            ),
        ).alias("parts"),
    )
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("replies"))

    def follow(state: Column, part: Column) -> Column:
        begins = state.at + F.length(part["head"])
        ends = begins + F.length(part["body"])
        reply = F.struct(begins.alias("start"), ends.alias("end"))
        return F.struct(
            (ends + len(END)).alias("at"),
            F.when(part["trained"], F.array_append(state.replies, reply))
            .otherwise(state.replies)
            .alias("replies"),
        )

    return parts.select(
        "conv_id",
        F.array_join(
            F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""
        ).alias("formatted"),
        F.aggregate("parts", start, follow)["replies"].alias("replies"),
    )


def expand_prefixes(formatted: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per assistant turn: example (from 0), text, loss_start, loss_end.

    ``text`` holds all turns up to and with the reply; code points from loss_start to
    loss_end are trainable. A conversation without one gives a row of nulls. The texts of a
    conversation's examples grow with the square of its turns, which is what the method
    asks for; they are cut from the formatted text row by row and never gathered.
    """
    rows = formatted.select(
        "conv_id", *(keep or []), "formatted", F.posexplode_outer("replies").alias("example", "reply")
    )
    return rows.select(
        "conv_id",
        *(keep or []),
        "example",
        F.substring(F.col("formatted"), F.lit(1), F.col("reply.end") + len(END)).alias("text"),
        F.col("reply.start").alias("loss_start"),
        F.col("reply.end").alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of (role, text), unescaped."""
    pieces = F.filter(F.split(formatted, END, -1), lambda p: p != "")

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substring(piece, F.lit(len(TURN) + 1), F.length(piece)), REPLY, 1)
        begins = F.length(role) + len(TURN) + len(REPLY)
        return F.struct(
            unescape(role).alias("role"),
            unescape(F.substring(piece, begins + 1, F.length(piece))).alias("text"),
        )

    return F.transform(pieces, turn)


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation, what formatted text and examples say when they are read back."""
    formatted = format_conversations(rows).withColumn("read", read_turns(F.col("formatted")))
    whole = formatted.select(
        "conv_id",
        "formatted",
        "replies",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(
                F.transform("read", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""
            ),
            256,
        ).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    known = ["n_turns", "turns_sha256", "formatted_chars"]
    examples = expand_prefixes(whole, known).select(
        "conv_id",
        *known,
        F.when(
            F.col("example").isNotNull(),
            F.struct(
                "example",
                unescape(
                    F.substring(
                        F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")
                    )
                ).alias("target"),
            ),
        ).alias("reply"),
    )
    # collect_list drops the nulls of conversations without an example.
    gathered = examples.groupBy("conv_id", *known).agg(
        F.sort_array(F.collect_list("reply")).alias("replies")
    )
    loss = F.array_join(F.transform("replies", lambda r: r.target), "")
    return gathered.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
