"""Text clean-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pattern and the name it stands for. The first match wins.
MANUFACTURER_PATTERNS = (
    ("%airbus%", "Airbus"),
    ("%boeing%", "Boeing"),
    ("%embraer%", "Embraer"),
    ("%bombardier%", "Bombardier"),
    ("%dassault%", "Dassault"),
    ("%gulfstream%", "Gulfstream"),
    ("%boing%", "Boeing"),
    ("%empresa brasileira%", "Embraer"),
)


def blank_to_null(text: Column) -> Column:
    """Trim spaces; what is then empty becomes null."""
    return F.nullif(F.trim(text), F.lit(""))


def manufacturer_name(raw: Column) -> Column:
    """Common name of a known manufacturer, the input itself for any other."""
    first, *rest = MANUFACTURER_PATTERNS
    chain = reduce(
        lambda acc, rule: acc.when(raw.ilike(rule[0]), rule[1]),
        rest,
        F.when(raw.ilike(first[0]), first[1]),
    )
    return chain.otherwise(raw)


def joined_label(left: Column, right: Column) -> Column:
    """``left → right``, null when either side is null."""
    return F.concat(left, F.lit(" → "), right)
