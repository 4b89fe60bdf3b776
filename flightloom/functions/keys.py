"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide the hash, so they must stay as they are.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
HISTORY_SEPARATOR = "|"


def surrogate_key(*columns: str | Column) -> Column:
    """MD5 over the columns as text; a null takes part as a token of its own."""
    parts = [_as_text(c, NULL_TOKEN) for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def history_row_id(key: str | Column, changed_at: Column) -> Column:
    """Identifier of one version of a key."""
    return F.md5(F.concat_ws(HISTORY_SEPARATOR, _as_text(key, ""), _as_text(changed_at, "")))


def _as_text(column: str | Column, when_null: str) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(value.cast("string"), F.lit(when_null))
