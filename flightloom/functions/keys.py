"""Row identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Existing keys were made with this separator and this stand-in for null.
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """MD5 of the parts' text, so that equal parts get equal keys in every batch."""
    texts = [F.coalesce(part.cast("string"), F.lit(KEY_NULL)) for part in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of whole rows: evenly spread, so it can order rows of equal date and also cut them into even pieces."""
    return F.xxhash64(*[F.col(c) for c in columns])
