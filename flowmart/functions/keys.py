"""Keys built from column values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: text standing for null inside a surrogate key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"


def composite_key(*parts: Column) -> Column:
    """Parts joined with `-`; null if any part is null."""
    pieces = []
    for part in parts:
        pieces += [F.lit("-"), part.cast("string")]
    return F.concat(*pieces[1:])


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the text of each part, nulls replaced by a marker."""
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_KEY_TEXT)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))
