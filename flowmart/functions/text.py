"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unicode white space plus the ASCII separators, at either end of the text.
_EDGE_SPACE = r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def strip_space(text: Column) -> Column:
    """Drop every kind of white space at both ends (landing rule)."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def blank_to_null(text: Column) -> Column:
    """Trim spaces; an empty result is null (warehouse rule, P1)."""
    return F.nullif(F.trim(text), F.lit(""))


def strip_to_null(text: Column) -> Column:
    """`strip_space`, with an empty result as null."""
    return F.nullif(strip_space(text), F.lit(""))


def title_label(code: Column) -> Column:
    """`prince_rupert` -> `Prince Rupert`."""
    return F.initcap(F.replace(code, F.lit("_"), F.lit(" ")))
