"""Wide tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def pivot_mean(
    df: DataFrame, index: str, column: str, value: str, values: Sequence[str]
) -> DataFrame:
    """Mean of `value` per `index` row and listed `column` value.

    The listed values keep Spark from scanning for them first. Index rows with
    no listed value at all are left out.
    """
    kept = df.where(F.col(column).isin(*values) & F.col(value).isNotNull())
    return kept.groupBy(index).pivot(column, list(values)).agg(F.avg(value))
