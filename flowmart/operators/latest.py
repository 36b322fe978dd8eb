"""Arg-max operators: the newest row of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from flowmart.operators.incremental import NULL_PARTITION
from flowmart.session import pin


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by `order`, whole record kept.

    An aggregate, not a window: every task reduces its input to one row per key
    before the shuffle, so a key holding most of the rows costs no more than
    any other.
    """
    rest = [name for name in df.columns if name not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(name) if name in keys else F.col(f"_best.{name}") for name in df.columns]
    )


def latest_rows(df: DataFrame, group: str, order: str) -> DataFrame:
    """All rows at the newest `order` value of their group, ties kept.

    The newest value per group is pinned, so the join back broadcasts it when
    its file is small and shuffles when it is not.
    """
    newest = pin(df.groupBy(group).agg(F.max(order).alias(order)), f"newest-{group}")
    return df.join(newest, [group, order], "left_semi")


def newest_rows(df: DataFrame, order: str, partition: str = "day") -> DataFrame:
    """All rows at the newest `order` value of the whole table.

    Of a stored table, partitioned by the day of `order`, only the newest day is
    opened: its name comes from the list of files, and the newest value is a
    constant when the rows are read.
    """
    day = _newest_folder(df, partition)
    if day is None:
        newest = df.select(F.max(order)).scalar()
        return df.where(F.col(order) == newest)
    rows = df.where(F.col(partition) == F.lit(day).cast(df.schema[partition].dataType))
    return rows.where(F.col(order) == F.lit(rows.agg(F.max(order)).first()[0]))


def _newest_folder(df: DataFrame, partition: str) -> str | None:
    """Highest partition value among the files of a stored table; None for other frames."""
    if partition not in df.columns:
        return None
    mark = f"/{partition}="
    values = {name.split(mark)[1].split("/")[0] for name in df.inputFiles() if mark in name}
    return max(values - {NULL_PARTITION}, default=None)
