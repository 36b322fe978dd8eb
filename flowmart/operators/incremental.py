"""Incremental loads: high-water mark, replace by key, attribute upserts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowmart.session import ROW_GROUP_BYTES

# Fixed value: the mark of an empty target.
FIRST_RUN_MARK = "1900-01-01 00:00:00"


def newer_than(
    source: DataFrame, target: DataFrame | None, column: str, lookback: timedelta = timedelta(0)
) -> DataFrame:
    """Rows of `source` strictly newer than anything in `target`.

    With no target every row with a time passes; rows without one are left to
    `without_time`. `target` may be the newest partition alone, see
    `VersionedTable.newest`. `lookback` re-reads the last stretch, for feeds whose
    rows may arrive late; replacing by key then removes repeats. Sources that are
    versioned tables need neither: their commits tell what is new.
    """
    if target is None:
        return source.where(F.col(column).isNotNull())
    mark = F.coalesce(F.max(column), F.lit(FIRST_RUN_MARK).cast("timestamp"))
    newest = target.select((mark - F.lit(lookback)).alias("mark")).scalar()
    fresh = source.where(F.col(column) > newest)
    # A source partitioned by day also skips the folders before the mark.
    return fresh.where(F.col("day") >= F.to_date(newest)) if "day" in source.columns else fresh


def without_time(source: DataFrame, column: str) -> DataFrame:
    """Rows no load takes up, to be looked at: they have no time to compare."""
    return source.where(F.col(column).isNull())


def replace_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`old` without the keys present in `new`, plus `new`."""
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet table at `path`, or None before its first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


# Fixed value: Spark's folder name for rows whose partition value is null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def write_partitioned(df: DataFrame, path: str, partition: str, mode: str = "append") -> None:
    """Write by partition value, few large files each.

    `rebalance` gathers the rows of a value and splits a value that holds too
    many, so a hot day neither becomes one task nor scatters over all files.
    """
    (
        df.hint("rebalance", partition)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .partitionBy(partition)
        .parquet(path)
    )


def merge_attributes(
    current: DataFrame, changes: DataFrame, key: str, attributes: Sequence[str], seen_at: str
) -> DataFrame:
    """Null-preserving upsert of one change row per key.

    A new non-null value wins, a null keeps the old one; `first_seen_at` stays,
    `last_seen_at` follows the change.
    """
    renamed = changes.select(
        key,
        *[F.col(c).alias(f"_new_{c}") for c in attributes],
        F.col(seen_at).alias("_seen"),
    )
    return current.join(renamed, key, "full_outer").select(
        key,
        *[F.coalesce(f"_new_{c}", c).alias(c) for c in attributes],
        F.coalesce("first_seen_at", "_seen").alias("first_seen_at"),
        F.coalesce("_seen", "last_seen_at").alias("last_seen_at"),
    )


def fold_attributes(
    history: DataFrame, key: str, attributes: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The state `merge_attributes` reaches after the whole history, in one pass.

    Per attribute the newest non-null value: an aggregate that combines
    map-side, so no mutable table is needed. `order` starts with the time seen.
    """
    rank = F.struct(*order)
    newest = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in attributes
    ]
    return history.groupBy(key).agg(
        *newest,
        F.min(order[0]).alias("first_seen_at"),
        F.max(order[0]).alias("last_seen_at"),
    )
