"""Exact running totals over a global order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from flowmart.session import pin


def running_totals(df: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """Add `<c>_before` (sum over smaller `order` values) and `<c>_all` per column.

    `order` must be unique. Rows are range-partitioned once and pinned with their
    partition number, each partition sums its own rows, and only the partition
    totals (one row per shuffle partition) are ordered in one place.
    """
    slotted = pin(
        df.repartitionByRange(order).withColumn("_slot", F.spark_partition_id()), "ranges"
    )
    slots = slotted.groupBy("_slot").agg(*[F.sum(c).alias(c) for c in columns])
    earlier = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = slots.select(
        "_slot",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}_offset") for c in columns],
        *[F.sum(c).over(everything).alias(f"{c}_all") for c in columns],
    )
    inside = (
        Window.partitionBy("_slot").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per partition of the range shuffle: a proven bound.
    joined = slotted.join(F.broadcast(offsets), "_slot")
    return joined.select(
        *df.columns,
        *[
            (F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_{c}_offset")).alias(
                f"{c}_before"
            )
            for c in columns
        ],
        *[f"{c}_all" for c in columns],
    )


def dense_codes(df: DataFrame, name: str, code: str) -> DataFrame:
    """Distinct non-null values of `name` with their 0-based position in order (M3)."""
    values = df.select(name).where(F.col(name).isNotNull()).distinct().withColumn("_one", F.lit(1))
    ranked = running_totals(values, name, ["_one"])
    return ranked.select(name, F.col("_one_before").cast("int").alias(code))
