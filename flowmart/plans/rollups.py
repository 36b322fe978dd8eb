"""Stored states that add up, so that a load costs what its own rows cost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from flowmart.plans.marts import PROFILE_CELL, PROFILE_VALUE, profile_counts, profile_of_counts
from flowmart.sources.versions import VersionedTable

# Registers of a sketch, as a power of two: a standard error of 1.04 / 2^6.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def add_profile_counts(counts: VersionedTable, source: VersionedTable, staged) -> DataFrame:
    """Count what is new in the source table and return the profile of all that was ever counted.

    `staged` turns source rows into history rows. Counts are stored per partition value of
    the source and load; a value and its counts are few numbers, however many readings it
    has. The history itself is read once, when it arrives. Sources must not replace rows.
    """
    upto = source.commit()
    fresh = source.changes(counts.taken(), upto)
    if fresh is not None:
        counted = profile_counts(staged(fresh).withColumn(counts.partition, F.lit(f"commit-{upto}")), counts.partition)
        counts.replace(counted, upto)
    stored = counts.read()
    summed = stored.groupBy(*PROFILE_CELL, *PROFILE_VALUE).agg(F.sum("n").alias("n"))
    return profile_of_counts(summed)


def distinct_sketches(rows: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """A sketch of the distinct values of `column` per group, of a few kB whatever their number."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(column, SKETCH_BITS).alias("sketch"))


def distinct_over(sketches: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Distinct values over coarser groups, from the sketches of finer ones."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
