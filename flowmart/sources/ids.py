"""Durable row numbers for files that carry none.

Numbers are decimals of 38 digits: wide enough that no part spills into another.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NUMBER = "decimal(38,0)"
POSITION_BITS = 40


def row_id(source_file: Column, position: Column) -> Column:
    """64-bit hash of the file, then the position in it; same on every run.

    Two of ten million files share a hash with a chance of one in 300,000; a
    position that does not fit fails the job.
    """
    high = F.xxhash64(source_file).cast(NUMBER) + F.lit(str(2**63)).cast(NUMBER)
    low = F.when(position < 2**POSITION_BITS, position.cast(NUMBER)).otherwise(
        F.raise_error(F.concat(F.lit("too many rows in "), source_file)).cast(NUMBER)
    )
    return (high * F.lit(2**POSITION_BITS).cast("decimal(13,0)") + low).cast(NUMBER)


def snapshot_id(snapshot_ts: Column, mmsi: Column) -> Column:
    """Seconds of the window and the vessel number, any 64-bit one, without hashing."""
    seconds = F.unix_seconds(snapshot_ts).cast("decimal(12,0)")
    return (seconds * F.lit(str(10**20)).cast("decimal(21,0)") + mmsi.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast(NUMBER)
