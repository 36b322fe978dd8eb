"""Border stream: landed feed files to staged waits."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowmart.plans.staging import stg_border_waits
from flowmart.sources.border_feed import feed_lines, parse_feed

WATERMARK = "1 day"


def staged_waits(readings: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Raw border rows to staged waits, replayed rows dropped."""
    fresh = readings.withWatermark("fetched_at", watermark).dropDuplicatesWithinWatermark(
        ["observation_id"]
    )
    return stg_border_waits(fresh)


def staged_waits_from_files(files: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """`staged_waits` over streamed feed files; files without a header yield nothing."""
    return staged_waits(parse_feed(feed_lines(files, strict=False)), watermark)
