"""One collection window: landed messages and feed files into the raw layer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, functions as F

from flowmart.operators.latest import latest_per_key
from flowmart.session import pin
from flowmart.sources.ais import decode_messages, position_reports, static_reports, with_snapshot_id
from flowmart.sources.border_feed import append_fetch
from flowmart.sources.files import EmptyLoad
from flowmart.sources.tables import Warehouse
from flowmart.streaming.ais import static_merger, static_state

ARRIVAL = ("received_at", "arrival")


def collect_vessels(house: Warehouse, lines: DataFrame, snapshot_ts: datetime) -> dict[str, int]:
    """Store the last position and static record per vessel of one window.

    A window with no usable message at all is an error (S13). Storing the same
    window again replaces it.
    """
    messages = pin(decode_messages(lines), "messages")
    stamp = F.lit(snapshot_ts).cast("timestamp")
    seen_positions, seen_static = Observation("positions"), Observation("static")
    positions = latest_per_key(
        position_reports(messages).withColumn("snapshot_ts", stamp), ["snapshot_ts", "mmsi"], ARRIVAL
    )
    positions = pin(
        with_snapshot_id(positions)
        .drop(*ARRIVAL)
        .withColumns({"ingested_at": F.current_timestamp(), "day": F.to_date("snapshot_ts")})
        .observe(seen_positions, F.count("*").alias("n")),
        "positions",
    )
    static = pin(
        static_reports(messages)
        .withColumn("snapshot_ts", stamp)
        .observe(seen_static, F.count("*").alias("n")),
        "static",
    )
    counts = {"positions": seen_positions.get["n"], "static": seen_static.get["n"]}
    if not any(counts.values()):
        raise EmptyLoad("no vessel messages in the window")
    if counts["positions"]:
        house.table("raw", "ais_positions", "snapshot_id").replace(positions)
    if counts["static"]:
        merge = static_merger(house.path("raw", "ship_static"), "snapshot_ts", ARRIVAL)
        merge(static, 0)
    return counts


def raw_positions(house: Warehouse) -> DataFrame:
    """Stored positions of all windows."""
    return house.read("raw", "ais_positions")


def raw_static(house: Warehouse) -> DataFrame:
    """Current vessel attributes."""
    return static_state(house.spark, house.path("raw", "ship_static"))


def collect_border(house: Warehouse, *paths: str, fetched_at: datetime | None = None) -> dict[str, int]:
    """Store what has landed since the last collection.

    Rows are stamped with the time their file landed, or all with `fetched_at`.
    """
    stamp = None if fetched_at is None else F.lit(fetched_at).cast("timestamp")
    return append_fetch(
        house.spark, house.path("raw", "border_raw"), house.path("raw", "border_files"), *paths, fetched_at=stamp
    )
