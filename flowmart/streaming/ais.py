"""Vessel streams: latest positions, port congestion and static attributes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowmart.functions.vessel import is_stationary
from flowmart.operators.latest import latest_per_key
from flowmart.plans.marts import congestion_measures, finish_congestion, with_vessel_category
from flowmart.session import discard, pin
from flowmart.sources.ais import STATIC_ATTRIBUTES

WINDOW = "15 minutes"
WATERMARK = "10 minutes"


def latest_positions(
    reports: DataFrame,
    arrival: str = "received_at",
    order: Sequence[str] = ("received_at", "arrival"),
    window: str = WINDOW,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Last report per vessel and arrival window; a window is emitted once closed."""
    rest = [name for name in reports.columns if name != "mmsi"]
    return (
        reports.withWatermark(arrival, watermark)
        .groupBy(F.window(arrival, window).alias("window"), "mmsi")
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("best"))
        .select(
            "window", "mmsi", *[F.col(f"best.{name}").alias(name) for name in rest if name != arrival]
        )
    )


def port_congestion(latest: DataFrame, vessels: DataFrame, window: str = WINDOW) -> DataFrame:
    """Congestion per window and region on top of `latest_positions` (R2).

    A second stateful aggregate over the same windows; vessel categories come
    from a stored table.
    """
    flagged = latest.select(
        "window",
        "mmsi",
        "region",
        F.col("sog").alias("speed_over_ground_kn"),
        is_stationary(F.col("navigational_status"), F.col("sog")).alias("is_stationary"),
    )
    grouped = (
        with_vessel_category(flagged, vessels)
        .groupBy(F.window(F.window_time("window"), window).alias("window"), "region")
        .agg(*congestion_measures(["window", "region"]))
        .withColumn("snapshot_ts", F.col("window.start"))
        .drop("window")
    )
    return finish_congestion(grouped)


def congestion_writer(
    path: str, vessels: Callable[[SparkSession], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function: congestion of the windows that `latest_positions` closes (R2).

    All vessels of a window come in the batch that closes it, so its counts are final.
    `vessels` is read anew for each batch: a category that arrives while the stream runs
    counts from the next window on. A repeated batch replaces its own rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        flagged = batch.select(
            F.col("window.start").alias("snapshot_ts"),
            "mmsi",
            "region",
            F.col("sog").alias("speed_over_ground_kn"),
            is_stationary(F.col("navigational_status"), F.col("sog")).alias("is_stationary"),
        )
        keys = ["snapshot_ts", "region"]
        joined = with_vessel_category(flagged, vessels(batch.sparkSession))
        grouped = joined.groupBy(*keys).agg(*congestion_measures(keys))
        finish_congestion(grouped).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


# Windows this far behind the newest one no longer get records that compete inside them.
OPEN_FOR = timedelta(days=1)
VERSIONS_KEPT = 2


def _records(batch: DataFrame, window: str, order: Sequence[str]) -> DataFrame:
    """Last record per vessel and window; each attribute with the window it was seen in."""
    newest = latest_per_key(batch.withColumn("_window", F.col(window)), ["mmsi", "_window"], order)
    return newest.select(
        "mmsi",
        "_window",
        F.struct(*order).alias("_order"),
        *[
            F.struct(F.col(c).alias("value"), F.when(F.col(c).isNotNull(), F.col("_window")).alias("at")).alias(c)
            for c in STATIC_ATTRIBUTES
        ],
        F.col("_window").alias("first_seen_at"),
        F.col("_window").alias("last_seen_at"),
    )


def _folded(rows: DataFrame) -> DataFrame:
    """One row per vessel: of each attribute the value seen last."""
    return rows.groupBy("mmsi").agg(
        *[F.max_by(c, F.col(f"{c}.at")).alias(c) for c in STATIC_ATTRIBUTES],
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
    )


def _merged(rows: DataFrame) -> DataFrame:
    """Stored and new rows together: open windows keep their records, older ones are folded.

    Neither the order in which records arrive nor how they are cut into batches
    changes the outcome, and merging the same records again changes nothing.
    """
    newest = rows.select(F.max("_window")).scalar()
    is_open = F.coalesce(F.col("_window") > newest - F.lit(OPEN_FOR), F.lit(False))
    records = latest_per_key(rows.where(is_open), ["mmsi", "_window"], ["_order"])
    closed = latest_per_key(rows.where(~is_open & F.col("_window").isNotNull()), ["mmsi", "_window"], ["_order"])
    folded = _folded(closed.unionByName(rows.where(F.col("_window").isNull())))
    return records.unionByName(folded, allowMissingColumns=True)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, newest first."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(location):
        return []
    names = [status.getPath().getName() for status in files.listStatus(location)]
    numbers = [int(name.removeprefix("version=")) for name in names if name.startswith("version=")]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted((n for n in numbers if files.exists(done(f"{path}/version={n}/_SUCCESS"))), reverse=True)


def static_state(spark: SparkSession, path: str) -> DataFrame | None:
    """Vessel attributes of the newest version kept by `static_merger`."""
    versions = _versions(spark, path)
    if not versions:
        return None
    rows = _folded(spark.read.parquet(f"{path}/version={versions[0]}"))
    return rows.select(
        "mmsi", *[F.col(f"{c}.value").alias(c) for c in STATIC_ATTRIBUTES], "first_seen_at", "last_seen_at"
    )


def static_merger(path: str, window: str, order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function for the null-preserving vessel upsert.

    Of the records of one vessel in one `window` the last by `order` counts;
    across windows a later value wins and a null keeps the earlier one. Each
    batch writes a version merged from the newest complete one, whatever its
    number, and the last versions are kept for readers.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = _records(batch, window, order)
        versions = _versions(spark, path)
        if versions:
            rows = spark.read.parquet(f"{path}/version={versions[0]}").unionByName(rows)
        rows = pin(rows, "static-rows")
        number = versions[0] + 1 if versions else 0
        _merged(rows).write.mode("overwrite").parquet(f"{path}/version={number}")
        discard(spark, *[f"{path}/version={n}" for n in versions[VERSIONS_KEPT - 1 :]])

    return merge
