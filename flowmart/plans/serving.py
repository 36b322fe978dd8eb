"""Serving queries over the marts; `as_of` is always a parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowmart.functions.delay import delay_tone, share_tone
from flowmart.functions.places import PORT_REGIONS
from flowmart.functions.text import title_label
from flowmart.functions.timez import age_label, age_tier, minutes_between
from flowmart.functions.vessel import display_speed, marker_radius
from flowmart.operators.latest import latest_per_key, latest_rows, newest_rows
from flowmart.operators.pivots import pivot_mean
from flowmart.session import pin

MIN_TREND_SNAPSHOTS = 4
MIN_PIVOT_HOURS = 3
BUSIEST = 4


def within_days(df: DataFrame, column: str, as_of: Column, days: int) -> DataFrame:
    """Rows of the last `days` days before `as_of`, start excluded.

    Stored tables carry their partition column `day`; testing it as well skips
    the folders of older days.
    """
    start = F.timestamp_add("DAY", F.lit(-days), as_of)
    recent = df.where(F.col(column) > start)
    return recent.where(F.col("day") >= F.to_date(start)) if "day" in df.columns else recent


def feed_freshness(ports: DataFrame, border: DataFrame, as_of: Column) -> DataFrame:
    """Age of the newest reading per feed, with tier and label.

    Any frame with the time column will do; only that column is read. Of a
    stored table pass `Warehouse.newest`, its newest partition.
    """
    newest = ports.agg(F.max("snapshot_ts").alias("latest_at")).select(
        F.lit("ports").alias("feed"), "latest_at"
    ).unionByName(
        border.agg(F.max("fetched_at").alias("latest_at")).select(
            F.lit("border").alias("feed"), "latest_at"
        )
    )
    age = minutes_between(as_of, F.col("latest_at"))
    return newest.select(
        "feed",
        "latest_at",
        F.round(age, 6).alias("age_minutes"),
        age_tier(age).alias("tier"),
        age_label(age).alias("age_label"),
    )


def latest_congestion(congestion: DataFrame) -> DataFrame:
    """Newest congestion row per region, with its tone and title (V2).

    A region has one row per snapshot, so one aggregate finds it. Pass the
    partitions of `Warehouse.newest_of_each` to open no older ones.
    """
    return latest_per_key(congestion, ["region"], ["snapshot_ts"]).withColumns(
        {"tone": share_tone(F.col("stationary_share")), "region_label": title_label(F.col("region"))}
    )


def congestion_trend(congestion: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Congestion of the last days in time order (V3)."""
    return (
        within_days(congestion, "snapshot_ts", as_of, days)
        .select("snapshot_ts", "region", "vessels_total", "vessels_stationary", "stationary_share")
        .orderBy("snapshot_ts")
    )


def congestion_pivot(
    congestion: DataFrame, as_of: Column, days: int, regions: Sequence[str] = PORT_REGIONS
) -> DataFrame:
    """Holding share by snapshot and region, shown from four snapshots on."""
    recent = within_days(congestion, "snapshot_ts", as_of, days)
    snapshots = recent.select(F.count_distinct("snapshot_ts")).scalar()
    shown = recent.where(snapshots >= MIN_TREND_SNAPSHOTS).withColumn(
        "region", title_label(F.col("region"))
    )
    labels = [region.replace("_", " ").title() for region in regions]
    return pivot_mean(shown, "snapshot_ts", "region", "stationary_share", labels).orderBy(
        "snapshot_ts"
    )


def vessel_map_points(positions: DataFrame, vessels: DataFrame) -> DataFrame:
    """Vessels at the newest snapshot of their region, ready to draw.

    Pass the partitions of `Warehouse.newest_of_each` to open no older ones.
    """
    static = vessels.select("mmsi", "vessel_category", "length_m", "destination")
    shown = latest_rows(
        positions.select(
            "mmsi", "ship_name", "region", "snapshot_ts", "latitude", "longitude",
            "speed_over_ground_kn", "is_stationary", "nav_status_desc",
        ),
        "region",
        "snapshot_ts",
    )
    return shown.join(static, "mmsi", "left").select(
        "mmsi",
        F.coalesce("ship_name", F.lit("unidentified")).alias("ship_name"),
        "region",
        "latitude",
        "longitude",
        "speed_over_ground_kn",
        "is_stationary",
        "nav_status_desc",
        F.coalesce("vessel_category", F.lit("unknown")).alias("vessel_category"),
        "length_m",
        "destination",
        marker_radius(F.col("length_m")).alias("radius"),
        F.when(F.col("is_stationary"), "holding").otherwise("under way").alias("status"),
        display_speed(F.col("speed_over_ground_kn")).alias("speed"),
    )


def map_centre(points: DataFrame) -> DataFrame:
    """Mean position of the drawn vessels."""
    return points.agg(
        F.round(F.avg("latitude"), 6).alias("latitude"),
        F.round(F.avg("longitude"), 6).alias("longitude"),
        F.count("*").alias("vessels"),
    )


def latest_border_waits(waits: DataFrame) -> DataFrame:
    """Reported Canada-bound lanes of the newest fetch."""
    return (
        newest_rows(waits, "fetched_at")
        .where("direction = 'canada' and delay_status = 'reported'")
        .select(
            "crossing_name",
            "canada_province",
            "region_group",
            "traffic_type",
            "delay_minutes",
            "delay_status",
            "congestion_band",
            "fetched_at",
        )
    )


def border_hourly_trend(waits: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Mean commercial delay per hour and crossing, Canada-bound.

    Uses staging columns only, so staged or mart rows both fit.
    """
    lanes = waits.where(
        "traffic_type = 'commercial' and direction = 'canada' and delay_status = 'reported'"
    )
    return (
        within_days(lanes, "fetched_at", as_of, days)
        .groupBy(F.date_trunc("hour", "fetched_at").alias("hour_utc"), "crossing_name")
        .agg(F.avg("delay_minutes").alias("avg_delay_minutes"))
        .orderBy("hour_utc")
    )


def ranked_crossings(lanes: DataFrame) -> DataFrame:
    """Commercial lanes of `latest_border_waits`, slowest first (K1)."""
    return (
        lanes.where("traffic_type = 'commercial'")
        .select("crossing_name", "canada_province", "delay_minutes", "congestion_band")
        .orderBy(F.desc_nulls_last("delay_minutes"), "crossing_name")
    )


def border_headline(lanes: DataFrame) -> DataFrame:
    """Lanes reporting and delayed, mean and worst lane in one row (V7, A10, K2).

    Ties for the worst lane go to the first name.
    """
    delay = F.col("delay_minutes")
    slowest = lanes.where("traffic_type = 'commercial'").groupBy(
        "crossing_name", "canada_province", "delay_minutes"
    ).agg(F.count("*").alias("n"))
    worst = F.min_by(
        F.struct("crossing_name", "canada_province", "delay_minutes"),
        F.when(delay.isNotNull(), F.struct(-delay, F.col("crossing_name"))),
    )
    totals = slowest.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("lanes_reporting"),
        F.coalesce(F.sum(F.when(delay > 0, F.col("n"))), F.lit(0)).cast("bigint").alias(
            "lanes_delayed"
        ),
        F.try_divide(F.sum(delay * F.col("n")), F.sum(F.when(delay.isNotNull(), F.col("n")))).alias(
            "avg_delay_minutes"
        ),
        worst.alias("worst"),
    )
    return totals.select(
        "lanes_reporting",
        "lanes_delayed",
        F.round("avg_delay_minutes", 6).alias("avg_delay_minutes"),
        F.col("worst.crossing_name").alias("worst_crossing"),
        F.col("worst.canada_province").alias("worst_province"),
        F.col("worst.delay_minutes").alias("longest_wait"),
        delay_tone(F.col("worst.delay_minutes")).alias("tone"),
    )


def busiest_crossings(trend: DataFrame, top: int = BUSIEST) -> DataFrame:
    """Crossings with the highest mean of hourly means (A7, K3); names break ties."""
    return (
        trend.groupBy("crossing_name")
        .agg(F.avg("avg_delay_minutes").alias("mean_of_hours"))
        .orderBy(F.desc_nulls_last("mean_of_hours"), "crossing_name")
        .limit(top)
    )


def busiest_crossings_hourly(trend: DataFrame, top: int = BUSIEST) -> DataFrame:
    """Hourly rows of the busiest crossings."""
    # `top` rows: a proven bound.
    names = F.broadcast(busiest_crossings(trend, top).select("crossing_name"))
    return trend.join(names, "crossing_name", "left_semi")


def border_pivot(trend: DataFrame, top: int = BUSIEST) -> DataFrame:
    """Hourly delay of the busiest crossings, a name and a value column for each.

    Columns are `crossing_<k>` and `delay_<k>` by rank, so the schema does not
    depend on the data. Shown from three hours on.
    """
    hourly = pin(trend, "trend")
    # At most `top` rows, numbered in one place.
    order = Window.orderBy(F.desc_nulls_last("mean_of_hours"), "crossing_name")
    ranked = busiest_crossings(hourly, top).withColumn("rank", F.row_number().over(order))
    ranked = pin(ranked.select("crossing_name", "rank"), "busiest")
    listed = hourly.where(F.col("avg_delay_minutes").isNotNull()).join(F.broadcast(ranked), "crossing_name")
    names = ranked.agg(
        *[F.max(F.when(F.col("rank") == k, F.col("crossing_name"))).alias(f"crossing_{k}") for k in range(1, top + 1)]
    )
    wide = listed.groupBy("hour_utc").agg(
        *[F.avg(F.when(F.col("rank") == k, F.col("avg_delay_minutes"))).alias(f"delay_{k}") for k in range(1, top + 1)]
    )
    hours = listed.select(F.count_distinct("hour_utc")).scalar()
    columns = [
        c
        for k in range(1, top + 1)
        for c in (names.select(f"crossing_{k}").scalar().alias(f"crossing_{k}"), F.col(f"delay_{k}"))
    ]
    return wide.where(hours >= MIN_PIVOT_HOURS).select("hour_utc", *columns).orderBy("hour_utc")


def expected_delay_curve(grid: DataFrame, crossing: str, day_of_week: int) -> DataFrame:
    """Expected delay by hour for one crossing and weekday."""
    return (
        grid.where((F.col("crossing_name") == crossing) & (F.col("day_of_week") == day_of_week))
        .select("hour_of_day", "delay_probability", "expected_delay_minutes")
        .orderBy("hour_of_day")
    )


def peak_hour(grid: DataFrame) -> DataFrame:
    """Hour with the longest expected delay per crossing and weekday, first of ties (K4)."""
    best = F.max_by(
        F.struct("hour_of_day", "expected_delay_minutes", "delay_probability"),
        F.struct("expected_delay_minutes", -F.col("hour_of_day")),
    )
    return (
        grid.groupBy("crossing_name", "day_of_week")
        .agg(best.alias("best"))
        .select(
            "crossing_name",
            "day_of_week",
            F.col("best.hour_of_day").alias("peak_hour"),
            F.col("best.expected_delay_minutes").alias("expected_delay_minutes"),
            F.col("best.delay_probability").alias("delay_probability"),
        )
    )


def crossing_names(grid: DataFrame) -> DataFrame:
    """Distinct crossings in order (K6)."""
    return grid.select("crossing_name").distinct().orderBy("crossing_name")


def model_summary(metrics: DataFrame, holdout: str, live: str, as_of: Column) -> DataFrame:
    """Headline scores of the metric table in one row, when they were made and how old they are (V9)."""

    def value(evaluation: str, metric: str) -> Column:
        hit = (F.col("evaluation") == evaluation) & (F.col("metric") == metric)
        return F.max(F.when(hit, F.col("value")))

    row = metrics.agg(
        value(holdout, "stage1_roc_auc").alias("roc_auc"),
        value(holdout, "model_mae_minutes").alias("model_mae_minutes"),
        value(holdout, "baseline_mae_minutes").alias("baseline_mae_minutes"),
        value(holdout, "delayed_share").alias("holdout_delayed_share"),
        value(live, "delayed_share").alias("live_delayed_share"),
        F.max("evaluated_at").alias("retrained_at"),
    )
    gain = F.try_divide(
        F.col("baseline_mae_minutes") - F.col("model_mae_minutes"), F.col("baseline_mae_minutes")
    )
    age = minutes_between(as_of, F.col("retrained_at"))
    return row.withColumns({"gain_pct": F.coalesce(gain, F.lit(0.0)) * 100, "age_label": age_label(age)})
