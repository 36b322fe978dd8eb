"""Marts: dimensions, facts and the delay profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowmart.functions.delay import congestion_band, is_measured
from flowmart.functions.exact import round_half_away, round_ratio, sample_sd
from flowmart.functions.keys import surrogate_key
from flowmart.functions.places import canada_province, region_group, us_state
from flowmart.functions.timez import is_weekend, lag_minutes, local_parts, season


def dim_crossings(waits: DataFrame) -> DataFrame:
    """One row per crossing, attributes taken from the readings (A1).

    Grouping by (name, location) first keeps the pass over all rows in a hash
    aggregate of fixed-width buffers; `max(location)`, which needs a sort, then
    sees only the few distinct pairs.
    """
    commercial = (F.col("traffic_type") == "commercial") & (F.col("delay_status") == "reported")
    pairs = waits.groupBy("crossing_name", "crossing_location").agg(
        F.min("fetched_at").alias("first_observed_at"),
        F.max("fetched_at").alias("last_observed_at"),
        F.max(commercial).alias("handles_commercial"),
        F.count("*").alias("observation_count"),
    )
    crossings = pairs.groupBy("crossing_name").agg(
        F.max("crossing_location").alias("crossing_location"),
        F.min("first_observed_at").alias("first_observed_at"),
        F.max("last_observed_at").alias("last_observed_at"),
        F.max("handles_commercial").alias("handles_commercial"),
        F.sum("observation_count").alias("observation_count"),
    )
    province = canada_province(F.col("crossing_location"))
    return crossings.select(
        surrogate_key(F.col("crossing_name")).alias("crossing_key"),
        "crossing_name",
        "crossing_location",
        province.alias("canada_province"),
        us_state(F.col("crossing_location")).alias("us_state"),
        region_group(province).alias("region_group"),
        "handles_commercial",
        "first_observed_at",
        "last_observed_at",
        "observation_count",
    )


def fct_border_waits(waits: DataFrame, crossings: DataFrame) -> DataFrame:
    """One row per crossing, traffic type, direction and fetch.

    Pass a stored or pinned dimension: its real size then decides between a
    broadcast and a shuffle join.
    """
    names = crossings.select("crossing_key", "crossing_name", "region_group", "canada_province")
    joined = waits.join(names, "crossing_name", "left")
    return joined.select(
        "wait_observation_key",
        "crossing_key",
        "crossing_name",
        "region_group",
        "canada_province",
        "traffic_type",
        "direction",
        "fetched_at",
        "cbsa_updated_at_utc",
        "delay_minutes",
        "delay_status",
        "delay_text_raw",
        "local_hour_pt",
        "local_dow_pt",
        "local_month_pt",
        lag_minutes(F.col("fetched_at"), F.col("cbsa_updated_at_utc")).alias("feed_lag_minutes"),
        congestion_band(F.col("delay_minutes")).alias("congestion_band"),
    )


def dim_vessels(positions: DataFrame, vessels: DataFrame) -> DataFrame:
    """One row per observed vessel, static attributes where known.

    Same two-step grouping as `dim_crossings`, for `max(ship_name)`.
    """
    named = positions.groupBy("mmsi", "ship_name").agg(
        F.min("snapshot_ts").alias("first_seen_at"),
        F.max("snapshot_ts").alias("last_seen_at"),
        F.count("*").alias("position_report_count"),
    )
    observed = named.groupBy("mmsi").agg(
        F.max("ship_name").alias("observed_name"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.sum("position_report_count").alias("position_report_count"),
    )
    static = vessels.drop("first_seen_at", "last_seen_at").withColumnRenamed(
        "ship_name", "static_name"
    ).withColumn("has_static_data", F.lit(True))
    joined = observed.join(static, "mmsi", "left")
    return joined.select(
        "mmsi",
        F.coalesce("static_name", "observed_name").alias("ship_name"),
        F.coalesce("vessel_category", F.lit("unknown")).alias("vessel_category"),
        "ship_type",
        "imo_number",
        "call_sign",
        "destination",
        "eta_text",
        "length_m",
        "beam_m",
        "max_draught",
        F.coalesce("has_static_data", F.lit(False)).alias("has_static_data"),
        "first_seen_at",
        "last_seen_at",
        "position_report_count",
    )


def congestion_measures(keys: list[str]) -> list:
    """Aggregates of port congestion over joined positions (A3)."""
    holding = F.col("is_stationary")
    category = F.col("vessel_category")
    return [
        F.count("*").alias("vessels_total"),
        F.count_if(holding).alias("vessels_stationary"),
        F.count_if(category == "cargo").alias("vessels_cargo"),
        F.count_if((category == "cargo") & holding).alias("cargo_stationary"),
        F.count_if(category == "tanker").alias("vessels_tanker"),
        F.count_if(category == "unknown").alias("vessels_unknown_category"),
        F.avg("speed_over_ground_kn").alias("avg_speed_kn"),
    ]


def with_vessel_category(positions: DataFrame, vessels: DataFrame) -> DataFrame:
    """Positions with the category of their vessel, `unknown` if there is none.

    Any table with unique `mmsi` and `vessel_category` will do: the vessel
    dimension, or the static table itself when facts are rebuilt in full.
    """
    categories = vessels.select("mmsi", "vessel_category")
    return positions.join(categories, "mmsi", "left").withColumn(
        "vessel_category", F.coalesce("vessel_category", F.lit("unknown"))
    )


def finish_congestion(grouped: DataFrame) -> DataFrame:
    """Key, shares and calendar parts on the aggregated congestion rows."""
    calendar = local_parts(F.col("snapshot_ts"))
    return grouped.select(
        surrogate_key(F.col("snapshot_ts"), F.col("region")).alias("congestion_key"),
        "snapshot_ts",
        "region",
        "vessels_total",
        "vessels_stationary",
        "vessels_cargo",
        "cargo_stationary",
        "vessels_tanker",
        "vessels_unknown_category",
        round_half_away(F.col("avg_speed_kn"), 2).alias("avg_speed_kn"),
        round_ratio(F.col("vessels_stationary"), F.col("vessels_total"), 3).alias(
            "stationary_share"
        ),
        calendar["local_hour_pt"].alias("local_hour_pt"),
        calendar["local_dow_pt"].alias("local_dow_pt"),
    )


def fct_port_congestion(positions: DataFrame, vessels: DataFrame) -> DataFrame:
    """One row per region and snapshot (A3).

    The grouping keys are few and hot, so the counts combine in each map task.
    """
    keys = ["snapshot_ts", "region"]
    joined = with_vessel_category(positions, vessels)
    return finish_congestion(joined.groupBy(*keys).agg(*congestion_measures(keys)))


PROFILE_CELL = ["crossing_name", "traffic_type", "local_hour_pt", "local_dow_pt", "local_month_pt"]


def agg_border_delay_profile(history: DataFrame) -> DataFrame:
    """Delay profile per crossing, type, hour, weekday and month.

    Two aggregates, one scan, no self-join. The first counts readings per cell,
    status and minute value: a hash aggregate that combines map-side, whatever
    the size of a cell. The second works on those counts, so the exact
    percentiles see distinct minute values only.
    """
    return profile_of_counts(profile_counts(history))


PROFILE_VALUE = ["kind", "minutes"]


def profile_counts(history: DataFrame, *more: str) -> DataFrame:
    """Readings per cell, status and minute value: all a profile needs, and counts of
    different rows add up. `more` columns are told apart too."""
    measured = is_measured(F.col("delay_status"), F.col("delay_minutes"))
    value = F.when(measured, F.col("delay_minutes"))
    kind = (
        F.when(measured, "measured")
        .when(F.col("delay_status").isin("closed", "missed_entry"), F.col("delay_status"))
        .otherwise("other")
    )
    return history.groupBy(*more, *PROFILE_CELL, kind.alias("kind"), value.alias("minutes")).agg(
        F.count("*").alias("n")
    )


def profile_of_counts(counts: DataFrame) -> DataFrame:
    """The profile of `profile_counts`, or of the sum of several."""
    n, minutes, kinds = F.col("n"), F.col("minutes"), F.col("kind")

    def total(rows, amount=n):
        return F.coalesce(F.sum(F.when(rows, amount)), F.lit(0).cast("bigint"))

    long_minutes = minutes.cast("bigint")
    cells = (
        counts.groupBy(*PROFILE_CELL)
        .agg(
            total(kinds == "measured").alias("observations"),
            total(minutes > 0).alias("delayed_observations"),
            F.sum(n * long_minutes).alias("minutes_sum"),
            F.sum(n * long_minutes * long_minutes).alias("squares_sum"),
            F.percentile(
                minutes, F.array(F.lit(0.5), F.lit(0.9)), F.when(minutes.isNotNull(), n).otherwise(0)
            ).alias("quantiles"),
            F.max("minutes").alias("max_delay_minutes"),
            total(kinds == "closed").alias("closed_observations"),
            total(kinds == "missed_entry").alias("missed_observations"),
            F.sum("n").alias("total_observations"),
        )
        .where(F.col("observations") > 0)
    )
    observations = F.col("observations")
    spread = sample_sd(observations, F.col("minutes_sum"), F.col("squares_sum"))
    return cells.select(
        surrogate_key(*[F.col(name) for name in PROFILE_CELL]).alias("profile_key"),
        "crossing_name",
        "traffic_type",
        F.col("local_hour_pt").alias("hour_of_day"),
        F.col("local_dow_pt").alias("day_of_week"),
        F.col("local_month_pt").alias("month_of_year"),
        is_weekend(F.col("local_dow_pt")).alias("is_weekend"),
        season(F.col("local_month_pt")).alias("season"),
        "observations",
        "delayed_observations",
        round_ratio(F.col("delayed_observations"), observations, 4).alias("delay_probability"),
        round_ratio(F.col("minutes_sum"), observations, 2).alias("mean_delay_minutes"),
        round_half_away(F.col("quantiles")[0], 6).alias("median_delay_minutes"),
        round_half_away(F.col("quantiles")[1], 6).alias("p90_delay_minutes"),
        "max_delay_minutes",
        round_half_away(spread, 2).alias("stddev_delay_minutes"),
        "closed_observations",
        "missed_observations",
        "total_observations",
        round_ratio(observations, F.col("total_observations"), 4).alias("measurement_coverage"),
    )
