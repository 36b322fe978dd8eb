"""Staging layer: cleaned, typed, long-form rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowmart.functions.delay import with_delay
from flowmart.functions.keys import composite_key
from flowmart.functions.text import blank_to_null
from flowmart.functions.timez import local_parts, local_to_utc
from flowmart.functions.vessel import (
    is_stationary,
    nav_status_desc,
    overall,
    status_speed_conflict,
    vessel_category,
)


# The flow columns of both feeds, as <traffic>_<direction>_bound and <traffic>_flow.
TRAFFIC = ("commercial", "travellers")
LIVE_FLOWS = tuple((traffic, direction) for traffic in TRAFFIC for direction in ("canada", "us"))


def stg_border_waits(raw: DataFrame) -> DataFrame:
    """Live readings as (crossing, traffic type, direction, fetch) rows.

    Everything that depends on the reading alone is computed before the unpivot,
    once instead of four times.
    """
    calendar = local_parts(F.col("fetched_at"))
    readings = raw.select(
        "observation_id",
        "fetched_at",
        F.trim("customs_office").alias("crossing_name"),
        F.trim("location").alias("crossing_location"),
        local_to_utc(F.col("last_updated_text")).alias("cbsa_updated_at_utc"),
        *[calendar[n].alias(n) for n in ("local_hour_pt", "local_dow_pt", "local_month_pt")],
        *[f"{traffic}_{direction}_bound" for traffic, direction in LIVE_FLOWS],
    )
    flows = [
        cell
        for traffic, direction in LIVE_FLOWS
        for cell in (F.lit(traffic), F.lit(direction), F.col(f"{traffic}_{direction}_bound"))
    ]
    long_form = F.stack(F.lit(len(LIVE_FLOWS)), *flows).alias(
        "traffic_type", "direction", "delay_text_raw"
    )
    return (
        with_delay(readings.select("*", long_form), "delay_text_raw")
        .select(
            composite_key(
                F.col("observation_id"), F.col("traffic_type"), F.col("direction")
            ).alias("wait_observation_key"),
            "observation_id",
            "fetched_at",
            "crossing_name",
            "crossing_location",
            "traffic_type",
            "direction",
            "delay_text_raw",
            "delay_minutes",
            "delay_status",
            "cbsa_updated_at_utc",
            "local_hour_pt",
            "local_dow_pt",
            "local_month_pt",
        )
    )


def stg_border_waits_historical(raw: DataFrame) -> DataFrame:
    """Archive readings in long form, all Canada-bound.

    Readings without a usable time are dropped (P22). The time travels through
    the unpivot, so that the test on it is not pushed below the parse and the
    parse done a second time there.
    """
    readings = raw.select(
        "historical_id",
        "source_file",
        F.trim("customs_office").alias("crossing_name"),
        F.trim("location").alias("crossing_location"),
        local_to_utc(F.col("updated_text")).alias("utc"),
        *[f"{traffic}_flow" for traffic in TRAFFIC],
    ).withColumns(local_parts(F.col("utc")))
    flows = [
        cell
        for traffic in TRAFFIC
        for cell in (F.lit(traffic), F.col(f"{traffic}_flow"), F.col("utc"))
    ]
    long_form = F.stack(F.lit(len(TRAFFIC)), *flows).alias(
        "traffic_type", "delay_text_raw", "observed_at_utc"
    )
    timed = readings.select("*", long_form).where(F.col("observed_at_utc").isNotNull())
    return (
        with_delay(timed, "delay_text_raw")
        .withColumn("direction", F.lit("canada"))
        .select(
            composite_key(F.col("historical_id"), F.col("traffic_type")).alias(
                "wait_observation_key"
            ),
            "historical_id",
            "source_file",
            "crossing_name",
            "crossing_location",
            "traffic_type",
            "direction",
            "delay_text_raw",
            "delay_minutes",
            "delay_status",
            "observed_at_utc",
            "local_hour_pt",
            "local_dow_pt",
            "local_month_pt",
            "local_year_pt",
        )
    )


def _column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name)


def stg_vessel_positions(raw: DataFrame) -> DataFrame:
    """Positions with decoded status and holding flags."""
    code, speed = F.col("navigational_status"), F.col("sog")
    return raw.select(
        "snapshot_id",
        "snapshot_ts",
        "region",
        "mmsi",
        blank_to_null(F.col("ship_name")).alias("ship_name"),
        "latitude",
        "longitude",
        speed.alias("speed_over_ground_kn"),
        F.col("cog").alias("course_over_ground_deg"),
        _column_or_null(raw, "true_heading", "int"),
        "navigational_status",
        nav_status_desc(code).alias("nav_status_desc"),
        is_stationary(code, speed).alias("is_stationary"),
        status_speed_conflict(code, speed).alias("status_speed_conflict"),
        "message_ts",
        _column_or_null(raw, "ingested_at", "timestamp"),
    )


def stg_vessels(raw: DataFrame) -> DataFrame:
    """Vessel attributes with category and dimensions."""
    return raw.select(
        "mmsi",
        blank_to_null(F.col("ship_name")).alias("ship_name"),
        "ship_type",
        vessel_category(F.col("ship_type")).alias("vessel_category"),
        "imo_number",
        blank_to_null(F.col("call_sign")).alias("call_sign"),
        blank_to_null(F.col("destination")).alias("destination"),
        "eta_text",
        overall(F.col("dim_a"), F.col("dim_b")).alias("length_m"),
        overall(F.col("dim_c"), F.col("dim_d")).alias("beam_m"),
        "max_draught",
        _column_or_null(raw, "first_seen_at", "timestamp"),
        _column_or_null(raw, "last_seen_at", "timestamp"),
    )
