from __future__ import annotations

import contextlib
import io
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowmart.operators.incremental import newer_than
from flowmart.operators.quality import CheckFailure, run_checks
from flowmart.plans import marts, serving, staging, warehouse
from flowmart.session import scratch_path
from flowmart.sources import adapters
from flowmart.sources.tables import Warehouse, read_source


def bag(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def raw(spark, small):
    return {
        "border": adapters.border_raw(spark, small),
        "positions": adapters.ais_positions(spark, small),
        "static": adapters.ship_static(spark, small),
        # The smallest sample repeats a few ids.
        "archive": adapters.archive_raw(spark, small).dropDuplicates(["historical_id"]),
    }


def plan_text(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    return text.getvalue()


def cut(df, column, upto):
    return df.where(F.col(column) < F.lit(upto).cast("timestamp"))


def test_border_in_slices_equals_full_rebuild(spark, raw):
    house = Warehouse(spark, scratch_path(spark, "house"))
    for upto in ("2024-01-10 00:00:00", "2024-01-20 00:00:00"):
        warehouse.build_border(house, cut(raw["border"], "fetched_at", upto))
    sliced = bag(warehouse.build_border(house, raw["border"]))
    assert bag(warehouse.build_border(house, raw["border"])) == sliced
    full = Warehouse(spark, scratch_path(spark, "house"))
    assert bag(warehouse.build_border(full, raw["border"], full_refresh=True)) == sliced
    assert len(sliced) == 4 * raw["border"].count()


def test_a_versioned_source_gives_equal_times_and_late_rows_once(spark, raw):
    house = Warehouse(spark, scratch_path(spark, "house"))
    source = house.table("raw", "border_raw", "observation_id")
    day = F.to_date("fetched_at")
    third = F.pmod(F.xxhash64("observation_id"), F.lit(3))
    for part in (2, 0, 1):
        source.replace(raw["border"].where(third == part).withColumn("day", day))
        facts = warehouse.build_border(house, source)
        again = warehouse.build_border(house, source)
        assert again.count() == facts.count() == 4 * source.read().count()
    full = Warehouse(spark, scratch_path(spark, "house"))
    columns = ["wait_observation_key", "fetched_at", "delay_minutes", "delay_status", "day"]
    assert bag(facts, *columns) == bag(warehouse.build_border(full, raw["border"]), *columns)
    commits = house.table("analytics_marts", "fct_border_waits").commit()
    assert commits == 3
    refreshed = warehouse.build_border(house, source, full_refresh=True)
    assert bag(refreshed) == bag(warehouse.build_border(full, raw["border"], full_refresh=True))


def test_ports_and_checks(spark, raw):
    house = Warehouse(spark, scratch_path(spark, "house"))
    warehouse.build_border(house, raw["border"])
    warehouse.build_ports(house, cut(raw["positions"], "snapshot_ts", "2024-01-15 00:00:00"), raw["static"])
    sliced = bag(warehouse.build_ports(house, raw["positions"], raw["static"]).drop("day"))
    whole = marts.fct_port_congestion(
        staging.stg_vessel_positions(raw["positions"]), staging.stg_vessels(raw["static"])
    )
    assert sliced == bag(whole)
    warehouse.build_archive(house, raw["archive"])
    results = warehouse.check_marts(house)
    assert set(results) == {
        "dim_crossings", "fct_border_waits", "dim_vessels", "fct_port_congestion",
        "agg_border_delay_profile",
    }
    history = staging.stg_border_waits_historical(raw["archive"])
    staged = warehouse.mart_checks(history)["stg_border_waits_historical"]
    assert run_checks(history, staged).where("failures > 0").count() == 0
    sources = {
        "border_raw": raw["border"], "hist_raw": raw["archive"],
        "ais_positions": raw["positions"], "ship_static": raw["static"],
    }
    for name, checks in warehouse.raw_checks().items():
        assert run_checks(sources[name], checks).where("failures > 0").count() == 0


def test_number_of_declared_assertions(spark):
    parent = spark.range(1)
    tables = [*warehouse.raw_checks().values(), *warehouse.mart_checks(parent).values()]
    assert sum(len(t.rows) + len(t.unique) + len(t.parents) for t in tables) == 43


def test_facts_keep_the_dimension_value_of_their_run(spark):
    at = datetime(2026, 1, 5)
    schema = (
        "observation_id bigint, fetched_at timestamp, customs_office string, location string, "
        "last_updated_text string, commercial_canada_bound string, commercial_us_bound string, "
        "travellers_canada_bound string, travellers_us_bound string"
    )

    def reading(i, place):
        return (i, at + timedelta(hours=i), "A", place, "2026-01-04 20:00 PST", "15", "--", "5", "No Delay")

    house = Warehouse(spark, scratch_path(spark, "house"))
    rows = [reading(1, "Surrey, BC/Blaine, WA")]
    warehouse.build_border(house, spark.createDataFrame(rows, schema))
    rows.append(reading(2, "Windsor, ON/Detroit, MI"))
    facts = warehouse.build_border(house, spark.createDataFrame(rows, schema))
    groups = {(r.fetched_at.hour, r.region_group) for r in facts.collect()}
    assert groups == {(1, "pacific"), (2, "ontario")}
    facts = warehouse.build_border(house, spark.createDataFrame(rows, schema), full_refresh=True)
    assert {r.region_group for r in facts.collect()} == {"ontario"}
    late = [reading(0, "Surrey, BC/Blaine, WA")]
    facts = warehouse.build_border(house, spark.createDataFrame(late, schema))
    assert facts.count() == 8
    facts = warehouse.build_border(
        house, spark.createDataFrame(late, schema), lookback=timedelta(hours=6)
    )
    assert facts.count() == 12


def test_errors_stop_the_build(spark, raw):
    house = Warehouse(spark, scratch_path(spark, "house"))
    warehouse.build_border(house, raw["border"])
    table = house.table("analytics_marts", "fct_border_waits", "wait_observation_key")
    table.overwrite(table.read().withColumn("direction", F.lit("north")))
    with pytest.raises(CheckFailure, match="accepted_values\\(direction\\)"):
        warehouse.check_marts(house)


def test_profile_properties(spark, raw):
    history = staging.stg_border_waits_historical(raw["archive"])
    profile = marts.agg_border_delay_profile(history)
    row = profile.agg(
        F.sum("total_observations").alias("total"),
        F.min(F.col("max_delay_minutes") - F.col("p90_delay_minutes")).alias("a"),
        F.min(F.col("p90_delay_minutes") - F.col("median_delay_minutes")).alias("b"),
        F.min(F.col("total_observations") - F.col("observations")).alias("c"),
        F.max("measurement_coverage").alias("d"),
    ).first()
    assert row.total <= history.count()
    assert min(row.a, row.b, row.c) >= 0 and row.d <= 1


def test_profile_statistics_match_python(spark):
    import statistics

    minutes = [0, 0, 0, 5, 10, 20, 60]
    rows = [(m, "reported") for m in minutes] + [(None, "closed"), (None, "missed_entry"), (None, "unknown")]
    df = spark.createDataFrame(rows, "delay_minutes int, delay_status string").withColumns(
        {
            "crossing_name": F.lit("A"), "traffic_type": F.lit("commercial"),
            "local_hour_pt": F.lit(8), "local_dow_pt": F.lit(6), "local_month_pt": F.lit(12),
        }
    )
    got = marts.agg_border_delay_profile(df).first()
    assert (got.observations, got.delayed_observations, got.total_observations) == (7, 4, 10)
    assert (got.closed_observations, got.missed_observations) == (1, 1)
    assert got.mean_delay_minutes == round(statistics.mean(minutes), 2)
    assert got.stddev_delay_minutes == round(statistics.stdev(minutes), 2)
    assert (got.median_delay_minutes, got.p90_delay_minutes, got.max_delay_minutes) == (5.0, 36.0, 60)
    assert (got.delay_probability, got.measurement_coverage) == (0.5714, 0.7)
    assert (got.is_weekend, got.season) == (True, "winter")


def test_empty_headline_and_short_trend(spark, raw):
    staged = staging.stg_border_waits(raw["border"])
    facts = marts.fct_border_waits(staged, marts.dim_crossings(staged))
    none = serving.border_headline(serving.latest_border_waits(facts.where("direction = 'us'")))
    row = none.first()
    assert (row.lanes_reporting, row.worst_crossing, row.tone) == (0, None, "")
    snapshots = spark.createDataFrame(
        [(datetime(2026, 1, 1, h), "vancouver", 0.5) for h in range(3)],
        "snapshot_ts timestamp, region string, stationary_share double",
    )
    as_of = F.lit("2026-01-02 00:00:00").cast("timestamp")
    assert serving.congestion_pivot(snapshots, as_of, 3).count() == 0
    more = snapshots.union(snapshots.limit(1).withColumn("snapshot_ts", F.lit(datetime(2026, 1, 1, 9))))
    assert serving.congestion_pivot(more, as_of, 3).count() == 4


def test_loads_read_only_the_newest_folder(spark, raw):
    house = Warehouse(spark, scratch_path(spark, "house"))
    facts = warehouse.build_border(house, raw["border"])
    newest = house.newest("analytics_marts", "fct_border_waits")
    assert newest.agg(F.max("fetched_at")).first() == facts.agg(F.max("fetched_at")).first()
    assert newest.select("day").distinct().count() == 1
    fresh = newer_than(facts, newest.where("fetched_at < timestamp '2024-01-30 12:00:00'"), "fetched_at")
    assert "PartitionFilters: [isnotnull(day" in plan_text(fresh)
    mark = newest.where("fetched_at < timestamp '2024-01-30 12:00:00'").agg(F.max("fetched_at")).first()[0]
    assert fresh.count() == facts.where(F.col("fetched_at") > mark).count()
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    assert "PartitionFilters: [isnotnull(day" in plan_text(serving.within_days(facts, "fetched_at", as_of, 3))


def test_readers(spark, raw):
    path = scratch_path(spark, "csv")
    raw["static"].select("mmsi", "ship_name").write.csv(path, header=True)
    again = read_source(spark, "csv", path, header="true")
    assert again.count() == raw["static"].count()
