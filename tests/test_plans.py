"""Physical plans: no cross joins, no Python rows, pruned scans, no single-task windows."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from contract.queries import REGISTRY as QUERIES

# Queries that run jobs while they are built are covered by their parts.
BATCH = sorted(
    name
    for name in QUERIES
    if not name.startswith(("stream_", "load_archive", "archive_backfill", "collect_", "incremental_border_build"))
    and name not in {"prediction_grid", "hurdle_holdout_metrics", "model_summary"}
)


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_plan_scales(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF", text)


def read_columns(text):
    return [re.findall(r"(\w+):", m) for m in re.findall(r"ReadSchema: struct<(.*)>", text)]


def test_scans_read_only_what_is_needed(spark, small):
    text = plan(QUERIES["congestion_band"](spark, small))
    assert [sorted(c) for c in read_columns(text)] == [
        ["l_linenumber", "l_orderkey", "l_partkey", "l_quantity", "l_shipdate", "l_suppkey"]
    ]
    text = plan(QUERIES["feed_freshness"](spark, small))
    assert all(columns == ["ts"] for columns in read_columns(text))


def test_newest_rows_of_a_stored_table_read_its_newest_day(spark, small):
    from flowmart.plans import serving, warehouse
    from flowmart.session import scratch_path
    from flowmart.sources import adapters
    from flowmart.sources.tables import Warehouse

    house = Warehouse(spark, scratch_path(spark, "house"))
    warehouse.build_border(house, adapters.border_raw(spark, small))
    stored = house.read("analytics_marts", "fct_border_waits")
    lanes = serving.latest_border_waits(stored)
    text = plan(lanes)
    assert re.search(r"PartitionFilters: \[.*day#\d+ = 2024-01-3", text), text
    assert len(re.findall(r"\(\d+\) Scan parquet", text)) == 1
    newest = serving.latest_border_waits(house.newest("analytics_marts", "fct_border_waits"))
    assert sorted(map(tuple, lanes.collect())) == sorted(map(tuple, newest.collect()))


def test_facts_are_not_shuffled(spark, small):
    text = plan(QUERIES["fct_border_waits"](spark, small))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_large_dimension_is_not_broadcast(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(QUERIES["fct_border_waits"](spark, small))
        assert "SortMergeJoin" in text and "BroadcastExchange" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_profile_counts_in_a_hash_aggregate_before_the_shuffle(spark, small):
    text = plan(QUERIES["border_delay_profile"](spark, small))
    assert re.search(r"HashAggregate", text) and "Join" not in text
