from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from flowmart.operators import boxes, incremental, latest, lookup, metrics, prefix, quality
from flowmart.sources import tables
from flowmart.sources.versions import VersionedTable

QUICK = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
DAY = datetime(2026, 1, 1)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_latest_per_key_keeps_whole_record(spark):
    df = spark.createDataFrame(
        [("a", 1, 0, "x"), ("a", 2, 0, None), ("a", 2, -1, "z"), ("b", 1, 5, "q")],
        "k string, t int, tie int, v string",
    )
    got = latest.latest_per_key(df, ["k"], ["t", "tie"])
    assert got.columns == df.columns
    assert rows_of(got, "k", "t", "tie", "v") == [("a", 2, 0, None), ("b", 1, 5, "q")]


def test_latest_rows_keep_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 1, 4)], "g string, t int, v int"
    )
    assert rows_of(latest.latest_rows(df, "g", "t"), "v") == [(2,), (3,), (4,)]
    assert rows_of(latest.newest_rows(df, "t"), "v") == [(2,), (3,)]
    assert latest.newest_rows(df.where("t > 9"), "t").count() == 0


@QUICK
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60, unique=True))
def test_running_totals_match_brute_force(spark, keys):
    data = [(k, abs(k) % 7, k * k) for k in keys]
    df = spark.createDataFrame(data, "k int, a bigint, b bigint").repartition(3)
    got = {r.k: r for r in prefix.running_totals(df, "k", ["a", "b"]).collect()}
    for k, _, _ in data:
        below = [d for d in data if d[0] < k]
        assert got[k].a_before == sum(d[1] for d in below)
        assert got[k].b_before == sum(d[2] for d in below)
        assert got[k].a_all == sum(d[1] for d in data)


def test_dense_codes(spark):
    df = spark.createDataFrame([(n,) for n in ["b", "a", "c", "a", None]], "n string")
    assert rows_of(prefix.dense_codes(df, "n", "code"), "n", "code") == [("a", 0), ("b", 1), ("c", 2)]


def brute_auc(rows):
    pos = [s for s, y, w in rows for _ in range(w) if y]
    neg = [s for s, y, w in rows for _ in range(w) if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(rows):
    flat = [(s, y) for s, y, w in rows for _ in range(w)]
    total = sum(y for _, y in flat)
    result, before = 0.0, 0.0
    for cut in sorted({s for s, _ in flat}, reverse=True):
        taken = [y for s, y in flat if s >= cut]
        recall = sum(taken) / total
        result += (recall - before) * sum(taken) / len(taken)
        before = recall
    return result


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rank_metrics_match_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randint(0, 6) / 7, rng.random() < 0.4, rng.randint(1, 3)) for _ in range(60)]
    rows += [(0.5, True, 1), (0.5, False, 1)]
    df = spark.createDataFrame(rows, "s double, y boolean, w bigint")
    got = metrics.rank_metrics(df, "s", "y", "w").first()
    assert got.roc_auc == pytest.approx(brute_auc(rows))
    assert got.average_precision == pytest.approx(brute_ap(rows))
    assert got.n_rows == sum(w for _, _, w in rows)


def test_rank_metrics_without_one_class(spark):
    df = spark.createDataFrame([(0.1, False), (0.2, False)], "s double, y boolean")
    got = metrics.rank_metrics(df, "s", "y").first()
    assert (got.roc_auc, got.average_precision, got.positives) == (None, None, 0)


def test_fallback_means_use_the_finest_known_cell(spark):
    train = spark.createDataFrame(
        [("a", 1, 10, 2), ("a", 2, 30, 1), ("b", 1, 8, 4)], "k string, h int, total int, n int"
    )
    target = spark.createDataFrame([("a", 1), ("a", 9), ("b", 2), ("z", 1)], "k string, h int")
    got = lookup.fallback_means(train, target, ["k", "h"], {"m": "total"}, "n")
    assert rows_of(got, "k", "h", "m") == [
        ("a", 1, 5.0), ("a", 9, 40 / 3), ("b", 2, 2.0), ("z", 1, 48 / 7),
    ]


def test_high_water_mark_is_strict(spark):
    source = spark.createDataFrame([(DAY + timedelta(hours=h), h) for h in range(5)], "t timestamp, h int")
    target = source.where("h <= 2")
    assert rows_of(incremental.newer_than(source, target, "t"), "h") == [(3,), (4,)]
    assert rows_of(incremental.newer_than(source, None, "t"), "h") == [(h,) for h in range(5)]
    assert rows_of(incremental.newer_than(source, source.where("h > 9"), "t"), "h") == [
        (h,) for h in range(5)
    ]
    back = incremental.newer_than(source, target, "t", timedelta(hours=1))
    assert rows_of(back, "h") == [(2,), (3,), (4,)]


def test_attribute_merge_keeps_old_values_over_nulls(spark):
    later = DAY + timedelta(days=1)
    current = spark.createDataFrame(
        [(1, "A", 70, DAY, DAY), (2, "B", None, DAY, DAY)],
        "mmsi int, name string, kind int, first_seen_at timestamp, last_seen_at timestamp",
    )
    changes = spark.createDataFrame(
        [(1, None, 71, later), (3, "C", None, later)], "mmsi int, name string, kind int, seen timestamp"
    )
    got = incremental.merge_attributes(current, changes, "mmsi", ["name", "kind"], "seen")
    assert rows_of(got, "mmsi", "name", "kind", "first_seen_at", "last_seen_at") == [
        (1, "A", 71, DAY, later), (2, "B", None, DAY, DAY), (3, "C", None, later, later),
    ]


def test_fold_equals_repeated_merges(spark):
    rng = random.Random(5)
    history = [
        (rng.randint(1, 3), DAY + timedelta(hours=h), rng.choice([None, "x", "y"]), rng.choice([None, 1, 2]))
        for h in range(12)
    ]
    state: dict = {}
    for mmsi, seen, name, kind in history:
        old = state.get(mmsi, (None, None, seen, seen))
        state[mmsi] = (name or old[0], kind or old[1], old[2], seen)
    df = spark.createDataFrame(history, "mmsi int, seen timestamp, name string, kind int")
    got = incremental.fold_attributes(df, "mmsi", ["name", "kind"], ["seen"])
    assert {r.mmsi: tuple(r)[1:] for r in got.collect()} == state


def test_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "b", None), (2, None, 50), (None, "c", -1), (None, "a", 9)],
        "id int, word string, n int",
    )
    parent = spark.createDataFrame([(1,)], "id int")
    checks = quality.TableChecks(
        rows=[
            quality.not_null("id"),
            quality.accepted_values("word", ["a", "b"]),
            quality.accepted_range("n", 0, 9, severity="warn"),
        ],
        unique=["id"],
        parents=[("id", parent, "id")],
    )
    results = quality.run_checks(df, checks)
    assert {(r.check, r.column): (r.failures, r.severity) for r in results.collect()} == {
        ("unique", "id"): (1, "error"),
        ("not_null", "id"): (2, "error"),
        ("accepted_values", "word"): (1, "error"),
        ("accepted_range", "n"): (2, "warn"),
        ("relationships", "id"): (1, "error"),
    }
    with pytest.raises(quality.CheckFailure, match="not_null"):
        quality.enforce(results)
    warned = quality.enforce(results.where("severity = 'warn'"))
    assert [r.column for r in warned] == ["n"]


def test_freshness_levels(spark):
    as_of = F.lit("2026-01-02 00:00:00").cast("timestamp")
    for hours, status in [(2, "pass"), (3, "warn"), (13, "error")]:
        df = spark.createDataFrame([(datetime(2026, 1, 2) - timedelta(hours=hours),)], "t timestamp")
        assert quality.source_freshness(df, "s", "t", as_of).first().status == status
    assert quality.source_freshness(df.where("t is null"), "s", "t", as_of).first().status == "error"


def test_null_predictions_have_no_weight(spark):
    rows = spark.createDataFrame([(10.0, 12.0, 1), (None, 30.0, 1)], "p double, y double, n int")
    error = metrics.mean_absolute_error(F.col("p"), F.col("y"), F.col("n"))
    assert rows.agg(error).first()[0] == 2.0


def test_rows_without_a_day_do_not_reset_the_mark(spark, tmp_path):
    stored = VersionedTable(spark, str(tmp_path / "table"), ["id"])
    rows = [(1, "2026-01-01 10:00:00"), (2, None), (3, "2026-01-02 10:00:00")]
    table = spark.createDataFrame(rows, "id int, t string").select("id", F.col("t").cast("timestamp").alias("t"))
    stored.replace(table.withColumn("day", F.to_date("t")))
    newest = stored.newest()
    assert [r.id for r in newest.collect()] == [3]
    assert incremental.newer_than(table, newest, "t").count() == 0
    assert incremental.newer_than(table, None, "t").count() == 2
    assert [r.id for r in incremental.without_time(table, "t").collect()] == [2]


def test_replacing_a_table_keeps_the_old_rows_until_the_end(spark, tmp_path):
    path = str(tmp_path / "table")
    assert tables.read_table_if_exists(spark, path) is None
    tables.replace_table(spark.range(3), path)
    broken = spark.range(2).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.replace_table(broken, path)
    assert tables.read_table_if_exists(spark, path).count() == 3
    for n in (4, 5, 6):
        tables.replace_table(spark.range(n), path)
    assert tables.read_table_if_exists(spark, path).count() == 6
    assert len([p for p in (tmp_path / "table").iterdir() if p.name.startswith("version-")]) <= 2


def test_boxes_as_a_table_equal_the_chain_of_conditions(spark):
    from flowmart.functions.places import PORT_BOXES, port_region

    rng = random.Random(4)
    listed = list(PORT_BOXES)
    for k in range(300):
        south, west = round(rng.uniform(-80, 80), 3), round(rng.uniform(-179, 179), 3)
        size = rng.choice([0.0, 0.004, 0.3, 5.0, 40.0])
        listed.append((f"box {k}", south, west, south + size, west + size * rng.choice([0.1, 1.0])))
    listed += [("world", -90.0, -180.0, 90.0, 180.0), ("wrong", 10.0, 10.0, 0.0, 0.0)]
    points = [(round(rng.uniform(-90, 90), 3), round(rng.uniform(-180, 180), 3)) for _ in range(2000)]
    points += [(box[1 + 2 * (k % 2)], box[2 + 2 * (k // 2 % 2)]) for k, box in enumerate(listed)]
    points += [(None, 1.0), (1.0, None), (None, None), (-0.0, 0.0), (0.0, 0.0), (48.95, -123.65), (48.95, -123.65), (91.0, 0.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, lat double, lon double")
    for some in (listed, listed[:-2], listed[:2]):
        table = spark.createDataFrame(
            [(*box, k) for k, box in enumerate(some)] + [("no edge", None, 0.0, 1.0, 1.0, -1)],
            "region string, south double, west double, north double, east double, priority int",
        )
        got = boxes.region_by_boxes(df, table, "lat", "lon")
        assert got.columns == ["i", "lat", "lon", "region"]
        chain = df.withColumn("region", port_region(F.col("lat"), F.col("lon"), some[:90] + some[-2:]))
        if len(some) < 90:
            assert rows_of(got, "i", "region") == rows_of(chain, "i", "region")
        want = {
            i: next((b[0] for b in some if None not in p and b[1] <= p[0] <= b[3] and b[2] <= p[1] <= b[4]), None)
            for i, p in enumerate(points)
        }
        assert dict(rows_of(got, "i", "region")) == want


def test_a_box_touches_four_cells_at_most(spark):
    rng = random.Random(9)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180), 10 ** rng.uniform(-4, 2.2)) for _ in range(500)]
    table = spark.createDataFrame(
        [(str(k), s, w, s + d, w + d, k) for k, (s, w, d) in enumerate(rows)],
        "region string, south double, west double, north double, east double, priority int",
    )
    cells = boxes.box_cells(table)
    assert cells.groupBy("region").count().agg(F.max("count")).first()[0] <= 4
    assert cells.select("level").distinct().count() <= boxes.LEVELS


def test_a_task_reads_a_bounded_part_of_a_pinned_table(spark, tmp_path):
    from pathlib import Path

    import pyarrow.parquet as pq

    from flowmart.operators.incremental import write_partitioned
    from flowmart.session import ROW_GROUP_BYTES, RUNTIME_SETTINGS, pin, scratch_path

    assert RUNTIME_SETTINGS["spark.sql.files.maxPartitionBytes"] == "16m"
    ids = spark.range(0, 3_000_000, 1, 1).withColumn("day", F.lit("one"))
    stored = scratch_path(spark, "parts")
    write_partitioned(ids, stored, "day")
    folders = [pin(ids, "ids").inputFiles()[0].rsplit("/", 1)[0], f"{stored}/day=one"]
    for folder in folders:
        files = [pq.ParquetFile(p).metadata for p in Path(folder.removeprefix("file:").replace("//", "/")).glob("*.parquet")]
        sizes = [m.row_group(k).total_byte_size for m in files for k in range(m.num_row_groups)]
        assert sum(m.num_rows for m in files) == 3_000_000
        assert max(sizes) < 2 * ROW_GROUP_BYTES


def test_a_listing_of_many_folders_takes_few_tasks(spark, tmp_path):
    path, context = str(tmp_path / "table"), spark.sparkContext
    spark.range(100).withColumn("day", F.col("id")).repartition(1).write.partitionBy("day").parquet(path)
    context.setJobGroup("listing", "many folders")
    try:
        assert spark.read.parquet(*[f"{path}/day={k}" for k in range(100)]).count() == 100
        tracker = context.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
        tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert tasks and max(tasks) <= 64
