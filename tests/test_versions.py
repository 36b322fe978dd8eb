from __future__ import annotations

import contextlib
import io
from datetime import date

import pytest
from pyspark.sql import Row, functions as F

from flowmart.session import scratch_path
from flowmart.sources import versions
from flowmart.sources.versions import CompactedAway, VersionedTable


@pytest.fixture
def table(spark):
    return VersionedTable(spark, scratch_path(spark, "versions"), ["id"])


def frame(spark, *rows):
    return spark.createDataFrame([(i, date(2026, 1, d), v) for i, d, v in rows], "id bigint, day date, value string")


def bag(df):
    return sorted((r.id, r.day.day, r.value) for r in df.collect()) if df is not None else []


def scanned(df):
    """Folders of the plan's scans."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_replace_by_key_and_repeat(spark, table):
    assert table.read() is None and table.newest() is None and table.changes(0) is None
    table.replace(frame(spark, (1, 1, "a"), (2, 1, "a"), (3, 2, "a")))
    table.replace(frame(spark, (2, 1, "b"), (4, 3, "b")))
    want = [(1, 1, "a"), (2, 1, "b"), (3, 2, "a"), (4, 3, "b")]
    assert bag(table.read()) == want
    table.replace(frame(spark, (2, 1, "b"), (4, 3, "b")))
    assert bag(table.read()) == want
    assert bag(table.newest()) == [(4, 3, "b")]
    assert bag(table.newest_of_each("value", ["a", "b"])) == [(3, 2, "a"), (4, 3, "b")]


def test_a_key_stays_in_its_partition(spark, table):
    table.replace(frame(spark, (1, 1, "a"), (2, 2, "a")))
    for rows in ([(1, 2, "b")], [(1, 3, "b")], [(1, 2, "b"), (5, 1, "b")]):
        with pytest.raises(ValueError, match="another day"):
            table.replace(frame(spark, *rows))
    assert bag(table.read()) == [(1, 1, "a"), (2, 2, "a")] and table.commit() == 1


def test_a_reader_that_began_before_a_load_sees_one_state(spark, table):
    table.replace(frame(spark, (1, 1, "a"), (2, 2, "a")))
    begun = table.read()
    table.replace(frame(spark, (1, 1, "b"), (2, 2, "b"), (3, 3, "b")))
    table.compact()
    table.vacuum()
    assert bag(begun) == [(1, 1, "a"), (2, 2, "a")] == bag(table.read(commit=1))
    assert bag(table.read()) == [(1, 1, "b"), (2, 2, "b"), (3, 3, "b")]


def test_a_load_that_breaks_off_leaves_the_table(spark, table, monkeypatch):
    table.replace(frame(spark, (1, 1, "a"), (2, 2, "a")))
    written = VersionedTable._written
    calls = []

    def breaks(self, *args):
        calls.append(args)
        if len(calls) == 2:  # the new rows are written, the old days not yet
            raise OSError("lost")
        return written(self, *args)

    monkeypatch.setattr(VersionedTable, "_written", breaks)
    with pytest.raises(OSError, match="lost"):
        table.replace(frame(spark, (1, 1, "b"), (2, 2, "b")))
    monkeypatch.undo()
    assert bag(table.read()) == [(1, 1, "a"), (2, 2, "a")]
    assert table.vacuum(hours=0) == 1
    table.replace(frame(spark, (1, 1, "b"), (2, 2, "b")))
    assert bag(table.read()) == [(1, 1, "b"), (2, 2, "b")]


def test_of_two_loads_at_once_the_later_one_starts_anew(spark, table, monkeypatch):
    table.replace(frame(spark, (1, 1, "a")))
    other = VersionedTable(spark, table.path, ["id"])
    commit = VersionedTable._commit
    between = []

    def slow(self, number, entries):
        if not between:
            between.append(number)
            other.replace(frame(spark, (1, 1, "other"), (2, 2, "other")))
        return commit(self, number, entries)

    monkeypatch.setattr(VersionedTable, "_commit", slow)
    assert table.replace(frame(spark, (2, 2, "mine"), (3, 3, "mine"))) == 3
    assert bag(table.read()) == [(1, 1, "other"), (2, 2, "mine"), (3, 3, "mine")]


def test_a_load_without_rows_is_no_commit(spark, table):
    assert table.replace(frame(spark, (1, 1, "a")).limit(0)) == 0
    table.replace(frame(spark, (1, 1, "a")))
    assert table.replace(frame(spark, (1, 1, "a")).limit(0)) == 1 == table.commit()


def test_partitions_another_loader_added_are_left_out(spark):
    table = VersionedTable(spark, scratch_path(spark, "versions"))
    rows = frame(spark, (1, 1, "a"), (2, 2, "a"))
    assert table.add_partitions(rows, ["2026-01-01", "2026-01-02", "2026-01-03"]) == 1
    assert table.add_partitions(rows, ["2026-01-01", "2026-01-02", "2026-01-03"]) == 0
    assert table.commit() == 1 and table.read().count() == 2 and len(table.entries()) == 3


def test_consumers_get_equal_times_and_late_rows_once(spark, table):
    table.replace(frame(spark, (1, 5, "a"), (2, 5, "a")))
    first = table.commit()
    assert bag(table.changes(0)) == [(1, 5, "a"), (2, 5, "a")]
    # The same day and an earlier one; one row in a new form.
    table.replace(frame(spark, (3, 5, "b"), (4, 1, "b"), (1, 5, "b")))
    assert bag(table.changes(first)) == [(1, 5, "b"), (3, 5, "b"), (4, 1, "b")]
    assert table.changes(table.commit()) is None
    assert bag(table.changes(0, upto=first)) == [(1, 5, "a"), (2, 5, "a")]


def test_compaction_keeps_rows_and_bounds_folders(spark, table):
    for k in range(6):
        table.replace(frame(spark, (k, 1, "a"), (100 + k, 2, "a"), (200 + k, 3 + k, "a")), taken=k)
    before, commit = bag(table.read()), table.commit()
    table.replace(frame(spark, (50, 1, "b")), taken=9)
    table.compact(upto=commit)
    assert bag(table.read()) == sorted([*before, (50, 1, "b")]) and table.taken() == 9
    folders = [e.folder for e in table.entries()]
    assert folders.count("day=2026-01-01") == 2 and folders.count("day=2026-01-02") == 1
    assert bag(table.changes(commit)) == [(50, 1, "b")]
    with pytest.raises(CompactedAway):
        table.changes(commit - 2)
    present = table.commit()
    assert table.compact(folders=2) == present
    table.replace(frame(spark, (3, 1, "c")))
    assert (3, 1, "c") in bag(table.read()) and table.read().count() == len(before) + 1


@pytest.mark.parametrize("spread", [False, True])
def test_a_load_reads_the_keys_of_few_folders(spark, monkeypatch, spread):
    """By range where keys follow time, else by Bloom filter; however long the history is."""

    def name(day, k):
        return F.xxhash64(F.lit(day), k) if spread else F.lit(day * 10_000) + k

    def day_of(day, n):
        return spark.range(n).select(name(day, F.col("id")).alias("id"), F.lit(date(2026, 1, day)).alias("day"), F.lit("a").alias("value"))

    opened = []
    holding = VersionedTable._holding
    monkeypatch.setattr(
        VersionedTable, "_holding", lambda self, entries, known: opened.append(len(entries)) or holding(self, entries, known)
    )
    table = VersionedTable(spark, scratch_path(spark, "versions"), ["id"])
    for day in range(1, 13):
        table.replace(day_of(day, 500))
    opened.clear()
    table.replace(day_of(12, 510).where(F.col("id").isin([r.id for r in day_of(12, 510).tail(12)])))
    table.replace(day_of(20, 10))
    assert opened[0] == 1 and opened[1] <= 1
    assert table.read().count() == 12 * 500 + 20
    with pytest.raises(ValueError, match="another day"):
        table.replace(day_of(3, 10).withColumn("day", F.lit(date(2026, 1, 25))))


def test_the_keys_of_a_large_load_are_not_broadcast(spark, table, monkeypatch):
    """Their file is small, as they compress well; the driver would hold each of them."""
    joined = []
    holding = VersionedTable._holding

    def held(self, entries, known):
        stored = self._rows(entries).select("id")
        joined.append((scanned(stored.join(known, "id", "left_semi")), scanned(stored.join(known, "id", "left_anti"))))
        return holding(self, entries, known)

    monkeypatch.setattr(VersionedTable, "_holding", held)
    many = spark.range(versions.FEW_KEYS + 1).select("id", F.lit(date(2026, 1, 1)).alias("day"), F.lit("a").alias("value"))
    table.replace(many)
    table.replace(many.withColumn("value", F.lit("b")))
    table.replace(many.limit(3))
    assert all("SortMergeJoin" in plan and "BroadcastExchange" not in plan for plan in joined[0])
    assert all("BroadcastExchange" in plan for plan in joined[1])
    counts = {r["value"]: r["count"] for r in table.read().groupBy("value").count().collect()}
    assert counts == {"a": 3, "b": versions.FEW_KEYS - 2}


def test_the_plan_of_an_index_does_not_grow_with_the_folders(spark, table):
    def plan(folders):
        made = [Row(folder=f"day=2026-01-{i:05d}", bits=32) for i in range(folders)]
        keyed = spark.createDataFrame([(e.folder, (i,)) for i, e in enumerate(made)], "folder string, key struct<id:bigint>")
        words = table._filters(keyed, made)
        assert words.select("folder").distinct().count() == folders
        return scanned(words)

    assert len(plan(400)) < len(plan(4)) + 400


def test_partition_filters_reach_the_scan(spark, table):
    table.replace(frame(spark, *[(d, d, "a") for d in range(1, 8)]))
    few = table.read().where(F.col("day") >= F.lit(date(2026, 1, 6)))
    assert "PartitionFilters: [isnotnull(day" in scanned(few)
    assert bag(few) == [(6, 6, "a"), (7, 7, "a")]


def test_filter_has_no_false_absence():
    assert versions._filter_bits(1) == 32 and versions._filter_bits(1000) == 32768
