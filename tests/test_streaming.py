from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowmart.operators.incremental import fold_attributes
from flowmart.operators.latest import latest_per_key
from flowmart.plans import marts, staging
from flowmart.session import scratch_path
from flowmart.sources import ais
from flowmart.streaming import ais as ais_stream, border as border_stream, run, vessel_state
from test_sources import GOOD, HEADER, land, static

START = datetime(2026, 6, 16, 20, 0)
REPORT = (
    "mmsi bigint, region string, sog double, navigational_status int, received_at timestamp, "
    "arrival bigint"
)


def reports(spark, minutes_by_mmsi, first=0):
    rows = [
        (mmsi, "vancouver", float(m), 0, START + timedelta(minutes=m), first + i)
        for i, (mmsi, m) in enumerate(minutes_by_mmsi)
    ]
    return spark.createDataFrame(rows, REPORT)


def test_latest_positions_in_micro_batches_equal_batch(spark, tmp_path):
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts = [[(1, 1), (2, 3), (1, 7)], [(1, 14), (2, 16), (3, 20)], [(2, 31), (1, 33)], [(9, 120)]]
    for part in parts:
        reports(spark, part).coalesce(1).write.mode("append").parquet(landed)
        stream = ais_stream.latest_positions(spark.readStream.schema(REPORT).parquet(landed))
        run.append_available(
            stream.withColumn("start", F.col("window.start")).drop("window"), out, str(tmp_path / "ck")
        )
    got = {(r.start, r.mmsi): r.sog for r in spark.read.parquet(out).collect()}
    everything = ais.with_snapshot(spark.read.parquet(landed))
    batch = latest_per_key(everything, ["snapshot_ts", "mmsi"], ["received_at", "arrival"])
    want = {
        (r.snapshot_ts, r.mmsi): r.sog
        for r in batch.collect()
        if r.snapshot_ts + timedelta(minutes=15) <= START + timedelta(minutes=110)
    }
    assert got == want and len(want) == 6


def test_late_rows_of_all_batches_are_counted(spark, tmp_path):
    """More batches than a query's recent progress keeps, and a restart."""
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    listener = run.LateRows(spark, str(tmp_path / "late"))
    spark.streams.addListener(listener)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for part in ([(1, 1)], [(1, 90)]):
            reports(spark, part).coalesce(1).write.mode("append").parquet(landed)
            query = _available(spark, landed, out, tmp_path)
            assert run.late_rows(listener, query) == 0
        for vessel in range(2, 9):
            reports(spark, [(vessel, 2)]).coalesce(1).write.mode("append").parquet(landed)
        query = _available(spark, landed, out, tmp_path)
        assert len(query.recentProgress) <= 2
        assert run.late_rows(listener, query) == 7
        assert {r["rows"] for r in listener.counts().collect()} == {1}
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert {r.mmsi for r in spark.read.parquet(out).collect()} == {1}


def _available(spark, landed, out, tmp_path):
    source = spark.readStream.schema(REPORT).option("maxFilesPerTrigger", 1).parquet(landed)
    return run.append_available(ais_stream.latest_positions(source).drop("window"), out, str(tmp_path / "ck"))


def test_a_category_that_arrives_counts_from_the_next_window(spark, tmp_path):
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    known = {"rows": [(1, "cargo")]}

    def vessels(session):
        return session.createDataFrame(known["rows"], "mmsi bigint, vessel_category string")

    def available():
        stream = ais_stream.latest_positions(spark.readStream.schema(REPORT).parquet(landed))
        (
            stream.writeStream.foreachBatch(ais_stream.congestion_writer(out, vessels))
            .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
        )

    reports(spark, [(1, 1), (2, 2), (9, 40)]).coalesce(1).write.mode("append").parquet(landed)
    available()
    known["rows"].append((2, "tanker"))
    reports(spark, [(1, 46), (2, 47), (9, 90)]).coalesce(1).write.mode("append").parquet(landed)
    available()
    rows = {int((r.snapshot_ts - START).total_seconds() // 60): r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {0, 30, 45}
    first, last = rows[0], rows[45]
    assert (first.vessels_total, first.vessels_cargo, first.vessels_tanker, first.vessels_unknown_category) == (2, 1, 0, 1)
    assert (last.vessels_total, last.vessels_cargo, last.vessels_tanker, last.vessels_unknown_category) == (2, 1, 1, 0)


VESSEL = "mmsi bigint, at timestamp, seen bigint, ship_name string, ship_type int"

def test_vessel_state_is_read_and_written_once_per_batch():
    calls = []

    class Handle:
        def __init__(self):
            self.rows, self.value = [], None

        def getListState(self, *_):
            return self

        def getValueState(self, *_):
            return type("Folded", (), {"get": lambda _: self.value, "update": lambda _, value: setattr(self, "value", value)})()

        def registerTimer(self, at):
            calls.append(("timer", at))

        def get(self):
            calls.append(("get",))
            return iter(self.rows)

        def put(self, rows):
            calls.append(("put", len(rows)))
            self.rows = rows

        def clear(self):
            self.rows = []

    class Times:
        at = 0

        def getCurrentWatermarkInMs(self):
            return self.at

    handle, times = Handle(), Times()
    state = vessel_state.VesselAttributes(["name"], ["seen"], "", "", 1000)
    state.init(handle)
    rows = [{"_window": w * 1000, "seen": s, "name": f"{w}-{s}" if w % 2 else None} for w in range(50) for s in (2, 1)]
    (one,) = state.handleInputRows((7,), iter(rows), times)
    assert one.asDict() == {"mmsi": 7, "name": "49-2", "first_seen_at": 0, "last_seen_at": 49000}
    assert calls == [("get",), ("put", 50), ("timer", 1)]
    times.at = 30
    assert list(state.handleExpiredTimer((7,), times, None)) == []
    assert calls[3:] == [("get",), ("put", 20), ("timer", 31)]
    assert handle.value == ("29-2", 29000, 0, 29000)
    times.at = 60
    assert list(state.handleExpiredTimer((7,), times, None)) == []
    assert handle.rows == [] and handle.value == ("49-2", 49000, 0, 49000)
    (late,) = state.handleInputRows((7,), iter([{"_window": 5000, "seen": 1, "name": "old"}]), times)
    assert late.asDict() == {"mmsi": 7, "name": "49-2", "first_seen_at": 0, "last_seen_at": 49000}
    assert calls[-1] == ("timer", 61)



@pytest.mark.parametrize("files", [[40], [1] * 40, [3, 17, 20], [39, 1]])
def test_vessel_state_does_not_depend_on_batches(spark, tmp_path, files):
    rnd = random.Random(2)
    rows = []
    for k in range(40):
        window = START + timedelta(minutes=15 * (k // 2 - (k % 5 == 4)))
        rows.append((rnd.randint(1, 4), window, k, rnd.choice([None, "a", "b", "c"]), rnd.choice([None, 1, 2, 3])))
    # Two records of one window, the earlier one last.
    rows += [(1, START + timedelta(hours=9), 101, "late", 7), (1, START + timedelta(hours=9), 100, "early", 8)]
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = 0
    for n in [*files, 2]:
        spark.createDataFrame(rows[at : at + n], VESSEL).coalesce(1).write.mode("append").parquet(landed)
        at += n
    stream = vessel_state.vessel_attributes(
        spark.readStream.schema(VESSEL).option("maxFilesPerTrigger", 1).parquet(landed),
        "at", ["seen"], attributes=["ship_name", "ship_type"], watermark="2 hours",
    )
    query = (
        stream.writeStream.outputMode("update").foreachBatch(vessel_state.change_writer(out))
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    newest = latest_per_key(spark.createDataFrame(rows, VESSEL), ["mmsi", "at"], ["seen"])
    want = fold_attributes(newest, "mmsi", ["ship_name", "ship_type"], ["at"])
    got = vessel_state.newest_attributes(spark, out).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # A batch stores its own vessels only.
    last = spark.read.parquet(out).where("batch > 0").groupBy("batch").count().collect()
    assert all(r["count"] <= 4 for r in last)


def test_stream_congestion_equals_batch(spark, tmp_path):
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    reports(spark, [(1, 0), (2, 3), (1, 7), (3, 16), (1, 17), (9, 200)]).coalesce(1).write.parquet(landed)
    vessels = spark.createDataFrame([(1, "cargo"), (2, "tanker")], "mmsi bigint, vessel_category string")
    stream = ais_stream.port_congestion(
        ais_stream.latest_positions(spark.readStream.schema(REPORT).parquet(landed)), vessels
    )
    run.append_available(stream, out, str(tmp_path / "ck"))
    raw = latest_per_key(
        ais.with_snapshot(spark.read.parquet(landed)), ["snapshot_ts", "mmsi"], ["received_at", "arrival"]
    ).where(F.col("received_at") < START + timedelta(minutes=100))
    missing = {"snapshot_id": "bigint", "ship_name": "string", "latitude": "double",
               "longitude": "double", "cog": "double", "message_ts": "timestamp"}
    raw = raw.withColumns({n: F.lit(None).cast(k) for n, k in missing.items()})
    batch = marts.fct_port_congestion(staging.stg_vessel_positions(raw), vessels)
    got = sorted(map(tuple, spark.read.parquet(out).select(*batch.columns).collect()))
    assert got == sorted(map(tuple, batch.collect())) and len(got) == 2


def test_border_files_stream_once(spark, tmp_path):
    feed, out = tmp_path / "feed", str(tmp_path / "out")

    def drain():
        from flowmart.sources.border_feed import stream_feed_files

        staged = border_stream.staged_waits_from_files(stream_feed_files(spark, str(feed)))
        run.append_available(staged, out, str(tmp_path / "ck"))

    land(feed, "one.csv", HEADER + GOOD)
    land(feed, "bad.csv", "Port;;Month\nx;;y")
    drain()
    land(feed, "two.csv", HEADER + GOOD + "\n" + GOOD)
    drain()
    drain()
    rows = spark.read.parquet(out)
    assert rows.count() == 12
    assert rows.select("wait_observation_key").distinct().count() == 12


def test_replayed_readings_are_dropped(spark, tmp_path):
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = (
        "observation_id bigint, fetched_at timestamp, customs_office string, location string, "
        "last_updated_text string, commercial_canada_bound string, commercial_us_bound string, "
        "travellers_canada_bound string, travellers_us_bound string"
    )
    row = (1, START, "A", "l", "2026-06-16 13:20 PDT", "15", "--", "No Delay", "1 hour")
    for _ in range(2):
        spark.createDataFrame([row], schema).write.mode("append").parquet(landed)
        stream = border_stream.staged_waits(spark.readStream.schema(schema).parquet(landed))
        run.append_available(stream, out, str(tmp_path / "ck"))
    assert spark.read.parquet(out).count() == 4


@pytest.fixture
def static_lines(spark):
    def make(messages, minute):
        rows = [(m, START + timedelta(minutes=minute), i) for i, m in enumerate(messages)]
        return spark.createDataFrame(rows, "value string, received_at timestamp, arrival bigint")

    return make


def test_static_state_over_batches(spark, static_lines):
    path = scratch_path(spark, "state")
    merge = ais_stream.static_merger(path, "snapshot_ts", ["received_at", "arrival"])

    def batch(number, messages, minute):
        reports = ais.static_reports(ais.decode_messages(static_lines(messages, minute)))
        merge(ais.with_snapshot(reports), number)

    assert ais_stream.static_state(spark, path) is None
    batch(0, [static(1, '"Name":"A","Type":70'), static(1, '"Name":"B"')], 0)
    batch(1, [static(1, '"Type":71'), static(2, '"Name":"C"')], 15)
    batch(2, [static(1, '"Type":72'), static(2, '"Name":"C"')], 16)
    state = {r.mmsi: r for r in ais_stream.static_state(spark, path).collect()}
    # Of the first window's records only the last counts, so its type was never seen.
    assert (state[1].ship_name, state[1].ship_type, state[2].ship_name) == ("B", 72, "C")
    assert state[1].first_seen_at == START
    assert state[1].last_seen_at == START + timedelta(minutes=15)


def test_static_state_does_not_depend_on_batches(spark, small):
    from contract.queries import STATIC_HISTORY_COLUMNS, static_history
    from flowmart.operators import incremental
    from flowmart.sources.ais import STATIC_ATTRIBUTES

    reports = static_history(spark, small)
    for name in set(STATIC_ATTRIBUTES) - set(STATIC_HISTORY_COLUMNS):
        reports = reports.withColumn(name, F.lit(None).cast("string"))
    newest = latest_per_key(reports, ["snapshot_ts", "mmsi"], ["seen_at", "event_id"])
    whole = incremental.fold_attributes(newest, "mmsi", STATIC_HISTORY_COLUMNS, ["snapshot_ts"])
    want = sorted(map(tuple, whole.collect()))
    cuts = ["2024-01-01", "2024-01-11 07:00:00", "2024-01-21 13:00:00", "2025-01-01"]
    parts = [
        reports.where((F.col("snapshot_ts") >= F.lit(a).cast("timestamp")) & (F.col("snapshot_ts") < F.lit(b).cast("timestamp")))
        for a, b in zip(cuts, cuts[1:], strict=False)
    ]
    for batches in ([reports], parts, [parts[2], parts[0], parts[1], parts[0]]):
        path = scratch_path(spark, "state")
        merge = ais_stream.static_merger(path, "snapshot_ts", ["seen_at", "event_id"])
        for number, batch in enumerate(batches):
            merge(batch, number)
        state = ais_stream.static_state(spark, path).select(*whole.columns)
        assert sorted(map(tuple, state.collect())) == want
        assert len(ais_stream._versions(spark, path)) <= 2
