from __future__ import annotations

import bz2
import gzip
import os
from datetime import datetime

import pytest
from pyspark.sql import DataFrame, functions as F

from flowmart.functions import vessel
from flowmart.plans import collect, warehouse
from flowmart.session import RUNTIME_SETTINGS, Scratch
from flowmart.sources import ais, archive, border_feed, files
from flowmart.sources.files import EmptyLoad
from flowmart.sources.tables import Warehouse
from flowmart.sources.versions import VersionedTable

HEADER = "﻿Customs Office ;; Location ;; Last updated ;; a ;; b ;; c ;; d\r\n"
GOOD = "Pacific Highway ;; Surrey, BC/Blaine, WA ;; 2026-06-16 13:20 PDT ;; 15 minutes ;; Not Applicable ;; No Delay ;; --"


def land(folder, name, body):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_bytes(body.encode("utf-8"))
    return str(path)


# --- live feed ---------------------------------------------------------------


def test_feed_cases(spark, tmp_path):
    body = (
        HEADER + GOOD + "\r\n\r\n" + "six;;cells;;only;;a;;b;;c\n"
        + ' eight ;; "q" ;;t;;1;;2;;3;;4;;extra\n' + " pad ;;;;;;;;;;;;x last;;l;;u;;1;;2;;3;;4"
    )
    path = land(tmp_path / "feed", "one.csv", body)
    got = border_feed.load_border_feed(spark, path).orderBy("observation_id")
    rows = [tuple(r) for r in got.select(*border_feed.FEED_COLUMNS).collect()]
    assert rows == [
        ("Pacific Highway", "Surrey, BC/Blaine, WA", "2026-06-16 13:20 PDT", "15 minutes",
         "Not Applicable", "No Delay", "--"),
        ("eight", '"q"', "t", "1", "2", "3", "4"),
        ("pad", "", "", "", "", "", "x"),
        ("last", "l", "u", "1", "2", "3", "4"),
    ]
    assert got.select("observation_id").distinct().count() == 4


def test_feed_ids_are_stable_and_distinct_across_files(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        land(tmp_path / "feed", name, HEADER + GOOD + "\n" + GOOD)
    first = {r[0] for r in border_feed.load_border_feed(spark, str(tmp_path / "feed")).select("observation_id").collect()}
    again = {r[0] for r in border_feed.load_border_feed(spark, str(tmp_path / "feed")).select("observation_id").collect()}
    assert len(first) == 4 and first == again


@pytest.mark.parametrize("body", ["Port;;Month\nx;;y", "\n\n", GOOD])
def test_wrong_header_fails_or_is_left_out(spark, tmp_path, body):
    path = land(tmp_path / "feed", "bad.csv", body)
    with pytest.raises(Exception, match="no feed header"):
        border_feed.load_border_feed(spark, path).collect()
    assert border_feed.load_border_feed(spark, path, strict=False).count() == 0


def test_append_fetch(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    at = datetime(2026, 6, 16, 20, 30)
    path = land(tmp_path / "feed", "one.csv", HEADER + GOOD + "\nshort;;line")
    assert collect.collect_border(house, path, fetched_at=at) == {"rows": 1, "malformed": 1}
    stored = house.read("raw", "border_raw")
    assert [r.fetched_at for r in stored.collect()] == [at]
    with pytest.raises(EmptyLoad):
        collect.collect_border(house, land(tmp_path / "none", "h.csv", HEADER), fetched_at=at)
    with pytest.raises(EmptyLoad, match="is empty"):
        collect.collect_border(house, land(tmp_path / "void", "e.csv", ""), fetched_at=at)
    assert house.read("raw", "border_raw").count() == 1
    assert collect.collect_border(house, path, fetched_at=at) == {"rows": 0, "malformed": 0}


def test_collecting_fetches_no_names_and_reads_new_files_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(DataFrame, "inputFiles", lambda _: pytest.fail("names fetched one by one"))
    read, scans = border_feed.read_feed_files, []
    monkeypatch.setattr(border_feed, "read_feed_files", lambda *a, **k: scans.append(a[1:]) or read(*a, **k))
    feed, table, ledger = tmp_path / "feed", str(tmp_path / "table"), str(tmp_path / "ledger")
    for k in range(3):
        os.utime(land(feed / "early", f"{k} +%41.txt", HEADER + GOOD), (1_700_000_000 + k, 1_700_000_000 + k))
    assert border_feed.append_fetch(spark, table, ledger, str(feed)) == {"rows": 3, "malformed": 0}
    # One that landed before files collected already is new as well.
    os.utime(land(feed / "late", "3.txt", HEADER + GOOD + "\r\n" + GOOD), (1_600_000_000, 1_600_000_000))
    assert border_feed.append_fetch(spark, table, ledger, str(feed)) == {"rows": 2, "malformed": 0}
    assert border_feed.append_fetch(spark, table, ledger, str(feed)) == {"rows": 0, "malformed": 0}
    assert scans == [(str(feed),)] * 2
    assert VersionedTable(spark, table).read().count() == 5



def test_fetches_are_read_as_the_text_source_reads_them(spark, tmp_path):
    land(tmp_path / "feed", "a +%41.txt", HEADER + GOOD)
    (tmp_path / "feed" / "odd.csv").write_bytes(b"\xff\x00a\r\nb\xfe")
    for name, pack in (("z.txt.gz", gzip.compress), ("z.bz2", bz2.compress)):
        (tmp_path / "feed" / name).write_bytes(pack((HEADER + GOOD).encode()))
    name, at = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    want = spark.read.text(str(tmp_path / "feed"), wholetext=True).select(name, at, F.hex("value"))
    got = border_feed.read_feed_files(spark, str(tmp_path / "feed")).select("source_file", "landed_at", F.hex("body"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() == 4
    table, ledger = str(tmp_path / "table"), str(tmp_path / "ledger")
    (tmp_path / "feed" / "odd.csv").unlink()
    for counts in ({"rows": 3, "malformed": 0}, {"rows": 0, "malformed": 0}):
        assert border_feed.append_fetch(spark, table, ledger, str(tmp_path / "feed")) == counts


def test_small_fetches_share_tasks_and_are_cut_into_lines_once(spark, tmp_path, monkeypatch):
    for k in range(60):
        land(tmp_path / "feed", f"{k}.txt", HEADER + GOOD)
    pinned, pin, listed = {}, Scratch.pin, []
    monkeypatch.setattr(Scratch, "pin", lambda self, df, label: pinned.setdefault(label, df) and pin(self, df, label))
    scanned = files.scanned_files
    monkeypatch.setattr(border_feed, "scanned_files", lambda *a, **k: listed.append(1) or scanned(*a, **k))
    # Without a bound on their number Spark gives each of these files a task.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        got = border_feed.append_fetch(spark, str(tmp_path / "table"), str(tmp_path / "ledger"), str(tmp_path / "feed"))
        tasks = {label: pinned[label].rdd.getNumPartitions() for label in ("landed", "feed")}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", RUNTIME_SETTINGS["spark.sql.files.maxPartitionBytes"])
    assert got == {"rows": 60, "malformed": 0} and listed == [1]
    assert max(tasks.values()) <= spark.sparkContext.defaultParallelism < 60
    plan = pinned["feed"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\A\x{FEFF}+") == 1
    assert "binaryFile" in str(pinned["feed"]._jdf.queryExecution().executedPlan()) and "Join" not in plan


def test_collecting_a_growing_folder(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    folder = tmp_path / "feed"
    with pytest.raises(EmptyLoad):
        collect.collect_border(house, land(tmp_path / "none", "h.csv", HEADER))
    assert house.find("raw", "border_raw") is None
    land(folder, "one.csv", HEADER + GOOD)
    assert collect.collect_border(house, str(folder))["rows"] == 1
    land(folder, "two.csv", HEADER + GOOD + "\n" + GOOD)
    assert collect.collect_border(house, str(folder))["rows"] == 2
    assert collect.collect_border(house, str(folder))["rows"] == 0
    stored = house.read("raw", "border_raw")
    assert stored.count() == stored.select("observation_id").distinct().count() == 3
    assert stored.where("day = to_date(fetched_at)").count() == 3
    warehouse.build_border(house, stored.drop("day"))
    warehouse.check_marts(house)


# --- archive -----------------------------------------------------------------

ARCHIVE = (
    "﻿Customs Office,Location,Updated,Commercial Flow,Travellers Flow\r\n"
    'A ,"Surrey, BC/Blaine, WA",2015-01-02 14:51 PST,No delay,15\r\n'
    '"B\nx",l,u,c\r\n'
    'C,l,u,,"",extra\r\n'
    "\r\n"
    ",l,u,1,2\r\n"
    '"D, ""q""",l,u,Closed,\r\n'
)
OTHER = "Port of Entry,Month,Fiscal Year,Percentage Met Service Standard,x\na,b,c,d,e\n"
SIX = "Customs Office,Loc,x,y,z,Location Updated\na,b,c,d,e,f\ng,h,i,j,k\n"


def archive_rows(df):
    return sorted(
        (tuple(r) for r in df.select("source_file", *archive.ARCHIVE_COLUMNS).collect()), key=repr
    )


def test_archive_cases(spark, tmp_path):
    folder = tmp_path / "csv"
    paths = [land(folder, "bwt-2016.csv", ARCHIVE), land(folder, "std.csv", OTHER), land(folder, "six-2017.csv", SIX)]
    got = archive.load_archive(spark, paths)
    assert archive_rows(got) == [
        ("bwt-2016.csv", "A", "Surrey, BC/Blaine, WA", "2015-01-02 14:51 PST", "No delay", "15"),
        ("bwt-2016.csv", "C", "l", "u", None, None),
        ("bwt-2016.csv", 'D, "q"', "l", "u", "Closed", None),
        ("six-2017.csv", "a", "b", "c", "d", "e"),
        ("six-2017.csv", "g", "h", "i", "j", "k"),
    ]
    kept = archive.archive_quarantine(spark, paths)
    assert archive_rows(kept) == [("bwt-2016.csv", None, "l", "u", "1", "2")]
    ids = {r[0] for r in got.select("historical_id").collect()}
    assert len(ids) == 5
    assert ids == {r[0] for r in archive.load_archive(spark, paths[::-1]).select("historical_id").collect()}


def test_an_unclosed_quote_takes_the_rest_of_its_file_only(spark, tmp_path):
    odd = ARCHIVE + 'E,l,u,"open,1\nF,l,u,1,2\n'
    got = archive_rows(archive.load_archive(spark, [land(tmp_path, "odd.csv", odd), land(tmp_path, "six.csv", SIX)]))
    assert [r[:2] for r in got] == [
        ("odd.csv", "A"), ("odd.csv", "C"), ("odd.csv", 'D, "q"'), ("six.csv", "a"), ("six.csv", "g"),
    ]


def test_header_must_come_first(spark, tmp_path):
    late = "x,y,z,1,2\n" + ARCHIVE.lstrip("﻿")
    assert archive.load_archive(spark, [land(tmp_path, "late.csv", late)]).count() == 0


def test_manifest(spark):
    urls = [
        "https://x/bwt-2016-q1.csv", "https://x/2019/bwt-2018.CSV ", "https://x/bwt-2016-FRA.csv",
        "https://x/bwt-2017-fr.csv", "https://x/readme.txt", "https://x/combined.csv", None,
    ]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [tuple(r) for r in archive.archive_manifest(df).collect()]
    assert got == [
        ("https://x/combined.csv", None, "combined.csv"),
        ("https://x/bwt-2016-q1.csv", 2016, "bwt-2016-q1.csv"),
        ("https://x/2019/bwt-2018.CSV", 2018, "bwt-2018.CSV"),
    ]
    assert [r.year for r in archive.archive_manifest(df, 2017, 2018).collect()] == [2018]


def test_backfill_records_files_once(spark, tmp_path):
    folder, path = tmp_path / "csv", str(tmp_path / "hist")
    table = archive.archive_table(spark, path)

    def manifest():
        rows = [(str(p),) for p in sorted(folder.iterdir())]
        return archive.archive_manifest(spark.createDataFrame(rows, "url string"))

    land(folder, "bwt-2016.csv", ARCHIVE)
    land(folder, "std-2016.csv", OTHER)
    first = archive.backfill(spark, manifest(), path)
    assert [(r.source_file, r.row_count) for r in first.collect()] == [("bwt-2016.csv", 3)]
    land(folder, "six-2017.csv", SIX)
    second = archive.backfill(spark, manifest(), path)
    assert [(r.source_file, r.row_count) for r in second.collect()] == [("six-2017.csv", 2)]
    assert table.read().count() == 5
    land(folder, "void-2018.csv", "")
    land(folder, "more-2019.csv", ARCHIVE)
    with pytest.raises(EmptyLoad, match="void-2018.csv is empty"), pytest.warns(UserWarning, match="std-2016.csv"):
        archive.backfill(spark, manifest(), path)
    assert table.read().count() == 8
    with pytest.raises(EmptyLoad):
        archive.backfill(spark, manifest(), path)
    assert table.read().count() == 8
    land(folder / "again", "new-2020.csv", ARCHIVE)
    twice = [(str(folder / "again" / "new-2020.csv"),), (str(folder / "new-2020.csv"),)]
    with pytest.raises(ValueError, match="2 pending files are called new-2020.csv"):
        archive.backfill(spark, archive.archive_manifest(spark.createDataFrame(twice, "url string")), path)


def test_files_of_one_name_are_kept_apart(spark, tmp_path):
    paths = [land(tmp_path / part, "bwt-2016.csv", ARCHIVE) for part in ("a", "b")]
    got = archive.load_archive(spark, paths)
    assert got.count() == 6
    assert got.select("historical_id").distinct().count() == 6
    assert "Customs Office" not in {r.customs_office for r in got.collect()}


def test_quoted_line_breaks_across_blocks(spark, tmp_path):
    head = "Customs Office,Location,Updated,Commercial Flow,Travellers Flow\n"
    body = "".join(
        f'"Office\n{i}, ""x""\n",l,u,"two\n\nlines",{i}\n' if i % 3 else f"Office {i},l,u,c,{i}\n\n" for i in range(60)
    )
    path = land(tmp_path, "q.csv", head + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        rows = {r.travellers_flow: r for r in archive.load_archive(spark, [path]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert set(rows) == {str(i) for i in range(60)}
    assert rows["4"].customs_office == 'Office\n4, "x"' and rows["4"].commercial_flow == "two\n\nlines"
    assert rows["3"].customs_office == "Office 3"


def test_a_file_is_loaded_as_a_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    folder, path = tmp_path / "csv", str(tmp_path / "hist")
    manifest = archive.archive_manifest(spark.createDataFrame([(land(folder, "bwt 2016=a%.csv", ARCHIVE),)], "url string"))

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(VersionedTable, "_commit", lost)
    with pytest.raises(OSError, match="lost"):
        archive.backfill(spark, manifest, path)
    monkeypatch.undo()
    table = archive.archive_table(spark, path)
    assert table.read() is None and archive.load_ledger(table).count() == 0
    assert [r.row_count for r in archive.backfill(spark, manifest, path).collect()] == [3]
    assert archive.backfill(spark, manifest, path).count() == 0
    assert [r.source_file for r in archive.load_ledger(table).collect()] == ["bwt 2016=a%.csv"]


def test_two_loaders_of_one_manifest_load_each_file_once(spark, tmp_path, monkeypatch):
    folder, path = tmp_path / "csv", str(tmp_path / "hist")
    header_only = ARCHIVE.split("\r\n")[0] + "\r\n"
    urls = [(land(folder, "a-2016.csv", ARCHIVE),), (land(folder, "b-2017.csv", SIX),), (land(folder, "c-2018.csv", header_only),)]
    every = archive.archive_manifest(spark.createDataFrame(urls, "url string"))
    commit, others = VersionedTable._commit, []

    def slow(self, number, entries):
        if not others:
            others.append(None)
            others.append(archive.backfill(spark, every.where("year <= 2016"), path).count())
        return commit(self, number, entries)

    monkeypatch.setattr(VersionedTable, "_commit", slow)
    mine = archive.backfill(spark, every, path)
    assert others[1] == 1
    assert sorted((r.source_file, r.row_count) for r in mine.collect()) == [("b-2017.csv", 2), ("c-2018.csv", 0)]
    table = archive.archive_table(spark, path)
    assert sorted((r.source_file, r.row_count) for r in archive.load_ledger(table).collect()) == [
        ("a-2016.csv", 3), ("b-2017.csv", 2), ("c-2018.csv", 0),
    ]
    assert table.read().count() == 5


# --- vessel messages ---------------------------------------------------------


def position(mmsi, body="", meta=""):
    return (
        f'{{"MessageType":"PositionReport","MetaData":{{"MMSI":{mmsi}{meta}}},'
        f'"Message":{{"PositionReport":{{{body}}}}}}}'
    )


def static(mmsi, body):
    return (
        f'{{"MessageType":"ShipStaticData","MetaData":{{"MMSI":{mmsi}}},'
        f'"Message":{{"ShipStaticData":{{{body}}}}}}}'
    )


SPOT = '"Latitude":49.29,"Longitude":-123.1'
META_SPOT = ',"latitude":49.45,"longitude":-122.85'
MESSAGES = [
    position(1, SPOT + ',"Sog":0.1,"Cog":12.5,"TrueHeading":90,"NavigationalStatus":1',
             ',"ShipName":"ABC  ","time_utc":"2026-06-16 20:15:03.123456789 +0000 UTC"'),
    position(2, '"Sog":1', META_SPOT + ',"ShipName":"  "'),
    position(3, '"Latitude":null,"Longitude":-123.0', META_SPOT),
    position(4, '"Sog":1'),
    position(5, '"Latitude":10.0,"Longitude":10.0'),
    position(1, SPOT + ',"Sog":7.5', ',"time_utc":"broken"'),
    position("null", SPOT),
    '{"MessageType":"Other","MetaData":{"MMSI":9}}',
    "{broken",
    static(1, '"Name":"ABC ","Type":71,"ImoNumber":9000001,"CallSign":" ","Destination":"CAVAN",'
              '"Dimension":{"A":200,"B":30,"C":16,"D":16},"Eta":{"Month":6,"Day":17,"Hour":4,"Minute":0},'
              '"MaximumStaticDraught":11.2'),
    static(6, '"Eta":{}'),
    static(7, '"Eta":{"Month":6}'),
]


def lines(spark, messages, start=datetime(2026, 6, 16, 20, 15)):
    rows = [(m, start, i) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, "value string, received_at timestamp, arrival bigint")


def test_message_cases(spark):
    messages = ais.decode_messages(lines(spark, MESSAGES))
    reports = {(r.mmsi, r.arrival): r for r in ais.position_reports(messages).collect()}
    assert set(reports) == {(1, 0), (2, 1), (1, 5)}
    first = reports[(1, 0)]
    assert (first.ship_name, first.sog, first.true_heading, first.navigational_status) == ("ABC", 0.1, 90, 1)
    assert first.message_ts == datetime(2026, 6, 16, 20, 15, 3, 123456)
    assert (reports[(2, 1)].latitude, reports[(2, 1)].region, reports[(2, 1)].ship_name) == (49.45, "vancouver", None)
    assert reports[(1, 5)].message_ts is None
    static_rows = {r.mmsi: r for r in ais.static_reports(messages).collect()}
    assert static_rows[1].eta_text == "06-17 04:00" and static_rows[1].call_sign is None
    assert (static_rows[1].dim_a, static_rows[1].max_draught) == (200, 11.2)
    assert static_rows[6].eta_text is None and static_rows[7].eta_text == "06-00 00:00"


def test_collect_vessels(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    first, second = datetime(2026, 6, 16, 20, 15), datetime(2026, 6, 16, 20, 30)
    assert collect.collect_vessels(house, lines(spark, MESSAGES), first) == {"positions": 2, "static": 3}
    assert collect.collect_vessels(house, lines(spark, MESSAGES), first) == {"positions": 2, "static": 3}
    more = [static(1, '"Destination":"USSEA"'), static(8, '"Name":"NEW"')]
    assert collect.collect_vessels(house, lines(spark, more), second) == {"positions": 0, "static": 2}
    with pytest.raises(EmptyLoad):
        collect.collect_vessels(house, lines(spark, ["{broken"]), second)
    stored = {r.mmsi: r for r in collect.raw_positions(house).collect()}
    assert {m: r.sog for m, r in stored.items()} == {1: 7.5, 2: 1.0}
    known = {r.mmsi: r for r in collect.raw_static(house).collect()}
    assert set(known) == {1, 6, 7, 8}
    assert (known[1].ship_name, known[1].destination) == ("ABC", "USSEA")
    assert (known[1].first_seen_at, known[1].last_seen_at) == (first, second)
    congestion = warehouse.build_ports(house, collect.raw_positions(house), collect.raw_static(house))
    row = congestion.first()
    assert (row.vessels_total, row.vessels_cargo, row.vessels_unknown_category) == (2, 1, 1)
    assert set(vessel.VESSEL_CATEGORIES) >= {
        r.vessel_category for r in house.read("analytics_marts", "dim_vessels").collect()
    }


def test_loosely_typed_messages_are_kept(spark):
    loose = [
        position('"3"', SPOT + ',"TrueHeading":90.0,"NavigationalStatus":"1"'),
        position("4.0", '"Latitude":"49.29","Longitude":"-123.1","Sog":"x","TrueHeading":90.5'),
        position(5, SPOT + ',"Sog":{"a":1}'),
        '{"MessageType":"PositionReport","MetaData":{"MMSI":6},"Message":{"PositionReport":{"Latitude":49.29,"Longitude":-123.1',
        position("null", SPOT),
        "[1]",
        static(7, '"Type":"71","Dimension":{"A":20.0},"Eta":{"Month":"6","Day":17.0}'),
    ]
    messages = ais.decode_messages(lines(spark, loose))
    got = {r.mmsi: r for r in ais.position_reports(messages).collect()}
    assert set(got) == {3, 4, 5}
    assert (got[3].true_heading, got[3].navigational_status) == (90, 1)
    assert (got[4].latitude, got[4].sog, got[4].true_heading) == (49.29, None, None)
    row = ais.static_reports(messages).first()
    assert (row.ship_type, row.dim_a, row.eta_text) == (71, 20, "06-17 00:00")
    rejected = {r.reject: r.lines for r in ais.rejected_messages(lines(spark, loose)).collect()}
    assert rejected["broken"] >= 1 and sum(rejected.values()) == 3


def test_windows_collected_late(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    first, second = datetime(2026, 6, 16, 0, 45), datetime(2026, 6, 16, 1, 0)
    collect.collect_vessels(house, lines(spark, [static(1, '"Name":"NEW"')]), second)
    collect.collect_vessels(house, lines(spark, [static(1, '"Name":"OLD","Type":70'), static(2, '"Name":"B"')]), first)
    known = {r.mmsi: r for r in collect.raw_static(house).collect()}
    assert set(known) == {1, 2}
    assert (known[1].ship_name, known[1].ship_type) == ("NEW", 70)
    assert (known[1].first_seen_at, known[1].last_seen_at) == (first, second)


def test_message_files(spark, tmp_path):
    land(tmp_path / "ais", "a.jsonl", "\n".join(MESSAGES))
    messages = ais.decode_messages(ais.read_message_lines(spark, str(tmp_path / "ais")))
    reports = ais.position_reports(messages)
    assert reports.count() == 3
    assert ais.with_snapshot(reports).where("snapshot_ts <= received_at").count() == 3
