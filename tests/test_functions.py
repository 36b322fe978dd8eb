from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowmart.functions import delay, exact, keys, places, text, timez, vessel

DELAYS = {
    None: (None, "unknown"),
    "": (None, "unknown"),
    "No Delay": (0, "reported"),
    " no delay ": (0, "reported"),
    "15": (15, "reported"),
    " 15 ": (15, "reported"),
    "15\n": (None, "unknown"),
    "15 minutes": (15, "reported"),
    "1 minute": (1, "reported"),
    " 15 minutes": (None, "unknown"),
    "15 Minutes": (None, "unknown"),
    "2 hours": (120, "reported"),
    "1 hour 30 minutes": (60, "reported"),
    "99999999999": (None, "reported"),
    "99999999999 minutes": (None, "reported"),
    "99999999 hours": (None, "reported"),
    "-5": (None, "unknown"),
    "Not Applicable": (None, "not_applicable"),
    "not applicable ": (None, "not_applicable"),
    " -- ": (None, "not_reported"),
    "Missed entry": (None, "missed_entry"),
    "Temporarily closed": (None, "closed"),
    "CLOSED": (None, "closed"),
    "weird": (None, "unknown"),
    "15minutes": (None, "unknown"),
}


def test_delay_text(values):
    texts = list(DELAYS)
    assert values(delay.parse_delay_minutes, texts) == [DELAYS[t][0] for t in texts]
    assert values(delay.delay_status, texts) == [DELAYS[t][1] for t in texts]


def test_with_delay_equals_the_functions(spark):
    df = spark.createDataFrame([(t,) for t in DELAYS], "x string")
    both = delay.with_delay(df, "x")
    assert both.columns == ["x", "delay_minutes", "delay_status"]
    assert {r.x: (r.delay_minutes, r.delay_status) for r in both.collect()} == DELAYS


def test_bands(values):
    minutes = [None, 0, 1, 15, 16, 30, 31, 60, 61]
    assert values(delay.congestion_band, minutes, "int") == [
        None, "clear", "light", "light", "moderate", "moderate", "heavy", "heavy", "severe",
    ]
    assert values(delay.delay_tone, [None, 0, 1, 29, 30], "int") == ["", "", "warn", "warn", "alert"]
    assert values(delay.share_tone, [None, 0.49, 0.5, 0.7], "double") == ["", "", "warn", "alert"]


@pytest.mark.parametrize(
    ("zone", "hour", "minute"),
    [("PST", 8, 0), ("PDT", 7, 0), ("MST", 7, 0), ("MDT", 6, 0), ("CST", 6, 0), ("CDT", 5, 0),
     ("EST", 5, 0), ("EDT", 4, 0), ("AST", 4, 0), ("ADT", 3, 0), ("NST", 3, 30), ("NDT", 2, 30),
     ("XXX", 0, 0)],
)
def test_zone_offsets(values, zone, hour, minute):
    got = values(timez.local_to_utc, [f"2026-01-05 00:00 {zone}"])
    assert got == [datetime(2026, 1, 5, hour, minute)]


def test_local_to_utc_edges(values):
    texts = [None, "", "soon PDT", "2015-12-31 19:00 PST", "2026-06-16 13:20 PDT ", "2026-13-01 00:00 PST"]
    assert values(timez.local_to_utc, texts) == [
        None, None, None, datetime(2016, 1, 1, 3), datetime(2026, 6, 16, 20, 20), None,
    ]


def test_local_to_utc_takes_other_offsets(values):
    got = values(lambda c: timez.local_to_utc(c, {"NST": 30}), ["2026-01-05 00:00 NST"])
    assert got == [datetime(2026, 1, 5, 0, 30)]


def test_strict_time_fails_the_job(values):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(lambda c: timez.local_to_utc(c, strict=True), ["soon PDT"])


def test_local_parts_across_year_and_daylight_time(spark):
    times = ["2016-01-01 03:00:00", "2026-03-08 09:59:00", "2026-03-08 10:00:00", "2026-11-01 09:30:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(
        F.col("t").cast("timestamp").alias("t")
    )
    parts = timez.local_parts(df.t)
    rows = df.orderBy("t").select(*[c.alias(n) for n, c in parts.items()]).collect()
    assert [tuple(r) for r in rows] == [
        (19, 4, 12, 2015), (1, 0, 3, 2026), (3, 0, 3, 2026), (1, 0, 11, 2026),
    ]


def test_calendar_words(values):
    assert values(timez.season, list(range(1, 13)), "int") == (
        ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["autumn"] * 3 + ["winter"]
    )
    assert values(timez.is_weekend, list(range(7)), "int") == [True] + [False] * 5 + [True]


def test_lag_rounds_half_away_from_zero(spark):
    base = datetime(2026, 1, 1, 12)
    rows = [
        (0, base, datetime(2026, 1, 1, 11, 58, 30)),
        (1, base, datetime(2026, 1, 1, 12, 1, 30)),
        (2, base, datetime(2026, 1, 1, 11, 59, 31)),
        (3, base, None),
    ]
    df = spark.createDataFrame(rows, "i int, a timestamp, b timestamp")
    got = {r.i: r.lag for r in df.select("i", timez.lag_minutes(df.a, df.b).alias("lag")).collect()}
    assert got == {0: 2, 1: -2, 2: 0, 3: None}


def test_message_time(values):
    texts = [
        "2026-06-16 20:15:03.123456789 +0000 UTC", "2026-06-16 20:15:03 +0000 UTC",
        "2026-06-16 20:15:03.5 +0000 UTC", "2026-06-16 20:15:03.5", "2026-06-16 20:15:03 -0400 X",
        "bad", "", None, "2026-06-16T20:15:03", "2026-99-16 20:15:03 +0000 UTC",
    ]
    at = datetime(2026, 6, 16, 20, 15, 3)
    half = at.replace(microsecond=500000)
    assert values(timez.parse_message_time, texts) == [
        at.replace(microsecond=123456), at, half, half, None, None, None, None, None, None,
    ]


def test_age_words(values):
    ages = [0.0, 45.9, 46.0, 59.99, 60.0, 180.5, 181.0, 307.0, None]
    assert values(timez.age_tier, ages, "double") == ["", "", "warn", "warn", "warn", "warn", "alert", "alert", ""]
    assert values(timez.age_label, ages, "double")[:8] == [
        "0 min old", "45 min old", "46 min old", "59 min old", "1h 00m old", "3h 00m old",
        "3h 01m old", "5h 07m old",
    ]


def test_vessel_words(values):
    assert values(vessel.nav_status_desc, [0, 1, 5, 8, 9, 15, None], "int") == [
        "under_way_engine", "at_anchor", "moored", "under_way_sailing", "other", "undefined", "other",
    ]
    types = [None, 0, 29, 30, 39, 40, 50, 59, 60, 69, 70, 79, 80, 89, 90]
    assert values(vessel.vessel_category, types, "int") == [
        "unknown", "other", "other", "fishing_special", "fishing_special", "other", "service",
        "service", "passenger", "passenger", "cargo", "cargo", "tanker", "tanker", "other",
    ]


def test_holding_flags(spark):
    cases = [(1, None, True, False), (5, 0.5, True, True), (0, 0.49, True, False),
             (0, 0.5, False, False), (None, None, False, False), (None, 0.1, True, False),
             (1, 0.1, True, False)]
    df = spark.createDataFrame(cases, "code int, sog double, still boolean, clash boolean")
    wrong = df.where(
        (vessel.is_stationary(df.code, df.sog) != df.still)
        | (vessel.status_speed_conflict(df.code, df.sog) != df.clash)
    )
    assert wrong.count() == 0


def test_display_defaults(values):
    assert values(vessel.marker_radius, [None, 10, 100, 900], "int") == [192.0, 96.0, 160.0, 640.0]
    assert values(vessel.display_speed, [None, 0.25, 0.35, 1.04], "double") == [0.0, 0.2, 0.4, 1.0]
    assert values(text.title_label, ["prince_rupert"]) == ["Prince Rupert"]


def test_places(values):
    spots = ["Surrey, BC/Blaine, WA", "Nowhere", "", None, "A, NL /B, ME"]
    assert values(places.canada_province, spots) == ["BC", "", "", None, "NL"]
    assert values(places.us_state, spots) == ["WA", "", "", None, "ME"]
    provinces = ["BC", "ON", "QC", "NB", "NS", "PE", "NL", "MB", "", None]
    assert values(places.region_group, provinces) == [
        "pacific", "ontario", "quebec", "atlantic", "atlantic", "atlantic", "atlantic",
        "prairie", "prairie", "prairie",
    ]


def test_port_boxes(spark):
    points = [
        (48.95, -123.65, "vancouver"), (49.45, -122.85, "vancouver"), (49.46, -122.85, None),
        (54.05, -130.6, "prince_rupert"), (54.2, -130.14, None), (None, -123.0, None),
    ]
    df = spark.createDataFrame(points, "lat double, lon double, want string")
    assert df.where(~places.port_region(df.lat, df.lon).eqNullSafe(df.want)).count() == 0
    overlap = (("first", 0, 0, 9, 9), ("second", 0, 0, 9, 9))
    one = spark.createDataFrame([(1.0, 1.0)], "lat double, lon double")
    assert one.select(places.port_region(one.lat, one.lon, overlap)).first()[0] == "first"


def test_text_rules(values):
    odd = [" \t x y \n", " x ", "", "   ", None]
    assert values(text.strip_space, odd) == ["x y", "x", "", "", None]
    assert values(text.strip_to_null, odd) == ["x y", "x", None, None, None]
    assert values(text.blank_to_null, [" x ", "  ", "\t"]) == ["x", None, "\t"]


def test_keys(spark):
    import hashlib

    df = spark.createDataFrame([("a", None, 3)], "a string, b string, c int")
    row = df.select(
        keys.surrogate_key(df.a, df.b, df.c).alias("s"),
        keys.composite_key(df.c, df.a).alias("k"),
        keys.composite_key(df.c, df.b).alias("n"),
    ).first()
    expected = f"a-{keys.NULL_KEY_TEXT}-3"
    assert row.s == hashlib.md5(expected.encode()).hexdigest()
    assert (row.k, row.n) == ("3-a", None)


def test_exact_ratio(spark):
    cases = [(1, 3, 4, 0.3333), (1, 8, 2, 0.13), (5, 1000, 2, 0.01), (7, 7, 3, 1.0), (0, 5, 2, 0.0)]
    for num, den, places_, want in cases:
        got = spark.range(1).select(exact.round_ratio(F.lit(num), F.lit(den), places_)).first()[0]
        assert got == want
    assert spark.range(1).select(exact.round_ratio(F.lit(1), F.lit(0), 2)).first()[0] is None
