"""Wall-clock text, zone offsets and calendar parts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Minutes to add to wall time to reach UTC, by abbreviation.
UTC_OFFSET_MINUTES = {
    "NDT": 150,
    "NST": 210,
    "ADT": 180,
    "AST": 240,
    "EDT": 240,
    "EST": 300,
    "CDT": 300,
    "CST": 360,
    "MDT": 360,
    "MST": 420,
    "PDT": 420,
    "PST": 480,
}

LOCAL_ZONE = "America/Vancouver"


def local_to_utc(
    text: Column,
    offsets: Mapping[str, int] = UTC_OFFSET_MINUTES,
    strict: bool = False,
) -> Column:
    """`2026-06-16 13:20 PDT` to a UTC timestamp.

    The abbreviation already says whether daylight time holds, so each one has a
    fixed offset; an unknown one counts as UTC. Malformed text gives null, or
    fails the job when `strict`.
    """
    head = F.substring(text, 1, 16)
    wall = head.cast("timestamp_ntz") if strict else head.try_cast("timestamp_ntz")
    zone = F.right(F.trim(text), F.lit(3))
    table = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])
    shift = F.coalesce(F.try_element_at(table, zone), F.lit(0))
    moved = F.timestamp_add("MINUTE", shift, wall)
    return moved.cast("timestamp")


def to_local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """UTC timestamp to one that reads as wall time of `zone` in a UTC session."""
    return F.from_utc_timestamp(ts, zone)


def local_parts(ts: Column, zone: str = LOCAL_ZONE) -> dict[str, Column]:
    """Calendar parts of a UTC timestamp in `zone` (P7); Sunday is day 0."""
    wall = to_local(ts, zone)
    return {
        "local_hour_pt": F.hour(wall),
        "local_dow_pt": F.dayofweek(wall) - 1,
        "local_month_pt": F.month(wall),
        "local_year_pt": F.year(wall),
    }


def is_weekend(dow: Column) -> Column:
    """Saturday or Sunday."""
    return dow.isin(0, 6)


def season(month: Column) -> Column:
    """Meteorological season of a month number (P20)."""
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer")
        .otherwise("autumn")
    )


def minutes_between(later: Column, earlier: Column) -> Column:
    """Elapsed minutes as a double, negative if `later` comes first."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(60_000_000.0)


def lag_minutes(later: Column, earlier: Column) -> Column:
    """Elapsed minutes rounded half away from zero to an int."""
    return F.round(minutes_between(later, earlier)).cast("int")


def parse_message_time(text: Column) -> Column:
    """`2026-06-16 20:15:03.123456789 +0000 UTC` to microseconds.

    Everything from the first ` +` on is dropped and the fraction cut to six
    digits; text of any other shape gives null.
    """
    head = F.substring_index(text, " +", 1)
    shaped = head.rlike(r"\A\d{4}-\d{2}-\d{2} \d{2}:\d{2}(:\d{2}(\.\d+)?)?\z")
    # Up to six digits of the fraction end at character 26.
    return F.when(shaped, F.substring(head, 1, 26).try_cast("timestamp_ntz").cast("timestamp"))


def eta_text(parts: Column) -> Column:
    """Map of Month/Day/Hour/Minute to `MM-DD HH:MM`.

    Missing parts count as zero; a missing or empty map gives null.
    """
    pieces = [F.coalesce(parts[name], F.lit(0)) for name in ("Month", "Day", "Hour", "Minute")]
    return F.when(F.cardinality(parts) > 0, F.format_string("%02d-%02d %02d:%02d", *pieces))


def age_tier(age_minutes: Column) -> Column:
    """Data-age tier on whole minutes: alert over 180, warn over 45."""
    whole = age_minutes.cast("long")
    return F.when(whole > 180, "alert").when(whole > 45, "warn").otherwise("")


def age_label(age_minutes: Column) -> Column:
    """`37 min old` below an hour, else `5h 07m old`."""
    whole = age_minutes.cast("long")
    hours = F.floor(whole / 60).cast("long")
    return F.when(whole < 60, F.format_string("%d min old", whole)).otherwise(
        F.format_string("%dh %02dm old", hours, whole - hours * 60)
    )
