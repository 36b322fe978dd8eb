"""Delay text: minutes, status and the bands built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The words delay cells use, lower case after trimming.
NO_DELAY = "no delay"
NOT_APPLICABLE = "not applicable"
NOT_REPORTED = "--"
MISSED_ENTRY = "missed entry"

# `\z`, not `$`: Java's `$` also matches before a final line break.
_BARE_DIGITS = r"\A[0-9]+\z"
_LEADING_DIGITS = r"\A([0-9]+)"

# Statuses the archive may carry; the live feed never reports a missed entry.
DELAY_STATUSES = ("reported", "not_applicable", "not_reported", "closed", "missed_entry", "unknown")
LIVE_DELAY_STATUSES = ("reported", "not_applicable", "not_reported", "closed", "unknown")


def parse_delay_minutes(text: Column) -> Column:
    """Delay text to whole minutes, null where the text carries no number.

    Bare digits may be padded; `N minute(s)` and `N hour(s)` may not, and are
    case-sensitive. Digits beyond the int range give null.
    """
    return _minutes(text, F.trim(text), F.lower(F.trim(text)))


def delay_status(text: Column) -> Column:
    """Why a delay cell does or does not carry minutes (P5); first match wins."""
    return _status(text, F.trim(text), F.lower(F.trim(text)))


def with_delay(df: DataFrame, text: str) -> DataFrame:
    """Add `delay_minutes` and `delay_status`; the text is trimmed and lowered once."""
    trimmed = df.withColumn("_padded", F.trim(text)).withColumn("_word", F.lower("_padded"))
    shared = F.col(text), F.col("_padded"), F.col("_word")
    return trimmed.withColumns(
        {"delay_minutes": _minutes(*shared), "delay_status": _status(*shared)}
    ).drop("_padded", "_word")


def _minutes(text: Column, padded: Column, word: Column) -> Column:
    leading = F.regexp_extract(text, _LEADING_DIGITS, 1).try_cast("int")
    return (
        F.when(word == NO_DELAY, F.lit(0))
        .when(padded.rlike(_BARE_DIGITS), padded.try_cast("int"))
        .when(text.rlike(r"\A[0-9]+ minute"), leading)
        .when(text.rlike(r"\A[0-9]+ hour"), F.try_multiply(leading, F.lit(60)))
    )


def _status(text: Column, padded: Column, word: Column) -> Column:
    return (
        F.when(text.isNull(), "unknown")
        .when(word == NOT_APPLICABLE, "not_applicable")
        .when(padded == NOT_REPORTED, "not_reported")
        .when(word == MISSED_ENTRY, "missed_entry")
        .when(word.contains("closed"), "closed")
        .when(
            (word == NO_DELAY)
            | padded.rlike(_BARE_DIGITS)
            | text.rlike(r"\A[0-9]+ (minute|hour)"),
            "reported",
        )
        .otherwise("unknown")
    )


def is_measured(status: Column, minutes: Column) -> Column:
    """A reading that carries a genuine measurement (P21); never null."""
    return F.coalesce(status == "reported", F.lit(False)) & minutes.isNotNull()


def congestion_band(minutes: Column) -> Column:
    """Delay minutes to a band, null when unknown."""
    return (
        F.when(minutes.isNull(), F.lit(None).cast("string"))
        .when(minutes == 0, "clear")
        .when(minutes <= 15, "light")
        .when(minutes <= 30, "moderate")
        .when(minutes <= 60, "heavy")
        .otherwise("severe")
    )


def delay_tone(minutes: Column) -> Column:
    """Headline tone: alert from 30 minutes, warn above zero."""
    return F.when(minutes >= 30, "alert").when(minutes > 0, "warn").otherwise("")


def share_tone(share: Column) -> Column:
    """Holding-share tone: alert from 0.7, warn from 0.5; null counts as zero."""
    return F.when(share >= 0.7, "alert").when(share >= 0.5, "warn").otherwise("")
