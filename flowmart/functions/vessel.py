"""Vessel decoding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Navigational status codes.
NAV_STATUS = {
    0: "under_way_engine",
    1: "at_anchor",
    2: "not_under_command",
    3: "restricted_manoeuvrability",
    4: "constrained_by_draught",
    5: "moored",
    6: "aground",
    7: "engaged_in_fishing",
    8: "under_way_sailing",
    15: "undefined",
}

# Statuses that claim no movement, and the speed that proves it.
HOLDING_STATUSES = (1, 5)
HOLDING_SPEED_KN = 0.5

# Ship type ranges, both ends included.
SHIP_TYPE_RANGES = {
    "fishing_special": (30, 39),
    "service": (50, 59),
    "passenger": (60, 69),
    "cargo": (70, 79),
    "tanker": (80, 89),
}

VESSEL_CATEGORIES = (*SHIP_TYPE_RANGES, "other", "unknown")


def nav_status_desc(code: Column) -> Column:
    """Navigational status word; null and unlisted codes are `other` (P10)."""
    words = F.create_map(*[F.lit(x) for pair in NAV_STATUS.items() for x in pair])
    return F.coalesce(F.try_element_at(words, code.cast("int")), F.lit("other"))


def _claims_holding(code: Column) -> Column:
    return F.coalesce(code.isin(*HOLDING_STATUSES), F.lit(False))


def is_stationary(code: Column, speed: Column) -> Column:
    """Status or speed says the vessel is holding; never null."""
    return _claims_holding(code) | F.coalesce(speed < HOLDING_SPEED_KN, F.lit(False))


def status_speed_conflict(code: Column, speed: Column) -> Column:
    """Status says holding while the speed says moving; never null."""
    return _claims_holding(code) & F.coalesce(speed >= HOLDING_SPEED_KN, F.lit(False))


def vessel_category(ship_type: Column) -> Column:
    """Category from the ship type number."""
    chain = F.when(ship_type.isNull(), "unknown")
    for name, (low, high) in SHIP_TYPE_RANGES.items():
        chain = chain.when(ship_type.between(low, high), name)
    return chain.otherwise("other")


def overall(first: Column, second: Column) -> Column:
    """Length or beam from two antenna distances, null if either is."""
    return first + second


def marker_radius(length_m: Column) -> Column:
    """Map marker size: hull length, 120 if unknown, kept in 60-400, x 1.6 (P25)."""
    hull = F.coalesce(length_m, F.lit(120)).cast("double")
    return F.least(F.greatest(hull, F.lit(60.0)), F.lit(400.0)) * F.lit(1.6)


def display_speed(speed: Column) -> Column:
    """Speed to one digit, ties to even; unknown shows as zero (P25)."""
    return F.rint(F.coalesce(speed, F.lit(0.0)) * 10) / 10
