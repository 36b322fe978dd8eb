"""Place names and port regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Port boxes as (region, south, west, north, east), in priority order.
PORT_BOXES = (
    ("vancouver", 48.95, -123.65, 49.45, -122.85),
    ("prince_rupert", 54.05, -130.60, 54.45, -130.15),
)

PORT_REGIONS = tuple(box[0] for box in PORT_BOXES)

# Province to region group; every other province is prairie.
PROVINCE_GROUPS = {
    "pacific": ("BC",),
    "ontario": ("ON",),
    "quebec": ("QC",),
    "atlantic": ("NB", "NS", "PE", "NL"),
}

REGION_GROUPS = (*PROVINCE_GROUPS, "prairie")


def port_region(lat: Column, lon: Column, boxes: Sequence[tuple] = PORT_BOXES) -> Column:
    """Name of the first box holding the point, edges included, else null.

    The boxes are a short list in code, so this stays a codegen expression.
    """
    hits = [
        F.when(lat.between(south, north) & lon.between(west, east), F.lit(name))
        for name, south, west, north, east in boxes
    ]
    return F.coalesce(*hits)


def _second_part(location: Column, side: int) -> Column:
    town = F.split_part(location, F.lit("/"), F.lit(side))
    return F.trim(F.split_part(town, F.lit(","), F.lit(2)))


def canada_province(location: Column) -> Column:
    """`Surrey, BC/Blaine, WA` -> `BC`; empty when absent."""
    return _second_part(location, 1)


def us_state(location: Column) -> Column:
    """`Surrey, BC/Blaine, WA` -> `WA`; empty when absent."""
    return _second_part(location, 2)


def region_group(province: Column) -> Column:
    """Province to region group."""
    chain = F
    for group, provinces in PROVINCE_GROUPS.items():
        chain = chain.when(province.isin(*provinces), group)
    return chain.otherwise("prairie")
