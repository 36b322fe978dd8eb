"""Building the warehouse: staging, marts and their assertions, in order."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from flowmart.functions.delay import DELAY_STATUSES, LIVE_DELAY_STATUSES
from flowmart.functions.places import PORT_REGIONS, REGION_GROUPS
from flowmart.functions.vessel import VESSEL_CATEGORIES
from flowmart.operators.incremental import newer_than
from flowmart.operators.quality import (
    TableChecks,
    accepted_range,
    accepted_values,
    enforce,
    not_null,
    run_checks,
)
from flowmart.plans.marts import (
    agg_border_delay_profile,
    dim_crossings,
    dim_vessels,
    fct_border_waits,
    fct_port_congestion,
)
from flowmart.plans.staging import (
    stg_border_waits,
    stg_border_waits_historical,
    stg_vessel_positions,
    stg_vessels,
)
from flowmart.sources.tables import Warehouse
from flowmart.sources.versions import VersionedTable

STAGING = "analytics_staging"
MARTS = "analytics_marts"

# The words assertions accept.
TRAFFIC_TYPES = ("commercial", "travellers")
DIRECTIONS = ("canada", "us")
SEASONS = ("winter", "spring", "summer", "autumn")


def raw_checks() -> dict[str, TableChecks]:
    """Assertions on the landing tables."""
    return {
        "border_raw": TableChecks(
            rows=[not_null("observation_id"), not_null("customs_office")],
            unique=["observation_id"],
        ),
        "hist_raw": TableChecks(
            rows=[not_null("historical_id"), not_null("customs_office")],
            unique=["historical_id"],
        ),
        "ais_positions": TableChecks(
            rows=[not_null("snapshot_id"), not_null("mmsi")], unique=["snapshot_id"]
        ),
        "ship_static": TableChecks(rows=[not_null("mmsi")], unique=["mmsi"]),
    }


def mart_checks(crossings: DataFrame) -> dict[str, TableChecks]:
    """Assertions on the staged archive and the marts."""
    return {
        "dim_crossings": TableChecks(
            rows=[
                not_null("crossing_key"),
                not_null("crossing_name"),
                accepted_values("region_group", REGION_GROUPS),
            ],
            unique=["crossing_key", "crossing_name"],
        ),
        "fct_border_waits": TableChecks(
            rows=[
                not_null("wait_observation_key"),
                accepted_values("traffic_type", TRAFFIC_TYPES),
                accepted_values("direction", DIRECTIONS),
                accepted_values("delay_status", LIVE_DELAY_STATUSES),
                accepted_range("delay_minutes", 0, 480, severity="warn"),
            ],
            unique=["wait_observation_key"],
            parents=[("crossing_key", crossings, "crossing_key")],
        ),
        "dim_vessels": TableChecks(
            rows=[not_null("mmsi"), accepted_values("vessel_category", VESSEL_CATEGORIES)],
            unique=["mmsi"],
        ),
        "fct_port_congestion": TableChecks(
            rows=[
                not_null("congestion_key"),
                not_null("region"),
                accepted_values("region", PORT_REGIONS),
                accepted_range("stationary_share", 0, 1),
            ],
            unique=["congestion_key"],
        ),
        "stg_border_waits_historical": TableChecks(
            rows=[
                not_null("wait_observation_key"),
                accepted_values("traffic_type", TRAFFIC_TYPES),
                accepted_values("delay_status", DELAY_STATUSES),
            ],
            unique=["wait_observation_key"],
        ),
        "agg_border_delay_profile": TableChecks(
            rows=[
                not_null("profile_key"),
                not_null("crossing_name"),
                accepted_range("hour_of_day", 0, 23),
                accepted_range("day_of_week", 0, 6),
                accepted_range("delay_probability", 0, 1),
                accepted_values("season", SEASONS),
                accepted_range("measurement_coverage", 0, 1),
            ],
            unique=["profile_key"],
        ),
    }


def _with_day(df: DataFrame, column: str) -> DataFrame:
    # Partition column of the stored tables; time filters on it skip whole folders.
    return df.withColumn("day", F.to_date(column))


def _load(
    house: Warehouse,
    layer: str,
    name: str,
    source: DataFrame | VersionedTable,
    build,
    mark: str,
    key: str,
    lookback: timedelta,
    full_refresh: bool,
) -> VersionedTable:
    """One incremental table: new rows of the source are built and replace by key.

    What is new in a versioned source, its commits say: rows of equal times and late ones
    are taken up once. Of any other source it is the rows past the highest time stored.
    `full_refresh` rebuilds the table from the whole source, which is how facts
    pick up a later dimension value (I3).
    """
    table = house.table(layer, name, key)
    if isinstance(source, VersionedTable):
        upto = source.commit()
        fresh = source.read(upto) if full_refresh else source.changes(table.taken(), upto)
    else:
        upto = 0
        # The highest mark lies in the newest day, so only that one is read.
        fresh = source if full_refresh else newer_than(source, table.newest(), mark, lookback)
    if fresh is not None:
        rows = _with_day(build(fresh), mark)
        if full_refresh:
            table.overwrite(rows, upto)
        else:
            table.replace(rows, upto)
    return table


def build_border(
    house: Warehouse,
    raw: DataFrame | VersionedTable,
    lookback: timedelta = timedelta(0),
    full_refresh: bool = False,
) -> DataFrame:
    """Live border tables: staging, crossings, facts.

    `raw` is a versioned table, `house.table("raw", "border_raw")`, or any rows.
    `lookback` re-reads a stretch of such rows.
    """
    how = dict(mark="fetched_at", key="wait_observation_key", lookback=lookback,
               full_refresh=full_refresh)
    staged = _load(house, STAGING, "stg_border_waits", raw, stg_border_waits, **how)
    crossings = house.replace(MARTS, "dim_crossings", dim_crossings(staged.read()))
    _load(house, MARTS, "fct_border_waits", staged, lambda rows: fct_border_waits(rows, crossings), **how)
    return house.read(MARTS, "fct_border_waits")


def build_ports(
    house: Warehouse,
    positions: DataFrame | VersionedTable,
    static: DataFrame,
    lookback: timedelta = timedelta(0),
    full_refresh: bool = False,
) -> DataFrame:
    """Vessel tables: staging, vessels, congestion; sources as for `build_border`."""
    how = dict(mark="snapshot_ts", lookback=lookback, full_refresh=full_refresh)
    staged = _load(
        house, STAGING, "stg_vessel_positions", positions, stg_vessel_positions,
        key="snapshot_id", **how,
    )
    vessels = house.replace(MARTS, "dim_vessels", dim_vessels(staged.read(), stg_vessels(static)))
    _load(
        house, MARTS, "fct_port_congestion", staged,
        lambda rows: fct_port_congestion(rows, vessels), key="congestion_key", **how,
    )
    return house.read(MARTS, "fct_port_congestion")


def build_archive(house: Warehouse, raw: DataFrame) -> DataFrame:
    """Delay profile from the archive; the staged archive itself stays a view."""
    return house.replace(
        MARTS, "agg_border_delay_profile", agg_border_delay_profile(stg_border_waits_historical(raw))
    )


def check_marts(house: Warehouse, raise_errors: bool = True) -> dict[str, DataFrame]:
    """Run the assertions of every stored mart; errors raise."""
    results = {}
    for name, checks in mart_checks(house.read(MARTS, "dim_crossings")).items():
        table = house.find(MARTS, name)
        if table is None:
            continue
        results[name] = run_checks(table, checks)
        if raise_errors:
            enforce(results[name])
    return results
