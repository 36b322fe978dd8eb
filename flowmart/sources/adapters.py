"""Raw-layer rows derived from the sample tables `events`, `lineitem`, `customer`.

The expressions are the ones of FIXTURES.md section 3, coordinates rounded to
six digits; the oracle SQL carries the same text as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowmart.operators.latest import latest_per_key

_PLACES = """
    case {n} % 5 when 0 then 'Surrey, BC/Blaine, WA' when 1 then 'Windsor, ON/Detroit, MI'
         when 2 then 'Lacolle, QC/Champlain, NY' when 3 then 'Woodstock, NB/Houlton, ME'
         else 'Emerson, MB/Pembina, ND' end"""

_ZONES = """
    case {n} % 9 when 0 then 'PST' when 1 then 'PDT' when 2 then 'MST' when 3 then 'MDT'
         when 4 then 'CST' when 5 then 'CDT' when 6 then 'EST' when 7 then 'EDT' else 'AST' end"""

_MINUTES = "concat(cast(cast(floor(value) as int) as string), ' minutes')"

_QUANTITY = "cast(cast(floor(l_quantity) as int) as string)"

BORDER_RAW_SQL = f"""
select event_id as observation_id,
       cast(date_trunc('hour', ts) as timestamp) as fetched_at,
       concat('Office ', cast(user_id % 29 as string)) as customs_office,
       {_PLACES.format(n='(user_id % 29)')} as location,
       concat(substring(cast(ts as string), 1, 16), ' ', {_ZONES.format(n='event_id')}) as last_updated_text,
       case event_id % 12 when 0 then 'Not Applicable' when 1 then '--' when 2 then 'Temporarily closed'
            when 3 then 'weird' when 4 then '1 hour' when 5 then null
            when 6 then {_MINUTES} when 7 then {_MINUTES}
            else 'No Delay' end as commercial_canada_bound,
       case (event_id + 3) % 12 when 0 then 'Not Applicable' when 1 then '--' when 2 then 'Temporarily closed'
            when 4 then '2 hours' when 5 then null when 6 then {_MINUTES}
            else 'No Delay' end as commercial_us_bound,
       case (event_id + 5) % 12 when 0 then 'Not Applicable' when 1 then '--' when 6 then {_MINUTES}
            when 7 then concat(' ', cast(cast(floor(value) as int) as string), ' ')
            else 'no delay' end as travellers_canada_bound,
       case (event_id + 7) % 12 when 0 then 'Not Applicable' when 1 then ' -- ' when 6 then {_MINUTES}
            when 7 then concat(' ', {_MINUTES})
            else 'No Delay' end as travellers_us_bound
from {{events}}
"""

ARCHIVE_RAW_SQL = f"""
select (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey as historical_id,
       concat('bwt-', substring(cast(l_shipdate as string), 1, 4), '.csv') as source_file,
       concat('Office ', cast(l_suppkey % 6 as string)) as customs_office,
       {_PLACES.format(n='(l_suppkey % 6)')} as location,
       concat(substring(cast(l_shipdate as string), 1, 10), ' ',
              lpad(cast(l_orderkey % 24 as string), 2, '0'), ':',
              lpad(cast(l_linenumber * 7 as string), 2, '0'), ' ',
              {_ZONES.format(n='l_partkey')}) as updated_text,
       case (l_partkey + l_orderkey) % 12 when 0 then 'Not applicable' when 1 then '--'
            when 2 then 'Temporarily closed' when 3 then 'Missed entry' when 4 then null
            when 5 then {_QUANTITY} when 6 then {_QUANTITY}
            else 'No delay' end as commercial_flow,
       case (l_partkey + l_suppkey) % 12 when 0 then 'Not applicable' when 1 then '--'
            when 2 then 'Closed' when 3 then 'Missed entry' when 5 then {_QUANTITY}
            else 'No delay' end as travellers_flow
from {{lineitem}}
"""

AIS_MESSAGES_SQL = """
select event_id as snapshot_id,
       cast(date_trunc('hour', ts) as timestamp) as snapshot_ts,
       case when user_id % 4 = 0 then 'prince_rupert' else 'vancouver' end as region,
       user_id as mmsi,
       case when user_id % 7 = 0 then '  ' else concat('SHIP ', cast(user_id as string)) end as ship_name,
       cast(round(48.90 + (event_id % 50) / 100.0, 6) as double) as latitude,
       cast(round(-123.70 + (event_id % 80) / 100.0, 6) as double) as longitude,
       case when event_id % 11 = 0 then null else value / 100 end as sog,
       cast(event_id % 360 as double) as cog,
       cast(event_id % 17 as int) as navigational_status,
       cast(ts as timestamp) as message_ts
from {events}
"""

SHIP_STATIC_SQL = """
select c_custkey as mmsi, c_name as ship_name,
       case when c_custkey % 13 = 0 then null else cast(c_custkey % 100 as int) end as ship_type,
       c_mktsegment as destination,
       cast(c_custkey % 200 as int) as dim_a, cast(c_custkey % 90 as int) as dim_b,
       case when c_custkey % 10 = 0 then null else 12 end as dim_c, 14 as dim_d
from {customer}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def border_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BORDER_RAW_SQL, events=table(spark, sf_dir, "events"))


def archive_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ARCHIVE_RAW_SQL, lineitem=table(spark, sf_dir, "lineitem"))


def ais_messages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Position messages; `events` may be a stream over the same table."""
    source = table(spark, sf_dir, "events") if events is None else events
    return spark.sql(AIS_MESSAGES_SQL, events=source)


def ais_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vessel and snapshot: the last message wins."""
    return latest_per_key(
        ais_messages(spark, sf_dir), ["snapshot_ts", "mmsi"], ["message_ts", "snapshot_id"]
    )


def ship_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static records of all vessels."""
    return spark.sql(SHIP_STATIC_SQL, customer=table(spark, sf_dir, "customer")).withColumns(
        {
            "imo_number": F.lit(None).cast("bigint"),
            "call_sign": F.lit(None).cast("string"),
            "eta_text": F.lit(None).cast("string"),
            "max_draught": F.lit(None).cast("double"),
        }
    )


def partial_ship_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static records that every third vessel lacks, for what is made of absent ones."""
    return ship_static(spark, sf_dir).where("mmsi % 3 <> 0")
