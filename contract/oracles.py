"""DuckDB SQL with the same answer as each registered query.

Every statement is a chain of common table expressions over the given tables;
only the expressions a query needs are included.
"""

from __future__ import annotations

import re

from flowmart.functions.keys import NULL_KEY_TEXT
from flowmart.functions.timez import UTC_OFFSET_MINUTES
from flowmart.functions.vessel import NAV_STATUS
from flowmart.sources import adapters

from contract import queries as q

AS_OF = "timestamp '2024-01-31 00:00:00'"
RECENT = f"{AS_OF} - interval {q.TREND_DAYS} day"


def minutes_sql(x: str) -> str:
    def number(source: str, pattern: str) -> str:
        return f"try_cast(nullif(regexp_extract({source}, '{pattern}', 1), '') as integer)"

    return f"""coalesce(
        case lower(trim({x})) when 'no delay' then 0 end,
        {number(f'trim({x})', '^([0-9]+)$')},
        {number(x, '^([0-9]+) minute')},
        60 * {number(x, '^([0-9]+) hour')})"""


def status_sql(x: str) -> str:
    return f"""coalesce(
        case lower(trim({x})) when 'not applicable' then 'not_applicable' when '--' then 'not_reported'
             when 'missed entry' then 'missed_entry' end,
        if(contains(lower(trim({x})), 'closed'), 'closed', null),
        if(lower(trim({x})) = 'no delay' or regexp_full_match(trim({x}), '[0-9]+')
           or regexp_matches({x}, '^[0-9]+ (minute|hour)'), 'reported', null),
        'unknown')"""


def utc_sql(x: str) -> str:
    pairs = ", ".join(f"'{zone}': {minutes}" for zone, minutes in UTC_OFFSET_MINUTES.items())
    return (
        f"(try_cast(left({x}, 16) as timestamp)"
        f" + to_minutes(coalesce(map {{{pairs}}}[right(trim({x}), 3)], 0)))"
    )


def local_sql(ts: str) -> str:
    return f"timezone('America/Vancouver', timezone('UTC', {ts}))"


def parts_sql(ts: str, *names: str) -> str:
    return ", ".join(
        f"cast(date_part('{n}', {local_sql(ts)}) as integer) as local_{n}_pt" for n in names
    )


def key_sql(*parts: str) -> str:
    texts = [f"coalesce(cast({p} as varchar), '{NULL_KEY_TEXT}')" for p in parts]
    return "md5(" + " || '-' || ".join(texts) + ")"


def ratio_sql(num: str, den: str, places: int) -> str:
    """Whole-number rounding, half up, of a ratio that is not negative."""
    scale = 10**places
    return (
        f"cast((cast({num} as hugeint) * {2 * scale} + {den}) // (2 * nullif({den}, 0)) as double)"
        f" / {float(scale)}"
    )


def half_away_sql(x: str, places: int) -> str:
    return f"cast(round(cast({x} as decimal(28, 9)), {places}) as double)"


def category_sql(x: str) -> str:
    return f"""case when {x} is null then 'unknown' when {x} // 10 = 3 then 'fishing_special'
        when {x} // 10 = 5 then 'service' when {x} // 10 = 6 then 'passenger'
        when {x} // 10 = 7 then 'cargo' when {x} // 10 = 8 then 'tanker' else 'other' end"""


def group_sql(x: str) -> str:
    return f"""coalesce(map {{'BC': 'pacific', 'ON': 'ontario', 'QC': 'quebec', 'NB': 'atlantic',
        'NS': 'atlantic', 'PE': 'atlantic', 'NL': 'atlantic'}}[{x}], 'prairie')"""


NAV_SQL = "coalesce(map {%s}[navigational_status], 'other')" % ", ".join(
    f"{code}: '{word}'" for code, word in NAV_STATUS.items()
)

_PROVINCE = "trim(split_part(split_part(crossing_location, '/', 1), ',', 2))"
_STATE = "trim(split_part(split_part(crossing_location, '/', 2), ',', 2))"

VIEWS: dict[str, str] = {
    "border_raw": adapters.BORDER_RAW_SQL.format(events="events"),
    "hist_raw": adapters.ARCHIVE_RAW_SQL.format(lineitem="lineitem"),
    "ais_messages": adapters.AIS_MESSAGES_SQL.format(events="events"),
    "ais_positions": """
        select * exclude (rn) from (
            select *, row_number() over (partition by snapshot_ts, mmsi
                                         order by message_ts desc, snapshot_id desc) as rn
            from ais_messages) where rn = 1""",
    "ship_static": adapters.SHIP_STATIC_SQL.format(customer="customer"),
    "partial_static": "select * from ship_static where mmsi % 3 <> 0",
    "static_history": q.STATIC_HISTORY_SQL.format(events="events"),
    "border_flows": """
        select observation_id, fetched_at, customs_office, location, last_updated_text,
               unnest(['commercial', 'commercial', 'travellers', 'travellers']) as traffic_type,
               unnest(['canada', 'us', 'canada', 'us']) as direction,
               unnest([commercial_canada_bound, commercial_us_bound,
                       travellers_canada_bound, travellers_us_bound]) as delay_text_raw
        from border_raw""",
    "waits": f"""
        select cast(observation_id as varchar) || '-' || traffic_type || '-' || direction
                   as wait_observation_key,
               observation_id, fetched_at, trim(customs_office) as crossing_name,
               trim(location) as crossing_location, traffic_type, direction, delay_text_raw,
               {minutes_sql('delay_text_raw')} as delay_minutes,
               {status_sql('delay_text_raw')} as delay_status,
               {utc_sql('last_updated_text')} as cbsa_updated_at_utc,
               {parts_sql('fetched_at', 'hour', 'dow', 'month')}
        from border_flows""",
    "archive_flows": f"""
        select historical_id, source_file, customs_office, location,
               {utc_sql('updated_text')} as observed_at_utc,
               unnest(['commercial', 'travellers']) as traffic_type,
               unnest([commercial_flow, travellers_flow]) as delay_text_raw
        from hist_raw""",
    "history": f"""
        select cast(historical_id as varchar) || '-' || traffic_type as wait_observation_key,
               historical_id, source_file, trim(customs_office) as crossing_name,
               trim(location) as crossing_location, traffic_type, 'canada' as direction,
               delay_text_raw, {minutes_sql('delay_text_raw')} as delay_minutes,
               {status_sql('delay_text_raw')} as delay_status, observed_at_utc,
               {parts_sql('observed_at_utc', 'hour', 'dow', 'month', 'year')}
        from archive_flows where observed_at_utc is not null""",
    "positions": f"""
        select snapshot_id, snapshot_ts, region, mmsi, nullif(trim(ship_name), '') as ship_name,
               latitude, longitude, sog as speed_over_ground_kn, cog as course_over_ground_deg,
               navigational_status, {NAV_SQL} as nav_status_desc,
               coalesce(navigational_status in (1, 5), false) or coalesce(sog < 0.5, false)
                   as is_stationary,
               coalesce(navigational_status in (1, 5) and sog >= 0.5, false) as status_speed_conflict,
               message_ts
        from ais_positions""",
    "vessels": f"""
        select mmsi, nullif(trim(ship_name), '') as ship_name, ship_type,
               {category_sql('ship_type')} as vessel_category,
               nullif(trim(destination), '') as destination,
               dim_a + dim_b as length_m, dim_c + dim_d as beam_m
        from partial_static""",
    "crossings": f"""
        select {key_sql('crossing_name')} as crossing_key, crossing_name, crossing_location,
               {_PROVINCE} as canada_province, {_STATE} as us_state,
               {group_sql(_PROVINCE)} as region_group, handles_commercial,
               first_observed_at, last_observed_at, observation_count
        from (select crossing_name, max(crossing_location) as crossing_location,
                     bool_or(traffic_type = 'commercial' and delay_status = 'reported')
                         as handles_commercial,
                     min(fetched_at) as first_observed_at, max(fetched_at) as last_observed_at,
                     count(*) as observation_count
              from waits group by all)""",
    "facts": """
        select w.wait_observation_key, c.crossing_key, w.crossing_name, c.region_group,
               c.canada_province, w.traffic_type, w.direction, w.fetched_at, w.cbsa_updated_at_utc,
               w.delay_minutes, w.delay_status, w.delay_text_raw, w.local_hour_pt, w.local_dow_pt,
               w.local_month_pt,
               cast(round(epoch(w.fetched_at - w.cbsa_updated_at_utc) / 60.0) as integer)
                   as feed_lag_minutes,
               case when delay_minutes = 0 then 'clear' when delay_minutes between 1 and 15 then 'light'
                    when delay_minutes between 16 and 30 then 'moderate'
                    when delay_minutes between 31 and 60 then 'heavy'
                    when delay_minutes > 60 then 'severe' end as congestion_band
        from waits w left join crossings c using (crossing_name)""",
    "congestion": f"""
        select {key_sql('snapshot_ts', 'region')} as congestion_key, snapshot_ts, region,
               count(*) as vessels_total, count(*) filter (is_stationary) as vessels_stationary,
               count(*) filter (category = 'cargo') as vessels_cargo,
               count(*) filter (category = 'cargo' and is_stationary) as cargo_stationary,
               count(*) filter (category = 'tanker') as vessels_tanker,
               count(*) filter (category = 'unknown') as vessels_unknown_category,
               {half_away_sql('avg(speed_over_ground_kn)', 2)} as avg_speed_kn,
               {ratio_sql('count(*) filter (is_stationary)', 'count(*)', 3)} as stationary_share,
               {parts_sql('snapshot_ts', 'hour', 'dow')}
        from (select p.*, coalesce(v.vessel_category, 'unknown') as category
              from positions p left join vessels v using (mmsi))
        group by snapshot_ts, region""",
    "fleet": """
        select o.mmsi, coalesce(v.ship_name, o.seen_name) as ship_name,
               coalesce(v.vessel_category, 'unknown') as vessel_category, v.ship_type,
               cast(null as bigint) as imo_number, cast(null as varchar) as call_sign, v.destination,
               cast(null as varchar) as eta_text, v.length_m, v.beam_m,
               cast(null as double) as max_draught, v.mmsi is not null as has_static_data,
               o.first_seen_at, o.last_seen_at, o.position_report_count
        from (select mmsi, max(ship_name) as seen_name, min(snapshot_ts) as first_seen_at,
                     max(snapshot_ts) as last_seen_at, count(*) as position_report_count
              from positions group by mmsi) o
        left join vessels v on v.mmsi = o.mmsi""",
    "profile": f"""
        select {key_sql('crossing_name', 'traffic_type', 'local_hour_pt', 'local_dow_pt',
                        'local_month_pt')} as profile_key,
               crossing_name, traffic_type, local_hour_pt as hour_of_day, local_dow_pt as day_of_week,
               local_month_pt as month_of_year, local_dow_pt in (0, 6) as is_weekend,
               ['winter', 'spring', 'summer', 'autumn'][(local_month_pt % 12) // 3 + 1] as season,
               count(x) as observations, count(*) filter (x > 0) as delayed_observations,
               {ratio_sql('count(*) filter (x > 0)', 'count(x)', 4)} as delay_probability,
               {ratio_sql('sum(x)', 'count(x)', 2)} as mean_delay_minutes,
               round(quantile_cont(x, 0.5), 6) as median_delay_minutes,
               round(quantile_cont(x, 0.9), 6) as p90_delay_minutes, max(x) as max_delay_minutes,
               {half_away_sql('stddev_samp(x)', 2)} as stddev_delay_minutes,
               count(*) filter (delay_status = 'closed') as closed_observations,
               count(*) filter (delay_status = 'missed_entry') as missed_observations,
               count(*) as total_observations,
               {ratio_sql('count(x)', 'count(*)', 4)} as measurement_coverage
        from (select *, if(delay_status = 'reported', delay_minutes, null) as x from history)
        group by crossing_name, traffic_type, local_hour_pt, local_dow_pt, local_month_pt
        having count(x) > 0""",
    "lanes": """
        select crossing_name, canada_province, region_group, traffic_type, delay_minutes,
               delay_status, congestion_band, fetched_at
        from facts
        where fetched_at = (select max(fetched_at) from facts) and direction = 'canada'
          and delay_status = 'reported'""",
    "trend": f"""
        select date_trunc('hour', fetched_at) as hour_utc, crossing_name,
               avg(delay_minutes) as avg_delay_minutes
        from waits
        where traffic_type = 'commercial' and direction = 'canada' and delay_status = 'reported'
          and fetched_at > {RECENT}
        group by all""",
    "busiest": """
        select crossing_name from trend group by crossing_name
        order by avg(avg_delay_minutes) desc nulls last, crossing_name limit 4""",
    "listed": """
        select t.*, b.rank
        from trend t join (
            select crossing_name, row_number() over (order by avg(avg_delay_minutes) desc nulls last,
                                                     crossing_name) as rank
            from trend group by crossing_name qualify rank <= 4) b using (crossing_name)
        where avg_delay_minutes is not null""",
    "points": """
        select p.mmsi, coalesce(p.ship_name, 'unidentified') as ship_name, p.region, p.latitude,
               p.longitude, p.speed_over_ground_kn, p.is_stationary, p.nav_status_desc,
               coalesce(v.vessel_category, 'unknown') as vessel_category, v.length_m, v.destination,
               least(greatest(cast(coalesce(v.length_m, 120) as double), 60), 400) * 1.6 as radius,
               if(p.is_stationary, 'holding', 'under way') as status,
               round_even(coalesce(p.speed_over_ground_kn, 0) * 10, 0) / 10 as speed
        from positions p
        join (select region, max(snapshot_ts) as snapshot_ts from positions group by region)
             using (region, snapshot_ts)
        left join vessels v using (mmsi)""",
    "measured": """
        select crossing_name, local_hour_pt as hour_of_day, local_dow_pt as day_of_week,
               local_month_pt as month_of_year, local_year_pt as year, delay_minutes
        from history
        where traffic_type = 'commercial' and delay_status = 'reported' and delay_minutes is not null""",
    "train": f"select * from measured where year <= {q.TRAIN_MAX_YEAR}",
    "test": f"select * from measured where year = {q.TEST_YEAR}",
    "live": """
        select crossing_name, local_hour_pt as hour_of_day, local_dow_pt as day_of_week,
               local_month_pt as month_of_year, delay_minutes
        from waits
        where traffic_type = 'commercial' and direction = 'canada' and delay_status = 'reported'
          and delay_minutes is not null""",
    "m4": "select crossing_name, hour_of_day, day_of_week, month_of_year, avg(delay_minutes) as m,"
    " avg(if(delay_minutes > 0, 1, 0)) as p from train group by all",
    "m3": "select crossing_name, hour_of_day, day_of_week, avg(delay_minutes) as m,"
    " avg(if(delay_minutes > 0, 1, 0)) as p from train group by all",
    "m2": "select crossing_name, hour_of_day, avg(delay_minutes) as m,"
    " avg(if(delay_minutes > 0, 1, 0)) as p from train group by all",
    "m1": "select crossing_name, avg(delay_minutes) as m,"
    " avg(if(delay_minutes > 0, 1, 0)) as p from train group by all",
    "m0": "select avg(delay_minutes) as m, avg(if(delay_minutes > 0, 1, 0)) as p from train",
    "grid": """
        select crossing_name, cast(d.range as integer) as day_of_week,
               cast(h.range as integer) as hour_of_day, 7 as month_of_year
        from (select distinct crossing_name from train), range(7) d, range(24) h""",
}


def scored_view(source: str) -> str:
    """Rows of `source` with the fallback means of value and probability."""
    return f"""
        select t.*, coalesce(m4.m, m3.m, m2.m, m1.m, (select m from m0)) as baseline,
               coalesce(m4.p, m3.p, m2.p, m1.p, (select p from m0)) as probability
        from {source} t
        left join m4 using (crossing_name, hour_of_day, day_of_week, month_of_year)
        left join m3 using (crossing_name, hour_of_day, day_of_week)
        left join m2 using (crossing_name, hour_of_day)
        left join m1 using (crossing_name)"""


VIEWS["test_scored"] = scored_view("test")
VIEWS["live_scored"] = scored_view("live")
VIEWS["grid_scored"] = scored_view("grid")
VIEWS["ranked"] = """
    select baseline as score, count(*) filter (delay_minutes > 0) as pos,
           count(*) filter (delay_minutes = 0) as neg
    from test_scored group by baseline"""
VIEWS["roc"] = """
    select sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) as auc
    from (select *, coalesce(sum(neg) over (order by score rows between unbounded preceding
                                            and 1 preceding), 0) as below
          from ranked_chance)"""
VIEWS["precision"] = """
    select sum(pos * tp / (tp + fp)) / sum(pos) as ap
    from (select pos, cast(sum(pos) over w as double) as tp, cast(sum(neg) over w as double) as fp
          from ranked_chance window w as (order by score desc))"""
VIEWS["ranked_chance"] = """
    select probability as score, count(*) filter (delay_minutes > 0) as pos,
           count(*) filter (delay_minutes = 0) as neg
    from test_scored group by probability"""
VIEWS["lookup_scores"] = """
    select ['stage1_roc_auc', 'stage1_pr_auc', 'stage1_brier', 'model_mae_minutes',
            'baseline_mae_minutes', 'delayed_share', 'improvement_over_baseline_pct'] as names,
           [(select auc from roc), (select ap from precision),
            avg(pow(probability - if(delay_minutes > 0, 1, 0), 2)),
            avg(abs(probability * baseline - delay_minutes)), avg(abs(baseline - delay_minutes)),
            avg(if(delay_minutes > 0, 1, 0)),
            100 * (avg(abs(baseline - delay_minutes)) - avg(abs(probability * baseline - delay_minutes)))
                / avg(abs(baseline - delay_minutes))] as scores,
           count(*) as n_rows
    from test_scored"""
VIEWS["json_events"] = """
    select *, cast(round(48.90 + (event_id % 50) / 100.0, 6) as double) as meta_lat,
           cast(round(-123.70 + (event_id % 80) / 100.0, 6) as double) as lon
    from events where event_id % 23 <> 0 and event_id % 17 <> 0"""
VIEWS["urls"] = """
    select 'https://data.example.org/bwt-' || month || ending as url
    from (select distinct strftime(l_shipdate, '%Y-%m') as month from lineitem),
         (select unnest(['-eng.csv', '.csv']) as ending)"""
VIEWS["manifest"] = """
    select url, if(left(month, 2) = '20', cast(left(month, 4) as integer), null) as year,
           'bwt-' || month || ending as source_file
    from (select distinct strftime(l_shipdate, '%Y-%m') as month from lineitem),
         (select unnest(['-eng.csv', '.csv']) as ending),
         lateral (select 'https://data.example.org/bwt-' || month || ending as url)"""


def with_views(body: str) -> str:
    """Prefix `body` with the views it needs, dependencies first."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", sql):
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    chain = ",\n".join(f"{name} as ({VIEWS[name]})" for name in needed)
    return f"with {chain}\n{body}"


def check_row(check: str, column: str, source: str, count: str, severity: str = "error") -> str:
    return (
        f"select '{check}' as \"check\", '{column}' as \"column\", {count} as failures,"
        f" '{severity}' as severity from {source}"
    )


def unique_row(column: str, source: str) -> str:
    counted = f"(select {column} from {source} where {column} is not null group by 1 having count(*) > 1)"
    return check_row("unique", column, counted, "count(*)")


def bad_rows(check: str, column: str, source: str, bad: str, severity: str = "error") -> str:
    return check_row(check, column, source, f"count(*) filter ({bad})", severity)


FLOW = "trim(coalesce({0}, '')) as {0}"

BODIES: dict[str, str] = {
    "load_border_feed": "select fetched_at, "
    + ", ".join(
        FLOW.format(c)
        for c in (
            "customs_office", "location", "last_updated_text", "commercial_canada_bound",
            "commercial_us_bound", "travellers_canada_bound", "travellers_us_bound",
        )
    )
    + " from border_raw",
    "load_archive": "select customs_office, location, updated_text, commercial_flow,"
    " travellers_flow from hist_raw",
    "archive_manifest": "select * from manifest order by coalesce(year, 0), url",
    "archive_pending_files": "select source_file, url, year from manifest"
    " where year >= 2000 and cast(substr(source_file, 10, 2) as integer) % 2 = 1",
    "ais_positions_from_json": """
        select event_id as arrival, 'vancouver' as region, user_id as mmsi,
               'SHIP ' || user_id as ship_name, lat as latitude, lon as longitude, value as sog,
               cast(event_id % 17 as integer) as navigational_status,
               if(event_id % 13 = 0, null, ts) as message_ts
        from (select *, if(event_id % 10 = 0, meta_lat, round(meta_lat + 1, 6)) as lat from json_events
              where event_id % 7 <> 0)
        where lat between 48.95 and 49.45 and lon between -123.65 and -122.85""",
    "ais_static_from_json": """
        select event_id as arrival, user_id as mmsi, 'S ' || event_type as ship_name,
               cast(event_id % 100 as integer) as ship_type,
               if(event_id % 2 = 0, printf('%02d-%02d 00:00', event_id % 12 + 1, event_id % 28 + 1),
                  null) as eta_text,
               cast(event_id % 200 as integer) as dim_a, cast(event_id % 90 as integer) as dim_b
        from json_events where event_id % 7 = 0""",
    "region_for_position": """
        select snapshot_id,
               if(latitude >= 48.95 and latitude <= 49.45 and longitude >= -123.65
                  and longitude <= -122.85, 'vancouver', null) as region
        from ais_messages""",
    "latest_position_per_window": "select * from ais_positions",
    "vessel_static_upsert": """
        select mmsi, arg_max(ship_name, snapshot_ts) filter (ship_name is not null) as ship_name,
               arg_max(ship_type, snapshot_ts) filter (ship_type is not null) as ship_type,
               arg_max(destination, snapshot_ts) filter (destination is not null) as destination,
               arg_max(max_draught, snapshot_ts) filter (max_draught is not null) as max_draught,
               min(snapshot_ts) as first_seen_at, max(snapshot_ts) as last_seen_at
        from (select *, row_number() over (partition by snapshot_ts, mmsi
                                           order by seen_at desc, event_id desc) as rn
              from static_history)
        where rn = 1 group by mmsi""",
    "vessel_static_merge": """
        select mmsi, coalesce(n.ship_name, o.ship_name) as ship_name,
               coalesce(n.ship_type, o.ship_type) as ship_type,
               coalesce(n.destination, o.destination) as destination,
               coalesce(n.max_draught, o.max_draught) as max_draught,
               coalesce(o.first_seen_at, n.seen_at) as first_seen_at,
               coalesce(n.seen_at, o.last_seen_at) as last_seen_at
        from (select mmsi, min(seen_at) as first_seen_at, max(seen_at) as last_seen_at,
                     arg_max(ship_name, seen_at) filter (ship_name is not null) as ship_name,
                     arg_max(ship_type, seen_at) filter (ship_type is not null) as ship_type,
                     arg_max(destination, seen_at) filter (destination is not null) as destination,
                     arg_max(max_draught, seen_at) filter (max_draught is not null) as max_draught
              from static_history where seen_at < timestamp '2024-01-16' group by mmsi) o
        full join (select * from static_history where seen_at >= timestamp '2024-01-16'
                   qualify row_number() over (partition by mmsi order by seen_at desc, event_id desc) = 1) n
        using (mmsi)""",
    "clean_vessel_names": "select snapshot_id, mmsi, nullif(trim(ship_name), '') as ship_name"
    " from ais_messages",
    "border_long": "select * from waits",
    "archive_long": "select * from history",
    "parse_delay_minutes": f"""
        select historical_id, {minutes_sql('commercial_flow')} as commercial_minutes,
               {minutes_sql('travellers_flow')} as travellers_minutes from hist_raw""",
    "delay_status": f"""
        select historical_id, {status_sql('commercial_flow')} as commercial_status,
               {status_sql('travellers_flow')} as travellers_status from hist_raw""",
    "local_to_utc": f"select historical_id, {utc_sql('updated_text')} as observed_at_utc from hist_raw",
    "local_time_features": f"""
        select historical_id, {parts_sql('utc', 'hour', 'dow', 'month', 'year')}
        from (select historical_id, {utc_sql('updated_text')} as utc from hist_raw)""",
    "surrogate_key": f"select snapshot_id, {key_sql('snapshot_ts', 'region', '(sog > 0.5)')} as key"
    " from ais_messages",
    "nav_status_desc": f"select snapshot_id, navigational_status, {NAV_SQL} as nav_status_desc"
    " from ais_messages",
    "vessel_stationary": "select snapshot_id, is_stationary, status_speed_conflict from positions",
    "vessel_category": "select mmsi, ship_type, vessel_category, length_m, beam_m, destination from ("
    + VIEWS["vessels"].replace("partial_static", "ship_static") + ")",
    "border_feed_lag": f"""
        select observation_id,
               cast(round(epoch(fetched_at - {utc_sql('last_updated_text')}) / 60.0) as integer)
                   as feed_lag_minutes
        from border_raw""",
    "congestion_band": """
        select crossing_name,
               case when delay_minutes > 60 then 'severe' when delay_minutes > 30 then 'heavy'
                    when delay_minutes > 15 then 'moderate' when delay_minutes > 0 then 'light'
                    when delay_minutes = 0 then 'clear' end as congestion_band,
               count(*) as readings
        from history group by all""",
    "dim_crossings": "select * from crossings",
    "fct_border_waits": "select * from facts",
    "dim_vessels": "select * from fleet",
    "fct_port_congestion": "select * from congestion",
    "border_delay_profile": "select * from profile",
    "feed_freshness": f"""
        select feed, latest_at, round(age, 6) as age_minutes,
               case when floor(age) > 180 then 'alert' when floor(age) > 45 then 'warn' else '' end as tier,
               if(age < 60, printf('%d min old', cast(floor(age) as bigint)),
                  printf('%dh %02dm old', cast(floor(age) as bigint) // 60,
                         cast(floor(age) as bigint) % 60)) as age_label
        from (select *, epoch({AS_OF} - latest_at) / 60.0 as age from (
                select 'ports' as feed, max(snapshot_ts) as latest_at from ais_messages
                union all select 'border', max(fetched_at) from border_raw))""",
    "latest_congestion": """
        select *, case when stationary_share >= 0.7 then 'alert' when stationary_share >= 0.5 then 'warn'
                       else '' end as tone,
               if(region = 'vancouver', 'Vancouver', 'Prince Rupert') as region_label
        from congestion
        qualify snapshot_ts = max(snapshot_ts) over (partition by region)""",
    "congestion_trend": f"""
        select snapshot_ts, region, vessels_total, vessels_stationary, stationary_share
        from congestion where snapshot_ts > {RECENT} order by snapshot_ts""",
    "congestion_pivot": f"""
        select snapshot_ts, avg(stationary_share) filter (region = 'vancouver') as "Vancouver",
               avg(stationary_share) filter (region = 'prince_rupert') as "Prince Rupert"
        from congestion
        where snapshot_ts > {RECENT}
          and (select count(distinct snapshot_ts) from congestion where snapshot_ts > {RECENT}) >= 4
        group by snapshot_ts order by snapshot_ts""",
    "vessel_map_points": "select * from points",
    "map_centre": "select round(avg(latitude), 6) as latitude, round(avg(longitude), 6) as longitude,"
    " count(*) as vessels from points",
    "latest_border_waits": "select * from lanes",
    "border_hourly_trend": "select hour_utc, crossing_name,"
    " round(avg_delay_minutes, 6) as avg_delay_minutes from trend order by hour_utc",
    "ranked_crossings": "select crossing_name, canada_province, delay_minutes, congestion_band"
    " from lanes where traffic_type = 'commercial'"
    " order by delay_minutes desc nulls last, crossing_name",
    "border_headline": """
        select count(*) as lanes_reporting, count(*) filter (delay_minutes > 0) as lanes_delayed,
               round(avg(delay_minutes), 6) as avg_delay_minutes,
               first(crossing_name order by delay_minutes desc nulls last, crossing_name)
                   as worst_crossing,
               first(canada_province order by delay_minutes desc nulls last, crossing_name)
                   as worst_province,
               max(delay_minutes) as longest_wait,
               case when max(delay_minutes) >= 30 then 'alert' when max(delay_minutes) > 0 then 'warn'
                    else '' end as tone
        from lanes where traffic_type = 'commercial'""",
    "busiest_crossings_hourly": "select hour_utc, crossing_name,"
    " round(avg_delay_minutes, 6) as avg_delay_minutes from trend"
    " where crossing_name in (select crossing_name from busiest)",
    "border_pivot": """
        select hour_utc,
               (select crossing_name from listed where rank = 1 limit 1) as crossing_1,
               round(avg(avg_delay_minutes) filter (rank = 1), 6) as delay_1,
               (select crossing_name from listed where rank = 2 limit 1) as crossing_2,
               round(avg(avg_delay_minutes) filter (rank = 2), 6) as delay_2,
               (select crossing_name from listed where rank = 3 limit 1) as crossing_3,
               round(avg(avg_delay_minutes) filter (rank = 3), 6) as delay_3,
               (select crossing_name from listed where rank = 4 limit 1) as crossing_4,
               round(avg(avg_delay_minutes) filter (rank = 4), 6) as delay_4
        from listed
        where (select count(distinct hour_utc) from listed) > 2
        group by hour_utc order by hour_utc""",
    "crossing_names": "select distinct crossing_name from waits order by crossing_name",
    "incremental_slice": "select wait_observation_key, fetched_at, delay_minutes from waits"
    " where fetched_at > timestamp '2024-01-15 10:00:00'",
    "upsert_by_key": """
        select wait_observation_key, fetched_at,
               if(fetched_at >= timestamp '2024-01-10', 'revised ', '') || delay_status as delay_status
        from waits""",
    "incremental_border_build": "select wait_observation_key, crossing_key, region_group, fetched_at,"
    " delay_minutes, feed_lag_minutes, congestion_band from facts",
    "check_unique": " union all ".join(
        [
            unique_row("observation_id", "border_raw"),
            unique_row("last_updated_text", "border_raw"),
            unique_row("historical_id", "hist_raw"),
            unique_row("snapshot_id", "ais_positions"),
            unique_row("mmsi", "ship_static"),
        ]
    ),
    "check_not_null": " union all ".join(
        bad_rows("not_null", c, "hist_raw", f"{c} is null")
        for c in ("historical_id", "customs_office", "commercial_flow")
    ),
    "check_accepted_values": " union all ".join(
        [
            bad_rows("accepted_values", "traffic_type", "history",
                     "traffic_type not in ('commercial', 'travellers')"),
            bad_rows("accepted_values", "delay_status", "history", "delay_status = 'missed_entry'"),
        ]
    ),
    "check_accepted_range": " union all ".join(
        [
            bad_rows("accepted_range", "delay_minutes", "history",
                     "delay_minutes < 0 or delay_minutes > 40", "warn"),
            bad_rows("accepted_range", "local_hour_pt", "history", "local_hour_pt not between 0 and 23"),
            bad_rows("accepted_range", "local_dow_pt", "history", "local_dow_pt in (0, 6)"),
        ]
    ),
    "check_parsed_times": bad_rows(
        "parsed", "updated_text", "hist_raw", "historical_id % 7 = 0", "warn"
    ),
    "check_relationships": bad_rows(
        "relationships", "mmsi", "positions", "mmsi not in (select mmsi from vessels)"
    ),
    "source_freshness": f"""
        select source, latest_at, round(age, 6) as age_hours,
               case when age > 12 then 'error' when age > 2 then 'warn' else 'pass' end as status
        from (select *, epoch({AS_OF} - latest_at) / 3600.0 as age from (
                select 'border_raw' as source, max(fetched_at) as latest_at from border_raw
                union all select 'ais_positions', max(snapshot_ts) from ais_messages))""",
    "border_fact_assertions": " union all ".join(
        [
            unique_row("wait_observation_key", "facts"),
            bad_rows("not_null", "wait_observation_key", "facts", "wait_observation_key is null"),
            bad_rows("accepted_values", "traffic_type", "facts",
                     "traffic_type not in ('commercial', 'travellers')"),
            bad_rows("accepted_values", "direction", "facts", "direction not in ('canada', 'us')"),
            bad_rows("accepted_values", "delay_status", "facts",
                     "delay_status not in ('reported', 'not_applicable', 'not_reported', 'closed', 'unknown')"),
            bad_rows("accepted_range", "delay_minutes", "facts", "delay_minutes not between 0 and 480", "warn"),
            bad_rows("relationships", "crossing_key", "facts",
                     "crossing_key not in (select crossing_key from crossings)"),
        ]
    ),
    "profile_assertions": " union all ".join(
        [
            unique_row("profile_key", "profile"),
            bad_rows("not_null", "profile_key", "profile", "profile_key is null"),
            bad_rows("not_null", "crossing_name", "profile", "crossing_name is null"),
            bad_rows("accepted_range", "hour_of_day", "profile", "hour_of_day not between 0 and 23"),
            bad_rows("accepted_range", "day_of_week", "profile", "day_of_week not between 0 and 6"),
            bad_rows("accepted_range", "delay_probability", "profile", "delay_probability not between 0 and 1"),
            bad_rows("accepted_values", "season", "profile",
                     "season not in ('winter', 'spring', 'summer', 'autumn')"),
            bad_rows("accepted_range", "measurement_coverage", "profile",
                     "measurement_coverage not between 0 and 1"),
        ]
    ),
    "temporal_split_counts": "select 'train' as side, count(*) as readings from train"
    " union all select 'test', count(*) from test",
    "model_features": """
        select l.crossing_name, coalesce(c.code, -1) as crossing_code, hour_of_day, day_of_week,
               month_of_year, if(day_of_week in (0, 6), 1, 0) as is_weekend,
               round(sin(2 * pi() * hour_of_day / 24), 6) + 0.0 as hour_sin,
               round(cos(2 * pi() * hour_of_day / 24), 6) + 0.0 as hour_cos,
               round(sin(2 * pi() * month_of_year / 12), 6) + 0.0 as month_sin,
               round(cos(2 * pi() * month_of_year / 12), 6) + 0.0 as month_cos
        from (select distinct crossing_name, hour_of_day, day_of_week, month_of_year from live) l
        left join (select crossing_name,
                          cast(row_number() over (order by crossing_name) - 1 as integer) as code
                   from (select distinct crossing_name from train)) c using (crossing_name)""",
    "lookup_baseline": """
        select crossing_name, hour_of_day, day_of_week, month_of_year, delay_minutes, year,
               count(*) as n, round(any_value(baseline), 6) as baseline
        from test_scored group by all""",
    "baseline_roc_auc": """
        select round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) as roc_auc,
               cast(sum(pos) as bigint) as positives, cast(sum(pos) + sum(neg) as bigint) as n_rows
        from (select *, coalesce(sum(neg) over (order by score rows between unbounded preceding
                                                and 1 preceding), 0) as below
              from ranked)""",
    "baseline_pr_auc": """
        select round(sum(pos * tp / (tp + fp)) / sum(pos), 6) as average_precision,
               cast(sum(pos) as bigint) as positives, cast(sum(pos) + sum(neg) as bigint) as n_rows
        from (select pos, neg, cast(sum(pos) over w as double) as tp,
                     cast(sum(neg) over w as double) as fp
              from ranked window w as (order by score desc))""",
    "baseline_brier": "select round(avg(pow(probability - if(delay_minutes > 0, 1, 0), 2)), 6) as brier"
    " from test_scored",
    "baseline_mae": "select round(avg(abs(baseline - delay_minutes)), 6) as mae_minutes from test_scored",
    "delayed_share": """
        select 'train' as side, round(avg(if(delay_minutes > 0, 1, 0)), 6) as delayed_share from train
        union all select 'test', round(avg(if(delay_minutes > 0, 1, 0)), 6) from test""",
    "drift_metrics": """
        select 'live_2026' as evaluation, unnest(['baseline_mae_minutes', 'delayed_share']) as metric,
               round(unnest([mae, share]), 6) as value, n_rows
        from (select avg(abs(baseline - delay_minutes)) as mae,
                     avg(if(delay_minutes > 0, 1, 0)) as share, count(*) as n_rows
              from live_scored)
        where n_rows >= 50""",
    "grid_cells": "select * from grid",
    "peak_hour": """
        select crossing_name, day_of_week, hour_of_day as peak_hour,
               round(baseline, 6) as expected_delay_minutes, round(probability, 6) as delay_probability
        from grid_scored
        qualify row_number() over (partition by crossing_name, day_of_week
                                   order by baseline desc, hour_of_day) = 1""",
    "expected_delay_curve": """
        select hour_of_day, round(probability, 6) as delay_probability,
               round(baseline, 6) as expected_delay_minutes
        from grid_scored where crossing_name = 'Office 3' and day_of_week = 3 order by hour_of_day""",
    "stream_latest_positions": """
        select time_bucket(interval 15 minute, message_ts) as window_start, mmsi, snapshot_id, region,
               sog, message_ts
        from ais_messages
        qualify row_number() over (partition by window_start, mmsi
                                   order by message_ts desc, snapshot_id desc) = 1""",
    "stream_border_waits": "select wait_observation_key, fetched_at, crossing_name, delay_minutes,"
    " delay_status, cbsa_updated_at_utc from waits",
    "lookup_holdout_metrics": """
        select 'holdout_2000' as evaluation, unnest(names) as metric, round(unnest(scores), 6) as value,
               n_rows
        from lookup_scores""",
    "lookup_summary": """
        select round(scores[1], 6) as roc_auc, round(scores[4], 6) as model_mae_minutes,
               round(scores[5], 6) as baseline_mae_minutes, round(scores[6], 6) as holdout_delayed_share,
               (select if(count(*) >= 50, round(avg(if(delay_minutes > 0, 1, 0)), 6), null)
                from live_scored) as live_delayed_share,
               timestamp '2024-01-30 11:53:00' as retrained_at,
               round(coalesce(scores[7], 0), 6) as gain_pct, '12h 07m old' as age_label
        from lookup_scores""",
}
BODIES["archive_backfill"] = BODIES["load_archive"]
BODIES["collect_border_twice"] = BODIES["load_border_feed"].replace("select fetched_at, ", "select ")
BODIES["stream_vessel_static"] = BODIES["vessel_static_upsert"]
BODIES["stream_vessel_state"] = BODIES["vessel_static_upsert"]
BODIES["crossings_reloaded"] = BODIES["dim_crossings"]
BODIES["late_border_rows"] = "select count(*) as late_rows from border_raw"
BODIES["versioned_border_build"] = (
    "select wait_observation_key, fetched_at, delay_minutes, feed_lag_minutes, congestion_band from facts"
)
BODIES["profile_from_stored_counts"] = BODIES["border_delay_profile"]
BODIES["distinct_vessels_by_region"] = (
    "select region, count(distinct mmsi) as vessels, true as is_close from ais_messages group by region"
)
_BOXES = """
    (select 'box ' || c_custkey as region, south, west, round(south + size, 6) as north,
            round(west + 2 * size, 6) as east, (c_custkey * 7919) % 1009 as priority
     from (select c_custkey, round(48.8 + (c_custkey % 97) / 100.0, 6)::double as south,
                  round(-123.8 + (c_custkey % 113) / 100.0, 6)::double as west,
                  (case when c_custkey % 50 = 0 then 0.3 when c_custkey % 3 = 0 then 0.011 else 0.004 end)::double as size
           from customer))"""
BODIES["region_by_box_table"] = f"""
    select snapshot_id, found.region
    from ais_messages m
    left join (
        select latitude, longitude, arg_min(region, (priority, region)) as region
        from (select distinct latitude, longitude from ais_messages)
        join {_BOXES} b on latitude between south and north and longitude between west and east
        group by all) found on m.latitude = found.latitude and m.longitude = found.longitude"""

_STREAM_POSITIONS = """
    (select bucket as snapshot_ts, mmsi, region, sog as speed_over_ground_kn,
            coalesce(navigational_status in (1, 5), false) or coalesce(sog < 0.5, false) as is_stationary
     from (select *, time_bucket(interval 15 minute, message_ts) as bucket from ais_messages)
     qualify row_number() over (partition by bucket, mmsi
                                order by message_ts desc, snapshot_id desc) = 1)"""

BODIES["stream_port_congestion"] = VIEWS["congestion"].replace(
    "from positions p", f"from {_STREAM_POSITIONS} p"
)

BODIES["stream_congestion_by_batch"] = BODIES["stream_port_congestion"]

ORACLES = {name: with_views(body) for name, body in BODIES.items()}
