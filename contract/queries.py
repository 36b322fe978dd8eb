"""One callable per operator: (spark, sf_dir) -> DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowmart.functions import delay, keys, places, text, timez, vessel
from flowmart.operators import boxes, incremental, latest, metrics, quality
from flowmart.plans import collect, marts, model, rollups, serving, staging, warehouse
from flowmart.session import configure, pin, scratch_path
from flowmart.sources import adapters, ais, archive, border_feed, files
from flowmart.sources.tables import Warehouse, current_path, read_source, replace_table
from flowmart.streaming import ais as ais_stream, border as border_stream, run, vessel_state

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

# The sample archive covers 1995-2001 and the sample feed January 2024.
TRAIN_MAX_YEAR = 1999
TEST_YEAR = 2000
TREND_DAYS = 7
LINES_PER_FETCH = 30


def as_of():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def at(text_value: str):
    return F.lit(text_value).cast("timestamp")


def query(fn: Query) -> Query:
    """Register a query under its function name."""

    def run_configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    REGISTRY[fn.__name__] = run_configured
    return run_configured


# --- shared inputs -----------------------------------------------------------


def waits(spark, sf):
    return staging.stg_border_waits(adapters.border_raw(spark, sf))


def history(spark, sf):
    return staging.stg_border_waits_historical(adapters.archive_raw(spark, sf))


def positions(spark, sf):
    return staging.stg_vessel_positions(adapters.ais_positions(spark, sf))


def vessels(spark, sf):
    """Vessels without every third one: what becomes of an absent vessel is part of the marts."""
    return staging.stg_vessels(adapters.partial_ship_static(spark, sf))


def border_facts(spark, sf):
    staged = waits(spark, sf)
    return marts.fct_border_waits(staged, pin(marts.dim_crossings(staged), "dim_crossings"))


def congestion(spark, sf):
    return marts.fct_port_congestion(positions(spark, sf), vessels(spark, sf))


def split_cells(spark, sf):
    cells = pin(model.delay_cells(history(spark, sf)), "cells")
    return model.temporal_split(cells, TRAIN_MAX_YEAR, TEST_YEAR)


def static_history(spark, sf):
    """Static reports per event, with attributes that come and go."""
    return spark.sql(STATIC_HISTORY_SQL, events=adapters.table(spark, sf, "events"))


STATIC_HISTORY_SQL = """
select event_id, user_id as mmsi, cast(ts as timestamp) as seen_at,
       cast(date_trunc('hour', ts) as timestamp) as snapshot_ts,
       case when event_id % 3 = 0 then null else concat('SHIP ', cast(event_id % 5 as string)) end as ship_name,
       case when event_id % 4 = 0 then null else cast(event_id % 100 as int) end as ship_type,
       case when event_id % 5 <> 0 then null else event_type end as destination,
       case when event_id % 2 = 0 then null else value / 10 end as max_draught
from {events}
"""

STATIC_HISTORY_COLUMNS = ["ship_name", "ship_type", "destination", "max_draught"]


# --- sources -----------------------------------------------------------------


def land(fetches, folder):
    """Write the body of each (source_file, body) row as a file of that name.

    Names are dealt out to 256 folders, so that a listing runs in tasks however many there are.
    """

    def written(batches):
        import pyarrow as pa
        import pyarrow.fs
        from pyspark import TaskContext

        made, attempt = set(), TaskContext.get().taskAttemptId()
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, bucket, body in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                where = f"{root}/{bucket}"
                if where not in made:
                    files.create_dir(where, recursive=True)
                    made.add(where)
                # Names with an underscore are not data; the file appears when it is complete.
                with files.open_output_stream(f"{where}/_{name}-{attempt}") as stream:
                    stream.write(body.encode())
                files.move(f"{where}/_{name}-{attempt}", f"{where}/{name}.txt")
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    bucket = F.pmod(F.xxhash64("source_file"), F.lit(256)).cast("string")
    rows = fetches.select("source_file", bucket.alias("bucket"), "body")
    rows.mapInArrow(written, "files bigint").agg(F.sum("files")).collect()


def feed_bodies(raw):
    """Rows rendered to feed bodies of at most thirty lines."""
    line = F.concat_ws(
        " ;; ", *[F.coalesce(F.col(c), F.lit("")) for c in border_feed.FEED_COLUMNS]
    )
    numbered = F.sort_array(F.collect_list(F.struct("observation_id", line.alias("line"))))
    header = "\ufeffCustoms Office ;; Location ;; Last updated ;; a ;; b ;; c ;; d\r\n"
    return (
        raw.groupBy("fetched_at", F.floor(F.col("observation_id") / LINES_PER_FETCH).alias("part"))
        .agg(numbered.alias("lines"))
        .select(
            F.concat_ws("-", F.unix_seconds("fetched_at"), "part").alias("source_file"),
            F.col("fetched_at").alias("landed_at"),
            F.concat(F.lit(header), F.array_join("lines.line", "\r\n\r\n")).alias("body"),
        )
    )


@query
def load_border_feed(spark, sf):
    """Feed bodies, parsed."""
    bodies = feed_bodies(adapters.border_raw(spark, sf))
    return border_feed.parse_feed(border_feed.feed_lines(bodies)).select(
        "fetched_at", *border_feed.FEED_COLUMNS
    )


@query
def load_archive(spark, sf):
    """Rows written as CSV files, then loaded."""
    path = scratch_path(spark, "archive-csv")
    adapters.archive_raw(spark, sf).select(*archive.ARCHIVE_COLUMNS).withColumnsRenamed(
        {"customs_office": "Customs Office", "location": "Location", "updated_text": "Updated"}
    ).write.csv(path, header=True, quote='"', escape='"')
    return archive.load_archive(spark, [path]).select(*archive.ARCHIVE_COLUMNS)


@query
def archive_backfill(spark, sf):
    """The archive's files loaded in two runs, the second of which finds some of them done."""
    path, table = (scratch_path(spark, f"backfill-{part}") for part in ("csv", "table"))
    rows = adapters.archive_raw(spark, sf).select(*archive.ARCHIVE_COLUMNS).withColumnsRenamed(
        {"customs_office": "Customs Office", "location": "Location", "updated_text": "Updated"}
    )
    rows.repartition(4).write.csv(path, header=True, quote='"', escape='"')
    urls = files.landed_files(spark, path).select(F.col("path").alias("url"))
    manifest = pin(archive.archive_manifest(urls), "manifest")
    some = F.pmod(F.xxhash64("source_file"), F.lit(2)) == 0
    archive.backfill(spark, manifest.where(some), table)
    archive.backfill(spark, manifest, table)
    return archive.archive_table(spark, table).read().select(*archive.ARCHIVE_COLUMNS)


@query
def collect_border_twice(spark, sf):
    """A folder collected when half of its fetches have landed, and again when all have."""
    feed, root = scratch_path(spark, "feed"), scratch_path(spark, "house")
    house = Warehouse(spark, root)
    # A sample row has a time of its own; a fetch reads all its crossings at one.
    raw = adapters.border_raw(spark, sf).withColumn("fetched_at", as_of())
    fetches = feed_bodies(raw).withColumn("part", F.pmod(F.xxhash64("source_file"), F.lit(2)))
    fetches = pin(fetches, "fetches")
    for part in (0, 1):
        land(fetches.where(F.col("part") == part), feed)
        collect.collect_border(house, feed)
    house.table("raw", "border_raw", "observation_id").compact()
    return house.read("raw", "border_raw").select(*border_feed.FEED_COLUMNS)


def archive_urls(spark, sf):
    """Catalogue entries: one file per month in two languages, plus a text file."""
    months = (
        adapters.table(spark, sf, "lineitem")
        .select(F.date_format("l_shipdate", "yyyy-MM").alias("month"))
        .distinct()
    )
    endings = F.array(*[F.lit(e) for e in ("-eng.csv", "-fra.csv", "-fr.CSV", ".csv", ".txt")])
    return months.select("month", F.explode(endings).alias("ending")).select(
        F.concat(F.lit(" https://data.example.org/bwt-"), "month", "ending").alias("url")
    )


@query
def archive_manifest(spark, sf):
    return archive.archive_manifest(archive_urls(spark, sf))


@query
def archive_pending_files(spark, sf):
    """Files of 2000 and later that the ledger, holding even months, lacks."""
    manifest = archive.archive_manifest(archive_urls(spark, sf), from_year=2000)
    month = F.regexp_extract("source_file", r"-(\d{2})[-.]", 1).cast("int")
    ledger = manifest.where(month % 2 == 0).select("source_file")
    return archive.pending_files(manifest, ledger).select("source_file", "url", "year")


def message_lines(spark, sf):
    """Events rendered as vessel messages, some of them broken or incomplete."""
    event = adapters.table(spark, sf, "events")
    lat = F.expr("cast(round(48.90 + (event_id % 50) / 100.0, 6) as double)")
    lon = F.expr("cast(round(-123.70 + (event_id % 80) / 100.0, 6) as double)")
    clock = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    n = F.col("event_id")

    def message(loose):
        """A message; a loose one has text for whole numbers or a fraction of zero."""
        return _message(n, lat, lon, clock, loose)

    typed = F.when(n % 3 == 0, message(True)).otherwise(message(False))
    return event.select(
        n.alias("arrival"),
        F.col("ts").cast("timestamp").alias("received_at"),
        F.when(n % 23 == 0, F.substring(typed, 1, 20)).otherwise(typed).alias("value"),
    )


def _message(n, lat, lon, clock, loose):
    whole = "string" if loose else "bigint"
    return F.to_json(
        F.struct(
            F.when(n % 7 == 0, "ShipStaticData").otherwise("PositionReport").alias("MessageType"),
            F.struct(
                F.when(n % 17 != 0, F.col("user_id").cast(whole)).alias("MMSI"),
                F.concat(F.lit(" SHIP "), F.col("user_id").cast("string")).alias("ShipName"),
                lat.alias("latitude"),
                lon.alias("longitude"),
                F.when(n % 13 != 0, F.concat(clock, F.lit("789 +0000 UTC"))).alias("time_utc"),
            ).alias("MetaData"),
            F.struct(
                F.when(
                    n % 7 != 0,
                    F.struct(
                        F.when(n % 10 != 0, F.round(lat + 1, 6)).alias("Latitude"),
                        F.when(n % 10 != 0, lon).alias("Longitude"),
                        F.col("value").alias("Sog"),
                        (n % 17).cast("double" if loose else "bigint").alias("NavigationalStatus"),
                    ),
                ).alias("PositionReport"),
                F.when(
                    n % 7 == 0,
                    F.struct(
                        F.concat(F.lit("S "), F.col("event_type"), F.lit("  ")).alias("Name"),
                        (n % 100).cast(whole).alias("Type"),
                        F.struct((n % 200).alias("A"), (n % 90).alias("B")).alias("Dimension"),
                        F.struct(
                            F.when(n % 2 == 0, n % 12 + 1).alias("Month"),
                            F.when(n % 2 == 0, n % 28 + 1).alias("Day"),
                        ).alias("Eta"),
                    ),
                ).alias("ShipStaticData"),
            ).alias("Message"),
        )
    )


@query
def ais_positions_from_json(spark, sf):
    reports = ais.position_reports(ais.decode_messages(message_lines(spark, sf)))
    return reports.select(
        "arrival", "region", "mmsi", "ship_name", "latitude", "longitude", "sog",
        "navigational_status", "message_ts",
    )


@query
def ais_static_from_json(spark, sf):
    reports = ais.static_reports(ais.decode_messages(message_lines(spark, sf)))
    return reports.select("arrival", "mmsi", "ship_name", "ship_type", "eta_text", "dim_a", "dim_b")


@query
def region_for_position(spark, sf):
    messages = adapters.ais_messages(spark, sf)
    return messages.select(
        "snapshot_id",
        places.port_region(F.col("latitude"), F.col("longitude")).alias("region"),
    )


@query
def region_by_box_table(spark, sf):
    """Positions looked up in a table of boxes, one per customer, some large and many small."""
    n = F.col("c_custkey")
    south, west = F.round(48.8 + (n % 97) / 100.0, 6), F.round(-123.8 + (n % 113) / 100.0, 6)
    size = F.when(n % 50 == 0, 0.3).when(n % 3 == 0, 0.011).otherwise(0.004)
    table = adapters.table(spark, sf, "customer").select(
        F.concat(F.lit("box "), n.cast("string")).alias("region"),
        south.cast("double").alias("south"),
        west.cast("double").alias("west"),
        F.round(south + size, 6).cast("double").alias("north"),
        F.round(west + 2 * size, 6).cast("double").alias("east"),
        F.pmod(n * 7919, F.lit(1009)).alias("priority"),
    )
    messages = adapters.ais_messages(spark, sf).drop("region")
    return boxes.region_by_boxes(messages, table, "latitude", "longitude").select("snapshot_id", "region")


@query
def latest_position_per_window(spark, sf):
    return adapters.ais_positions(spark, sf)


@query
def vessel_static_upsert(spark, sf):
    """Latest record per snapshot, folded over time without losing values to nulls."""
    reports = latest.latest_per_key(
        static_history(spark, sf), ["snapshot_ts", "mmsi"], ["seen_at", "event_id"]
    )
    return incremental.fold_attributes(reports, "mmsi", STATIC_HISTORY_COLUMNS, ["snapshot_ts"])


@query
def vessel_static_merge(spark, sf):
    """The same upsert as one merge of two halves of the history."""
    reports = static_history(spark, sf)
    cut = at("2024-01-16 00:00:00")
    current = incremental.fold_attributes(
        reports.where(F.col("seen_at") < cut), "mmsi", STATIC_HISTORY_COLUMNS, ["seen_at", "event_id"]
    )
    changes = latest.latest_per_key(
        reports.where(F.col("seen_at") >= cut), ["mmsi"], ["seen_at", "event_id"]
    )
    return incremental.merge_attributes(
        current, changes, "mmsi", STATIC_HISTORY_COLUMNS, "seen_at"
    )


# --- expressions and staging -------------------------------------------------


@query
def clean_vessel_names(spark, sf):
    messages = adapters.ais_messages(spark, sf)
    return messages.select(
        "snapshot_id", "mmsi", text.blank_to_null(F.col("ship_name")).alias("ship_name")
    )


@query
def border_long(spark, sf):
    return waits(spark, sf)


@query
def archive_long(spark, sf):
    return history(spark, sf)


@query
def parse_delay_minutes(spark, sf):
    raw = adapters.archive_raw(spark, sf)
    return raw.select(
        "historical_id",
        delay.parse_delay_minutes(F.col("commercial_flow")).alias("commercial_minutes"),
        delay.parse_delay_minutes(F.col("travellers_flow")).alias("travellers_minutes"),
    )


@query
def delay_status(spark, sf):
    raw = adapters.archive_raw(spark, sf)
    return raw.select(
        "historical_id",
        delay.delay_status(F.col("commercial_flow")).alias("commercial_status"),
        delay.delay_status(F.col("travellers_flow")).alias("travellers_status"),
    )


@query
def local_to_utc(spark, sf):
    raw = adapters.archive_raw(spark, sf)
    return raw.select(
        "historical_id", timez.local_to_utc(F.col("updated_text")).alias("observed_at_utc")
    )


@query
def local_time_features(spark, sf):
    raw = adapters.archive_raw(spark, sf)
    parts = timez.local_parts(timez.local_to_utc(F.col("updated_text")))
    return raw.select("historical_id", *[c.alias(name) for name, c in parts.items()])


@query
def surrogate_key(spark, sf):
    messages = adapters.ais_messages(spark, sf)
    key = keys.surrogate_key(F.col("snapshot_ts"), F.col("region"), F.col("sog") > 0.5)
    return messages.select("snapshot_id", key.alias("key"))


@query
def nav_status_desc(spark, sf):
    messages = adapters.ais_messages(spark, sf)
    return messages.select(
        "snapshot_id",
        "navigational_status",
        vessel.nav_status_desc(F.col("navigational_status")).alias("nav_status_desc"),
    )


@query
def vessel_stationary(spark, sf):
    return positions(spark, sf).select("snapshot_id", "is_stationary", "status_speed_conflict")


@query
def vessel_category(spark, sf):
    return staging.stg_vessels(adapters.ship_static(spark, sf)).select(
        "mmsi", "ship_type", "vessel_category", "length_m", "beam_m", "destination"
    )


@query
def border_feed_lag(spark, sf):
    raw = adapters.border_raw(spark, sf)
    lag = timez.lag_minutes(
        F.col("fetched_at"), timez.local_to_utc(F.col("last_updated_text"))
    )
    return raw.select("observation_id", lag.alias("feed_lag_minutes"))


@query
def congestion_band(spark, sf):
    staged = history(spark, sf)
    return staged.groupBy(
        "crossing_name", delay.congestion_band(F.col("delay_minutes")).alias("congestion_band")
    ).agg(F.count("*").alias("readings"))


# --- marts -------------------------------------------------------------------


@query
def dim_crossings(spark, sf):
    return marts.dim_crossings(waits(spark, sf))


@query
def fct_border_waits(spark, sf):
    return border_facts(spark, sf)


@query
def dim_vessels(spark, sf):
    return marts.dim_vessels(positions(spark, sf), vessels(spark, sf))


@query
def fct_port_congestion(spark, sf):
    return congestion(spark, sf)


@query
def border_delay_profile(spark, sf):
    return marts.agg_border_delay_profile(history(spark, sf))


@query
def profile_from_stored_counts(spark, sf):
    """The profile after three loads of the archive, each counted once when it arrives."""
    house = Warehouse(spark, scratch_path(spark, "house"))
    source = house.table("raw", "hist_raw", partition="source_file")
    counts = house.table("analytics_staging", "profile_counts", partition="load_name")
    raw = adapters.archive_raw(spark, sf)
    part = F.pmod("historical_id", F.lit(3)).cast("string")
    for name in "102":
        source.replace(raw.withColumn("source_file", F.concat(F.lit("part-"), part)).where(part == name))
        profile = rollups.add_profile_counts(counts, source, staging.stg_border_waits_historical)
    return profile


@query
def distinct_vessels_by_region(spark, sf):
    """Vessels per region from daily sketches, beside the exact count; four standard errors count as close."""
    seen = adapters.ais_messages(spark, sf).select("region", "mmsi", F.to_date("message_ts").alias("day"))
    daily = pin(rollups.distinct_sketches(seen, ["day", "region"], "mmsi"), "daily-sketches")
    estimated = rollups.distinct_over(daily, ["region"], "estimate")
    exact = seen.groupBy("region").agg(F.count_distinct("mmsi").alias("vessels"))
    joined = exact.join(estimated, exact.region.eqNullSafe(estimated.region)).drop(estimated.region)
    off = F.abs(F.col("estimate") - F.col("vessels")) / F.col("vessels")
    return joined.select("region", "vessels", (off <= 4 * rollups.SKETCH_ERROR).alias("is_close"))


# --- serving -----------------------------------------------------------------


@query
def feed_freshness(spark, sf):
    return serving.feed_freshness(
        adapters.ais_messages(spark, sf), adapters.border_raw(spark, sf), as_of()
    )


@query
def latest_congestion(spark, sf):
    return serving.latest_congestion(congestion(spark, sf))


@query
def congestion_trend(spark, sf):
    return serving.congestion_trend(congestion(spark, sf), as_of(), TREND_DAYS)


@query
def congestion_pivot(spark, sf):
    return serving.congestion_pivot(congestion(spark, sf), as_of(), TREND_DAYS)


@query
def vessel_map_points(spark, sf):
    return serving.vessel_map_points(positions(spark, sf), vessels(spark, sf))


@query
def map_centre(spark, sf):
    return serving.map_centre(serving.vessel_map_points(positions(spark, sf), vessels(spark, sf)))


@query
def latest_border_waits(spark, sf):
    return serving.latest_border_waits(border_facts(spark, sf))


@query
def border_hourly_trend(spark, sf):
    trend = serving.border_hourly_trend(waits(spark, sf), as_of(), TREND_DAYS)
    return trend.withColumn("avg_delay_minutes", F.round("avg_delay_minutes", 6))


@query
def ranked_crossings(spark, sf):
    return serving.ranked_crossings(serving.latest_border_waits(border_facts(spark, sf)))


@query
def border_headline(spark, sf):
    return serving.border_headline(serving.latest_border_waits(border_facts(spark, sf)))


@query
def busiest_crossings_hourly(spark, sf):
    trend = serving.border_hourly_trend(waits(spark, sf), as_of(), TREND_DAYS)
    return serving.busiest_crossings_hourly(trend).withColumn(
        "avg_delay_minutes", F.round("avg_delay_minutes", 6)
    )


@query
def border_pivot(spark, sf):
    trend = serving.border_hourly_trend(waits(spark, sf), as_of(), TREND_DAYS)
    wide = serving.border_pivot(trend)
    return wide.withColumns({c: F.round(c, 6) for c in wide.columns if c.startswith("delay_")})


@query
def crossing_names(spark, sf):
    return serving.crossing_names(waits(spark, sf))


# --- incremental -------------------------------------------------------------


@query
def incremental_slice(spark, sf):
    staged = waits(spark, sf)
    target = staged.where(F.col("fetched_at") <= at("2024-01-15 10:00:00"))
    return incremental.newer_than(staged, target, "fetched_at").select(
        "wait_observation_key", "fetched_at", "delay_minutes"
    )


@query
def upsert_by_key(spark, sf):
    """Rows to 20 January, replaced and extended by revised rows from the 10th on."""
    staged = waits(spark, sf).select("wait_observation_key", "fetched_at", "delay_status")
    old = staged.where(F.col("fetched_at") < at("2024-01-20 00:00:00"))
    new = staged.where(F.col("fetched_at") >= at("2024-01-10 00:00:00")).withColumn(
        "delay_status", F.concat(F.lit("revised "), "delay_status")
    )
    return incremental.replace_by_key(old, new, ["wait_observation_key"])


@query
def incremental_border_build(spark, sf):
    """Fact table stored in two runs of the incremental build."""
    house = Warehouse(spark, scratch_path(spark, "house"))
    raw = adapters.border_raw(spark, sf)
    warehouse.build_border(house, raw.where(F.col("fetched_at") < at("2024-01-15 00:00:00")))
    facts = warehouse.build_border(house, raw)
    return facts.select(
        "wait_observation_key", "crossing_key", "region_group", "fetched_at", "delay_minutes",
        "feed_lag_minutes", "congestion_band",
    )


@query
def versioned_border_build(spark, sf):
    """Facts from a raw table that grows by three loads whose times overlap, built after each."""
    house = Warehouse(spark, scratch_path(spark, "house"))
    raw = house.table("raw", "border_raw", "observation_id")
    rows = adapters.border_raw(spark, sf).withColumn("day", F.to_date("fetched_at"))
    for part in (2, 0, 1):
        raw.replace(rows.where(F.pmod("observation_id", F.lit(3)) == part))
        facts = warehouse.build_border(house, raw)
    return facts.select("wait_observation_key", "fetched_at", "delay_minutes", "feed_lag_minutes", "congestion_band")


@query
def crossings_reloaded(spark, sf):
    """The crossing table truncated and reloaded, then read as a Spark source."""
    staged, path = waits(spark, sf), scratch_path(spark, "crossings")
    for rows in (staged.where(F.col("fetched_at") < at("2024-01-10 00:00:00")), staged):
        replace_table(marts.dim_crossings(rows), path)
    return read_source(spark, "parquet", current_path(spark, path))


# --- streaming ---------------------------------------------------------------


def event_stream(spark, sf):
    schema = adapters.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def closed_event_stream(spark, sf):
    """Events and one far later row, behind which all their windows are closed."""
    events = event_stream(spark, sf)
    path = scratch_path(spark, "closing")
    row = spark.sql("select timestamp_ntz'2100-01-01 00:00:00' as ts")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema if f.name != "ts"]
    row.select(F.col("ts").cast(events.schema["ts"].dataType), *nulls).select(*events.columns).write.parquet(path)
    return events.unionByName(spark.readStream.schema(events.schema).parquet(path))


def _drain(spark, stream, label):
    out = scratch_path(spark, label)
    run.append_available(stream, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def _latest_stream(spark, sf):
    reports = adapters.ais_messages(spark, sf, closed_event_stream(spark, sf)).drop("snapshot_ts")
    return ais_stream.latest_positions(
        reports.withColumnRenamed("message_ts", "received_at").withColumn(
            "message_ts", F.col("received_at")
        ),
        order=["message_ts", "snapshot_id"],
    )


@query
def stream_latest_positions(spark, sf):
    latest_rows = _latest_stream(spark, sf).select(
        F.col("window.start").alias("window_start"), "mmsi", "snapshot_id", "region", "sog",
        "message_ts",
    )
    return _drain(spark, latest_rows, "latest")


@query
def stream_port_congestion(spark, sf):
    return _drain(
        spark,
        ais_stream.port_congestion(_latest_stream(spark, sf), vessels(spark, sf)),
        "congestion",
    )


@query
def stream_congestion_by_batch(spark, sf):
    """Congestion of closed windows with the vessel table as each batch finds it."""
    out = scratch_path(spark, "congestion")
    known = pin(vessels(spark, sf), "vessels")
    writer = ais_stream.congestion_writer(f"{out}/rows", lambda session: known)
    (
        _latest_stream(spark, sf)
        .writeStream.foreachBatch(writer)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{out}/rows").drop("batch")


@query
def stream_border_waits(spark, sf):
    """Readings sent twice, staged once."""
    raw = spark.sql(adapters.BORDER_RAW_SQL, events=event_stream(spark, sf))
    twice = raw.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    staged = border_stream.staged_waits(twice).select(
        "wait_observation_key", "fetched_at", "crossing_name", "delay_minutes", "delay_status",
        "cbsa_updated_at_utc",
    )
    return _drain(spark, staged, "waits")


@query
def stream_vessel_static(spark, sf):
    reports = spark.sql(STATIC_HISTORY_SQL, events=event_stream(spark, sf))
    for name, kind in {
        "imo_number": "bigint", "call_sign": "string", "eta_text": "string", "dim_a": "int",
        "dim_b": "int", "dim_c": "int", "dim_d": "int",
    }.items():
        reports = reports.withColumn(name, F.lit(None).cast(kind))
    out = scratch_path(spark, "static")
    merger = ais_stream.static_merger(f"{out}/state", "snapshot_ts", ["seen_at", "event_id"])
    stream = (
        reports.writeStream.foreachBatch(merger)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return ais_stream.static_state(spark, f"{out}/state").select(
        "mmsi", *STATIC_HISTORY_COLUMNS, "first_seen_at", "last_seen_at"
    )


@query
def stream_vessel_state(spark, sf):
    """The same attributes as keyed state, a batch writing its own vessels only."""
    reports = spark.sql(STATIC_HISTORY_SQL, events=event_stream(spark, sf))
    out = scratch_path(spark, "vessels")
    stream = vessel_state.vessel_attributes(
        reports, "snapshot_ts", ["seen_at", "event_id"], "1 hour", STATIC_HISTORY_COLUMNS
    )
    (
        stream.writeStream.outputMode("update")
        .foreachBatch(vessel_state.change_writer(f"{out}/changes"))
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return vessel_state.newest_attributes(spark, f"{out}/changes")


@query
def late_border_rows(spark, sf):
    """Readings behind the watermark, counted batch by batch (R5): all, after one from far later."""
    raw = adapters.border_raw(spark, sf)
    landed, out = scratch_path(spark, "landed"), scratch_path(spark, "late")
    listener = run.LateRows(spark, f"{out}/counts")
    spark.streams.addListener(listener)
    later = raw.groupBy().agg(*[F.max(c).alias(c) for c in raw.columns]).withColumn("fetched_at", at("2100-01-01 00:00:00"))
    try:
        for rows in (later, later.withColumn("observation_id", F.lit(-1)), raw):
            rows.select([F.col(f.name).cast(f.dataType) for f in raw.schema]).write.mode("append").parquet(landed)
            stream = border_stream.staged_waits(spark.readStream.schema(raw.schema).parquet(landed))
            ended = run.append_available(stream.select("wait_observation_key"), f"{out}/rows", f"{out}/checkpoint")
            counts = pin(listener.counts(ended), "counts")
    finally:
        spark.streams.removeListener(listener)
    return counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("late_rows"))


# --- assertions --------------------------------------------------------------


def _union(parts):
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def check_unique(spark, sf):
    border = adapters.border_raw(spark, sf)
    return _union(
        [
            quality.check_unique(border, "observation_id"),
            quality.check_unique(border, "last_updated_text"),
            quality.check_unique(adapters.archive_raw(spark, sf), "historical_id"),
            quality.check_unique(adapters.ais_positions(spark, sf), "snapshot_id"),
            quality.check_unique(adapters.ship_static(spark, sf), "mmsi"),
        ]
    )


@query
def check_not_null(spark, sf):
    rules = [quality.not_null(c) for c in ("historical_id", "customs_office", "commercial_flow")]
    return quality.check_rows(adapters.archive_raw(spark, sf), rules)


@query
def check_accepted_values(spark, sf):
    rules = [
        quality.accepted_values("traffic_type", warehouse.TRAFFIC_TYPES),
        quality.accepted_values("delay_status", delay.LIVE_DELAY_STATUSES),
    ]
    return quality.check_rows(history(spark, sf), rules)


@query
def check_accepted_range(spark, sf):
    rules = [
        quality.accepted_range("delay_minutes", 0, 40, severity="warn"),
        quality.accepted_range("local_hour_pt", 0, 23),
        quality.accepted_range("local_dow_pt", 1, 5),
    ]
    return quality.check_rows(history(spark, sf), rules)


@query
def check_parsed_times(spark, sf):
    """Update times of the archive, every seventh of them malformed."""
    raw = adapters.archive_raw(spark, sf)
    malformed = F.concat(F.lit("x"), "updated_text")
    given = F.when(F.col("historical_id") % 7 == 0, malformed).otherwise(F.col("updated_text"))
    times = raw.select(given.alias("updated_text")).withColumn(
        "observed_at_utc", timez.local_to_utc(F.col("updated_text"))
    )
    return quality.check_rows(times, [quality.parsed("updated_text", "observed_at_utc")])


@query
def check_relationships(spark, sf):
    parents = vessels(spark, sf).select("mmsi")
    return quality.check_relationships(positions(spark, sf), parents, "mmsi", "mmsi")


@query
def source_freshness(spark, sf):
    return _union(
        [
            quality.source_freshness(
                adapters.border_raw(spark, sf), "border_raw", "fetched_at", as_of()
            ),
            quality.source_freshness(
                adapters.ais_messages(spark, sf), "ais_positions", "snapshot_ts", as_of()
            ),
        ]
    )


@query
def border_fact_assertions(spark, sf):
    staged = waits(spark, sf)
    crossings = pin(marts.dim_crossings(staged), "dim_crossings")
    facts = pin(marts.fct_border_waits(staged, crossings), "facts")
    return quality.run_checks(facts, warehouse.mart_checks(crossings)["fct_border_waits"])


@query
def profile_assertions(spark, sf):
    profile = pin(marts.agg_border_delay_profile(history(spark, sf)), "profile")
    checks = warehouse.mart_checks(profile)["agg_border_delay_profile"]
    return quality.run_checks(profile, checks)


# --- model -------------------------------------------------------------------


@query
def temporal_split_counts(spark, sf):
    cells = pin(model.delay_cells(history(spark, sf)), "cells")
    cells = model.with_side(cells, TRAIN_MAX_YEAR, TEST_YEAR)
    return model.by_side(cells, F.coalesce(F.sum("n"), F.lit(0)).alias("readings"))


@query
def model_features(spark, sf):
    """Features of every live cell; crossings unknown to training get code -1."""
    train, _ = split_cells(spark, sf)
    live = model.delay_cells(waits(spark, sf)).select(*model.CELL).distinct()
    features = model.with_features(live, model.crossing_codes(train))
    smooth = [c for c in model.FEATURES if c.endswith(("_sin", "_cos"))]
    return features.select(
        "crossing_name",
        *[c for c in model.FEATURES if c not in smooth],
        *[F.round(c, 6).alias(c) for c in smooth],
    )


@query
def lookup_baseline(spark, sf):
    train, test = split_cells(spark, sf)
    scored = model.lookup_baseline(train, test)
    return scored.withColumn("baseline", F.round("baseline", 6))


def _baseline_scored(spark, sf):
    train, test = split_cells(spark, sf)
    scored = model.lookup_scores(train, test)
    return scored.withColumn("delayed", F.col("delay_minutes") > 0)


@query
def baseline_roc_auc(spark, sf):
    ranks = metrics.rank_metrics(_baseline_scored(spark, sf), "baseline", "delayed", "n")
    return ranks.select(F.round("roc_auc", 6).alias("roc_auc"), "positives", "n_rows")


@query
def baseline_pr_auc(spark, sf):
    ranks = metrics.rank_metrics(_baseline_scored(spark, sf), "baseline", "delayed", "n")
    return ranks.select(
        F.round("average_precision", 6).alias("average_precision"), "positives", "n_rows"
    )


@query
def baseline_brier(spark, sf):
    score = metrics.brier(F.col("probability"), F.col("delayed"), F.col("n"))
    return _baseline_scored(spark, sf).agg(F.round(score, 6).alias("brier"))


@query
def baseline_mae(spark, sf):
    error = metrics.mean_absolute_error(F.col("baseline"), F.col("delay_minutes"), F.col("n"))
    return _baseline_scored(spark, sf).agg(F.round(error, 6).alias("mae_minutes"))


@query
def delayed_share(spark, sf):
    cells = pin(model.delay_cells(history(spark, sf)), "cells")
    cells = model.with_side(cells, TRAIN_MAX_YEAR, TEST_YEAR)
    share = metrics.weighted_mean((F.col("delay_minutes") > 0).cast("double"), F.col("n"))
    return model.by_side(cells, F.round(share, 6).alias("delayed_share"))


@query
def drift_metrics(spark, sf):
    train, _ = split_cells(spark, sf)
    live = pin(model.delay_cells(waits(spark, sf)), "live")
    drift = model.drift_metrics(model.lookup_baseline(train, live))
    return drift.withColumn("value", F.round("value", 6))


@query
def grid_cells(spark, sf):
    train, _ = split_cells(spark, sf)
    return model.prediction_grid(model.crossing_codes(train))


def _lookup_grid(spark, sf):
    train, _ = split_cells(spark, sf)
    grid = model.prediction_grid(model.crossing_codes(train))
    scored = model.lookup_scores(train, grid, "expected_delay_minutes", "delay_probability")
    return scored.drop("month_of_year")


@query
def peak_hour(spark, sf):
    """Peak hours of the grid scored by the lookup baseline."""
    peaks = serving.peak_hour(_lookup_grid(spark, sf))
    return peaks.withColumns(
        {c: F.round(c, 6) for c in ("expected_delay_minutes", "delay_probability")}
    )


@query
def expected_delay_curve(spark, sf):
    curve = serving.expected_delay_curve(_lookup_grid(spark, sf), "Office 3", 3)
    return curve.withColumns(
        {c: F.round(c, 6) for c in ("expected_delay_minutes", "delay_probability")}
    )


@query
def lookup_holdout_metrics(spark, sf):
    """The metric table of the hurdle's formula over looked-up stages."""
    train, test = split_cells(spark, sf)
    scored = model.lookup_scores(train, test, "baseline", "delay_probability")
    expected = model.hurdle_minutes(F.col("delay_probability"), F.log1p("baseline"))
    scored = scored.withColumn("expected_delay_minutes", expected)
    metric_rows = model.holdout_metrics(scored, model.holdout_name(TEST_YEAR))
    return metric_rows.withColumn("value", F.round("value", 6))


@query
def lookup_summary(spark, sf):
    """Summary of looked-up scores, made half a day before it is read (V9)."""
    train, test = split_cells(spark, sf)
    scored = model.lookup_scores(train, test, "baseline", "delay_probability")
    expected = model.hurdle_minutes(F.col("delay_probability"), F.log1p("baseline"))
    live = pin(model.delay_cells(waits(spark, sf)), "live")
    holdout = model.holdout_name(TEST_YEAR)
    metric_rows = model.holdout_metrics(scored.withColumn("expected_delay_minutes", expected), holdout)
    metric_rows = metric_rows.unionByName(model.drift_metrics(model.lookup_baseline(train, live)))
    metric_rows = metric_rows.withColumn("evaluated_at", at("2024-01-30 11:53:00"))
    row = serving.model_summary(metric_rows, holdout, model.LIVE, as_of())
    return row.withColumns({c: F.round(c, 6) for c in row.columns if c not in ("retrained_at", "age_label")})


_HURDLES: dict[tuple, tuple] = {}


def _hurdle(spark, sf):
    """Cells of the archive and the hurdle model, counted and trained once per session and files."""
    read = files.landed_files(spark, f"{sf}/lineitem.parquet").orderBy("path").collect()
    key = (spark.sparkContext.applicationId, *[tuple(row) for row in read])
    if key not in _HURDLES:
        cells = pin(model.delay_cells(history(spark, sf)), "cells")
        _HURDLES.clear()
        _HURDLES[key] = (cells, model.fit_hurdle(model.temporal_split(cells, TRAIN_MAX_YEAR, TEST_YEAR)[0]))
    return _HURDLES[key]


@query
def prediction_grid(spark, sf):
    return model.grid_predictions(_hurdle(spark, sf)[1])


@query
def hurdle_holdout_metrics(spark, sf):
    cells, hurdle = _hurdle(spark, sf)
    train, test = model.temporal_split(cells, TRAIN_MAX_YEAR, TEST_YEAR)
    scored = model.lookup_baseline(train, hurdle.predict(test))
    return model.holdout_metrics(scored, model.holdout_name(TEST_YEAR))


@query
def model_summary(spark, sf):
    cells, hurdle = _hurdle(spark, sf)
    metric_rows, _ = model.train_and_score(
        history(spark, sf), waits(spark, sf), train_max_year=TRAIN_MAX_YEAR, test_year=TEST_YEAR,
        fitted=hurdle, cells=cells,
    )
    return serving.model_summary(
        metric_rows, model.holdout_name(TEST_YEAR), model.LIVE, F.current_timestamp()
    )
