"""Live border feed: `;;`-delimited text, one small file per fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from flowmart.functions.text import strip_space
from flowmart.operators.incremental import read_if_exists
from flowmart.session import Scratch
from flowmart.sources.files import (
    EmptyLoad,
    few_tasks,
    is_packed,
    landed_files,
    located_files,
    refuse_empty_files,
    scanned_files,
)
from flowmart.sources.ids import row_id
from flowmart.sources.schemas import FEED_LEDGER
from flowmart.sources.versions import FEW_KEYS, VersionedTable

# The shape of the feed.
DELIMITER = ";;"
HEADER_WORDS = "customs office"
FEED_COLUMNS = (
    "customs_office",
    "location",
    "last_updated_text",
    "commercial_canada_bound",
    "commercial_us_bound",
    "travellers_canada_bound",
    "travellers_us_bound",
)

_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"


def read_feed_files(
    spark: SparkSession, *paths: str, listed: DataFrame | None = None, packed: bool = True, **options: str
) -> DataFrame:
    """Landed fetches as (source_file, landed_at, body), one row per file.

    A fetch is one reading of each crossing, some thirty lines, so a file is a
    small value; Spark packs many files into one task. The text source sets up a
    reader of its own for each file, which takes five times as long as its bytes, so
    only files it has to unpack go through it; without any, say `packed=False`.
    `options` are the scan's; `listed` is a scan of the same paths made before, which
    spares another listing.
    """
    if listed is None:
        listed = scanned_files(spark, *paths, **options)
    name = F.col("_metadata.file_path")
    head = [name.alias("source_file"), F.col("_metadata.file_modification_time").alias("landed_at")]
    body = F.col("content").cast("string").alias("body")
    if not packed:
        return listed.select(*head, body)
    texts = spark.read.options(**options).text(list(paths), wholetext=True)
    unpacked = texts.where(is_packed(spark, name)).select(*head, F.col("value").alias("body"))
    return listed.where(~is_packed(spark, name)).select(*head, body).unionByName(unpacked)


def stream_feed_files(spark: SparkSession, path: str) -> DataFrame:
    """`read_feed_files` over a folder that keeps receiving files."""
    return spark.readStream.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("value").alias("body"),
    )


def feed_lines(files: DataFrame, strict: bool = True) -> DataFrame:
    """Fetch bodies to data lines with their cells and a `malformed` flag.

    A body without the expected header (or without lines) fails the job when
    `strict`; otherwise it yields no rows. Blank lines vanish, the rest keep
    their position after the header as `line_no`.
    """
    text = F.regexp_replace("body", r"\A\x{FEFF}+", "")
    trimmed = F.transform(F.split(text, _LINE_BREAK), strip_space)
    lines = F.filter(trimmed, lambda line: line != "")
    first_cell = F.lower(F.split_part(F.element_at("lines", 1), F.lit(DELIMITER), F.lit(1)))
    usable = F.coalesce((F.size("lines") > 0) & first_cell.contains(HEADER_WORDS), F.lit(False))
    data = F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))
    refused: Column = (
        F.raise_error(F.concat(F.lit("no feed header in "), F.col("source_file")))
        if strict
        else F.lit(None)
    ).cast("array<string>")
    # Through a generator, below which the test that the next one has rows is not pushed; else
    # every body is cut into lines once more there.
    bodies = files.select("source_file", "landed_at", F.stack(F.lit(1), lines).alias("lines"))
    bodies = bodies.withColumn("data", F.when(usable, data).otherwise(refused))
    parts = F.split("line", DELIMITER, -1)
    return (
        bodies.select("source_file", "landed_at", F.posexplode("data").alias("line_no", "line"))
        .withColumn("cells", F.transform(parts, strip_space))
        .withColumn("malformed", F.size(parts) < len(FEED_COLUMNS))
    )


def parse_feed(lines: DataFrame, fetched_at: Column | None = None) -> DataFrame:
    """Well-formed lines as raw border rows; cells beyond the seventh are ignored.

    Every row of a file gets the same `fetched_at` (S2): the given value, or the
    time the file landed.
    """
    stamp = F.col("landed_at") if fetched_at is None else fetched_at
    return lines.where(~F.col("malformed")).select(
        row_id(F.col("source_file"), F.col("line_no")).alias("observation_id"),
        stamp.cast("timestamp").alias("fetched_at"),
        *[F.col("cells")[i].alias(name) for i, name in enumerate(FEED_COLUMNS)],
        F.current_timestamp().alias("ingested_at"),
    )


def load_border_feed(
    spark: SparkSession, *paths: str, strict: bool = True, fetched_at: Column | None = None
) -> DataFrame:
    """Raw border rows of landed feed files (S1); an empty file is an error."""
    refuse_empty_files(landed_files(spark, *paths))
    return parse_feed(feed_lines(read_feed_files(spark, *paths), strict), fetched_at)


def append_fetch(
    spark: SparkSession,
    table_path: str,
    ledger_path: str,
    *paths: str,
    fetched_at: Column | None = None,
) -> dict[str, int]:
    """Store landed files that are not stored yet, by day.

    The ledger names the files that are; a file is told by its path and landing
    time. Rows are parsed and counted before anything is written: an empty file,
    or new files without a row, are an error that leaves no trace (Q8). A load
    that broke off before its ledger rows replaces its own rows when repeated.
    Returns the numbers of rows written and of malformed lines skipped.
    """
    ledger = read_if_exists(spark, ledger_path)
    known = spark.createDataFrame([], FEED_LEDGER) if ledger is None else ledger
    with Scratch(spark) as scratch:
        listed = scanned_files(spark, *paths, recursiveFileLookup="true")
        landed = scratch.pin(located_files(spark, *paths, listed=listed), "landed")
        # Merged: names compress so well that Spark would broadcast hundreds of thousands.
        unknown = landed.join(known.hint("merge"), ["path", "landed_at"], "left_anti")
        fresh = scratch.pin(unknown, "fresh")
        refuse_empty_files(fresh)
        new = fresh.agg(
            F.unix_micros(F.min("landed_at")).alias("first"),
            F.count("*").alias("files"),
            F.sum("bytes").alias("bytes"),
            F.coalesce(F.max(is_packed(spark, F.col("source_file"))), F.lit(False)).alias("packed"),
        ).first()
        if new.first is None:
            return {"rows": 0, "malformed": 0}
        # The scan opens no file that landed before the first new one.
        since = F.col("landed_at") >= F.timestamp_micros(F.lit(new.first))
        files = read_feed_files(spark, *paths, listed=listed, packed=new.packed, recursiveFileLookup="true")
        files = few_tasks(files.where(since), new.files, new.bytes)
        if landed.where(since).count() > new.files:  # files collected before are among them
            names = fresh.select("source_file")
            files = files.join(names.hint("merge") if new.files > FEW_KEYS else names, "source_file", "left_semi")
        seen = Observation("feed")
        lines = feed_lines(files).observe(
            seen,
            F.count_if(~F.col("malformed")).alias("rows"),
            F.count_if("malformed").alias("malformed"),
        )
        rows = parse_feed(lines, fetched_at).withColumn("day", F.to_date("fetched_at"))
        rows = scratch.pin(rows, "feed")
        counts = seen.get
        if not counts["rows"]:
            raise EmptyLoad("no border rows in the landed files")
        VersionedTable(spark, table_path, ["observation_id"]).replace(rows)
        loaded = scratch.pin(fresh.select("path", "landed_at", F.current_timestamp().alias("loaded_at")), "files")
        loaded.write.mode("append").parquet(ledger_path)
    return counts
