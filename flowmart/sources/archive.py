"""Border archive: quarterly CSV files, a manifest and a load ledger."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowmart.functions.text import strip_to_null
from flowmart.session import Scratch, pin
from flowmart.sources.files import EmptyLoad, landed_files
from flowmart.sources.ids import row_id
from flowmart.sources.schemas import LEDGER
from flowmart.sources.versions import VersionedTable

# What the header of a usable file contains.
HEADER_MARKERS = ("office", "location", "updated")
ARCHIVE_COLUMNS = (
    "customs_office",
    "location",
    "updated_text",
    "commercial_flow",
    "travellers_flow",
)


def basename(url):
    """Last path segment of a URL column."""
    return F.substring_index(url, "/", -1)


def _decoded(name: Column) -> Column:
    """A file's or folder's name without escapes."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def archive_manifest(
    urls: DataFrame, from_year: int | None = None, to_year: int | None = None
) -> DataFrame:
    """English CSV files of a `url` table with their earliest year.

    A year range drops files without a year in the name. Ordered by year, then
    url, undated files first.
    """
    url = strip_to_null(F.col("url"))
    years = F.transform(
        F.regexp_extract_all("url", F.lit(r"(20\d{2})"), F.lit(1)), lambda y: y.cast("int")
    )
    files = (
        urls.select(url.alias("url"))
        .where(F.lower("url").endswith(".csv"))
        .where(~F.lower("url").rlike(r"-(fra|fr)\.csv\z"))
        .select("url", F.array_min(years).alias("year"), basename(F.col("url")).alias("source_file"))
    )
    if from_year:
        files = files.where(F.col("year") >= from_year)
    if to_year:
        files = files.where(F.col("year") <= to_year)
    return files.orderBy(F.coalesce("year", F.lit(0)), "url")


def pending_files(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Manifest rows whose file is not in the ledger yet."""
    return manifest.join(ledger.select("source_file"), "source_file", "left_anti")


def read_archive_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """CSV records with their file, cells and width, numbered as they follow one another in a file.

    A quarterly file is one task, as a quoted cell may hold line breaks. Blank lines are no
    records. Short and long records land in the corrupt-record column; their cells are
    counted from the text with quoted stretches removed.
    """
    names = [f"c{i}" for i in range(len(ARCHIVE_COLUMNS))]
    spec = ", ".join(f"{name} string" for name in (*names, "_bad"))
    options = {"multiLine": True, "quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}
    rows = spark.read.schema(spec).options(**options).csv(paths)
    # An open quote takes what is left of its file.
    unquoted = F.regexp_replace("_bad", r'"[^"]*(?:"|\z)', "")
    width = F.when(F.col("_bad").isNull(), F.lit(len(names))).otherwise(F.size(F.split(unquoted, ",", -1)))
    return rows.select(
        F.col("_metadata.file_path").alias("_file"),
        F.monotonically_increasing_id().alias("_position"),
        width.alias("_width"),
        *[strip_to_null(F.col(c)).alias(target) for c, target in zip(names, ARCHIVE_COLUMNS)],
        F.when(width > len(names), F.lower("_bad")).alias("_long_text"),
    )


def split_archive_rows(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Data rows of usable files, and one (_file, source_file, usable) row per file.

    A file is usable if its very first record is a wait-time header. Files are
    told apart by their whole path; `source_file` is the last part of it.
    """
    texts = F.concat_ws("\n", *[F.lower(c) for c in ARCHIVE_COLUMNS], "_long_text")
    header_like = F.col("_width") >= len(ARCHIVE_COLUMNS)
    for marker in HEADER_MARKERS:
        header_like = header_like & texts.contains(marker)
    files = rows.groupBy("_file").agg(
        F.min("_position").alias("_header"),
        F.coalesce(F.min_by(header_like, "_position"), F.lit(False)).alias("usable"),
    )
    files = scratch.pin(files.withColumn("source_file", _decoded(basename(F.col("_file")))), "files")
    data = rows.join(files.where("usable"), "_file").where(
        (F.col("_position") > F.col("_header")) & (F.col("_width") >= len(ARCHIVE_COLUMNS))
    )
    raw = data.select(
        row_id(F.col("_file"), F.col("_position") - F.col("_header")).alias("historical_id"),
        "source_file",
        *ARCHIVE_COLUMNS,
        F.current_timestamp().alias("ingested_at"),
    )
    return raw, files.select("_file", "source_file", "usable")


def _archive_rows(spark: SparkSession, paths: list[str], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    # Pinned: the numbers of the records must not change between the two uses.
    return split_archive_rows(scratch.pin(read_archive_records(spark, paths), "records"), scratch)


def load_archive(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Raw archive rows of the files that have the wait-time header (S3).

    Rows without an office are kept apart by `archive_quarantine`.
    """
    return _loaded(spark, paths, F.col("customs_office").isNotNull())


def archive_quarantine(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows `load_archive` leaves out because the office cell is empty."""
    return _loaded(spark, paths, F.col("customs_office").isNull())


def _loaded(spark: SparkSession, paths: list[str], wanted: Column) -> DataFrame:
    with Scratch(spark) as scratch:
        raw, _ = _archive_rows(spark, paths, scratch)
        return pin(raw.where(wanted), "archive")


def archive_table(spark: SparkSession, path: str) -> VersionedTable:
    """The loaded archive, a partition per file; what it holds is its ledger."""
    return VersionedTable(spark, path, partition="source_file")


def load_ledger(table: VersionedTable, commit: int | None = None) -> DataFrame:
    """(source_file, row_count, loaded_at) of the files a table has, those without rows included.

    With `commit`, of the files that commit brought.
    """
    entries = [e for e in table.entries(commit) if commit is None or e.commit == commit]
    rows = [(e.folder.removeprefix("source_file="), e.rows, e.loaded_at) for e in entries]
    return table.spark.createDataFrame(rows, LEDGER).withColumn("source_file", _decoded(F.col("source_file")))


def backfill(spark: SparkSession, manifest: DataFrame, path: str) -> DataFrame:
    """Load pending files into the archive table at `path`; returns their ledger rows.

    Rows and ledger change in one commit, so a file is loaded as a whole or not at all, and
    of two loaders of one manifest the later one leaves out what the other has loaded. Files
    of another schema are not recorded, are named in a warning, and are looked at again.
    Empty files fail the run when the others are loaded and recorded; two pending
    files of one name fail it before anything is loaded.
    """
    table = archive_table(spark, path)
    pending = pending_files(manifest, load_ledger(table))
    double = pending.groupBy("source_file").count().where("count > 1").first()
    if double is not None:
        raise ValueError(f"{double['count']} pending files are called {double.source_file}")
    # The list of files to scan, which any Spark read keeps on the driver.
    paths = [row.url for row in pending.select("url").collect()]
    if not paths:
        return spark.createDataFrame([], LEDGER)
    landed = landed_files(spark, *paths)
    empty = sorted(row.path for row in landed.where("bytes = 0").collect())
    full = [row.path for row in landed.where("bytes > 0").select("path").collect()]
    loaded = _backfilled(spark, full, table) if full else spark.createDataFrame([], LEDGER)
    if empty:
        raise EmptyLoad(f"{empty[0]} is empty" + (f", {len(empty) - 1} more are" if empty[1:] else ""))
    return loaded


def _backfilled(spark: SparkSession, paths: list[str], table: VersionedTable) -> DataFrame:
    with Scratch(spark) as scratch:
        raw, files = _archive_rows(spark, paths, scratch)
        # A name per usable file, as many as the scan has files.
        usable = [row.source_file for row in files.where("usable").select("source_file").collect()]
        commit = table.add_partitions(raw.where(F.col("customs_office").isNotNull()), usable)
        skipped = [row.source_file for row in files.where("not usable").select("source_file").limit(6).collect()]
        if skipped:
            more = "" if len(skipped) < 6 else " and more"
            warnings.warn(f"files of another schema were skipped: {', '.join(skipped[:5])}{more}", stacklevel=3)
    return load_ledger(table, commit)
