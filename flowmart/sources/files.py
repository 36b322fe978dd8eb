"""Checks on landed files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Small files a task scans, and bytes: a task per few files takes longer than their scan.
FILES_PER_TASK, BYTES_PER_TASK = 1_000, 16 << 20


class EmptyLoad(RuntimeError):
    """A load that would have written no rows."""


def landed_files(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, bytes, landed_at) of each file and of each file below a folder.

    Spark lists them, in tasks where they are many; their content is not read.
    Names starting with `_` or `.` are not data. A scan leaves files without
    bytes out, so these are taken from the listing, which Spark's driver holds.
    """
    return located_files(spark, *paths).drop("source_file")


def scanned_files(spark: SparkSession, *paths: str, **options: str) -> DataFrame:
    """Scan of landed files as Spark's binary source gives them; the files are listed here, once."""
    return spark.read.format("binaryFile").options(**options).load(list(paths))


def few_tasks(scan: DataFrame, files: int, size: int = 0) -> DataFrame:
    """A scan of so many files, and bytes to read, without a task for every few of them."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.coalesce(max(cores, files // FILES_PER_TASK, size // BYTES_PER_TASK))


def is_packed(spark: SparkSession, name: Column) -> Column:
    """Whether the text source unpacks a file of this name: whether a Hadoop codec has its ending."""
    settings, hadoop = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop
    codecs = hadoop.io.compress.CompressionCodecFactory.getCodecClasses(settings)
    made = [hadoop.util.ReflectionUtils.newInstance(codec, settings) for codec in codecs]
    return name.rlike("|".join(sorted(f"{re.escape(codec.getDefaultExtension())}$" for codec in made)))


def located_files(spark: SparkSession, *paths: str, listed: DataFrame | None = None) -> DataFrame:
    """`landed_files` with `source_file`, the path as other scans name it (null without bytes).

    `listed` is a scan of the paths and of folders below them, if there is one.
    """
    files = scanned_files(spark, *paths, recursiveFileLookup="true") if listed is None else listed
    number = len(files._jdf.inputFiles())
    full = few_tasks(files, number).select(
        "path",
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("landed_at"),
        F.col("_metadata.file_path").alias("source_file"),
    )
    # Python fetches the listing name by name, so only where the scan has left files out.
    if number == full.count():
        return full
    names = spark.createDataFrame([(name,) for name in files.inputFiles()], "name string")
    plain = F.url_decode(F.replace("name", F.lit("+"), F.lit("%2B")))
    names = names.select(F.regexp_replace(plain, "^([a-z0-9]+):/+(?=[^/])", "$1:/").alias("_key"), plain.alias("_path"))
    full = full.withColumn("_key", F.regexp_replace("path", "^([a-z0-9]+):/+(?=[^/])", "$1:/"))
    return names.join(full, "_key", "left").select(
        F.coalesce("path", "_path").alias("path"),
        F.coalesce("bytes", F.lit(0).cast("bigint")).alias("bytes"),
        "landed_at",
        "source_file",
    )


def refuse_empty_files(files: DataFrame) -> None:
    """Fail when a landed file has no bytes; a scan would skip it without a word."""
    empty = files.where("bytes = 0").first()
    if empty is not None:
        raise EmptyLoad(f"{empty.path} is empty")
