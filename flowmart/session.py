"""Session settings and the shared folder every job relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Wall-clock arithmetic, surrogate keys and calendar parts assume UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: coalesced shuffles, checked broadcasts, skew splits.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What a task reads bounds the rows it sorts or buffers; tables of repeated values hold
    # millions of rows in a few MB. Many small files still share a task.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.files.openCostInBytes": "256k",
    # Listings share this many tasks; otherwise each folder of a table is one.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}
# Parquet files can only be cut between row groups.
ROW_GROUP_BYTES = 8 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "flowmart", master: str | None = None, **conf: str) -> SparkSession:
    """New session with the package settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **RUNTIME_SETTINGS,
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, as named by `spark.checkpoint.dir`.

    Only a local master, where driver and executors are one process, may fall
    back to a folder of its own; a cluster without the setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    named = tempfile.mkdtemp(prefix="flowmart-")
    spark.conf.set("spark.checkpoint.dir", named)
    spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path below the shared folder, removed at the latest when the driver ends."""
    files, location = _located(spark, f"{shared_dir(spark)}/flowmart/{label}-{uuid.uuid4().hex}")
    files.deleteOnExit(location)
    # With its file system's name, for readers outside Spark too.
    return files.makeQualified(location).toString()


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove scratch folders that nothing reads any more."""
    for path in paths:
        files, location = _located(spark, path)
        files.delete(location, True)


def _located(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    The result survives lost executors, has no lineage, and carries its true
    file size, so Catalyst broadcasts it only below
    `spark.sql.autoBroadcastJoinThreshold` and plans a shuffle join beyond.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Pinned tables of one job. Leaving the block removes those that were not kept."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def pin(self, df: DataFrame, label: str) -> DataFrame:
        """As `pin`; a table pinned under the same label before is removed afterwards."""
        old = self.paths.get(label)
        path = self.paths[label] = scratch_path(self.spark, label)
        df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
        if old:
            discard(self.spark, old)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, label: str) -> None:
        """A returned frame still reads this table; it goes when the driver ends."""
        self.paths.pop(label)

    def drop(self, *labels: str) -> None:
        discard(self.spark, *[self.paths.pop(label) for label in labels])

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop(*list(self.paths))
