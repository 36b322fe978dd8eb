"""Readers and writers for stored tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from flowmart.operators.incremental import read_if_exists
from flowmart.sources.versions import VersionedTable

# The layers of the warehouse and how each is materialised.
LAYERS = {
    "raw": "append",
    "analytics_staging": "view",
    "analytics_marts": "table",
}


def read_source(spark: SparkSession, fmt: str, path: str | None = None, **options: str) -> DataFrame:
    """Any Spark source, `jdbc` included."""
    return spark.read.format(fmt).options(**options).load(path)


# Names the folder below a table's path that holds its rows.
POINTER = "_current"


def _files(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def current_path(spark: SparkSession, path: str) -> str:
    """Folder of a table's present rows: the one it points to, or the path itself."""
    files, pointer = _files(spark, f"{path}/{POINTER}")
    if not files.exists(pointer):
        return path
    stream = files.open(pointer)
    try:
        return f"{path}/{spark._jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8')}"
    finally:
        stream.close()


def read_table_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """Present rows of a table, or None before its first write."""
    return read_if_exists(spark, current_path(spark, path))


def replace_table(df: DataFrame, path: str) -> None:
    """Truncate and reload.

    The rows go to a folder of their own; then the pointer is replaced in one
    step. Until that the old rows are read, also after a crash. The version
    before the new one stays for readers that have begun.
    """
    spark = df.sparkSession
    before = current_path(spark, path)
    version = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    files, fresh = _files(spark, f"{path}/{POINTER}-{version}")
    stream = files.create(fresh, True)
    stream.write(version.encode())
    stream.close()
    _, pointer = _files(spark, f"{path}/{POINTER}")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark._jsc.hadoopConfiguration())
    kind = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context.rename(files.makeQualified(fresh), files.makeQualified(pointer), how)
    for status in files.listStatus(spark._jvm.org.apache.hadoop.fs.Path(path)):
        name = status.getPath().getName()
        if name.startswith("version-") and name not in (version, before.rsplit("/", 1)[-1]):
            files.delete(status.getPath(), True)


class Warehouse:
    """Paths of the layers below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise KeyError(layer)
        return f"{self.root}/{layer}/{name}"

    def table(self, layer: str, name: str, *keys: str, partition: str = "day") -> VersionedTable:
        """A table that grows by loads; see `VersionedTable`."""
        return VersionedTable(self.spark, self.path(layer, name), keys, partition)

    def read(self, layer: str, name: str) -> DataFrame:
        """Present rows of a table; an error before its first write."""
        versioned = self.table(layer, name).read()
        if versioned is not None:
            return versioned
        return self.spark.read.parquet(current_path(self.spark, self.path(layer, name)))

    def find(self, layer: str, name: str) -> DataFrame | None:
        """Present rows of a table, or None before its first write."""
        versioned = self.table(layer, name).read()
        return read_table_if_exists(self.spark, self.path(layer, name)) if versioned is None else versioned

    def newest(self, layer: str, name: str) -> DataFrame | None:
        """Newest partition of a table, enough for marks and freshness."""
        return self.table(layer, name).newest()

    def newest_of_each(self, layer: str, name: str, column: str, values) -> DataFrame | None:
        """Newest partitions that together hold every listed value, for readings per group."""
        return self.table(layer, name).newest_of_each(column, values)

    def replace(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Reload a table; rows of an append-only layer are never replaced as a whole."""
        if LAYERS[layer] == "append":
            raise ValueError(f"{layer} is append-only")
        replace_table(df, self.path(layer, name))
        return self.read(layer, name)
