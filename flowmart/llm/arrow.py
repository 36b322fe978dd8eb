"""Functions over Arrow arrays as Spark columns."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows Spark hands to Python at a time, and their bytes; a longer text comes alone. Several
#: copies of a batch are alive at once, in the JVM, on the way and as arrays.
BATCH_ROWS = 2048
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the memory of a Python task whatever the length of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def once(key: tuple, make: Callable[[], object]):
    """What `make` gives, made once per Python worker; the few latest keys are kept.

    Functions travel to workers by value, with new globals for each task, so the
    store hangs on the interpreter's table of modules.
    """
    store = sys.modules.setdefault("_flowmart_worker_store", types.ModuleType("_flowmart_worker_store")).__dict__
    if key not in store:
        for old in [k for k in store if isinstance(k, tuple)][:-3]:
            del store[old]
        store[key] = make()
    return store[key]


def give_back() -> None:
    """Free memory a task leaves goes back to the system: workers outlive tasks and stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`mapInArrow`, after which a task gives its memory back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(task, schema)


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that `df` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_function(make: Callable[[], Callable[[pa.Array], pa.Array]], kind: str) -> Callable[..., Column]:
    """A column function of Spark type `kind`; `make` prepares one task's function of arrays.

    With several input columns the function gets a tuple of arrays.
    """

    def several(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        run = make()
        for arrays in batches:
            yield run(*arrays)
        give_back()

    def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = make()
        for array in batches:
            yield run(array)
        give_back()

    several.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    one.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    single, many = F.arrow_udf(one, kind), F.arrow_udf(several, kind)
    return lambda *columns: single(*columns) if len(columns) == 1 else many(*columns)
