"""Vessel attributes as keyed state: a batch costs what its own vessels cost."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowmart.operators.incremental import read_if_exists
from flowmart.sources.ais import STATIC_ATTRIBUTES

# Executors need not have this package: the processor travels with its tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WATERMARK = "1 day"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class VesselAttributes(StatefulProcessor):
    """Attributes of one vessel.

    `open` has the last record of each window the watermark has not passed, `folded` of each
    attribute the value and window seen last before. A timer at the end of the earliest open
    window moves what has passed from the one to the other. A batch reads and writes a vessel's
    state as a whole, as each access is a round trip. Times are microseconds.
    """

    def __init__(self, attributes: Sequence[str], order: Sequence[str], record: str, folded: str, window_micros: int):
        self.attributes, self.order, self.record, self.folded_type = list(attributes), list(order), record, folded
        self.window_micros = window_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", f"window bigint, {self.record}")
        self.folded = handle.getValueState("folded", self.folded_type)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self._held()
        due = min(held, default=None)
        for row in rows:
            window, order = row["_window"], tuple(row[name] for name in self.order)
            if window not in held or held[window][: len(order)] <= order:
                held[window] = (*order, *[row[name] for name in self.attributes])
        self._keep(held, timerValues, due)
        state = self.folded.get()
        for window in sorted(held):
            state = self._after(state, window, held[window])
        n = len(self.attributes)
        names = ["mmsi", *self.attributes, "first_seen_at", "last_seen_at"]
        yield Row(**dict(zip(names, [*key, *state[:n], *state[2 * n :]], strict=True)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = self._held()
        over = sorted(window for window in held if window + self.window_micros <= passed)
        if over:
            state = self.folded.get()
            for window in over:
                state = self._after(state, window, held.pop(window))
            self.folded.update(state)
            self._keep(held, timerValues)
        yield from ()

    def _held(self) -> dict[int, tuple]:
        return {window: tuple(record) for window, *record in self.open.get()}

    def _keep(self, held: dict[int, tuple], timerValues, due: int | None = None) -> None:
        """Store the open windows; the earliest gets a timer, unless it is the one that is `due`."""
        if not held:
            self.open.clear()
            return
        self.open.put([(window, *record) for window, record in held.items()])
        first = min(held)
        if due is None or first < due:
            end = (first + self.window_micros) // 1000
            # A window behind the watermark is moved at the next chance.
            self.handle.registerTimer(max(end, timerValues.getCurrentWatermarkInMs() + 1))

    def close(self) -> None:
        pass

    def _after(self, state, window: int, record: tuple) -> tuple:
        """State after a window's record: values, the windows they were seen in, first and last window."""
        n = len(self.attributes)
        values, seen, first, last = ([None] * n, [None] * n, window, window)
        if state is not None:
            values, seen, first, last = list(state[:n]), list(state[n : 2 * n]), state[2 * n], state[2 * n + 1]
        for k, value in enumerate(record[len(self.order) :]):
            if value is not None and (seen[k] is None or seen[k] <= window):
                values[k], seen[k] = value, window
        return (*values, *seen, min(first, window), max(last, window))


def _micros(df: DataFrame, name: str):
    kind = df.schema[name].dataType
    return F.unix_micros(name) if isinstance(kind, T.TimestampType) else F.col(name)


def vessel_attributes(
    reports: DataFrame,
    window: str,
    order: Sequence[str],
    window_length: str = "15 minutes",
    attributes: Sequence[str] = STATIC_ATTRIBUTES,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Stream of the attributes of every vessel a batch has reports of.

    Of the records of one vessel in one `window` (its start) the last by `order` counts;
    across windows a later value wins and a null keeps the earlier one. Reports without a
    window, or behind the watermark, are left out; `LateRows` counts the latter.
    """
    spark = reports.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    rows = reports.where(F.col(window).isNotNull()).withWatermark(window, watermark)
    rows = rows.select(
        "mmsi",
        F.col(window).alias("_event_time"),
        F.unix_micros(window).alias("_window"),
        *[_micros(reports, c).alias(f"_order_{k}") for k, c in enumerate(order)],
        *attributes,
    )
    kinds = [f"{name} {rows.schema[name].dataType.simpleString()}" for name in attributes]
    ranks = [f"_order_{k}" for k in range(len(order))]
    record = ", ".join([*[f"{name} {rows.schema[name].dataType.simpleString()}" for name in ranks], *kinds])
    seen = ", ".join(f"{name}_at bigint" for name in attributes)
    ends = "first_seen_at bigint, last_seen_at bigint"
    micros = spark.sql(f"select unix_micros(timestamp_micros(0) + interval {window_length})").first()[0]
    processor = VesselAttributes(attributes, ranks, record, f"{', '.join(kinds)}, {seen}, {ends}", micros)
    key = f"mmsi {rows.schema['mmsi'].dataType.simpleString()}"
    made = rows.groupBy("mmsi").transformWithState(processor, f"{key}, {', '.join(kinds)}, {ends}", "Update", "EventTime")
    return made.withColumns({c: F.timestamp_micros(c) for c in ("first_seen_at", "last_seen_at")})


def change_writer(path: str) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function that stores a batch's vessels and nothing else; a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def newest_attributes(spark: SparkSession, path: str) -> DataFrame | None:
    """Each vessel's attributes after the last batch that had it."""
    rows = read_if_exists(spark, path)
    if rows is None:
        return None
    values = [name for name in rows.columns if name not in ("mmsi", "batch")]
    newest = rows.groupBy("mmsi").agg(F.max_by(F.struct(*values), "batch").alias("newest"))
    return newest.select("mmsi", "newest.*")
