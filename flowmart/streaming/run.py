"""Running a stream over what has arrived so far."""

from __future__ import annotations

from datetime import datetime, timezone
from threading import Event

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from flowmart.operators.incremental import read_if_exists


def append_available(
    stream: DataFrame, path: str, checkpoint: str, partition: str | None = None
) -> StreamingQuery:
    """Process everything new into a Parquet table and stop.

    The checkpoint remembers what was read, so unlike a high-water mark it does
    not skip rows that share the newest timestamp.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition:
        writer = writer.partitionBy(partition)
    query = writer.start()
    query.awaitTermination()
    return query


class LateRows(StreamingQueryListener):
    """Keeps how many rows each batch of each query dropped behind the watermark.

    Counts are appended to a table as batches end, so unlike a query's recent progress
    they cover all batches, and those before a restart too. A batch that ran again counts
    once. Register with `spark.streams.addListener`.
    """

    SCHEMA = "query_id string, batch_id bigint, rows bigint, counted_at timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: dict[str, Event] = {}

    def onQueryStarted(self, event) -> None:
        self.ended[str(event.runId)] = Event()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(int(operator.numRowsDroppedByWatermark) for operator in progress.stateOperators)
        if dropped:
            row = (str(progress.id), progress.batchId, dropped, datetime.now(timezone.utc))
            # One row a batch, and only for batches with late rows.
            self.spark.createDataFrame([row], self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def counts(self, query: StreamingQuery | None = None, timeout: float = 60.0) -> DataFrame:
        """Late rows per query and batch; of an ended query, once all its counts are in."""
        if query is not None and not self.ended[str(query.runId)].wait(timeout):
            raise TimeoutError(f"query {query.id} has not ended")
        stored = read_if_exists(self.spark, self.path)
        rows = self.spark.createDataFrame([], self.SCHEMA) if stored is None else stored
        if query is not None:
            rows = rows.where(F.col("query_id") == str(query.id))
        return rows.groupBy("query_id", "batch_id").agg(F.max("rows").alias("rows"))


def late_rows(listener: LateRows, query: StreamingQuery) -> int:
    """Rows an ended query has dropped behind the watermark in all its batches."""
    return listener.counts(query).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
