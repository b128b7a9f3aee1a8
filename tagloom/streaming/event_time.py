"""Event time of resource rows, windows over it, and late rows."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tagloom.operators.upsert import run_columns

# The column that carries the event time of each resource, in epoch milliseconds.
EVENT_TIME_COLUMNS = {
    "assets": "lastUpdatedTime",
    "events": "lastUpdatedTime",
    "timeseries": "lastUpdatedTime",
    "files": "lastUpdatedTime",
    "sequences": "lastUpdatedTime",
    "relationships": "lastUpdatedTime",
    "data_sets": "lastUpdatedTime",
    "raw_rows": "lastUpdatedTime",
    "labels": "createdTime",
    "datapoints": "timestamp",
}
# Fixed value: sequence rows carry no time of their own.
SEQUENCE_ROW_TIME = 1


def event_time_ms(resource: str) -> Column:
    if resource == "sequence_rows":
        return F.lit(SEQUENCE_ROW_TIME).cast("long")
    if resource == "datapoint_batches":
        return F.array_min(F.transform("items", lambda p: p["timestamp"]))
    if resource not in EVENT_TIME_COLUMNS:
        raise ValueError(f"no event time for {resource}")
    return F.col(EVENT_TIME_COLUMNS[resource])


def with_event_time(df: DataFrame, resource: str, delay: str = "30 seconds") -> DataFrame:
    """Add ``event_time``; a stream also gets a watermark that trails by ``delay``."""
    timed = df.withColumn("event_time", F.timestamp_millis(event_time_ms(resource)))
    return timed.withWatermark("event_time", delay) if df.isStreaming else timed


def window_count(df: DataFrame, duration: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows per tumbling window (start as epoch milliseconds); empty windows are silent."""
    counted = df.groupBy(F.window("event_time", duration), *keys).agg(F.count("*").alias("count"))
    return counted.select(F.unix_millis("window.start").alias("window_start"), *keys, "count")


def window_runs(
    df: DataFrame, external_id: str, status: str = "SUCCESS", verb: str = "upserted", duration: str = "10 seconds"
) -> DataFrame:
    """A run row per window that wrote something; empty windows report nothing."""
    counted = window_count(df, duration)
    return counted.select("window_start", *run_columns(external_id, status, verb, F.col("count")))


class DropCounter(StreamingQueryListener):
    """Counts the rows that streams drop for arriving after their window had closed, over all their triggers.

    Register it with ``spark.streams.addListener`` before the stream starts.
    """

    def __init__(self, timeout_s: float = 60.0):
        self._rows: dict[str, int] = {}
        self._ended: set[str] = set()
        self._heard, self._timeout_s = threading.Condition(), timeout_s

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._heard:
            known = self._rows.get(str(progress.id), 0)
            self._rows[str(progress.id)] = known + sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._heard:
            self._ended.add(str(event.runId))
            self._heard.notify_all()

    def dropped(self, query: StreamingQuery) -> int:
        """Rows dropped so far by all runs of the query. For a query that has ended, its last report is waited for."""
        with self._heard:
            if not query.isActive and not self._heard.wait_for(lambda: str(query.runId) in self._ended, self._timeout_s):
                raise TimeoutError("the end of the stream was not reported")
            return self._rows.get(str(query.id), 0)


def write_with_late_rows(
    df: DataFrame, event_time: str, window_ms: int, out: str, checkpoint: str, delay_ms: int = 30_000, available_now: bool = False
) -> StreamingQuery:
    """Append a stream's rows to ``out`` below (batch_id, late): rows whose window had closed come apart, and none is lost.

    A window has closed once the latest event of all earlier micro-batches, less ``delay_ms``, has passed its end. The
    latest event of a micro-batch is kept beside its rows, so a micro-batch that runs again finds the same and replaces
    its folder.
    """
    spark = df.sparkSession
    at = F.col(event_time)
    ends = (F.floor(at / window_ms) + 1) * window_ms

    def write(batch: DataFrame, batch_id: int) -> None:
        earlier = None
        if batch_id > 0:
            marks = spark.read.schema("latest long, batch_id long").parquet(f"{out}-marks")
            earlier = marks.where(F.col("batch_id") < batch_id).agg(F.max("latest")).first()[0]
        closed = F.lit(False) if earlier is None else ends <= F.lit(earlier - delay_ms)
        latest = Observation()
        rows = batch.withColumn("late", F.coalesce(closed, F.lit(False))).observe(latest, F.max(at).alias("latest"))
        rows.write.mode("overwrite").partitionBy("late").parquet(f"{out}/batch_id={batch_id}")
        mark = spark.range(1).select(F.lit(latest.get["latest"]).cast("long").alias("latest"))
        mark.write.mode("overwrite").parquet(f"{out}-marks/batch_id={batch_id}")

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_with_late_rows(spark: SparkSession, out: str) -> DataFrame:
    """What :func:`write_with_late_rows` wrote, with ``late`` as a boolean."""
    return spark.read.parquet(out).withColumn("late", F.col("late").cast("boolean")).drop("batch_id")
