"""Landing folders: files that arrive, read as streams."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def land(df: DataFrame, path: str, order_by: str, files: int | None = None) -> str:
    """Write rows as files that each hold one range of ``order_by``: as many as Spark makes of their size, or ``files``."""
    ranges = df.repartitionByRange(order_by) if files is None else df.repartitionByRange(files, order_by)
    ranges.sortWithinPartitions(order_by).write.mode("append").parquet(path)
    return path


def read_landing(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """A stream of the files of a landing folder, at most ``max_files`` per micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_available(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what is there, append its result to ``path`` and read it back."""
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_until_drained(df: DataFrame, path: str, checkpoint: str, idle_s: float = 120.0) -> DataFrame:
    """As :func:`run_available` for a stateful stream whose latency timers keep it running.

    Stops once the input is read and the timers have emptied the state. A stream may run as long as it likes, and so may
    each of its micro-batches, which report at their end; it fails if it still holds rows and nothing has moved for
    ``idle_s``: no input came, the state kept its size, and no micro-batch is at work that has yet to report.
    """
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .start()
    )
    fed, held, last, deadline = False, None, None, time.monotonic() + idle_s
    try:
        while True:
            # Only the last progress reports are kept: what was seen once is remembered here.
            seen = query.recentProgress
            fed = fed or any(p["numInputRows"] for p in seen)
            reported = bool(seen) and seen[-1]["timestamp"] != last
            if seen:
                last = seen[-1]["timestamp"]
                now = (seen[-1]["numInputRows"], [o["numRowsTotal"] for o in seen[-1]["stateOperators"]])
                if now != held or now[0]:
                    held, deadline = now, time.monotonic() + idle_s
                if fed and not now[0] and not any(now[1]):
                    break
            if query.awaitTermination(0.1):
                break
            if time.monotonic() > deadline and (reported or not query.status["isTriggerActive"]):
                raise TimeoutError("the stream still holds rows")
    finally:
        query.stop()
    return df.sparkSession.read.schema(df.schema).parquet(path)
