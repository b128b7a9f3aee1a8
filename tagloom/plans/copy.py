"""End to end: data points of a stream written to other series."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.streaming.event_time import with_event_time, window_count
from tagloom.streaming.upsert import stream_upsert


def copy_series(points: DataFrame, rename: Callable[[Column], Column], log: str, checkpoint: str) -> None:
    """Write every arriving point under the renamed series into a change log."""
    renamed = points.withColumn("externalId", rename(F.col("externalId")))
    stream_upsert(renamed, log, checkpoint, available_now=True).awaitTermination()


def copy_counts(points: DataFrame, duration: str, delay: str = "30 seconds") -> DataFrame:
    """Points copied per window, to report next to the copy."""
    return window_count(with_event_time(points, "datapoints", delay), duration)
