"""Unbounded reads by time: a stream of contiguous slices of update time, each read from the table as a plain range.

``TimeSlices`` is a streaming source whose offsets are points in time. A poll delivers what lies between the last offset
and now less the poll offset, the time that rows may take to show in the table; rows that show later are not read. The
offsets are kept by Spark's checkpoint, so slices neither overlap nor leave gaps over restarts. A clock that has gone
back behind the last offset fails the stream, which can be started again once it has caught up.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tagloom.request import Request
from tagloom.streaming.event_time import EVENT_TIME_COLUMNS
from tagloom.streaming.watch import FOREVER, POLL_INTERVAL_MS, watch_bounds, watched_rows

# The default poll offset, the least length of a slice, and how many slices a poll has at most.
POLL_OFFSET_MS, SLICE_MS, MOST_SLICES = 5_000, 60_000, 64


class Slice(InputPartition):
    """``[low, high)`` in milliseconds."""

    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class SliceReader(DataSourceStreamReader):
    """Offsets are ``{"to": milliseconds}``. A long way to go is cut into longer slices, not into more."""

    def __init__(self, options: dict[str, str]):
        self.start, self.end = int(options.get("start", 0)), int(options.get("end", FOREVER))
        self.behind, self.least = int(options.get("polloffset", POLL_OFFSET_MS)), int(options.get("slice", SLICE_MS))
        if self.start >= self.end or self.least < 1 or self.behind < 0:
            raise ValueError("a watch needs start < end, slices of some length and no negative poll offset")

    def initialOffset(self) -> dict:
        return {"to": self.start}

    def latestOffset(self) -> dict:
        return {"to": max(self.start, min(self.end, time.time_ns() // 1_000_000 - self.behind))}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        low, high = start["to"], end["to"]
        if high < low:
            raise ValueError(f"the clock is behind the last slice: {high} < {low}")
        step = max(self.least, -(-(high - low) // MOST_SLICES))
        return [Slice(at, min(at + step, high)) for at in range(low, high, step)]

    def read(self, partition: Slice) -> Iterator[tuple[int, int]]:
        yield partition.low, partition.high

    def commit(self, end: dict) -> None:
        """Nothing is kept here: the checkpoint has the offsets."""


class TimeSlices(DataSource):
    """Source ``time_slices`` of (low, high). Options: start, end, pollOffset, slice, all in milliseconds."""

    @classmethod
    def name(cls) -> str:
        return "time_slices"

    def schema(self) -> str:
        return "low long, high long"

    def streamReader(self, schema: StructType) -> SliceReader:
        return SliceReader({k.lower(): v for k, v in self.options.items()})


def read_slices(spark: SparkSession, start: int = 0, end: int = FOREVER, poll_offset_ms: int = POLL_OFFSET_MS, slice_ms: int = SLICE_MS) -> DataFrame:
    """The stream of slices."""
    spark.dataSource.register(TimeSlices)
    reader = spark.readStream.format("time_slices").option("start", start).option("end", end)
    return reader.option("pollOffset", poll_offset_ms).option("slice", slice_ms).load()


def watch_slices(
    spark: SparkSession,
    table: Callable[[], DataFrame],
    resource: str,
    request: Request,
    out: str,
    checkpoint: str,
    poll_offset_ms: int = POLL_OFFSET_MS,
    poll_interval_ms: int = POLL_INTERVAL_MS,
    available_now: bool = False,
    end: int | None = None,
) -> StreamingQuery:
    """Start a stream that writes the request's rows of every poll's time range to a folder of ``out``.

    ``table`` opens the table as it is at the poll. A poll's slices follow each other, so it is one range that reaches
    the scan. A poll that runs again replaces its folder. ``end`` stops the slices before the end of the request.
    """
    bounds = watch_bounds(resource, request)
    at = F.col(EVENT_TIME_COLUMNS[resource])
    last = bounds.end if end is None else min(end, bounds.end)

    def poll(slices: DataFrame, batch: int) -> None:
        low, high = slices.agg(F.min("low"), F.max("high")).first()
        if low is not None:
            rows = watched_rows(table().where((at >= low) & (at < high)), resource, request)
            rows.write.mode("overwrite").parquet(f"{out}/poll={batch}")

    writer = read_slices(spark, bounds.start, last, poll_offset_ms).writeStream.foreachBatch(poll).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_interval_ms} milliseconds").start()
