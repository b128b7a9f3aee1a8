"""Unbounded reads: a stream of the rows of a request as a table grows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tagloom.operators.reads import list_resource
from tagloom.request import Request
from tagloom.streaming.event_time import EVENT_TIME_COLUMNS
from tagloom.streaming.landing import read_landing

# The resources that can be watched, and the default wait between polls.
WATCHED = ("assets", "events", "timeseries", "datapoints", "files", "raw_rows", "sequences")
POLL_INTERVAL_MS = 10_000
FOREVER = 2**63 - 1


@dataclass(frozen=True)
class Bounds:
    """Time range ``[start, end)`` a request watches."""

    start: int
    end: int


def watch_bounds(resource: str, request: Request) -> Bounds:
    """The range of a request: its own start and end where given, else from 0 and forever."""
    if resource not in WATCHED:
        raise ValueError(f"{resource} cannot be watched")
    if "granularity" in request.root:
        raise ValueError("an aggregate request cannot be watched")
    if resource == "datapoints":
        low, high = request.root.get("start"), request.root.get("end")
    elif resource == "raw_rows":
        low, high = request.root.get("minLastUpdatedTime"), request.root.get("maxLastUpdatedTime")
    else:
        span = request.filter.get("lastUpdatedTime") or {}
        low, high = span.get("min"), span.get("max")
    bounds = Bounds(0 if low is None else low, FOREVER if high is None else high)
    if bounds.start >= bounds.end:
        raise ValueError("start must lie before end")
    return bounds


def watched_rows(table: DataFrame, resource: str, request: Request) -> DataFrame:
    """Rows that a watch of the request delivers: its own filters and items, and ``start <= time < end``."""
    bounds = watch_bounds(resource, request)
    rest = {k: v for k, v in request.filter.items() if k != "lastUpdatedTime"}
    at = F.col(EVENT_TIME_COLUMNS[resource])
    rows = table.where((at >= bounds.start) & (at < bounds.end))
    return list_resource(rows, Request(rest, request.metadata, items=request.items))


def watch(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    resource: str,
    request: Request,
    out: str,
    checkpoint: str,
    poll_interval_ms: int = POLL_INTERVAL_MS,
    available_now: bool = False,
    max_files: int | None = None,
) -> StreamingQuery:
    """Start a stream that appends the request's rows to ``out`` as files arrive in ``folder``.

    The folder is looked at every ``poll_interval_ms``. Spark's checkpoint keeps which files were read and the file
    sink which micro-batches were written, so a restart neither repeats nor loses rows, and a poll reads new files
    only. With ``available_now`` the stream ends once it has read what is there.
    """
    rows = watched_rows(read_landing(spark, folder, schema, max_files), resource, request)
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_interval_ms} milliseconds").start()
