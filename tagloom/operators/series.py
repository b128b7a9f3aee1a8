"""Data points: range reads, granularity aggregates, sizing, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.columns import granularity_ms
from tagloom.operators.upsert import addressed
from tagloom.request import utc_at
from tagloom.session import is_small, small_side

SERIES, TIME, VALUE = "externalId", "timestamp", "valueNum"


def _ranged(points: DataFrame, start: int, end: int | None, stored: Column | None) -> DataFrame:
    if end is not None and start >= end:
        raise ValueError("start must lie before end")
    upper = F.unix_millis(F.current_timestamp()) if end is None else F.lit(end)
    if stored is not None:
        points = points.where(stored >= utc_at(start))
        points = points.where(stored < utc_at(end)) if end is not None else points
    return points.where((F.col(TIME) >= F.lit(start)) & (F.col(TIME) < upper))


def read_datapoints(
    points: DataFrame,
    items: DataFrame | None = None,
    start: int = 0,
    end: int | None = None,
    limit: int | None = None,
    limit_mode: str = "page",
    stored: Column | None = None,
) -> DataFrame:
    """Points of the listed series in ``[start, end)``; start defaults to 0 and end to now.

    ``stored`` is the stored timestamp that the points' time was derived from: the range then reaches the file scan.
    Items may carry ``start`` and ``end`` columns of their own. ``limit_mode='page'`` makes the limit a fetch
    size without effect on the result; ``per_series`` keeps the first ``limit`` points of each series by time.
    """
    if limit_mode not in ("page", "per_series"):
        raise ValueError(f"unknown limit mode: {limit_mode}")
    rows = _ranged(points, start, end, stored)
    if items is not None:
        own = [c for c in ("start", "end") if c in items.columns]
        if own:
            asked = items.select(SERIES, *[F.col(c).alias(f"_{c}") for c in own])
            rows = rows.join(small_side(asked), SERIES)
            if "start" in own:
                rows = rows.where(F.col(TIME) >= F.coalesce("_start", F.lit(0)))
            if "end" in own:
                rows = rows.where(F.col("_end").isNull() | (F.col(TIME) < F.col("_end")))
            rows = rows.select(*points.columns)
        else:
            rows = rows.join(small_side(items.select(SERIES).distinct()), SERIES, "left_semi")
    if limit is not None and limit_mode == "per_series":
        first = W.partitionBy(SERIES).orderBy(TIME)
        rows = rows.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= limit).drop("_rn")
    return rows


def _aggregates() -> dict[str, Column]:
    return {
        "average": F.avg(VALUE),
        "max": F.max(VALUE),
        "min": F.min(VALUE),
        "sum": F.sum(VALUE),
        "count": F.count(VALUE),
    }


def bucket_start(granularity: str) -> Column:
    """Start of a point's bucket, counted from the epoch."""
    width = F.lit(granularity_ms(granularity))
    return F.col(TIME) - F.pmod(F.col(TIME), width)


def aggregate_datapoints(
    points: DataFrame,
    aggregates: Sequence[str],
    granularity: str,
    start: int = 0,
    end: int | None = None,
    items: DataFrame | None = None,
    stored: Column | None = None,
) -> DataFrame:
    """Aggregates per series and bucket; empty buckets are absent."""
    known = _aggregates()
    unknown = [a for a in aggregates if a not in known]
    if unknown:
        raise ValueError(f"unknown aggregates: {unknown}")
    rows = read_datapoints(points, items, start, end, stored=stored)
    return rows.groupBy(SERIES, bucket_start(granularity).alias(TIME)).agg(*[known[a].alias(a) for a in aggregates])


def series_max_frequency(
    points: DataFrame,
    granularity: str = "h",
    start: int = 0,
    end: int | None = None,
    headers: DataFrame | None = None,
    stored: Column | None = None,
) -> DataFrame:
    """Highest point rate (Hz) per series; 0 for a listed series without points in the range."""
    counts = aggregate_datapoints(points, ["count"], granularity, start, end, stored=stored)
    peak = counts.groupBy(SERIES).agg((F.max("count") / (granularity_ms(granularity) / 1000)).alias("frequency"))
    if headers is None:
        return peak
    listed = headers.select(SERIES).distinct()
    return listed.join(peak, SERIES, "left").select(SERIES, F.coalesce("frequency", F.lit(0.0)).alias("frequency"))


def split_identified(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(points with a series id, points without one); the second part must not be written."""
    named = F.col(SERIES).isNotNull()
    if "id" in points.columns:
        named = named | F.col("id").isNotNull()
    return points.where(named), points.where(~named)


def upsert_datapoints(points: DataFrame, incoming: DataFrame, check: bool = True, headers: DataFrame | None = None) -> DataFrame:
    """Points after a write: an incoming point replaces the stored one at the same (series, timestamp).

    ``incoming`` must hold one row per (series, timestamp). A point that carries only an id belongs to the series
    that ``headers`` (or else the stored points) have for it. With ``check`` a point with neither fails the job,
    without it such points are left out.
    """
    if check:
        failure = F.raise_error(F.lit("a data point has neither externalId nor id"))
        named = F.col(SERIES).isNotNull()
        if "id" in incoming.columns:
            named = named | F.col("id").isNotNull()
        incoming = incoming.where(F.when(named, F.lit(True)).otherwise(failure.cast("boolean")))
    else:
        incoming = split_identified(incoming)[0]
    if headers is not None and "id" in incoming.columns:
        incoming = addressed(headers, incoming)
    elif "id" in points.columns and "id" in incoming.columns:
        incoming = addressed(points.select("id", SERIES).where(F.col(SERIES).isNotNull()).distinct(), incoming)
    keys = incoming.select(SERIES, TIME)
    keys = F.broadcast(keys) if is_small(keys) else keys
    return points.join(keys, [SERIES, TIME], "left_anti").unionByName(incoming.select(*points.columns))
