"""Rollups of data points: stored partial aggregates in tiers, merged with raw points at the edges of a range.

A tier holds count, sum, minimum and maximum per series and bucket of one width. A range is covered by the widest whole
buckets, then by narrower tiers at both ends, and by raw points only where no bucket is whole, so a long range reads as
many rows as it has wide buckets. All parts are combined in one aggregation.

Defined cases: points without value count as present, so their bucket stands with count 0 and no other aggregate; an
empty range gives no rows; points without time lie in no bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.columns import granularity_ms
from tagloom.operators.series import SERIES, TIME, VALUE, bucket_start, read_datapoints

PARTIALS = ("count", "sum", "min", "max")


def rollup(points: DataFrame, granularity: str) -> DataFrame:
    """(series, bucket start, count, sum, min, max) of raw points."""
    timed = points.where(F.col(TIME).isNotNull())
    return timed.groupBy(SERIES, bucket_start(granularity).alias(TIME)).agg(*_partials(lambda name: F.col(VALUE), F.count))


def coarser(tier: DataFrame, granularity: str) -> DataFrame:
    """A tier of wider buckets from a tier whose width divides theirs."""
    return tier.groupBy(SERIES, bucket_start(granularity).alias(TIME)).agg(*_partials(F.col, F.sum))


def tiers(points: DataFrame, granularities: Sequence[str]) -> dict[str, DataFrame]:
    """Tiers of the given widths; each is built from the one before, whose width must divide its own."""
    made: dict[str, DataFrame] = {}
    before = None
    for granularity in granularities:
        if before is not None and granularity_ms(granularity) % granularity_ms(before):
            raise ValueError(f"{before} does not divide {granularity}")
        made[granularity] = rollup(points, granularity) if before is None else coarser(made[before], granularity)
        before = granularity
    return made


def cover(start: int, end: int, widths: Sequence[int]) -> list[tuple[int | None, int, int]]:
    """``[start, end)`` as whole buckets of the given widths (widest first) and raw rests: (width or None, from, to)."""
    if start >= end:
        return []
    if not widths:
        return [(None, start, end)]
    width, narrower = widths[0], widths[1:]
    first, last = -(-start // width) * width, end // width * width
    if first >= last:
        return cover(start, end, narrower)
    return [*cover(start, first, narrower), (width, first, last), *cover(last, end, narrower)]


def aggregate_rolled(
    points: DataFrame,
    stored: Mapping[str, DataFrame],
    aggregates: Sequence[str],
    granularity: str,
    start: int,
    end: int,
    raw_stored: Column | None = None,
) -> DataFrame:
    """What :func:`series.aggregate_datapoints` gives for ``[start, end)``, from tiers (by their width) and raw edges.

    Tiers whose width does not divide the asked one are left aside. ``raw_stored`` is the stored timestamp of the points.
    """
    known = {
        "average": F.try_divide(F.sum("sum"), F.sum("count")),
        "max": F.max("max"),
        "min": F.min("min"),
        "sum": F.sum("sum"),
        "count": F.sum("count"),
    }
    unknown = [a for a in aggregates if a not in known]
    if unknown:
        raise ValueError(f"unknown aggregates: {unknown}")
    if start >= end:
        raise ValueError("start must lie before end")
    asked = granularity_ms(granularity)
    usable = {granularity_ms(g): t for g, t in stored.items() if asked % granularity_ms(g) == 0}
    columns = [SERIES, TIME, *PARTIALS]
    pieces = []
    for width, lower, upper in cover(start, end, sorted(usable, reverse=True)):
        if width is None:
            raw = read_datapoints(points, None, lower, upper, stored=raw_stored)
            # Raw points take part as partials of one point each: they are combined before the shuffle anyway.
            one = raw.select(SERIES, TIME, F.col(VALUE).isNotNull().cast("long").alias("count"), *[F.col(VALUE).alias(c) for c in PARTIALS[1:]])
            pieces.append(one)
        else:
            pieces.append(usable[width].where((F.col(TIME) >= lower) & (F.col(TIME) < upper)).select(*columns))
    merged = pieces[0]
    for piece in pieces[1:]:
        merged = merged.unionByName(piece)
    return merged.groupBy(SERIES, bucket_start(granularity).alias(TIME)).agg(*[known[a].alias(a) for a in aggregates])


def _partials(source, counted) -> list[Column]:
    how = {"count": counted, "sum": F.sum, "min": F.min, "max": F.max}
    return [how[c](source(c)).alias(c) for c in PARTIALS]
