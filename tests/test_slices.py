"""Time slices: contiguous over restarts, behind the clock by the poll offset, and read as ranges of a growing table."""

import time

import pytest
from pyspark.sql import functions as F

from tagloom.request import Request
from tagloom.session import work_path
from tagloom.streaming.landing import run_available
from tagloom.streaming.slices import MOST_SLICES, SliceReader, read_slices, watch_slices


def slices(spark, out, checkpoint, **options):
    rows = run_available(read_slices(spark, **options), out, checkpoint).collect()
    return sorted((r.low, r.high) for r in rows)


def test_slices_are_contiguous_over_a_restart(spark):
    out, checkpoint = work_path(spark, "out"), work_path(spark, "stream")
    first = slices(spark, out, checkpoint, start=1_000, end=10_000, slice_ms=4_000)
    assert first == [(1_000, 5_000), (5_000, 9_000), (9_000, 10_000)]
    again = slices(spark, out, checkpoint, start=1_000, end=17_500, slice_ms=4_000)
    assert again[:3] == first and again[0][0] == 1_000 and again[-1][1] == 17_500
    assert all(a[1] == b[0] for a, b in zip(again, again[1:]))
    assert slices(spark, out, checkpoint, start=1_000, end=17_500, slice_ms=4_000) == again  # nothing new


def test_a_slice_ends_the_poll_offset_before_now(spark):
    start = time.time_ns() // 1_000_000 - 100_000
    found = slices(spark, work_path(spark, "out"), work_path(spark, "stream"), start=start, poll_offset_ms=60_000, slice_ms=10_000)
    now = time.time_ns() // 1_000_000
    assert found[0][0] == start and start + 40_000 <= found[-1][1] <= now - 60_000


def test_a_long_way_has_longer_slices_and_a_late_clock_fails():
    reader = SliceReader({"start": "0", "slice": "10"})
    cut = reader.partitions({"to": 0}, {"to": 10**12})
    assert len(cut) <= MOST_SLICES and cut[0].low == 0 and cut[-1].high == 10**12
    assert reader.partitions({"to": 5}, {"to": 5}) == []
    with pytest.raises(ValueError, match="clock"):
        reader.partitions({"to": 9}, {"to": 8})
    with pytest.raises(ValueError):
        SliceReader({"start": "5", "end": "5"})


def test_a_watch_by_slices_reads_each_row_once_as_the_table_grows(spark):
    path, out, checkpoint = work_path(spark, "table"), work_path(spark, "out"), work_path(spark, "stream")
    make = lambda low, high: spark.range(low, high).select(
        F.col("id"), F.concat(F.lit("e"), F.col("id").cast("string")).alias("externalId"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("type"), (F.col("id") * 1000).alias("lastUpdatedTime"),
    )
    make(0, 50).write.mode("append").parquet(path)
    request = Request({"type": "a", "lastUpdatedTime": {"min": 10_000, "max": 90_000}})
    table = lambda: spark.read.parquet(path)
    watch_slices(spark, table, "events", request, out, checkpoint, available_now=True, end=50_000).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(10, 50, 2))
    make(50, 120).write.mode("append").parquet(path)
    watch_slices(spark, table, "events", request, out, checkpoint, available_now=True).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(10, 90, 2))
    assert spark.read.parquet(out).select("poll").distinct().count() == 2
