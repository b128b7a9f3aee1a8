"""Streams: batching, watching, late rows, change log."""

import time
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.plans import catalog
from tagloom.plans.delta import delta_read
from tagloom.plans.streams import _point_facts
from tagloom.request import Request
from tagloom.session import work_path
from tagloom.streaming.batcher import BatchProcessor, batch_end, group_into_batches_stream, group_into_window_batches
from tagloom.streaming.event_time import DropCounter, read_with_late_rows, window_count, with_event_time, write_with_late_rows
from tagloom.streaming.landing import land, read_landing, run_available, run_until_drained
from tagloom.streaming.upsert import merge_log, stream_upsert
from tagloom.streaming.watch import Bounds, watch, watch_bounds, watched_rows

ITEMS = [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("c", 10), ("c", 11), ("d", 100), ("d", 101), ("d", 102)]


@pytest.fixture()
def items(spark):
    return spark.createDataFrame(ITEMS, "key string, id long")


def paths(spark):
    return work_path(spark, "out"), work_path(spark, "stream")


def landed(spark, df, order_by, max_files=None):
    return read_landing(spark, land(df, work_path(spark, "landing"), order_by), df.schema, max_files)


@pytest.mark.parametrize("shards", [1, 2])
def test_batches_lose_nothing(spark, items, shards):
    stream = landed(spark, items, "id", max_files=1)
    found = run_until_drained(group_into_batches_stream(stream, ["key"], 2, 10, shards=shards), *paths(spark))
    opened = sorted((r["key"], i["id"]) for r in found.collect() for i in r["items"])
    assert opened == ITEMS
    assert max(r["n"] for r in found.collect()) <= 2


def test_flush_before_the_cap(spark, items):
    weighted = items.withColumn("w", F.lit(3).cast("long"))
    stream = landed(spark, weighted, "id")
    batches = group_into_batches_stream(stream, ["key"], 100, 10, weight="w", max_weight=7, flush_before=True)
    found = run_until_drained(batches, *paths(spark))
    assert sorted((r["key"], r["n"]) for r in found.collect()) == [("a", 2), ("a", 2), ("c", 2), ("d", 1), ("d", 2)]


def test_distinct_cap(spark, items):
    stream = landed(spark, items.withColumn("one", F.lit("x")), "id")
    batches = group_into_batches_stream(stream, ["one"], 100, 10, distinct="key", max_distinct=2)
    found = run_until_drained(batches, *paths(spark)).collect()
    assert sum(r["n"] for r in found) == len(ITEMS)
    assert all(len({i["key"] for i in r["items"]}) <= 2 for r in found)


def test_batches_that_fill_up_at_once_do_not_enter_the_state():
    """70 rows for batches of 10, five of which wait in the state: seven batches in one frame, one entry for the rest."""
    calls = []

    class Value:
        def __init__(self, held=None):
            self.held = held

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, value):
            calls.append("update")
            self.held = value

        def clear(self):
            self.held = None

    class Chunks:
        held = ["\n".join(f"s{i}" for i in range(5))]

        def get(self):
            return iter([(chunk,) for chunk in self.held])

        def appendValue(self, value):
            calls.append("append")
            self.held = [*self.held, value[0]]

        def clear(self):
            self.held = []

    most = np.iinfo(np.int64).max
    processor = BatchProcessor(["k"], (10, most, most), 10, False, None)
    processor.handle = SimpleNamespace(registerTimer=lambda at: None, deleteTimer=lambda at: None)
    processor.chunks, processor.sums, processor.deadline = Chunks(), Value((5, 0, "")), Value((99,))
    rows = pd.DataFrame({"item_json": [f"r{i}" for i in range(70)], "item_weight": 0, "item_mark": ""})
    frames = list(processor.handleInputRows(("a",), iter([rows]), SimpleNamespace(getCurrentProcessingTimeInMs=lambda: 7)))
    batches = [list(b) for f in frames for b in f["items"]]
    assert len(frames) == 1 and [len(b) for b in batches] == [10] * 7
    left = processor.chunks.held[0].split("\n")
    assert sum(batches, []) + left == [f"s{i}" for i in range(5)] + [f"r{i}" for i in range(70)]
    assert processor.sums.held == (5, 0, "") and processor.deadline.held == (17,) and calls.count("append") == 1


def test_a_long_micro_batch_is_no_standstill(spark, items):
    """The micro-batch works for longer than a stream may stand still; it is waited for."""
    slow = F.udf(lambda x: time.sleep(1.5) or x, "long")
    stream = landed(spark, items, "id").withColumn("id", slow("id"))
    found = run_until_drained(group_into_batches_stream(stream, ["key"], 2, 10), *paths(spark), idle_s=1.0)
    assert sorted((r["key"], i["id"]) for r in found.collect() for i in r["items"]) == ITEMS


def test_facts_of_point_batches(spark):
    """Series that come again within and across batches, points without a series, times whose sum leaves the long range."""
    point = "externalId: string, timestamp: long, valueNum: double"
    far = 9 * 10**15
    batches = [
        (10, [("a", 1, 0.0), ("a", 2, 0.0), ("b", 3, None)], 3),
        (10, [("a", 4, 0.0), (None, 5, 0.0)], 2),
        (20, [(None, 6, 0.0)], 1),
        (30, [(f"s{i}", 7, 0.0) for i in range(40)], 40),
        (40, [("a", 8, 0.0)] * 100, 100),
        *[(50, [(f"s{i % 39}", far, 0.0) for i in range(99)], 99)] * 11,
    ]
    found = _point_facts(spark.createDataFrame(batches, f"window_end long, items array<struct<{point}>>, n long"))
    assert sorted(map(tuple, found.collect())) == [
        (10, 5, 2, "15", True),
        (20, 1, 0, "6", True),
        (30, 40, 40, "280", False),
        (40, 100, 1, "800", False),
        (50, 1089, 39, str(1089 * far), True),
    ]


def test_points_of_batches_are_not_opened(spark, capsys):
    """The facts of the batches are had without one row per point."""
    catalog.QUERIES["stateful_batches_datapoints"](spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert "explode(ids" in plan and "explode(items" not in plan


def test_windows_flush_once_they_are_over(spark):
    schema = "key string, id long, at long, note string"
    landing, (out, checkpoint) = work_path(spark, "landing"), paths(spark)
    counter = DropCounter()
    spark.streams.addListener(counter)

    def run(*rows):
        land(spark.createDataFrame([(k, i, t, None) for k, i, t in rows], schema), landing, "at", files=1)
        stream = read_landing(spark, landing, spark.createDataFrame([], schema).schema)
        batches = group_into_window_batches(stream, ["key"], "at", 1000, delay_ms=100, lateness_ms=500, size=3)
        found = run_available(batches, out, checkpoint).collect()
        return sorted((r["key"], r["window_end"], sorted(i["id"] for i in r["items"]), r["reason"]) for r in found)

    assert run(("a", 1, 10), ("a", 2, 20)) == []
    # 1400 is past the window's end and the delay, but not the lateness: the state waits over a restart.
    full = ("a", 1000, [1, 2, 3], "full")
    assert run(("a", 3, 30), ("b", 9, 1400)) == [full]
    done = [full, ("a", 1000, [4], "window")]
    assert run(("a", 4, 950), ("b", 7, 1700)) == sorted(done)
    # Late by now: dropped. An open window is not delivered.
    assert run(("a", 5, 990), ("a", 6, 1900)) == sorted(done)
    assert run(("c", 8, 3000)) == sorted([*done, ("b", 2000, [7, 9], "window"), ("a", 2000, [6], "window")])
    spark.streams.removeListener(counter)


def test_batch_ends():
    import itertools
    import random

    import numpy as np

    pick = random.Random(4)
    for before, _ in itertools.product((False, True), range(300)):
        weights = np.array([pick.randrange(0, 9) for _ in range(pick.randrange(1, 12))])
        fresh = np.array([pick.randrange(2) for _ in weights])
        caps = (pick.randrange(1, 8), pick.randrange(1, 30), pick.randrange(1, 6))
        n, weight, ids, want = 0, 0, 0, None
        for i, (w, f) in enumerate(zip(weights, fresh)):
            reached = n + 1 >= caps[0] or weight + w >= caps[1] or ids + f >= caps[2]
            if before and n and reached:
                want = (i, True)
                break
            n, weight, ids = n + 1, weight + w, ids + f
            if not before and reached:
                want = (i + 1, True)
                break
        assert batch_end(weights, fresh, (0, 0, 0), caps, before) == (want or (len(weights), False))


def test_late_rows_are_kept_apart(spark):
    landing, (out, checkpoint) = work_path(spark, "landing"), paths(spark)
    for times in ([1, 2, 25], [3, 14, 26], [99], [29]):
        land(spark.createDataFrame([(t,) for t in times], "at long"), landing, "at", files=1)
        stream = read_landing(spark, landing, spark.createDataFrame([], "at long").schema)
        write_with_late_rows(stream, "at", 10, out, checkpoint, delay_ms=8, available_now=True).awaitTermination()
    found = read_with_late_rows(spark, out)
    assert sorted((r["at"], r["late"]) for r in found.collect()) == [
        (1, False), (2, False), (3, True), (14, False), (25, False), (26, False), (29, True), (99, False),
    ]


@pytest.mark.parametrize("arguments", [{"max_latency_ms": 9}, {"max_latency_ms": 10**9}, {"size": 0}])
def test_batch_limits(items, arguments):
    with pytest.raises(ValueError):
        group_into_batches_stream(items, ["key"], **arguments)


def test_watch_bounds():
    assert watch_bounds("events", Request()).start == 0
    assert watch_bounds("datapoints", Request(root={"start": 5, "end": 9})) == Bounds(5, 9)
    assert watch_bounds("raw_rows", Request(root={"minLastUpdatedTime": 3})).start == 3
    for resource, request in [
        ("labels", Request()),
        ("datapoints", Request(root={"granularity": "d"})),
        ("events", Request({"lastUpdatedTime": {"min": 9, "max": 9}})),
    ]:
        with pytest.raises(ValueError):
            watch_bounds(resource, request)


def test_watch_sees_new_files_and_resumes(spark):
    schema = T.StructType.fromDDL("id long, type string, lastUpdatedTime long")
    folder, (out, checkpoint) = work_path(spark, "table"), paths(spark)
    request = Request({"type": "x", "lastUpdatedTime": {"min": 10, "max": 100}})

    def add(*times):
        table = spark.createDataFrame([(t, "x" if t % 2 else "y", t) for t in times], schema)
        table.write.mode("append").parquet(folder)

    def run():
        watch(spark, folder, schema, "events", request, out, checkpoint, available_now=True).awaitTermination()
        return sorted(r["id"] for r in spark.read.schema(schema).parquet(out).collect())

    add(1, 11, 12, 13, 39)
    assert run() == [11, 13, 39]
    add(31, 99, 101, 9)
    assert run() == [11, 13, 31, 39, 99]
    assert run() == [11, 13, 31, 39, 99]


def test_watch_polls_until_stopped(spark):
    schema = T.StructType.fromDDL("id long, type string, lastUpdatedTime long")
    folder, (out, checkpoint) = work_path(spark, "table"), paths(spark)
    spark.createDataFrame([(1, "x", 1)], schema).write.parquet(folder)
    query = watch(spark, folder, schema, "events", Request(), out, checkpoint, poll_interval_ms=50)
    try:
        query.processAllAvailable()
        spark.createDataFrame([(2, "x", 2)], schema).write.mode("append").parquet(folder)
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.schema(schema).parquet(out).count() == 2


def test_watch_keeps_items(spark):
    points = spark.createDataFrame([("a", 1), ("b", 1), ("a", 9)], "externalId string, timestamp long")
    request = Request(root={"start": 0, "end": 5}, items=({"externalId": "a"},))
    assert watched_rows(points, "datapoints", request).count() == 1


def test_late_rows_are_counted_or_dropped(spark):
    second = 1000
    landing, (out, checkpoint) = work_path(spark, "landing"), paths(spark)
    table = lambda *times: spark.createDataFrame([(t * second,) for t in times], "lastUpdatedTime long")
    counter = DropCounter()
    spark.streams.addListener(counter)

    def run(*times):
        land(table(*times), landing, "lastUpdatedTime", files=1)
        stream = with_event_time(read_landing(spark, landing, table(0).schema), "events", "10 seconds")
        query = (
            window_count(stream, "10 seconds")
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return counter.dropped(query)

    assert run(1, 2, 11, 35) == 0
    assert run(3, 12, 26) == 2
    assert run(60) == 2
    spark.streams.removeListener(counter)
    found = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert found == [(0, 2), (10_000, 1), (20_000, 1), (30_000, 1)]


@pytest.mark.parametrize("mode", ["update", "replace"])
def test_the_row_read_later_wins_within_a_micro_batch(spark, mode):
    log, checkpoint = paths(spark)
    landing = work_path(spark, "landing")
    spark.createDataFrame([(i % 3, i) for i in range(300)], "id long, v long").coalesce(1).write.parquet(landing)
    stream = read_landing(spark, landing, spark.createDataFrame([], "id long, v long").schema)
    stream_upsert(stream, log, checkpoint, available_now=True).awaitTermination()
    found = merge_log(None, spark.read.parquet(log), ["id"], mode=mode)
    assert found.columns == ["id", "v"] and sorted(map(tuple, found.collect())) == [(0, 297), (1, 298), (2, 299)]


def test_a_stream_is_no_delta_read(spark):
    stream = spark.readStream.format("rate").load().select(F.col("value").alias("id"), F.col("value").alias("lastUpdatedTime"))
    with pytest.raises(ValueError, match="delta"):
        delta_read(stream, Request(), None, "db.t", "a")


@pytest.mark.parametrize("mode, wanted", [("update", (1, "z", "y")), ("replace", (1, "z", None))])
def test_change_log(spark, mode, wanted):
    schema = "id long, a string, b string, at long"
    base = spark.createDataFrame([(1, "x", "y", 0), (2, "p", "q", 0)], schema)
    log, checkpoint = paths(spark)
    landing = work_path(spark, "landing")
    for change in ([(1, "w", None, 1), (3, "n", None, 1)], [(1, "z", None, 2)]):
        land(spark.createDataFrame(change, schema), landing, "at", files=1)
        stream_upsert(read_landing(spark, landing, base.schema), log, checkpoint, available_now=True).awaitTermination()
    merged = merge_log(base, spark.read.parquet(log), ["id"], ["at"], mode).select("id", "a", "b")
    found = {r["id"]: tuple(r) for r in merged.collect()}
    assert found == {1: wanted, 2: (2, "p", "q"), 3: (3, "n", None)}


def test_nested_values_survive_the_state(spark):
    schema = "key string, id long, tags map<string,string>, at struct<x:long,y:array<struct<z:string>>>"
    table = spark.createDataFrame(
        [("k", i, {"a": str(i)}, (i, [(f"z{i}",)])) for i in range(5)], schema
    )
    stream = landed(spark, table, "id", max_files=1)
    found = run_until_drained(group_into_batches_stream(stream, ["key"], 3, 500), *paths(spark))
    opened = [i for r in found.collect() for i in r["items"]]
    assert sorted((i["id"], i["tags"]["a"], i["at"]["y"][0]["z"]) for i in opened) == [
        (i, str(i), f"z{i}") for i in range(5)
    ]
