"""Stored tables in parts by key, the state store on them, and rollups."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tagloom.operators import keyed, rollup, series
from tagloom.operators.state import StateStore
from tagloom.session import work_path

ROWS = "externalId string, id long, name string"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def table(spark):
    rows = spark.range(2000).select(F.concat(F.lit("k"), F.col("id")).alias("externalId"), "id", F.lit("old").alias("name"))
    return keyed.create(rows, work_path(spark, "test-keyed"), ["externalId"], parts=16)


def files(table):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{table.path.removeprefix('file:')}/data/*/*/*.parquet")}


def test_upsert_rewrites_the_parts_of_its_keys_only(spark, table):
    before = files(table)
    assert len(before) == 16
    written = table.upsert(spark.createDataFrame([("k7", None, "new"), ("fresh", 9000, "new")], ROWS))
    assert written.version == 1 and 1 <= len(written.parts) <= 2
    after = files(table)
    assert {f: after[f] for f in before} == before and len(after) - len(before) == len(written.parts)
    got = {r.externalId: (r.id, r.name) for r in table.read().collect()}
    assert len(got) == 2001 and got["k7"] == (7, "new") and got["fresh"] == (9000, "new") and got["k8"] == (8, "old")
    assert table.read(version=0).where("name = 'new'").count() == 0
    asked = spark.createDataFrame([("k7",), ("k7",), ("nobody",), (None,)], "externalId string")
    assert rows_of(table.read_for(asked)) == [("k7", 7, "new")]


def test_replace_delete_and_vacuum(spark, table):
    table.upsert(spark.createDataFrame([("k1", None, None)], ROWS), mode="replace")
    table.delete(spark.createDataFrame([("k2",), ("k2",), ("nobody",)], "externalId string"))
    got = {r.externalId: (r.id, r.name) for r in table.read().collect()}
    assert len(got) == 1999 and got["k1"] == (1, None) and "k2" not in got
    assert table.vacuum() == 0  # too young to go
    removed = table.vacuum(older_than_ms=-60_000)
    assert removed <= 2 and table.read().count() == 1999
    with pytest.raises(Exception, match="000000000000"):
        table.read(version=0).count()


def test_awkward_writes(spark, table):
    with pytest.raises(ValueError, match="whole key"):
        table.upsert(spark.createDataFrame([(None, 1, "x")], ROWS))
    with pytest.raises(ValueError, match="several incoming rows"):
        table.upsert(spark.createDataFrame([("k1", 1, "x"), ("k1", 1, "y")], ROWS))
    assert table.upsert(spark.createDataFrame([], ROWS)) == (0, [])
    with pytest.raises(ValueError, match="other parts"):
        table.write(lambda stored, rows: stored.withColumn("externalId", F.concat("externalId", F.lit("!"))), spark.createDataFrame([("k1",)], "externalId string"))
    assert table.version() == 0 and table.read().where("name = 'old'").count() == 2000
    with pytest.raises(FileExistsError):
        keyed.create(table.read(), table.path, ["externalId"])
    with pytest.raises(ValueError, match="whole key"):
        keyed.create(spark.createDataFrame([(None, 1, "x")], ROWS), work_path(spark, "test-keyed"), ["externalId"])
    none = keyed.create(spark.createDataFrame([], ROWS), work_path(spark, "test-keyed"), ["externalId"])
    assert none.read().count() == 0
    none.upsert(spark.createDataFrame([("a", 1, "x")], ROWS))
    assert rows_of(none.read()) == [("a", 1, "x")]


def test_a_writer_that_lost_applies_its_change_again(spark):
    """The other writer commits between the first one's read and its commit: on the same part, then on another."""
    path = work_path(spark, "test-marks")
    ours, theirs = StateStore.create(spark, path, parts=1), StateStore.open(spark, path)
    pair = lambda key, high: spark.createDataFrame([(key, high)], "key string, high long")
    ours.expand(pair("a", 5))
    runs = []

    def late(stored, given):
        runs.append(stored.count())
        if len(runs) == 1:
            theirs.expand(pair("a", 90).unionByName(pair("b", 1)))
        from tagloom.operators.state import expand_high

        return expand_high(stored, given)

    assert ours.table.write(late, pair("a", 40)).version == 3
    assert runs == [1, 2] and rows_of(theirs.table.read()) == [("a", 90), ("b", 1)]


def test_a_writer_that_lost_keeps_parts_the_winner_left_alone(spark, table):
    keys = table.read().select("externalId", keyed.part_of({"key": ["externalId"], "parts": 16}).alias("p")).collect()
    part = {r.externalId: r.p for r in keys}
    other = next(k for k, p in part.items() if p != part["k1"])
    runs = []

    def late(stored, given):
        runs.append(1)
        table.upsert(spark.createDataFrame([(other, None, "theirs")], ROWS))
        return stored.withColumn("name", F.when(F.col("externalId") == "k1", "ours").otherwise(F.col("name")))

    written = table.write(late, spark.createDataFrame([("k1",)], "externalId string"))
    assert runs == [1] and written == (2, [part["k1"]])
    got = {r.externalId: r.name for r in table.read().where("name <> 'old'").collect()}
    assert got == {"k1": "ours", other: "theirs"}


def test_state_store(spark):
    store = StateStore.create(spark, work_path(spark, "test-marks"))
    pairs = lambda *p: spark.createDataFrame(p, "key string, high long, ord int")
    store.set(pairs(("a", 9, 1), ("a", 4, 2), ("b", 3, 1), (None, 1, 1), ("c", None, 1)), "ord")
    store.expand(pairs(("a", 2, 1), ("b", 8, 1), ("b", 6, 2), (None, 5, 1), ("d", None, 1)))
    asked = pairs(("a", 0, 0), ("b", 0, 0), ("nobody", 0, 0))
    assert sorted(store.get(asked).collect()) == [("a", 4), ("b", 8), ("nobody", None)]
    store.delete(pairs(("a", 0, 0), (" ", 0, 0), (None, 0, 0)))
    again = StateStore.open(spark, store.table.path)
    assert sorted(again.get(asked).collect(), key=lambda r: r.key) == [("a", None), ("b", 8), ("nobody", None)]


def test_cover():
    assert rollup.cover(5, 5, [10]) == []
    assert rollup.cover(3, 9, [10, 5]) == [(None, 3, 9)]
    assert rollup.cover(3, 27, [10, 5]) == [(None, 3, 5), (5, 5, 10), (10, 10, 20), (5, 20, 25), (None, 25, 27)]
    for start in range(-30, 30, 7):
        for end in range(start + 1, 90, 11):
            found = rollup.cover(start, end, [20, 10, 5])
            assert [t for _, a, b in found for t in range(a, b)] == list(range(start, end))
            assert all(w is None or (a % w == 0 and b % w == 0) for w, a, b in found)


def test_rollup_equals_the_raw_aggregate(spark):
    points = spark.range(6000).select(
        F.concat(F.lit("s"), F.col("id") % 3).alias("externalId"),
        (F.col("id") * 61_000).alias("timestamp"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 101).cast("double")).alias("valueNum"),
    )
    stored = {g: t.cache() for g, t in rollup.tiers(points, ["10m", "h", "d"]).items()}
    names = ["average", "max", "min", "sum", "count"]
    rounded = lambda df: sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.fillna(-1).collect())
    for granularity in ("m", "30m", "2d"):
        for start, end in ((1_234_567, 200_000_001), (5_000, 6_000), (3_600_000, 7_200_000)):
            raw = series.aggregate_datapoints(points, names, granularity, start, end)
            assert rounded(rollup.aggregate_rolled(points, stored, names, granularity, start, end)) == rounded(raw)
    with pytest.raises(ValueError):
        rollup.tiers(points, ["h", "90m"])
    with pytest.raises(ValueError):
        rollup.aggregate_rolled(points, stored, ["median"], "h", 0, 1)


def test_rollup_reads_raw_points_at_the_edges_only(spark):
    points = spark.range(2880).select(F.lit("s").alias("externalId"), (F.col("id") * 60_000).alias("timestamp"), F.lit(1.0).alias("valueNum"))
    stored = rollup.tiers(points, ["10m", "h"])
    wrong = points.where((F.col("timestamp") < 600_000) | (F.col("timestamp") >= 170_400_000))  # the middle is not in the raw points
    found = rollup.aggregate_rolled(wrong, stored, ["count"], "d", 60_000, 172_800_000 - 60_000)
    assert rounded_counts(found) == [1439, 1439]


def rounded_counts(df):
    return sorted(r["count"] for r in df.collect())
