"""One key that holds most rows: results stay whole, caps hold, and results equal a plain computation."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.operators import batching, hierarchy, reads
from tagloom.operators.matching import match_entities


@pytest.fixture(scope="module")
def skewed(spark):
    """20 000 rows, a third of them under one key."""
    table = spark.range(20_000).withColumn("key", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50))
    return table.withColumn("name", F.concat(F.lit("n"), F.col("id")))


@pytest.mark.parametrize("order", ["id", "name"])
def test_batches_are_exact(spark, skewed, order):
    batches = batching.group_into_batches(skewed, ["key"], 128, [order], hot_rows=500)
    sizes = batches.select("key", "batch", F.size("items").alias("n"))
    last = W.partitionBy("key").orderBy(F.desc("batch"))
    marked = sizes.withColumn("last", F.row_number().over(last) == 1)
    assert marked.where("not last and n <> 128").count() == 0
    assert sizes.agg(F.max("n"), F.sum("n")).first() == (128, 20_000)
    assert batching.explode_batches(batches).select("id").distinct().count() == 20_000


@pytest.mark.parametrize("order", [["id"], ["name"], ["name", "id"]])
def test_the_order_is_the_same_at_every_size(spark, skewed, order):
    numbered = lambda hot: batching.assign_batches(skewed, ["key"], 128, order, hot_rows=hot)
    assert numbered(500).exceptAll(numbered(10**6)).count() == 0
    first = batching.group_into_batches(skewed.where("key = -1"), ["key"], 128, ["name"], hot_rows=500).where("batch = 0")
    wanted = sorted(f"n{i}" for i in range(0, 20_000, 3))[:128]
    assert sorted(i["name"] for i in first.first()["items"]) == wanted


def test_outliers_do_not_fill_a_slice(spark, monkeypatch):
    """3000 close values and one far away: the slices are written, so their sizes can be seen."""
    table = spark.range(3000).union(spark.createDataFrame([(10**12,)], "id long")).withColumn("key", F.lit("k"))
    written = {}
    plain = batching.materialize
    monkeypatch.setattr(batching, "materialize", lambda df, label: written.setdefault(label, plain(df, label)))
    assert batching.assign_batches(table, ["key"], 100, ["id"], hot_rows=100).where("batch = 30").count() == 1
    sizes = [r["count"] for r in written["slices"].groupBy("_slice").count().collect()]
    assert sum(sizes) == 3001 and max(sizes) <= 2 * 100


@pytest.mark.parametrize("hot", [500, 10**6])
def test_running_totals_equal_a_window(spark, skewed, hot):
    found = batching.running_totals(skewed, ["key"], ["id"], {"ones": F.lit(1), "ids": F.col("id")}, hot)
    before = W.partitionBy("key").orderBy("id").rowsBetween(W.unboundedPreceding, -1)
    wanted = skewed.select(
        "*", F.count("*").over(before).alias("ones"), F.coalesce(F.sum("id").over(before), F.lit(0)).alias("ids")
    )
    assert found.exceptAll(wanted).count() == 0 and wanted.exceptAll(found).count() == 0


def test_datapoint_batches_keep_the_caps(spark):
    points = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 100).alias("series"),
        (F.col("id") * 40_000).alias("timestamp"),
    )
    found = batching.batch_datapoints(points, 200, 15, 50, 3, series="series", hot_rows=300)
    assert found.count() == 6000 and found.select("series", "timestamp").distinct().count() == 6000
    key = ["day", "level", "shard", "part", "batch", F.when(F.col("level") == "series", F.col("series")).alias("own")]
    caps = found.groupBy(*key).agg(F.count("*").alias("n"), F.countDistinct("series").alias("s"))
    worst = caps.agg(F.max("n"), F.max("s")).first()
    assert worst[0] <= 200 and worst[1] <= 15


def test_requests_for_a_hot_value(spark, skewed):
    table = skewed.withColumn("lastUpdatedTime", F.col("id") * 1000)
    asked = spark.createDataFrame(
        [(1, -1, None, None), (2, None, 5_000_000, 9_000_000), (3, None, None, None), (4, None, 10**12, None), (5, -1, None, 70_000), (6, 7, 0, 10**12)],
        "request_id int, key long, min long, max long",
    )
    found = reads.list_many(table, asked, {"key": F.col("key")}, bucket_ms=1_000_000)
    wanted = table.alias("t").join(
        asked.alias("r"),
        (F.col("r.key").isNull() | (F.col("r.key") == F.col("t.key")))
        & (F.col("min").isNull() | (F.col("lastUpdatedTime") >= F.col("min")))
        & (F.col("max").isNull() | (F.col("lastUpdatedTime") <= F.col("max"))),
    )
    counts = lambda df: sorted(tuple(r) for r in df.groupBy("request_id").count().collect())
    assert counts(found) == counts(wanted)
    hits = reads.aggregate_many(table, asked, {"key": F.col("key")})
    assert dict(map(tuple, hits.collect()))[4] == 0


def test_dyadic_covers(spark):
    pairs = [(lo, hi) for lo in range(19) for hi in range(lo - 1, 19) if hi - lo < 18]
    asked = spark.createDataFrame(pairs, "lo long, hi long")
    for r in asked.withColumn("nodes", reads.dyadic_cover(F.col("lo"), F.col("hi"), 5)).collect():
        held = [x for n in r.nodes for x in range(n.node << n.level, (n.node + 1) << n.level)]
        assert sorted(held) == list(range(r.lo, r.hi + 1)) and len(r.nodes) <= 9


def test_many_open_and_wide_requests_share_no_task(spark):
    table = spark.range(20_000).select("id", (F.col("id") * 86_400).alias("lastUpdatedTime"))
    asked = spark.range(3000).select(
        F.col("id").alias("request_id"),
        F.when(F.col("id") % 3 > 0, F.col("id") * 10_000).alias("min"),
        F.when(F.col("id") % 3 == 1, F.col("id") * 10_000 + 86_400 * F.pmod(F.col("id") * 7, F.lit(40))).alias("max"),
    )
    narrow = asked.where("request_id % 300 < 30")
    seen = []
    keep = reads.small_side
    reads.small_side = lambda df, **_: seen.append(df) or df  # the shuffled join
    try:
        found = reads.list_many(table, narrow, {}, bucket_ms=500_000)
        got = {r.request_id: r.n for r in found.groupBy("request_id").agg(F.count("*").alias("n")).collect()}
    finally:
        reads.small_side = keep
    want = {}
    for r in narrow.collect():
        n = sum((r.min is None or t >= r.min) and (r.max is None or t <= r.max) for t in range(0, 20_000 * 86_400, 86_400))
        if n:
            want[r.request_id] = n
    assert got == want
    # Open requests meet the rows under as many keys as there are salts, and wide ones under their part of them.
    salts = {r._r_level: r.n for r in seen[-1].groupBy("_r_level").agg(F.countDistinct("_r_salt").alias("n")).collect()}
    top = max(salts)
    assert salts[top] == 8 and all(salts[level] >= 8 >> (top - level) for level in salts)


def test_requests_are_taken_apart_once(spark):
    """Each request is counted where it is read; one of them names a row twice, so all are looked at again."""
    table = spark.range(20).select("id", (F.col("id") * 1000).alias("lastUpdatedTime"))
    read = spark.sparkContext.accumulator(0)

    def counted(k):
        read.add(1)
        return k

    asked = spark.createDataFrame([(1, 3, None, None), (1, None, 0, 5000), (2, 4, None, None)], "request_id long, kind long, min long, max long")
    asked = asked.repartition(1).withColumn("kind", F.udf(counted, "long").asNondeterministic()("kind"))
    assert reads.list_many(table, asked, {"kind": F.col("id")}).count() == 7
    assert read.value == 3


def test_requests_cut_into_many_nodes_are_not_broadcast(spark):
    """30 000 requests in a small file are over 200 000 rows once they stand under their nodes and salts."""
    table = spark.range(100).select("id", (F.col("id") * 86_400_000).alias("lastUpdatedTime"))
    asked = spark.range(30_000).select(F.col("id").alias("request_id"), F.lit(None).cast("long").alias("min"), F.lit(None).cast("long").alias("max"))
    plan = reads.list_many(table, asked, {})._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_summaries_equal_the_listed_rows_without_pairs(spark, monkeypatch):
    times = F.when(F.col("id") % 7 > 0, F.col("id") % 500 * 1000)
    table = spark.range(3000).select("id", (F.col("id") % 4).alias("kind"), times.alias("lastUpdatedTime"))
    low, high = F.col("id") * 37 % 600 * 1000, F.col("id") * 53 % 600 * 1000 + F.col("id") % 2
    asked = spark.range(400).select(
        F.col("id").alias("request_id"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 6).alias("kind"),
        F.when(F.col("id") % 5 < 3, low).alias("min"),
        F.when(F.col("id") % 5 % 2 == 0, high).alias("max"),
    )
    # One request of two kinds in one range: no row meets it twice.
    asked = asked.union(spark.createDataFrame([(900, 1, 5000, 70_000), (900, 2, 5000, 70_000)], asked.schema))
    at = F.col("lastUpdatedTime")
    facts = lambda df: df.groupBy("request_id").agg(F.count("*").alias("count"), F.min(at).alias("first"), F.max(at).alias("last"))
    rows = lambda df: sorted(map(tuple, df.collect()))
    fields = {"kind": F.col("kind")}
    several = spark.createDataFrame([(901, 1, None, 70_000), (901, None, 50_000, 90_000)], asked.schema)
    wanted, mixed = rows(facts(reads.list_many(table, asked, fields))), rows(facts(reads.list_many(table, several, fields)))
    assert rows(reads.summarize_many(table, several, fields)) == mixed
    assert rows(reads.summarize_many(table, asked.union(several), fields)) == wanted + mixed
    assert rows(reads.summarize_many(table.where("id < 0"), asked, fields)) == []
    for hot in (10**6, 100):
        monkeypatch.setattr(reads, "running_totals", lambda *a, hot=hot: batching.running_totals(*a, hot_rows=hot))
        monkeypatch.setattr(reads, "_hits", None)  # rows and requests are not paired
        assert rows(reads.summarize_many(table, asked, fields)) == wanted
        assert sum(r["count"] for r in reads.aggregate_many(table, asked, fields).collect()) == sum(w[1] for w in wanted)
        monkeypatch.undo()


def test_rows_named_twice_are_delivered_once(spark):
    table = spark.createDataFrame([(7, "e7", 5), (8, "e8", 6), (9, None, None)], "id long, externalId string, lastUpdatedTime long")
    texts = [(1, '{"items":[{"id":7},{"externalId":"e7"},{"id":9}]}'), (2, '{"items":[{"externalId":"e8"}]}'), (2, '{"minLastUpdatedTime":6}'), (3, "{}"), (3, "{}")]
    asked = reads.parse_requests(spark.createDataFrame(texts, "request_id int, request string"), ["id", "externalId"])
    fields = {"id": F.col("id").cast("string"), "externalId": F.col("externalId")}
    found = reads.list_many(table, asked, fields)
    assert sorted((r.request_id, r.id) for r in found.collect()) == [(1, 7), (1, 9), (2, 8), (3, 7), (3, 8), (3, 9)]
    assert sorted(map(tuple, reads.aggregate_many(table, asked, fields).collect())) == [(1, 2), (2, 1), (3, 3)]


def test_deep_chains_are_deleted_in_few_rounds(spark, monkeypatch):
    written = []
    keep = hierarchy.materialize
    monkeypatch.setattr(hierarchy, "materialize", lambda df, label: written.append(label) or keep(df, label))
    kind = "id long, externalId string, parentExternalId string"
    up = F.when(F.col("id") % 5000 > 0, F.concat(F.lit("n"), F.col("id") - 1))
    chains = spark.range(10_000).select("id", F.concat(F.lit("n"), "id").alias("externalId"), up.alias("parentExternalId"))
    # A ring that a listed node hangs in, and one that none leads into.
    rings = spark.createDataFrame([(20_000 + i, f"n{20_000 + i}", f"n{20_000 + i // 9 * 9 + (i + 1) % 9}") for i in range(18)], kind)
    table = chains.unionByName(rings)
    items = spark.createDataFrame([(None, "n40"), (20_003, None)], "id long, externalId string")
    remaining, deleted = hierarchy.delete_assets(table, items)
    gone = {r.id for r in deleted.collect()}
    assert gone == set(range(40, 5000)) | set(range(20_000, 20_009))
    assert remaining.count() == 10_018 - len(gone) and len(written) < 25


def _cosine(a, b):
    return len(a & b) / (len(a) * len(b)) ** 0.5


def test_a_word_that_all_names_share_pairs_few_of_them(spark, monkeypatch):
    import tagloom.operators.matching as matching

    joined = []
    keep = matching.materialize
    monkeypatch.setattr(matching, "materialize", lambda df, label: joined.append((label, out := keep(df, label))) or out)
    name = lambda tag: F.concat(F.lit("place "), F.lit(tag), F.col("id"))
    sources = spark.range(6000).select("id", name("a").alias("name"))
    targets = spark.range(6000).select("id", F.concat(name("b"), F.when(F.col("id") % 2 == 0, " more").otherwise("")).alias("name"))
    found = match_entities(sources, targets, [("name", "name")], max_matches=2)
    assert found.groupBy("target_id").count().orderBy("target_id").collect() == [(1, 6000), (3, 6000)]
    # Each source looked at one block of the word; all its other blocks hold worse or later targets.
    assert [df.count() for label, df in joined if label == "open"][1:] == [0]


def test_sources_that_differ_in_unknown_words_are_matched_once(spark, monkeypatch):
    import tagloom.operators.matching as matching

    written = []
    keep = matching.materialize
    monkeypatch.setattr(matching, "materialize", lambda df, label: written.append((label, out := keep(df, label))) or out)
    monkeypatch.setattr(matching, "COMMON_ENTITIES", 50)
    sources = spark.range(300).select("id", F.concat(F.lit("order place "), "id").alias("name"))
    targets = spark.range(100).select("id", F.concat(F.lit("stop place x"), "id", F.when(F.col("id") % 50 == 7, " 7").otherwise("")).alias("name"))
    found = match_entities(sources, targets, [("name", "name")], max_matches=2)
    by_source = {}
    for r in found.orderBy("rank").collect():
        by_source.setdefault(r.source_id, []).append((r.target_id, round(r.score, 6)))
    assert by_source.pop(7) == [(7, 0.57735), (57, 0.57735)]
    assert len(by_source) == 299 and all(m == [(0, 0.333333), (1, 0.333333)] for m in by_source.values())
    # Two kinds of sources: those that hold the 7 as well, and all the others.
    assert [df.count() for label, df in written if label == "open"][0] == 2


def test_a_source_whose_match_is_sure_is_given_no_blocks(spark, monkeypatch):
    import tagloom.operators.matching as matching

    plain = matching._probes
    monkeypatch.setattr(matching, "_probes", lambda: F.when(F.raise_error(F.lit("a source was given blocks")).isNull(), plain()))
    sources = spark.range(200).select("id", F.concat(F.lit("customer "), "id").alias("name"))
    targets = sources.select("id", F.concat("name", F.lit(" account")).alias("name"))
    found = match_entities(sources, targets, [("name", "name")]).collect()
    assert len(found) == 200 and all(r.source_id == r.target_id for r in found)


@pytest.mark.parametrize("first_block", [1, 3, 32])
@pytest.mark.parametrize("k, threshold", [(1, 0.0), (3, 0.0), (2, 0.55)])
def test_matching_equals_brute_force(spark, k, threshold, first_block):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    text = lambda n: " ".join(["common"] + rng.sample(words, n))
    sources = [(i, text(rng.randint(0, 4))) for i in range(60)]
    targets = [(i, text(rng.randint(1, 4))) for i in range(80)]
    sources += [(1000 + i, sources[0][1]) for i in range(40)]
    targets += [(1000 + i, targets[0][1]) for i in range(40)]
    found = match_entities(
        spark.createDataFrame(sources, "id int, name string"),
        spark.createDataFrame(targets, "id int, name string"),
        [("name", "name")],
        max_matches=k,
        threshold=threshold,
        first_block=first_block,
    )
    wanted = []
    for sid, s in sources:
        scored = [(-round(_cosine(set(s.split()), set(t.split())), 9), tid) for tid, t in targets]
        for rank, (score, tid) in enumerate(sorted(x for x in scored if x[0] < 0 and -x[0] >= threshold)[:k]):
            wanted.append((sid, tid, -score, rank + 1))
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted)
