"""What only large tables reach, reached on small ones by smaller parameters."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from tagloom.llm import mixing, mtree
from tagloom.llm.frames import hex_slice, ranked
from tests.llm.helpers import sentence


def brute(rows, asked, k):
    whole = lambda v: [int(np.floor(1024 * x)) for x in v]
    out = []
    for i, v in asked:
        scored = sorted((-sum(a * b for a, b in zip(whole(v), whole(w))), j) for j, w in rows if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_cells_split_by_distance_until_they_are_pages(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 8)) * 20
    rows = [(i, (centres[i % 40] + rng.normal(size=8) * 0.05).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    tree, width, reach = mtree.pages(df, "vec_id", "embedding", page=50)
    held = [np.frombuffer(r.ids, np.int64) for r in tree.collect()]
    assert sorted(np.concatenate(held).tolist()) == list(range(3000))
    assert max(len(h) for h in held) <= 50
    assert np.mean([len(set((h % 40).tolist())) for h in held]) < 1.5  # pages hold neighbours
    queries = df.where("vec_id % 20 = 0")
    assert found(mtree.top_k(df, queries, 4, page=50, block=16)) == brute(rows, [r for r in rows if r[0] % 20 == 0], 4)


def test_the_directory_excludes_pages_before_the_join(spark):
    rng = np.random.default_rng(6)
    turns = rng.normal(size=(30, 6))
    turns = 10 * turns / np.linalg.norm(turns, axis=1)[:, None]
    rows = [(i, (turns[i % 30] + rng.normal(size=6) * 0.01).tolist()) for i in range(2400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    tree, width, reach = mtree.pages(df, "vec_id", "embedding", page=40)
    upper = mtree.directory(tree, size=16)
    asked = mtree.whole(df.where("vec_id % 24 = 0"), "vec_id", "embedding").withColumnRenamed("id", "query_id")
    homes = mtree.at_home(asked, upper, width, 8).withColumn("floor", F.lit(0.9 * 1024 * 1024 * 100))
    blocks = mtree._blocks(homes, ["block"], width)
    pairs = mtree.reachable(upper, blocks, width, reach)
    assert 0 < pairs.count() < 0.5 * tree.count() * blocks.count()


def test_equal_vectors_and_repeated_rows_fill_pages(spark):
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(300 + i, [float(i), 1.0]) for i in range(20)]
    df = spark.createDataFrame(rows + rows[:1] * 150, "vec_id long, embedding array<double>")
    tree, _, _ = mtree.pages(df, "vec_id", "embedding", page=40)
    sizes = [len(r.ids) // 8 for r in tree.collect()]
    assert sum(sizes) == 470 and max(sizes) <= 40
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(mtree.top_k(plain, plain.where("vec_id IN (5, 310)"), 6, page=40, block=1)) == brute(rows, [rows[5], rows[310]], 6)


def test_mix_deals_units_of_several_blocks(spark):
    docs = spark.createDataFrame([(i, sentence(i, 20 + i % 30), "abc"[i % 7 % 3]) for i in range(150)], "doc_id long, text string, source string")
    placed, one = mixing.mix(docs, block_words=50, shard_words=400)
    several = mixing.draw(placed, 50, 400, most_units=7)
    taken = lambda df: sorted((r.doc_id, r.epoch) for r in df.collect())
    assert taken(one) == taken(several)
    assert several.select("shard").distinct().count() > 1


def test_slices_follow_the_number_of_rows(spark):
    rows = [(i % 3, hashlib.md5(str(i).encode()).hexdigest(), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g int, d string, w long")
    few, many = (sorted(ranked(df, ["g"], hex_slice("d", n), ["d"], F.col("w")).collect()) for n in (0, 10**9))
    assert few == many
    assert df.select(hex_slice("d", 10**9).alias("s")).distinct().count() > 1500
