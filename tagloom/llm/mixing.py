"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

1. Targets. Sources in code point order (null last) weigh ``weights`` in turn and share all words by weight. A target
   stops at ``cap`` times its source; the excess is shared again by weight until none is above. The solution of that
   is one level L with target = min(cap * size, L * weight), found with windows over one row per source.
2. Layout. Inside its source a document stands at a pseudo-random place (the order of a digest of id and text), with
   the words before it. Whole passes over the source take every document; what is left of the target takes those whose
   middle lies before the rest, so the words taken miss the target by at most half a document.
3. Blocks of about ``block_words`` words cut the layout. Block quotas per source are exact counts. A binary tree over
   the output shards splits them (above ``MOST_UNITS`` blocks, units of several blocks): each node draws how many blocks of every source go left from the multivariate
   hypergeometric distribution, seeded by the node, so any task can walk to its leaf alone and a lost one walks again.
4. A source's blocks stand in permuted order; shards take disjoint runs of it by their quotas. Inside a shard,
   documents are shuffled by a digest of shard, pass and id.

Defined cases: null text has size 0; a null source is the last source; a source of size 0 has target 0 and is not
taken; equal rows (id, source and text) share their place and are all taken alike; an empty table gives no rows; other
columns of the input do not matter. The driver sees one row per source (its block count), never documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.frames import hex_slice, ranked
from tagloom.llm.text import word_count
from tagloom.session import materialize

#: The generator draws from fewer than this many units in one tree. A unit is one block, or a run of neighbouring turns.
MOST_UNITS = 10**9


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """(source, source_size) to (source, source_size, target). Windows run over one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    named = sizes.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int") + 1).cast("double"))
    by_room = Window.orderBy(cap * F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = named.select(
        "source",
        "source_size",
        "_w",
        F.row_number().over(by_room).alias("_k"),
        (
            (F.sum("source_size").over(by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
            / F.sum("_w").over(by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        ).alias("_level"),
    )
    fits = F.when(F.col("_level") <= cap * F.col("source_size") / F.col("_w"), F.struct("_k", "_level"))
    level = F.coalesce(F.min(fits).over(everything)["_level"], F.lit(0.0))
    return levels.select("source", "source_size", F.least(cap * F.col("source_size").cast("double"), level * F.col("_w")).alias("target"))


def layout(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, block_words: int = 4096, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per distinct (id, source, text): size, copies, source_size, target, block, whole passes and whether the rest takes it."""
    units = (
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("size"),
            F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("mark"),
        )
        .groupBy("doc_id", "source", "size", "mark")
        .agg(F.count("*").alias("copies"))
        .withColumn("place", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("mark"))))
    )
    placed = ranked(units, ["source"], hex_slice("place", docs.count()), ["place"], F.col("size") * F.col("copies"))
    aims = targets(placed.groupBy("source").agg(F.max("total").alias("source_size")), weights, cap)
    aims = aims.select(F.col("source").alias("_source"), "source_size", "target")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    middle = F.col("before") + F.col("size") * F.col("copies") / 2.0
    return (
        placed.join(aims, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("passes", passes)
        .select(
            "doc_id", "source", "mark", "size", "copies", "source_size", "target", "passes", "place",
            ((F.col("size") > 0) & (middle < rest)).alias("rest"),
            F.floor(F.col("before") / block_words).alias("block"),
        )
    )


def splits(quotas: np.ndarray, shards: int, seed: int, shard: int) -> np.ndarray:
    """Walk from the root to one leaf: how many blocks of every source this shard gets."""
    left, right, held = 0, shards, quotas.astype(np.int64)
    base, extra = divmod(int(held.sum()), shards)
    room = lambda i: i * base + min(i, extra)  # noqa: E731  blocks of the shards before i
    while right - left > 1:
        middle = (left + right) // 2
        take = room(middle) - room(left)
        drawn = np.random.default_rng([seed, left, right]).multivariate_hypergeometric(held, take, method="marginals")
        if shard < middle:
            held, right = drawn, middle
        else:
            held, left = held - drawn, middle
    return held


def draw(placed: DataFrame, block_words: int = 4096, shard_words: int = 1 << 21, seed: int = 17, most_units: int = MOST_UNITS) -> DataFrame:
    """Placements of a layout: (doc_id, mark, size, copies, source, epoch, shard, spot), one row per unit and pass it is taken in."""
    spark = placed.sparkSession
    blocks = placed.groupBy("source", "block").agg(F.max("passes").alias("passes"), F.max("rest").alias("rest"))
    instances = blocks.select(
        "source", "block", F.posexplode(F.array_repeat(F.lit(True), F.col("passes") + F.col("rest").cast("int"))).alias("epoch", "_")
    ).drop("_")
    instances = instances.withColumn("turn", F.md5(F.concat_ws(":", F.lit(f"b{seed}"), "source", F.col("block").cast("string"), F.col("epoch").cast("string"))))
    counted = instances.groupBy("source").count().orderBy(F.col("source").asc_nulls_last()).collect()  # one row per source
    names, blocks_of = [r["source"] for r in counted], np.array([r["count"] for r in counted], np.int64)
    total = int(blocks_of.sum())
    unit = 1 + total // most_units
    quotas = -(-blocks_of // unit)  # the last unit of a source may be shorter
    shards = max(1, -(-total * block_words // shard_words))

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                held = splits(quotas, shards, seed, int(shard))
                yield pd.DataFrame({"source": names, "shard": int(shard), "n": held})[held > 0]

    parts = min(shards, spark.sparkContext.defaultParallelism)
    leaf = spark.range(0, shards if total else 0, 1, parts).mapInPandas(leaves, "source string, shard long, n long")
    runs = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    turns = leaf.withColumn("_from", F.coalesce(F.sum("n").over(runs), F.lit(0))).select(
        F.col("source").alias("_source"), "shard", F.explode(F.sequence(F.col("_from"), F.col("_from") + F.col("n") - 1)).alias("_unit")
    )
    permuted = ranked(instances, ["source"], hex_slice("turn", total), ["turn"], F.lit(1))
    dealt = permuted.join(turns, F.col("source").eqNullSafe(F.col("_source")) & (F.floor(F.col("before") / unit) == F.col("_unit")))
    dealt = dealt.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "epoch", "shard")
    taken = placed.join(dealt, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
    return taken.where((F.col("epoch") < F.col("passes")) | F.col("rest")).select(
        "doc_id", "source", "mark", "size", "copies", "epoch", "shard",
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("shard").cast("string"), F.col("epoch").cast("string"), "place")).alias("spot"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, block_words: int = 4096, shard_words: int = 1 << 21, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(layout, placements) of a mix of ``docs`` (doc_id, text, source). The layout is written once, then read by both."""
    placed = materialize(layout(docs, weights, cap, block_words, seed), "mix-layout")
    return placed, draw(placed, block_words, shard_words, seed)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, each shard in one partition, shuffled inside it."""
    _, placements = mix(docs, **options)
    rows = docs.select(F.struct("*").alias("row"), F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("_mark"))
    same = (
        F.col("row.doc_id").eqNullSafe(F.col("doc_id"))
        & (F.col("_mark") == F.col("mark"))
        & F.col("row.source").cast("string").eqNullSafe(F.col("source"))
    )
    dealt = rows.join(placements.select("doc_id", "mark", "source", "shard", "spot"), same)
    return dealt.repartition("shard").sortWithinPartitions("shard", "spot").select("row.*")


def op2_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes from it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    placed, placements = mix(docs)
    times = placements.groupBy("doc_id", "mark", "source").agg(F.count("*").alias("times"))
    times = times.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_m"), F.col("source").alias("_s"), "times")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_m")) & F.col("source").eqNullSafe(F.col("_s"))
    return (
        placed.join(times, same, "left")
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.coalesce("times", F.lit(0))).alias("taken"))
    )


OP2_SQL = r"""
WITH units AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('17:' || doc_id || ':' || md5(coalesce(text, ''))) AS place
  FROM documents),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM units),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM units GROUP BY source),
levels AS (
  SELECT *, row_number() OVER o AS k,
         (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources WINDOW o AS (ORDER BY 3 * source_size / w, source NULLS LAST)),
level AS (SELECT coalesce(arg_min(level, k) FILTER (WHERE level <= 3 * source_size / w), 0.0) AS level FROM levels),
aims AS (
  SELECT source, source_size, least(3 * source_size::DOUBLE, level.level * w) AS target FROM levels, level),
taking AS (
  SELECT doc_id, size::BIGINT AS size, source_size, target, before,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes
  FROM placed JOIN aims ON placed.source IS NOT DISTINCT FROM aims.source)
SELECT doc_id, size, source_size, target,
       (size * (passes + CASE WHEN size > 0 AND before + size / 2.0 < target - passes * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM taking
"""
