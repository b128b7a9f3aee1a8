"""Optimal length buckets and token-budget batches.

A document is cut into pieces of at most ``longest`` words (nothing is dropped), so the histogram of lengths has at most
``longest + 1`` rows whatever the data, and the driver may hold it. Dynamic programming over it chooses the bounds of at
most ``buckets`` length buckets that minimise the padding of all pieces, exactly. Inside a bucket every batch holds
``budget // bound`` pieces, so a padded batch never exceeds the token budget; only a bucket's last batch may have fewer.

Pieces stand in a bucket by a digest, so a batch mixes sources. Places are counted in slices, each shifted by the slices
before it (``frames.ranked``): a bucket with a third of all pieces isn't one task.

Defined cases: null and empty texts are one piece of length 0 in the first bucket; a null id is text ``\\N`` in the
digest; equal rows are pieces of their own; fewer lengths than buckets give a bucket each; ties between bounds go to the
lower earlier bound; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.frames import hex_slice, let, ranked
from tagloom.llm.text import WORD, word_count

BUCKETS, LONGEST, BUDGET = 12, 2048, 16384


def bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds (inclusive) of at most ``buckets`` buckets of least padding. ``lengths`` ascend and are distinct."""
    n = len(lengths)
    if not n:
        return []
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    many = np.concatenate(([0], np.cumsum(counts)))
    words = np.concatenate(([0], np.cumsum(counts * lengths)))
    best, back = np.full((min(buckets, n) + 1, n + 1), np.iinfo(np.int64).max // 2), np.zeros((min(buckets, n) + 1, n + 1), np.int64)
    best[0, 0] = 0
    for k in range(1, len(best)):
        for j in range(k, n + 1):
            costs = best[k - 1, :j] + lengths[j - 1] * (many[j] - many[:j]) - (words[j] - words[:j])
            back[k, j] = np.argmin(costs)
            best[k, j] = costs[back[k, j]]
    out, j = [], n
    for k in range(len(best) - 1, 0, -1):
        out.append(int(lengths[j - 1]))
        j = back[k, j]
    return out[::-1]


def pieces(docs: DataFrame, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, n_tokens): how the documents are cut."""
    sized = docs.select(F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("_n"))
    last = F.greatest(F.ceil(F.col("_n") / longest) - 1, F.lit(0)).cast("int")
    cut = sized.select("doc_id", "_n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    return cut.select("doc_id", "piece", F.least(F.lit(longest), F.col("_n") - F.col("piece") * longest).cast("long").alias("n_tokens"))


def piece_texts(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(doc_id, piece, tokens): the words of every piece."""
    return _cut_texts(docs, longest).select("doc_id", "piece", _words("piece_text").alias("tokens"))


def _words(name: str) -> Column:
    return F.when(F.col(name) == "", F.array().cast("array<string>")).otherwise(F.split(name, " "))


def _cut_texts(docs: DataFrame, longest: int) -> DataFrame:
    """(doc_id, piece, n_tokens, piece_text): pieces with their words, joined by a space as words hold none."""

    def cut(words: Column) -> Column:
        last = F.greatest(F.ceil(F.size(words) / longest) - 1, F.lit(0)).cast("int")
        part = lambda w: F.struct(F.size(w).cast("long").alias("n_tokens"), F.array_join(w, " ").alias("piece_text"))
        return F.transform(F.sequence(F.lit(0), last), lambda i: let(F.slice(words, i * longest + 1, longest), part))

    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})"))
    parts = docs.select("doc_id", F.posexplode(let(found, cut)).alias("piece", "_part"))
    return parts.select("doc_id", "piece", "_part.n_tokens", "_part.piece_text")


def pack(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, budget: int = BUDGET, texts: bool = False) -> DataFrame:
    """(doc_id, piece, n_tokens, bucket, bucket_len, batch, slot) for every piece of every document.

    With ``texts`` a row has its words, too (``tokens``), so that a batch can be filled from its rows alone; bucket, batch
    and slot name a row, also among copies of one document.
    """
    cut = pieces(docs, longest)
    counted = cut.groupBy("n_tokens").count().orderBy("n_tokens").collect()  # at most longest + 1 rows
    edges = bounds(np.array([r["n_tokens"] for r in counted]), np.array([r["count"] for r in counted]), buckets) or [0]
    number = F.lit(0)
    for edge in edges[:-1]:
        number = number + (F.col("n_tokens") > edge).cast("int")
    edge_of = F.array(*[F.lit(e).cast("long") for e in edges])
    order = ["_place", "n_tokens"]
    if texts:
        cut = _cut_texts(docs, longest).withColumn("_words", F.xxhash64("piece_text"))
        order.append("_words")
    filed = cut.withColumn("bucket", number).withColumn("bucket_len", F.element_at(edge_of, F.col("bucket") + 1))
    filed = filed.withColumn("_place", F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit(r"\N")), F.col("piece").cast("string"))))
    held = F.greatest(F.lit(1), F.floor(budget / F.greatest(F.col("bucket_len"), F.lit(1)))).cast("long")
    placed = ranked(filed, ["bucket"], hex_slice("_place", sum(r["count"] for r in counted)), order, F.lit(1))
    return placed.select(
        "doc_id", "piece", "n_tokens", "bucket", "bucket_len",
        F.floor(F.col("before") / held).cast("long").alias("batch"),
        F.pmod(F.col("before"), held).alias("slot"),
        *([_words("piece_text").alias("tokens")] if texts else []),
    )


def op8_length_buckets(spark, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every piece of every document."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle(table: str = "documents", buckets: int = BUCKETS, longest: int = LONGEST, budget: int = BUDGET) -> str:
    steps = []
    for k in range(2, buckets + 1):
        steps.append(
            f"""f{k} AS (
  SELECT h.i AS j, min(f.cost + h.len * (h.many - p.many) - (h.words - p.words)) AS cost,
         arg_min(list_append(f.edges, h.len), (f.cost + h.len * (h.many - p.many) - (h.words - p.words)) * 100000 + f.j) AS edges
  FROM f{k - 1} f JOIN hist p ON p.i = f.j JOIN hist h ON h.i > f.j GROUP BY h.i, h.len, h.many, h.words)"""
        )
    chained = ",\n".join(steps)
    best = " UNION ALL ".join(f"SELECT edges, {k} AS k FROM f{k} WHERE j = (SELECT max(i) FROM hist)" for k in range(1, buckets + 1))
    return rf"""
WITH sized AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM {table}),
cut AS (SELECT doc_id, unnest(range(greatest(ceil(n / {longest}.0), 1)::BIGINT))::INT AS piece, n FROM sized),
piece AS (SELECT doc_id, piece, least({longest}, n - piece * {longest})::BIGINT AS n_tokens FROM cut),
hist AS (
  SELECT n_tokens AS len, row_number() OVER o AS i, sum(c) OVER o AS many, sum(c * n_tokens) OVER o AS words
  FROM (SELECT n_tokens, count(*) AS c FROM piece GROUP BY 1) WINDOW o AS (ORDER BY n_tokens)),
f1 AS (SELECT i AS j, len * many - words AS cost, [len] AS edges FROM hist),
{chained},
best AS (SELECT edges FROM ({best}) ORDER BY k DESC LIMIT 1),
filed AS (
  SELECT piece.*, len(list_filter(edges[1:len(edges) - 1], lambda e: n_tokens > e))::INT AS bucket, edges FROM piece, best),
placed AS (
  SELECT *, edges[bucket + 1] AS bucket_len,
         row_number() OVER (PARTITION BY bucket ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '\N') || ':' || piece), n_tokens) - 1 AS before
  FROM filed)
SELECT doc_id, piece, n_tokens, bucket, bucket_len,
       before // greatest(1, {budget} // greatest(bucket_len, 1)) AS batch,
       before % greatest(1, {budget} // greatest(bucket_len, 1)) AS slot
FROM placed
"""
