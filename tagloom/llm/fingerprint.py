"""Order MinHash fingerprints of whole texts.

A text is the sequence of its k-mers of code points, each numbered among its equals (first, second, ... occurrence).
For each of ``HASHES`` hash functions the ``TUPLE`` numbered k-mers with the least values are selected, put back into
text order and hashed as one tuple. Two texts agree in a place of the fingerprint the more likely the smaller their edit
distance: the set of k-mers, their repeats and their order all count.

The next document of a table (ascending id, then text; after the last the first) comes from one range shuffle: ids are
cut into buckets at quantiles, and the first document of each bucket is also sent to the bucket before. A task streams
its sorted rows and holds two texts at a time.

Defined cases: null text is the empty text, whose fingerprint is all zeros (alike to itself only); a text shorter than k
is one k-mer; null ids come first; equal ids are ordered by text; a table of one row follows itself; an empty table
gives no rows; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tagloom.llm.text import mix

K, TUPLE, HASHES = 8, 2, 32
_U = np.uint64
_SEEDS = mix(np.arange(1, 2 * HASHES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
_XOR = (_SEEDS[:HASHES] >> _U(32)).astype(np.uint32)
_TIMES = (_SEEDS[HASHES:] >> _U(32)).astype(np.uint32) | np.uint32(1)
_MAX = np.uint32(0xFFFFFFFF)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def kmers(points: np.ndarray) -> np.ndarray:
    """Hash of the k-mer at each place."""
    value = mix(points.astype(_U) + _U(0x632BE59BD9B4E019))
    if len(points) < K:
        whole = np.full(min(1, len(points)), len(points), _U)
        for i in range(len(points)):
            whole = mix(whole * _U(0x9FB21C651E98DF25) + value[i : i + 1])
        return whole
    width = 1
    while width < K:  # K is a power of two: windows of 2, 4, 8, ... places
        value = value[:-width] * _U(pow(0x9FB21C651E98DF25, width, 1 << 64)) + value[width:]
        width *= 2
    return mix(value)


def numbered(hashes: np.ndarray) -> np.ndarray:
    """Hash of each k-mer with its occurrence number, in text order."""
    n = len(hashes)
    low = (_U(1) << _U(n.bit_length())) - _U(1)
    ordered = np.sort((hashes & ~low) | np.arange(n, dtype=_U))
    at = (ordered & low).astype(np.int64)
    key = ordered & ~low
    fresh = np.concatenate(([True], key[1:] != key[:-1]))
    index = np.arange(n)
    times = index - np.maximum.accumulate(np.where(fresh, index, 0))
    out = np.empty(n, _U)
    out[at] = mix(hashes[at] + times.astype(_U) * _U(0xD1B54A32D192ED03))
    return out


def fingerprint(points: np.ndarray) -> np.ndarray:
    """``HASHES`` 32-bit tuple hashes."""
    if not len(points):
        return np.zeros(HASHES, np.uint32)
    items = numbered(kmers(points))
    short = (items >> _U(32)).astype(np.uint32)
    picked = np.empty((HASHES, min(TUPLE, len(items))), np.int64)
    rows = max(1, (1 << 17) // len(items))  # hash functions at a time, so that the values stay in the cache
    for a in range(0, HASHES, rows):
        values = (short[None, :] ^ _XOR[a : a + rows, None]) * _TIMES[a : a + rows, None]
        lines = np.arange(len(values))
        for t in range(picked.shape[1]):
            least = values.argmin(axis=1)
            picked[a : a + rows, t] = least
            values[lines, least] = _MAX
    picked.sort(axis=1)
    value = np.zeros(HASHES, _U)
    for t in range(picked.shape[1]):
        value = mix(value * _U(0x9FB21C651E98DF25) + items[picked[:, t]])
    return np.maximum((value >> _U(32)).astype(np.uint32), 1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Part of the places in which two fingerprints agree."""
    return float(np.mean(a == b))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, again, id, text) partitioned and sorted so that a row's next document follows it; ``again`` marks the
    first document of the next bucket, sent along."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = [i / parts for i in range(1, parts)] or [0.5]
    found = rows.agg(F.percentile_approx("id", cuts, 10_000).alias("cuts")).first()["cuts"] or []
    cuts = sorted(set(found))
    bucket = F.lit(0)
    if cuts:
        edges = F.array(*[F.lit(c) for c in cuts])
        bucket = F.coalesce(F.size(F.filter(edges, lambda e: e <= F.col("id"))), F.lit(0))
        bucket = F.when(F.col("id").isNull(), 0).otherwise(bucket)
    rows = rows.withColumn("bucket", bucket)
    firsts = rows.groupBy("bucket").agg(F.min("id").alias("id"), F.max(F.col("id").isNull()).alias("none")).orderBy("bucket").collect()
    # One row per bucket: (first id, the bucket before); the first document of all follows the last bucket's last.
    heads = [(r["bucket"], None if r["none"] else r["id"], firsts[i - 1]["bucket"]) for i, r in enumerate(firsts)]
    if not heads:
        return rows.select("bucket", F.lit(False).alias("again"), "id", "text")
    head = spark.createDataFrame(heads, f"bucket int, first {rows.schema['id'].dataType.simpleString()}, before int")
    # ``head`` has a row per bucket, of which there are as many as shuffle partitions: small enough to send everywhere.
    copied = rows.join(F.broadcast(head), "bucket").select(
        F.explode(
            F.array_compact(
                F.array(
                    F.struct("bucket", F.lit(False).alias("again")),
                    F.when(F.col("id").eqNullSafe(F.col("first")), F.struct(F.col("before").alias("bucket"), F.lit(True).alias("again"))),
                )
            )
        ).alias("to"),
        "id",
        "text",
    )
    sent = copied.select("to.*", "id", "text").repartitionById(max(1, len(cuts) + 1), F.col("bucket").cast("int"))
    return sent.sortWithinPartitions("bucket", "again", "id", "text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, in which the last quarter gives way to the next one's beginning."""
    rows = with_next(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (bucket, id, text, code points, fingerprint) of the row whose next one is awaited
        skip = None  # the bucket whose next document has come
        out: list[tuple] = []
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                bucket, again, key, text = (c[i].as_py() for c in columns)
                if again and skip == bucket:
                    continue
                points = code_points(text)
                mark = fingerprint(points)
                if held is not None:
                    assert held[0] == bucket
                    out.append(_row(*held[1:], text, points, mark))
                held, skip = (None, bucket) if again else ((bucket, key, text, points, mark), None)
                if len(out) >= 1000:
                    yield _batch(out)
                    out = []
        yield _batch(out)

    def _row(key, text, points, mark, next_text, next_points, next_mark) -> tuple:
        q = len(text) // 4
        edited = text[: len(text) - q] + next_text[:q]
        other = fingerprint(np.concatenate((points[: len(points) - q], next_points[:q])))
        return (
            key, len(text), hashlib.sha256(edited.encode()).hexdigest(), mark.astype(">u4").tobytes().hex(),
            other.astype(">u4").tobytes().hex(), likeness(mark, other), likeness(mark, next_mark),
        )

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [to_arrow_type(docs.schema[id_col].dataType), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        values = list(zip(*out)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(values, types)], names)

    return rows.mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


def op4_order_minhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
