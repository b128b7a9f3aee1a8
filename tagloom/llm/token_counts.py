"""Token counts of whole texts, with huge texts encoded in overlapping chunks that are spliced where they agree.

A text of at most ``huge`` code points is counted by its task. It is cut before spaces that follow a visible ASCII
character: the byte-level pattern always ends a word there, and merges never cross words, so the counts of the parts add
up. Short parts are remembered by the worker, as many as two tables of ``MOST_PARTS`` hold. Vocabularies with another
pre-tokenizer or a normalizer get whole texts.

A longer text is cut into chunks of ``step`` code points that run on by ``overlap`` into the next chunk, and the chunks
are spread over all tasks. Each chunk is encoded with offsets and says at which code points of its two overlaps a word
begins, and how many of its tokens stand before. The pattern decides a word from its own beginning on and reads at most
two code points more than it takes, and a special string is read whole: so once both chunks begin a word at the
same place, ``margin`` or more before the earlier one ends, they agree from there on. Two chunks are spliced at the first
such place. Where there is none (a word longer than the overlap, a long stretch of white space) the overlap is widened to
the whole next chunk: the two become one chunk, which is encoded again, until every splice is proven. This holds for the
byte-level pattern; texts of other vocabularies are not cut.

Memory: a task holds one text, a slice of about ``SLICE`` bytes of texts, or the encoding of one chunk. A word without
any boundary is one chunk, however long it is.

Defined cases: null text is empty and has no tokens; null and repeated ids are rows of their own; empty tables give no
rows; other columns do not matter; a text that holds a special string gets its one id, as by the library's default.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tagloom.llm.text import slices, string_parts
from tagloom.session import materialize

VOCABULARY = "byte_bpe_50k.json"
HUGE, STEP, OVERLAP, LIMIT = 1 << 16, 1 << 15, 1024, 1024
SLICE = 1 << 20
# Parts of at most SHORT bytes are remembered, MOST_PARTS of them at a time; the rest are encoded when they are met.
SHORT, MOST_PARTS = 48, 1 << 18

_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_loaded: dict[str, Counter] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Counter:
    """A vocabulary and the token counts of the parts met so far."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's own core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        stated = json.loads(self.tokenizer.to_str())
        split = stated.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        special = [t["content"] for t in stated["added_tokens"]]
        self.cuts = bool(plain and stated.get("normalizer") is None and not any(" " in s for s in special)
                         and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in stated["added_tokens"]))
        self.margin = 4 + max([len(s) for s in special], default=0)
        self.known: dict[bytes, int] = {}
        self.earlier: dict[bytes, int] = {}

    def encode(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)

    def counts(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Number of tokens of each of the texts that lie between ``bounds`` in the UTF-8 bytes ``raw``."""
        raw = raw[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        edge = np.zeros(len(raw) + 1, bool)
        edge[bounds] = True
        if self.cuts and len(raw) > 1:
            edge[1:-1] |= _VISIBLE[raw[:-1]] & (raw[1:] == 32)
        at = np.flatnonzero(edge)
        if len(at) < 2:
            return np.zeros(len(bounds) - 1, np.int64)
        parts = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))])
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        sizes = [self.known.get(p, -1) for p in distinct]
        new = [i for i, n in enumerate(sizes) if n < 0]
        if self.earlier:
            for i in new:
                sizes[i] = self.earlier.get(distinct[i], -1)
        unmet = [i for i in new if sizes[i] < 0]
        for a in range(0, len(unmet), 4096):
            some = unmet[a : a + 4096]
            for i, found in zip(some, self.encode([distinct[i].decode() for i in some])):
                sizes[i] = len(found)
        if len(self.known) + len(new) > MOST_PARTS:
            self.known, self.earlier = {}, self.known
        self.known.update((distinct[i], sizes[i]) for i in new if len(distinct[i]) <= SHORT)
        total = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64)[coded.indices.to_numpy()])))
        return np.diff(total[np.searchsorted(at, bounds)])

    def starts(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Where words begin, how many tokens stand before each of them, and the number of tokens."""
        found = self.encode([text])[0]
        n = len(found)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        words = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
        first = np.flatnonzero(np.concatenate(([True], (words[1:] != words[:-1]) | (words[1:] < 0))))
        places = np.array([p for p, _ in found.offsets], np.int64)
        return places[first], first, n


def counter(path: str) -> Counter:
    """The vocabulary of this Python worker; only its path travels."""
    if path not in _loaded:
        _loaded[path] = Counter(path)
    return _loaded[path]


def _cut(docs: DataFrame, id_col: str, text_col: str, path: str, huge: int, step: int, overlap: int) -> DataFrame:
    """(row, id, n_bytes, n_tokens, chunk, text): counted texts with no chunk, and the chunks of huge ones."""
    kind = docs.schema[id_col].dataType
    schema = f"row long, id {kind.simpleString()}, n_bytes long, n_tokens long, chunk long, text string"
    types = [pa.int64(), to_arrow_type(kind), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = ["row", "id", "n_bytes", "n_tokens", "chunk", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, (raw, bounds) = batch.column(0), string_parts(batch.column(1))
            for first, last in slices(bounds, SLICE):
                sizes = np.diff(bounds[first : last + 1])
                if last == first + 1 and sizes[0] > huge and known.cuts:
                    text = raw[bounds[first] : bounds[last]].tobytes().decode()
                    if len(text) > huge:
                        held = [row, ids[first].as_py(), int(sizes[0]), None]
                        for i in range(0, max(1, -(-(len(text) - overlap - known.margin) // step))):
                            piece = text[i * step : (i + 1) * step + overlap + known.margin]
                            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([*held, i, piece], types)], names)
                        row += 1
                        continue
                counted = known.counts(raw, bounds[first : last + 1])
                rows = last - first
                values = [np.arange(row, row + rows), ids.slice(first, rows), sizes, counted, [None] * rows, [None] * rows]
                row += rows
                yield pa.RecordBatch.from_arrays([pa.array(v, t) if not isinstance(v, pa.Array) else v.cast(t) for v, t in zip(values, types)], names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


_EDGES = "array<struct<place:long,before:long>>"


def _encoded(chunks: DataFrame, path: str, step: int, overlap: int) -> DataFrame:
    """(row, chunk, last, n, left, right): tokens of each chunk, and the words that begin in its two overlaps.

    ``chunk``..``last`` are the numbers of the chunks that it is made of; places are those of the whole text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in batches:
            for row, chunk, last, final, text in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                begin = chunk * step
                places, before, n = known.starts(text)
                places = places + begin
                edges = []
                for low, ends in ((begin, begin + overlap), ((last + 1) * step, (last + 1) * step + overlap)):
                    inside = (places >= low) & (places < ends)
                    edges.append([{"place": int(p), "before": int(b)} for p, b in zip(places[inside], before[inside])])
                yield pa.RecordBatch.from_pylist(
                    [{"row": row, "chunk": chunk, "last": last, "n": n, "left": edges[0], "right": [] if final else edges[1]}], out
                )

    edge = pa.list_(pa.struct([("place", pa.int64()), ("before", pa.int64())]))
    out = pa.schema([("row", pa.int64()), ("chunk", pa.int64()), ("last", pa.int64()), ("n", pa.int64()), ("left", edge), ("right", edge)])
    return chunks.select("row", "chunk", "last", "final", "text").mapInArrow(run, f"row long, chunk long, last long, n long, left {_EDGES}, right {_EDGES}")


def _splices(encoded: DataFrame) -> DataFrame:
    """(row, chunk, gain): for each chunk that another one follows, its tokens up to the first common beginning less those
    of the next chunk up to there; null where they share none."""
    ends = encoded.select("row", (F.col("last") + 1).alias("next"), "chunk", F.col("right"))
    heads = encoded.select("row", F.col("chunk").alias("next"), "left")
    met = ends.join(heads, ["row", "next"])
    common = F.array_min(F.array_intersect(F.col("right.place"), F.col("left.place")))
    before = lambda side: F.element_at(F.filter(side, lambda e: e["place"] == F.col("at")), 1)["before"]
    return met.withColumn("at", common).select(
        "row", "chunk", F.when(F.col("at").isNotNull(), before(F.col("right")) - before(F.col("left"))).alias("gain")
    )


def _widened(chunks: DataFrame, splices: DataFrame, step: int) -> DataFrame:
    """The chunks, with every chunk that shares no beginning with the next one put together with it."""
    flags = chunks.select("row", "chunk").join(splices.where(F.col("gain").isNull()).select("row", "chunk", F.lit(1).alias("open")), ["row", "chunk"], "left")
    along = W.partitionBy("row").orderBy("chunk")
    # A chunk opens a group of its own unless the chunk before it is open.
    opened = flags.withColumn("fresh", F.coalesce(F.lag("open").over(along), F.lit(0)) == 0)
    grouped = opened.withColumn("first", F.max(F.when(F.col("fresh"), F.col("chunk"))).over(along)).select("row", "chunk", "first")
    # All but the last chunk of a group give their own part, without the overlap.
    parts = chunks.join(grouped, ["row", "chunk"]).withColumn("width", (F.col("last") + 1 - F.col("chunk")) * step)
    put = parts.groupBy("row", "first").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "width", "last", "final", "text"))).alias("p")
    )
    size = F.size("p")
    own = F.transform("p", lambda x, i: F.when(i < size - 1, F.substring(x["text"], F.lit(1), x["width"].cast("int"))).otherwise(x["text"]))
    end = F.element_at("p", -1)
    return put.select("row", F.col("first").alias("chunk"), end["last"].alias("last"), end["final"].alias("final"), F.concat_ws("", own).alias("text"))


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", huge: int = HUGE, step: int = STEP, overlap: int = OVERLAP
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every text by the vocabulary at ``path``, a file that every executor has."""
    if not 0 < overlap < step <= huge:
        raise ValueError("overlap must be less than step, and step at most huge")
    cut = materialize(_cut(docs, id_col, text_col, path, huge, step, overlap), "token-chunks")
    whole = cut.where(F.col("chunk").isNull()).select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens")
    pieces = cut.where(F.col("chunk").isNotNull())
    ends = pieces.groupBy("row").agg(F.max("chunk").alias("end"))
    chunks = pieces.join(ends, "row").select(
        "row", "chunk", F.col("chunk").alias("last"), (F.col("chunk") == F.col("end")).alias("final"), "text"
    )
    while True:
        encoded = materialize(_encoded(chunks.repartition("row", "chunk"), path, step, overlap), "token-edges")
        splices = _splices(encoded)
        if splices.where(F.col("gain").isNull()).isEmpty():
            break
        chunks = materialize(_widened(chunks, splices, step), "token-chunks-wider")
    last = encoded.groupBy("row").agg(F.max_by("n", "chunk").alias("n_tokens"))
    gains = splices.groupBy("row").agg(F.sum("gain").alias("gain"))
    heads = pieces.where(F.col("chunk") == 0).select("row", "id", "n_bytes")
    long = heads.join(last, "row").join(gains, "row", "left")
    return whole.unionByName(
        long.select(F.col("id").alias("doc_id"), "n_bytes", (F.col("n_tokens") + F.coalesce("gain", F.lit(0))).alias("n_tokens"))
    )


def op13_token_counts(spark, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it passes ``LIMIT`` tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, vocabulary_path()).withColumn("over_limit", F.col("n_tokens") > LIMIT)
