"""Word bigram model with Katz backoff, and the log probability of every text under it.

Tokens are the words of a text, then one end; the first one follows the start. Counts c(v, w) and c(w) come from the
training texts. With Good-Turing discounts d for small counts,

    P(w | v) = d(c(v, w)) * c(v, w) / c(v)      for a pair that training has,
    P(w | v) = backoff(v) * P(w)                otherwise, backoff(v) = (1 - sum of the first kind) / (1 - sum of P(w) over it),
    P(w)     = d(c(w)) * c(w) / N, and the rest of the mass for all words that training lacks, as one unknown word.

A context that training lacks backs off with weight 1. So P(. | v) sums to 1 over the training words, end and the
unknown word, exactly. Counts above ``MOST`` lose ``LEAST_LOSS`` of one count, so that every context leaves some mass.

Plan. Tokens are dealt by their second word, so a task has all pairs of its words: it counts words and pairs exactly
and, once the counts of counts are known, knows every seen pair's probability and the unseen pairs' P(w). Sums travel on
per text; contexts are summed over tasks, and meet the unseen pairs in one join. The counts of counts come from the same
shuffle, read again. Words that make a thousandth of a sample of tokens (at most a thousand words) are dealt by both
words, their counts are taken beforehand. Second words travel once per batch of texts, first words as a code of two
bytes where a word list of fixed size has them; the sample that gives both lists affects no result. A context is known
by the lower 48 bits of its hash.

Defined cases: null and empty texts are one end; a null id is in training; equal rows are scored alike and counted
each; no training texts: every word is unknown and P is 1 for it (score 0), the base score uses N = V = 0; an empty
table gives no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.text import mix, slices, string_parts, word_batches

MOST, LEAST_LOSS = 5, 1e-3
SAMPLE_TEXTS, CODES, FREQUENT = 4000, 65_535, 1000
PIECE_BYTES = 12 << 20
_U = np.uint64
START, END = mix(np.array([0x5354415254, 0x454E44], _U))
_LOW48 = _U((1 << 48) - 1)


def _tokens(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first words, second words, text number, tokens per text) of a batch."""
    firsts, seconds, sizes = [], [], []
    for _, hashes, counts in word_batches(batch.column(column)):
        ends = np.cumsum(counts + 1)
        second = np.full(int(ends[-1]) if len(ends) else 0, END, _U)
        inner = np.ones(len(second), bool)
        inner[ends - 1] = False
        second[inner] = hashes
        first = np.empty_like(second)
        first[1:] = second[:-1]
        first[ends - counts - 1] = START
        firsts.append(first)
        seconds.append(second)
        sizes.append(counts + 1)
    size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    join = lambda x: np.concatenate(x) if x else np.zeros(0, _U)
    return join(firsts), join(seconds), np.repeat(np.arange(len(size)), size), size


def _pieces(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most about ``PIECE_BYTES`` of text, so that their token arrays stay small."""
    for batch in batches:
        _, bounds = string_parts(batch.column(column))
        for first, last in slices(bounds, PIECE_BYTES):
            yield batch.slice(first, last - first)


def _find(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted table, whether it is there) of each value."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


class Lists:
    """The word lists that shape the shuffle: frequent words with their training counts, and words that have a code."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray, coded: np.ndarray):
        self.frequent, self.counts, self.coded = frequent, counts, coded


def word_lists(docs: DataFrame) -> tuple[Lists, dict[str, int]]:
    """Lists from a sample of texts; frequent words' counts, training texts and tokens from all texts."""

    def count(batches):
        for batch in _pieces(batches, 0):
            _, second, _, _ = _tokens(batch, 0)
            values, n = np.unique(second, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(n)], ["w", "n"])

    total = docs.count()
    part = min(1.0, SAMPLE_TEXTS / max(total, 1))
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 12), 16, 10).cast("double")
    seen = docs.where(key < part * 16.0**12).select("text").mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    rows = seen.orderBy(F.col("n").desc(), "w").limit(CODES).collect()
    words = np.array([r["w"] for r in rows], np.int64).astype(_U)
    n = np.array([r["n"] for r in rows], np.int64)
    frequent = np.unique(np.append(words[n * FREQUENT >= n.sum()], END))
    coded = np.unique(words)

    def exact(batches):
        counts, texts, tokens = np.zeros(len(frequent), np.int64), 0, 0
        for batch in _pieces(batches, 0):
            training = ~batch.column(1).to_numpy(zero_copy_only=False)
            _, second, text, size = _tokens(batch, 0)
            at, there = _find(second, frequent)
            counts += np.bincount(at[there & training[text]], minlength=len(frequent))
            texts += int(training.sum())
            tokens += int(size[training].sum())
        every = np.concatenate((counts, [texts, tokens]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(every))), pa.array(every)], ["i", "n"])

    sums = docs.select("text", "held_out").mapInArrow(exact, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    every = np.zeros(len(frequent) + 2, np.int64)
    for r in sums:
        every[r["i"]] = r["n"]
    return Lists(frequent, every[:-2], coded), {"texts": int(every[-2]), "tokens": int(every[-1])}


_DEALT = "bucket int, chunk long, texts int, seconds binary, runs binary, codes binary, firsts binary, text binary, ids binary"


def deal(docs: DataFrame, lists: Lists, parts: int) -> DataFrame:
    """Tokens of batches of texts, sorted by second word and dealt to ``parts`` tasks; each batch's ids go along once."""
    frequent, coded = lists.frequent, lists.coded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(_pieces(batches, 2)):
            held = batch.column(1).to_numpy(zero_copy_only=False)
            first, second, text, size = _tokens(batch, 2)
            order = np.argsort(second, kind="stable")
            first, second, text = first[order], second[order], text[order].astype(np.uint32)
            both = np.where(_find(second, frequent)[1], mix(second ^ mix(first)), second)
            bucket = (mix(both) % _U(parts)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            first, second, text, bucket = first[order], second[order], text[order], bucket[order]
            code, there = _find(first, coded)
            code = np.where(there, code, CODES).astype(np.uint16)
            text = text << np.uint32(1) | held[text].astype(np.uint32)
            text = text.astype(np.uint16) if len(held) < 1 << 15 else text
            edges = np.searchsorted(bucket, np.arange(parts + 1))
            rows = []
            for b in np.flatnonzero(np.diff(edges)):
                a, e = edges[b], edges[b + 1]
                fresh = np.flatnonzero(np.concatenate(([True], second[a + 1 : e] != second[a : e - 1])))
                runs = np.diff(np.append(fresh, e - a)).astype(np.uint32)
                rest = first[a:e][~there[a:e]] & _LOW48
                parts48 = (rest & _U(0xFFFFFFFF)).astype(np.uint32).tobytes() + (rest >> _U(32)).astype(np.uint16).tobytes()
                rows.append((int(b), second[a:e][fresh].tobytes(), runs.tobytes(), code[a:e].tobytes(), parts48, text[a:e].tobytes(), None))
            ids = _pack_ids(batch.column(0), held, size)
            rows.append(((task + number) % parts, b"", b"", b"", b"", b"", ids))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int32()), pa.array([task | number] * len(rows), pa.int64()), pa.array([len(held)] * len(rows), pa.int32()),
                    *[pa.array(c, pa.binary()) for c in columns[1:]],
                ],
                [f.split()[0] for f in _DEALT.split(", ")],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, _DEALT).repartitionById(parts, "bucket")


def _pack_ids(ids: pa.Array, held: np.ndarray, size: np.ndarray) -> bytes:
    table = pa.table({"id": ids, "held": pa.array(held), "size": pa.array(size)})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


class Gathered:
    """All tokens of one task: distinct second words and pairs with their training counts, and where each token is."""

    def __init__(self, batches: Iterator[pa.RecordBatch], lists: Lists):
        seconds, firsts, texts, chunks, self.ids, self.stats = [], [], [], [], [], None
        coded48 = lists.coded & _LOW48
        self.chunk_of: list[int] = []
        for batch in batches:
            names = batch.schema.names
            if "stats" in names and batch.num_rows:
                self.stats = batch.column(names.index("stats"))[0].as_py()
            for i in range(batch.num_rows):
                row = [batch.column(j)[i].as_py() for j in range(9)]
                if row[8] is not None:
                    self.ids.append((row[1], row[8]))
                    continue
                runs = np.frombuffer(row[4], np.uint32)
                code = np.frombuffer(row[5], np.uint16)
                first = np.empty(len(code), _U)
                plain = code < CODES
                first[plain] = coded48[code[plain]]
                rest = int((~plain).sum())
                first[~plain] = np.frombuffer(row[6], np.uint32, rest).astype(_U) | np.frombuffer(row[6], np.uint16, rest, 4 * rest).astype(_U) << _U(32)
                seconds.append(np.repeat(np.frombuffer(row[3], _U), runs))
                firsts.append(first)
                texts.append(np.frombuffer(row[7], np.uint16 if row[2] < 1 << 15 else np.uint32).astype(np.uint32))
                chunks.append(np.full(len(code), len(self.chunk_of), np.int32))
                self.chunk_of.append(row[1])
        join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        text = join(texts, np.uint32)
        self.chunk, self.text, training = join(chunks, np.int32), (text >> np.uint32(1)).astype(np.int32), (text & np.uint32(1)) == 0
        del texts, chunks, text
        second = join(seconds, _U)
        del seconds
        first = join(firsts, _U)
        del firsts
        self.word, self.word_at = np.unique(second, return_inverse=True)
        self.word_at = self.word_at.astype(np.int32)
        self.word_count = np.bincount(self.word_at[training], minlength=len(self.word))
        at, self.frequent = _find(self.word, lists.frequent)
        self.word_count[self.frequent] = lists.counts[at[self.frequent]]
        second ^= mix(first)
        _, index, self.pair_at = np.unique(mix(second), return_index=True, return_inverse=True)
        self.pair_at = self.pair_at.astype(np.int32)
        del second
        self.pair_count = np.bincount(self.pair_at[training], minlength=len(index))
        self.pair_word, self.pair_first = self.word_at[index], first[index].astype(np.int64)
        self.first = first.view(np.int64)


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, MOST + 2), minlength=MOST + 3)[1 : MOST + 2].tolist()


_STATS = ["types", *[f"w{r}" for r in range(1, MOST + 2)], *[f"p{r}" for r in range(1, MOST + 2)]]


def counts_of_counts(dealt: DataFrame, lists: Lists) -> DataFrame:
    """One row: word types without the frequent ones, and how many words (w1...) and pairs (p1...) occur r times."""

    def run(batches):
        g = Gathered(batches, lists)
        rare = g.word_count[~g.frequent]
        values = [int((rare > 0).sum()), *_counts_of_counts(rare), *_counts_of_counts(g.pair_count)]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in values], _STATS)

    sums = dealt.mapInArrow(run, ", ".join(f"{s} long" for s in _STATS))
    return sums.agg(F.array(*[F.coalesce(F.sum(s), F.lit(0)) for s in _STATS]).alias("stats"))


def discounted(counts_of: np.ndarray) -> np.ndarray:
    """Discounted counts for 0..MOST; larger counts lose ``LEAST_LOSS``.

    Katz's rule with Good-Turing estimates below the cut; where the counts of counts are too thin for it (not between
    0.1 and r), half a count is taken off.
    """
    out = np.zeros(MOST + 1)
    n = np.concatenate(([0.0], counts_of.astype(float)))
    cut = (MOST + 1) * n[MOST + 1] / n[1] if n[1] else 1.0
    for r in range(1, MOST + 1):
        good_turing = (r + 1) * n[r + 1] / n[r] if n[r] else 0.0
        kept = r * (good_turing / r - cut) / (1 - cut) if cut < 1 else -1.0
        out[r] = kept if 0.1 < kept < r - LEAST_LOSS else r - 0.5
    return out


class Model:
    """Probabilities from counts, given the counts of counts and the frequent words."""

    def __init__(self, stats: list[int], lists: Lists, tokens: int):
        at = lists.counts > 0
        words = np.array(stats[1 : MOST + 2]) + _counts_of_counts(lists.counts)
        self.types = int(stats[0] + at.sum())
        self.tokens = tokens
        self.words, self.pairs = discounted(words), discounted(np.array(stats[MOST + 2 :]))
        lost = sum(words[r - 1] * (r - self.words[r]) for r in range(1, MOST + 1)) + LEAST_LOSS * (self.types - words[:MOST].sum())
        self.unknown = lost / tokens if tokens else 1.0

    @staticmethod
    def kept(counts: np.ndarray, table: np.ndarray) -> np.ndarray:
        return np.where(counts <= MOST, table[np.minimum(counts, MOST)], counts - LEAST_LOSS)

    def word(self, counts: np.ndarray) -> np.ndarray:
        """P(w) of words with these training counts; 0 is the unknown word."""
        return np.where(counts > 0, self.kept(counts, self.words) / max(self.tokens, 1), self.unknown)

    def pair(self, counts: np.ndarray) -> np.ndarray:
        return self.kept(counts, self.pairs)


def contexts(dealt: DataFrame, lists: Lists, tokens: int) -> DataFrame:
    """(context, weight): log10 of backoff(v) * c(v) for every context of training."""

    def run(batches):
        g = Gathered(batches, lists)
        if g.stats is None:
            return
        model = Model(g.stats, lists, tokens)
        seen = g.pair_count > 0
        count, first = g.pair_count[seen], g.pair_first[seen]
        rows = pd.DataFrame({"context": first, "free": count - model.pair(count), "taken": model.word(g.word_count[g.pair_word[seen]])})
        yield pa.RecordBatch.from_pandas(rows.groupby("context", as_index=False, sort=False).sum(), preserve_index=False)

    sums = dealt.mapInArrow(run, "context long, free double, taken double").groupBy("context").agg(F.sum("free").alias("free"), F.sum("taken").alias("taken"))
    return sums.select("context", F.log10(F.col("free") / F.greatest(1 - F.col("taken"), F.lit(1e-300))).alias("weight"))


def unseen(dealt: DataFrame, lists: Lists) -> DataFrame:
    """(context, chunk, text, n): tokens whose pair training lacks, by text."""

    def run(batches):
        g = Gathered(batches, lists)
        lost = g.pair_count[g.pair_at] == 0
        rows = pd.DataFrame({"context": g.first[lost], "chunk": np.array(g.chunk_of, np.int64)[g.chunk[lost]], "text": g.text[lost].astype(np.int32)})
        yield pa.RecordBatch.from_pandas(rows, preserve_index=False)

    return dealt.mapInArrow(run, "context long, chunk long, text int")


_SUMS = "chunk long, ids binary, texts binary, known binary, base binary, score binary"


def text_sums(dealt: DataFrame, lists: Lists, tokens: int) -> DataFrame:
    """Per task and batch of texts: the sums of its tokens per text, without backoff weights; and the ids, once."""

    def run(batches):
        g = Gathered(batches, lists)
        rows = [(chunk, ids, b"", b"", b"", b"") for chunk, ids in g.ids]
        if g.stats is not None and len(g.word_at):
            model = Model(g.stats, lists, tokens)
            count = g.word_count[g.word_at]
            pair = g.pair_count[g.pair_at]
            base = np.log10(count + 0.5)
            # A seen pair's share of its context: the context's own count is taken off where the context is a token.
            own = np.where((count > 0) & (g.word[g.word_at] != END), -np.log10(np.maximum(count, 1)), 0.0)
            score = own + np.log10(np.where(pair > 0, model.pair(np.maximum(pair, 1)), model.word(count)))
            order = np.lexsort((g.text, g.chunk))
            chunk, text = g.chunk[order], g.text[order]
            fresh = np.flatnonzero(np.concatenate(([True], (chunk[1:] != chunk[:-1]) | (text[1:] != text[:-1]))))
            sums = [np.add.reduceat(x[order], fresh) for x in ((count > 0).astype(np.int64), base, score)]
            chunk, text = chunk[fresh], text[fresh]
            edges = np.searchsorted(chunk, np.arange(len(g.chunk_of) + 1))
            for c in range(len(g.chunk_of)):
                part = slice(edges[c], edges[c + 1])
                rows.append((g.chunk_of[c], None, text[part].astype(np.uint32).tobytes(), sums[0][part].astype(np.uint32).tobytes(), sums[1][part].tobytes(), sums[2][part].tobytes()))
        columns = list(zip(*rows)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]], [f.split()[0] for f in _SUMS.split(", ")])

    return dealt.mapInArrow(run, _SUMS)


def score(docs: DataFrame) -> DataFrame:
    """Scores of ``docs`` (doc_id, held_out, text): training is what isn't held out."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "text")
    lists, totals = word_lists(docs)
    tokens, texts = totals["tokens"], totals["texts"]
    dealt = deal(docs, lists, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stats = counts_of_counts(dealt, lists)
    informed = dealt.withColumn("stats", stats.scalar())
    weights = contexts(informed, lists, tokens)
    start = float(np.log10(max(texts, 1)))
    # An unseen pair takes backoff(v) * P(w); the sums above hold P(w) / c(v), so backoff(v) * c(v) is missing.
    missing = unseen(dealt, lists).groupBy("context", "chunk", "text").agg(F.count("*").alias("n"))
    missing = missing.join(weights, "context", "left").groupBy("chunk", "text").agg(F.sum(F.col("n") * F.coalesce("weight", F.lit(0.0))).alias("extra"))
    missing = missing.groupBy("chunk").agg(F.collect_list(F.struct("text", "extra")).alias("extras"))  # a batch of texts
    sums = text_sums(informed, lists, tokens).withColumn("stats", stats.scalar())
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def finish(key, rows: pa.Table, extras: pa.Table) -> pa.Table:
        columns = {n: rows.column(n) for n in rows.column_names}
        packed = [x.as_py() for x in columns["ids"] if x.is_valid]
        model = Model(columns["stats"][0].as_py(), lists, tokens)
        ids = pa.ipc.open_stream(packed[0]).read_all()
        size = ids.column("size").to_numpy()
        known, base, points = np.zeros(len(size), np.int64), np.zeros(len(size)), np.zeros(len(size))
        for i in range(rows.num_rows):
            if columns["ids"][i].is_valid:
                continue
            at = np.frombuffer(columns["texts"][i].as_py(), np.uint32)
            known[at] += np.frombuffer(columns["known"][i].as_py(), np.uint32)
            base[at] += np.frombuffer(columns["base"][i].as_py())
            points[at] += np.frombuffer(columns["score"][i].as_py())
        base -= size * np.log10(tokens + 0.5 * (model.types + 1))
        points -= start if texts else 0.0
        for row in extras.column("extras"):
            for e in row.as_py() or ():
                points[e["text"]] += e["extra"]
        values = [ids.column("id"), ids.column("held"), pa.array(size), pa.array(known), pa.array(np.full(len(size), tokens)), pa.array(base), pa.array(points)]
        return pa.table(dict(zip(["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"], values)))

    return sums.groupBy("chunk").cogroup(missing.groupBy("chunk")).applyInArrow(finish, out)


def write_model(docs: DataFrame, path: str) -> None:
    """Write the model's tables below ``path``: ``pairs`` (bucket, context, word, count, log10 P) partitioned by bucket,
    ``words`` (word, count, log10 P) and ``contexts`` (context, log10 backoff * c(context))."""
    spark = docs.sparkSession
    lists, totals = word_lists(docs)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = deal(docs, lists, parts)
    informed = dealt.withColumn("stats", counts_of_counts(dealt, lists).scalar())
    tokens = totals["tokens"]

    def grams(batches):
        g = Gathered(batches, lists)
        model = Model(g.stats or [0] * len(_STATS), lists, tokens)
        at = g.pair_count > 0
        rows = pd.DataFrame({"context": g.pair_first[at], "word": g.word[g.pair_word[at]].astype(np.int64), "n": g.pair_count[at], "kept": model.pair(g.pair_count[at])})
        rows["word_n"] = g.word_count[g.pair_word[at]]
        rows["word_log"] = np.log10(model.word(rows["word_n"].to_numpy()))
        yield pa.RecordBatch.from_pandas(rows, preserve_index=False)

    pairs = informed.mapInArrow(grams, "context long, word long, n long, kept double, word_n long, word_log double")
    pairs.withColumn("bucket", F.pmod(F.hash("context"), F.lit(parts))).repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/pairs")
    spark.read.parquet(f"{path}/pairs").groupBy("word").agg(F.max("word_n").alias("n"), F.max("word_log").alias("log_p")).write.parquet(f"{path}/words")
    contexts(informed, lists, tokens).write.parquet(f"{path}/contexts")


def op10_katz(spark, sf_dir: str) -> DataFrame:
    """Scores of every document; those whose crc32 of the id as text leaves 1 modulo 5 are held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return score(docs.select("doc_id", held.alias("held_out"), "text"))
