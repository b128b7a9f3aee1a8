"""Quality classifier from weak labels.

1. Labellers. Nine overlapping heuristics look at a whole text and vote good, bad or abstain.
2. Label model. The votes of all documents are counted by pattern (at most 3 ** 9 rows, whatever the data); expectation
   maximisation over the counts estimates each labeller's vote probabilities per class and the share of good documents.
   Every pattern gets the posterior that its documents are good.
3. Scorer. A logistic scorer over hashed shape n-grams (letters, capitals, digits and marks, not words) is fitted to the
   posteriors of a sample: documents are taken by a digest of id and text so that about ``SAMPLE`` of them, and at most
   twice as many, reach the driver. It then scores every whole text; ``keep`` says that the score is at least ``LEAST``.

The sample is the only bounded part; votes, counts, posteriors and scores cover all documents.

Defined cases: a null or empty text, or one without words, gets score 0 and is rejected; equal rows score alike; an
empty table gives no rows; if all patterns agree, the posterior is the majority's vote and the scorer is constant; null
ids are kept; other columns do not matter to the score and stay in ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from tagloom.llm.text import mix, slices, string_parts, words_of

SAMPLE, LEAST, WIDTH = 4096, 0.5, 1024
BAD, GOOD, ABSTAIN = 0, 1, 2
LABELLERS = ("repeats", "variety", "marks", "capitals", "shouting", "sentences", "bars", "word_length", "doubled_marks")
_U = np.uint64

#: Byte classes of the shape n-grams: a lower, A upper, 0 digit, s space, n line end, e other scripts, marks themselves.
_CLASS = np.arange(256, dtype=np.uint8)
for _range, _as in (((97, 123), "a"), ((65, 91), "A"), ((48, 58), "0"), ((128, 256), "e"), ((9, 14), "n"), ((32, 33), "s")):
    _CLASS[slice(*_range)] = ord(_as)
_MARK = np.zeros(256, bool)
_MARK[list(b"#$%&*@^~|<>{}[]\\=_+")] = True


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each run bounds[i]..bounds[i + 1]."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _measures(raw: np.ndarray, bounds: np.ndarray, first: int, last: int) -> dict[str, np.ndarray]:
    """Counts of a run of texts that labellers and features share."""
    hashes, words = words_of(raw, bounds, first, last)
    part, edge = raw[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
    at = np.concatenate(([0], np.cumsum(words)))
    owner = np.repeat(np.arange(last - first), words)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[1:] != owner[:-1])
    upper, lower = (part >= 65) & (part < 91), (part >= 97) & (part < 123)
    doubled = np.zeros(len(part), bool)
    doubled[1:] = (part[1:] == part[:-1]) & (_MARK[part[1:]] | (part[1:] == 33))
    space = (part == 32) | ((part >= 9) & (part < 14))
    return {
        "words": words, "same": _sums(same, at), "distinct": _sums(fresh, at), "bytes": np.diff(edge),
        "marks": _sums(_MARK[part], edge), "upper": _sums(upper, edge), "lower": _sums(lower, edge),
        "shout": _sums(part == 33, edge), "stops": _sums(part == 46, edge), "bars": _sums(part == 124, edge),
        "space": _sums(space, edge), "doubled": _sums(doubled, edge),
    }


def _vote(value: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, ABSTAIN))


def votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """Votes of all labellers, one column each."""
    words, size = np.maximum(m["words"], 1), np.maximum(m["bytes"], 1)
    letters = m["upper"] + m["lower"]
    same, variety = m["same"] / words, m["distinct"] / words
    marks, capitals = m["marks"] / size, m["upper"] / np.maximum(letters, 1)
    shout, stops, bars = m["shout"] / words, m["stops"] / words, m["bars"] / words
    long = (m["bytes"] - m["space"]) / words
    doubled = m["doubled"] / words
    few = m["words"] < 20
    out = np.stack(
        [
            _vote(same, (same < 0.05) & ~few, same > 0.2),
            _vote(variety, (variety > 0.3) & ~few, (variety < 0.15) & ~few),
            _vote(marks, marks < 0.01, marks > 0.05),
            _vote(capitals, (capitals < 0.2) & (letters > 0), (capitals > 0.6) & (letters > 20)),
            _vote(shout, shout < 0.05, shout > 0.3),
            _vote(stops, (stops > 0.02) & (stops < 0.6) & ~few, (stops < 0.002) & (m["words"] > 60)),
            _vote(bars, (bars == 0) & ~few, bars > 0.15),
            _vote(long, (long > 2.5) & (long < 14), (long < 1.5) | (long > 40)),
            _vote(doubled, doubled < 0.02, doubled > 0.25),
        ],
        axis=1,
    )
    out[m["words"] == 0] = ABSTAIN
    return out


def features(raw: np.ndarray, bounds: np.ndarray, first: int, last: int, m: dict[str, np.ndarray]) -> np.ndarray:
    """Hashed shape 4-grams (square root of their share of the text) with hashed steps of the repeat and variety ratios."""
    part, edge = _CLASS[raw[bounds[first] : bounds[last]]].astype(_U), bounds[first : last + 1] - bounds[first]
    out = np.zeros((last - first, WIDTH), np.float32)
    if len(part) >= 4:
        grams = part[:-3] | part[1:-2] << _U(8) | part[2:-1] << _U(16) | part[3:] << _U(24)
        bucket = (mix(grams) >> _U(54)).astype(np.int64)
        for i in range(last - first):
            a, b = edge[i], edge[i + 1] - 3
            if b > a:
                out[i] = np.sqrt(np.bincount(bucket[a:b], minlength=WIDTH) / (b - a))
    words = np.maximum(m["words"], 1)
    rows = np.arange(last - first)
    for name, ratio in ((1, m["same"] / words), (2, m["distinct"] / words)):
        step = np.minimum(9, (ratio * 10)).astype(_U)
        np.add.at(out, (rows, (mix(step + _U(name << 8)) >> _U(54)).astype(np.int64)), 0.5)
    return out


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of good per pattern, vote probabilities [class, labeller, vote], share of good) by expectation maximisation."""
    n, width = patterns.shape
    if not n:
        return np.zeros(0), np.full((2, width, 2), 0.5), 0.5
    hot = np.stack([patterns == v for v in range(2)], axis=2).astype(float)  # an abstention says nothing
    post = np.where((patterns == BAD).any(1), 0.1, 0.95)  # kinds of bad documents differ: one bad vote is a first guess
    for _ in range(rounds):
        chance = np.empty((2, width, 2))
        for c, share in ((GOOD, post), (BAD, 1 - post)):
            seen = np.einsum("p,plv->lv", share * counts, hot) + 1.0
            chance[c] = seen / seen.sum(1, keepdims=True)
        # A labeller's good votes are never a sign of bad documents, nor the other way round.
        for vote, its, other in ((GOOD, GOOD, BAD), (BAD, BAD, GOOD)):
            wrong = chance[other, :, vote] > chance[its, :, vote]
            middle = (chance[0, :, vote] + chance[1, :, vote]) / 2
            chance[0, wrong, vote] = chance[1, wrong, vote] = middle[wrong]
        prior = float(np.clip((post * counts).sum() / counts.sum(), 1e-3, 1 - 1e-3))
        logs = np.log(chance)
        odds = np.log(prior / (1 - prior)) + np.einsum("plv,lv->p", hot, logs[GOOD] - logs[BAD])
        fresh = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if np.abs(fresh - post).max() < 1e-9:
            break
        post = fresh
    return post, chance, prior


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 12, ridge: float = 0.3) -> np.ndarray:
    """Weights (the last one is the constant) of a logistic scorer for soft labels, by Newton steps with a ridge."""
    weights = np.zeros(WIDTH + 1)
    if not len(x):
        return weights
    x = np.concatenate((x.astype(np.float64), np.ones((len(x), 1))), axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + ridge * weights
        bend = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(WIDTH + 1)
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


_PATTERN = 3 ** np.arange(len(LABELLERS))


def _texts(batches: Iterator[pa.RecordBatch], texts_of):
    """Runs of texts with their measures; ``texts_of`` takes the texts from a batch."""
    for batch in batches:
        raw, bounds = string_parts(texts_of(batch))
        for first, last in slices(bounds):
            yield batch, first, last, raw, bounds, _measures(raw, bounds, first, last)


def _first(batch: pa.RecordBatch) -> pa.Array:
    return batch.column(0)


def patterns_of(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(pattern, count): the votes of all documents as base-3 numbers."""

    def run(batches):
        for _, _, _, _, _, m in _texts(batches, _first):
            values, counts = np.unique(votes(m) @ _PATTERN, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(counts.astype(np.int64))], ["pattern", "n"])

    counted = docs.select(text_col).mapInArrow(run, "pattern long, n long")
    return counted.groupBy("pattern").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, dict[int, float]]:
    """(weights of the scorer, posterior per vote pattern)."""
    counted = patterns_of(docs, text_col).orderBy("pattern").collect()  # at most 3 ** 9 rows
    codes = np.array([r["pattern"] for r in counted], np.int64)
    counts = np.array([r["n"] for r in counted], np.float64)
    post, _, _ = label_model(codes[:, None] // _PATTERN % 3, counts)
    posterior = dict(zip(codes.tolist(), post.tolist()))
    total = int(counts.sum())
    if not total:
        return np.zeros(WIDTH + 1), posterior
    part = min(1.0, sample / total)

    def run(batches):
        for _, first, last, raw, bounds, m in _texts(batches, _first):
            x = features(raw, bounds, first, last, m)
            rows = [pa.array((votes(m) @ _PATTERN).astype(np.int64)), pa.array([v.tobytes() for v in x], pa.binary())]
            yield pa.RecordBatch.from_arrays(rows, ["pattern", "x"])

    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.col(text_col))), 1, 12), 16, 10).cast("double")
    chosen = docs.where(F.coalesce(F.length(text_col), F.lit(0)) > 0).where(key < part * 16.0**12).select(text_col).limit(2 * sample)
    rows = chosen.mapInArrow(run, "pattern long, x binary").collect()  # at most 2 * sample rows of WIDTH numbers
    rows.sort(key=lambda r: bytes(r["x"]))
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in rows), np.float32).reshape(-1, WIDTH)
    return fit(x, np.array([posterior.get(r["pattern"], 0.5) for r in rows])), posterior


def _judge(docs: DataFrame, id_col: str, text_col: str, sample: int, least: float):
    """Fit label model and scorer to ``docs``; a function from the measures of texts to (posterior, score, keep)."""
    weights, posterior = train(docs, id_col, text_col, sample)
    codes = np.array(sorted(posterior), np.int64)
    values = np.array([posterior[c] for c in codes.tolist()])

    def judge(raw, bounds, first, last, m):
        x = features(raw, bounds, first, last, m)
        score = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
        score = np.round(np.where(m["words"] > 0, score, 0.0), 9)
        return values[np.searchsorted(codes, votes(m) @ _PATTERN)], score, score >= least

    return judge


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, least: float = LEAST) -> DataFrame:
    """``docs`` with posterior (label model), score (scorer) and keep; clashing columns of the input are replaced."""
    judge = _judge(docs, id_col, text_col, sample, least)
    docs = docs.drop("posterior", "score", "keep")
    at = docs.columns.index(text_col)

    def run(batches):
        for batch, first, last, *run_of in _texts(batches, lambda b: b.column(at)):
            part = batch.slice(first, last - first)
            marks = [pa.array(v) for v in judge(run_of[0], run_of[1], first, last, run_of[2])]
            yield pa.RecordBatch.from_arrays([*part.columns, *marks], [*part.schema.names, "posterior", "score", "keep"])

    schema = StructType(list(docs.schema.fields)).add("posterior", DoubleType()).add("score", DoubleType()).add("keep", BooleanType())
    return docs.mapInArrow(run, schema)


def accepted(docs: DataFrame, sample: int = SAMPLE, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) that the classifier keeps, with their own columns only."""
    judge = _judge(docs, "doc_id", "text", sample, least)
    at = docs.columns.index("text")

    def run(batches):
        for batch, first, last, *run_of in _texts(batches, lambda b: b.column(at)):
            yield batch.slice(first, last - first).filter(pa.array(judge(run_of[0], run_of[1], first, last, run_of[2])[2]))

    return docs.mapInArrow(run, docs.schema)


def op3_quality_labels(spark, sf_dir: str) -> DataFrame:
    """Posterior, score and decision for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classify(docs.select("doc_id", "text")).drop("text")
