"""Runs against a plain search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import awkward, clashing, empty

from tagloom.llm import runs


def plain_runs(words, shortest=12):
    n, out = len(words), {}
    w = np.unique(np.array(words), return_inverse=True)[1] if n else np.zeros(0)
    for q in range(1, n // 2 + 1):
        same = np.concatenate(([0], w[:-q] == w[q:], [0])).astype(int)
        for i, j in zip(np.flatnonzero(np.diff(same) == 1).tolist(), np.flatnonzero(np.diff(same) == -1).tolist()):
            if j + q - i >= max(shortest, 2 * q):
                out.setdefault((i, j + q - i), q)  # smaller periods come first
    return sorted((s, ln, q) for (s, ln), q in out.items())


def collapsed(words, found):
    gone = {i for s, ln, q in found for i in range(s + q, s + ln)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_rebuilt(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def plain_row(doc_id, text):
    words = plain_rebuilt(doc_id, text)
    found = plain_runs(words)
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
        sha("".join(f"{s},{ln},{q}\n" for s, ln, q in found)), sha(collapsed(words, found)),
    )


def sequences():
    pick = random.Random(7)
    for n in (0, 1, 11, 12, 13, 40, 200):
        for letters in (1, 2, 3):
            yield [pick.randrange(letters) for _ in range(n)]
    for _ in range(150):  # stretches of all kinds of periods next to each other
        out = []
        while len(out) < pick.randrange(20, 160):
            part = [pick.randrange(3) for _ in range(pick.randrange(1, 14))]
            out += part * pick.randrange(1, 7) + part[: pick.randrange(len(part))]
        yield out
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    yield b  # Fibonacci words are full of runs
    yield [bin(i).count("1") % 2 for i in range(256)]
    for q in (2, 3, 4, 5):  # touching stretches: every odd distance is a run of its own
        part = list(range(q))
        yield part * 12 + part[::-1] * 12 + part[1:] * 9


def test_runs_of_sequences():
    seqs = list(sequences())
    for group in ([s] for s in seqs):
        check(group)
    check(seqs)
    check([[0] * 20, [], [0] * 20, [0, 1] * 10])


def check(seqs):
    counts = np.array([len(s) for s in seqs])
    start, length, period = runs.find_runs(np.array([w for s in seqs for w in s], np.int64), counts)
    want, begin = [], 0
    for s in seqs:
        want += [(begin + a, ln, q) for a, ln, q in plain_runs(s)]
        begin += len(s)
    assert list(zip(start.tolist(), length.tolist(), period.tolist())) == want


def test_candidates_stay_linear():
    for words in (np.zeros(20_000, np.int64), np.tile(np.arange(7), 3000)):
        s = runs.Suffixes(words, np.array([len(words)]))
        place, _ = runs._candidates(s, runs.WaveletTree(s.array))
        assert len(place) <= 8 * len(words)  # at most four of each block


def test_wavelet_tree():
    pick = np.random.default_rng(3)
    values = pick.permutation(500)
    tree = runs.WaveletTree(values)
    lo = pick.integers(0, 400, 300)
    hi = lo + pick.integers(1, 100, 300)
    limit = pick.integers(0, 501, 300)
    below = tree.less(lo, hi, limit)
    assert below.tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(lo, hi, limit)]
    n = pick.integers(0, hi - lo)
    assert tree.nth(lo, hi, n).tolist() == [int(np.sort(values[a:b])[k]) for a, b, k in zip(lo, hi, n)]


def rows_of(df):
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    return sorted((tuple(r[n] for n in names) for r in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("change", [lambda d: d, clashing])
def test_awkward_texts(spark, change):
    docs = awkward(spark)
    more = spark.createDataFrame([(i, "x y Z z Y " * 9 + "  end", None, None, 0) for i in (None, *range(100, 140))], docs.schema)
    docs = docs.union(more)
    found = runs.periodic_runs(change(docs)).collect()
    want = {}
    for r in docs.collect():
        words = [w.decode() for w in (r.text or "").encode().split()]
        found_runs = plain_runs(words)
        want.setdefault(r.doc_id, []).append((len(words), found_runs, collapsed(words, found_runs)))
    got = {}
    for r in found:
        got.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    assert got == want
    rebuilt = {r.doc_id: r.text for r in runs.repeated_tails(change(docs)).collect()}
    for r in docs.collect():
        assert [w.decode() for w in (rebuilt[r.doc_id] or "").encode().split()] == plain_rebuilt(r.doc_id, r.text)


def test_empty(spark):
    assert runs.periodic_runs(runs.repeated_tails(empty(spark))).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    # The plain search is quadratic: documents of up to 1500 words.
    small = [r for r in docs if len((r.text or "").split()) <= 1500]
    ids = {r.doc_id for r in small}
    found = [r for r in rows_of(runs.op11_periodic_runs(spark, folder)) if r[0] in ids]
    assert len(docs) > len(small) > 150 and found == sorted((plain_row(r.doc_id, r.text) for r in small), key=repr)
    assert any(r[1] for r in found)
