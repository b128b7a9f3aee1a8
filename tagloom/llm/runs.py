"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``max(12, 2 * q)`` long, that no neighbour extends. Its first
q words hold a block of 2 ** k words that begins at a multiple of 2 ** k, for the k with 2 ** (k + 1) - 1 <= q <
2 ** (k + 2) - 1, and the block occurs again q words later. So for every k and every such block, the occurrences in the
two windows of 2 ** k places behind it are asked for:

* Prefix doubling sorts the suffixes of a text. After k rounds the suffixes that begin with a block lie next to each
  other, and their interval stays the same in the finished suffix array.
* A wavelet tree over the suffix array gives the least occurrence at or after a place within an interval (range
  successor), the greatest before one, and their number.
* Occurrences in a window of 2 ** k places form an arithmetic progression. One or two of them are candidates themselves.
  Three or more lie in a periodic stretch: if the block lies in the same stretch, no run of this length begins so; if
  it lies in another one, the two stretches' ends, or else their beginnings, are q apart, unless they touch, when all are
  candidates. The candidates stay linear in the text.

Each candidate is extended to both sides in log steps over the ranks of the doubling rounds, which compare words exactly.

Texts are worked on in slices of about ``SLICE`` bytes by Arrow batches, without a shuffle. One text is one row: some 50
bytes per byte of the longest text are held (100 where it is one long repetition).

Defined cases: null text is empty; texts without words have no runs and an empty collapsed text; null and repeated ids are
rows of their own; words are compared as they are written; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tagloom.llm.text import WORD, slices, string_parts

SHORTEST = 12
SLICE = 1 << 19


class Suffixes:
    """Suffix array of several word sequences (no match crosses from one to another) and the ranks of each round."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        n = len(words)
        ends = np.cumsum(counts)
        self.begin, self.end = np.repeat(ends - counts, counts), np.repeat(ends, counts)
        key = self.begin * (int(words.max(initial=0)) + 1) + words
        self.array = np.argsort(key, kind="stable")
        self.ranks: list[np.ndarray] = []
        #: (block, first, last exclusive) per round: blocks that occur again, and their intervals of the array
        self.blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rank, size = np.empty(n, np.int64), np.empty(n, np.int64)
        rows = np.arange(n)  # places of the array whose class has several members
        self._classes(rows, key[self.array], rank, size)
        width = 1
        while True:
            rows = rows[size[self.array[rows]] > 1]
            if not len(rows):
                break
            self.ranks.append(rank.astype(np.int32))
            at = np.sort(self.array[rows])
            at = at[((at - self.begin[at]) % width == 0) & (at + width <= self.end[at])]
            self.blocks.append((at, rank[at], rank[at] + size[at]))
            held = self.array[rows]
            follow = np.minimum(held + width, n - 1)
            second = np.where(held + width < self.end[held], rank[follow], -1)
            key = rank[held] * (n + 1) + second + 1
            order = np.argsort(key, kind="stable")
            self.array[rows] = held[order]
            self._classes(rows, key[order], rank, size)
            width *= 2

    def _classes(self, rows: np.ndarray, key: np.ndarray, rank: np.ndarray, size: np.ndarray) -> None:
        """Rank (first place of the class) and class size of the suffixes at ``rows``, whose keys ascend."""
        if not len(rows):
            return
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        many = np.diff(np.append(first, len(rows)))
        rank[self.array[rows]] = np.repeat(rows[first], many)
        size[self.array[rows]] = np.repeat(many, many)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i < j, of one text)."""
        i, start, last = i.copy(), j, self.end[j]
        j = j.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, width = self.ranks[k], 1 << k
            fits = j + width <= last
            same = fits & (rank[i] == rank[np.where(fits, j, 0)])
            i, j = i + same * width, j + same * width
        return j - start

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j (i < j, of one text)."""
        low, start = self.begin[i], i
        i, j = i.copy(), j.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, width = self.ranks[k], 1 << k
            fits = i - width >= low
            same = fits & (rank[np.where(fits, i - width, 0)] == rank[np.where(fits, j - width, 0)])
            i, j = i - same * width, j - same * width
        return start - i


class WaveletTree:
    """Order queries over intervals of a sequence of distinct numbers 0..n-1, one level per bit."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, len(values).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            right = (values >> bit) & 1 == 1
            count = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~right, out=count[1:])
            self.zeros.append(count)
            values = np.concatenate((values[~right], values[right]))

    def less(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many numbers of [lo, hi) are below ``value``."""
        found = np.zeros(len(lo), np.int64)
        for count, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            left_lo, left_hi = count[lo], count[hi]
            right = (value >> bit) & 1 == 1
            found += np.where(right, left_hi - left_lo, 0)
            lo = np.where(right, count[-1] + lo - left_lo, left_lo)
            hi = np.where(right, count[-1] + hi - left_hi, left_hi)
        return found

    def nth(self, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The number of [lo, hi) that has ``n`` smaller ones there."""
        value = np.zeros(len(lo), np.int64)
        for count, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            left_lo, left_hi = count[lo], count[hi]
            held = left_hi - left_lo
            right = n >= held
            n = n - np.where(right, held, 0)
            value |= right.astype(np.int64) << bit
            lo = np.where(right, count[-1] + lo - left_lo, left_lo)
            hi = np.where(right, count[-1] + hi - left_hi, left_hi)
        return value


def _candidates(s: Suffixes, tree: WaveletTree) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): the words at place and at place + period may belong to a run of that period."""
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, (block, lo, hi) in enumerate(s.blocks):
        width = 1 << k
        near = block + 2 * width - 1 < s.end[block]
        block, lo, hi = block[near], lo[near], hi[near]
        below = tree.less(lo, hi, block + 2 * width - 1)
        there = below < hi - lo
        block, lo, hi, below = block[there], lo[there], hi[there], below[there]
        next_one = tree.nth(lo, hi, below)
        reach = next_one < block + 4 * width - 1
        block, lo, hi, below = block[reach], lo[reach], hi[reach], below[reach]
        for window in range(2):
            edge = block + (3 + window) * width - 1
            upto = tree.less(lo, hi, edge)
            many = upto - below
            some = many > 0
            b, l, h, c, u, m = block[some], lo[some], hi[some], below[some], upto[some], many[some]
            first = tree.nth(l, h, c)
            last = first.copy()
            several = m > 1
            last[several] = tree.nth(l[several], h[several], u[several] - 1)
            few = m < 3
            for found, chosen in ((first, few), (last, few & several)):
                places.append(b[chosen])
                periods.append((found - b)[chosen])
            if not few.all():
                at, far, step = b[~few], first[~few], ((last - first) // np.maximum(m - 1, 1))[~few]
                # The periodic stretches of the block and of its occurrences.
                end, far_end = at + step + s.ahead(at, at + step), far + step + s.ahead(far, far + step)
                begin, far_begin = at - s.behind(at, at + step), far - s.behind(far, far + step)
                other = begin != far_begin
                apart = other & (end < far_begin)
                for period in (far_end - end, far_begin - begin):
                    good = apart & (period > 0) & (at + period < s.end[at])
                    places.append(at[good])
                    periods.append(period[good])
                touch = np.flatnonzero(other & ~apart)
                times = m[~few][touch]
                offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                places.append(np.repeat(at[touch], times))
                periods.append(np.repeat((far - at)[touch], times) + offset * np.repeat(step[touch], times))
            below = upto
    return np.concatenate(places), np.concatenate(periods)


def find_runs(words: np.ndarray, counts: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of several sequences, by start, then period; starts count through all of them."""
    none = np.zeros(0, np.int64)
    if len(words) < shortest:
        return none, none, none
    s = Suffixes(words, counts)
    if not s.blocks:
        return none, none, none
    place, period = _candidates(s, WaveletTree(s.array))
    start = place - s.behind(place, place + period)
    length = place + period + s.ahead(place, place + period) - start
    good = length >= np.maximum(shortest, 2 * period)
    start, length, period = start[good], length[good], period[good]
    # A stretch found with several periods has the least one; the others are its multiples.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[fresh], length[fresh], period[fresh]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every text.

    ``runs`` are (start, length, period) by start, then period. ``collapsed`` is the text's words joined by one space,
    without those that a run repeats: all of a run but its first period.
    """
    kind = docs.schema[id_col].dataType
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    names, types = ["doc_id", "n_words", "runs", "collapsed"], [to_arrow_type(kind), pa.int64(), run_type, pa.string()]

    def collapse(own: list[bytes], begin: int, starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> str:
        if len(starts):
            gone = np.zeros(len(own) + 1, np.int64)
            np.add.at(gone, starts - begin + periods, 1)
            np.add.at(gone, starts - begin + lengths, -1)
            own = compress(own, (np.cumsum(gone[:-1]) == 0).tolist())
        return b" ".join(own).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = string_parts(batch.column(1))
            for first, last in slices(bounds, SLICE):
                split = [raw[bounds[i] : bounds[i + 1]].tobytes().split() for i in range(first, last)]
                counts = np.array([len(w) for w in split], np.int64)
                flat = pa.array([w for own in split for w in own], pa.large_binary()).dictionary_encode()
                start, length, period = find_runs(flat.indices.to_numpy().astype(np.int64), counts, shortest)
                begins = np.cumsum(counts) - counts
                cut = np.searchsorted(start, np.append(begins, counts.sum()))
                within = start - np.repeat(begins, np.diff(cut))
                runs = pa.StructArray.from_arrays([pa.array(within), pa.array(length), pa.array(period)], ["start", "length", "period"])
                texts = [collapse(own, begins[i], start[a:b], length[a:b], period[a:b]) for i, (own, a, b) in enumerate(zip(split, cut, cut[1:]))]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first).cast(types[0]), pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(cut, pa.int32()), runs), pa.array(texts, pa.string()),
                    ], names,
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def repeated_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): a tenth of the texts, by the checksum of the id, go on in words a, a+1, ..., a+p-1 from word a on.

    Null ids and texts without words stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), h.alias("_h"))
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"))
    chosen = rows.withColumn("_w", F.when(F.col("_h") % 10 == 0, words))
    n, g = F.size("_w").cast("long"), F.floor(F.col("_h") / 10)
    a = F.when(F.size("_w") > 0, g % n)
    p = F.lit(1) + F.floor((n - F.col("_a")) / (3 + g % 8))
    shaped = chosen.withColumn("_a", a).withColumn("_p", p)
    tail: Column = F.flatten(
        F.array_repeat(F.slice("_w", (F.col("_a") + 1).cast("int"), F.col("_p").cast("int")), F.ceil((n - F.col("_a")) / F.col("_p")).cast("int"))
    )
    rebuilt = F.slice(F.concat(F.slice("_w", F.lit(1), F.col("_a").cast("int")), tail), F.lit(1), F.size("_w"))
    return shaped.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(rebuilt, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """The runs of every document, a tenth of which repeat a part of themselves."""
    found = periodic_runs(repeated_tails(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    top = found.withColumn("_top", longest)
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_top.s")).alias("start"),
        F.col("_top.l").alias("length"),
        (-F.col("_top.p")).alias("period"),
        F.floor(1000 * F.col("_top.l") / -F.col("_top.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
