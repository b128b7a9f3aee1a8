"""Words of whole texts as numpy arrays: the helper that the text operators share inside their tasks.

A word is a longest run of bytes other than space and ``\\x09``-``\\x0D``, with A-Z lowered. Words are held as 64-bit
hashes of their bytes (a polynomial over a table of random values, then mixed), all computed for a batch of texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
_U = np.uint64
_SLICE_BYTES = 1 << 20


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (the public splitmix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64; the table grows with the longest batch seen."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, _U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def string_parts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each text begins and ends in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(bounds: np.ndarray, most: int = _SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts (first, last exclusive) of about ``most`` bytes; a longer text is a run of its own."""
    n, at = len(bounds) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1)
        yield at, end
        at = end


def words_of(raw: np.ndarray, bounds: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts ``first``..``last`` in order, and how many words each text has."""
    lo, hi = bounds[first], bounds[last]
    part = raw[lo:hi]
    begins = bounds[first:last] - lo
    if not len(part):
        return np.zeros(0, _U), np.zeros(last - first, np.int64)
    inside = ~_SPACE[part]
    edge = np.zeros(len(part) + 1, bool)
    edge[begins] = True
    edge[-1] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    total = np.zeros(len(part) + 1, _U)
    np.cumsum(_VALUE[_LOWER[part]] * _power(_BASE, len(part)), out=total[1:])
    hashes = (total[ends + 1] - total[starts]) * _power(_INVERSE, len(part))[starts]
    hashes = mix(hashes + (ends - starts + 1).astype(_U) * _U(0x9E3779B97F4A7C15))
    return hashes, np.diff(np.searchsorted(starts, np.append(begins, hi - lo)))


def word_batches(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Word hashes of a column of texts: (number of the first text, hashes, words per text) for runs of texts."""
    raw, bounds = string_parts(column)
    for first, last in slices(bounds):
        yield first, *words_of(raw, bounds, first, last)


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles of each text, with repeats, and their number per text.

    A text of fewer words gives its whole sequence as one shingle, a text without words none.
    """
    n = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    begins = np.concatenate(([0], np.cumsum(counts)))[:-1]
    out_begin = np.concatenate(([0], np.cumsum(n)))[:-1]
    owner = np.repeat(np.arange(len(counts)), n)
    at = begins[owner] + (np.arange(n.sum()) - out_begin[owner])
    room = begins[owner] + counts[owner] - at
    value = np.zeros(len(at), _U)
    padded = np.concatenate((hashes, np.zeros(k, _U)))
    for j in range(k):
        value = value * _U(0xD6E8FEB86659FD93) + np.where(room > j, padded[at + j], _U(0))
    return mix(value + np.minimum(room, k).astype(_U)), n
