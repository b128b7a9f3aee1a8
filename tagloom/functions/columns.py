"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000

# Granularity units and their length in milliseconds.
GRANULARITY_MS = {"s": 1_000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp (UTC session)."""
    return F.unix_millis(ts.cast("timestamp"))


def utc_day(ms: Column) -> Column:
    """Start of the UTC day of an epoch millisecond, as epoch milliseconds."""
    return ms - F.pmod(ms, F.lit(DAY_MS))


def iso_instant(ms: Column) -> Column:
    """ISO instant text of an epoch millisecond: a fraction is shown only when there is one."""
    seconds = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(F.pmod(ms, F.lit(1000)) == 0, F.lit("Z")).otherwise(
        F.date_format(F.timestamp_millis(ms), ".SSS'Z'")
    )
    return F.concat(seconds, fraction)


def granularity_ms(text: str) -> int:
    """``10m``, ``2h``, ``d``: a count (default 1) and a unit."""
    count, unit = text[:-1] or "1", text[-1:]
    if unit not in GRANULARITY_MS or not count.isdigit() or int(count) < 1:
        raise ValueError(f"not a granularity: {text!r}")
    return int(count) * GRANULARITY_MS[unit]


def map_entries_sorted(value: Column) -> Column:
    """A map as a sorted entry array, which can be compared and hashed; unset equals empty."""
    return F.coalesce(F.array_sort(F.map_entries(value)), F.array())


def strip(text: Column) -> Column:
    """Text without blanks and control characters at both ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def all_of(parts: Iterable[Column]) -> Column:
    folded = F.lit(True)
    for part in parts:
        folded = folded & part
    return folded


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def split_letters_digits(words: Column) -> Column:
    """Cut words where letters meet digits and strip leading zeros of the numbers."""
    cut = F.flatten(F.transform(words, lambda w: F.regexp_extract_all(w, F.lit(r"(\p{N}+|\p{L}+)"), F.lit(1))))
    return F.transform(cut, lambda w: F.regexp_replace(w, r"^0+(?=\p{N})", ""))


def bigrams(words: Column) -> Column:
    """Adjacent word pairs."""
    return F.zip_with(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
