"""Shard placement by a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table: offset + j * skip modulo the size, both from
a digest of its name. The shards take turns; at its turn a shard claims the first free slot of its order. The full
table gives each shard an equal part (within one slot), and a changed shard list moves few slots. A key's slot is a
digest of the key modulo the size, so placing a row is one lookup. The table has ``size`` rows whatever the data, hence
it may be broadcast.

Placement by a unique key is even. A key that holds a third of all rows would put them on one shard: ``spread`` names
further columns that are then part of the key.

Defined cases: a null key is the key ``\\N``; equal rows meet on one shard; an empty table gives no rows; no shards or a
size that isn't prime is an error; other columns stay as they are (a clashing ``slot`` or ``shard`` is replaced).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
SIZE = 16381


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: tuple[str, ...] = SHARDS, size: int = SIZE) -> list[int]:
    """The lookup table: for each slot the number of the shard that claims it."""
    if not shards or size < len(shards) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table needs shards and a prime size that is no smaller than their number")
    offset = [_digest(f"offset:{s}") % size for s in shards]
    skip = [_digest(f"skip:{s}") % (size - 1) + 1 for s in shards]
    table, claimed, turn = [-1] * size, 0, [0] * len(shards)
    while claimed < size:
        for i in range(len(shards)):
            slot = (offset[i] + turn[i] * skip[i]) % size
            while table[slot] >= 0:
                turn[i] += 1
                slot = (offset[i] + turn[i] * skip[i]) % size
            table[slot] = i
            turn[i] += 1
            claimed += 1
            if claimed == size:
                break
    return table


def slot_of(keys: list[Column], size: int = SIZE) -> Column:
    """Slot of a key: the first 15 hexadecimal digits of its digest modulo the table's size."""
    text = F.concat_ws(":", *[F.coalesce(k.cast("string"), F.lit(r"\N")) for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(size))


def place(df: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, size: int = SIZE, spread: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with its ``slot`` (long) and ``shard`` (name), in place of columns of these names."""
    joined = ",".join(map(str, fill(shards, size)))
    names = F.array(*[F.lit(s) for s in shards])
    own, taken = "_slot", {c.lower() for c in df.columns}
    while own in taken:
        own = f"_{own}"
    table = df.sparkSession.range(1).select(F.posexplode(F.split(F.lit(joined), ",")).alias("n", "owner"))
    table = table.select(F.col("n").cast("long").alias(own), F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"))
    keyed = df.withColumn("slot", slot_of([F.col(f"`{c}`") for c in (key, *spread)], size)).drop("shard")
    return keyed.join(F.broadcast(table), F.col("slot") == F.col(own)).drop(own)


def write_shards(df: DataFrame, path: str, key: str, **options) -> None:
    """Write ``df`` as one folder per shard."""
    placed = place(df, key, **options)
    placed.repartition("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path)


def op6_shard_placement(spark, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return place(docs.select("doc_id", "source", "n_chars"), "doc_id")


def oracle() -> str:
    owners = ",".join(map(str, fill()))
    return f"""
WITH slots AS (
  SELECT doc_id, source, n_chars,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '\\N')), 1, 15) AS BIGINT) % {SIZE} AS slot FROM documents)
SELECT doc_id, source, n_chars, slot,
       'shard-' || lpad(string_split('{owners}', ',')[slot + 1], 3, '0') AS shard FROM slots
"""
