"""Annotation: find entity names in whole document texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.columns import tokens
from tagloom.session import is_small, materialize, small_side

#: Bits of the filter of runs: it takes 16 MB at most, whatever the number of names.
FILTER_BITS = 1 << 27


def annotate(
    documents: DataFrame,
    entities: DataFrame,
    search_field: str = "name",
    min_tokens: int = 2,
    partial: bool = False,
    document_id: str = "doc_id",
    text: str = "text",
    entity_id: str = "id",
) -> DataFrame:
    """(document_id, entity_id, matches, first_position) of entities whose name occurs in the text.

    Names and texts are compared token by token, and a name needs at least ``min_tokens`` tokens. A whole
    match needs all tokens of the name in a row; with ``partial`` any ``min_tokens`` consecutive ones do, and
    ``matches`` counts the positions where such a run starts.

    Both sides are cut into runs of ``min_tokens`` tokens that meet in one equi join. A whole name is covered by
    as few runs as possible, and is found where all of them hit at the right distance. Where the names are too many for
    a broadcast, runs of the texts that no name has are dropped by a filter of bits before they are shuffled. Hits travel
    with the number of their name, not with the name.
    """
    if min_tokens < 1:
        raise ValueError("min_tokens must be positive")
    n = min_tokens
    gram = lambda words, at: F.array_join(F.slice(words, at, n), " ")

    named = entities.select(F.col(entity_id).alias("_eid"), tokens(F.col(search_field)).alias("_name"))
    named = named.where(F.size("_name") >= n)
    names = named.select("_name").distinct().withColumn("_no", F.monotonically_increasing_id())
    names = materialize(names, "names")  # a number stays with its name
    last = F.size("_name") - n
    if partial:
        offsets = F.sequence(F.lit(0), last)
    else:
        offsets = F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(n)), F.array(last)))
    pieces = (
        names.withColumn("_offsets", offsets)
        .withColumn("_needed", F.size("_offsets"))
        .select("_name", "_no", "_needed", F.explode("_offsets").alias("_offset"))
        .select("_no", "_needed", "_offset", gram(F.col("_name"), F.col("_offset") + 1).alias("_gram"))
    )

    words = documents.select(F.col(document_id).alias("_doc"), tokens(F.col(text)).alias("_words"))
    words = words.where(F.size("_words") >= n)
    runs = words.select(
        "_doc",
        F.posexplode(
            F.transform(F.sequence(F.lit(1), F.size("_words") - n + 1), lambda at: gram(F.col("_words"), at))
        ).alias("_pos", "_gram"),
    )
    if is_small(pieces):
        met = runs.join(F.broadcast(pieces), "_gram")
    else:
        met = maybe_held(runs, pieces).join(pieces, "_gram")
    hits = met.select("_doc", "_no", "_needed", "_pos", (F.col("_pos") - F.col("_offset")).alias("_start"))
    if partial:
        # A name that repeats a run hits one position more than once.
        found = hits.select("_doc", "_no", F.col("_pos").alias("_start")).distinct()
    else:
        found = (
            hits.groupBy("_doc", "_no", "_start", "_needed")
            .agg(F.count("*").alias("_hits"))
            .where(F.col("_hits") == F.col("_needed"))
        )
    per_name = found.groupBy("_doc", "_no").agg(
        F.count("*").alias("matches"), F.min("_start").alias("first_position")
    )
    entity = named.join(names, "_name").select("_no", "_eid")
    return per_name.join(small_side(entity), "_no").select(
        F.col("_doc").alias("document_id"), F.col("_eid").alias("entity_id"), "matches", "first_position"
    )


def maybe_held(runs: DataFrame, pieces: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``runs`` whose ``_gram`` may be in ``pieces``: all that are, and some others whose bit is set as well."""
    place = F.pmod(F.xxhash64("_gram"), F.lit(bits))
    lit = pieces.select(place.alias("_at")).groupBy(F.bitmap_bucket_number("_at").alias("_bucket"))
    maps = lit.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_map"))
    bit = F.bitmap_bit_position(F.col("_at"))
    byte = F.conv(F.hex(F.substring("_map", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = (byte / F.pow(F.lit(2), bit % 8)).cast("int") % 2 == 1
    placed = runs.withColumn("_at", place).withColumn("_bucket", F.bitmap_bucket_number("_at"))
    return placed.join(F.broadcast(maps), "_bucket").where(is_set).select(*runs.columns)
