"""Exact similarity join of documents in the Jaccard metric space of their word shingles.

The distance 1 - |x & y| / |x | y| is a metric. Unrelated texts all lie at distance 1 from each other, so a pivot chosen
from the whole table would put every text into one region. Regions are therefore seeded by rare shingles, which loses
nothing: of a document with n shingles at most floor(n / 5) may be absent from a partner, so under any global order of
shingles two partners share one of their first floor(n / 5) + 1. The order used here is ascending document frequency.

1. Of equal sets only the document with the least id goes on. Shingles below ``SHARE`` of the hash range are counted
   over all documents: a document with more of those that no other has than it may lose has no partner and leaves. The
   rest are counted once more, with all their shingles and among themselves, and leave by the same rule.
2. The remaining documents join the regions of their rarest shared shingles. A region's pivot is the document with the
   smallest part of shingles of its own (an original rather than one of its edited copies), then the least id; every
   member's distance to it is computed exactly, so the region splits into the ball around the pivot (all linked to it)
   and the documents outside. Regions of one pivot are one region from here on.
3. Regions with documents outside join recursively: those become pivots in turn, and meet just the members that the
   triangle inequality leaves: whose distances to the first pivot differ by at most the join's distance (boundary
   documents of the ball included), with sizes and shared parts that allow a link, and not yet in the same component. Each level has four times
   the pivots of the last one; the recursion ends when no region has an undecided pair.
4. Components of all links, then of all copies.

A text with very common shingles (boilerplate) does not flood a region: shingles found in a hundredth of a sample of
documents come last in the order. The sample only chooses the order, so it can't change the result; the list it yields
has at most 100 times the sample's mean number of shingles. Distances to one pivot are computed in slices of its members.

Defined cases: null text is empty: no shingles, linked with nothing; a text of fewer than five words is one shingle; a
null id takes no part (its own component, null; ``one_of_each`` lets it take part); rows that share an id are one
document, linked if any of its texts is; an empty table gives no rows; other columns do not matter. Inside the join a
document is a different (id, text), known by a 64-bit digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.components import components
from tagloom.llm.text import mix, shingles, word_batches
from tagloom.session import materialize, small_side

WORDS, SHARE, COMMON_SAMPLE = 5, 0.25, 2000
#: Linked when FIVE * |x & y| >= FOUR * |x | y|: similarity 0.8 in whole numbers.
FOUR, FIVE = 4, 5
_EDGE = np.uint64(int(SHARE * 2**64))


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for _, hashes, counts in word_batches(column):
        values, n = shingles(hashes, counts, WORDS)
        at = 0
        for size in n:
            yield np.unique(values[at : at + size])
            at += size


def marks(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_shingles, sampled, mark_a, mark_b): set size, shingles below the edge, and a 128-bit digest of the set."""

    def run(batches):
        for batch in batches:
            rows = np.zeros((batch.num_rows, 4), np.int64)
            for i, s in enumerate(shingle_sets(batch.column(2))):
                a, b = mix(s ^ np.uint64(0xA0761D6478BD642F)), mix(s ^ np.uint64(0xE7037ED1A0B428DB))
                rows[i] = len(s), np.searchsorted(s, _EDGE), a.sum(dtype=np.uint64).astype(np.int64), b.sum(dtype=np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(rows[:, j]) for j in range(4)]], ["doc_id", "key", "n_shingles", "sampled", "mark_a", "mark_b"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "key", "text").mapInArrow(run, f"doc_id {kind}, key long, n_shingles long, sampled long, mark_a long, mark_b long")


def common_shingles(docs: DataFrame, total: int) -> np.ndarray:
    """Shingles that a hundredth of a sample of documents has (at least 20 of them)."""
    part = min(1.0, COMMON_SAMPLE / max(total, 1))

    def run(batches):
        for batch in batches:
            for s in shingle_sets(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int64))], ["s"])

    key = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 12), 16, 10).cast("double")
    counted = docs.where(key < part * 16.0**12).select("text").mapInArrow(run, "s long").groupBy("s").count()
    rows = counted.where(F.col("count") >= max(20, COMMON_SAMPLE // 100)).select("s").collect()
    return np.sort(np.array([r["s"] for r in rows], np.int64))


def postings(docs: DataFrame, common: np.ndarray, whole: bool) -> DataFrame:
    """(s, doc, place): the shingles of each document, below the edge only unless ``whole``.

    Place 0 is below the edge; 1 beyond it, but among the first of the document that its prefix might need; 2 the rest.
    Common shingles have 4 more: they are not counted.
    """

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            values, owners, places, held = [], [], [], 0
            for i, s in enumerate(shingle_sets(batch.column(1))):
                below, need = int(np.searchsorted(s, _EDGE)), len(s) // FIVE + 1
                taken = s.astype(np.int64) if whole else s[:below].astype(np.int64)
                place = np.full(len(taken), 2, np.int8)
                place[: max(below, need)] = 1
                place[:below] = 0
                if len(common):
                    at = np.minimum(np.searchsorted(common, taken), len(common) - 1)
                    place[common[at] == taken] += 4
                values.append(taken)
                places.append(place)
                owners.append(np.full(len(taken), ids[i]))
                held += len(taken)
                if held > 200_000:
                    yield _rows(values, owners, places)
                    values, owners, places, held = [], [], [], 0
            if values:
                yield _rows(values, owners, places)

    def _rows(values, owners, places):
        parts = [pa.array(np.concatenate(values)), pa.array(np.concatenate(owners).astype(np.int64)), pa.array(np.concatenate(places))]
        return pa.RecordBatch.from_arrays(parts, ["s", "doc", "place"])

    return docs.select("doc_id", "text").mapInArrow(run, "s long, doc long, place byte")


def _shared(rows: DataFrame) -> DataFrame:
    """Postings of shingles that more than one document has, with their document frequency."""
    counted = rows.where("place < 4").withColumn("df", F.count("*").over(Window.partitionBy("s"))).where("df > 1")
    return counted.unionByName(rows.where("place >= 4").select("s", "doc", (F.col("place") - 4).cast("byte").alias("place"), F.lit(1 << 40).alias("df")))


def regions(docs: DataFrame, marked: DataFrame, common: np.ndarray) -> DataFrame:
    """(s, doc, n, shared): the documents of each region of two and more, with the number of shingles that another has."""
    firsts = marked.where("n_shingles > 0").groupBy("mark_a", "mark_b").agg(F.min(F.struct("doc_id", "n_shingles", "sampled")).alias("first")).select("first.*")
    may_lose = F.floor(F.col("n_shingles") / FIVE)
    counts = _shared(postings(docs, common, False)).groupBy("doc").agg(F.count("*").alias("shared"))
    left = firsts.join(counts, F.col("doc_id") == F.col("doc"), "left")
    # Too small to have a shingle below the edge is no reason to leave.
    left = left.where(F.col("sampled") - F.coalesce("shared", F.lit(0)) <= may_lose).select("doc_id", "n_shingles")
    left = materialize(left, "candidates")
    texts = docs.join(small_side(left.select("doc_id")), "doc_id", "left_semi")
    lists = _shared(postings(texts, common, True)).groupBy("doc").agg(
        F.count("*").alias("shared"),
        F.array_sort(F.collect_list(F.when(F.col("place") < 2, F.struct("place", "df", "s")))).alias("known"),
    )
    known = lists.join(left, F.col("doc") == F.col("doc_id"))
    alone = F.col("n_shingles") - F.col("shared")
    room = (may_lose + 1 - alone).cast("int")
    # Below the edge by frequency, then beyond it by hash: sorted by (place, df, s), with one df for all beyond. Hashes have
    # no sign where places are given, so s is sorted with its sign bit flipped.
    unsigned = lambda s: s.bitwiseXOR(F.lit(-(1 << 63)))
    ordered = F.array_sort(F.transform("known", lambda e: F.struct(e["place"], F.when(e["place"] == 0, e["df"]).otherwise(0).alias("df"), unsigned(e["s"]).alias("s"))))
    prefix = F.transform(F.slice(ordered, F.lit(1), F.greatest(room, F.lit(1))), lambda e: unsigned(e["s"]))
    members = known.where(room > 0).select(F.explode(prefix).alias("s"), "doc", F.col("n_shingles").alias("n"), "shared")
    return members.withColumn("_size", F.count("*").over(Window.partitionBy("s"))).where("_size > 1").drop("_size")


def distances(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(doc, pivot, both, either): sizes of the common set and the union for distinct pairs (doc, pivot).

    A pivot's members are cut into slices of about 256; its text goes to each slice, whose task holds one pivot's set.
    """
    slices = pairs.groupBy("pivot").agg((F.floor(F.count("*") / 256) + 1).cast("int").alias("slices"))
    as_member = pairs.join(slices, "pivot").select(
        F.col("doc").alias("_doc"), "pivot", F.pmod(F.xxhash64("doc"), F.col("slices")).cast("int").alias("slice"), F.lit(1).alias("role")
    )
    as_pivot = slices.select(F.col("pivot").alias("_doc"), "pivot", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("role"))
    sent = small_side(materialize(as_member.unionByName(as_pivot), "compare"))
    texts = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.join(sent, F.col("doc_id") == F.col("_doc")).select("pivot", "slice", "role", F.col("_doc").alias("doc"), "text")
    rows = rows.repartition(parts, "pivot", "slice").sortWithinPartitions("pivot", "slice", "role", "doc")

    def run(batches):
        key, held = None, None
        for batch in batches:
            pivot, part, role, doc = (batch.column(i).to_pylist() for i in range(4))
            out = []
            for i, s in enumerate(shingle_sets(batch.column(4))):
                if role[i] == 0:
                    if key != (pivot[i], part[i]):
                        key, held = (pivot[i], part[i]), s
                    continue
                at = np.minimum(np.searchsorted(held, s), len(held) - 1)
                both = int((held[at] == s).sum())
                out.append((doc[i], pivot[i], both, len(held) + len(s) - both))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["doc", "pivot", "both", "either"])

    return rows.mapInArrow(run, "doc long, pivot long, both long, either long")


def links(docs: DataFrame, marked: DataFrame, common: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """(links (a, b) between least documents of equal sets, their components (node, root))."""
    near = F.col("both") * FIVE >= F.col("either") * FOUR
    apart = 1 - F.col("both") / F.col("either")
    most = 1 - FOUR / FIVE + 1e-9
    region = materialize(regions(docs, marked, common), "regions")
    pivots = region.groupBy("s").agg(F.min(F.struct(1 - F.col("shared") / F.col("n"), "doc"))["doc"].alias("pivot"))
    seen = region.join(pivots, "s").where("doc <> pivot").groupBy("doc", "pivot").agg(F.max("n").alias("n"), F.max("shared").alias("shared"))
    seen = materialize(seen, "seen")
    found = materialize(distances(docs, seen.select("doc", "pivot")), "distances")
    roots = components(found.where(near).select(F.col("doc").alias("a"), F.col("pivot").alias("b")))
    known = found.groupBy("doc", "pivot").agg(F.min(apart).alias("d"), F.max(near).alias("in_ball"))
    left = seen.join(known, ["doc", "pivot"]).select(F.col("pivot").alias("s"), "doc", "n", "shared", "d", (~F.col("in_ball")).alias("outside"))
    wide = 4
    while True:
        # A ball's documents stay only within reach of the nearest document outside.
        by_region = Window.partitionBy("s")
        left = left.withColumn("_out", F.min(F.when(F.col("outside"), F.col("d"))).over(by_region))
        left = left.where(F.col("_out").isNotNull() & (F.col("outside") | (F.col("d") >= F.col("_out") - most))).drop("_out")
        left = left.withColumn("_turn", F.row_number().over(by_region.orderBy(F.col("outside").desc(), 1 - F.col("shared") / F.col("n"), "doc")))
        left = left.withColumn("_pivot", F.col("outside") & (F.col("_turn") <= wide))
        left = left.join(roots.select(F.col("node").alias("doc"), "root"), "doc", "left").withColumn("root", F.coalesce("root", "doc"))
        left = materialize(left, "undecided")
        if left.isEmpty():
            break
        turn = left.where("_pivot").select("s", F.col("doc").alias("pivot"), F.col("n").alias("_n"), F.col("shared").alias("_shared"), F.col("d").alias("_d"), F.col("root").alias("_root"), F.col("_turn").alias("_at"))
        met = left.join(turn, "s").where(
            (F.col("doc") != F.col("pivot"))
            & (~F.col("_pivot") | (F.col("_turn") > F.col("_at")))
            & (F.col("root") != F.col("_root"))
            & (F.least("n", "_n") * FIVE >= F.greatest("n", "_n") * FOUR)
            # The common part holds no shingle that only one document has; similar sets need 4 / 9 of both sizes.
            & (F.least("shared", "_shared") * (FOUR + FIVE) >= (F.col("n") + F.col("_n")) * FOUR)
            & (F.abs(F.col("d") - F.col("_d")) <= most)
        )
        met = met.select("doc", "pivot").distinct().join(found.select("doc", "pivot").distinct(), ["doc", "pivot"], "left_anti")
        met = materialize(met, "pairs")
        if not met.isEmpty():
            fresh = materialize(distances(docs, met), "distances")
            found = found.unionByName(fresh)
            roots = components(found.where(near).select(F.col("doc").alias("a"), F.col("pivot").alias("b")))
        left = left.where("NOT _pivot").select("s", "doc", "n", "shared", "d", "outside")
        wide *= 4
    return found.where(near).select(F.col("doc").alias("a"), F.col("pivot").alias("b")), roots


def row_key(doc_id: Column, text: Column) -> Column:
    """A number for each different (id, text), null ids included: what the join knows documents by."""
    return F.xxhash64(doc_id, F.coalesce(text, F.lit("")))


def _joined(docs: DataFrame, nulls: bool) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n_shingles, first) of every row, first being the least key with an equal set; components (node, root) of firsts.

    Rows with a null id take part only if ``nulls``.
    """
    docs = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    marked = materialize(marks(docs), "marks")
    part = F.lit(True) if nulls else F.col("doc_id").isNotNull()
    keyed = docs.where(part).select(F.col("key").alias("doc_id"), "text")
    known = marked.where(part).select(F.col("key").alias("doc_id"), "n_shingles", "sampled", "mark_a", "mark_b")
    _, roots = links(keyed, known, common_shingles(keyed, known.count()))
    firsts = known.where("n_shingles > 0").groupBy("mark_a", "mark_b").agg(F.min("doc_id").alias("first"))
    same = marked.join(firsts, ["mark_a", "mark_b"], "left")
    first = F.when((F.col("n_shingles") > 0) & part, F.col("first")).otherwise(F.col("key"))
    return same.select("doc_id", "key", "n_shingles", first.alias("first")), roots


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    same, roots = _joined(docs, nulls=False)
    same = materialize(same, "same")
    known = same.where("doc_id IS NOT NULL")
    # Different texts of one id are one document.
    several = known.groupBy("doc_id").agg(F.min("first").alias("a"), F.max("first").alias("b")).where("a <> b").select("doc_id", "a")
    several = materialize(known.join(several, "doc_id").where("a <> first").select(F.col("first").alias("a"), F.col("a").alias("b")), "several")
    if not several.isEmpty():
        roots = components(several.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    ids = known.groupBy("first").agg(F.min("doc_id").alias("id"))
    named = materialize(ids.join(roots, F.col("first") == F.col("node"), "left").select("first", "id", F.coalesce("root", "first").alias("root")), "named")
    least = named.groupBy("root").agg(F.min("id").alias("component_id"), F.count("*").alias("_n")).where("_n > 1").select("root", "component_id")
    named = named.join(small_side(materialize(least, "least")), "root", "left").select("first", F.coalesce("component_id", "id").alias("component_id"))
    return same.join(named, "first", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: exactly one row of each component of texts stays, one with the least id.

    Null ids take part and come last; different texts of one id are documents of their own, texts without words
    too. Of rows equal in id and text the least as JSON stays.
    """
    same, roots = _joined(docs, nulls=True)
    keys = same.groupBy("key", "first").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
    keys = materialize(keys.join(roots, F.col("first") == F.col("node"), "left").select("key", "id", "n", F.coalesce("root", "first").alias("root")), "keys")
    stays = keys.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("null"), "id", "key")).alias("least"), F.count("*").alias("_n"))
    stays = stays.where("_n > 1").select("root", F.col("least.key").alias("_stays"))
    marked = keys.join(small_side(materialize(stays, "stays")), "root", "left")
    marked = marked.select(F.col("key").alias("_key"), (F.col("key") == F.coalesce("_stays", "key")).alias("_kept"), F.col("n").alias("_n")).where("NOT _kept OR _n > 1")
    marked = small_side(materialize(marked, "gone"), max_rows=1_000_000)
    rows = docs.select(F.struct("*").alias("row")).withColumn("_id", row_key(F.col("row.doc_id"), F.col("row.text")))
    rows = rows.join(marked, F.col("_id") == F.col("_key"), "left").where("_kept IS NULL OR _kept")
    again = rows.where("_key IS NOT NULL").groupBy("_id").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return rows.where("_key IS NULL").select("row").unionByName(again.select("row")).select("row.*")


def op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
