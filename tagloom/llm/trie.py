"""The prefix trie of conversations, with its aggregates, from sorted neighbours.

A turn is known by 16 bytes of the digest of its role and text, a conversation by the sequence of its turns' marks, cut
into segments of ``SEGMENT`` turns. A segment knows the turns before it by a sum of 128 bits over (place, mark): segments
of one sum form a *piece* of the trie, rooted where the piece before it ends. So no row grows with a conversation.

Segments are sorted by piece, marks and id into ranges (equal conversations are spread over ranges, too) and worked on in
blocks of rows. In a block, a union-find takes the longest common prefixes of sorted neighbours in descending depth:
rows that meet form a component, and each merge makes a branching node; the nodes on the way from one branching node to
the next have the same members. A node that holds neither the first nor the last row of its block is finished. The
others, at most two paths of a block, are what remains of its forest: each is written as a partial node with the sums of the
finished ones below it. Partial nodes of equal path are merged across all blocks, and hand their own values to the partial
nodes above them (at most ``SEGMENT`` each).

Values of later segments reach the nodes of earlier ones in a second pass, carried by the least member of each piece,
summed from its last segment back. Digests of ending members are made from sorted strings of ids, read one by one.

Defined cases: null ids take no part; null turns come first, equal ones by the turn's mark; null role or text is empty;
repeated rows are turns of their own; an empty table has no nodes; other columns do not matter. Ids are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.text import WORD, word_count
from tagloom.operators.batching import running_totals
from tagloom.session import materialize

SEGMENT, MARK = 64, 16
BLOCK = 1 << 15  # rows of a block
LANES = ["_a", "_b", "_c", "_d"]


def marked(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, mark, words): turns in their order, numbered from 0."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", digest.alias("digest"), word_count(text).alias("words")
    )
    placed = running_totals(turns, ["conv_id"], ["turn", "digest"], {"place": F.lit(1)})
    return placed.select("conv_id", "place", F.unhex(F.substring("digest", 1, 2 * MARK)).alias("mark"), "words")


def with_shared_heads(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """(conv_id, length, place, mark, words): every conversation with the first h turns of conversation c - c % every in the
    place of its own first h, h being the checksum of c modulo ``most``. A conversation without turns is one row of null
    place."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("h", h)
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("place") < most - 1))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("place", "mark", "words"))).alias("heads"))
    based = sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(heads, "base", "left")
    taken = F.filter(F.coalesce("heads", F.array()), lambda t: t["place"] < F.col("h"))
    convs = based.withColumn("heads", taken).withColumn("k", F.size("heads").cast("long"))
    convs = convs.withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    own = turns.join(convs.select("conv_id", "h", "k", "length"), "conv_id").where(F.col("place") >= F.col("h"))
    own = own.select("conv_id", "length", (F.col("place") - F.col("h") + F.col("k")).alias("place"), "mark", "words")
    first = convs.select("conv_id", "length", F.explode("heads").alias("t")).select("conv_id", "length", "t.place", "t.mark", "t.words")
    bare = convs.where(F.col("length") == 0).select(
        "conv_id", "length", F.lit(None).cast("long").alias("place"), F.lit(None).cast("binary").alias("mark"), F.lit(None).cast("long").alias("words")
    )
    return own.unionByName(first).unionByName(bare)


def segments(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, seg, piece, next, path, words, goes_on) of turns (conv_id, length, place, mark, words)."""
    lane = [(F.xxhash64(F.lit(i), "place", "mark").bitwiseAND(0xFFFFFFFF)).alias(f"_h{i}") for i in range(4)]
    number = F.floor(F.coalesce("place", F.lit(0)) / segment).cast("long").alias("seg")
    turn = F.when(F.col("place").isNotNull(), F.struct("place", "mark", "words"))
    rows = turns.select("conv_id", "length", number, turn.alias("t"), *lane, F.col("place").isNotNull().alias("real"))
    held = rows.groupBy("conv_id", "seg").agg(
        F.max("length").alias("length"),
        F.sort_array(F.collect_list("t")).alias("t"),
        *[F.sum(F.when(F.col("real"), F.col(f"_h{i}"))).alias(c) for i, c in enumerate(LANES)],
    )
    held = held.select(
        "conv_id", "seg", *[F.coalesce(c, F.lit(0)).alias(c) for c in LANES],
        F.concat(F.unhex(F.lit("")), F.unhex(F.array_join(F.transform("t", lambda t: F.hex(t["mark"])), ""))).alias("path"),
        F.col("t.words").alias("words"), (F.col("length") > (F.col("seg") + 1) * segment).alias("goes_on"),
    )
    summed = running_totals(held, ["conv_id"], ["seg"], {f"{c}0": F.col(c) for c in LANES})
    hexed = lambda parts: F.concat(*[F.lpad(F.hex(p % (1 << 32)), 8, "0") for p in parts])
    return summed.select(
        "conv_id", "seg", hexed([F.col(f"{c}0") for c in LANES]).alias("piece"),
        hexed([F.col(f"{c}0") + F.col(c) for c in LANES]).alias("next"), "path", "words", "goes_on",
    )


class Top:
    """The uppermost node so far of a component of neighbouring rows."""

    __slots__ = ("lo", "hi", "depth", "n", "least", "children", "leaves", "saved", "goes_on", "ends", "waiting")

    def __init__(self, row: int, depth: int, conv: int, goes_on: bool, carry: tuple[int, int, int]):
        self.lo = self.hi = row
        self.depth, self.n, self.least, self.goes_on = depth, 1, conv, goes_on
        self.children, self.leaves, self.saved = carry
        self.ends: list[int] = [] if goes_on else [conv]
        self.waiting: list[dict] = []  # finished nodes whose parent is this node


class Forest:
    """The trie of one block of sorted segments."""

    def __init__(self, rows: list[dict], segment: int):
        self.rows, self.segment, self.out = rows, segment, []

    def _open(self, top: Top) -> bool:
        return top.lo == 0 or top.hi == len(self.rows) - 1

    def _node(self, top: Top, depth: int, kind: str) -> dict:
        row = self.rows[top.lo]
        return {
            "kind": kind, "seg": row["seg"], "piece": row["piece"], "local": depth, "conv_id": top.least, "n_convs": top.n,
            "n_children": top.children, "n_leaves": top.leaves, "saved": top.saved, "parent": None, "path": None,
            "words": row["words"][depth - 1] if depth else 0, "goes_on": top.goes_on, "ends": None,
            "next": row["next"] if depth == self.segment else None,
        }

    def _finish(self, top: Top) -> None:
        """Write the node on top."""
        if self._open(top):
            row = self.rows[top.lo]
            node = self._node(top, top.depth, "partial")
            node["path"] = row["path"][: top.depth * MARK]
            self.out.append(node)
            if top.ends:
                ends = {k: node[k] for k in ("seg", "piece", "path", "local")}
                self.out.append({**dict.fromkeys(node), **ends, "kind": "ends", "conv_id": top.ends[0], "ends": ",".join(map(str, top.ends))})
            for child in top.waiting:  # their parent's least member is known once all blocks are merged
                child["path"] = node["path"]
                self.out.append(child)
            top.waiting = []
        else:
            if not top.children and not top.goes_on:
                top.leaves = 1
            node = self._node(top, top.depth, "done")
            top.saved += (top.n - 1) * node["words"]
            node.update(n_leaves=top.leaves, saved=top.saved, ends=hashlib.sha256(",".join(map(str, top.ends)).encode()).hexdigest())
            for child in top.waiting:
                child["parent"] = top.least
                self.out.append(child)
            top.waiting = [node]
        top.ends = []

    def _lift(self, top: Top, depth: int) -> None:
        """Finish the nodes below ``depth``; the component's top is then its node of that depth."""
        while top.depth > depth:
            self._finish(top)
            # An open node counts as its parent's child once all blocks are merged.
            top.children, top.goes_on, top.depth = int(not self._open(top)), False, top.depth - 1

    def _merge(self, a: Top, b: Top) -> Top:
        """One node of two neighbouring components of equal depth."""
        a.hi, a.least, a.goes_on = b.hi, min(a.least, b.least), a.goes_on or b.goes_on
        a.n, a.children, a.leaves, a.saved = a.n + b.n, a.children + b.children, a.leaves + b.leaves, a.saved + b.saved
        a.ends += b.ends
        a.waiting += b.waiting
        return a

    def build(self) -> list[dict]:
        rows = self.rows
        tops = [Top(i, len(r["path"]) // MARK, r["conv_id"], r["goes_on"], (r["children"], r["leaves"], r["carried"])) for i, r in enumerate(rows)]
        up = list(range(len(rows)))

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        edges: list[list[int]] = [[] for _ in range(self.segment + 1)]
        for i in range(len(rows) - 1):
            a, b = rows[i], rows[i + 1]
            if (a["seg"], a["piece"]) == (b["seg"], b["piece"]):
                edges[common(a["path"], b["path"])].append(i)
        for depth in range(self.segment, -1, -1):
            for i in edges[depth]:
                a, b = find(i), find(i + 1)
                self._lift(tops[a], depth)
                self._lift(tops[b], depth)
                up[b] = a
                tops[a] = self._merge(tops[a], tops[b])
        for i in range(len(rows)):
            if up[i] == i:
                self._lift(tops[i], 0)
                self._finish(tops[i])
                self.out += tops[i].waiting
        return self.out


def common(a: bytes, b: bytes) -> int:
    """Number of first turns that two paths share."""
    if a == b:
        return len(a) // MARK
    n = min(len(a), len(b)) // MARK
    for d in range(n):
        if a[d * MARK : (d + 1) * MARK] != b[d * MARK : (d + 1) * MARK]:
            return d
    return n


_NODE = (
    "kind string, seg long, piece string, local long, conv_id long, n_convs long, n_children long, n_leaves long, saved long, "
    "parent long, path binary, words long, goes_on boolean, ends string, next string"
)
_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
_NODE_ARROW = pa.schema([(f.split()[0], _KINDS[f.split()[1]]) for f in _NODE.split(", ")])


def _forests(rows: DataFrame, segment: int, block: int) -> DataFrame:
    """Nodes, partial nodes and ends of all blocks of ``rows`` (segments with what later ones carry to them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def built() -> Iterator[pa.RecordBatch]:
            nodes = Forest(held, segment).build() if held else []
            for a in range(0, len(nodes), 10_000):
                yield pa.RecordBatch.from_pylist(nodes[a : a + 10_000], _NODE_ARROW)

        for batch in batches:
            held += batch.to_pylist()
            if len(held) >= block:
                yield from built()
                held = []
        yield from built()

    ordered = rows.repartitionByRange("seg", "piece", "path", "conv_id").sortWithinPartitions("seg", "piece", "path", "conv_id")
    return ordered.mapInArrow(run, _NODE)


PLACE = ["seg", "piece", "path"]


def _above(path: Column, steps: Column | int = 1) -> Column:
    return F.substring(path, F.lit(1), (F.octet_length(path) - MARK * steps).cast("int"))


def _nodes(rows: DataFrame, segment: int, block: int) -> DataFrame:
    """(seg, piece, local, conv_id, parent, up, n_convs, n_children, n_leaves, saved, ends, next) of every node of every
    piece. ``up`` is set where the parent is the end of the piece before this one."""
    built = materialize(_forests(rows, segment, block), "trie-forests")
    partial = built.where(F.col("kind") == "partial").groupBy(*PLACE).agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("n_children").alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("goes_on").alias("goes_on"),
        F.first("words").alias("words"), F.first("next").alias("next"), F.first("local").alias("local"),
    )
    partial = materialize(partial, "trie-partial")
    below = partial.where(F.col("local") > 0).select("seg", "piece", _above(F.col("path")).alias("path"))
    joined = partial.join(below.groupBy(*PLACE).agg(F.count("*").alias("open_children")), PLACE, "left")
    joined = joined.withColumn("n_children", F.col("children") + F.coalesce("open_children", F.lit(0)))
    own_leaf = ((F.col("n_children") == 0) & ~F.col("goes_on")).cast("long")
    joined = joined.withColumn("own_leaf", own_leaf).withColumn("own_saved", (F.col("n_convs") - 1) * F.col("words"))
    given = joined.where((F.col("own_leaf") > 0) | (F.col("own_saved") > 0))
    given = given.select("seg", "piece", "path", "own_leaf", "own_saved", F.explode(F.sequence(F.lit(0), F.col("local").cast("int"))).alias("up"))
    given = given.groupBy("seg", "piece", _above(F.col("path"), F.col("up")).alias("path")).agg(F.sum("own_leaf").alias("l"), F.sum("own_saved").alias("s"))
    ends = _ends(built.where(F.col("kind") == "ends").select(*PLACE, "conv_id", "ends"))
    open_nodes = joined.join(given, PLACE, "left").join(ends, PLACE, "left").select(
        *PLACE, "local", "conv_id", F.lit(None).cast("long").alias("parent"), "n_convs", "n_children",
        (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends"), "next",
    )
    open_nodes = open_nodes.withColumn("path", F.when(F.col("local") > 0, _above(F.col("path"))))
    names = [c for c in open_nodes.columns if c != "next"] + ["next"]
    found = built.where(F.col("kind") == "done").select(*names).unionByName(open_nodes)
    # The parent of a partial node, or of a finished node that lies directly under one, is a partial node.
    parents = partial.select(*PLACE, F.col("conv_id").alias("merged"))
    found = found.join(parents, PLACE, "left").withColumn("parent", F.coalesce("parent", "merged"))
    return found.drop("merged", "path").withColumn("up", F.when((F.col("local") == 1) & (F.col("seg") > 0), F.col("piece")))


def _ends(chunks: DataFrame) -> DataFrame:
    """(seg, piece, path, digest): the SHA-256 of the ids of all chunks of a node, which is fed one chunk at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                key = tuple(row[c] for c in PLACE)
                if key == at:
                    digest.update(b",")
                else:
                    if at is not None:
                        out.append((*at, digest.hexdigest()))
                    at, digest = key, hashlib.sha256()
                digest.update(row["ends"].encode())
            yield pack(out)
        if at is not None:
            yield pack([(*at, digest.hexdigest())])

    def pack(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip([*PLACE, "digest"], r)) for r in out], schema)

    schema = pa.schema([("seg", pa.int64()), ("piece", pa.string()), ("path", pa.binary()), ("digest", pa.string())])
    ordered = chunks.repartition(*PLACE).sortWithinPartitions(*PLACE, "conv_id")
    return ordered.mapInArrow(run, "seg long, piece string, path binary, digest string")


def _carried(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The segments with the values of all later pieces that their conversation is the least member of."""
    roots = nodes.where((F.col("local") == 0) & (F.col("seg") > 0)).select(
        "conv_id", "seg", F.col("n_children").alias("children"), F.col("n_leaves").alias("leaves"), "saved"
    )
    kept = rows.drop("children", "leaves", "carried").join(roots, ["conv_id", "seg"], "left").withColumn("_back", -F.col("seg"))
    owned = {"leaves0": F.coalesce("leaves", F.lit(0)), "saved0": F.coalesce("saved", F.lit(0))}
    summed = running_totals(kept, ["conv_id"], ["_back"], owned)
    children = roots.select("conv_id", (F.col("seg") - 1).alias("seg"), F.col("children").alias("children0"))
    return summed.join(children, ["conv_id", "seg"], "left").select(
        *[c for c in rows.columns if c not in ("children", "leaves", "carried")],
        F.coalesce("children0", F.lit(0)).alias("children"), F.col("leaves0").alias("leaves"), F.col("saved0").alias("carried"),
    )


def prefix_trie(turns: DataFrame, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """Every node of the trie of turns (conv_id, length, place, mark, words)."""
    zero = F.lit(0).cast("long")
    rows = segments(turns, segment).withColumns({"children": zero, "leaves": zero, "carried": zero})
    rows = materialize(rows, "trie-segments")
    if rows.where(F.col("seg") > 0).isEmpty():
        found = _nodes(rows, segment, block)
    else:
        first = materialize(_nodes(rows, segment, block), "trie-nodes")
        found = materialize(_nodes(materialize(_carried(rows, first), "trie-carried"), segment, block), "trie-nodes")
        ends = found.where(F.col("next").isNotNull()).select((F.col("seg") + 1).alias("seg"), F.col("next").alias("up"), F.col("conv_id").alias("end"))
        found = found.join(ends, ["seg", "up"], "left").withColumn("parent", F.when(F.col("up").isNotNull(), F.col("end")).otherwise(F.col("parent")))
        found = found.where((F.col("local") > 0) | (F.col("seg") == 0))
    return found.select(
        "conv_id", (F.col("seg") * segment + F.col("local")).alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The trie of all conversations, which share the first turns of every twentieth."""
    turns = materialize(marked(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "trie-turns")
    return prefix_trie(with_shared_heads(turns))


# The polynomial and the start value of CRC-32.
OP12_SQL = rf"""
WITH crc AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
  FROM range(256) r(i)),
turns AS (
  SELECT conv_id, sha256(concat_ws(':', length(coalesce(role, '')), coalesce(role, ''), coalesce(text, ''))) AS mark,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(concat_ws(':', length(coalesce(role, '')), coalesce(role, ''), coalesce(text, '')))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
           lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.place, t.mark, t.words FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.place < c.h
  UNION ALL SELECT c.conv_id, 1, t.place, t.mark, t.words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place >= c.h),
paths AS (
  SELECT c.conv_id, coalesce(marks, []) AS marks, coalesce(words, []) AS words
  FROM convs c LEFT JOIN (
    SELECT conv_id, list(mark ORDER BY part, place) AS marks, list(words ORDER BY part, place) AS words FROM rebuilt GROUP BY 1) USING (conv_id)),
steps AS (
  SELECT conv_id, d AS depth, sha256(array_to_string(marks[1:d], ',')) AS node,
         CASE WHEN d > 0 THEN sha256(array_to_string(marks[1:d - 1], ',')) END AS above,
         CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, d = len(marks) AS ends
  FROM (SELECT *, unnest(range(len(marks) + 1)) AS d FROM paths)),
nodes AS (
  SELECT depth, node, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS own,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM steps GROUP BY 1, 2),
children AS (SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
known AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, node)),
below AS (
  SELECT s.depth, s.node, sum((k.n_children = 0)::INT) AS n_leaves, sum(k.own) AS saved_tokens
  FROM known k JOIN steps s ON s.conv_id = k.conv_id AND s.depth <= k.depth GROUP BY 1, 2)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, b.n_leaves, b.saved_tokens, k.ends_sha256
FROM known k JOIN below b USING (depth, node) LEFT JOIN nodes p ON p.depth = k.depth - 1 AND p.node = k.above
"""
