"""Exact top-k inner products by best-first search in an M-tree.

Vectors become whole numbers, floor(1024 * x). With one more component sqrt(R^2 - |x|^2) for candidates (R the largest
norm) and 0 for queries, the inner product falls exactly as the Euclidean distance grows, so a metric tree finds it.

The tree is a table of pages. Routing objects are a sample of at most ``ROUTERS`` vectors; a vector belongs to the
nearest one. A cell of more than ``PAGE`` vectors is split by distance to routing objects of its own, level by level,
until every cell is one page; only equal vectors are dealt by a digest. A page holds its nodes: routing object, covering
radius and distance to the page's own, and for every vector its distance to its node's (the parent distances). The
directory has the centre and covering radius of every page, in chunks of ``DIRECTORY``. Pages are written once and
searched in two rounds: every query first searches the page with the nearest centre, which gives a lower bound of its
k-th score; then blocks of about ``BLOCK`` queries near each other meet the pages that the directory can't exclude for
some query of the block, best node first. A node or a vector is passed over without computing a distance if the stored
distances and the triangle inequality show that it can't reach the bound. A task holds a page and a block.

Scores are computed in whole numbers, by 64-bit or longer ones where a product may pass 2 ** 52; bounds have a margin above
their rounding error, so they only save work. A score beyond 64 bits is held at their end.

Defined cases: vectors null or with null or non-finite components take no part; shorter vectors count as padded with
zeros; the query itself (its id) is no candidate; ties go to the smaller id; equal vectors are candidates each; null ids
take no part; fewer candidates than k give all; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import materialize, small_side

SCALE, ROUTERS, PAGE, FANOUT, BLOCK, DIRECTORY = 1024, 64, 4096, 64, 4096, 1024
_MARGIN = 1e-6


def whole(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): valid vectors as whole numbers."""
    v = F.col(vec_col)
    good = v.isNotNull() & F.col(id_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return df.where(good).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(SCALE * x.cast("double"))).alias("v"))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _lift(x: np.ndarray, reach: float) -> np.ndarray:
    """Candidates with the component that makes all norms equal."""
    f = x.astype(np.float64)
    return np.concatenate((f, np.sqrt(np.maximum(reach - (f * f).sum(1), 0.0))[:, None]), axis=1)


def build(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of one page: (node of each point, its distance to the node's router, routers' rows, radii, distance to the page's router, row 0)."""
    n = max(1, len(points) // FANOUT)
    chosen, gap = [0], np.full(len(points), np.inf)
    for _ in range(n - 1):  # each next router is the point farthest from those before
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(gap.argmax()))
    rows = np.unique(np.array(chosen))
    apart = np.sqrt(np.maximum((points**2).sum(1)[:, None] + (points[rows] ** 2).sum(1)[None, :] - 2 * points @ points[rows].T, 0))
    node = apart.argmin(1)
    parent = np.sqrt(((points - points[rows][node]) ** 2).sum(1))
    radius = np.zeros(len(rows))
    np.maximum.at(radius, node, parent)
    return node, parent, rows, radius, np.sqrt(((points[rows] - points[0]) ** 2).sum(1))


def split(cells: DataFrame, large: DataFrame, width: int, reach: float, page: int, depth: int) -> DataFrame:
    """Rows of the ``large`` cells (cell, count), each in the cell of the nearest of a few vectors of its own cell.

    The routers are the first of a cell by digest, at most ``FANOUT``. A cell is dealt to several tasks, each of which
    reads the cell's routers before its vectors. Vectors that are nearest to several equal routers are dealt among them.
    """
    sized = cells.join(large, "cell")
    parts = F.ceil(F.col("count") / (16 * page))
    by_digest = Window.partitionBy("cell").orderBy(F.xxhash64("row"), "row")
    picked = sized.withColumn("k", F.row_number().over(by_digest)).where(F.col("k") <= FANOUT).where(F.col("k") <= F.ceil(2 * F.col("count") / page))
    first = picked.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("salt"), F.lit(0).alias("flag"), "id", "v", "row")
    rest = sized.select("cell", F.pmod(F.xxhash64("row", F.lit(5)), parts).alias("salt"), F.lit(1).alias("flag"), "id", "v", "row")
    both = first.unionByName(rest).withColumn("turn", F.pmod(F.xxhash64("row", F.lit(depth)), F.lit(1 << 30)))
    both = both.repartition("cell", "salt").sortWithinPartitions("cell", "salt", "flag", "row")

    def assign(batches):
        key, own = None, []
        for batch in batches:
            for now, rows in batch.groupby(["cell", "salt"], sort=False):
                if now != key:
                    key, own = now, []
                own = own + rows.loc[rows["flag"] == 0, "v"].tolist()  # a cell's routers come before its vectors
                rows = rows[rows["flag"] == 1]
                if not len(rows):
                    continue
                routers, times = np.unique(_matrix(own, width), axis=0, return_counts=True)
                x, lifted = _lift(_matrix(rows["v"].to_list(), width), reach), _lift(routers, reach)
                near = ((lifted**2).sum(1)[None, :] - 2 * x @ lifted.T).argmin(1)
                among = rows["turn"].to_numpy() % times[near]
                yield rows.assign(cell=[f"{now[0]}/{i}.{j}" for i, j in zip(near, among)])[["id", "v", "row", "cell"]]

    return both.mapInPandas(assign, "id long, v array<long>, row long, cell string")


def pages(df: DataFrame, id_col: str, vec_col: str, page: int = PAGE) -> tuple[DataFrame, int, float]:
    """(pages, width, squared reach). The pages are written once; each is a cell of at most ``page`` vectors."""
    vectors = materialize(whole(df, id_col, vec_col).withColumn("row", F.monotonically_increasing_id()), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    width, reach = vectors.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(norm), F.lit(0.0))).first()
    reach *= 1 + 1e-12  # above the rounding of the sum
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(ROUTERS).collect()
    routers = _matrix([r["v"] for r in sample], width) if sample else np.zeros((1, width), np.int64)
    lifted = _lift(routers, reach)

    def route(batches):
        for batch in batches:
            x = _lift(_matrix(batch["v"].to_list(), width), reach)
            far = (x**2).sum(1)[:, None] + (lifted**2).sum(1)[None, :] - 2 * x @ lifted.T
            yield batch.assign(cell=far.argmin(1).astype(str))

    cells = materialize(vectors.mapInPandas(route, "id long, v array<long>, row long, cell string"), "cells")
    depth = 0
    while True:
        large = materialize(cells.groupBy("cell").count().where(F.col("count") > page), "large")
        if large.isEmpty():
            break
        depth += 1
        large = small_side(large)
        kept = cells.join(large, "cell", "left_anti")
        cells = materialize(kept.unionByName(split(cells, large, width, reach, page, depth)), "cells")

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        x, ids = _matrix(rows["v"].to_list(), width), rows["id"].to_numpy(np.int64)
        points = _lift(x, reach)
        middle = int(((points - points.mean(0)) ** 2).sum(1).argmin())  # the page's own routing object goes first
        order = np.concatenate(([middle], np.delete(np.arange(len(ids)), middle)))
        x, ids, points = x[order], ids[order], points[order]
        node, parent, router_rows, radius, up = build(points)
        return pd.DataFrame(
            {
                "page": [rows["cell"].iloc[0]], "ids": [ids.tobytes()], "vectors": [x.tobytes()],
                "node": [node.astype(np.int32).tobytes()], "parent": [parent.tobytes()], "routers": [router_rows.astype(np.int64).tobytes()],
                "radius": [radius.tobytes()], "up": [up.tobytes()],
                "centre": [points[0].tobytes()], "cover": [float(np.sqrt(((points - points[0]) ** 2).sum(1)).max())],
            }
        )

    built = cells.groupBy("cell").applyInPandas(
        fill, "page string, ids binary, vectors binary, node binary, parent binary, routers binary, radius binary, up binary, centre binary, cover double"
    )
    return materialize(built, "pages"), width, float(reach)


def directory(tree: DataFrame, size: int = DIRECTORY) -> DataFrame:
    """The tree's upper level in chunks: names, centres and covering radii of about ``size`` pages each."""
    chunks = max(1, -(-tree.count() // size))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"names": [rows["page"].tolist()], "centres": [b"".join(rows["centre"])], "covers": [rows["cover"].to_numpy(np.float64).tobytes()]})

    named = tree.select("page", "centre", "cover", F.pmod(F.xxhash64("page"), F.lit(chunks)).alias("chunk"))
    packed = named.groupBy("chunk").applyInPandas(pack, "names array<string>, centres binary, covers binary")
    return materialize(packed, "directory")


def _away(q: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances of queries (whose last component is 0) to centres."""
    squares = (q**2).sum(1)[:, None] + (centres**2).sum(1)[None, :]
    return np.sqrt(np.maximum(squares - 2 * q @ centres[:, :-1].T, 0.0))


def _slack(q: np.ndarray, reach: float) -> np.ndarray:
    """How far rounding may put a computed distance of a query from the true one."""
    return 1e-7 * np.sqrt((q**2).sum(1) + reach) + _MARGIN


class Page:
    """One page of the tree."""

    def __init__(self, row, width: int, reach: float):
        self.ids = np.frombuffer(row.ids, np.int64)
        self.x = np.frombuffer(row.vectors, np.int64).reshape(len(self.ids), width)
        self.points = _lift(self.x, reach)
        self.exact = self.x.astype(np.float64)
        node = np.frombuffer(row.node, np.int32)
        self.parent, self.radius, self.up = (np.frombuffer(b, np.float64) for b in (row.parent, row.radius, row.up))
        self.centre = self.points[np.frombuffer(row.routers, np.int64)]
        self.members = [np.flatnonzero(node == i) for i in range(len(self.radius))]
        self.reach = reach

    def scores(self, rows: np.ndarray, whole_q: np.ndarray, q: np.ndarray, most: float) -> np.ndarray:
        """Inner products in whole numbers; ``most`` is a bound of their size. Those beyond 64 bits are held at the end."""
        if most < 2.0**52:
            return (self.exact[rows] @ q).astype(np.int64)
        if most < 2.0**62:
            return self.x[rows] @ whole_q
        end = 2**63 - 1
        return np.array([max(-end, min(end, s)) for s in self.x[rows].astype(object) @ whole_q.astype(object)], np.int64)

    def search(self, own: int, whole_q: np.ndarray, k: int, floor: float) -> list[tuple[int, int]]:
        """The k best (score, -id) of the page for a query, of those that score at least ``floor``."""
        q = whole_q.astype(np.float64)
        norm = float((q * q).sum())
        most = np.sqrt(norm * self.reach)
        point = np.append(q, 0.0)
        best: list[tuple[int, int]] = []

        def limit() -> float:
            """Distance beyond which nothing counts."""
            least = max(floor, best[0][0]) if len(best) == k else floor
            return np.sqrt(max(norm + self.reach - 2 * least, 0.0)) * (1 + _MARGIN) + _MARGIN if least > -np.inf else np.inf

        top = np.sqrt(((self.points[0] - point) ** 2).sum())
        cheap = np.maximum(np.abs(top - self.up) - self.radius, 0.0)  # without computing a distance to the node
        queue = [(b, 0, i, 0.0) for i, b in enumerate(cheap)]
        heapq.heapify(queue)
        while queue:
            bound, computed, i, away = heapq.heappop(queue)
            if bound > limit():
                break
            if not computed:
                away = float(np.sqrt(((self.centre[i] - point) ** 2).sum()))
                heapq.heappush(queue, (max(away - self.radius[i], 0.0), 1, i, away))
                continue
            rows = self.members[i]
            rows = rows[np.abs(away - self.parent[rows]) <= limit()]
            scores = self.scores(rows, whole_q, q, most)
            enough = scores >= max(floor, best[0][0]) if len(best) == k else scores >= floor
            for s, v in zip(scores[enough].tolist(), self.ids[rows[enough]].tolist()):
                if v == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -v))
                elif (s, -v) > best[0]:
                    heapq.heapreplace(best, (s, -v))
        return best


def top_k(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", page: int = PAGE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each of ``queries`` its k best of ``df`` other than itself."""
    tree, width, reach = pages(df, id_col, vec_col, page)
    asked = materialize(whole(queries, id_col, vec_col).withColumnRenamed("id", "query_id"), "queries")
    upper = directory(tree)
    asked = materialize(at_home(asked, upper, width, block), "homes")
    found = "query_id long, vec_id long, score long"

    def search(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples():
                held = Page(row, width, reach)
                own = np.frombuffer(row.query_ids, np.int64).tolist()
                q = np.frombuffer(row.queries, np.int64).reshape(len(own), width)
                for i, point, floor in zip(own, q, np.frombuffer(row.floors, np.float64).tolist()):
                    out += [(i, -v, s) for s, v in held.search(i, point, k, floor)]
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    # First round: the queries that share a nearest page meet it.
    unbounded = asked.withColumn("floor", F.lit(float("-inf")))
    near = tree.join(_blocks(unbounded, ["page", "part"], width), "page").mapInPandas(search, found)
    floors = near.groupBy("query_id").agg(F.min("score").cast("double").alias("floor"), F.count("*").alias("n")).where(F.col("n") >= k)
    below = F.col("floor") - F.abs("floor") * 1e-12  # a score above 2 ** 53 may be rounded up
    bounded = asked.join(floors.select("query_id", below.alias("floor")), "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    # Second round: blocks of queries near each other meet the pages that the directory can't exclude.
    second = small_side(materialize(_blocks(bounded, ["block"], width), "blocks"))
    pairs = materialize(reachable(upper, second, width, reach), "reachable")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = tree.drop("centre", "cover").join(small_side(pairs), "page").repartition(parts, "page", "block")
    met = keyed.join(second, "block").mapInPandas(search, found)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def at_home(asked: DataFrame, upper: DataFrame, width: int, block: int) -> DataFrame:
    """``asked`` with the nearest page of each query, its part of the page's queries, and its block of neighbours.

    Pages in the order of their names lie beside others of their cell; blocks are runs of about ``block`` queries in it.
    """

    def nearest(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples():
                centres, names = np.frombuffer(row.centres, np.float64).reshape(-1, width + 1), row.names
                q = _matrix([np.asarray(v)[:width] for v in row.vs], width).astype(np.float64)
                away = _away(q, centres)
                best = away.argmin(1)
                out.append(pd.DataFrame({"query_id": row.ids, "page": [names[i] for i in best], "away": away[np.arange(len(q)), best]}))
            yield pd.concat(out) if out else pd.DataFrame({"query_id": [], "page": [], "away": []})

    hundreds = max(1, -(-asked.count() // 512))
    some = asked.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(hundreds)).alias("some")).agg(F.collect_list("query_id").alias("ids"), F.collect_list("v").alias("vs"))
    met = upper.withColumn("some", F.explode(F.sequence(F.lit(0), F.lit(hundreds - 1)))).join(some, "some")
    homes = met.mapInPandas(nearest, "query_id long, page string, away double").groupBy("query_id").agg(F.min_by("page", F.struct("away", "page")).alias("page"))
    homed = asked.join(homes, "query_id")
    counts = homed.groupBy("page").count()
    before = Window.orderBy("page").rowsBetween(Window.unboundedPreceding, -1)  # one row per page
    runs = counts.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    turn = F.pmod(F.xxhash64("query_id", F.lit(3)), F.col("count"))
    return homed.join(runs, "page").select(
        "query_id", "v", "page", F.floor(turn / block).alias("part"), F.floor((F.col("before") + turn) / block).alias("block")
    )


def _blocks(asked: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Queries packed by ``keys``: ids, vectors and lower bounds of their k-th scores."""

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        q = _matrix(rows["v"].map(lambda v: v[:width]).to_list(), width)
        packed = {"query_ids": [rows["query_id"].to_numpy(np.int64).tobytes()], "queries": [q.tobytes()], "floors": [rows["floor"].to_numpy(np.float64).tobytes()]}
        return pd.DataFrame({name: [value] for name, value in zip(keys, key)} | packed)

    kinds = {"page": "string", "part": "long", "block": "long"}
    schema = ", ".join(f"{name} {kinds[name]}" for name in keys) + ", query_ids binary, queries binary, floors binary"
    return asked.groupBy(*keys).applyInPandas(pack, schema)


def reachable(upper: DataFrame, blocks: DataFrame, width: int, reach: float) -> DataFrame:
    """(block, page): pages whose covering ball holds, for some query of the block, places near enough to count."""

    def survive(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples():
                centres, covers = np.frombuffer(row.centres, np.float64).reshape(-1, width + 1), np.frombuffer(row.covers, np.float64)
                floors = np.frombuffer(row.floors, np.float64)
                q = np.frombuffer(row.queries, np.int64).reshape(len(floors), width).astype(np.float64)
                bounded = np.isfinite(floors)
                room = (q**2).sum(1) + reach - 2 * np.where(bounded, floors, 0.0)
                limit = np.where(bounded, np.sqrt(np.maximum(room, 0.0)) * (1 + _MARGIN) + _MARGIN, np.inf)
                least = _away(q, centres) - covers[None, :] * (1 + _MARGIN) - _slack(q, reach)[:, None]
                out += [(row.block, row.names[i]) for i in np.flatnonzero((least <= limit[:, None]).any(0))]
            yield pd.DataFrame(out, columns=["block", "page"])

    last = blocks.agg(F.coalesce(F.max("block"), F.lit(0))).first()[0]
    every = upper.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long")))).repartition("block")
    return every.join(blocks.select("block", "queries", "floors"), "block").mapInPandas(survive, "block long, page string")


def op7_mtree_topk(spark, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all others."""
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(df, df.where(F.col("vec_id") % 100 == 0))


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
