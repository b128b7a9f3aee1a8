"""Connected components of a table of links, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the least node reachable.

    Each round, every node hooks to its least neighbour, hooks are followed to their ends by doubling, and the links are
    contracted to the ends. Links shrink at least by half a round; tables written in between keep the lineage short.
    """
    edges = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    found = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        hook = materialize(hook.select("node", F.least("node", "least").alias("root")), "hooks")
        while True:
            up = hook.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            jumped = materialize(hook.join(up, F.col("root") == F.col("_n")).select("node", F.col("_r").alias("root"), (F.col("root") != F.col("_r")).alias("moved")), "jumps")
            hook = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        ends = hook.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        if found is None:
            found = hook
        else:
            found = materialize(found.join(ends, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_r", "root").alias("root")), "roots")
        left = edges.join(ends, F.col("a") == F.col("_n")).select(F.col("_r").alias("a"), "b")
        left = left.join(ends, F.col("b") == F.col("_n")).select("a", F.col("_r").alias("b"))
        edges = materialize(left.where("a <> b").distinct(), "links")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
