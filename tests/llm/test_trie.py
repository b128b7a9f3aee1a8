"""The prefix trie against a plain one, with small segments and blocks so that every boundary is met."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tagloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def mark(role, text):
    return hashlib.sha256(f"{len(role or '')}:{role or ''}:{text or ''}".encode()).hexdigest()


def plain(rows, shared=True):
    """Nodes of the trie as tuples."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, mark(role, text), len((text or "").encode().split())))
    convs = {c: [(m, w) for _, _, m, w in sorted(t)] for c, t in convs.items()}
    built = convs
    if shared:
        built = {}
        for c, own in convs.items():
            h = zlib.crc32(str(c).encode()) % 4
            rest = abs(c) % 20 * (1 if c >= 0 else -1)
            built[c] = convs.get(c - rest, [])[:h] + own[h:]
    members, words = {}, {(): 0}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            key = tuple(m for m, _ in turns[:d])
            members.setdefault(key, []).append(c)
            if d:
                words[key] = turns[d - 1][1]
    children = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        below = children.get(key, [])
        leaves[key] = sum(leaves[k] for k in below) if below else 1
        saved[key] = sum(saved[k] for k in below) + (len(members[key]) - 1) * words[key]
    out = []
    for key, held in members.items():
        ends = sorted(c for c in held if len(built[c]) == len(key))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        up = min(members[key[:-1]]) if key else None
        out.append((min(held), len(key), up, len(held), len(children.get(key, [])), leaves[key], saved[key], sha))
    return sorted(out, key=repr)


def got(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def tables():
    pick = random.Random(5)
    words = ["a", "b b", "c c c", "", None]
    mixed = []
    for c in range(120):
        for t in range(pick.randrange(0, 9)):
            mixed.append((c, t, pick.choice(["user", "user", "tool", None]), pick.choice(words[: 2 + c % 4])))
    yield mixed
    yield [(c, t, "user", "same") for c in range(90) for t in range(5)]  # copies only
    yield [(c, t, "user", "same") for c in range(40) for t in range(c % 13)]  # each a prefix of the next
    yield [(7, t, "user", f"t{t % 3}") for t in range(150)] + [(c, t, "user", f"t{t % 3}") for c in (3, 9, 27) for t in range(8 * c)]
    yield [(None, 1, "user", "x"), (-3, 2, "user", "y"), (-3, None, "user", "z"), (5, 1, None, None), (5, 1, None, None), (0, 1, "user", "y z")]
    yield []


@pytest.mark.parametrize("number", range(6))
@pytest.mark.parametrize("sizes", [(4, 16), (64, 1 << 15)])
def test_nodes(spark, number, sizes):
    rows = list(tables())[number]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("path", "seg", "place", "words", "mark", "h", "k", "n", "t", "children"):
        df = df.withColumn(name, F.lit("x"))
    turns = trie.marked(df)
    assert got(trie.prefix_trie(trie.with_shared_heads(turns), *sizes)) == plain(rows)


def test_arrow_batches_do_not_matter(spark):
    rows = next(tables())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        turns = trie.marked(spark.createDataFrame(rows, SCHEMA))
        assert got(trie.prefix_trie(trie.with_shared_heads(turns), 3, 20)) == plain(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def test_one_block():
    """The forest of a block alone: union-find makes a node per merge, and the nodes of both edges stay open."""
    row = lambda conv, path: {
        "seg": 0, "piece": "", "next": "", "path": b"".join(bytes([c]) * trie.MARK for c in path), "words": [1] * len(path),
        "conv_id": conv, "goes_on": False, "children": 0, "leaves": 0, "carried": 0,
    }
    out = trie.Forest([row(1, b"a"), row(2, b"bcd"), row(3, b"bce"), row(4, b"bf"), row(5, b"g")], 64).build()
    done = {(n["conv_id"], n["local"]): (n["n_convs"], n["n_children"], n["n_leaves"], n["saved"], n["parent"]) for n in out if n["kind"] == "done"}
    assert done == {
        (2, 3): (1, 0, 1, 0, 2), (3, 3): (1, 0, 1, 0, 2), (2, 2): (2, 2, 2, 1, 2), (4, 2): (1, 0, 1, 0, 2), (2, 1): (3, 2, 3, 3, None),
    }
    assert sorted(n["local"] for n in out if n["kind"] == "partial") == [0, 1, 1]
