"""Annotation where the names are too many for a broadcast: the filter of bits loses nothing and drops most runs."""

import random

from pyspark.sql import functions as F

from tagloom.operators import annotate as module


def test_the_filter_keeps_every_run_of_a_name(spark):
    pieces = spark.range(0, 4000, 7).select(F.concat(F.lit("g"), F.col("id").cast("string")).alias("_gram"))
    runs = spark.range(0, 6000).select("id", F.concat(F.lit("g"), F.col("id").cast("string")).alias("_gram"))
    kept = {r.id for r in module.maybe_held(runs, pieces).collect()}
    wanted = {i for i in range(0, 4000, 7)}
    assert wanted <= kept and len(kept) < len(wanted) + 30
    few = module.maybe_held(runs, pieces, bits=64).count()  # all bits are set: nothing is lost
    assert few == 6000
    assert module.maybe_held(runs, pieces.limit(0)).count() == 0


def test_many_names_are_found_as_few_are(spark, monkeypatch):
    pick = random.Random(3)
    word = lambda: f"w{pick.randrange(12)}"
    names = [(i, " ".join(word() for _ in range(pick.randrange(1, 6)))) for i in range(200)] + [(900, None), (901, "")]
    texts = [(i, " ".join(word() for _ in range(60))) for i in range(30)] + [(90, None), (91, "w1")]
    entities, docs = spark.createDataFrame(names, "id long, name string"), spark.createDataFrame(texts, "doc_id long, text string")
    for partial in (False, True):
        small = sorted(map(tuple, module.annotate(docs, entities, partial=partial).collect()))
        with monkeypatch.context() as patch:
            patch.setattr(module, "is_small", lambda df: False)
            large = sorted(map(tuple, module.annotate(docs, entities, partial=partial).collect()))
        assert small == large and small
        if not partial:
            split = {i: t.split() for i, t in texts if t}
            brute = []
            for d, words in split.items():
                for e, name in names:
                    n = (name or "").split()
                    at = [p for p in range(len(words) - len(n) + 1) if words[p : p + len(n)] == n] if len(n) >= 2 else []
                    if at:
                        brute.append((d, e, len(at)))
            assert sorted(brute) == [(d, e, m) for d, e, m, _ in small]
