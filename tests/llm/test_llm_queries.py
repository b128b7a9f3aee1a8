"""The registered queries against their SQL or a plain version, and the pipeline stage by stage."""

import sys
from collections import Counter
from pathlib import Path

import pytest
from helpers import components
from oracle_check import compare

import __spark_entry__ as entry
import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
LLM = [n for n in entry.queries() if n.startswith("op")] + ["pipeline"]


@pytest.mark.parametrize("name", [n for n in LLM if n in entry.oracle_sql()])
def test_query_matches_sql(spark, name):
    assert compare(spark, FOLDER, name) is None


def test_join_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = components([tuple(r) for r in docs])
    found = {r.doc_id: r.component_id for r in entry.queries()["op5_jaccard_join"](spark, FOLDER).collect()}
    assert found == want


def test_all_queries_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in LLM if n != "pipeline"}
    assert numbers == set(range(1, 14)) and "pipeline" in entry.queries()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "ngram_jaccard_join", "pii", "mixing", "packing"]
    kept = stages["quality_classifier"](spark, docs, FOLDER).cache()
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert all(i in ids for i, q in labels.items() if q == 1)
    single = stages["ngram_jaccard_join"](spark, kept, FOLDER).cache()
    want = components([(r.doc_id, r.text) for r in kept.collect()])
    assert single.columns == docs.columns and {r.doc_id for r in single.collect()} == set(want.values())
    clean = stages["pii"](spark, single, FOLDER).cache()
    assert clean.columns == docs.columns and clean.count() == single.count()
    mixed = stages["mixing"](spark, clean, FOLDER)
    assert mixed.columns == docs.columns
    mixed = mixed.cache()
    packed = stages["packing"](spark, mixed, FOLDER).cache()
    rows = packed.collect()
    assert all(len(r.tokens) == r.n_tokens <= r.bucket_len for r in rows)
    assert len({(r.bucket, r.batch, r.slot) for r in rows}) == len(rows)
    delivered, given = Counter(), Counter()
    for r in rows:
        delivered[r.doc_id, r.piece, tuple(r.tokens)] += 1
    for r in mixed.collect():
        told = (r.text or "").encode().split()
        for piece in range(max(1, -(-len(told) // 2048))):
            given[r.doc_id, piece, tuple(w.decode() for w in told[piece * 2048 : piece * 2048 + 2048])] += 1
    assert delivered == given
    assert packed.count() == corpus_pipeline.run(spark, FOLDER).count() > 0


def test_the_rest_does_not_import_this_package():
    root = Path(entry.__file__).parent
    for path in (root / "tagloom").rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "llm" not in path.read_text(), path
    assert "tagloom.llm" in sys.modules
