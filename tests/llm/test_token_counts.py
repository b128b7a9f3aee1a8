"""Token counts against the tokenizer's own encoding of whole texts."""

import random

import pytest
from helpers import awkward, clashing, empty

from tagloom.llm import token_counts as tc

PATH = tc.vocabulary_path()
LETTERS = ["a", "b", "Z", "é", "漢", "😀", "1", "23", " ", " ", "  ", "\n", "\t ", " ", "'", "'ll", "'s", "!", "...", "<|endoftext|>", "<|endof", "text|>", "the ", " of", "x" * 40]


def plain(text, name=PATH):
    from tokenizers import Tokenizer

    return len(Tokenizer.from_file(name).encode(text or "", add_special_tokens=False))


def table(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def random_texts(seed, n, size):
    pick = random.Random(seed)
    return ["".join(pick.choice(LETTERS) for _ in range(pick.randrange(size))) for _ in range(n)]


def check(spark, texts, **sizes):
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in tc.token_counts(table(spark, texts), PATH, **sizes).collect()}
    assert got == {i: (len((t or "").encode()), plain(t)) for i, t in enumerate(texts)}


def test_small_texts(spark):
    check(spark, [*random_texts(1, 60, 300), "", None, " ", "a b", "it's we'll", "x  \n y", "<|endoftext|>", " <|endoftext|> a <|endoftext|>"])


def test_spliced_texts(spark):
    check(spark, random_texts(2, 40, 900), huge=64, step=64, overlap=24)


def test_overlaps_are_widened(spark):
    texts = ["x" * 1000, "word " * 30 + " " * 500 + "end", "ab" * 300 + " tail" * 40, "one two " * 20 + "'" * 200 + "ll", "漢" * 300, "<|endoftext|>" * 60]
    check(spark, texts, huge=50, step=50, overlap=8)


def test_widening_joins_chunks(spark, monkeypatch):
    rounds = []
    widened = tc._widened
    monkeypatch.setattr(tc, "_widened", lambda *a: rounds.append(1) or widened(*a))
    check(spark, ["some words here " * 20], huge=64, step=64, overlap=32)
    assert not rounds
    check(spark, ["some words here " * 5 + "x" * 300 + " and more words" * 8], huge=64, step=64, overlap=32)
    assert rounds


def test_awkward_tables(spark):
    docs = awkward(spark)
    docs = docs.union(docs.sparkSession.createDataFrame([(None, "a b", None, None, None), (None, "a b", None, None, None)], docs.schema))
    want = sorted(((r.doc_id, len((r.text or "").encode()), plain(r.text)) for r in docs.collect()), key=repr)
    for df in (docs, clashing(docs)):
        assert sorted(map(tuple, tc.token_counts(df, PATH, huge=4096, step=2048, overlap=128).collect()), key=repr) == want
    assert tc.token_counts(empty(spark), PATH).count() == 0


def test_other_vocabularies_are_not_cut(spark):
    path = tc.vocabulary_path("word_bpe_49k.json")
    texts = ["Some  Words, it's 12 " * 10, "漢字 <|endoftext|> x"]
    got = {r.doc_id: r.n_tokens for r in tc.token_counts(table(spark, texts), path, huge=20, step=20, overlap=5).collect()}
    assert got == {i: plain(t, path) for i, t in enumerate(texts)}


def test_sizes_are_checked(spark):
    with pytest.raises(ValueError):
        tc.token_counts(empty(spark), PATH, huge=10, step=20, overlap=5)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tc.op13_token_counts(spark, folder).collect()}
    want = {i: (len(t.encode()), plain(t)) for i, t in docs.items()}
    assert got == {i: (b, n, n > 1024) for i, (b, n) in want.items()}
