"""Each operator on awkward, empty and clashing tables, and against plain versions."""

import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from helpers import awkward, base_spans, clashing, components, empty, held_out, sentence, shingles, words
from pyspark.sql import functions as F

from tagloom.llm import disclosure, fingerprint, jaccard, katz, mixing, mtree, packing, quality, sharding, text, warc


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Words -------------------------------------------------------------------------------------------------------------


def test_word_hashes_follow_words():
    import pyarrow as pa

    texts = ["One two  one", None, "", "\x0btwo\tONE ", "é É", "x" * 2_000_000, "漢字 one"]
    seen = {}
    for first, hashes, counts in text.word_batches(pa.array(texts)):
        at = 0
        for i, n in enumerate(counts):
            mine = words(texts[first + i])
            assert len(mine) == n
            for w, h in zip(mine, hashes[at : at + n]):
                assert seen.setdefault(w, h) == h
            at += n
    assert len(set(seen.values())) == len(seen)


# 1 Revisits --------------------------------------------------------------------------------------------------------

RECORDS = "record_id string, url string, captured_at long, kind string, status int, headers map<string,string>, payload_digest string, payload_length long"


def test_revisits(spark):
    rows = [
        ("a", "http://www.X.org:80/p/?utm_source=q&b=2&a=1#f", 10, "response", 200, {"ETag": '"1"', "Content-Type": "t", "Set-Cookie": "s"}, "d", 5),
        ("b", "https://x.org/p?a=1&b=2", 20, "revisit", 304, {"etag": 'W/"1"', "DATE": "now", "Content-Type": "other"}, None, None),
        ("c", "x.org/p?a=1&b=2", 5, "revisit", 304, {"etag": '"1"'}, None, None),  # before any response
        ("d", "x.org/p?a=1&b=2", 10, "revisit", 304, {"etag": '"1"'}, None, None),  # at the response's time, the higher id
        ("e", "x.org/p?a=1&b=2", 90_000_000, "revisit", 304, None, "d", None),  # days later, by digest
        ("f", "x.org/p?a=1&b=2", 90_000_000, "revisit", 304, {}, None, None),
        ("g", "x.org/p?a=1&b=2", 30, "revisit", 304, {"etag": '"2"'}, "d", None),
        ("h", None, 30, "revisit", 304, {"etag": '"1"'}, None, None),
        ("i", "x.org/p?a=1&b=2", None, "revisit", 304, {"etag": '"1"'}, None, None),
        ("j", "x.org/p?a=1&b=2", 15, "response", 404, {"etag": '"9"'}, "z", 1),  # no full response
        ("b", "https://x.org/p?a=1&b=2", 20, "revisit", 304, {"etag": 'W/"1"', "DATE": "now", "Content-Type": "other"}, None, None),
    ]
    df = spark.createDataFrame(rows, RECORDS)
    found = [r for r in warc.resolve_revisits(df.withColumn("_slice", F.lit(1)).withColumn("outcome", F.lit("x"))).collect()]
    assert Counter((r.record_id, r.response_id, r.outcome) for r in found) == Counter(
        [("b", "a", "etag"), ("b", "a", "etag"), ("c", None, "missing"), ("d", "a", "etag"), ("e", "a", "digest"), ("f", "a", "unverified"),
         ("g", "a", "mismatch"), ("h", None, "missing"), ("i", None, "missing")]
    )
    merged = next(r for r in found if r.record_id == "b")
    assert {h.k: h.v for h in merged.headers} == {"etag": 'W/"1"', "content-type": "t", "set-cookie": "s", "date": "now"}
    assert (merged.payload_digest, merged.payload_length) == ("d", 5)
    assert warc.resolve_revisits(df.limit(0)).count() == 0


# 2 Mixing ----------------------------------------------------------------------------------------------------------


def test_mix(spark):
    docs = clashing(awkward(spark))
    placed, placements = mixing.mix(docs, block_words=50, shard_words=400)
    rows, dealt = placed.collect(), placements.collect()
    assert sum(r.copies for r in rows) == docs.count()
    total = sum(r["size"] * r.copies for r in rows)
    assert math.isclose(sum({r.source: r.target for r in rows}.values()), min(total, 3 * total), rel_tol=1e-9)
    times = Counter((r.doc_id, r.mark, r.source) for r in dealt)
    for r in rows:
        assert times[r.doc_id, r.mark, r.source] == r.passes + r.rest <= 3
    most = max(r["size"] * r.copies for r in rows)
    for source in {r.source for r in rows}:
        mine = [r for r in rows if r.source == source]
        taken = sum(r["size"] * r.copies * times[r.doc_id, r.mark, r.source] for r in mine)
        assert abs(taken - mine[0].target) <= most / 2 + 1
    again = mixing.mix(docs, block_words=50, shard_words=400)[1]
    assert sorted(map(repr, again.collect())) == sorted(map(repr, dealt))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixing.mixed_documents(empty(spark)).count() == 0


def test_splitting_tree_deals_exact_quotas():
    quotas = np.array([17, 0, 400, 3])
    dealt = np.stack([mixing.splits(quotas, 13, 5, s) for s in range(13)])
    assert (dealt.sum(0) == quotas).all()
    assert set(dealt.sum(1)) <= {420 // 13, 420 // 13 + 1}
    assert (mixing.splits(quotas, 13, 5, 4) == dealt[4]).all()


def test_targets_stop_at_the_cap(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 100), ("c", 1000), (None, 0)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(sizes).collect()}
    weights, size, left = {"a": 5, "b": 2, "c": 1, None: 5}, {"a": 1, "b": 100, "c": 1000, None: 0}, {}
    free, total = set(size), 1101.0
    while True:
        level = total / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > 3 * size[s]}
        if not over:
            break
        for s in over:
            left[s] = 3 * size[s]
            total -= left[s]
        free -= over
    left |= {s: level * weights[s] for s in free}
    assert all(math.isclose(found[s], left[s], abs_tol=1e-9) for s in size)


# 3 Quality ---------------------------------------------------------------------------------------------------------


def test_quality_on_awkward_tables(spark):
    docs = clashing(awkward(spark))
    found = {r.doc_id: r for r in quality.classify(docs).collect()}
    assert len(found) == 15 and not any(found[i].keep for i in (3, 4, 5)) and found[3].score == 0
    assert quality.accepted(docs).columns == docs.columns
    assert quality.classify(empty(spark)).count() == 0


def test_quality_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    scored = quality.op3_quality_labels(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    kept = {(r.quality, r.keep): r["count"] for r in scored.groupBy("quality", "keep").count().collect()}
    assert kept.get((1, False), 0) <= 0.01 * (kept[1, True] + kept.get((1, False), 0))
    assert kept.get((0, True), 0) <= 0.1 * (kept[0, False] + kept.get((0, True), 0))


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.8
    accuracy = (0.95, 0.9, 0.85, 0.8)
    votes = np.stack([np.where(rng.random(len(truth)) < a, truth, ~truth).astype(int) for a in accuracy], 1)
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, chance, prior = quality.label_model(patterns, counts.astype(float))
    assert ((post[at.ravel()] > 0.5) == truth).mean() > 0.95
    assert np.abs(chance[1, :, 1] - accuracy).max() < 0.05 and abs(prior - 0.8) < 0.05


# 4 Fingerprints ----------------------------------------------------------------------------------------------------


def plain_fingerprint(t):
    points = [ord(c) for c in t]
    if not points:
        return "00000000" * fingerprint.HASHES
    hashes = fingerprint.kmers(np.array(points, np.uint32)).tolist()
    seen, items = Counter(), []
    for h in hashes:
        items.append(int(fingerprint.mix(np.array([h + seen[h] * 0xD1B54A32D192ED03 & (1 << 64) - 1], np.uint64))[0]))
        seen[h] += 1
    out = ""
    for x, m in zip(fingerprint._XOR.tolist(), fingerprint._TIMES.tolist()):
        order = sorted(range(len(items)), key=lambda i: (((items[i] >> 32) ^ x) * m & 0xFFFFFFFF, i))[: fingerprint.TUPLE]
        value = np.zeros(1, np.uint64)
        for i in sorted(order):
            value = fingerprint.mix(value * np.uint64(0x9FB21C651E98DF25) + np.array([items[i]], np.uint64))
        out += f"{max(int(value[0]) >> 32, 1):08x}"
    return out


def test_fingerprints(spark):
    docs = clashing(awkward(spark)).drop("id")
    found = fingerprint.fingerprints(docs).collect()
    rows = sorted([(r.doc_id, r.text or "") for r in docs.collect()])
    want = Counter()
    for i, (doc, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        a, b, c = plain_fingerprint(t), plain_fingerprint(edited), plain_fingerprint(nxt)
        like = lambda x, y: sum(x[j : j + 8] == y[j : j + 8] for j in range(0, len(x), 8)) / fingerprint.HASHES
        want[doc, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, round(like(a, b), 6), round(like(a, c), 6)] += 1
    assert Counter((*tuple(r)[:5], round(r.near_edited, 6), round(r.near_next, 6)) for r in found) == want
    assert fingerprint.fingerprints(empty(spark)).count() == 0
    one = fingerprint.fingerprints(docs.where("doc_id = 9")).collect()
    assert one[0].near_next == 1.0
    nulls = docs.withColumn("doc_id", F.when(F.col("doc_id") > 3, F.col("doc_id")))
    assert fingerprint.fingerprints(nulls).count() == 16


# 5 Jaccard join ----------------------------------------------------------------------------------------------------


def test_join_on_awkward_tables(spark):
    docs = clashing(awkward(spark))
    rows = list({(r.doc_id, r.text) for r in docs.collect()})
    want = components(rows)
    found = jaccard.near_duplicates(docs).collect()
    assert len(found) == 16
    texts = dict(rows)
    assert all(r.component_id == want[r.doc_id] and r.n_shingles == len(shingles(texts[r.doc_id])) for r in found)
    assert jaccard.near_duplicates(empty(spark)).count() == 0
    with_null = docs.withColumn("doc_id", F.when(F.col("doc_id") != 7, F.col("doc_id")))
    assert [r.component_id for r in jaccard.near_duplicates(with_null).where("doc_id IS NULL").collect()] == [None]
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(want.values())


def chains(n=60):
    """Chains of texts that link only to their neighbours, groups around a common passage, and texts at the threshold."""
    rows, doc = [], 0
    for c in range(4):
        base = [f"c{c}v{i}" for i in range(100)]
        for step in range(n // 4):
            rows.append((doc, " ".join(base)))
            doc += 1
            base = base[4:] + [f"c{c}n{step}q{j}" for j in range(4)]
    common = [f"common{i}" for i in range(50)]
    for i in range(40):
        rows.append((doc, " ".join(common + [f"own{i}z{j}" for j in range(i % 14)])))
        doc += 1
    for cut in range(8, 16):
        rows.append((doc, " ".join(f"edge{i}" for i in range(104 - cut))))
        rows.append((doc + 1, " ".join(f"edge{i}" for i in range(104))))
        doc += 2
    return rows


def test_join_is_exact_on_chains_and_crowds(spark):
    rows = chains()
    docs = spark.createDataFrame([(d * 3 % 1009, t) for d, t in rows], "doc_id long, text string")
    want = components([(r.doc_id, r.text) for r in docs.collect()])
    found = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert found == want and len(set(want.values())) > 5


def test_one_row_of_each_component_stays(spark):
    a, b, c, d = (sentence(i, 40) for i in (1, 2, 3, 4))
    rows = [
        (1, a, "x"), (1, a, "y"), (1, a, "y"),  # ingested again
        (None, a + " more", "x"), (None, b, "x"), (None, b, "z"), (None, b + " more", "x"),  # null ids
        (5, c, "x"), (5, d, "x"), (6, d + " more", "x"),  # one id, two texts
        (7, None, "x"), (8, "", "x"), (8, "", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = got(jaccard.one_of_each(docs))
    assert Counter(r for r in kept if r[0] is not None) == Counter([(1, a, "x"), (5, c, "x"), (5, d, "x"), (7, None, "x"), (8, "", "x")])
    assert len(kept) == 6 and sum(r[0] is None and r[1].startswith(b) for r in kept) == 1
    found = Counter((r.doc_id, r.component_id) for r in jaccard.near_duplicates(docs).collect())
    assert found == {(1, 1): 3, (None, None): 4, (5, 5): 2, (6, 5): 1, (7, 7): 1, (8, 8): 2}


def test_join_links_short_texts(spark):
    rows, want = [], {}
    for pair in range(4000):
        n = 5 + pair % 17  # shingles; texts of 9 to 25 words
        full = [f"p{pair}w{i}" for i in range(n + 4)]
        cut = n // 5 if pair % 3 else max(n // 5 - 1, 0)  # at 0.8 or just above
        rows += [(2 * pair, " ".join(full)), (2 * pair + 1, " ".join(full[: len(full) - cut]))]
        a, b = shingles(rows[-1][1]), shingles(rows[-2][1])
        want[2 * pair] = 2 * pair
        want[2 * pair + 1] = 2 * pair + (100 * len(a & b) < 80 * len(a | b))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()} == want
    assert all(v % 2 == 0 for v in want.values())


# 6 Sharding --------------------------------------------------------------------------------------------------------


def test_lookup_table_is_even_and_stable():
    names = tuple(f"n{i}" for i in range(11))
    table = sharding.fill(names, 1009)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(table) == set(range(11))
    fewer = sharding.fill(names[:-1], 1009)
    moved = sum(names[a] != names[b] for a, b in zip(table, fewer) if a != 10)
    assert moved < 0.25 * 1009
    for bad in ((), 10), (names, 1000), (names, 7):
        with pytest.raises(ValueError):
            sharding.fill(*bad)


def test_place(spark, tmp_path):
    docs = clashing(awkward(spark))
    found = sharding.place(docs, "doc_id").select("doc_id", "slot", "shard").collect()
    table = sharding.fill()
    assert len(found) == 16
    for r in found:
        slot = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % sharding.SIZE
        assert (r.slot, r.shard) == (slot, sharding.SHARDS[table[slot]])
    nulls = sharding.place(docs.withColumn("doc_id", F.lit(None).cast("long")), "doc_id")
    assert nulls.select("shard").distinct().count() == 1
    assert sharding.place(empty(spark), "doc_id").count() == 0
    clash = docs.withColumns({c: F.lit("x") for c in ("_slot", "__slot", "slot", "shard", "n", "owner")})
    again = sharding.place(clash, "doc_id")
    assert sorted((r.doc_id, r.slot, r.shard) for r in again.collect()) == sorted((r.doc_id, r.slot, r.shard) for r in found)
    assert set(again.columns) == set(clash.columns)
    sharding.write_shards(docs, str(tmp_path / "s"), "doc_id")
    assert spark.read.parquet(str(tmp_path / "s")).count() == 16


# 7 M-tree ----------------------------------------------------------------------------------------------------------


def brute(vectors, queries, k):
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in vectors}
    out = []
    for i, v in queries:
        q = [math.floor(1024 * x) for x in v]
        scores = sorted((-sum(a * b for a, b in zip(q, w)), j) for j, w in whole.items() if j != i)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (1 + i % 3)]) for i in range(700)]
    rows += [(700 + i, rows[5][1]) for i in range(20)] + [(800, [0.0] * 6)]
    bad = [(900, None), (901, [1.0, None]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (None, [1.0] * 6)]
    df = clashing(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>"))
    queries = df.where("vec_id % 50 = 0 OR vec_id IN (5, 702)")
    want = brute(rows, [r for r in rows if r[0] % 50 == 0 or r[0] in (5, 702)], 7)
    assert got(mtree.top_k(df, queries, 7).select("query_id", "rank", "vec_id", "score")) == sorted(want, key=repr)
    assert mtree.top_k(df.limit(0), queries.limit(0)).count() == 0
    few = df.where("vec_id < 3")
    assert mtree.top_k(few, few).count() == 6


def test_top_k_of_large_components(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(300)]
    rows += [(300, [1e10, -1.0, 0.5, 2.0]), (301, [1e10, 1.0, 0.25, -2.0]), (302, [-3e8, 1e10, 1e4, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = df.where("vec_id % 100 = 0 OR vec_id = 7")
    whole = lambda v: [math.floor(1024 * x) for x in v]
    want, end = [], 2**63 - 1
    for i, v in rows:
        if i % 100 == 0 or i == 7:
            scored = [(max(-end, min(end, sum(a * b for a, b in zip(whole(v), whole(w))))), -j) for j, w in rows if j != i]
            want += [(i, n + 1, -j, s) for n, (s, j) in enumerate(sorted(scored, reverse=True)[:5])]
    assert got(mtree.top_k(df, queries, 5).select("query_id", "rank", "vec_id", "score")) == sorted(want, key=repr)


# 8 Packing ---------------------------------------------------------------------------------------------------------


def test_bounds_are_optimal():
    from itertools import combinations

    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = np.unique(rng.integers(0, 60, 9))
        counts = rng.integers(1, 20, len(lengths))

        def padding(edges):
            return sum(c * (min(e for e in edges if e >= n) - n) for n, c in zip(lengths, counts))

        for k in (1, 2, 3, 20):
            found = packing.bounds(lengths, counts, k)
            rest = [list(c) + [int(lengths[-1])] for m in range(min(k, len(lengths))) for c in combinations(lengths[:-1].tolist(), m)]
            assert padding(found) == min(map(padding, rest)) and len(found) <= k


def test_pack(spark):
    docs = clashing(awkward(spark))
    found = packing.pack(docs, buckets=4, longest=64, budget=256).collect()
    sizes = Counter()
    for r in found:
        sizes[r.doc_id] += r.n_tokens
        assert r.n_tokens <= r.bucket_len <= 64
    want = Counter()
    for r in docs.collect():
        want[r.doc_id] += len(words(r.text))
    assert +sizes == +want
    batches = defaultdict(list)
    for r in found:
        batches[r.bucket, r.batch].append(r)
    for rows in batches.values():
        assert len(rows) * rows[0].bucket_len <= 256 or len(rows) == 1
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert packing.pack(empty(spark)).count() == 0
    plain = packing.pack(docs, buckets=4, longest=64, budget=256)
    whole = packing.pack(clashing(docs), buckets=4, longest=64, budget=256, texts=True)
    assert got(whole.drop("tokens")) == got(plain) and whole.where("size(tokens) <> n_tokens").count() == 0
    assert packing.pack(empty(spark), texts=True).count() == 0
    texts = packing.piece_texts(docs, 64).where("doc_id = 6").orderBy("piece").collect()
    assert [w.encode() for r in texts for w in r.tokens] == docs.where("doc_id = 6").first().text.encode().split()


# 9 Personal data ---------------------------------------------------------------------------------------------------


def test_base_spans_match_plain_patterns(spark):
    texts = [r.text for r in awkward(spark).collect()] + [
        "a@b.c_x@y.zz @@ a@b a@b. .@-.-", "1.2.3.4.5.6.7.8 1.2.3.256 001.002.003.0004", "+1 (706) 555-3138 Therou 4644348398010899", "+(1) +12--- +1234567890123456",
        "4111-1111-1111-1111 4111  1111", "x@" + "a" * 9000, "1" * 9000 + ".2.3.4", "+1" + "(" * 9000, "a@b.cd" * 500, None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in disclosure.entities(docs).collect()}
    for i, t in enumerate(texts):
        assert ",".join(f"{s.kind}:{s.start}:{s.end}" for s in found[i]) == base_spans(t), i


def test_disclosing_terms(spark):
    rows = [(i, f"{sentence(i, 12)} write to Quixotania at bob@mail.example of the {i} office {sentence(i + 50, 12)}") for i in range(6)]
    rows += [(10 + i, f"write to the office at other{i}@mail.example now {sentence(i, 9)}") for i in range(40)]
    rows += [(100 + i, sentence(i) + " Write office") for i in range(40)] + [(200, None), (201, "")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text"))).drop("spans")
    found = {r.doc_id: r for r in disclosure.all_spans(docs).collect()}
    text = dict(rows)
    for i in range(6):
        terms = {text[i][s.start : s.end] for s in found[i].added}
        assert "Quixotania" in terms and "write" not in terms and "office" not in terms
    assert not any(found[i].added for i in range(100, 140))
    clean = {r.doc_id: r for r in disclosure.sanitised(docs).collect()}
    assert "Quixotania" not in clean[0].text and "[EMAIL]" in clean[0].text and "bob@" not in clean[0].text
    assert clean[100].text == text[100] and clean[200].text is None and len(clean[0].text) == clean[0].n_chars
    assert len(clean) == len(rows)
    assert disclosure.sanitised(empty(spark)).count() == 0
    assert disclosure.sanitised(clashing(awkward(spark)).drop("spans")).count() == 16


def test_terms_of_entities_that_stand_once_or_twice(spark):
    filler = lambda i: " ".join(f"common{(i + j) % 9}" for j in range(30))
    once = f"Quixotania {filler(1)} write to bob@mail.example {filler(2)} quixotania"
    twice = [f"Zanzibarum {filler(i)} call +1 (706) 555-3138 {filler(i + 1)} note{i}" for i in (3, 4)]
    rows = [(0, once), (1, once), (2, once), (3, twice[0]), (4, twice[1]), (5, f"Quixotania{filler(5)}")]
    rows += [(100 + i, f"{filler(i)} write call plain{i}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in disclosure.all_spans(docs).collect()}
    terms = {i: [(rows[i][1][s.start : s.end], s.removed) for s in found[i].added] for i in range(5)}
    # Far from the entity, both places; copies of one text are one text.
    assert all(terms[i] == [("Quixotania", True), ("quixotania", True)] for i in range(3))
    assert ("Zanzibarum", True) in terms[3] and ("Zanzibarum", True) in terms[4]
    assert not any(t.startswith("common") for i in terms for t, _ in terms[i])
    assert not any(found[i].added for i in (5, *range(100, 190)))
    clean = {r.doc_id: r.text for r in disclosure.sanitised(docs).collect()}
    assert "uixotania" not in clean[1] and "Zanzibarum" not in clean[4] and clean[5] == rows[5][1]


def plain_disclosure(rows):
    """Disclosing terms by dictionaries: {doc_id: [(start, end, removed)]}."""
    term = regex.compile(r"\p{L}[\p{L}\p{N}]{3,}+")
    texts = sorted({t or "" for _, t in rows})
    entities, terms = {}, {}
    for t in texts:
        spans = [x.split(":") for x in base_spans(t).split(",") if x]
        entities[t] = {f"{k}:{t[int(a):int(b)].lower()}" for k, a, b in spans}
        terms[t] = {m[0].lower() for m in term.finditer(t)}
    n_c, n_t, n_ct = (Counter(x for t in texts for x in of(t)) for of in (entities.get, terms.get, lambda t: {(c, w) for c in entities[t] for w in terms[t]}))
    told = {}
    for (c, w), both in n_ct.items():
        expected = n_c[c] * n_t[w] / len(texts)
        all_there_is = math.log2(len(texts) / n_c[c])
        share = math.log2(both / expected) / all_there_is if all_there_is else 0
        if share >= 0.8 - 1e-12 and both * math.log(both / expected) - both + expected >= -math.log(0.05):
            told[c, w] = share
    out = {}
    for i, t in rows:
        t = t or ""
        spans = [tuple(map(int, x.split(":")[1:])) for x in base_spans(t).split(",") if x]
        out[i] = []
        for m in term.finditer(t):
            share = max((told[c, m[0].lower()] for c in entities[t] if (c, m[0].lower()) in told), default=None)
            if share is not None and not any(a < m.end() and m.start() < b for a, b in spans):
                out[i].append((m.start(), m.end(), share >= 0.95))
    return out


def plain_sanitised(text, spans, added):
    marks = sorted([(s.start, s.end, f"[{s.kind.upper()}]") for s in spans] + [(t.start, t.end, "" if t.removed else "[TERM]") for t in added])
    out, at = "", 0
    for start, end, put in marks:
        out += text[at : max(at, start)] + (put if start >= at else "")
        at = max(at, end)
    return out + text[at:]


def test_added_spans_and_sanitised_texts_match_plain_counts(spark):
    rng = random.Random(4)
    names = [f"Name{chr(97 + i)}quist" for i in range(25)]
    rows = []
    for i in range(150):
        parts = [rng.choice(names[k % 25 : k % 25 + 2] + ["übrig"]) if rng.random() < 0.3 else f"word{rng.randrange(60)}" for k in range(rng.randrange(0, 40))]
        for k in range(rng.randrange(0, 4)):
            who = rng.randrange(30)
            parts.insert(rng.randrange(len(parts) + 1), rng.choice([f"p{who}x@mail.example", f"10.0.0.{who}", f"+49 151 23456{who:02}", f"😀ÄÖ{names[who % 25]}x{who}@host.example"]))
            parts.insert(rng.randrange(len(parts) + 1), names[who % 25])
        rows.append((i, " ".join(parts)))
    rows += [(200, None), (201, ""), (202, rows[3][1]), (203, " ".join(f"a{i}.b@c{i}.example Name{i % 7}quist 10.0.{i % 250}.1" for i in range(300)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in disclosure.all_spans(docs).collect()}
    plain = plain_disclosure(rows)
    assert sum(map(len, plain.values())) > 50
    for i, t in rows:
        assert [(s.start, s.end, s.removed) for s in found[i].added] == plain[i], i
        assert ",".join(f"{s.kind}:{s.start}:{s.end}" for s in found[i].spans) == base_spans(t), i
    for r in disclosure.sanitised(docs).collect():
        assert r.text == (None if r.doc_id == 200 else plain_sanitised(dict(rows)[r.doc_id], found[r.doc_id].spans, found[r.doc_id].added)), r.doc_id


def test_running_results_and_free_places(spark):
    rng = random.Random(9)
    arrays = [[rng.randrange(100) for _ in range(n)] for n in (0, 1, 15, 16, 17, 256, 257, 1000)]
    df = spark.createDataFrame([(a,) for a in arrays], "a array<int>")
    got = df.select(disclosure.running(F.col("a"), lambda x, y: x + y, 0), disclosure.running(F.col("a"), F.greatest, 0)).collect()
    assert [tuple(r) for r in got] == [(list(itertools.accumulate(a)), list(itertools.accumulate(a, max))) for a in arrays]


def test_a_text_of_forty_thousand_addresses(spark):
    text = " ".join(f"u{i}@h.ex word" for i in range(40_000))
    docs = spark.createDataFrame([(1, text)] + [(i, sentence(i)) for i in range(2, 9)], "doc_id long, text string")
    spans = disclosure.entities(docs).where("doc_id = 1").first().spans
    assert ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans) == base_spans(text)
    clean = {r.doc_id: r.text for r in disclosure.sanitised(docs).collect()}
    assert clean[1].count("[EMAIL]") == 40_000 and "@" not in clean[1]


# 10 Katz -----------------------------------------------------------------------------------------------------------


def plain_katz(rows):
    """Scores by dictionaries."""
    train = [words(t) + ["</s>"] for i, t in rows if not held_out(i)]
    c1, c2, ctx = Counter(), Counter(), Counter()
    for t in train:
        for v, w in zip(["<s>", *t], t):
            c1[w] += 1
            c2[v, w] += 1
            ctx[v] += 1
    n = sum(c1.values())
    count_of = lambda c: np.array([sum(x == r for x in c.values()) for r in range(1, katz.MOST + 2)])
    d1, d2 = katz.discounted(count_of(c1)), katz.discounted(count_of(c2))
    kept = lambda c, d: d[c] if c <= katz.MOST else c - katz.LEAST_LOSS
    unknown = sum(c - kept(c, d1) for c in c1.values()) / n if n else 1.0
    p1 = lambda w: kept(c1[w], d1) / n if c1[w] else unknown
    seen = defaultdict(list)
    for (v, w), c in c2.items():
        seen[v].append((w, c))
    alpha = {v: (1 - sum(kept(c, d2) for _, c in s) / ctx[v]) / (1 - sum(p1(w) for w, _ in s)) for v, s in seen.items()}
    for v, s in list(seen.items())[:50]:  # exactly normalised
        whole = sum(kept(c, d2) / ctx[v] for _, c in s) + alpha[v] * (sum(p1(w) for w in c1) + unknown - sum(p1(w) for w, _ in s))
        assert math.isclose(whole, 1, rel_tol=1e-9)
    out = {}
    for i, t in rows:
        tokens = words(t) + ["</s>"]
        score = base = 0.0
        for v, w in zip(["<s>", *tokens], tokens):
            score += math.log10(kept(c2[v, w], d2) / ctx[v] if c2[v, w] else alpha.get(v, 1.0) * p1(w))
            base += math.log10((c1[w] + 0.5) / (n + 0.5 * (len(c1) + 1)))
        out[i] = (held_out(i), len(tokens), sum(c1[w] > 0 for w in tokens), n, base, score)
    return out


def scored(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return katz.score(docs.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1).alias("held_out"), "text"))


def test_katz_matches_dictionaries(spark):
    rng = np.random.default_rng(4)
    zipf = lambda n: " ".join(f"t{x}" for x in rng.zipf(1.3, n) if x < 5000)
    rows = [(i, zipf(int(rng.integers(0, 120)))) for i in range(300)] + [(300, None), (301, ""), (302, "T1 t1\x0bT1")]
    want = plain_katz(rows)
    found = scored(spark, rows).collect()
    assert len(found) == len(rows)
    for r in found:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert math.isclose(r.base_score, w[4], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(r.score, w[5], rel_tol=1e-9, abs_tol=1e-9)


def test_katz_on_awkward_tables(spark):
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    assert scored(spark, rows).count() == 16
    assert scored(spark, rows[:0]).count() == 0
    only = [(i, t) for i, t in [(k, f"a b {k}") for k in range(60)] if held_out(i)]
    assert all(r.score == 0 and r.train_tokens == 0 for r in scored(spark, only).collect())


def test_katz_tables_are_normalised(spark, tmp_path):
    rows = [(i, sentence(i % 7, 30) + " " + sentence(i, 5)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", F.lit(False))
    katz.write_model(docs, str(tmp_path / "m"))
    pairs, contexts = spark.read.parquet(str(tmp_path / "m/pairs")), spark.read.parquet(str(tmp_path / "m/contexts"))
    sums = pairs.groupBy("context").agg(F.sum("n").alias("n"), F.sum("kept").alias("kept"), F.sum(F.pow(10.0, "word_log")).alias("p")).join(contexts, "context")
    worst = sums.select(F.max(F.abs(F.col("kept") / F.col("n") + F.pow(10.0, "weight") / F.col("n") * (1 - F.col("p")) - 1))).first()[0]
    assert worst < 1e-9 and pairs.agg(F.sum("n")).first()[0] == sum(len(words(t)) + 1 for _, t in rows)
