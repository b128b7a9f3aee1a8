"""The registered queries of this package, and the SQL of those that SQL can state."""

from __future__ import annotations

from tagloom.llm import disclosure, fingerprint, jaccard, katz, mixing, mtree, packing, quality, runs, sharding, token_counts, trie, warc
from tagloom.session import configure


def _configured(function):
    return lambda spark, sf_dir: function(configure(spark), sf_dir)


QUERIES = {
    f.__name__: _configured(f)
    for f in (
        warc.op1_warc_revisits,
        mixing.op2_mix_sources,
        quality.op3_quality_labels,
        fingerprint.op4_order_minhash,
        jaccard.op5_jaccard_join,
        sharding.op6_shard_placement,
        mtree.op7_mtree_topk,
        packing.op8_length_buckets,
        disclosure.op9_disclosure_spans,
        katz.op10_katz,
        runs.op11_periodic_runs,
        trie.op12_prefix_trie,
        token_counts.op13_token_counts,
    )
}

ORACLES = {
    "op1_warc_revisits": warc.OP1_SQL,
    "op2_mix_sources": mixing.OP2_SQL,
    "op6_shard_placement": sharding.oracle(),
    "op7_mtree_topk": mtree.OP7_SQL,
    "op8_length_buckets": packing.oracle(),
    "op12_prefix_trie": trie.OP12_SQL,
}
