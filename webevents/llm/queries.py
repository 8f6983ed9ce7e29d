"""The registered queries: one per operator, over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers

from webevents.llm import (
    blob_ledger,
    bpe_two_tier,
    curriculum_mix,
    isolation_rules,
    line_dedup,
    multiprobe,
    quality_cotrain,
    radix_windows,
    repair_grammar,
    simhash_ring,
    toivonen_phrases,
    treap_search,
    warc_zstd,
)
from webevents.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_cotrain(spark, sf_dir):
    return quality_cotrain.op1_quality_cotrain(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_repair_tokens(spark, sf_dir):
    return repair_grammar.op2_repair_tokens(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_isolation_rules(spark, sf_dir):
    return isolation_rules.op3_isolation_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_radix_windows(spark, sf_dir):
    return radix_windows.op4_radix_windows(table(spark, sf_dir, "documents"))


def op5_simhash_ring(spark, sf_dir):
    return simhash_ring.op5_simhash_ring(table(spark, sf_dir, "documents"))


def op6_curriculum_mix(spark, sf_dir):
    return curriculum_mix.op6_curriculum_mix(table(spark, sf_dir, "documents"))


def op7_bpe_two_tier(spark, sf_dir):
    return bpe_two_tier.op7_bpe_two_tier(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op8_line_dedup(spark, sf_dir):
    return line_dedup.op8_line_dedup(table(spark, sf_dir, "documents"))


def op9_multiprobe(spark, sf_dir):
    return multiprobe.op9_multiprobe(table(spark, sf_dir, "embeddings"))


def op10_warc_zstd(spark, sf_dir):
    return warc_zstd.op10_warc_zstd(table(spark, sf_dir, "pages"))


def op11_blob_ledger(spark, sf_dir):
    return blob_ledger.op11_blob_ledger(table(spark, sf_dir, "documents"))


def op12_treap_search(spark, sf_dir):
    return treap_search.op12_treap_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_toivonen_phrases(spark, sf_dir):
    return toivonen_phrases.op13_toivonen_phrases(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_cotrain, op2_repair_tokens, op3_isolation_rules, op4_radix_windows, op5_simhash_ring,
        op6_curriculum_mix, op7_bpe_two_tier, op8_line_dedup, op9_multiprobe, op10_warc_zstd,
        op11_blob_ledger, op12_treap_search, op13_toivonen_phrases,
    )
}

SQL = {
    "op6_curriculum_mix": curriculum_mix.SQL,
    "op8_line_dedup": line_dedup.SQL,
    "op10_warc_zstd": warc_zstd.SQL,
    "op11_blob_ledger": blob_ledger.SQL,
    "op12_treap_search": treap_search.SQL,
    "op13_toivonen_phrases": toivonen_phrases.SQL,
}
