"""Queries of this package for ``__spark_entry__``: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import corpus_pipeline
from starforge.llm import bwt_merge, byte_bpe, decontaminate, hamming, language_id, ngram_join, prefix_trie, sharding, spelling, substring_dedup, suffix_tree, toxicity, warc

QUERIES = {
    "op1_suffix_tree": suffix_tree.query,
    "op2_warc": warc.query,
    "op3_hamming_topk": hamming.query,
    "op4_decontaminate": decontaminate.query,
    "op5_sharding": sharding.query,
    "op6_ngram_join": ngram_join.query,
    "op7_substring_dedup": substring_dedup.query,
    "op8_toxicity": toxicity.query,
    "op9_byte_bpe": byte_bpe.query,
    "op10_language_id": language_id.query,
    "op11_bwt_merge": bwt_merge.query,
    "op12_spelling": spelling.query,
    "op13_prefix_trie": prefix_trie.query,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op3_hamming_topk": hamming.ORACLE_SQL,
    "op4_decontaminate": decontaminate.ORACLE_SQL,
}
