"""From raw documents to token ids: five stages, each written as Parquet and read again.

1. language ID: texts without a letter, or that no language explains, go;
2. n-gram Jaccard join: one document of each near-duplicate group stays;
3. substring dedup: passages that a document with a smaller id also has are cut out;
4. benchmark decontamination: contaminated documents go;
5. byte-level BPE: doc_id, n_tokens, token_ids and round_trip of what is left.

A stage sees all that its predecessor kept. The stages train and iterate, so SQL can't
express them; tests/llm compares them with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starforge.llm import byte_bpe, decontaminate, language_id, ngram_join, substring_dedup
from starforge.llm.common import materialize, read_table

STAGES = [
    ("language_id", language_id.stage),
    ("ngram_join", ngram_join.stage),
    ("substring_dedup", substring_dedup.stage),
    ("decontamination", decontaminate.stage),
    ("byte_bpe", byte_bpe.stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
