import corpus_pipeline
import __spark_entry__ as entry
from starforge.llm import byte_bpe, decontaminate, ngram_join, substring_dedup
from tests.conftest import SF0001


def test_stages_hand_on_what_they_keep(spark):
    """Every stage's input and output, against brute force over the stage's own input."""
    from tests.llm.test_decontaminate import brute as hits
    from tests.llm.test_ngram_join import brute as groups
    from tests.llm.test_substring_dedup import brute as cut

    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = sorted((r["doc_id"], r["text"]) for r in docs.collect())
        docs = spark.createDataFrame(stage(spark, docs, SF0001).toPandas(), None) if name == "byte_bpe" else stage(spark, docs, SF0001)
        rows = docs.collect()
        seen[name] = before, sorted((r["doc_id"], r["text"]) for r in rows) if name != "byte_bpe" else rows
        if name != "byte_bpe":
            assert docs.columns == columns
            docs = corpus_pipeline.materialize(docs, name)
    before, after = seen["language_id"]
    assert set(after) <= set(before) and len(after) >= 0.99 * len(before)
    before, after = seen["ngram_join"]
    assert [i for i, _ in after] == sorted({c for _, c, _ in groups(before)}) and set(after) <= set(before)
    before, after = seen["substring_dedup"]
    want = {i: k for i, _, d, k in cut(before, substring_dedup.WINDOW) if k or not d}
    assert {i: b" ".join(t.encode().split()) for i, t in after} == want
    before, after = seen["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    bad = {i for i, n, h, _ in hits(before, items, decontaminate.WINDOW) if h and 20 * h >= n}
    assert after == [r for r in before if r[0] not in bad]
    before, after = seen["byte_bpe"]
    assert sorted(r["doc_id"] for r in after) == [i for i, _ in before] and all(r["round_trip"] for r in after)


def test_run_and_registration(spark):
    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_join", "substring_dedup", "decontamination", "byte_bpe"]
    out = entry.queries()["pipeline"](spark, SF0001)
    assert {"doc_id", "token_ids"} <= set(out.columns) and out.count() > 100
    assert ngram_join.SHINGLE == 5 and byte_bpe.MATRIX_MAX >= 64
