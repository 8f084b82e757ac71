import hashlib
import random

from starforge.llm import decontaminate as D


def brute(rows, items, window):
    grams = {}
    for name, text in items:
        w = D.words_of(text.encode()) if text else []
        n = min(window, len(w))
        for k in range(len(w) - n + 1) if n else ():
            grams.setdefault(tuple(w[k:k + n]), set()).add("" if name is None else str(name))
    out = []
    for i, text in rows:
        w = D.words_of(text.encode()) if text else []
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def scanned(spark, docs, items, window, block_words=1000):
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_hit string")
    got = D.scan_documents(docs, bench, window, block_words=block_words).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=str)


def test_random_against_brute_force(spark, docs_of):
    rnd = random.Random(3)
    text = lambda n: " ".join(rnd.choice("a b C d,e é f0".split()) for _ in range(n))
    items = [(k, text(rnd.randint(0, 9))) for k in range(12)] + [(3, text(4)), (None, text(6)), (50, None), (51, "!!")]
    rows = [(k, text(rnd.randint(0, 60))) for k in range(60)]
    for window in (3, 5):
        for block in (1000, 10):        # one automaton, and several
            assert scanned(spark, docs_of(rows), items, window, block) == sorted(brute(rows, items, window), key=str)


def test_odd_rows_and_no_items(spark, docs_of, odd_rows):
    items = [(1, "quick brown fox"), (2, odd_rows[7][1][:4000])]
    assert scanned(spark, docs_of(odd_rows), items, 13, 10**6) == sorted(brute(odd_rows, items, 13), key=str)
    assert all(n == 0 for _, _, n, _ in scanned(spark, docs_of(odd_rows), [], 13))
    assert scanned(spark, docs_of(odd_rows).limit(0), items, 13) == []


def test_spans_are_cut_out(spark, docs_of):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    cut = D.excise(D.scan_documents(docs_of([(1, "Zero, One two\nTHREE four; five"), (2, "one two"), (3, None)]), bench, 3), 3)
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {1: "Zero, ; five", 2: "one two", 3: None}


def test_stage_drops_only_contaminated(spark, docs_of, tmp_path):
    item = " ".join(f"q{k}" for k in range(15))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, item), (2, "x " * 40 + item), (3, "x " * 400 + item), (4, "clean"), (5, None), (None, item)]
    docs = docs_of(rows)
    kept = D.stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5]


def test_digest_of_items():
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
