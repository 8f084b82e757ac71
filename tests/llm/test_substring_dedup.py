import hashlib
import random

import pytest

from starforge.llm import substring_dedup as S


def brute(rows, window):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            if i is not None:
                first[g] = min(first.get(g, i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        drop = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                drop[k:k + window] = [True] * window
        out.append((i, len(w), sum(drop), b" ".join(x for x, d in zip(w, drop) if not d)))
    return out


def passages(n=60, seed=5):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("a b c d e f g h The of é".split()) + rnd.choice("012")
    shared = [[word() for _ in range(rnd.randint(5, 40))] for _ in range(6)]
    rows = []
    for k in range(n):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            parts += rnd.choice(shared) if rnd.random() < 0.5 else [word() for _ in range(rnd.randint(0, 20))]
        rows.append((k, " ".join(parts)))
    return rows + [(None, " ".join(shared[0])), (3, rows[5][1]), (3, rows[5][1]), (90, None), (91, "")]


@pytest.mark.parametrize("hot", [2_000, 2])     # buckets only; very frequent minimisers spread singly
def test_against_brute_force(spark, docs_of, hot):
    rows = passages()
    got = [tuple(r) for r in S.removed(docs_of(rows), window=8, minimiser=3, hot_runs=hot).collect()]
    want = [(i, n, d, hashlib.sha256(k).hexdigest()) for i, n, d, k in brute(rows, 8)]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(d for _, _, d, _ in got) > 100


def test_odd_rows(spark, docs_of, odd_rows, tmp_path):
    docs_of(odd_rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in S.query(spark, str(tmp_path)).collect()}
    assert got == {(i, n, d) for i, n, d, _ in brute(odd_rows, S.WINDOW)}
    docs_of(odd_rows[:1]).limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert S.query(spark, f"{tmp_path}/none").count() == 0


def test_stage_cuts_and_drops(spark, docs_of):
    shared = " ".join(f"s{k}" for k in range(60))
    docs = docs_of([(1, f"first\t{shared} end"), (2, f"other \n{shared}\n  tail"), (3, shared), (4, "short"), (None, shared), (5, None)])
    kept = S.stage(spark, docs, "")
    assert kept.columns == docs.columns
    rows = {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.collect()}
    assert rows == {1: (f"first\t{shared} end", 10 + len(shared)), 2: ("other \ntail", 11), 4: ("short", 5), None: (shared, len(shared)), 5: (None, None)}


def test_short_slices_at_the_production_window():
    for total in range(2 * S.WINDOW):
        words = b" ".join(b"w%d" % k for k in range(total))
        for texts in ([words], [words[:len(words) // 2], None, words[len(words) // 2:]]):
            runs = S.Runs(texts, S.WINDOW, S.MINIMISER)
            assert runs.windows.sum() == sum(max(0, len((t or b"").split()) - S.WINDOW + 1) for t in texts)
        a = S.run_hash(S.word_hashes(words.split()), S.MINIMISER, 1)
        width = S.WINDOW - S.MINIMISER + 1
        assert S.sliding_min(a, width).tolist() == [a[k:k + width].min() for k in range(len(a) - width + 1)]


def test_lone_short_documents(spark, docs_of):
    rows = [(n, " ".join(f"w{k}" for k in range(n))) for n in (13, 20, 33, 46)]
    got = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in S.removed(docs_of(rows).repartition(4, "doc_id")).collect()}
    assert got == {(n, n, 0) for n, _ in rows}
