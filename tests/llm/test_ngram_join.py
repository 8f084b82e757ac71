import random
from collections import Counter

import numpy as np
import pytest

from starforge.llm import ngram_join as N
from starforge.llm.components import connected_components


def brute(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 5 * n >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), i), i)
    return Counter((i, low[find(k)], links[k]) for k, (i, _) in enumerate(rows))


def near_copies(seed=1):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rnd.randint(1, 90))]
        for _ in range(rnd.randint(1, 9)):
            copy = list(base)
            for _ in range(rnd.randint(0, 2)):
                copy[rnd.randrange(len(copy))] = word()
            rows.append((rnd.randint(0, 10**6), " ".join(copy)))
    return rows + [(5, "one two"), (6, "ONE\ttwo"), (6, "ONE\ttwo"), (7, None), (8, ""), (9, " ")]


@pytest.mark.parametrize("tile", [800, 3])      # components in one tile, and in several
def test_against_brute_force(spark, docs_of, tile):
    rows = near_copies()
    got = N.near_duplicates(N.keyed(docs_of(rows)), tile=tile).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == brute(rows)


def test_odd_rows(spark, docs_of, odd_rows, tmp_path):
    docs_of(odd_rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = N.query(spark, str(tmp_path)).collect()
    named = [r for r in odd_rows if r[0] is not None]
    assert Counter(tuple(r) for r in got) == brute(named) + Counter({(None, None, 0): 2})
    docs_of(odd_rows[:1]).limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert N.query(spark, f"{tmp_path}/none").count() == 0


def test_stage_keeps_one_of_each_group(spark, docs_of):
    rows = near_copies(2) + [(None, "no id")]
    docs = docs_of(rows)
    kept = N.stage(spark, docs, "")
    assert kept.columns == docs.columns
    classes = {c for _, c, _ in brute(rows[:-1])}
    assert sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect()) == sorted(classes)
    assert kept.filter("doc_id is null").count() == 1


def test_recall_decides_the_prefix():
    assert N.prefix_depth(0.8, 32, 8, 0.9999) == 6
    assert 1 - (1 - 0.8 ** 6) ** 32 >= 0.9999 > 1 - (1 - 0.8 ** 7) ** 32
    assert N.prefix_depth(0.5, 4, 8, 0.9999) == 1


def test_minimum_hashes_estimate_jaccard():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 900).astype(np.uint64)
    sig = N.signatures([np.sort(x[:600]), np.sort(x[300:])], 512)
    assert abs((sig[0] == sig[1]).mean() - 1 / 3) < 0.08


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in linked)
