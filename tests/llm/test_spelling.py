import random
import re
import zlib
from collections import Counter

import pytest

from starforge.llm import spelling as S


def near(a, b):
    """Whether one inserted, deleted or replaced code point turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(a == b[:k] + b[k + 1:] for k in range(len(b)))


def brute(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda x: x[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    beside = {w: [x for x in n if x != w and near(w, x)] for w in n}
    form = {}
    for w, around in beside.items():
        best = min(around, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(beside[w]), n[form[w]] if form[w] else None) for w in n)


def texts(seed, size=120):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "aaaaaaa", "aaabaaa"]
    rows = []
    for k in range(size):
        words = []
        for _ in range(rng.randint(0, 90)):
            w = rng.choice(base)
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + "x" + w[at:], w[:at] + rng.choice("abc") + w[at + 1:]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((k, rng.choice([" ", ", ", "-"]).join(words)))
    return rows


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("tile", [S.TILE, 7])       # packed buckets, and chunks of large keys
def test_against_brute_force(spark, docs_of, tile):
    rows = texts(1)
    got = found(S.variants(docs_of(rows).repartition(3), tile))
    assert got == brute(rows)
    assert any(f for _, f, *_ in got) and any(f and r != f for _, f, r, *_ in got)


def test_odd_rows(spark, docs_of, odd_rows):
    rows = odd_rows + [(k, "ÀÉÎõü Àéîõü wörld wôrld world worlds") for k in range(20)] + [(50 + k, "b" * (5_000 - k % 2)) for k in range(6)]
    assert found(S.variants(docs_of(rows))) == brute(rows)


def test_empty_table(spark, docs_of):
    assert S.variants(docs_of([(1, "a")]).limit(0)).count() == 0


def test_chain_of_forms(spark, docs_of):
    """Each word one letter from the next, each twice as frequent."""
    chain = ["aaaaaaaa"[:8 - k] + "bbbbbbbb"[:k] for k in range(8)]
    rows = [(k, " ".join([w] * (3 * 2 ** k))) for k, w in enumerate(chain)]
    got = {r["word"]: r["root"] for r in S.variants(docs_of(rows)).collect()}
    assert got == {w: r for w, _, r, *_ in brute(rows)} and got[chain[0]] == chain[-1]


def test_every_near_pair_once():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(5, 8))) for _ in range(250)})
    want = {(a, b) for a in words for b in words if a < b and near(a, b)}
    got = []
    for m in range(5, 9):
        for at_end in (False, True):
            keys: dict = {}
            for w in words:
                if len(w) in (m, m + 1):
                    keys.setdefault(w[len(w) - (m - m // 2):] if at_end else w[:m // 2], []).append(w)
            for group in keys.values():
                short, long = ([w for w in group if len(w) == s] for s in (m, m + 1))
                got += [tuple(sorted(p)) for p in S.near_in((short, short), (long, long), m, at_end, True)]
    assert len(got) == len(set(got)) and set(got) == want


def test_query_reads_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert found(S.query(spark, "/root/testdata/sf0.001")) == brute(rows)
