import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from starforge.llm import suffix_tree as S


def brute(rows, depth):
    """The model of the module's docstring, one token at a time."""
    end = ("end",)
    token = [[*(t or "").encode().lower().split(), end] for _, t in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i, _ in rows]
    count = [Counter() for _ in range(depth + 1)]
    train = [t for t, h in zip(token, held) if not h]
    for t in train:
        for d in range(depth + 1):
            count[d].update(tuple(t[k - d:k + 1]) for k in range(d, len(t)))
    total, vocabulary = sum(count[0].values()), len(count[0])
    nodes = [set() for _ in range(depth + 1)]

    def p(t, k, most, own=False):
        q = (count[0][t[k],] + S.BASE) / (total + S.BASE * (vocabulary + 1))
        for d in range(1, min(most, k) + 1):
            c, out = tuple(t[k - d:k]), int(own and d == most)
            if c in nodes[d] or out:
                q = (max(count[d][(*c, t[k])] - out, 0) + S.MASS * q) / (count[d - 1][c] - out + S.MASS)
        return q

    def passed(c):
        """Contexts in a row, up to this one, that have nearly all occurrences of their suffix."""
        run = 0
        for d in range(2, len(c) + 1):
            run = run + 1 if S.APART * count[d - 1][c[-d:]] > (S.APART - 1) * count[d - 2][c[-d + 1:]] else 0
            if run >= S.PASSED:
                return run
        return run

    for d in range(1, depth + 1):
        gain = defaultdict(float)
        for t in train:
            for k in range(d, len(t)):
                if count[d - 1][tuple(t[k - d:k])] >= S.MIN_CONTEXT and not passed(tuple(t[k - d:k])):
                    gain[tuple(t[k - d:k])] += math.log(p(t, k, d, True) / p(t, k, d - 1))
        nodes[d] = {c for c, g in gain.items() if g >= S.MIN_GAIN}
    return nodes, [(i, h, len(t), sum(count[0][w,] > 0 for w in t), total, sum(math.log10(p(t, k, 0)) for k in range(len(t))),
                    sum(math.log10(p(t, k, depth)) for k in range(len(t)))) for (i, _), h, t in zip(rows, held, token)]


def corpus():
    rng = np.random.default_rng(2)
    line = "it was the best of times it was the worst of times".split()
    rows = []
    for k in range(150):
        words = [f"w{x}" for x in rng.zipf(1.6, rng.integers(0, 60)) if x < 300]
        at = rng.integers(0, len(words) + 1)
        rows.append((k, " ".join(words[:at] + (line if k % 3 == 0 else []) + words[at:])))
    return rows


@pytest.mark.parametrize("block_bytes", [1 << 20, 2_000])       # one block, and many
def test_against_brute_force(spark, docs_of, odd_rows, block_bytes):
    rows = corpus() + odd_rows
    nodes, want = brute(rows, 16)
    assert nodes[1] and nodes[2]
    got = sorted((tuple(r)[:7] for r in S.score(docs_of(rows).repartition(3), block_bytes=block_bytes).collect()), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in sorted(want, key=str)]
    for g, w in zip(got, sorted(want, key=str)):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_held_out_texts_gain(spark, docs_of):
    held = [r for r in S.score(docs_of(corpus())).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_empty_table(spark, docs_of):
    assert S.score(docs_of([(1, "a")]).limit(0)).count() == 0


def test_packed_arrays():
    for a in (np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64)), np.zeros(0, np.uint64)):
        assert (np.cumsum(S.unpack(S.pack(S.steps(a)), np.uint64), dtype=np.uint64) == a).all()


def varied(seed):
    """Text with words in which longer contexts matter, and not only by copies."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(200):
        words = ["a", "b"]
        for _ in range(int(rng.integers(0, 80))):
            certain = rng.random() < 0.85
            words.append("abc"[(len(words) if words[-1] == "a" else ord(words[-2]) + (words[-3:-2] == ["b"])) % 3] if certain else "abc"[rng.integers(3)])
        rows.append((k, " ".join(words)))
    return rows


def test_contexts_of_any_length(spark, docs_of, odd_rows, tmp_path):
    rows = varied(5) + odd_rows
    nodes, want = brute(rows, 16)
    assert any(nodes[3:])
    docs_of(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r)[:7] for r in S.query(spark, str(tmp_path)).collect()), key=str)
    for g, w in zip(got, sorted(want, key=str), strict=True):
        assert g[:5] == w[:5] and g[6] == pytest.approx(w[6], rel=1e-9)


def test_long_passage_ends_soon(spark, docs_of, monkeypatch):
    """A passage of 400 words in 30 texts: the branches that run through it end in a few rounds."""
    rng = np.random.default_rng(3)
    passage = " ".join(f"p{x}" for x in rng.integers(0, 150, 400))
    rows = [(k, " ".join(f"w{x}" for x in rng.integers(0, 40, 30)) + " " + passage + " " + " ".join(f"w{x}" for x in rng.integers(0, 40, 10))) for k in range(30)]
    depths = []
    ask = S.ask
    monkeypatch.setattr(S, "ask", lambda tables, rounds, known, kind, depth, buckets: depths.append(depth) or ask(tables, rounds, known, kind, depth, buckets))
    got = sorted((tuple(r)[:7] for r in S.score(docs_of(rows)).collect()), key=str)
    assert max(depths) <= 10
    for g, w in zip(got, sorted(brute(rows, 16)[1], key=str), strict=True):
        assert g[:5] == w[:5] and g[6] == pytest.approx(w[6], rel=1e-9)


def test_one_round_a_depth(spark, docs_of, odd_rows, monkeypatch):
    """Every depth costs one round, and a round's state is no more than what is still open."""
    asked, sizes = [], {}
    ask, reply = S.ask, S.Tables.reply

    def kept(tables, got):
        out = reply(tables, got)
        sizes[tables.n_rounds] = sum(len(x) for r in tables.last.filter("kind = 'state'").select("state").collect() for x in r["state"])
        return out

    monkeypatch.setattr(S, "ask", lambda tables, rounds, known, kind, depth, buckets: asked.append(depth) or ask(tables, rounds, known, kind, depth, buckets))
    monkeypatch.setattr(S.Tables, "reply", kept)
    S.score(docs_of(varied(5) + odd_rows), block_bytes=1 << 30)
    assert asked == list(range(len(asked))) and len(asked) > 5
    assert sizes[len(sizes)] < max(sizes.values()) / 2
    assert not [r for r in spark.sql("SHOW DATABASES").collect() if r[0].startswith("starforge_")]


def test_numbered_like_a_dictionary():
    for n in (0, 1, 1000):
        keys = np.random.default_rng(n).integers(0, 300, n).astype(np.uint64) << np.uint64(55)
        distinct, number = S.numbered(keys)
        assert distinct.tolist() == sorted(set(keys.tolist())) and (distinct[number] == keys).all()
