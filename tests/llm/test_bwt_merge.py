import hashlib
import random

import numpy as np
import pytest

from starforge.llm import bwt_merge as B


def brute(rows, window=B.WINDOW):
    """The rule, window by window."""
    text = [(t or "").encode() for _, t in rows]
    least = {}
    for (doc, _), t in zip(rows, text):
        if doc is not None:
            for k in range(len(t) - window + 1):
                w = t[k:k + window]
                least[w] = min(doc, least.get(w, doc))
    out = []
    for (doc, _), t in zip(rows, text):
        gone, seen = np.zeros(len(t), bool), set()
        for k in range(len(t) - window + 1 if doc is not None else 0):
            w = t[k:k + window]
            if least[w] < doc or w in seen:
                gone[k:k + window] = True
            seen.add(w)
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(t) else 0
        out.append((doc, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def texts(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    say = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [say(60), say(25), "All rights reserved. " * 6]
    rows = []
    for k in range(n):
        kind = rng.random()
        if rows and kind < 0.2:
            t = rng.choice(rows)[1]                                 # a copy
        elif rows and kind < 0.4:
            t = rng.choice(rows)[1].split(" ")                      # a near copy
            for _ in range(3):
                t[rng.randrange(len(t))] = rng.choice(words)
            t = " ".join(t)
        else:
            t = say(rng.randint(0, 120))
            for p in passages:
                if rng.random() < 0.4:
                    at = rng.randint(0, len(t))
                    t = t[:at] + p + t[at:]
        rows.append((rng.randrange(10_000), t))
    return rows


@pytest.mark.parametrize("options", [{}, {"block_bytes": 3_000}, {"block_bytes": 3_000, "hot_bytes": 900}, {"hot_bytes": 0}, {"unit_bytes": 300}])
def test_against_brute_force(spark, docs_of, options):
    rows = texts(1)
    assert found(B.removed(docs_of(rows).repartition(3), **options)) == brute(rows)


@pytest.mark.parametrize("options", [{}, {"hot_bytes": 500, "block_bytes": 20_000}])
def test_odd_rows(spark, docs_of, odd_rows, options):
    rows = odd_rows + [(20, "ab" * 700), (21, "ba" * 700), (22, "x" * 99), (23, "x" * 100), (24, "x" * 101), (25, "\0" * 150), (26, "\0" * 130)]
    rows += [(30, "same id, two rows, " * 9), (30, "same id, two rows, " * 9), (30, "x same id, two rows, " * 9)]
    assert found(B.removed(docs_of(rows), **options)) == brute(rows)


def test_empty_table(spark, docs_of):
    assert B.removed(docs_of([(1, "a")]).limit(0)).count() == 0


def test_long_runs_and_pieces(spark, docs_of, monkeypatch):
    monkeypatch.setattr(B, "PIECE", 1_000)
    monkeypatch.setattr(B, "LONGEST_RUN", 64)
    rows = texts(2, 25) + [(5, "z" * 3_000), (6, "long " * 1_500), (7, "y" + "long " * 900)]
    assert len(list(B.runs_of([t.encode() for _, t in rows], 100, 24))) > 10
    assert found(B.removed(docs_of(rows))) == brute(rows)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_merge_orders_all_windows(shards):
    """After the last round the interleave lists the windows in one order, equal ones together."""
    rng = random.Random(4)
    base = bytes(rng.choice(b"ab") for _ in range(400))
    strings = [base[a:a + n] for a, n in ((0, 200), (50, 220), (10, 130), (200, 100), (0, 200), (201, 120), (90, 99))]
    strings += [bytes(rng.choice(b"abc") for _ in range(140)) for _ in range(4)]
    string, offset, group = B.merged(strings, np.arange(len(strings)) % shards, 100)
    windows = [strings[s][o:o + 100] for s, o in zip(string.tolist(), offset.tolist())]
    assert sorted(zip(string.tolist(), offset.tolist())) == [(s, o) for s, t in enumerate(strings) for o in range(len(t) - 99)]
    assert windows == sorted(windows)
    assert [a == b for a, b in zip(windows, windows[1:])] == (np.diff(group) == 0).tolist()


def test_suffix_order():
    rng = random.Random(6)
    strings = [bytes(rng.choice(b"\1\2") for _ in range(rng.randint(1, 60))) for _ in range(20)] * 2
    data = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8)
    begin = np.cumsum([0] + [len(s) + 1 for s in strings])[:-1]
    owner = np.searchsorted(begin, np.arange(len(data)), side="right") - 1
    want = sorted(range(len(data)), key=lambda p: (strings[owner[p]][p - begin[owner[p]]:], owner[p]))
    assert B.suffix_order(data, begin).tolist() == want


def test_query_reads_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert found(B.query(spark, "/root/testdata/sf0.001")) == brute(rows)


def test_equal_hot_strings_of_a_block_are_hashed_once(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from starforge.llm import bwt_merge as M
    text = bytes(np.random.default_rng(1).integers(97, 123, 3_000, dtype=np.uint8)).decode()
    table = pa.table({"block": pa.array([0] * 50, pa.int64()), "pos": pa.array(range(50), pa.int32()), "doc_id": pa.array(range(50), pa.int64()), "text": [text] * 50})
    keys = M.BlockRuns(table, M.WINDOW, M.MINIMISER).keys
    answers = pa.table({"bucket": pa.array([0], pa.int32()), "state": pa.array([M.pack(np.full(len(keys), 2, np.uint8))], pa.binary())})
    hashed, plain = [], M.hot_windows
    monkeypatch.setattr(M, "hot_windows", lambda block, which: (hashed.append(int(block.size[which].sum())), plain(block, which))[1])
    rows = M.packed_strings(4, 4, M.WINDOW, M.MINIMISER)(table, answers).to_pylist()
    assert hashed[0] < 10 * len(text)
    gone = np.concatenate([M.unpack(r["pos"], np.int64) for r in rows if r["kind"] == M.LOCAL])
    assert sorted(set(gone.tolist())) == list(range(1, 50))
    sent = [r for r in rows if r["kind"] == M.HOT]
    assert sum(len(M.unpack(r["ids"], np.int64)) for r in sent) <= len(text) - M.WINDOW + 1
