import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from starforge.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, digest string, block string, n string, kind string, slot string"


def table(spark, rows):
    """Conversations with columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def brute(rows):
    """The rule on whole sequences, without digests."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), (role or "", text or "")))
    own = {c: [x[1] for x in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(np.fmod(c, 20)), [])[:h] + turns[h:])
    members, children = defaultdict(set), defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
            if d:
                children[turns[:d - 1]].add(turns[:d])

    def below(node):
        yield node
        for k in children[node]:
            yield from below(k)

    out = []
    for node, convs in list(members.items()):
        under = list(below(node))
        words = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) if x else 0
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
                    sum(not children[x] for x in under), sum((len(members[x]) - 1) * words(x) for x in under),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r)[:8] for r in df.collect()), key=str)


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(300), 150):
        kind = rng.random()
        for t in range(rng.randint(1, 6)):
            text = "hello there\tfriend" if t == 0 and kind < 0.4 else f"say {rng.randint(0, 3)} {'é ' * rng.randint(0, 2)}"
            rows.append((c, t, ("user", "assistant")[t % 2], text))
    rows += [(c, t, "user", f"copy {t}") for c in range(1_000, 1_300, 3) for t in range(3)]      # copies, their heads partly absent
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_rows", [T.BLOCK_ROWS, 25])     # one block a task, and many
def test_against_brute_force(spark, block_rows):
    rows = conversations(1)
    assert found(T.trie(table(spark, rows).repartition(3), block_rows)) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "no conversation"), (1, None, "user", "first"), (1, 0, None, None), (1, 1, "user", ""), (2, 0, "user", "word " * 50_000),
            (22, 0, "user", "x"), (-5, 0, "user", "negative"), (-5, 1, "user", "negative"), (40, 0, "a", "b"), (40, 0, "a", "b"), (41, 5, "ab", ""), (43, 5, "a", "b")]
    assert found(T.trie(table(spark, rows))) == brute(rows)


def test_long_conversation(spark):
    rows = [(20, t, "user", f"turn {t % 7}") for t in range(3_000)] + [(c, t, "user", f"turn {t % 7}") for c in (40, 60) for t in range(2_500)]
    got = T.trie(table(spark, rows), 500)
    assert got.count() == 3_001 and got.filter("n_convs = 3").count() == 2_501 and got.agg({"n_leaves": "max"}).first()[0] == 1


def test_empty_table(spark):
    assert T.trie(table(spark, conversations(1)).limit(0)).count() == 0


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**63, (5_000, 2)).astype(np.uint64), axis=0)
    t = T.SlotTable(keys)
    assert sorted(t.slots(keys).tolist()) == list(range(len(keys)))
    assert (t.slots(keys + np.uint64(1)) == -1).all()


def test_query_reads_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(T.query(spark, "/root/testdata/sf0.001")) == brute(rows)
