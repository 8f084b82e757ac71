import numpy as np

from starforge.llm import hamming as H


def brute(rows, k, every):
    good = [(i, tuple(x is not None and x >= 0 for x in v)) for i, v in rows if i is not None and v]
    out = set()
    for q, c in good:
        if q % every == 0:
            near = sorted((sum(a != b for a, b in zip(c, d)), i) for i, d in good if len(d) == len(c))[:k]
            out |= {(q, n + 1, i, d) for n, (d, i) in enumerate(near)}
    return out


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=24)]) for i in range(400)]
    rows += [(1000 + i, [1.0] * 24) for i in range(300)]                    # one very common code
    rows += [(None, [1.0] * 24), (2000, None), (2010, []), (2020, [1.0, None, -1.0]), (2030, [1.0] * 3)]
    df = spark.createDataFrame([(i, v, "c") for i, v in rows], "vec_id long, embedding array<double>, code string")
    index = H.binary_codes(df, "vec_id", "embedding")
    for shard_rows, block in ((10**6, 10**6), (150, 7)):
        got = H.top_k(index, index.filter("id % 10 = 0"), 7, shard_rows, block).collect()
        assert {tuple(r) for r in got} == brute(rows, 7, 10) and len(got) == len({tuple(r) for r in got})


def test_fewer_rows_than_asked_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, -1.0]), (0, [1.0, -1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    index = H.binary_codes(df, "vec_id", "embedding")
    assert sorted(map(tuple, H.top_k(index, index.filter("id = 0")).collect())) == [(0, 1, 0, 0), (0, 2, 0, 0), (0, 3, 1, 1)]
    assert H.top_k(index.limit(0), index.limit(0)).count() == 0


def test_radius_covers_the_distance():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 256, (3000, 8), dtype=np.uint8)
    index = H.MultiIndex(np.arange(3000), codes, 64)
    for q in rng.integers(0, 256, (20, 8), dtype=np.uint8):
        place, distance = index.search(q, 10)
        every = np.bitwise_count(codes ^ q).sum(axis=1)
        want = np.lexsort((np.arange(3000), every))[:10]
        assert place.tolist() == want.tolist() and distance.tolist() == every[want].tolist()
