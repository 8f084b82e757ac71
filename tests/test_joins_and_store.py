"""NULL-safe joins, versioned table store."""

import os

from pyspark.sql import functions as F

from starforge.operators.joins import null_safe_anti_join, null_safe_left_join
from starforge.sources.sinks import TableStore, check_unique


def test_null_matches_null(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, key int")
    got = {r["id"]: r["key"] for r in null_safe_left_join(left, right, "k").collect()}
    assert got == {1: 10, 2: 20, 3: None}
    anti = [r["id"] for r in null_safe_anti_join(left, right, "k").collect()]
    assert anti == [3]


def test_table_store_versions(spark, tmpdir_path):
    store = TableStore(spark, os.path.join(tmpdir_path, "t"))
    assert store.read("x") is None
    store.replace("x", spark.range(3))
    store.append("x", spark.range(3, 5))
    assert store.read("x").count() == 5
    p2 = store.replace("x", store.read("x").where(F.col("id") > 2))   # read-then-write: new version
    assert p2.endswith("v=2") and store.read("x").count() == 2
    assert store.names() == ["x"]
    import pytest
    with pytest.raises(ValueError):
        check_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])


def test_two_writers_keep_both_their_rows(spark, tmpdir_path):
    """The second writer commits while the first computes; the first computes again from its version."""
    from starforge.sources.sinks import Conflict, TableStore
    store, other = TableStore(spark, tmpdir_path), TableStore(spark, tmpdir_path)
    rows = lambda *names: spark.createDataFrame([(n,) for n in names], "name string")
    store.replace("memory", rows("old"))
    tries = []

    def slow(last):
        tries.append(last.count())
        if len(tries) == 1:
            other.update("memory", lambda now: now.unionByName(rows("from the other")))
        return last.unionByName(rows("from the first"))

    store.update("memory", slow)
    assert tries == [1, 2] and store.version("memory") == 3
    assert sorted(r[0] for r in store.read("memory").collect()) == ["from the first", "from the other", "old"]
    assert store.read("memory", 2).count() == 2          # no version is overwritten
    try:
        store.replace("memory", rows("late"), based_on=1)
        raise AssertionError("the conflict was not noticed")
    except Conflict:
        assert store.read("memory").count() == 3


def test_versions_that_were_never_committed_are_not_read(spark, tmpdir_path):
    from starforge.sources.sinks import TableStore
    store = TableStore(spark, tmpdir_path)
    assert store.read("t") is None and not store.exists("t") and store.version("t") == 0
    spark.range(5).write.parquet(f"{tmpdir_path}/t/lost/v=1")
    assert store.read("t") is None
    store.append("t", spark.range(2))
    store.append("t", spark.range(2, 3))
    assert store.read("t").count() == 3 and store.version("t") == 1
