import os
import random

import pytest
from pyspark.sql import functions as F

from starforge.operators import drill, pages

ORDER = ["k", "id"]


def test_pages_equal_those_of_the_whole_table(spark, tmpdir_path):
    df = spark.range(20_000).select(F.when(F.col("id") % 50 > 0, F.col("id") * 7919 % 1_000).alias("k"), "id", (F.col("id") * 3).alias("v"))
    path = os.path.join(tmpdir_path, "sorted table")
    pages.write(df, ORDER, path, 1_000)
    files = pages.directory(spark, path, ORDER).cache()
    assert files.count() >= 15 and files.agg(F.sum("rows")).first()[0] == 20_000
    rng = random.Random(1)
    for offset, limit in [(0, 10), (19_990, 100), (20_000, 5), (10_000, 1), *((rng.randrange(20_000), rng.randint(1, 900)) for _ in range(4))]:
        got = pages.page(spark, files, ORDER, limit, offset)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in drill.page(df, ORDER, limit, offset).collect()]
        assert got.schema.names == ["k", "id", "v", "total_rows"]


def test_a_deep_page_opens_two_files(spark, tmpdir_path):
    df = spark.range(3_000_000).withColumnRenamed("id", "k")
    pages.write(df, ["k"], tmpdir_path + "/t", 100_000)
    files = pages.directory(spark, tmpdir_path + "/t", ["k"]).cache()
    got = pages.page(spark, files, ["k"], 5_000, 2_000_000)
    assert len(got.inputFiles()) <= 2
    assert [r["k"] for r in got.collect()] == list(range(2_000_000, 2_005_000))


def test_limits_and_empty_tables(spark, tmpdir_path):
    pages.write(spark.range(0), ["id"], tmpdir_path + "/e")
    files = pages.directory(spark, tmpdir_path + "/e", ["id"])
    for bad in ((0, 0), (5_001, 0), (1, -1)):
        with pytest.raises(ValueError):
            pages.page(spark, files, ["id"], *bad)
    with pytest.raises(ValueError):
        pages.page(spark, files, ["id"])


def test_files_of_the_deep_page_do_not_grow_with_the_table(spark, tmpdir_path, monkeypatch):
    from starforge.plans import registry
    n = 6_000
    spark.range(n).select((F.col("id") * 7919 % n).alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("id").alias("l_partkey"),
                          F.lit(2).alias("l_suppkey"), (F.col("id") / 4).alias("l_extendedprice")).write.parquet(tmpdir_path + "/lineitem.parquet")
    sizes, plain = [], pages.write
    monkeypatch.setattr(pages, "ROWS_PER_FILE", 200)
    monkeypatch.setattr(pages, "write", lambda df, order, path, rows: (sizes.append(rows), plain(df, order, path, rows)))
    got = [(r["l_orderkey"], r["total_rows"]) for r in registry.q_page_deep(spark, tmpdir_path).collect()]
    assert got == [(k, n) for k in range(3_000, 3_500)] and sizes == [200]


def test_the_directory_sorts_no_rows(spark, tmpdir_path):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("k"), F.col("id").cast("string").alias("s"))
    pages.write(df, ["k", "s"], tmpdir_path + "/t", 500)
    files = pages.directory(spark, tmpdir_path + "/t", ["k", "s"])
    assert "SortAggregate" not in files._jdf.queryExecution().executedPlan().toString()
    rows = files.orderBy("before").collect()
    assert [r["before"] for r in rows] == [sum(q["rows"] for q in rows[:i]) for i in range(len(rows))] and sum(r["rows"] for r in rows) == 5_000
