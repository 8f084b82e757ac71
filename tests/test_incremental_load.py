"""Incremental loads with stable keys (I1-I3, W1-W3), also on tables far above one task's rows."""

import os

import pytest
from pyspark.sql import functions as F

from starforge.operators import incremental

SF01 = "/root/testdata/sf0.1"


def _ports(spark, codes):
    return spark.createDataFrame([(c, f"port of {c}") for c in codes], "port_id string, label string")


def _calls(spark, rows):
    return spark.createDataFrame([(c, float(len(c)), f"sum:{c}") for c in rows], "call_id string, tons double, _row_checksum string")


def _column(df, name):
    return sorted(r[0] for r in df.select(name).collect())


def test_first_load_numbers_in_order_of_the_id(spark):
    full, appended = incremental.load_dimension(None, _ports(spark, ["RTM", "ANR", "HAM", "LEH"]), "port", "port_id")
    assert {r["port_id"]: r["port_key"] for r in full.collect()} == {"ANR": 1, "HAM": 2, "LEH": 3, "RTM": 4}
    assert appended.count() == 4


def test_known_ids_keep_their_keys_and_attributes(spark):
    old, _ = incremental.load_dimension(None, _ports(spark, ["RTM", "HAM"]), "port", "port_id")
    batch = _ports(spark, ["ANR", "HAM", None, "RTM"]).withColumn("label", F.upper("label"))
    full, appended = incremental.load_dimension(old, batch, "port", "port_id")
    assert {r["port_id"]: r["port_key"] for r in appended.collect()} == {None: 3, "ANR": 4}
    assert {r["port_id"]: r["label"] for r in full.collect()}["HAM"] == "port of HAM"
    again, none = incremental.load_dimension(full, batch, "port", "port_id")
    assert none.count() == 0 and _column(again, "port_key") == [1, 2, 3, 4]


def test_full_reload_starts_again(spark):
    old, _ = incremental.load_dimension(None, _ports(spark, ["RTM", "HAM", "ANR"]), "port", "port_id")
    full, _ = incremental.load_dimension(old, _ports(spark, ["OSL", "RTM"]), "port", "port_id", full_reload=True)
    assert {r["port_id"]: r["port_key"] for r in full.collect()} == {"OSL": 1, "RTM": 2}


def test_facts_append_only_what_is_new(spark):
    old, _ = incremental.load_fact(None, _calls(spark, ["b", "a", "b"]))
    assert _column(old, "fact_id") == [1, 2]
    full, appended = incremental.load_fact(old, _calls(spark, ["c", "a", "c", "dd"]))
    assert {r["call_id"]: r["fact_id"] for r in appended.collect()} == {"c": 3, "dd": 4}
    assert _column(full, "fact_id") == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        incremental.load_fact(None, _calls(spark, ["x", "x"]), on_duplicate="error")


@pytest.mark.parametrize("attempt", [1, 2])
def test_keys_are_dense_and_distinct_on_a_large_table(spark, tmpdir_path, attempt):
    """Load and increment of 600,000 lines, written and read again."""
    li = spark.read.parquet(f"{SF01}/lineitem.parquet") \
        .select("l_orderkey", "l_linenumber", F.concat_ws("-", "l_orderkey", "l_linenumber", F.monotonically_increasing_id()).alias("_row_checksum"))
    li.write.parquet(os.path.join(tmpdir_path, "lines"))
    li = spark.read.parquet(os.path.join(tmpdir_path, "lines"))
    n, head = li.count(), li.where(F.col("l_orderkey") % 3 == 0)
    _, appended = incremental.load_fact(None, head)
    path = os.path.join(tmpdir_path, "fact")
    appended.write.parquet(path)
    _, more = incremental.load_fact(spark.read.parquet(path), li)
    more.write.mode("append").parquet(path)
    got = spark.read.parquet(path).agg(F.count("*"), F.countDistinct("fact_id"), F.min("fact_id"), F.max("fact_id"),
                                       F.countDistinct("_row_checksum")).first()
    assert tuple(got) == (n, n, 1, n, n)
    ids = li.select(F.col("_row_checksum").alias("line_id"))
    _, dim = incremental.load_dimension(None, ids, "line", "line_id")
    dim.write.parquet(os.path.join(tmpdir_path, "dim"))
    got = spark.read.parquet(os.path.join(tmpdir_path, "dim")).agg(F.countDistinct("line_key"), F.max("line_key")).first()
    assert tuple(got) == (n, n)


def test_increment_sorts_no_whole_rows_of_known_facts(spark, tmpdir_path):
    """Known checksums leave before rows are grouped."""
    path = os.path.join(tmpdir_path, "f")
    old, _ = incremental.load_fact(None, _calls(spark, ["a", "b"]))
    old.write.parquet(path)
    fresh = incremental.new_rows(spark.read.parquet(path), _calls(spark, ["a", "c"]), incremental.CHECKSUM)
    plan = incremental.dedup_checksums(fresh)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftAnti")
