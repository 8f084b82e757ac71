"""Dense keys at scale-like size, cube invariants, drill, validation."""

from pyspark.sql import functions as F

from starforge.operators import cube, drill, validate
from starforge.operators.keys import dense_ids

SF001 = "/root/testdata/sf0.01"


def test_dense_ids_are_dense_and_ordered(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    cols = li.columns
    ids = dense_ids(li, cols, "fact_id", start=11, num_partitions=7)
    agg = ids.agg(F.min("fact_id"), F.max("fact_id"), F.countDistinct("fact_id"), F.count(F.lit(1))).first()
    assert tuple(agg) == (11, 60010, 60000, 60000)
    # order: the id follows the ordering columns
    first = ids.orderBy("fact_id").first()
    smallest = li.orderBy(*cols).first()
    assert [first[c] for c in cols] == [smallest[c] for c in cols]


def _fact(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("order_id"), (F.col("o_custkey") % 50).alias("cust_key"),
                    F.when(F.col("o_orderkey") % 9 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("amount"),
                    F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("order_date_key"),
                    F.lit("f.csv").alias("_bronze_path"), F.lit("h").alias("_file_checksum"))


def test_lattice_levels_sum_to_apex(spark):
    f = _fact(spark)
    lat = cube.lattice(f, ["cust_key"], "order_date_key", ["amount"]).cache()
    sums = {r["cuboid"]: (r["s"], r["c"]) for r in
            lat.groupBy("cuboid").agg(F.sum("amount_sum").alias("s"), F.sum("amount_count").alias("c")).collect()}
    apex_s, apex_c = sums["apex"]
    for name, (s, c) in sums.items():
        assert abs(s - apex_s) < 1e-6 * abs(apex_s) and c == apex_c, name
    # lattice cuboid == stand-alone cuboid
    a = cube.cuboid(lat, "by_cust_key", ["cust_key"]).orderBy("cust_key").collect()
    b = cube.by_dim(f, "cust_key", ["amount"]).orderBy("cust_key").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_record_count_fallback(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "role string")
    assert cube.measures(df) == []
    got = {r["role"]: r["_record_count_count"] for r in cube.by_dim(df, "role").collect()}
    assert got == {"a": 2, "b": 1}


def test_all_null_group_sum_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "k string, x double")
    got = {r["k"]: (r["x_sum"], r["x_count"], r["x_mean"]) for r in cube.by_dim(df, "k", ["x"]).collect()}
    assert got["a"] == (0.0, 0, None)


def test_drill_counts_match_cuboid(spark):
    f = _fact(spark)
    bm = cube.by_month(f, "order_date_key", ["amount"]).where("year = 1996 and month = 3").first()
    rows = drill.rows(f, {"year": 1996, "month": 3}, date_role="order_date_key")
    assert rows.where(F.col("amount").isNotNull()).count() == bm["amount_count"]
    import pytest
    with pytest.raises(KeyError):
        drill.rows(f, {"no_such_col": 1})


def test_validation(spark):
    f = _fact(spark)
    ap = cube.apex(f, ["amount"])
    assert all(r["ok"] for r in validate.apex_check(f, ap, ["amount"]).collect())
    bad = ap.withColumn("count", F.col("count") + 1)
    assert not any(r["ok"] for r in validate.apex_check(f, bad, ["amount"]).collect())
    man = spark.createDataFrame([("fact_a", "fact", None, 3), ("cuboid_fact_a_by_month", "cuboid", "fact_a", 0)],
                                "name string, kind string, fact string, rows long")
    findings = sorted(r[0] for r in validate.manifest_findings(man).collect())
    assert findings == ["cuboid_fact_a_by_month is empty", "missing apex cuboid for fact_a"]


def test_dense_ids_paths_agree(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet").select("o_orderkey", "o_custkey")
    a = dense_ids(o, ["o_custkey", "o_orderkey"], "k", start=5)
    b = dense_ids(o, ["o_custkey", "o_orderkey"], "k", start=5)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())


def test_empty_fact_apex_and_late_dimension(spark):
    from starforge.operators import incremental
    empty = spark.createDataFrame([], "order_id string, amount double, customer_key long")
    apex = cube.lattice(empty, [], None, ["amount"]).collect()
    assert [(r["cuboid"], r["amount_sum"], r["amount_count"]) for r in apex] == [("apex", 0.0, 0)]
    fact = spark.createDataFrame([("O1", "C1", None), ("O2", "C9", None), ("O3", "C2", 2)],
                                 "order_id string, customer_id string, customer_key long")
    dim = spark.createDataFrame([("C1", 1), ("C2", 2), ("C9", 9)], "customer_id string, customer_key long")
    fixed = {r["order_id"]: r["customer_key"] for r in
             incremental.reresolve_null_fks(fact, dim, "customer_id", "customer_key").collect()}
    assert fixed == {"O1": 1, "O2": 9, "O3": 2}


def test_drill_and_cube_use_one_date_key(spark):
    """A key made from a datetime column whatever its name; dimension keys are never dates."""
    import datetime as dt
    from starforge.operators import cube, drill, star
    df = spark.createDataFrame([(dt.datetime(2020, 1, 5), 7, 1.0), (dt.datetime(2021, 3, 9), 8, 2.0)],
                               "created_at timestamp, port_key int, tons double")
    fact = star.with_date_keys(df)
    assert cube.date_key_columns(fact, []) == cube.date_key_columns(fact) == ["created_at_key"]
    assert [r["tons"] for r in drill.rows(fact, {"year": 2021, "month": 3}).collect()] == [2.0]


def _three_dims(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    k = F.col("o_orderkey")
    return o.select(F.when(k % 11 > 0, k % 7).alias("a_key"), F.when(k % 13 > 0, k % 3).alias("b_key"), (k % 40).alias("c_key"),
                    F.when(k % 9 > 0, F.col("o_totalprice").cast("decimal(12,2)")).alias("price"), (k % 5 == 0).alias("flag"),
                    F.when(k % 17 > 0, F.date_format("o_orderdate", "yyyyMMdd").cast("int")).alias("day_key"))


def test_lattice_from_smallest_parents_equals_each_cuboid(spark):
    f, dims, ms = _three_dims(spark), ["a_key", "b_key", "c_key"], ["price", "flag"]
    for date_key in ("day_key", None):
        lat = cube.lattice_by_parents(f, dims, date_key, ms, {"a_key": 7, "b_key": 3, "c_key": 40}).cache()
        assert sorted(r[0] for r in lat.select("cuboid").distinct().collect()) == sorted(n for n, _ in cube.lattice_sets(dims, date_key is not None))
        df, _ = cube._prepared(cube.with_month(f, date_key) if date_key else f, ms)
        for name, keys in cube.lattice_sets(dims, date_key is not None):
            want = df.groupBy(*keys).agg(*cube.measure_aggs(ms)).select(*keys, *[f"{m}_{x}" for m in ms for x in ("sum", "count", "mean")])
            got = lat.where(F.col("cuboid") == name).select(*want.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name


def test_lattice_expands_the_fact_once_per_dimension(spark):
    f = _three_dims(spark)
    plan = cube.lattice_by_parents(f, ["a_key", "b_key", "c_key"], "day_key", ["price"], {"a_key": 7, "b_key": 3, "c_key": 40})
    rows = plan._jdf.queryExecution().optimizedPlan().toString()
    expands = [line for line in rows.splitlines() if "Expand" in line]
    assert expands and all(line.count("[price") - 1 == 3 for line in expands)     # three sets (and the output), not eight
    assert cube.smallest_key(f, ["a_key", "b_key", "c_key"], None) == "b_key"


def test_every_cuboid_is_validated(spark):
    f, dims, ms = _three_dims(spark), ["a_key", "b_key"], ["price", "flag"]
    lat = cube.lattice_by_parents(f, dims, "day_key", ms).cache()
    bad = lambda x: sorted({r["cuboid"] for r in validate.lattice_check(f, x, dims, "day_key", ms).where("not ok").collect()})
    assert bad(lat) == []
    for name, _ in cube.lattice_sets(dims, True):
        here = F.col("cuboid") == name
        one = lat.where(here).select(F.max("price_sum")).first()[0]
        assert bad(lat.withColumn("price_sum", F.when(here & (F.col("price_sum") == one), F.col("price_sum") * 1.01).otherwise(F.col("price_sum")))) == [name]
        assert bad(lat.where(~(here & (F.col("price_sum") == one)))) == [name]                               # a group is missing
    moved = lat.withColumn("a_key", F.when((F.col("cuboid") == "by_a_key") & F.col("a_key").isNull(), 99).otherwise(F.col("a_key")))
    assert bad(moved) == ["by_a_key"]


def test_lattice_shuffles_the_finest_groups_once(spark, tmpdir_path):
    from starforge.operators import cube
    path = tmpdir_path + "/fact"
    spark.range(5_000).select((F.col("id") % 40).alias("a_key"), F.when(F.col("id") % 7 > 0, F.col("id") % 90).alias("b_key"),
                              (F.lit(20260101) + F.col("id") % 12 * 100).cast("int").alias("d_key"), (F.col("id") % 13).alias("v")).write.parquet(path)
    fact = spark.read.parquet(path)
    got = cube.lattice_by_parents(fact, ["a_key", "b_key"], "d_key", ["v"])
    rows = got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan
    want = cube.lattice(fact, ["a_key", "b_key"], "d_key", ["v"]).select(got.columns).collect()
    assert sorted(map(str, rows)) == sorted(map(str, want))


def test_lattice_query_has_the_orders_of_the_line_items(spark, tmpdir_path):
    import datetime as dt
    from collections import defaultdict

    from starforge.plans.registry import QUERIES
    day = lambda m: dt.datetime(2026, m, 5)
    lines = [(10, 1, 4, 1, 2.0, day(1)), (10, 2, 4, 2, 3.0, day(1)), (10, 1, 5, 3, 4.0, day(2)), (7, 2, 5, 1, 5.0, day(2)),
             (None, 1, 4, 1, 6.0, day(1)), (99, 1, 4, 1, 7.0, None), (30, None, 8, 2, 8.0, day(3))]
    spark.createDataFrame([(o, p, s, n, q, q * 10, 0.5, None, "N", "O", t) for o, p, s, n, q, t in lines],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                          "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(tmpdir_path + "/lineitem.parquet")
    orders = [(30, 1), (10, 1), (10, 1), (7, 2), (None, 2)]       # 10 twice; keys by id, NULL first: None 1, 7 2, 10 3, 30 4; 99 is no order
    spark.createDataFrame([(o, c, "O", 1.0, day(1), "1-URGENT") for o, c in orders],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(tmpdir_path + "/orders.parquet")
    spark.createDataFrame([(1, "a"), (2, "b")], "p_partkey long, p_name string").write.parquet(tmpdir_path + "/part.parquet")
    spark.createDataFrame([(4, "a"), (5, "b")], "s_suppkey long, s_name string").write.parquet(tmpdir_path + "/supplier.parquet")
    keys = {"orders_key": (0, {None: 1, 7: 2, 10: 3, 30: 4}), "part_key": (1, {1: 1, 2: 2}), "supplier_key": (2, {4: 1, 5: 2})}
    want = defaultdict(list)
    for x in lines:
        month = (x[5].year, x[5].month) if x[5] else (None, None)
        want[("apex", None, None, None, None, None)].append(x[4])
        want[("by_month", *month, None, None, None)].append(x[4])
        for k, (at, ids) in keys.items():
            own = [ids.get(x[at]) if name == k else None for name in sorted(keys)]
            want[(f"by_{k}", None, None, *own)].append(x[4])
            want[(f"by_month_{k}", *month, *own)].append(x[4])
    got = QUERIES["cuboid_lattice"](spark, tmpdir_path).collect()
    assert {(r["cuboid"], r["year"], r["month"], *[r[k] for k in sorted(keys)]): (r["l_quantity_sum"], r["l_quantity_count"], r["l_tax_count"]) for r in got} \
        == {k: (sum(v), len(v), 0) for k, v in want.items()} and len(got) == len(want)
