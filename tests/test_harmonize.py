"""Harmonisation H1-H9 and name normalisation P1."""

from pyspark.sql import functions as F

from starforge import config as C
from starforge.functions.names import dedupe_names, normalize_name
from starforge.operators import harmonize


def test_normalize_name():
    assert normalize_name("  Sign Up Date ") == "sign_up_date"
    assert normalize_name("How satisfied are you (1-5)?") == "how_satisfied_are_you_1_5"
    assert normalize_name("---") == "unnamed"
    assert dedupe_names(["a", "a", "b", "a"]) == ["a", "a_dup2", "b", "a_dup3"]


def _resolve(spark, cols, memory=None, domain="retail", entity="orders"):
    cat = spark.createDataFrame([(domain, entity, c, i) for i, c in enumerate(cols)],
                                "domain string, entity string, raw_column string, position int")
    r = harmonize.resolve(cat, C.Config.load(), memory)
    return {x["raw_column"]: (x["final_column"], x["method"], x["needs_review"]) for x in r.collect()}


def test_resolution_order(spark):
    got = _resolve(spark, ["Order No", "Cust Id", "Order Dt", "Order Total", "Order Status", "update_amount",
                           "Customer Phone", "promo_code"])
    assert got["Order No"] == ("order_id", "alias", False)
    assert got["Cust Id"] == ("customer_id", "alias", False)
    assert got["Order Dt"] == ("order_date", "alias", False)
    assert got["Order Total"] == ("amount", "alias", False)
    assert got["Order Status"] == ("status", "alias", False)
    # 'update_amount' contains 'date', a rule without target: the search ends, no rename
    assert got["update_amount"] == ("update_amount", "fallback", True)
    assert got["Customer Phone"] == ("phone_number", "heuristic_name", False)
    assert got["promo_code"] == ("promo_code", "fallback", True)


def test_null_rule_stops_search(spark):
    got = _resolve(spark, ["due_date_amount"])
    # 'date' comes first and maps to nothing: no rename, fallback
    assert got["due_date_amount"] == ("due_date_amount", "fallback", True)


def test_memory_wins_when_approved(spark):
    mem = spark.createDataFrame(
        [("retail", "orders", "order_no", "order_ref", "alias", True, None, None),
         ("retail", "orders", "order_status", "st", "fallback", False, None, None)], C.MEMORY_SCHEMA)
    got = _resolve(spark, ["Order No", "Order Status"], mem)
    assert got["Order No"] == ("order_ref", "memory", False)
    assert got["Order Status"] == ("status", "alias", False)


def test_collision_suffix(spark):
    got = _resolve(spark, ["email", "Email Address", "contact email"], domain="retail", entity="customers")
    finals = sorted(v[0] for v in got.values())
    assert finals == ["email", "email_dup2", "email_dup3"]


def test_range_guess(spark):
    df = spark.createDataFrame([(float(i % 5 + 1), float(i % 11), "x") for i in range(40)],
                               "col_1 double, unnamed_2 double, col_3 string")
    out, mapping = harmonize.harmonize(df, "unknown", "export", C.Config.load())
    m = {r["raw_column"]: (r["final_column"], r["method"]) for r in mapping.collect()}
    assert m["col_1"] == ("rating", "heuristic_range")
    assert m["unnamed_2"] == ("score", "heuristic_range")
    assert m["col_3"] == ("col_3", "fallback")
    assert "rating" in out.columns


def test_upsert_memory(spark):
    mem = spark.createDataFrame(
        [("retail", "orders", "order_no", "order_id", "alias", True, None, None)], C.MEMORY_SCHEMA)
    cat = spark.createDataFrame([("retail", "orders", "Order No", 0), ("retail", "orders", "Order Status", 1),
                                 ("retail", "orders", "promo", 2)],
                                "domain string, entity string, raw_column string, position int")
    r = harmonize.resolve(cat, C.Config.load(), mem)
    up = {x["raw_column"]: x for x in harmonize.upsert_memory(mem, r).collect()}
    assert up["order_no"]["method"] == "alias" and up["order_no"]["last_seen"] is None   # memory hit: untouched
    assert up["order_status"]["approved"] is True
    assert up["promo"]["approved"] is False
    pend = harmonize.pending_review(harmonize.upsert_memory(mem, r)).collect()
    assert [(p["entity"], p["pending"]) for p in pend] == [("orders", 1)]
