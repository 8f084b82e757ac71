"""End to end on dirty Bronze files: readers, Silver, Gold, cuboids, validation, rerun."""

import os

from pyspark.sql import functions as F

from bronze_fixture import write_bronze
from starforge import config as C
from starforge.plans import pipeline
from starforge.sources import readers
from starforge.sources.sinks import TableStore


def test_readers(spark, tmpdir_path):
    write_bronze(tmpdir_path)
    x = readers.read_xlsx(spark, [os.path.join(tmpdir_path, "retail/orders_20260603.xlsx")], tmpdir_path)
    assert x.count() == 15
    assert x.columns[:5] == ["Order No", "Cust Id", "Order Dt", "Order Total", "Order Status"]
    c = readers.read_csv(spark, [os.path.join(tmpdir_path, "retail/customers_20260601.csv")], tmpdir_path)
    assert c.count() == 11 and "  Full Name " in c.columns
    assert c.select("_bronze_path").distinct().first()[0] == "retail/customers_20260601.csv"
    j = readers.read_json(spark, [os.path.join(tmpdir_path, "education/students_20260602.json")], tmpdir_path)
    assert j.columns[:5] == ["roll_no", "name", "date of birth", "dept", "email address"]
    xm = readers.read_xml(spark, [os.path.join(tmpdir_path, "education/grades_20260604.xml")], tmpdir_path)
    assert xm.count() == 10 and "course_code" in xm.columns


def test_pipeline_end_to_end_and_rerun(spark, tmpdir_path):
    bronze = os.path.join(tmpdir_path, "bronze")
    lake = os.path.join(tmpdir_path, "lake")
    write_bronze(bronze)
    out = pipeline.run(spark, bronze, lake, C.Config.load(), run_id="r1")
    status = {r["status"]: r["n"] for r in out["status"].collect()}
    assert status == {"SUCCESS": 8, "COPIED": 1}
    store = TableStore(spark, os.path.join(lake, "tables"))
    names = store.names()
    for dim in ("dim_customers", "dim_students", "dim_agents", "dim_date"):
        assert dim in names, names
    for fact in ("fact_retail_orders", "fact_retail_feedback", "fact_education_grades", "fact_support_tickets",
                 "fact_unknown_random_export"):
        assert fact in names, names
    assert out["findings"].count() == 0
    orders = store.read("fact_retail_orders")
    assert orders.count() == 15
    assert "customers_key" in orders.columns and "order_date_key" in orders.columns
    assert orders.where(F.col("customers_key").isNotNull()).count() > 0
    cust = store.read("dim_customers")
    assert cust.count() == 10 and sorted(r[0] for r in cust.select("customers_key").collect()) == list(range(1, 11))
    tickets = store.read("fact_support_tickets")
    assert tickets.count() == 8            # blank and duplicate rows removed
    memory = store.read("mapping_memory")
    assert memory.where(F.col("approved")).count() > 0
    # rerun: files already processed are skipped, nothing is appended
    out2 = pipeline.run(spark, bronze, lake, C.Config.load(), run_id="r2")
    assert {r["status"] for r in out2["status"].collect()} == {"SKIPPED"}
    assert store.read("fact_retail_orders").count() == 15


def test_quality_profile_and_drift(spark, tmpdir_path):
    bronze = os.path.join(tmpdir_path, "bronze")
    lake = os.path.join(tmpdir_path, "lake")
    os.makedirs(os.path.join(bronze, "shop"))
    with open(os.path.join(bronze, "shop", "items_20260101.csv"), "w") as fh:
        fh.write("item id,price,note\nI1,1.5,\nI2,,x\nI2,,x\n")
    pipeline.run(spark, bronze, lake, C.Config.load(), run_id="a")
    store = TableStore(spark, os.path.join(lake, "tables"))
    summ = store.read("profile_summary").first()
    assert (summ["row_count"], summ["duplicates_removed"]) == (2, 1)
    cols = {r["column"]: (r["null_pct"], r["type_label"]) for r in store.read("profile_columns").collect()}
    assert cols["price"] == (50.0, "numeric")
    assert store.read("schema_drift") is None or store.read("schema_drift").count() == 0
    with open(os.path.join(bronze, "shop", "items_20260201.csv"), "w") as fh:
        fh.write("item id,price,colour\nI3,2.0,red\n")
    pipeline.run(spark, bronze, lake, C.Config.load(), run_id="b")
    drift = {(r["column"], r["change"]) for r in store.read("schema_drift").collect()}
    assert ("colour", "added") in drift and ("note", "removed") in drift


def test_json_lines_and_nested(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "x", "events_2026.json")
    os.makedirs(os.path.dirname(p))
    with open(p, "w") as fh:
        fh.write('{"id": 1, "props": {"k": 2, "tags": ["a"]}}\n{"id": 2, "props": {"k": 3, "tags": []}}\n')
    df = readers.read_json(spark, [p], tmpdir_path)
    rows = sorted((r["id"], r["props_k"], r["props_tags"]) for r in df.collect())
    assert rows == [("1", "2", '["a"]'), ("2", "3", "[]")]
