"""Catalog rules S2, S4, S5, S6 and the ingest gate S12."""

import datetime as dt

from pyspark.sql import functions as F

from starforge.operators.ingest import gate
from starforge.sources import catalog as CAT


def _rows(spark, paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def test_domain_entity(spark):
    df = CAT.with_domain_entity(_rows(spark, [
        "retail/customers_20260601.csv", "random_export_2026.csv", "education/sub/grades_2026_06.xml",
        "x/abc2026.csv", "x/t_123456789.csv", "x/2026.csv", "x/orders_20260601123045.csv"]))
    got = {r["path"]: (r["domain"], r["entity"], r["format"]) for r in df.collect()}
    assert got["retail/customers_20260601.csv"] == ("retail", "customers", ".csv")
    assert got["random_export_2026.csv"] == ("unknown", "random_export", ".csv")
    assert got["x/abc2026.csv"][1] == "abc2026"
    assert got["x/t_123456789.csv"][1] == "t_123456789"
    assert got["x/2026.csv"][1] == "unknown"
    assert got["x/orders_20260601123045.csv"][1] == "orders"   # upload stamp stripped


def test_source_date(spark):
    df = CAT.with_source_date(_rows(spark, ["a/x_20260601.csv", "a/x_2026.csv", "a/x.csv", "a/x_20260601_v2.csv"]))
    got = {r["path"]: (r["year"], r["month"]) for r in df.collect()}
    assert got == {"a/x_20260601.csv": ("2026", "06"), "a/x_2026.csv": ("2026", "00"),
                   "a/x.csv": ("unknown", "00"), "a/x_20260601_v2.csv": ("2026", "06")}


def test_duplicates_and_merge(spark):
    t = dt.datetime(2026, 1, 1)
    listing = spark.createDataFrame([("b.csv", "h1"), ("a.csv", "h1"), ("c.csv", "h2")], "path string, checksum string")
    prev = spark.createDataFrame([("b.csv", t)], "path string, first_seen timestamp")
    merged = CAT.merge(listing, prev, F.lit(dt.datetime(2026, 2, 1)))
    dup = {r["path"]: r["duplicate_of"] for r in CAT.first_of_checksum(merged).collect()}
    assert dup == {"b.csv": None, "a.csv": "b.csv", "c.csv": None}    # earliest first_seen wins


def test_gate_order(spark):
    files = spark.createDataFrame([
        ("m.csv", ".csv", 1, "h", False), ("big.csv", ".csv", 999, "h", True), ("img.png", ".png", 1, "h", True),
        ("old.png", ".png", 1, "h", True), ("x.bin", ".bin", 1, "h", True), ("done.csv", ".csv", 1, "h", True),
        ("changed.csv", ".csv", 1, "h2", True), ("new.csv", ".csv", 1, "h", True)],
        "path string, format string, size_bytes long, checksum string, on_disk boolean")
    existing = spark.createDataFrame([("old.png", "h"), ("done.csv", "h"), ("changed.csv", "h1")],
                                     "path string, out_checksum string")
    got = {r["path"]: r["status"] for r in gate(files, existing, size_limit=100).collect()}
    assert got == {"m.csv": "FAILED", "big.csv": "SKIPPED", "img.png": "COPIED", "old.png": "SKIPPED",
                   "x.bin": "SKIPPED", "done.csv": "SKIPPED", "changed.csv": "SUCCESS", "new.csv": "SUCCESS"}
