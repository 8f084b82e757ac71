"""Streaming forms: availableNow ingest is restartable and processes each file once."""

import os

from bronze_fixture import write_bronze
from starforge import config as C
from starforge.sources.sinks import TableStore
from starforge.streaming.ingest import fact_stream, ingest_stream


def test_ingest_stream_processes_new_files_once(spark, tmpdir_path):
    bronze = os.path.join(tmpdir_path, "bronze")
    lake = os.path.join(tmpdir_path, "lake")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    write_bronze(bronze)
    # start with one entity only
    keep = {"random_export_2026.csv"}
    for dp, _, fs in os.walk(bronze):
        for f in fs:
            rel = os.path.relpath(os.path.join(dp, f), bronze)
            if rel not in keep:
                os.rename(os.path.join(dp, f), os.path.join(tmpdir_path, "held_" + f))
    q = ingest_stream(spark, bronze, lake, ckpt, C.Config.load())
    q.awaitTermination(300)
    store = TableStore(spark, os.path.join(lake, "tables"))
    log = store.read("processing_log")
    assert [r["status"] for r in log.collect()] == ["SUCCESS"]
    # a new file arrives: only it is processed on restart
    os.rename(os.path.join(tmpdir_path, "held_agents_20260601.json"),
              os.path.join(bronze, "support", "agents_20260601.json") if os.path.isdir(os.path.join(bronze, "support"))
              else os.path.join(bronze, "agents_20260601.json"))
    q2 = ingest_stream(spark, bronze, lake, ckpt, C.Config.load())
    q2.awaitTermination(300)
    log = store.read("processing_log")
    print([(r["path"], r["status"], r["reason"]) for r in log.collect()])
    assert log.count() == 2 and log.where("status = 'SUCCESS'").count() == 2


def test_fact_stream_appends_unseen_checksums(spark, tmpdir_path):
    from pyspark.sql import functions as F
    src = os.path.join(tmpdir_path, "silver_orders")
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    rows = [(f"O{i}", float(i), f"chk{i}") for i in range(5)]
    df = spark.createDataFrame(rows, "order_id string, amount double, _row_checksum string")
    df.write.parquet(src, mode="append")
    q = fact_stream(spark, src, df.schema, store, "fact_x_orders", "orders", {}, os.path.join(tmpdir_path, "c1"))
    q.awaitTermination(300)
    assert sorted(r[0] for r in store.read("fact_x_orders").select("fact_id").collect()) == [1, 2, 3, 4, 5]
    more = spark.createDataFrame(rows[3:] + [("O9", 9.0, "chk9")], df.schema)
    more.write.parquet(src, mode="append")
    q = fact_stream(spark, src, df.schema, store, "fact_x_orders", "orders", {}, os.path.join(tmpdir_path, "c1"))
    q.awaitTermination(300)
    got = {r["order_id"]: r["fact_id"] for r in store.read("fact_x_orders").collect()}
    assert len(got) == 6 and got["O9"] == 6
    assert store.read("fact_x_orders").where(F.col("order_id") == "O3").count() == 1
