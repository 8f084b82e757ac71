"""Streams over the same batch code.

* ``ingest_stream`` (I4): a file-source stream over the Bronze root. The
  stream checkpoint remembers which files were processed, replacing the
  "output exists" test; each micro-batch runs the Bronze -> Silver job on
  just its files. ``trigger(availableNow=True)`` processes what is there
  and stops, which makes it a restartable, exactly-once batch ingest.
* ``fact_stream`` (I3): a Parquet stream over one Silver entity; each
  micro-batch resolves keys and appends rows with unseen checksums.
  ``dropDuplicatesWithinWatermark`` would not be equivalent: the de-dup is
  against all history, so it is an anti-join with the stored fact table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starforge import config as C
from starforge.operators import incremental, star
from starforge.plans.pipeline import bronze_to_silver
from starforge.sources import catalog as CAT
from starforge.sources.sinks import TableStore


BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_stream(spark: SparkSession, bronze_root: str, lake_root: str, checkpoint: str,
                  cfg: C.Config | None = None, run_id: str = "stream", max_files_per_trigger: int = 1000,
                  available_now: bool = True) -> StreamingQuery:
    cfg = cfg or C.Config.load()
    store = TableStore(spark, f"{lake_root.rstrip('/')}/tables")
    silver_root = f"{lake_root.rstrip('/')}/silver"
    root = bronze_root.rstrip("/")
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max_files_per_trigger).load(root)
             .select("path", "length", "modificationTime"))   # content pruned: the batch job reads what it needs

    def per_batch(batch: DataFrame, epoch: int) -> None:
        new = batch.select(CAT.relative(F.col("path"), root).alias("path"), F.col("path").alias("uri"),
                           F.col("length").alias("size_bytes"), F.col("modificationTime").alias("mtime")).checkpoint(eager=True)
        if not new.isEmpty():       # only these files are listed, hashed and read
            bronze_to_silver(spark, root, silver_root, store, cfg, f"{run_id}-{epoch}", new_files=new)

    w = files.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def fact_stream(spark: SparkSession, silver_entity_path: str, schema, store: TableStore, fact_name: str,
                entity: str, dims: dict[str, tuple[DataFrame, str]], checkpoint: str,
                available_now: bool = True) -> StreamingQuery:
    """Append new fact rows of one Silver entity as they arrive."""
    src = spark.readStream.schema(schema).parquet(silver_entity_path)

    def per_batch(batch: DataFrame, epoch: int) -> None:
        f = star.fact(batch, entity, dims)
        existing = store.read(fact_name)
        _, appended = incremental.load_fact(existing, f)
        if existing is None:
            store.replace(fact_name, appended)
        else:
            store.append(fact_name, appended)

    w = src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
