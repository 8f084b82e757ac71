"""Lineage projection P7-P9."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.functions.hashing import row_checksum

LINEAGE_COLUMNS = ["_bronze_path", "_domain", "_entity", "_format", "_file_checksum",
                   "_processed_at", "_pipeline_run_id", "_row_checksum", "_needs_review"]


def add_lineage(df: DataFrame, catalog: DataFrame, run_id: str, processed_at: str | Column | None = None,
                needs_review: Column | None = None) -> DataFrame:
    """Adds the nine lineage columns.

    ``df`` carries ``_bronze_path``; ``catalog`` (path, domain, entity, format,
    checksum) has a row per file.
    ``_processed_at`` stays ISO text; ``_row_checksum`` hashes the business
    columns only, so equal rows from different files share it.
    """
    business = [c for c in df.columns if not c.startswith("_")]
    chk = row_checksum(df, business)
    cat = catalog.select(F.col("path").alias("_bronze_path"), F.col("domain").alias("_domain"),
                         F.col("entity").alias("_entity"), F.col("format").alias("_format"),
                         F.col("checksum").alias("_file_checksum"))
    if processed_at is None:
        processed_at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    elif isinstance(processed_at, str):
        processed_at = F.lit(processed_at)
    review = needs_review if needs_review is not None else F.lit(False)
    out = (df.withColumn("_row_checksum", chk).join(cat, "_bronze_path", "left")
           .withColumn("_processed_at", processed_at)
           .withColumn("_pipeline_run_id", F.lit(run_id))
           .withColumn("_needs_review", (F.col("_domain") == "unknown") | review))
    return out.select(*business, *LINEAGE_COLUMNS,
                      *[c for c in df.columns if c.startswith("_") and c not in LINEAGE_COLUMNS])


def file_needs_review(mapping: DataFrame) -> DataFrame:
    """Per (domain, entity) whether any column was resolved by range/fallback."""
    return mapping.groupBy("domain", "entity").agg(F.bool_or("needs_review").alias("needs_review"))
