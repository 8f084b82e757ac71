"""Ingest gate and run logs: S12, I4, S20-S22.

The gate is an ordered ``when`` chain over the catalog joined with the
existing Silver outputs (both file-sized, not row-sized). A file is skipped as
already processed only if the output exists *and* was produced from the same
checksum, so a changed file under an old name is processed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.sources.catalog import READABLE_FORMATS, UNSTRUCTURED_FORMATS


def latest_outputs(existing: DataFrame) -> DataFrame:
    """One row per path: the checksum its last output was made from (by ``written_at``;
    without that column a path's versions can't be told apart, and the greatest counts)."""
    order = "written_at" if "written_at" in existing.columns else "out_checksum"
    return existing.groupBy("path").agg(F.max_by("out_checksum", order).alias("out_checksum"))


def gate(files: DataFrame, existing: DataFrame | None, size_limit: int | None = None) -> DataFrame:
    """Adds ``status`` and ``reason``.

    ``files``: path, format, size_bytes, checksum [, on_disk, decodable, problem, problem_at].
    ``existing``: path, out_checksum [, written_at] of outputs already written; a path may
    have several versions, of which the last counts.
    """
    j = files
    if existing is not None:
        j = j.join(latest_outputs(existing), "path", "left")
    else:
        j = j.withColumn("out_checksum", F.lit(None).cast("string"))
    on_disk = F.col("on_disk") if "on_disk" in files.columns else F.lit(True)
    decodable = F.col("decodable") if "decodable" in files.columns else F.lit(True)
    decode_error = F.lit("decode error")
    if {"problem", "problem_at"} <= set(files.columns):
        decode_error = F.concat_ws(" at byte ", F.concat_ws(": ", decode_error, "problem"), F.col("problem_at").cast("string"))
    unstructured = F.col("format").isin(*UNSTRUCTURED_FORMATS)
    structured = F.col("format").isin(*READABLE_FORMATS)
    done = F.col("out_checksum").isNotNull() & (F.col("out_checksum") == F.col("checksum"))
    too_big = (F.col("size_bytes") > F.lit(size_limit)) if size_limit is not None else F.lit(False)
    steps = [
        (~on_disk, "FAILED", F.lit("file missing on disk")),
        (too_big, "SKIPPED", F.lit("exceeds size limit")),
        (unstructured & done, "SKIPPED", F.lit("already copied (idempotent)")),
        (unstructured, "COPIED", F.lit(None).cast("string")),
        (~structured, "SKIPPED", F.concat(F.lit("unsupported extension "), F.col("format"))),
        (done, "SKIPPED", F.lit("silver output exists (idempotent)")),
        (~decodable, "FAILED", decode_error),
    ]
    status = reason = None
    for cond, st, rs in steps:
        status = F.when(cond, F.lit(st)) if status is None else status.when(cond, F.lit(st))
        reason = F.when(cond, rs) if reason is None else reason.when(cond, rs)
    return j.withColumn("status", status.otherwise(F.lit("SUCCESS"))).withColumn(
        "reason", reason.otherwise(F.lit(None).cast("string")))


def status_summary(results: DataFrame) -> DataFrame:
    """Files per status."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def review_queue(results: DataFrame) -> DataFrame:
    """Files flagged for review or without a domain."""
    flag = F.col("needs_review") if "needs_review" in results.columns else F.lit(False)
    return results.where(F.coalesce(flag, F.lit(False)) | (F.col("domain") == "unknown"))


def file_lineage(results: DataFrame, run_id: str, silver_root: str) -> DataFrame:
    """One lineage row per processed or copied file."""
    silver = F.concat(F.lit(f"{silver_root.rstrip('/')}/domain="), F.col("domain"), F.lit("/entity="), F.col("entity"))
    return results.where(F.col("status").isin("SUCCESS", "COPIED")).select(
        F.lit(run_id).alias("pipeline_run_id"), F.col("path").alias("bronze_path"), silver.alias("silver_path"),
        "domain", "entity", "rows_in", "rows_out", "checksum", F.current_timestamp().alias("processed_at"))


def lineage_log(results: DataFrame, run_id: str) -> DataFrame:
    """S22 summed up: one row per (domain, entity) of processed or copied files."""
    ok = results.where(F.col("status").isin("SUCCESS", "COPIED"))
    success = F.col("status") == "SUCCESS"
    return ok.groupBy("domain", "entity").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(F.when(success, F.col("rows_in"))).cast("bigint").alias("rows_in"),
        F.sum(F.when(success, F.col("rows_out"))).cast("bigint").alias("rows_out"),
    ).select(F.lit(run_id).alias("pipeline_run_id"), "*")
