"""Incremental loads I1-I3 with stable surrogate keys.

Insert-only semantics: a dimension row is new when its natural id is unseen
(attribute changes of known ids are ignored - no SCD); a fact row is new when
its ``_row_checksum`` is unseen. New keys continue at MAX(existing) + 1.
Every function is a lazy transform returning ``(full, appended)``; writing is
the caller's (``sources.sinks``) job, so reruns append nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.operators.clean import first_per_key
from starforge.operators.joins import null_safe_anti_join
from starforge.operators.keys import dense_ids

CHECKSUM = "_row_checksum"


def max_key(existing: DataFrame, key_col: str) -> int:
    """MAX(key) of the existing table, 0 when empty (one scalar to the driver)."""
    v = existing.agg(F.max(key_col)).first()[0]
    return int(v or 0)


def new_rows(existing: DataFrame, batch: DataFrame, key: str, null_safe: bool = False) -> DataFrame:
    """Batch rows whose key does not occur in ``existing``.

    Only the key column of the existing side is read (column pruning).
    """
    if null_safe:
        return null_safe_anti_join(batch, existing.select(key), key)
    return batch.join(existing.select(key).distinct(), key, "left_anti")


def load_dim_date(existing: DataFrame | None, batch: DataFrame, full_reload: bool = False):
    """Append unseen date keys."""
    if full_reload or existing is None:
        return batch, batch
    appended = new_rows(existing, batch, "date_key")
    return existing.unionByName(appended), appended


def load_dimension(existing: DataFrame | None, batch: DataFrame, entity: str, nat: str,
                   full_reload: bool = False):
    """Keys 1..N on first load / full reload, else unseen ids get max+1.."""
    key_col = f"{entity}_key"
    if full_reload or existing is None:
        appended = dense_ids(batch, [nat], key_col, 1)
        return appended, appended
    start = max_key(existing, key_col) + 1
    fresh = new_rows(existing, batch, nat, null_safe=True)
    appended = dense_ids(fresh, [nat], key_col, start).select(*existing.columns)
    return existing.unionByName(appended), appended


def dedup_checksums(batch: DataFrame, on_duplicate: str = "drop", order_cols: list[str] | None = None) -> DataFrame:
    """In-batch duplicate checksums: ``drop`` keeps the first row, ``error`` raises."""
    if on_duplicate == "error":
        dup = batch.groupBy(CHECKSUM).count().where(F.col("count") > 1).limit(1).count()
        if dup:
            raise ValueError("duplicate _row_checksum values in batch")
        return batch
    if on_duplicate != "drop":
        raise ValueError(f"unknown on_duplicate policy {on_duplicate!r}")
    order = order_cols or [c for c in ("_bronze_path", "_src_row") if c in batch.columns] or None
    return first_per_key(batch, [CHECKSUM], order)


def load_fact(existing: DataFrame | None, batch: DataFrame, full_reload: bool = False,
              on_duplicate: str = "drop", order_cols: list[str] | None = None,
              known: DataFrame | None = None, last_id: int | None = None):
    """``fact_id`` 1..N on first load, else rows with unseen checksums get max+1..

    Ids follow ``_row_checksum`` order. Known checksums are taken out first
    (only that column of the stored table is read), then the rest is
    de-duplicated, and only *new* rows are range-partitioned for ids. A caller that keeps an index gives
    the stored checksums that can matter (``known``) and the largest id (``last_id``); the
    stored table is then not read at all.
    """
    if full_reload or existing is None:
        appended = dense_ids(dedup_checksums(batch, on_duplicate, order_cols), [CHECKSUM], "fact_id", 1)
        return appended, appended
    start = (max_key(existing, "fact_id") if last_id is None else last_id) + 1
    fresh = dedup_checksums(new_rows(existing if known is None else known, batch, CHECKSUM), on_duplicate, order_cols)
    appended = dense_ids(fresh, [CHECKSUM], "fact_id", start).select(*existing.columns)
    return existing.unionByName(appended), appended


# -- checksum index -------------------------------------------------------------
BUCKET = "bucket"


def checksum_bucket(checksum) -> Column:
    """One of 256 buckets: the first two hexadecimal digits."""
    return F.substring(checksum, 1, 2)


def index_rows(fact: DataFrame) -> DataFrame:
    """(_row_checksum, fact_id, bucket): what the index of a fact table holds, a folder per bucket."""
    return fact.select(CHECKSUM, "fact_id", checksum_bucket(F.col(CHECKSUM)).alias(BUCKET))


def touched(index: DataFrame, batch: DataFrame) -> DataFrame:
    """The index rows in the buckets of the batch's checksums; no other bucket is read."""
    buckets = [r[0] for r in batch.select(checksum_bucket(F.col(CHECKSUM)).alias(BUCKET)).distinct().collect()]    # 256 at most
    return index.where(F.col(BUCKET).isin(buckets)).select(CHECKSUM)


def reresolve_null_fks(fact_df: DataFrame, dim_df: DataFrame, nat: str, key_col: str) -> DataFrame:
    """Optional repair for late dimensions: fill NULL ``key_col`` where the id now matches."""
    lookup = dim_df.select(F.col(nat).alias("__nat"), F.col(key_col).alias("__k"))
    j = fact_df.join(lookup, fact_df[nat].eqNullSafe(lookup["__nat"]), "left")
    return j.withColumn(key_col, F.coalesce(F.col(key_col), F.col("__k"))).drop("__nat", "__k")
