"""Data-quality profile Q1-Q5."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, cols: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """Q1: column, rows, nulls, null_pct = round(100 * nulls / rows, 2) - one aggregate.

    ``by`` (e.g. ``_bronze_path``) profiles each source separately in the
    same pass; lineage columns are profiled too, as in the reference.
    """
    by = by or []
    cols = cols if cols is not None else [c for c in df.columns if c not in by]
    g = df.groupBy(*by) if by else df
    wide = g.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"), F.col(f"__n{i}").alias("nulls"))
               for i, c in enumerate(cols)]
    return (wide.select(*by, F.col("__rows").alias("rows"), F.explode(F.array(*structs)).alias("s"))
            .select(*by, "s.column", "s.position", "rows", "s.nulls",
                    F.round(F.when(F.col("rows") > 0, F.col("s.nulls") * 100.0 / F.col("rows"))
                            , 2).alias("null_pct")))


def completeness(profile: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Q2: round(100 - mean(null_pct), 2)."""
    g = profile.groupBy(*(by or []))
    return g.agg(F.round(100 - F.avg("null_pct"), 2).alias("completeness"))


def sample_values(df: DataFrame, order_cols: list[str], n: int = 3, cols: list[str] | None = None) -> DataFrame:
    """Q3: first ``n`` non-NULL values per column in source order, as text.

    No per-column window (a column's values would meet in one task): rank r
    is the minimum (order, value) above rank r-1, an algebraic aggregate that
    is reduced map-side. ``n`` passes, each shuffling k rows per task.
    """
    cols = cols if cols is not None else [c for c in df.columns if c not in order_cols]
    order = F.struct(*[F.col(f"`{c}`") for c in order_cols])
    long = df.select(order.alias("__o"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols
    ])).alias("__s")).select("__o", "__s.column", "__s.value").where(F.col("value").isNotNull())
    found = None
    ranks = []
    for r in range(1, n + 1):
        cand = long
        if found is not None:
            cand = (long.join(F.broadcast(found.select("column", F.col("__o").alias("__prev"))), "column")
                    .where(F.col("__o") > F.col("__prev")).drop("__prev"))
        best = cand.groupBy("column").agg(F.min(F.struct("__o", "value")).alias("__m"))
        found = best.select("column", F.col("__m.__o").alias("__o"), F.col("__m.value").alias("value"))
        ranks.append(found.select("column", F.lit(r).alias("rank"), "value"))
    out = ranks[0]
    for x in ranks[1:]:
        out = out.unionByName(x)
    return out


def drift(prev_cols: DataFrame, cur_cols: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Columns added or removed against the previous load (``column``).

    ``keys`` (e.g. domain, entity) compares many entities at once; only
    entities present on both sides are compared.
    """
    keys = keys or []
    p = prev_cols.select(*keys, "column").distinct().withColumn("__p", F.lit(True))
    c = cur_cols.select(*keys, "column").distinct().withColumn("__c", F.lit(True))
    if keys:
        both = p.select(*keys).distinct().join(c.select(*keys).distinct(), keys)
        p = p.join(both, keys, "left_semi")
        c = c.join(both, keys, "left_semi")
    j = p.join(c, keys + ["column"], "full_outer")
    return (j.where(F.col("__p").isNull() | F.col("__c").isNull())
            .select(*keys, "column",
                    F.when(F.col("__p").isNull(), F.lit("added")).otherwise(F.lit("removed")).alias("change")))
