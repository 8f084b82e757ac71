"""Column harmonisation H1-H9 as joins over a column-catalog DataFrame.

A column catalog has one row per (domain, entity, raw_column) with its
``position`` and, for the numeric-range guess, value statistics. All entities
resolve in one job: memory, alias and rule candidates are joined (config
tables are schema-sized and broadcast), then ``coalesce`` picks the first hit
in the resolution order memory -> alias -> name rule -> range -> fallback.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starforge import config as C
from starforge.functions.names import normalize_name, normalize_name_col
from starforge.operators.infer import NUMBER_PATTERN

KEY = ["domain", "entity", "raw_norm"]


def range_stats(df: DataFrame, cols: list[str], cfg: C.Config) -> DataFrame:
    """Per column: rows, numeric count and count within each range rule (one pass)."""
    parsed = df.select(*[F.when(F.trim(F.col(f"`{c}`").cast("string")).rlike(NUMBER_PATTERN),
                                F.trim(F.col(f"`{c}`").cast("string")).try_cast("double")).alias(f"__v{i}")
                         for i, c in enumerate(cols)])
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        v = F.col(f"__v{i}")
        aggs.append(F.count(v).alias(f"__{i}_num"))
        for j, (lo, hi, _) in enumerate(cfg.range_rules):
            aggs.append(F.count_if(v.between(lo, hi)).alias(f"__{i}_r{j}"))
    wide = parsed.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("raw_column"), F.col(f"__{i}_num").alias("num_values"),
                        F.array(*[F.col(f"__{i}_r{j}") for j in range(len(cfg.range_rules))]).alias("in_range"))
               for i, c in enumerate(cols)]
    return (wide.select(F.col("__rows").alias("n_rows"), F.explode(F.array(*structs)).alias("s"))
            .select("s.raw_column", "n_rows", "s.num_values", "s.in_range"))


def name_rule_expr(raw_norm: Column, cfg: C.Config) -> Column:
    """First rule whose key is contained decides; a NULL target means 'no hit'."""
    expr = None
    for contains, maps_to in cfg.name_rules:
        cond = F.instr(raw_norm, contains) > 0
        val = F.lit(maps_to) if maps_to is not None else F.lit(None).cast("string")
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr if expr is not None else F.lit(None).cast("string")


def range_rule_expr(cfg: C.Config) -> Column:
    """Numeric-range guess for unhelpful names; needs >= max(3, 50 %) numeric values."""
    eligible = (F.col("raw_norm").rlike(C.UNNAMED_COLUMN_PATTERN)
                & F.col("num_values").isNotNull()
                & (F.col("num_values") >= F.greatest(F.lit(3.0), F.col("n_rows") * 0.5)))
    expr = None
    for j, (_, _, maps_to) in enumerate(cfg.range_rules):
        cond = eligible & (F.col("in_range")[j] / F.col("num_values") > 0.9)
        expr = F.when(cond, F.lit(maps_to)) if expr is None else expr.when(cond, F.lit(maps_to))
    return expr if expr is not None else F.lit(None).cast("string")


def resolve(columns: DataFrame, cfg: C.Config, memory: DataFrame | None = None,
            spark: SparkSession | None = None) -> DataFrame:
    """H1, H3-H7, H9.

    ``columns``: domain, entity, raw_column, position [, n_rows, num_values, in_range].
    Returns domain, entity, raw_column, position, raw_norm, mapped, method,
    needs_review, final_column.
    """
    spark = spark or columns.sparkSession
    cols = columns.where(~F.col("raw_column").startswith("_"))   # H9: system columns pass through
    if "num_values" not in cols.columns:
        cols = (cols.withColumn("n_rows", F.lit(None).cast("bigint"))
                .withColumn("num_values", F.lit(None).cast("bigint"))
                .withColumn("in_range", F.lit(None).cast("array<bigint>")))
    cols = cols.withColumn("raw_norm", normalize_name_col(F.col("raw_column")))

    mem = memory if memory is not None else C.empty_memory(spark)
    mem_hit = (mem.where(F.col("approved"))
               .select(F.col("domain"), F.col("entity"), F.col("raw_column").alias("raw_norm"),
                       F.col("mapped_column").alias("mem_mapped"))
               .dropDuplicates(KEY))
    alias_hit = (cfg.alias_df(spark)
                 .groupBy("domain", "entity", F.col("alias_norm").alias("raw_norm"))
                 .agg(F.min_by("canonical", "canon_order").alias("alias_mapped")))

    # config and memory are keyed by column name: size bounded by schemas, not data
    j = (cols.join(F.broadcast(mem_hit), KEY, "left")
         .join(F.broadcast(alias_hit), KEY, "left")
         .withColumn("name_mapped", name_rule_expr(F.col("raw_norm"), cfg))
         .withColumn("range_mapped", range_rule_expr(cfg)))

    method = (F.when(F.col("mem_mapped").isNotNull(), F.lit("memory"))
              .when(F.col("alias_mapped").isNotNull(), F.lit("alias"))
              .when(F.col("name_mapped").isNotNull(), F.lit("heuristic_name"))
              .when(F.col("range_mapped").isNotNull(), F.lit("heuristic_range"))
              .otherwise(F.lit("fallback")))
    mapped = F.coalesce("mem_mapped", "alias_mapped", "name_mapped", "range_mapped", "raw_norm")
    out = (j.withColumn("mapped", mapped).withColumn("method", method)
           .withColumn("needs_review", F.col("method").isin(*C.NEEDS_REVIEW_METHODS)))
    return with_dup_suffix(out)


def with_dup_suffix(mapping: DataFrame) -> DataFrame:
    """H7: 2nd, 3rd ... column with the same target gets ``_dup2``, ``_dup3``."""
    w = Window.partitionBy("domain", "entity", "mapped").orderBy("position")
    rn = F.row_number().over(w)
    return (mapping.withColumn("_rn", rn)
            .withColumn("final_column", F.when(F.col("_rn") == 1, F.col("mapped"))
                        .otherwise(F.concat(F.col("mapped"), F.lit("_dup"), F.col("_rn").cast("string"))))
            .drop("_rn"))


def apply(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P10: rename to canonical names (``mapping`` raw -> final)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k != v and k in df.columns})


def upsert_memory(memory: DataFrame, resolved: DataFrame, now: Column | None = None) -> DataFrame:
    """H2: remember every non-memory resolution.

    New (domain, entity, raw) rows are inserted with ``approved = method in
    AUTO_APPROVED``; rows already present only get ``last_seen`` refreshed.
    The result is a new version of the memory table (no in-place update).
    """
    now = now if now is not None else F.current_timestamp()
    touched = (resolved.where(F.col("method") != "memory")
               .select("domain", "entity", F.col("raw_norm").alias("raw_column"),
                       F.col("mapped").alias("n_mapped"), F.col("method").alias("n_method"))
               .dropDuplicates(["domain", "entity", "raw_column"]))
    k = ["domain", "entity", "raw_column"]
    j = memory.join(touched, k, "full_outer")
    present = F.col("method").isNotNull()
    seen = F.col("n_method").isNotNull()
    return j.select(
        *k,
        F.when(present, F.col("mapped_column")).otherwise(F.col("n_mapped")).alias("mapped_column"),
        F.when(present, F.col("method")).otherwise(F.col("n_method")).alias("method"),
        F.when(present, F.col("approved")).otherwise(F.col("n_method").isin(*C.AUTO_APPROVED_METHODS)).alias("approved"),
        F.when(present, F.col("first_seen")).otherwise(now).alias("first_seen"),
        F.when(seen, now).otherwise(F.col("last_seen")).alias("last_seen"),
    )


def pending_review(memory: DataFrame) -> DataFrame:
    """H8: unapproved memory rows per (domain, entity)."""
    return memory.where(~F.col("approved")).groupBy("domain", "entity").agg(F.count(F.lit(1)).alias("pending"))


MAPPING_COLUMNS = ["domain", "entity", "raw_column", "position", "raw_norm", "mapped", "method", "final_column",
                   "needs_review", "range_mapped"]
MAPPING_SCHEMA = ("domain string, entity string, raw_column string, position int, raw_norm string, mapped string, "
                  "method string, final_column string, needs_review boolean, range_mapped string")


def harmonize(df: DataFrame, domain: str, entity: str, cfg: C.Config,
              memory: DataFrame | None = None, with_ranges: bool = True):
    """Harmonise one entity's DataFrame. Returns (renamed DataFrame, mapping DataFrame)."""
    spark = df.sparkSession
    business = [c for c in df.columns if not c.startswith("_")]
    cat = C.local_df(spark, [(domain, entity, c, i) for i, c in enumerate(business)],
                     "domain string, entity string, raw_column string, position int")
    # only unhelpful names can take a range guess: scan just those columns
    unnamed = [c for c in business if re.match(C.UNNAMED_COLUMN_PATTERN, normalize_name(c))]
    if with_ranges and unnamed and cfg.range_rules:
        cat = cat.join(F.broadcast(range_stats(df, unnamed, cfg)), "raw_column", "left")
    mapping = resolve(cat, cfg, memory, spark).select(*MAPPING_COLUMNS)
    # one collect of the schema-sized decisions; re-used as a local table so
    # later consumers (memory upsert, profile) do not rescan the data
    rows = [tuple(r) for r in mapping.collect()]
    mapping = C.local_df(spark, rows, MAPPING_SCHEMA)
    names = {r[2]: r[7] for r in rows}
    return apply(df, names), mapping


def harmonize_many(frames: dict, cfg: C.Config, memory: DataFrame | None = None):
    """Harmonise many entities with one resolution job.

    ``frames``: (domain, entity) -> DataFrame. Returns ({key: renamed}, local
    mapping table). Range statistics are computed only for unhelpful names,
    in one union job; the resolution itself runs once over the combined column
    catalog.
    """
    keys = list(frames)
    if not keys:
        return {}, None
    spark = frames[keys[0]].sparkSession
    rows, stats = [], []
    for d, e in keys:
        business = [c for c in frames[(d, e)].columns if not c.startswith("_")]
        rows += [(d, e, c, i) for i, c in enumerate(business)]
        unnamed = [c for c in business if re.match(C.UNNAMED_COLUMN_PATTERN, normalize_name(c))]
        if unnamed and cfg.range_rules:
            stats.append(range_stats(frames[(d, e)], unnamed, cfg).select(
                F.lit(d).alias("domain"), F.lit(e).alias("entity"), "*"))
    cat = C.local_df(spark, rows, "domain string, entity string, raw_column string, position int")
    if stats:
        st = stats[0]
        for x in stats[1:]:
            st = st.unionByName(x)
        st = C.local_df(spark, [tuple(r) for r in st.collect()],
                        "domain string, entity string, raw_column string, n_rows bigint, num_values bigint, "
                        "in_range array<bigint>")
        cat = cat.join(st, ["domain", "entity", "raw_column"], "left")
    mapping = resolve(cat, cfg, memory, spark).select(*MAPPING_COLUMNS)
    decided = [tuple(r) for r in mapping.collect()]
    mapping = C.local_df(spark, decided, MAPPING_SCHEMA)
    names: dict = {k: {} for k in keys}
    for r in decided:
        names[(r[0], r[1])][r[2]] = r[7]
    return {k: apply(frames[k], names[k]) for k in keys}, mapping
