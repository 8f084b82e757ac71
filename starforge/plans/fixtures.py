"""Inputs derived from the driver tables, in Spark form and in SQL form.

The driver tables are clean, so dirt, NULLs, unmatched keys, file paths and
existing-state splits are *derived* from them by rules both engines can
express. Each fixture reads a whole table; nothing is sampled or capped.
The SQL snippets are the oracle's view of the same fixtures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.config import Config
from starforge.functions.names import normalize_name

DOMAIN = "tpch"
RUN_ID = "run-0001"
# fixed clocks (no wall clock in compared results)
PROCESSED_AT = "2026-06-01T00:00:00+00:00"
CLOCK_0 = "2026-01-01 00:00:00"
CLOCK_1 = "2026-06-01 00:00:00"
CLOCK_2 = "2026-07-01 00:00:00"

# Driver tables that form the star (the others carry text, not star data).
STAR_ENTITIES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "labels", "conversations"]

_CFG = None


def cfg() -> Config:
    global _CFG
    if _CFG is None:
        _CFG = Config.driver()
    return _CFG


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def alias_map(entity: str) -> dict[str, str]:
    """raw -> canonical for one driver entity (alias hits only)."""
    out = {}
    block = (cfg().aliases.get(DOMAIN) or {}).get(entity) or {}
    for canonical, aliases in block.items():
        for a in aliases:
            out.setdefault(normalize_name(a), canonical)
    return out


# ---------------------------------------------------------------- dirty_orders
DIRTY_COLUMNS = ["Order No", " Cust Id ", "Order Status", "Order-Priority", "Order Total",
                 "Order Dt", "Is Urgent", "Notes"]
DIRTY_NORMALIZED = ["order_no", "cust_id", "order_status", "order_priority", "order_total",
                    "order_dt", "is_urgent", "notes"]


def dirty_orders(spark: SparkSession, d: str) -> DataFrame:
    """orders as raw text: padded status/priority, 'N/A' totals, two date
    formats, yes/no flags, an all-NULL column, blank rows, duplicated rows."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    blank = (k % 50) == 7

    def keep(c):
        return F.when(~blank, c)

    df = o.select(
        keep(k.cast("string")).alias("Order No"),
        keep(F.col("o_custkey").cast("string")).alias(" Cust Id "),
        keep(F.when(k % 2 == 0, F.concat(F.lit("  "), F.col("o_orderstatus"), F.lit(" ")))
             .otherwise(F.col("o_orderstatus"))).alias("Order Status"),
        keep(F.when(k % 3 == 0, F.concat(F.lit("\t"), F.col("o_orderpriority")))
             .otherwise(F.col("o_orderpriority"))).alias("Order-Priority"),
        keep(F.when(k % 20 == 0, F.lit("N/A")).otherwise(F.format_string("%.2f", F.col("o_totalprice"))))
        .alias("Order Total"),
        keep(F.when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
             .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))).alias("Order Dt"),
        keep(F.when(F.col("o_orderpriority").startswith("1-"), F.lit("Yes"))
             .when(F.col("o_orderpriority").startswith("2-"), F.lit(" y"))
             .otherwise(F.lit("no"))).alias("Is Urgent"),
        F.lit(None).cast("string").alias("Notes"),
    )
    dups = df.where((F.col("Order No").cast("bigint") % 40) == 3)
    return df.unionAll(dups)


DIRTY_ORDERS_SQL = """
dirty_base AS (
  SELECT
    CASE WHEN o_orderkey % 50 <> 7 THEN CAST(o_orderkey AS VARCHAR) END AS "Order No",
    CASE WHEN o_orderkey % 50 <> 7 THEN CAST(o_custkey AS VARCHAR) END AS " Cust Id ",
    CASE WHEN o_orderkey % 50 <> 7 THEN CASE WHEN o_orderkey % 2 = 0 THEN '  ' || o_orderstatus || ' ' ELSE o_orderstatus END END AS "Order Status",
    CASE WHEN o_orderkey % 50 <> 7 THEN CASE WHEN o_orderkey % 3 = 0 THEN chr(9) || o_orderpriority ELSE o_orderpriority END END AS "Order-Priority",
    CASE WHEN o_orderkey % 50 <> 7 THEN CASE WHEN o_orderkey % 20 = 0 THEN 'N/A' ELSE printf('%.2f', o_totalprice) END END AS "Order Total",
    CASE WHEN o_orderkey % 50 <> 7 THEN CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%m/%d/%Y') END END AS "Order Dt",
    CASE WHEN o_orderkey % 50 <> 7 THEN CASE WHEN starts_with(o_orderpriority, '1-') THEN 'Yes' WHEN starts_with(o_orderpriority, '2-') THEN ' y' ELSE 'no' END END AS "Is Urgent",
    CAST(NULL AS VARCHAR) AS "Notes"
  FROM orders
),
dirty_orders AS (
  SELECT * FROM dirty_base
  UNION ALL
  SELECT * FROM dirty_base WHERE CAST("Order No" AS BIGINT) % 40 = 3
),
dirty_norm AS (
  SELECT "Order No" AS order_no, " Cust Id " AS cust_id, "Order Status" AS order_status,
         "Order-Priority" AS order_priority, "Order Total" AS order_total, "Order Dt" AS order_dt,
         "Is Urgent" AS is_urgent, "Notes" AS notes
  FROM dirty_orders
),
dirty_na AS (
  SELECT {na_cols} FROM dirty_norm
),
dirty_trim AS (
  SELECT {trim_cols} FROM dirty_na
),
dirty_nonempty AS (
  SELECT * FROM dirty_trim
  WHERE NOT (order_no IS NULL AND cust_id IS NULL AND order_status IS NULL AND order_priority IS NULL
             AND order_total IS NULL AND order_dt IS NULL AND is_urgent IS NULL AND notes IS NULL)
),
dirty_clean AS (
  SELECT DISTINCT * FROM dirty_nonempty
)
"""


def _na_sql(c: str) -> str:
    from starforge.config import NA_TOKENS
    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
    return f"CASE WHEN {c} NOT IN ({toks}) THEN {c} END AS {c}"


def _trim_sql(c: str) -> str:
    from starforge.functions.text import WHITESPACE
    chars = " || ".join(f"chr({ord(ch)})" for ch in WHITESPACE)
    return f"trim({c}, {chars}) AS {c}"


def dirty_orders_sql() -> str:
    return DIRTY_ORDERS_SQL.format(
        na_cols=", ".join(_na_sql(c) for c in DIRTY_NORMALIZED),
        trim_cols=", ".join(_trim_sql(c) for c in DIRTY_NORMALIZED))


# ---------------------------------------------------------------- holey_orders
def holey_orders(spark: SparkSession, d: str) -> DataFrame:
    """orders, harmonised, with NULL and unmatched customer ids, NULL dates and
    amounts, and lineage columns spread over four source files."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    path = F.concat(F.lit("tpch/orders_"), (k % 4).cast("string"), F.lit(".csv"))
    return o.select(
        k.alias("order_id"),
        F.when(k % 25 == 0, F.lit(None).cast("bigint"))
        .when(k % 25 == 1, F.col("o_custkey") + 100000).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderstatus"),
        F.when(k % 12 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("amount"),
        F.when(k % 30 == 0, F.lit(None).cast("timestamp")).otherwise(F.col("o_orderdate")).alias("order_date"),
        F.col("o_orderpriority"),
        path.alias("_bronze_path"),
        F.sha2(path, 256).alias("_file_checksum"),
    )


HOLEY_ORDERS_SQL = """
holey_orders AS (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 25 = 0 THEN NULL WHEN o_orderkey % 25 = 1 THEN o_custkey + 100000 ELSE o_custkey END AS customer_id,
         o_orderstatus,
         CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE o_totalprice END AS amount,
         CASE WHEN o_orderkey % 30 = 0 THEN NULL ELSE o_orderdate END AS order_date,
         o_orderpriority,
         'tpch/orders_' || CAST(o_orderkey % 4 AS VARCHAR) || '.csv' AS _bronze_path,
         sha256('tpch/orders_' || CAST(o_orderkey % 4 AS VARCHAR) || '.csv') AS _file_checksum
  FROM orders
)
"""


def customer_dim_input(spark: SparkSession, d: str) -> DataFrame:
    """customer, harmonised, as a dimension input."""
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("customer_id"), "c_name", F.col("c_nationkey").alias("nation_id"),
                    "c_acctbal", "c_mktsegment")


CUSTOMER_DIM_SQL = """
customer_h AS (
  SELECT c_custkey AS customer_id, c_name, c_nationkey AS nation_id, c_acctbal, c_mktsegment FROM customer
),
dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_id NULLS FIRST) AS customer_key, * FROM customer_h
)
"""

# ---------------------------------------------------------------- as_files(documents)


def as_files(spark: SparkSession, d: str) -> DataFrame:
    """documents as Bronze files: path, size, checksum, first_seen, n_lines."""
    doc = table(spark, d, "documents")
    i = F.col("doc_id")
    root = (i % 9) == 0
    date8 = F.concat(F.lit("2026"), F.lpad(((i % 12) + 1).cast("string"), 2, "0"),
                     F.lpad(((i % 28) + 1).cast("string"), 2, "0"))
    suffix = (F.when(i % 4 == 0, F.concat(F.lit("_"), date8))
              .when(i % 4 == 1, F.lit("_2026"))
              .when(i % 4 == 2, F.lit(""))
              .otherwise(F.concat(F.lit("_"), date8, F.lit("_v2"))))
    ext = F.element_at(F.array(*[F.lit(e) for e in [".csv", ".json", ".xml", ".xlsx", ".png", ".bin"]]),
                       ((i % 6) + 1).cast("int"))
    prefix = F.when(root, F.lit("")).otherwise(F.concat(F.col("lang"), F.lit("/"), i.cast("string"), F.lit("/")))
    stem = F.concat(F.col("source"), F.when(root, F.concat(F.lit("-"), i.cast("string"))).otherwise(F.lit("")), suffix)
    first_seen = F.to_timestamp(F.lit(CLOCK_1)) + F.make_dt_interval(hours=(i % 97).cast("int"))
    return doc.select(
        i.alias("doc_id"),
        F.concat(prefix, stem, ext).alias("path"),
        F.octet_length("text").cast("bigint").alias("size_bytes"),
        F.sha2(F.col("text"), 256).alias("checksum"),
        first_seen.alias("first_seen"),
        F.size(F.split(F.col("text"), "\n")).cast("bigint").alias("rows_in"),
        F.size(F.array_distinct(F.split(F.col("text"), "\n"))).cast("bigint").alias("rows_out"),
    )


AS_FILES_SQL = f"""
as_files AS (
  SELECT doc_id,
         (CASE WHEN doc_id % 9 = 0 THEN '' ELSE lang || '/' || CAST(doc_id AS VARCHAR) || '/' END)
         || source || (CASE WHEN doc_id % 9 = 0 THEN '-' || CAST(doc_id AS VARCHAR) ELSE '' END)
         || (CASE doc_id % 4
               WHEN 0 THEN '_2026' || lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0') || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0')
               WHEN 1 THEN '_2026'
               WHEN 2 THEN ''
               ELSE '_2026' || lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0') || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || '_v2' END)
         || ['.csv', '.json', '.xml', '.xlsx', '.png', '.bin'][doc_id % 6 + 1] AS path,
         CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes,
         sha256(text) AS checksum,
         TIMESTAMP '{CLOCK_1}' + to_hours(CAST(doc_id % 97 AS BIGINT)) AS first_seen,
         CAST(len(string_split(text, chr(10))) AS BIGINT) AS rows_in,
         CAST(len(list_distinct(string_split(text, chr(10)))) AS BIGINT) AS rows_out
  FROM documents
)
"""

# ---------------------------------------------------------------- export entity
EXPORT_COLUMNS = ["Col 1", "Col 2", "Unnamed: 3", "Field", "Discount Amount", "Ship Date",
                  "Contact Phone", "Email Address"]


def export_entity(spark: SparkSession, d: str) -> DataFrame:
    """An 'unknown' domain export of lineitem with unhelpful column names."""
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_linenumber").alias("Col 1"),
        F.col("l_quantity").alias("Col 2"),
        F.round(F.col("l_discount") * 100).alias("Unnamed: 3"),
        F.round(F.col("l_tax") * 100).alias("Field"),
        F.col("l_discount").alias("Discount Amount"),
        F.col("l_shipdate").alias("Ship Date"),
        F.concat(F.lit("555-"), F.col("l_orderkey").cast("string")).alias("Contact Phone"),
        F.concat(F.lit("u"), F.col("l_orderkey").cast("string"), F.lit("@example.org")).alias("Email Address"),
    )


EXPORT_SQL = {
    "Col 1": ("l_linenumber", "numeric"),
    "Col 2": ("l_quantity", "numeric"),
    "Unnamed: 3": ("round(l_discount * 100)", "numeric"),
    "Field": ("round(l_tax * 100)", "numeric"),
    "Discount Amount": ("l_discount", "numeric"),
    "Ship Date": ("l_shipdate", "datetime"),
    "Contact Phone": ("'555-' || CAST(l_orderkey AS VARCHAR)", "string"),
    "Email Address": ("'u' || CAST(l_orderkey AS VARCHAR) || '@example.org'", "string"),
}

# ---------------------------------------------------------------- column catalog
# Schemas of the driver tables (name, type class), in file order.
DRIVER_SCHEMAS = {
    "region": [("r_regionkey", "numeric"), ("r_name", "string")],
    "nation": [("n_nationkey", "numeric"), ("n_name", "string"), ("n_regionkey", "numeric")],
    "customer": [("c_custkey", "numeric"), ("c_name", "string"), ("c_nationkey", "numeric"),
                 ("c_acctbal", "numeric"), ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "numeric"), ("s_name", "string"), ("s_nationkey", "numeric"),
                 ("s_acctbal", "numeric")],
    "part": [("p_partkey", "numeric"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "numeric"), ("p_retailprice", "numeric")],
    "orders": [("o_orderkey", "numeric"), ("o_custkey", "numeric"), ("o_orderstatus", "string"),
               ("o_totalprice", "numeric"), ("o_orderdate", "datetime"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "numeric"), ("l_partkey", "numeric"), ("l_suppkey", "numeric"),
                 ("l_linenumber", "numeric"), ("l_quantity", "numeric"), ("l_extendedprice", "numeric"),
                 ("l_discount", "numeric"), ("l_tax", "numeric"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "datetime")],
    "events": [("event_id", "numeric"), ("ts", "datetime"), ("user_id", "numeric"), ("event_type", "string"),
               ("value", "numeric"), ("props", "string")],
    "labels": [("doc_id", "numeric"), ("quality", "numeric"), ("toxic", "numeric")],
    "conversations": [("conv_id", "numeric"), ("turn", "numeric"), ("role", "string"), ("text", "string")],
}

# The mapping memory the registered queries start from.
MEMORY_ROWS = [
    ("tpch", "customer", "c_name", "customer_name", "alias", True),
    ("tpch", "part", "p_name", "part_name", "alias", True),
    ("tpch", "orders", "o_orderstatus", "order_status", "fallback", False),
    ("tpch", "events", "event_type", "event_type", "fallback", False),
]


def memory_df(spark: SparkSession) -> DataFrame:
    from starforge.config import MEMORY_SCHEMA
    import datetime as dt
    t0 = dt.datetime.fromisoformat(CLOCK_0)
    from starforge.config import local_df
    return local_df(spark, [r + (t0, t0) for r in MEMORY_ROWS], MEMORY_SCHEMA)


def entity_catalog(df: DataFrame, domain: str, entity: str) -> DataFrame:
    """Column catalog of one entity: (domain, entity, raw_column, position,
    type_class, n_rows, num_values, in_range).

    Value statistics are what the numeric-range guess needs, and it only
    applies to unhelpful names: an entity without such columns is catalogued
    from its schema alone; otherwise one aggregate pass covers just those
    columns (parsed once in a projection fused with the aggregate).
    """
    import re
    from starforge import config as C
    from starforge.config import local_df
    from starforge.operators.infer import NUMBER_PATTERN
    from starforge.operators.star import type_class
    rules = cfg().range_rules
    fields = list(df.schema.fields)
    unnamed = [i for i, f in enumerate(fields) if re.match(C.UNNAMED_COLUMN_PATTERN, normalize_name(f.name))]
    schema_rows = local_df(df.sparkSession, [(domain, entity, f.name, i, type_class(f.dataType))
                                             for i, f in enumerate(fields)],
                           "domain string, entity string, raw_column string, position int, type_class string")
    if not unnamed:
        return schema_rows.withColumns({"n_rows": F.lit(None).cast("bigint"),
                                        "num_values": F.lit(None).cast("bigint"),
                                        "in_range": F.lit(None).cast("array<bigint>")})
    proj = []
    for i in unnamed:
        t = F.trim(F.col(f"`{fields[i].name}`").cast("string"))
        proj.append(F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double")).alias(f"__v{i}"))
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i in unnamed:
        v = F.col(f"__v{i}")
        aggs.append(F.count(v).alias(f"__{i}_num"))
        aggs += [F.count_if(v.between(lo, hi)).alias(f"__{i}_r{j}") for j, (lo, hi, _) in enumerate(rules)]
    wide = df.select(*proj).agg(*aggs)
    structs = [F.struct(F.lit(fields[i].name).alias("raw_column"), F.col(f"__{i}_num").alias("num_values"),
                        F.array(*[F.col(f"__{i}_r{j}") for j in range(len(rules))]).alias("in_range"))
               for i in unnamed]
    stats = (wide.select(F.col("__rows").alias("n_rows"), F.explode(F.array(*structs)).alias("s"))
             .select("s.raw_column", "n_rows", "s.num_values", "s.in_range"))
    n_rows = wide.select(F.lit(domain).alias("domain"), F.lit(entity).alias("entity"), F.col("__rows").alias("n_rows"))
    # every column of the entity carries the row count; value stats only for unhelpful names
    return (schema_rows.join(F.broadcast(stats.drop("n_rows")), "raw_column", "left")
            .join(F.broadcast(n_rows), ["domain", "entity"], "left")
            .select("domain", "entity", "raw_column", "position", "type_class", "n_rows", "num_values", "in_range"))


def col_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Column catalog of all star entities plus the 'unknown.export' entity."""
    parts = [entity_catalog(table(spark, d, e), DOMAIN, e) for e in STAR_ENTITIES]
    parts.append(entity_catalog(export_entity(spark, d), "unknown", "export"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
