"""Registry of driver queries: Spark callables and their SQL oracles.

Every query reads whole driver tables (or data Spark derives from them) and
is built from the library operators. ``ORACLE`` holds the DuckDB SQL that
computes the same result independently; the two must agree row for row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge import config as C
from starforge.functions import dates as D
from starforge.functions.hashing import row_checksum
from starforge.functions.names import normalize_name_col
from starforge.operators import clean, cube, drill, harmonize, incremental, infer, profile, star, validate
from starforge.operators.keys import dense_ids
from starforge.plans import fixtures as FX
from starforge.plans import sqlgen as S
from starforge.sources import catalog as CAT

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def r2(c):
    return F.round(c.cast("double"), 2)


def r4(c):
    return F.round(c.cast("double"), 4)


# =====================================================================  catalog
CAT_SQL = f"""
cat AS (
  SELECT *, CASE WHEN instr(path, '/') > 0 THEN split_part(path, '/', 1) ELSE 'unknown' END AS domain,
         regexp_replace(regexp_extract(path, '([^/]+)$', 1), '[.][^.]*$', '') AS stem,
         lower(regexp_extract(regexp_extract(path, '([^/]+)$', 1), '([.][^.]*)$', 1)) AS format
  FROM as_files
),
cat2 AS (
  SELECT *, coalesce(nullif(regexp_replace(stem, '(^|_)({CAT.DATE_TOKEN})(_({CAT.DATE_TOKEN}))*$', ''), ''), 'unknown') AS entity
  FROM cat
)"""


def _files(spark, d):
    return CAT.with_domain_entity(FX.as_files(spark, d))


@register("catalog_infer", with_ctes(FX.AS_FILES_SQL, CAT_SQL) + "SELECT path, domain, entity, format FROM cat2")
def q_catalog_infer(spark, d):
    return _files(spark, d).select("path", "domain", "entity", "format")


@register("source_date", with_ctes(FX.AS_FILES_SQL, CAT_SQL) + """
, toks AS (SELECT path, list_filter(string_split(stem, '_'), lambda x: regexp_matches(x, '^([0-9]{8}|[0-9]{4})$')) AS t FROM cat2)
SELECT path, coalesce(substr(t[-1], 1, 4), 'unknown') AS year,
       CASE WHEN length(t[-1]) = 8 THEN substr(t[-1], 5, 2) ELSE '00' END AS month
FROM toks""")
def q_source_date(spark, d):
    return CAT.with_source_date(FX.as_files(spark, d)).select("path", "year", "month")


LEAF = 16_384           # of the registered queries, so that small tables still give trees


@register("fingerprint", f"""
WITH f AS (SELECT doc_id % 8 AS bucket, encode(string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id)) AS b FROM documents GROUP BY 1),
o AS (SELECT bucket, b, octet_length(b) AS size_bytes, unnest(range(0, octet_length(b), {LEAF})) AS o FROM f),
h AS (SELECT bucket, size_bytes, o, sha256(array_slice(b, o + 1, o + {LEAF})) AS leaf FROM o)
SELECT bucket, CAST(max(size_bytes) AS BIGINT) AS size_bytes,
       CASE WHEN count(*) = 1 THEN min(leaf) ELSE sha256(string_agg(leaf, '' ORDER BY o)) END AS checksum
FROM h GROUP BY bucket""")
def q_fingerprint(spark, d):
    """Documents written as eight files, listed and hashed in byte ranges."""
    from starforge.sources import scan
    root = _scratch(spark, "fingerprint")
    docs = FX.table(spark, d, "documents").withColumn("bucket", F.pmod("doc_id", F.lit(8)))
    docs.repartition("bucket").sortWithinPartitions("bucket", "doc_id").select("bucket", "text").write.partitionBy("bucket").text(root)
    files = CAT.list_files(spark, root, with_content=False).where(F.col("path").rlike(r"(^|/)bucket="))
    found = scan.scan(files.select("uri", F.lit(".txt").alias("format"), "size_bytes"), 4 * LEAF, LEAF)
    return files.join(found, "uri").select(F.regexp_extract("path", r"bucket=([0-9]+)", 1).cast("bigint").alias("bucket"), "size_bytes", "checksum")


@register("duplicate_files", with_ctes(FX.AS_FILES_SQL) + """
, firsts AS (SELECT checksum, arg_min(path, (first_seen, path)) AS first_path FROM as_files GROUP BY checksum)
SELECT a.path, f.first_path AS duplicate_of FROM as_files a JOIN firsts f USING (checksum)
WHERE f.first_path <> a.path""")
def q_duplicate_files(spark, d):
    c = CAT.first_of_checksum(FX.as_files(spark, d))
    return c.where(F.col("duplicate_of").isNotNull()).select("path", "duplicate_of")


@register("catalog_merge", with_ctes(FX.AS_FILES_SQL) + f"""
, prev AS (SELECT path, first_seen FROM as_files WHERE doc_id % 10 < 8)
SELECT a.path, coalesce(p.first_seen, TIMESTAMP '{FX.CLOCK_2}') AS first_seen,
       TIMESTAMP '{FX.CLOCK_2}' AS last_seen, p.path IS NULL AS is_new
FROM as_files a LEFT JOIN prev p USING (path)""")
def q_catalog_merge(spark, d):
    files = FX.as_files(spark, d)
    prev = files.where(F.col("doc_id") % 10 < 8).select("path", "first_seen")
    m = CAT.merge(files.select("path", "size_bytes", "checksum"), prev, F.to_timestamp(F.lit(FX.CLOCK_2)))
    return m.select("path", "first_seen", "last_seen", "is_new")


SIZE_LIMIT = 20000


def _gate_inputs(spark, d):
    """Catalog + simulated disk state: missing files, existing outputs (path and checksum)."""
    files = _files(spark, d)
    files = files.withColumn("on_disk", F.col("doc_id") % 31 != 0)
    files = files.withColumn("decodable", F.col("doc_id") % 13 != 0)
    done = files.where(F.col("doc_id") % 5 == 0)
    stale = F.col("doc_id") % 10 == 5
    # several versions per path: the last one counts, an older one may have today's checksum
    existing = (done.select("path", F.when(stale, F.lit("stale")).otherwise(F.col("checksum")).alias("out_checksum"), F.lit(2).alias("written_at"))
                .unionByName(done.select("path", F.when(stale, F.col("checksum")).otherwise(F.lit("older")).alias("out_checksum"),
                                         F.lit(1).alias("written_at"))))
    return files, existing


def _ingest_gate(spark, d):
    from starforge.operators.ingest import gate
    files, existing = _gate_inputs(spark, d)
    return gate(files, existing, size_limit=SIZE_LIMIT)


GATE_SQL = f"""
versions AS (
  SELECT path, CASE WHEN doc_id % 10 = 5 THEN 'stale' ELSE checksum END AS out_checksum, 2 AS written_at FROM as_files WHERE doc_id % 5 = 0
  UNION ALL
  SELECT path, CASE WHEN doc_id % 10 = 5 THEN checksum ELSE 'older' END, 1 FROM as_files WHERE doc_id % 5 = 0),
ex AS (SELECT path, arg_max(out_checksum, written_at) AS out_checksum FROM versions GROUP BY path),
gate AS (
  SELECT c.*, CASE
      WHEN c.doc_id % 31 = 0 THEN 'FAILED'
      WHEN c.size_bytes > {SIZE_LIMIT} THEN 'SKIPPED'
      WHEN c.format IN ({", ".join(S.q(x) for x in CAT.UNSTRUCTURED_FORMATS)}) AND e.out_checksum = c.checksum THEN 'SKIPPED'
      WHEN c.format IN ({", ".join(S.q(x) for x in CAT.UNSTRUCTURED_FORMATS)}) THEN 'COPIED'
      WHEN c.format NOT IN ({", ".join(S.q(x) for x in CAT.READABLE_FORMATS)}) THEN 'SKIPPED'
      WHEN e.out_checksum = c.checksum THEN 'SKIPPED'
      WHEN c.doc_id % 13 = 0 THEN 'FAILED'
      ELSE 'SUCCESS' END AS status,
    CASE
      WHEN c.doc_id % 31 = 0 THEN 'file missing on disk'
      WHEN c.size_bytes > {SIZE_LIMIT} THEN 'exceeds size limit'
      WHEN c.format IN ({", ".join(S.q(x) for x in CAT.UNSTRUCTURED_FORMATS)}) AND e.out_checksum = c.checksum THEN 'already copied (idempotent)'
      WHEN c.format IN ({", ".join(S.q(x) for x in CAT.UNSTRUCTURED_FORMATS)}) THEN NULL
      WHEN c.format NOT IN ({", ".join(S.q(x) for x in CAT.READABLE_FORMATS)}) THEN 'unsupported extension ' || c.format
      WHEN e.out_checksum = c.checksum THEN 'silver output exists (idempotent)'
      WHEN c.doc_id % 13 = 0 THEN 'decode error'
      ELSE NULL END AS reason
  FROM cat2 c LEFT JOIN ex e USING (path)
)"""


@register("ingest_gate", with_ctes(FX.AS_FILES_SQL, CAT_SQL, GATE_SQL) + "SELECT path, status, reason FROM gate")
def q_ingest_gate(spark, d):
    return _ingest_gate(spark, d).select("path", "status", "reason")


@register("status_summary", with_ctes(FX.AS_FILES_SQL, CAT_SQL, GATE_SQL)
          + "SELECT status, count(*) AS n FROM gate GROUP BY status")
def q_status_summary(spark, d):
    from starforge.operators.ingest import status_summary
    return status_summary(_ingest_gate(spark, d))


@register("review_queue", with_ctes(FX.AS_FILES_SQL, CAT_SQL, GATE_SQL) + """
SELECT path, domain, status FROM gate
WHERE domain = 'unknown' OR (status = 'SUCCESS' AND ends_with(entity, '_v2'))""")
def q_review_queue(spark, d):
    from starforge.operators.ingest import review_queue
    g = _ingest_gate(spark, d).withColumn(
        "needs_review", (F.col("status") == "SUCCESS") & F.col("entity").endswith("_v2"))
    return review_queue(g).select("path", "domain", "status")


@register("lineage_log", with_ctes(FX.AS_FILES_SQL, CAT_SQL, GATE_SQL) + f"""
SELECT {S.q(FX.RUN_ID)} AS pipeline_run_id, domain, entity, count(*) AS files,
       CAST(sum(CASE WHEN status = 'SUCCESS' THEN rows_in END) AS BIGINT) AS rows_in,
       CAST(sum(CASE WHEN status = 'SUCCESS' THEN rows_out END) AS BIGINT) AS rows_out
FROM gate WHERE status IN ('SUCCESS', 'COPIED') GROUP BY domain, entity""")
def q_lineage_log(spark, d):
    from starforge.operators.ingest import lineage_log
    return lineage_log(_ingest_gate(spark, d), FX.RUN_ID)


@register("file_lineage", with_ctes(FX.AS_FILES_SQL, CAT_SQL, GATE_SQL) + f"""
SELECT {S.q(FX.RUN_ID)} AS pipeline_run_id, path AS bronze_path, '/lake/silver/domain=' || domain || '/entity=' || entity AS silver_path,
       domain, entity, rows_in, rows_out, checksum
FROM gate WHERE status IN ('SUCCESS', 'COPIED')""")
def q_file_lineage(spark, d):
    from starforge.operators.ingest import file_lineage
    return file_lineage(_ingest_gate(spark, d), FX.RUN_ID, "/lake/silver").drop("processed_at")


def flagship(spark, d):
    """C8 + A6: star from orders/customer, month x customer cube."""
    return q_cuboid_month_dim(spark, d)


# =====================================================================  cleaning (P1-P8) and typing
def _dirty(spark, d):
    return clean.normalize_names(FX.dirty_orders(spark, d))


def _dirty_clean(spark, d):
    return clean.clean(FX.dirty_orders(spark, d), csv_like=True)


@register("normalize_names", f"""
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 97 = 0 THEN ' -- ' ELSE '  ' || upper(p_name) || ' (' || p_type || ')-' || p_brand || '#' END AS label FROM part)
SELECT p_partkey, label, {S.normalize_sql('label')} AS normalized FROM p""")
def q_normalize_names(spark, d):
    p = FX.table(spark, d, "part")
    label = F.when(F.col("p_partkey") % 97 == 0, F.lit(" -- ")).otherwise(
        F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ("), F.col("p_type"), F.lit(")-"), F.col("p_brand"), F.lit("#")))
    return p.select("p_partkey", label.alias("label")).withColumn("normalized", normalize_name_col(F.col("label")))


def _dirty_sql(tail: str) -> str:
    return "WITH " + FX.dirty_orders_sql().strip() + "\n" + tail


@register("trim_strings", _dirty_sql("SELECT " + ", ".join(FX._trim_sql(c) for c in FX.DIRTY_NORMALIZED)
                                     + " FROM dirty_norm"))
def q_trim_strings(spark, d):
    return clean.trim_strings(_dirty(spark, d))


@register("na_tokens", _dirty_sql("SELECT order_no, order_total, is_urgent FROM dirty_na"))
def q_na_tokens(spark, d):
    return clean.na_tokens(_dirty(spark, d)).select("order_no", "order_total", "is_urgent")


@register("drop_empty_rows", _dirty_sql("SELECT * FROM dirty_nonempty"))
def q_drop_empty_rows(spark, d):
    return _dirty(spark, d).transform(clean.na_tokens).transform(clean.trim_strings).transform(clean.drop_empty_rows)


@register("dedup_rows", _dirty_sql("""
SELECT 'dirty_orders' AS source, (SELECT count(*) FROM dirty_nonempty) AS rows_in,
       (SELECT count(*) FROM dirty_clean) AS rows_out,
       (SELECT count(*) FROM dirty_nonempty) - (SELECT count(*) FROM dirty_clean) AS removed
UNION ALL
SELECT 'documents', (SELECT count(*) FROM documents),
       (SELECT count(*) FROM (SELECT DISTINCT lang, source, text FROM documents)),
       (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT lang, source, text FROM documents))"""))
def q_dedup_rows(spark, d):
    dirty = _dirty(spark, d).transform(clean.na_tokens).transform(clean.trim_strings).transform(clean.drop_empty_rows)
    docs = FX.table(spark, d, "documents").select("lang", "source", "text")

    def counts(name, df):
        src = F.lit(name).alias("source")
        before = df.groupBy(src).agg(F.count(F.lit(1)).alias("rows_in"))
        after = clean.dedup_rows(df).groupBy(src).agg(F.count(F.lit(1)).alias("rows_out"))
        return (before.join(after, "source")
                .select("source", "rows_in", "rows_out", (F.col("rows_in") - F.col("rows_out")).alias("removed")))
    return counts("dirty_orders", dirty).unionByName(counts("documents", docs))


CLEAN_ORDERS_SELECT = (
    f"{S.int_sql('order_no')} AS order_no, {S.int_sql('cust_id')} AS cust_id, order_status, order_priority, "
    f"{S.num_sql('order_total')} AS order_total, {S.parse_dt_sql('trim(order_dt)')} AS order_dt, "
    f"{S.bool_sql('is_urgent', FX.cfg())} AS is_urgent, notes")


@register("clean_orders", _dirty_sql(f"SELECT {CLEAN_ORDERS_SELECT} FROM dirty_clean"))
def q_clean_orders(spark, d):
    typed, _ = infer.infer_and_cast(_dirty_clean(spark, d), cfg=FX.cfg())
    return typed


@register("cast_numeric", _dirty_sql(f"SELECT order_no, {S.num_sql('order_total')} AS amount FROM dirty_clean"))
def q_cast_numeric(spark, d):
    df = _dirty_clean(spark, d)
    return df.select("order_no", infer.numeric_value(F.col("order_total")).alias("amount"))


@register("cast_datetime", _dirty_sql(f"SELECT order_no, {S.parse_dt_sql('trim(order_dt)')} AS order_date FROM dirty_clean"))
def q_cast_datetime(spark, d):
    df = _dirty_clean(spark, d)
    return df.select("order_no", D.parse_datetime(F.trim(F.col("order_dt"))).alias("order_date"))


# Written forms of a moment: Spark's pattern, strftime's, minutes that the written offset is ahead of UTC.
WRITTEN_FORMS = [
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "%Y-%m-%dT%H:%M:%S.%fZ", 0), ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "%Y-%m-%dT%H:%M:%S.%f", 0),
    ("yyyy-MM-dd'T'HH:mm:ss'+02:00'", "%Y-%m-%dT%H:%M:%S+02:00", 120), ("yyyy-MM-dd HH:mm:ss'-0530'", "%Y-%m-%d %H:%M:%S-0530", -330),
    ("yyyy-MM-dd'T'HH:mm'Z'", "%Y-%m-%dT%H:%MZ", 0), ("yyyy-MM-dd HH:mm:ss 'UTC'", "%Y-%m-%d %H:%M:%S UTC", 0), ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S", 0),
    ("yyyy/MM/dd HH:mm", "%Y/%m/%d %H:%M", 0), ("yyyy.MM.dd", "%Y.%m.%d", 0), ("yyyyMMdd'T'HHmmss'Z'", "%Y%m%dT%H%M%SZ", 0), ("yyyy-MM-dd", "%Y-%m-%d", 0),
    ("M/d/yyyy", "%-m/%-d/%Y", 0), ("MM/dd/yyyy hh:mm a", "%m/%d/%Y %I:%M %p", 0), ("M/d/yyyy HH:mm:ss", "%-m/%-d/%Y %H:%M:%S", 0), ("MM.dd.yyyy", "%m.%d.%Y", 0),
    ("MMMM d, yyyy", "%B %-d, %Y", 0), ("MMM d yyyy", "%b %-d %Y", 0), ("MMMM dd, yyyy hh:mm:ss a", "%B %d, %Y %I:%M:%S %p", 0), ("d MMMM yyyy", "%-d %B %Y", 0),
    ("dd-MMM-yyyy HH:mm:ss", "%d-%b-%Y %H:%M:%S", 0), ("EEEE, MMMM d, yyyy", "%A, %B %-d, %Y", 0), ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", "%a, %d %b %Y %H:%M:%S GMT", 0),
    ("dd MMM yyyy HH:mm:ss'+01'", "%d %b %Y %H:%M:%S+01", 60), ("yyyy-MM-dd HH:mm:ss,SSS", "%Y-%m-%d %H:%M:%S,%g", 0),
]


@register("cast_datetime_forms", f"""
WITH m AS (SELECT o_orderkey, o_orderkey % {len(WRITTEN_FORMS)} AS form,
             o_orderdate + to_seconds(o_orderkey * 7919 % 86400) + to_microseconds(o_orderkey * 104729 % 1000000) AS moment0 FROM orders)
SELECT o_orderkey, CASE form {" ".join(f"WHEN {k} THEN strftime(moment0, {S.q(f)})" for k, (_, f, _) in enumerate(WRITTEN_FORMS))} END AS written,
       CASE form {" ".join(f"WHEN {k} THEN strptime(strftime(moment0, {S.q(f)}), {S.q(f)}) - to_minutes({m})" for k, (_, f, m) in enumerate(WRITTEN_FORMS))} END AS moment
FROM m""")
def q_cast_datetime_forms(spark, d):
    """Every order's moment written in one of 24 forms and read again."""
    o, k = FX.table(spark, d, "orders"), F.col("o_orderkey")
    at = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + (k * 7919 % 86400) * 1_000_000 + k * 104729 % 1_000_000)
    written = None
    for n, (form, _, _) in enumerate(WRITTEN_FORMS):
        written = (F if written is None else written).when(k % len(WRITTEN_FORMS) == n, F.date_format(at, form))
    return o.select("o_orderkey", written.alias("written")).withColumn("moment", D.parse_datetime(F.col("written")))


@register("cast_boolean", f"""
SELECT doc_id, {S.bool_sql('CAST(quality AS VARCHAR)', FX.cfg())} AS quality,
       {S.bool_sql('CAST(toxic AS VARCHAR)', FX.cfg())} AS toxic FROM labels""")
def q_cast_boolean(spark, d):
    lab = FX.table(spark, d, "labels")
    decided = infer.labels(lab, ["quality", "toxic"], FX.cfg())
    return infer.cast(lab, decided, FX.cfg())


def _stats_sql(source: str, frm: str, cols: list[str]) -> list[str]:
    cfg = FX.cfg()
    vocab = ", ".join(S.q(v.lower()) for v in cfg.true_values + cfg.false_values)
    out = []
    for i, c in enumerate(cols):
        t = f"trim(CAST({c} AS VARCHAR))"
        out.append(
            f"SELECT {S.q(source)} AS source, {S.q(c)} AS \"column\", {i} AS position, count({c}) AS nonnull, "
            f"count(CASE WHEN lower({t}) IN ({vocab}) THEN 1 END) AS bool_hits, "
            f"count(CASE WHEN regexp_matches({t}, {S.q(infer.NUMBER_PATTERN)}) THEN 1 END) AS num_hits, "
            f"count(CASE WHEN regexp_matches({t}, {S.q(infer.INTEGER_PATTERN)}) THEN TRY_CAST({t} AS BIGINT) END) AS int_hits, "
            f"count({S.parse_dt_sql(t)}) AS dt_hits FROM {frm}")
    return out


INFER_SOURCES = [("dirty_orders", FX.DIRTY_NORMALIZED), ("labels", ["doc_id", "quality", "toxic"]),
                 ("events", ["event_id", "ts", "user_id", "event_type", "value", "props"])]


@register("infer_types", _dirty_sql("""
, st AS (
  """ + "\n  UNION ALL ".join(
    _stats_sql("dirty_orders", "dirty_clean", FX.DIRTY_NORMALIZED)
    + _stats_sql("labels", "labels", ["doc_id", "quality", "toxic"])
    + _stats_sql("events", "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])) + f"""
)
SELECT source, "column", position, nonnull, bool_hits, num_hits, int_hits, dt_hits,
  CASE WHEN nonnull = 0 THEN 'empty' WHEN bool_hits / nonnull >= {C.BOOL_THRESHOLD} THEN 'boolean'
       WHEN num_hits / nonnull >= {C.NUMERIC_THRESHOLD} THEN 'numeric'
       WHEN dt_hits / nonnull >= {C.DATETIME_THRESHOLD} THEN 'datetime' ELSE 'string' END AS label
FROM st"""))
def q_infer_types(spark, d):
    srcs = {"dirty_orders": _dirty_clean(spark, d), "labels": FX.table(spark, d, "labels"),
            "events": FX.table(spark, d, "events")}
    first = clean.trim_strings(clean.na_tokens(_dirty(spark, d)))        # rows not yet de-duplicated
    repeated = [infer.repeated_dates([(first, FX.DIRTY_NORMALIZED)])[0], [], []]
    out = None
    for (name, cols), rep in zip(INFER_SOURCES, repeated):
        st = infer.decide(infer.column_stats(srcs[name], cols, FX.cfg(), rep)).select(
            F.lit(name).alias("source"), "column", "position", "nonnull", "bool_hits", "num_hits", "int_hits",
            "dt_hits", "label")
        out = st if out is None else out.unionByName(st)
    return out


LINEAGE_PATH = "tpch/orders.parquet"


@register("lineage_cols", f"""
SELECT o.*, {S.q(LINEAGE_PATH)} AS _bronze_path, 'tpch' AS _domain, 'orders' AS _entity, '.parquet' AS _format,
       sha256({S.q(LINEAGE_PATH)}) AS _file_checksum, {S.q(FX.PROCESSED_AT)} AS _processed_at,
       {S.q(FX.RUN_ID)} AS _pipeline_run_id,
       sha256(concat_ws(chr(31), 'i:' || CAST(o_orderkey AS VARCHAR), 'i:' || CAST(o_custkey AS VARCHAR),
              's:' || o_orderstatus, 'f:' || CAST(o_totalprice AS VARCHAR),
              't:' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), 's:' || o_orderpriority)) AS _row_checksum,
       FALSE AS _needs_review
FROM orders o""")
def q_lineage_cols(spark, d):
    from starforge.operators.lineage import add_lineage
    o = FX.table(spark, d, "orders").withColumn("_bronze_path", F.lit(LINEAGE_PATH))
    cat = CAT.with_domain_entity(spark.createDataFrame([(LINEAGE_PATH,)], "path string")).withColumn(
        "checksum", F.sha2(F.col("path"), 256))
    return add_lineage(o, cat, FX.RUN_ID, FX.PROCESSED_AT)


@register("row_checksum", """
SELECT c_custkey, sha256(concat_ws(chr(31), coalesce('i:' || CAST(c_custkey AS VARCHAR), '\\N'),
       coalesce('s:' || c_name, '\\N'), coalesce('i:' || CAST(c_nationkey AS VARCHAR), '\\N'),
       coalesce('f:' || CAST(c_acctbal AS VARCHAR), '\\N'), coalesce('s:' || c_mktsegment, '\\N'))) AS checksum
FROM customer""")
def q_row_checksum(spark, d):
    c = FX.table(spark, d, "customer")
    return c.select("c_custkey", row_checksum(c).alias("checksum"))


# =====================================================================  harmonisation (H1-H9, P9) and profile (Q1-Q5)
def _resolved(spark, d):
    return harmonize.resolve(FX.col_catalog(spark, d), FX.cfg(), FX.memory_df(spark))


H_SQL = S.harmonize_sql()


@register("harmonize", with_ctes(H_SQL) + """
SELECT domain, entity, raw_column, position, mapped, method, needs_review, final_column FROM resolved""")
def q_harmonize(spark, d):
    return _resolved(spark, d).select("domain", "entity", "raw_column", "position", "mapped", "method",
                                      "needs_review", "final_column")


@register("needs_review", with_ctes(H_SQL) + """
SELECT domain, entity, bool_or(needs_review) OR domain = 'unknown' AS needs_review FROM resolved GROUP BY domain, entity""")
def q_needs_review(spark, d):
    from starforge.operators.lineage import file_needs_review
    r = file_needs_review(_resolved(spark, d))
    return r.select("domain", "entity", (F.col("needs_review") | (F.col("domain") == "unknown")).alias("needs_review"))


UPSERT_SQL = f"""
touched AS (SELECT DISTINCT domain, entity, raw_norm AS raw_column, first(mapped) OVER w AS n_mapped, first(method) OVER w AS n_method
            FROM resolved WHERE method <> 'memory'
            WINDOW w AS (PARTITION BY domain, entity, raw_norm ORDER BY position)),
upserted AS (
  SELECT coalesce(m.domain, t.domain) AS domain, coalesce(m.entity, t.entity) AS entity,
         coalesce(m.raw_column, t.raw_column) AS raw_column,
         CASE WHEN m.method IS NOT NULL THEN m.mapped_column ELSE t.n_mapped END AS mapped_column,
         CASE WHEN m.method IS NOT NULL THEN m.method ELSE t.n_method END AS method,
         CASE WHEN m.method IS NOT NULL THEN m.approved ELSE t.n_method IN ({", ".join(S.q(x) for x in C.AUTO_APPROVED_METHODS)}) END AS approved,
         CASE WHEN m.method IS NOT NULL THEN m.first_seen ELSE TIMESTAMP '{FX.CLOCK_1}' END AS first_seen,
         CASE WHEN t.n_method IS NOT NULL THEN TIMESTAMP '{FX.CLOCK_1}' ELSE m.last_seen END AS last_seen
  FROM memory m FULL OUTER JOIN touched t
    ON m.domain = t.domain AND m.entity = t.entity AND m.raw_column = t.raw_column
)"""


def _upserted(spark, d):
    return harmonize.upsert_memory(FX.memory_df(spark), _resolved(spark, d), F.to_timestamp(F.lit(FX.CLOCK_1)))


@register("mapping_upsert", with_ctes(H_SQL, UPSERT_SQL) + "SELECT * FROM upserted")
def q_mapping_upsert(spark, d):
    return _upserted(spark, d)


@register("pending_review", with_ctes(H_SQL, UPSERT_SQL) + """
SELECT domain, entity, count(*) AS pending FROM upserted WHERE NOT approved GROUP BY domain, entity""")
def q_pending_review(spark, d):
    return harmonize.pending_review(_upserted(spark, d))


@register("range_guess", with_ctes(H_SQL) + """
SELECT raw_column, n_rows, num_values, range_mapped AS guess FROM resolved WHERE entity = 'export'""")
def q_range_guess(spark, d):
    r = _resolved(spark, d).where(F.col("entity") == "export")
    return r.select("raw_column", "n_rows", "num_values", F.col("range_mapped").alias("guess"))


@register("dup_suffix", with_ctes(H_SQL) + """
SELECT domain, entity, raw_column, mapped, final_column FROM resolved WHERE mapped IN (
  SELECT mapped FROM resolved r2 WHERE r2.domain = resolved.domain AND r2.entity = resolved.entity
  GROUP BY mapped HAVING count(*) > 1)""")
def q_dup_suffix(spark, d):
    r = _resolved(spark, d)
    multi = (r.groupBy("domain", "entity", "mapped").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1).drop("n"))
    return r.join(multi, ["domain", "entity", "mapped"], "left_semi").select(
        "domain", "entity", "raw_column", "mapped", "final_column")


@register("schema_drift", with_ctes(H_SQL) + """
, p AS (SELECT final_column AS "column" FROM resolved WHERE entity = 'customer'),
c AS (SELECT final_column AS "column" FROM resolved WHERE entity = 'supplier')
SELECT "column", 'added' AS change FROM c WHERE "column" NOT IN (SELECT "column" FROM p)
UNION ALL
SELECT "column", 'removed' FROM p WHERE "column" NOT IN (SELECT "column" FROM c)""")
def q_schema_drift(spark, d):
    r = _resolved(spark, d).select("entity", F.col("final_column").alias("column"))
    return profile.drift(r.where(F.col("entity") == "customer"), r.where(F.col("entity") == "supplier"))


def _classify_input(spark, d):
    r = _resolved(spark, d)
    return r.select("domain", "entity", F.col("final_column").alias("column"), "position", "type_class",
                    F.lit(True).alias("null_free"))


CLASSIFY_SQL = """
cls AS (
  SELECT domain, entity,
         count(CASE WHEN ends_with(final_column, '_id') THEN 1 END) AS n_id,
         count(CASE WHEN type_class = 'numeric' AND NOT ends_with(final_column, '_id') THEN 1 END) AS n_measure,
         count(CASE WHEN type_class = 'datetime' THEN 1 END) AS n_date
  FROM resolved GROUP BY domain, entity
),
cls2 AS (
  SELECT *, CASE WHEN n_id >= 2 OR n_measure >= 1 OR n_date >= 2 THEN 'fact' ELSE 'dimension' END AS heuristic FROM cls
)"""


def _overrides_sql() -> str:
    return S.values(FX.cfg().override_rows(), ["domain", "entity", "forced"])


@register("classify", with_ctes(H_SQL, CLASSIFY_SQL) + "SELECT domain, entity, n_id, n_measure, n_date, heuristic AS class FROM cls2")
def q_classify(spark, d):
    c = star.classify(_classify_input(spark, d))
    return c.select("domain", "entity", "n_id", "n_measure", "n_date", "class")


@register("classify_override", with_ctes(H_SQL, CLASSIFY_SQL) + f"""
SELECT c.domain, c.entity, coalesce(o.forced, c.heuristic) AS class, o.forced IS NOT NULL AS overridden
FROM cls2 c LEFT JOIN (SELECT * FROM {_overrides_sql()} WHERE forced IN ('dimension', 'fact')) o
  ON c.domain = o.domain AND c.entity = o.entity""")
def q_classify_override(spark, d):
    c = star.classify(_classify_input(spark, d), FX.cfg().override_df(spark))
    return c.select("domain", "entity", "class", "overridden")


HOLEY_COLS = ["order_id", "customer_id", "o_orderstatus", "amount", "order_date", "o_orderpriority"]
LINEITEM_COLS = [n for n, _ in FX.DRIVER_SCHEMAS["lineitem"]]


def _nulls_sql(table: str, frm: str, cols: list[str]) -> list[str]:
    return [f"SELECT {S.q(table)} AS \"table\", {S.q(c)} AS \"column\", {i} AS position, count(*) AS rows, "
            f"count(*) - count({c}) AS nulls, round(100.0 * (count(*) - count({c})) / count(*), 2) AS null_pct FROM {frm}"
            for i, c in enumerate(cols)]


PROFILE_SQL = "prof AS (\n  " + "\n  UNION ALL ".join(
    _nulls_sql("holey_orders", "holey_orders", HOLEY_COLS) + _nulls_sql("lineitem", "lineitem", LINEITEM_COLS)) + "\n)"


def _profile(spark, d):
    h = profile.null_profile(FX.holey_orders(spark, d), HOLEY_COLS).withColumn("table", F.lit("holey_orders"))
    li = profile.null_profile(FX.table(spark, d, "lineitem")).withColumn("table", F.lit("lineitem"))
    return h.unionByName(li).select("table", "column", "position", "rows", "nulls", "null_pct")


@register("profile_nulls", with_ctes(FX.HOLEY_ORDERS_SQL, PROFILE_SQL) + "SELECT * FROM prof")
def q_profile_nulls(spark, d):
    return _profile(spark, d)


@register("completeness", with_ctes(FX.HOLEY_ORDERS_SQL, PROFILE_SQL)
          + "SELECT \"table\", round(100 - avg(null_pct), 2) AS completeness FROM prof GROUP BY \"table\"")
def q_completeness(spark, d):
    return profile.completeness(_profile(spark, d), ["table"])


@register("sample_values", with_ctes(FX.HOLEY_ORDERS_SQL) + """
, long AS (""" + "\n  UNION ALL ".join(
    f"SELECT {S.q(c)} AS \"column\", order_id AS ord, CAST({c} AS VARCHAR) AS value FROM holey_orders WHERE {c} IS NOT NULL"
    for c in HOLEY_COLS) + """)
SELECT "column", CAST(rank AS INTEGER) AS rank, value FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY ord) AS rank FROM long) WHERE rank <= 3""")
def q_sample_values(spark, d):
    return profile.sample_values(FX.holey_orders(spark, d).select(*HOLEY_COLS), ["order_id"], 3, HOLEY_COLS)


# =====================================================================  star schema
def rounded(df: DataFrame) -> DataFrame:
    """Float aggregates in a form two engines reproduce bit for bit.

    Sums are rounded to 2 decimals (the inputs have 2); means are that rounded
    sum divided by the count (an IEEE division of identical operands), never a
    rounded ``avg`` - rounding a mean hits exact decimal ties (k/800, ...).
    """
    cols = set(df.columns)
    out = []
    for c in df.columns:
        if c.endswith("_sum") or c == "sum":
            out.append(r2(F.col(c)).alias(c))
        elif c.endswith("_mean") or c == "mean":
            base = c[: -len("mean")]
            s_, n_ = f"{base}sum", f"{base}count"
            if s_ in cols and n_ in cols:
                out.append(F.when(F.col(n_) > 0, r2(F.col(s_)) / F.col(n_)).alias(c))
            else:
                out.append(F.col(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def rounded_sql(cols: list[tuple[str, str]]) -> str:
    out = []
    for expr, name in cols:
        if name.endswith("_sum") or name == "sum":
            out.append(f"round(CAST({expr} AS DOUBLE), 2) AS {name}")
        else:
            out.append(f"{expr} AS {name}")
    return ", ".join(out)


def _dim_customer(spark, d):
    dim, nat = star.dimension(FX.customer_dim_input(spark, d), "customer_id", order_cols=["customer_id"])
    return dense_ids(dim, [nat], "customer_key")


def _fact_orders(spark, d):
    return star.fact(FX.holey_orders(spark, d), "orders", {"customer": (_dim_customer(spark, d), "customer_id")})


FACT_ORDERS_SQL = """
fact_orders AS (
  SELECT h.*, CAST(strftime(h.order_date, '%Y%m%d') AS INTEGER) AS order_date_key, dc.customer_key
  FROM holey_orders h LEFT JOIN dim_customer dc ON h.customer_id IS NOT DISTINCT FROM dc.customer_id
)"""
STAR_ORDERS = [FX.HOLEY_ORDERS_SQL, FX.CUSTOMER_DIM_SQL, FACT_ORDERS_SQL]

CUSTOMER_VERSIONS_SQL = """
cust_versions AS (
  SELECT c_custkey AS customer_id, c_name, c_nationkey AS nation_id, c_acctbal, c_mktsegment,
         'tpch/customer_v0.csv' AS _bronze_path, c_custkey AS _src_row, sha256('tpch/customer_v0.csv') AS _file_checksum
  FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1, 'CHANGED', 'tpch/customer_v1.csv', c_custkey,
         sha256('tpch/customer_v1.csv')
  FROM customer WHERE c_custkey % 7 = 0
),
dim_cust_first AS (
  SELECT customer_id, c_name, nation_id, c_acctbal, c_mktsegment, _bronze_path, _file_checksum FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY _bronze_path, _src_row) AS rn FROM cust_versions)
  WHERE rn = 1
)"""


def _customer_versions(spark, d):
    base = FX.customer_dim_input(spark, d)
    v0 = base.withColumns({"_bronze_path": F.lit("tpch/customer_v0.csv"), "_src_row": F.col("customer_id")})
    v1 = (base.where(F.col("customer_id") % 7 == 0)
          .withColumns({"c_acctbal": F.col("c_acctbal") + 1, "c_mktsegment": F.lit("CHANGED"),
                        "_bronze_path": F.lit("tpch/customer_v1.csv"), "_src_row": F.col("customer_id")}))
    return v0.unionByName(v1).withColumn("_file_checksum", F.sha2(F.col("_bronze_path"), 256))


@register("dim_customer", with_ctes(CUSTOMER_VERSIONS_SQL) + "SELECT * FROM dim_cust_first")
def q_dim_customer(spark, d):
    dim, _ = star.dimension(_customer_versions(spark, d))
    return dim


@register("dim_surrogate", with_ctes(CUSTOMER_VERSIONS_SQL)
          + "SELECT row_number() OVER (ORDER BY customer_id NULLS FIRST) AS customer_key, customer_id FROM dim_cust_first")
def q_dim_surrogate(spark, d):
    dim, nat = star.dimension(_customer_versions(spark, d))
    return dense_ids(dim, [nat], "customer_key").select("customer_key", "customer_id")


DATES_SQL = """
dd AS (SELECT DISTINCT d FROM (
  SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL
  SELECT CAST(l_shipdate AS DATE) FROM lineitem UNION ALL
  SELECT CAST(ts AS DATE) FROM events) WHERE d IS NOT NULL),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_of_week, isodow(d) >= 6 AS is_weekend
  FROM dd
)"""


def _dim_date(spark, d):
    return star.dim_date([(FX.table(spark, d, "orders"), ["o_orderdate"]),
                          (FX.table(spark, d, "lineitem"), ["l_shipdate"]),
                          (FX.table(spark, d, "events"), ["ts"])])


@register("dim_date", with_ctes(DATES_SQL) + "SELECT * FROM dim_date")
def q_dim_date(spark, d):
    return _dim_date(spark, d)


@register("date_keys", with_ctes(FX.HOLEY_ORDERS_SQL)
          + "SELECT order_id, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS order_date_key FROM holey_orders")
def q_date_keys(spark, d):
    return star.with_date_keys(FX.holey_orders(spark, d)).select("order_id", "order_date_key")


@register("fact_orders_fk", with_ctes(*STAR_ORDERS)
          + "SELECT order_id, customer_id, customer_key, order_date_key FROM fact_orders")
def q_fact_orders_fk(spark, d):
    return _fact_orders(spark, d).select("order_id", "customer_id", "customer_key", "order_date_key")


@register("fk_match_rate", with_ctes(*STAR_ORDERS) + """
SELECT 'customer_key' AS key_col, count(customer_key) AS matched, count(*) AS total FROM fact_orders
UNION ALL SELECT 'order_date_key', count(order_date_key), count(*) FROM fact_orders""")
def q_fk_match_rate(spark, d):
    return star.fk_match(_fact_orders(spark, d), ["customer_key", "order_date_key"])


@register("fact_ids", "SELECT row_number() OVER (ORDER BY " + ", ".join(LINEITEM_COLS)
          + ") AS fact_id, l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem")
def q_fact_ids(spark, d):
    li = FX.table(spark, d, "lineitem")
    return dense_ids(li, LINEITEM_COLS, "fact_id").select("fact_id", "l_orderkey", "l_partkey", "l_suppkey",
                                                          "l_linenumber")


@register("incr_dim_date", with_ctes(DATES_SQL) + "SELECT * FROM dim_date WHERE date >= DATE '2000-01-01'")
def q_incr_dim_date(spark, d):
    batch = _dim_date(spark, d)
    existing = batch.where(F.col("date") < F.lit("2000-01-01").cast("date"))
    _, appended = incremental.load_dim_date(existing, batch)
    return appended


@register("incr_dim", with_ctes(FX.CUSTOMER_DIM_SQL) + """
, ex AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, * FROM customer_h WHERE customer_id % 10 < 8),
nw AS (SELECT (SELECT max(customer_key) FROM ex) + row_number() OVER (ORDER BY customer_id) AS customer_key, *
       FROM customer_h WHERE customer_id NOT IN (SELECT customer_id FROM ex))
SELECT * FROM ex UNION ALL SELECT * FROM nw""")
def q_incr_dim(spark, d):
    batch = FX.customer_dim_input(spark, d)
    existing, _ = incremental.load_dimension(None, batch.where(F.col("customer_id") % 10 < 8), "customer", "customer_id")
    full, _ = incremental.load_dimension(existing, batch, "customer", "customer_id")
    return full


ORDERS_CHECKSUM_SQL = """
fo AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus, o_totalprice AS amount,
         o_orderdate AS order_date, o_orderpriority,
         sha256(concat_ws(chr(31), coalesce('i:' || CAST(o_orderkey AS VARCHAR), '\\N'),
           coalesce('i:' || CAST(o_custkey AS VARCHAR), '\\N'), coalesce('s:' || o_orderstatus, '\\N'),
           coalesce('f:' || CAST(o_totalprice AS VARCHAR), '\\N'),
           coalesce('t:' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), '\\N'),
           coalesce('s:' || o_orderpriority, '\\N'))) AS _row_checksum
  FROM orders
)"""


def _orders_fact_rows(spark, d):
    o = FX.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), "o_orderstatus",
        F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("order_date"), "o_orderpriority")
    return o.withColumn("_row_checksum", row_checksum(o))


@register("incr_fact", with_ctes(ORDERS_CHECKSUM_SQL) + """
, ex AS (SELECT row_number() OVER (ORDER BY _row_checksum) AS fact_id, * FROM fo WHERE order_id % 10 < 8)
SELECT (SELECT max(fact_id) FROM ex) + row_number() OVER (ORDER BY _row_checksum) AS fact_id, order_id, _row_checksum
FROM fo WHERE _row_checksum NOT IN (SELECT _row_checksum FROM ex)""")
def q_incr_fact(spark, d):
    batch = _orders_fact_rows(spark, d)
    existing, _ = incremental.load_fact(None, batch.where(F.col("order_id") % 10 < 8))
    _, appended = incremental.load_fact(existing, batch)
    return appended.select("fact_id", "order_id", "_row_checksum")


@register("unique_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def q_unique_keys(spark, d):
    return validate.duplicate_keys(FX.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("measure_list", with_ctes(H_SQL, CLASSIFY_SQL) + f"""
, cls3 AS (SELECT c.domain, c.entity, coalesce(o.forced, c.heuristic) AS class
           FROM cls2 c LEFT JOIN (SELECT * FROM {_overrides_sql()} WHERE forced IN ('dimension', 'fact')) o
           ON c.domain = o.domain AND c.entity = o.entity)
SELECT r.entity, r.final_column AS "column",
       CASE WHEN ends_with(r.final_column, '_id') THEN 'identifier' WHEN r.type_class = 'datetime' THEN 'date'
            WHEN r.type_class = 'numeric' THEN 'measure' ELSE 'attribute' END AS role
FROM resolved r JOIN cls3 c ON r.domain = c.domain AND r.entity = c.entity WHERE c.class = 'fact'""")
def q_measure_list(spark, d):
    cat = _classify_input(spark, d)
    facts = star.classify(cat, FX.cfg().override_df(spark)).where(F.col("class") == "fact").select("domain", "entity")
    role = (F.when(F.col("column").endswith("_id"), F.lit("identifier"))
            .when(F.col("type_class") == "datetime", F.lit("date"))
            .when(F.col("type_class") == "numeric", F.lit("measure")).otherwise(F.lit("attribute")))
    return cat.join(facts, ["domain", "entity"], "left_semi").select("entity", "column", role.alias("role"))


# =====================================================================  cubes (A1-A7), reads (L1-L6), drill (R1-R3), validation
def _month_sql(k: str) -> str:
    return (f"CAST({k} // 10000 AS INTEGER) AS year, CAST(({k} // 100) % 100 AS INTEGER) AS month, "
            f"monthname(strptime(CAST({k} AS VARCHAR), '%Y%m%d')) AS month_name")


def _mean_sql(m: str) -> str:
    return f"round(CAST(coalesce(sum({m}), 0) AS DOUBLE), 2) / nullif(count({m}), 0)"


def _aggs_sql(ms: list[str]) -> str:
    return rounded_sql([x for m in ms for x in (
        (f"coalesce(sum({m}), 0)", f"{m}_sum"), (f"count({m})", f"{m}_count"), (_mean_sql(m), f"{m}_mean"))])


@register("cuboid_record_count", """
SELECT role, CAST(count(*) AS BIGINT) AS _record_count_sum, count(*) AS _record_count_count,
       CAST(1.0 AS DOUBLE) AS _record_count_mean FROM conversations GROUP BY role""")
def q_cuboid_record_count(spark, d):
    conv = FX.table(spark, d, "conversations").select("role", "text")
    out = cube.by_dim(conv, "role")
    return out.withColumn("_record_count_sum", F.col("_record_count_sum").cast("bigint"))


LI_MEASURES = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lineitem_h(spark, d):
    li = FX.table(spark, d, "lineitem")
    ren = FX.alias_map("lineitem")
    return li.select(*[F.col(c).alias(ren.get(c, c)) for c in li.columns])


@register("cuboid_apex", "\nUNION ALL ".join(
    f"SELECT {S.q(m)} AS measure, round(CAST(coalesce(sum({m}), 0) AS DOUBLE), 2) AS sum, count({m}) AS count, "
    f"{_mean_sql(m)} AS mean FROM lineitem" for m in LI_MEASURES))
def q_cuboid_apex(spark, d):
    return rounded(cube.apex(_lineitem_h(spark, d)))


@register("cuboid_by_month", with_ctes(*STAR_ORDERS) + f"""
, m AS (SELECT *, {_month_sql('order_date_key')} FROM fact_orders)
SELECT year, month, month_name, {_aggs_sql(['amount'])} FROM m GROUP BY year, month, month_name""")
def q_cuboid_by_month(spark, d):
    return rounded(cube.by_month(_fact_orders(spark, d), "order_date_key"))


@register("cuboid_by_dim", with_ctes(*STAR_ORDERS) + f"""
SELECT customer_key, {_aggs_sql(['amount'])} FROM fact_orders GROUP BY customer_key""")
def q_cuboid_by_dim(spark, d):
    return rounded(cube.by_dim(_fact_orders(spark, d), "customer_key"))


@register("cuboid_month_dim", with_ctes(*STAR_ORDERS) + f"""
, m AS (SELECT *, {_month_sql('order_date_key')} FROM fact_orders)
SELECT year, month, customer_key, {_aggs_sql(['amount'])} FROM m GROUP BY year, month, customer_key""")
def q_cuboid_month_dim(spark, d):
    return rounded(cube.by_month_dim(_fact_orders(spark, d), "order_date_key", "customer_key"))


def _dim_keys(spark, d, entity: str, nat: str):
    src = FX.table(spark, d, entity)
    ren = FX.alias_map(entity)
    src = src.select(*[F.col(c).alias(ren.get(c, c)) for c in src.columns])
    dim, nat = star.dimension(src, nat, order_cols=[nat])
    return dense_ids(dim, [nat], f"{entity}_key")


def _fact_lineitem(spark, d, checkpointed: bool = False):
    """``checkpointed``: the dimensions' keys are computed once, and plans over them can be told to be the same."""
    dims = {"orders": (_dim_keys(spark, d, "orders", "order_id"), "order_id"),
            "part": (_dim_keys(spark, d, "part", "part_id"), "part_id"),
            "supplier": (_dim_keys(spark, d, "supplier", "supplier_id"), "supplier_id")}
    if checkpointed:
        dims = {k: (keys.select(on, f"{k}_key").checkpoint(), on) for k, (keys, on) in dims.items()}
    return star.fact(_lineitem_h(spark, d), "lineitem", dims)


LATTICE_KEYS = ["orders_key", "part_key", "supplier_key"]
FACT_LINEITEM_SQL = """
dim_orders AS (SELECT row_number() OVER (ORDER BY o_orderkey NULLS FIRST) AS orders_key, o_orderkey AS order_id FROM (SELECT DISTINCT o_orderkey FROM orders)),
dim_part AS (SELECT row_number() OVER (ORDER BY p_partkey) AS part_key, p_partkey AS part_id FROM part),
dim_supplier AS (SELECT row_number() OVER (ORDER BY s_suppkey) AS supplier_key, s_suppkey AS supplier_id FROM supplier),
fact_lineitem AS (
  SELECT l.*, CAST(strftime(l.l_shipdate, '%Y%m%d') AS INTEGER) AS ship_date_key, o.orders_key, p.part_key, s.supplier_key
  FROM lineitem l LEFT JOIN dim_orders o ON l.l_orderkey IS NOT DISTINCT FROM o.order_id
  LEFT JOIN dim_part p ON l.l_partkey IS NOT DISTINCT FROM p.part_id
  LEFT JOIN dim_supplier s ON l.l_suppkey IS NOT DISTINCT FROM s.supplier_id
)"""


def _lattice_sql() -> str:
    group_cols = ["year", "month", "month_name"] + LATTICE_KEYS
    sets = cube.lattice_sets(LATTICE_KEYS, True)

    def gid(cols):
        v = 0
        for i, c in enumerate(group_cols):
            if c not in cols:
                v |= 1 << (len(group_cols) - 1 - i)
        return v
    names = " ".join(f"WHEN {gid(cols)} THEN {S.q(n)}" for n, cols in sets)
    gsets = ", ".join("(" + ", ".join(cols) + ")" for _, cols in sets)
    return with_ctes(FACT_LINEITEM_SQL) + f"""
, m AS (SELECT *, {_month_sql('ship_date_key')} FROM fact_lineitem)
SELECT CASE grouping({", ".join(group_cols)}) {names} END AS cuboid, {", ".join(group_cols)}, {_aggs_sql(LI_MEASURES)}
FROM m GROUP BY GROUPING SETS ({gsets})"""


@register("cuboid_lattice", _lattice_sql())
def q_cuboid_lattice(spark, d):
    f = _fact_lineitem(spark, d, checkpointed=True)
    sizes = {k: FX.table(spark, d, k.removesuffix("_key")).count() for k in LATTICE_KEYS}       # footer counts
    return rounded(cube.lattice_by_parents(f, LATTICE_KEYS, "ship_date_key", LI_MEASURES, sizes))


@register("monthly_trend", with_ctes(*STAR_ORDERS) + f"""
, m AS (SELECT *, {_month_sql('order_date_key')} FROM fact_orders),
bm AS (SELECT year, month, round(CAST(coalesce(sum(amount), 0) AS DOUBLE), 2) AS amount_sum FROM m GROUP BY year, month)
SELECT year * 12 + month AS period, strftime(make_date(year, month, 1), '%b ''%y') AS label,
       coalesce(amount_sum, 0.0) AS value FROM bm WHERE year IS NOT NULL""")
def q_monthly_trend(spark, d):
    bm = rounded(cube.by_month(_fact_orders(spark, d), "order_date_key"))
    return drill.monthly_trend(bm, "amount")


@register("topk_by_dim", with_ctes(*STAR_ORDERS) + """
, bd AS (SELECT customer_key, round(CAST(coalesce(sum(amount), 0) AS DOUBLE), 2) AS value FROM fact_orders
         WHERE customer_key IS NOT NULL GROUP BY customer_key),
top AS (SELECT * FROM bd ORDER BY value DESC, customer_key ASC LIMIT 15)
SELECT CAST(row_number() OVER (ORDER BY t.value DESC, t.customer_key ASC) AS INTEGER) AS rank, t.customer_key,
       coalesce(dc.c_name, CAST(t.customer_key AS VARCHAR)) AS label, t.value
FROM top t LEFT JOIN dim_customer dc ON t.customer_key = dc.customer_key""")
def q_topk_by_dim(spark, d):
    bd = rounded(cube.by_dim(_fact_orders(spark, d), "customer_key"))
    return drill.topk_by_dim(bd, _dim_customer(spark, d), "customer_key", "amount", 15)


@register("page_table", """
SELECT *, (SELECT count(*) FROM orders) AS total_rows FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 50""")
def q_page_table(spark, d):
    return drill.page(FX.table(spark, d, "orders"), ["o_orderkey"], limit=25, offset=50)


DRILL_COLS = ["order_id", "customer_id", "customer_key", "amount", "order_date_key", "_bronze_path"]


@register("drill_dim", with_ctes(*STAR_ORDERS) + f"SELECT {', '.join(DRILL_COLS)} FROM fact_orders WHERE customer_key = 7")
def q_drill_dim(spark, d):
    return drill.rows(_fact_orders(spark, d), {"customer_key": "7"}).select(*DRILL_COLS)


@register("drill_month", with_ctes(*STAR_ORDERS)
          + f"SELECT {', '.join(DRILL_COLS)} FROM fact_orders WHERE order_date_key // 10000 = 1996 AND (order_date_key // 100) % 100 = 3")
def q_drill_month(spark, d):
    return drill.rows(_fact_orders(spark, d), {"year": 1996, "month": 3}, date_role="order_date_key").select(*DRILL_COLS)


@register("trace_cell", with_ctes(*STAR_ORDERS) + """
SELECT _bronze_path, _file_checksum, count(*) AS n_rows FROM fact_orders WHERE order_date_key // 10000 = 1997
GROUP BY _bronze_path, _file_checksum""")
def q_trace_cell(spark, d):
    return drill.trace(drill.rows(_fact_orders(spark, d), {"year": 1997}, date_role="order_date_key"))


@register("validate_apex", """
WITH a AS (""" + "\nUNION ALL ".join(
    f"SELECT DISTINCT {S.q(m)} AS measure FROM lineitem" for m in LI_MEASURES) + """)
SELECT 'original' AS copy, measure, TRUE AS ok FROM a
UNION ALL SELECT 'corrupted', measure, measure <> 'l_quantity' FROM a""")
def q_validate_apex(spark, d):
    f = _lineitem_h(spark, d)
    stored = cube.lattice_apex(cube.lattice(f, [], None, LI_MEASURES))
    corrupted = stored.withColumn("sum", F.when(F.col("measure") == "l_quantity", F.col("sum") + 1).otherwise(F.col("sum")))
    ok = validate.apex_check(f, stored, LI_MEASURES).select(F.lit("original").alias("copy"), "measure", "ok")
    bad = validate.apex_check(f, corrupted, LI_MEASURES).select(F.lit("corrupted").alias("copy"), "measure", "ok")
    return ok.unionByName(bad)


@register("validate_lattice", with_ctes(*STAR_ORDERS) + f"""
, m AS (SELECT *, {_month_sql('order_date_key')} FROM fact_orders),
bc AS (SELECT customer_key, coalesce(sum(amount), 0) AS s, count(amount) AS n FROM m GROUP BY customer_key),
lim AS (SELECT min(customer_key) AS a, max(customer_key) AS b FROM bc),
swapped AS (SELECT bool_and(x.s = y.s AND x.n = y.n) AS same FROM lim JOIN bc x ON x.customer_key = lim.a JOIN bc y ON y.customer_key = lim.b),
sums AS (SELECT 'apex' AS cuboid, sum(n) AS v FROM bc
  UNION ALL SELECT 'by_customer_key', sum(n) FROM bc
  UNION ALL SELECT 'by_month', sum(n) FROM (SELECT count(amount) AS n FROM m GROUP BY year, month)
  UNION ALL SELECT 'by_month_customer_key', sum(n) FROM (SELECT count(amount) AS n FROM m GROUP BY year, month, customer_key))
SELECT 'stored' AS copy, cuboid, 'amount' AS measure, CAST(v AS BIGINT) AS "values", TRUE AS ok FROM sums
UNION ALL
SELECT 'swapped', cuboid, 'amount', CAST(v AS BIGINT), cuboid <> 'by_customer_key' OR same FROM sums, swapped""")
def q_validate_lattice(spark, d):
    """V3: every cuboid against its fact, as stored and with the groups of two customers swapped (all totals still add up)."""
    f = _fact_orders(spark, d)
    lat = cube.lattice_by_parents(f, ["customer_key"], "order_date_key", ["amount"])
    here = F.col("cuboid") == "by_customer_key"
    ends = lat.where(here).agg(F.min("customer_key").alias("a"), F.max("customer_key").alias("b")).first()      # two scalars
    key = F.when(here & (F.col("customer_key") == ends["a"]), ends["b"]).when(here & (F.col("customer_key") == ends["b"]), ends["a"]).otherwise(F.col("customer_key"))
    out = None
    for copy, stored in (("stored", lat), ("swapped", lat.withColumn("customer_key", key))):
        part = validate.lattice_check(f, stored, ["customer_key"], "order_date_key", ["amount"]).select(F.lit(copy).alias("copy"), "cuboid", "measure", "values", "ok")
        out = part if out is None else out.unionByName(part)
    return out


def _events_fact(spark, d):
    return star.with_date_keys(FX.table(spark, d, "events"))


def _manifest(spark, d):
    """Gold manifest (name, kind, fact, rows) of three facts and their cuboids.

    Rows are counted from the data; the apex of the events fact is left out
    on purpose, so validation must report it.
    """
    facts = {
        "fact_tpch_orders": (_fact_orders(spark, d), ["customer_key"], "order_date_key", ["amount"]),
        "fact_tpch_lineitem": (_fact_lineitem(spark, d), LATTICE_KEYS, "ship_date_key", LI_MEASURES),
        "fact_tpch_events": (_events_fact(spark, d), [], "ts_key", ["value"]),
    }
    parts = []
    for name, (f, keys, dk, ms) in facts.items():
        parts.append(f.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("name"), F.lit("fact").alias("kind"), F.lit(None).cast("string").alias("fact"), "rows"))
        lat = cube.lattice(f, keys, dk, ms)
        if name == "fact_tpch_events":
            lat = lat.where(F.col("cuboid") != "apex")
        parts.append(lat.groupBy("cuboid").agg(F.count(F.lit(1)).alias("rows")).select(
            F.concat(F.lit(f"cuboid_{name}_"), F.col("cuboid")).alias("name"), F.lit("cuboid").alias("kind"),
            F.lit(name).alias("fact"), "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("validate_cubes", """
SELECT 'missing apex cuboid for ' || f AS finding FROM (SELECT 'fact_tpch_events' AS f, count(*) AS n FROM events)
UNION ALL
SELECT 'fact_tpch_orders is empty' FROM orders HAVING count(*) = 0""")
def q_validate_cubes(spark, d):
    return validate.manifest_findings(_manifest(spark, d))


INVENTORY_SQL = with_ctes(DATES_SQL) + """
, t AS (
  SELECT 'dim' AS kind, count(DISTINCT r_regionkey) AS n FROM region
  UNION ALL SELECT 'dim', count(DISTINCT n_nationkey) FROM nation
  UNION ALL SELECT 'dim', count(DISTINCT c_custkey) FROM customer
  UNION ALL SELECT 'dim', count(DISTINCT s_suppkey) FROM supplier
  UNION ALL SELECT 'dim', count(DISTINCT p_partkey) FROM part
  UNION ALL SELECT 'dim', count(*) FROM dim_date
  UNION ALL SELECT 'fact', count(*) FROM orders
  UNION ALL SELECT 'fact', count(*) FROM lineitem
  UNION ALL SELECT 'fact', count(*) FROM events
  UNION ALL SELECT 'fact', count(*) FROM labels
  UNION ALL SELECT 'fact', count(*) FROM conversations
)
SELECT kind, count(*) AS n_tables, CAST(sum(n) AS BIGINT) AS n_rows FROM t GROUP BY kind"""


@register("gold_inventory", INVENTORY_SQL)
def q_gold_inventory(spark, d):
    """Tables per kind of the star built from the driver tables."""
    cls = star.classify(_classify_input(spark, d), FX.cfg().override_df(spark)).where(F.col("domain") == FX.DOMAIN)
    classes = {r["entity"]: r["class"] for r in cls.select("entity", "class").collect()}   # one row per entity
    parts = []
    frames = []
    for entity in FX.STAR_ENTITIES:
        df = FX.table(spark, d, entity)
        ren = FX.alias_map(entity)
        df = df.select(*[F.col(c).alias(ren.get(c, c)) for c in df.columns])
        frames.append((df, star.datetime_columns(df)))
        if classes.get(entity) == "dimension":
            dim, _ = star.dimension(df)
            parts.append(dim.agg(F.count(F.lit(1)).alias("n")).select(F.lit("dim").alias("kind"), "n"))
        else:
            parts.append(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("fact").alias("kind"), "n"))
    dd = star.dim_date([(f, c) for f, c in frames if c])
    parts.append(dd.agg(F.count(F.lit(1)).alias("n")).select(F.lit("dim").alias("kind"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("kind").agg(F.count(F.lit(1)).alias("n_tables"), F.sum("n").cast("bigint").alias("n_rows"))


@register("silver_union", """
SELECT 'customer' AS entity, c_custkey AS customer_id, c_name, c_nationkey AS nation_id, c_acctbal, c_mktsegment,
       CAST(NULL AS BIGINT) AS supplier_id, CAST(NULL AS VARCHAR) AS s_name, CAST(NULL AS DOUBLE) AS s_acctbal FROM customer
UNION ALL
SELECT 'supplier', NULL, NULL, s_nationkey, NULL, NULL, s_suppkey, s_name, s_acctbal FROM supplier""")
def q_silver_union(spark, d):
    def h(entity):
        df = FX.table(spark, d, entity)
        ren = FX.alias_map(entity)
        return df.select(F.lit(entity).alias("entity"), *[F.col(c).alias(ren.get(c, c)) for c in df.columns])
    from starforge.plans.pipeline import widened_union
    # a type that changed between loads: int in one, bigint in the other
    return widened_union([h("customer").withColumn("nation_id", F.col("nation_id").cast("int")), h("supplier")])


@register("json_flatten", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events")
def q_json_flatten(spark, d):
    from starforge.functions.json import flatten_column
    return flatten_column(FX.table(spark, d, "events").select("event_id", "props"), "props")


@register("export_records", with_ctes(FX.HOLEY_ORDERS_SQL) + """
SELECT order_id, customer_id, o_orderstatus, amount, strftime(order_date, '%Y-%m-%dT%H:%M:%S') AS order_date,
       o_orderpriority FROM holey_orders""")
def q_export_records(spark, d):
    return drill.export_records(FX.holey_orders(spark, d).select(*HOLEY_COLS))


# =====================================================================  readers over files Spark derives from the tables
def _scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for derived Bronze files."""
    import uuid
    from starforge.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/bronze-{name}-{uuid.uuid4().hex[:12]}"


def _bronze_files(spark, root: str) -> list[str]:
    """The data files under a folder (file names only; content pruned)."""
    from starforge.sources.catalog import list_files
    fs = list_files(spark, root, with_content=False).where(~F.col("path").rlike(r"(^|/)[_.]"))
    return [f"{root}/{r['path']}" for r in fs.select("path").collect()]   # one row per file


FACT_COLUMNS = {"orders": (["amount"], "order_date_key"), "lineitem": (["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"], "ship_date_key"),
                "events": (["value"], "ts_key")}
FACT_COLUMNS_SQL = {k: f"CAST(strftime({c}, '%Y%m%d') AS INTEGER)" for k, c in (("ship_date_key", "l_shipdate"), ("ts_key", "ts"))}
FACT_TABLES = {"orders": "fact_orders"}


@register("fact_columns", with_ctes(*STAR_ORDERS) + "\nUNION ALL\n".join(
    [f"SELECT '{t}' AS fact, '{m}' AS \"column\", 'measure' AS role, count({FACT_COLUMNS_SQL.get(m, m)}) AS n, round(CAST(sum({FACT_COLUMNS_SQL.get(m, m)}) AS DOUBLE), 2) AS total FROM {FACT_TABLES.get(t, t)}"
     for t, (ms, _) in FACT_COLUMNS.items() for m in ms]
    + [f"SELECT '{t}', '{k}', 'date', count(DISTINCT {FACT_COLUMNS_SQL.get(k, k)}), CAST(min({FACT_COLUMNS_SQL.get(k, k)}) AS DOUBLE) FROM {FACT_TABLES.get(t, t)}"
       for t, (_, k) in FACT_COLUMNS.items()]))
def q_fact_columns(spark, d):
    """The measures and date keys the cube finds in each fact, with what they hold."""
    dims = {k: ["customer_key", *LATTICE_KEYS] for k in ("orders", "lineitem", "events")}
    out = None
    for name, f in (("orders", _fact_orders(spark, d)), ("lineitem", _fact_lineitem(spark, d)), ("events", _events_fact(spark, d))):
        ms, keys = cube.measures(f), cube.date_key_columns(f, dims[name])
        got = f.agg(*[x for m in ms for x in (F.count(m).alias(f"n_{m}"), r2(F.sum(m)).alias(f"t_{m}"))],
                    *[x for k in keys for x in (F.count_distinct(k).alias(f"n_{k}"), F.min(k).cast("double").alias(f"t_{k}"))])
        rows = [F.struct(F.lit(c).alias("column"), F.lit(role).alias("role"), F.col(f"n_{c}").alias("n"), F.col(f"t_{c}").alias("total"))
                for role, cs in (("measure", ms), ("date", keys)) for c in cs]
        part = got.select(F.lit(name).alias("fact"), F.explode(F.array(*rows)).alias("s")).select("fact", "s.*")
        out = part if out is None else out.unionByName(part)
    return out


@register("classify_boolean", """
WITH l AS (SELECT doc_id AS document_id, toxic = 1 AS is_toxic, CASE WHEN doc_id % 7 > 0 THEN toxic = 1 END AS some_toxic FROM labels),
n AS (SELECT count(*) - count(is_toxic) AS whole, count(*) - count(some_toxic) AS holes FROM l)
SELECT 'whole' AS entity, whole AS nulls, CASE WHEN whole = 0 THEN 'fact' ELSE 'dimension' END AS class FROM n
UNION ALL SELECT 'holes', holes, CASE WHEN holes = 0 THEN 'fact' ELSE 'dimension' END FROM n""")
def q_classify_boolean(spark, d):
    """A flag counts as a measure where it has no NULL; the NULLs are counted in the labels."""
    lab = FX.table(spark, d, "labels").select(F.col("doc_id").alias("document_id"), (F.col("toxic") == 1).alias("is_toxic"))
    holes = lab.select("document_id", F.when(F.col("document_id") % 7 > 0, F.col("is_toxic")).alias("some_toxic"))
    cats = star.column_catalog(lab, FX.DOMAIN, "whole").unionByName(star.column_catalog(holes, FX.DOMAIN, "holes"))
    nulls = lab.agg(F.lit("whole").alias("entity"), F.count_if(F.col("is_toxic").isNull()).alias("nulls")).unionByName(
        holes.agg(F.lit("holes").alias("entity"), F.count_if(F.col("some_toxic").isNull()).alias("nulls")))
    return star.classify(cats).join(nulls, "entity").select("entity", "nulls", "class")


@register("validate_missing", """
WITH n AS (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM orders WHERE o_totalprice < 0) AS e)
SELECT 'complete' AS state, 'cuboid_fact_orders_by_month is empty' AS finding FROM n WHERE o = 0
UNION ALL SELECT 'no facts', 'no fact tables' FROM n
UNION ALL SELECT 'no facts', 'no cuboid tables' FROM n
UNION ALL SELECT 'no cuboids', 'no cuboid tables' FROM n
UNION ALL SELECT 'no cuboids', 'missing apex cuboid for fact_orders' FROM n
UNION ALL SELECT 'empty cuboid', 'cuboid_fact_orders_by_month is empty' FROM n WHERE e = 0""")
def q_validate_missing(spark, d):
    """V1, V2, V4: manifests counted from orders, complete and with something missing, each with its findings."""
    o = star.with_date_keys(FX.table(spark, d, "orders").withColumnRenamed("o_orderdate", "order_date"))
    lat = cube.lattice_by_parents(o, [], "order_date_key", ["o_totalprice"])
    none = cube.lattice_by_parents(o.where("o_totalprice < 0"), [], "order_date_key", ["o_totalprice"])
    row = lambda df, name, kind, fact: df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.lit(fact).cast("string").alias("fact"), "rows")
    fact = row(o, "fact_orders", "fact", None)
    apex = row(lat.where("cuboid = 'apex'"), "cuboid_fact_orders_apex", "cuboid", "fact_orders")
    month = row(lat.where("cuboid = 'by_month'"), "cuboid_fact_orders_by_month", "cuboid", "fact_orders")
    empty = row(none.where("cuboid = 'by_month'"), "cuboid_fact_orders_by_month", "cuboid", "fact_orders")
    states = {"complete": fact.unionByName(apex).unionByName(month), "no facts": fact.where("rows < 0"), "no cuboids": fact,
              "empty cuboid": fact.unionByName(apex).unionByName(empty)}
    out = None
    for state, manifest in states.items():
        part = validate.manifest_findings(manifest).select(F.lit(state).alias("state"), "finding")
        out = part if out is None else out.unionByName(part)
    return out


@register("page_deep", """
WITH n AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS rn, count(*) OVER () AS total_rows FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, total_rows FROM n WHERE rn >= total_rows // 2 AND rn < total_rows // 2 + 500""")
def q_page_deep(spark, d):
    """L1: a page from the middle of lineitem, through the directory of its sorted files."""
    from starforge.operators import pages
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    li = FX.table(spark, d, "lineitem")
    path = f"{_scratch(spark, 'pages')}/lineitem"
    n = li.count()
    pages.write(li, order, path, max(1, min(pages.ROWS_PER_FILE, n // 12)))       # a task sorts one file's rows
    return pages.page(spark, pages.directory(spark, path, order), order, 500, n // 2) \
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "total_rows")


@register("csv_roundtrip", _dirty_sql(f"SELECT {CLEAN_ORDERS_SELECT} FROM dirty_clean"))
def q_csv_roundtrip(spark, d):
    """S1, S7, S11, P6, T: dirty orders written as CSV files, read back and cleaned."""
    from starforge.sources.readers import read_group
    root = _scratch(spark, "csv")
    # four Bronze files with the raw headers; NA markers and blanks as written text
    (FX.dirty_orders(spark, d).repartition(4).write.option("header", True).option("nullValue", "")
     .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(f"{root}/tpch/orders_2026"))
    raw = read_group(spark, _bronze_files(spark, root), ".csv", root)
    cleaned = clean.clean(raw, per=None, csv_like=True).drop("_bronze_path", "_src_row")
    typed, _ = infer.infer_and_cast(cleaned, cfg=FX.cfg())
    return typed


@register("xml_roundtrip", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""")
def q_xml_roundtrip(spark, d):
    """Customer written as XML record files and read back as text columns."""
    from starforge.sources.readers import read_group
    root = _scratch(spark, "xml")
    (FX.table(spark, d, "customer").repartition(3).write.format("xml").option("rowTag", "record")
     .option("rootTag", "customers").save(f"{root}/tpch/customer_2026"))
    raw = read_group(spark, _bronze_files(spark, root), ".xml", root)
    return raw.drop("_bronze_path", "_src_row")


def _one_array(batches):
    """The JSON records of a partition as the lines of one array."""
    import pyarrow as pa
    begin = "["
    for batch in batches:
        lines = batch.column("value").to_pylist()
        if lines:
            yield pa.RecordBatch.from_pydict({"value": [begin + lines[0], *("," + x for x in lines[1:])]})
            begin = ","
    yield pa.RecordBatch.from_pydict({"value": ["[]" if begin == "[" else "]"]})


@register("json_roundtrip", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""")
def q_json_roundtrip(spark, d):
    """Customer written half as JSON lines, half as files of one array each, read back as one group
    in ranges smaller than the files."""
    from starforge.sources.readers import read_json, scanned_files
    root = _scratch(spark, "json")
    c = FX.table(spark, d, "customer")
    files = max(3, -(-c.count() // 100_000))        # of either kind, about 50,000 rows each
    c.where(F.col("c_custkey") % 2 == 0).repartition(files).write.json(f"{root}/tpch/customer_2025")
    c.where(F.col("c_custkey") % 2 == 1).repartition(files).select(F.to_json(F.struct(*c.columns)).alias("value")) \
        .mapInArrow(_one_array, "value string").write.text(f"{root}/tpch/customer_2026")
    paths = _bronze_files(spark, root)
    return read_json(spark, paths, root, scanned=scanned_files(spark, paths, ".json", range_bytes=LEAF // 4, leaf=LEAF // 4)).drop("_bronze_path", "_src_row")
