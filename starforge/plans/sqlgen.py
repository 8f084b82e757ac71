"""SQL text for the oracle side (DuckDB dialect), generated from the same
configuration the Spark operators use."""

from __future__ import annotations

import re

from starforge import config as C
from starforge.functions.dates import STRPTIME_FORMATS
from starforge.functions.names import normalize_name
from starforge.operators.infer import INTEGER_PATTERN, NUMBER_PATTERN
from starforge.plans import fixtures as FX


def q(s) -> str:
    if s is None:
        return "NULL"
    if isinstance(s, bool):
        return "TRUE" if s else "FALSE"
    if isinstance(s, (int, float)):
        return repr(s)
    return "'" + str(s).replace("'", "''") + "'"


def ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def values(rows: list[tuple], cols: list[str]) -> str:
    body = ", ".join("(" + ", ".join(q(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(cols)}))"


def normalize_sql(e: str) -> str:
    s = f"regexp_replace(regexp_replace(lower(trim({e})), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"
    return f"(CASE WHEN {s} = '' THEN 'unnamed' ELSE {s} END)"


def parse_dt_sql(e: str) -> str:
    return "coalesce(" + ", ".join(f"try_strptime({e}, {q(f)})" for f in STRPTIME_FORMATS) + ")"


def num_sql(e: str) -> str:
    return f"(CASE WHEN regexp_matches(trim({e}), {q(NUMBER_PATTERN)}) THEN TRY_CAST(trim({e}) AS DOUBLE) END)"


def int_sql(e: str) -> str:
    return f"(CASE WHEN regexp_matches(trim({e}), {q(INTEGER_PATTERN)}) THEN TRY_CAST(trim({e}) AS BIGINT) END)"


def bool_sql(e: str, cfg: C.Config) -> str:
    t = f"lower(trim({e}))"
    tv = ", ".join(q(v) for v in cfg.true_values)
    fv = ", ".join(q(v) for v in cfg.false_values)
    return f"(CASE WHEN {t} IN ({tv}) THEN TRUE WHEN {t} IN ({fv}) THEN FALSE END)"


def catalog_sql() -> str:
    """SQL form of ``fixtures.col_catalog``: one row per column with statistics."""
    rules = FX.cfg().range_rules
    parts = []
    ents = [(FX.DOMAIN, e, e, [(n, n, t) for n, t in FX.DRIVER_SCHEMAS[e]]) for e in FX.STAR_ENTITIES]
    ents.append(("unknown", "export", "lineitem", [(n, e, t) for n, (e, t) in FX.EXPORT_SQL.items()]))
    for domain, entity, src, cols in ents:
        for pos, (name, expr, tc) in enumerate(cols):
            if re.match(C.UNNAMED_COLUMN_PATTERN, normalize_name(name)):
                v = num_sql(f"CAST({expr} AS VARCHAR)")
                num = f"count({v})"
                rng = [f"count(CASE WHEN {v} BETWEEN {lo} AND {hi} THEN 1 END)" for lo, hi, _ in rules]
            else:
                num = "CAST(NULL AS BIGINT)"
                rng = ["CAST(NULL AS BIGINT)" for _ in rules]
            rcols = ", ".join(f"{r} AS r{j}" for j, r in enumerate(rng))
            parts.append(
                f"SELECT {q(domain)} AS domain, {q(entity)} AS entity, {q(name)} AS raw_column, {pos} AS position, "
                f"{q(tc)} AS type_class, count(*) AS n_rows, count({expr}) AS nonnull, {num} AS num_values, {rcols} "
                f"FROM {src}")
    return "col_catalog AS (\n  " + "\n  UNION ALL ".join(parts) + "\n)"


def memory_sql() -> str:
    rows = [r + (FX.CLOCK_0, FX.CLOCK_0) for r in FX.MEMORY_ROWS]
    v = values(rows, ["domain", "entity", "raw_column", "mapped_column", "method", "approved", "fs", "ls"])
    return (f"memory AS (SELECT domain, entity, raw_column, mapped_column, method, approved, "
            f"CAST(fs AS TIMESTAMP) AS first_seen, CAST(ls AS TIMESTAMP) AS last_seen FROM {v})")


def harmonize_sql() -> str:
    """CTEs col_catalog, memory, alias_hit, resolved (the H-pipeline in SQL)."""
    cfg = FX.cfg()
    alias = values(cfg.alias_rows(), ["domain", "entity", "canonical", "canon_order", "alias_norm"])
    name_case = " ".join(
        f"WHEN instr(c.raw_norm, {q(k)}) > 0 THEN {q(v) if v is not None else 'CAST(NULL AS VARCHAR)'}"
        for k, v in cfg.name_rules)
    range_case = " ".join(f"WHEN c.r{j} / c.num_values > 0.9 THEN {q(m)}" for j, (_, _, m) in enumerate(cfg.range_rules))
    review = ", ".join(q(m) for m in C.NEEDS_REVIEW_METHODS)
    return f"""{catalog_sql()},
{memory_sql()},
alias_hit AS (
  SELECT domain, entity, alias_norm AS raw_norm, arg_min(canonical, canon_order) AS alias_mapped
  FROM {alias} GROUP BY domain, entity, alias_norm
),
cat_n AS (
  SELECT *, {normalize_sql('raw_column')} AS raw_norm FROM col_catalog WHERE NOT starts_with(raw_column, '_')
),
cand AS (
  SELECT c.*, m.mapped_column AS mem_mapped, a.alias_mapped,
         CASE {name_case} ELSE NULL END AS name_mapped,
         CASE WHEN regexp_matches(c.raw_norm, {q(C.UNNAMED_COLUMN_PATTERN)}) AND c.num_values IS NOT NULL
                   AND c.num_values >= greatest(3.0, c.n_rows * 0.5)
              THEN CASE {range_case} ELSE NULL END END AS range_mapped
  FROM cat_n c
  LEFT JOIN (SELECT DISTINCT domain, entity, raw_column, mapped_column FROM memory WHERE approved) m
    ON c.domain = m.domain AND c.entity = m.entity AND c.raw_norm = m.raw_column
  LEFT JOIN alias_hit a ON c.domain = a.domain AND c.entity = a.entity AND c.raw_norm = a.raw_norm
),
meth AS (
  SELECT *, coalesce(mem_mapped, alias_mapped, name_mapped, range_mapped, raw_norm) AS mapped,
         CASE WHEN mem_mapped IS NOT NULL THEN 'memory' WHEN alias_mapped IS NOT NULL THEN 'alias'
              WHEN name_mapped IS NOT NULL THEN 'heuristic_name' WHEN range_mapped IS NOT NULL THEN 'heuristic_range'
              ELSE 'fallback' END AS method
  FROM cand
),
resolved AS (
  SELECT *, method IN ({review}) AS needs_review,
         CASE WHEN row_number() OVER (PARTITION BY domain, entity, mapped ORDER BY position) = 1 THEN mapped
              ELSE mapped || '_dup' || CAST(row_number() OVER (PARTITION BY domain, entity, mapped ORDER BY position) AS VARCHAR) END AS final_column
  FROM meth
)"""
