"""End-to-end jobs: Bronze files -> Silver Parquet -> Gold star -> cuboids -> validation.

Every step is a set of DataFrame jobs; the driver only handles metadata
(file lists per entity, column labels, mapping decisions, table names).
Tables live in a versioned ``TableStore`` under one shared root.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from collections import Counter
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge import config as C
from starforge.operators import clean, cube, harmonize, incremental, infer, profile, star, validate
from starforge.operators.ingest import file_lineage, gate, review_queue, status_summary
from starforge.operators.lineage import add_lineage
from starforge.sources import catalog as CAT
from starforge.sources.readers import header_names, read_group
from starforge.session import ensure_checkpoint_dir
from starforge.sources.sinks import TableStore, check_unique, write_partitioned

CSV_LIKE = (".csv", ".xlsx", ".xls")
# ``attempt`` names one run of the job. Rows of an attempt count only for the files that
# ``silver_outputs`` ascribes to it, so a run that failed half-way, or the rows of a file
# that has changed since, are never read.
SILVER_PARTITIONS = ["domain", "entity", "year", "month", "attempt"]


_TIMING = os.environ.get("STARFORGE_TIMING") == "1"


class _Clock:
    """Wall-clock per pipeline phase on stderr when STARFORGE_TIMING=1."""

    def __init__(self):
        self.t = time.perf_counter()

    def mark(self, name: str) -> None:
        if _TIMING:
            print(f"[starforge] {name}: {time.perf_counter() - self.t:.2f}s", file=sys.stderr, flush=True)
        self.t = time.perf_counter()


@dataclass
class RunResult:
    catalog: DataFrame
    results: DataFrame
    mappings: list = field(default_factory=list)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def bronze_to_silver(spark: SparkSession, bronze_root: str, silver_root: str, store: TableStore,
                     cfg: C.Config, run_id: str, size_limit: int | None = None,
                     new_files: DataFrame | None = None) -> RunResult:
    """S1-S14, P1-P9, T0-T5, H1-H9, Q-profile, S20-S22 for one Bronze root.

    ``new_files`` (path, uri, size_bytes, mtime) restricts the run to some files, e.g. those
    of one streaming micro-batch; no other file is listed or read.
    """
    clock = _Clock()
    attempt = uuid.uuid4().hex
    known = store.read("catalog")
    known = None if known is None else CAT.latest(known)
    catalog = CAT.with_source_date(CAT.build(spark, bronze_root, known) if new_files is None else CAT.update(new_files, known))
    # Checkpoint, not cache: this run appends to the tables these plans read
    # (catalog, silver_outputs), and a write refreshes cached plans over its
    # path - the gate would be re-evaluated against its own outputs.
    ensure_checkpoint_dir(spark)
    catalog = catalog.checkpoint(eager=True)
    existing = store.read("silver_outputs")
    gated = gate(catalog, existing, size_limit).checkpoint(eager=True)
    todo = gated.where(F.col("status") == "SUCCESS").select("path", "domain", "entity", "format", "utf8", "header").collect()
    headers = {r["path"]: bytes(r["header"]).decode("utf-8" if r["utf8"] else "latin-1") for r in todo if r["format"] == ".csv" and r["header"] is not None}
    groups: dict[tuple[str, str], dict[str, list[str]]] = {}
    for r in todo:     # one row per file: metadata, bounded by the number of files
        groups.setdefault((r["domain"], r["entity"]), {}).setdefault(r["format"], []).append(
            f"{bronze_root.rstrip('/')}/{r['path']}")

    memory = store.read("mapping_memory")
    if memory is None:
        memory = C.empty_memory(spark)
    memory = memory.checkpoint(eager=True)
    clock.mark("catalog+gate")
    keys = sorted(groups)
    raw_of, clean_of = {}, {}
    for key in keys:                         # lazy reads, one per (format, header) group
        raw_parts, clean_parts = [], []
        for fmt, paths in sorted(groups[key].items()):
            raw = read_group(spark, paths, fmt, bronze_root, catalog)
            raw_parts.append(raw)
            clean_parts.append(clean.clean(raw, per=["_bronze_path"], csv_like=fmt in CSV_LIKE))
        raw_of[key], clean_of[key] = _union(raw_parts), _union(clean_parts)
    clock.mark("reads")

    # pass 1 - T0-T5 for every entity in one job, H1-H9 for every entity in one job
    decided = infer.labels_many({k: (clean_of[k], [c for c in clean_of[k].columns if not c.startswith("_")])
                                 for k in keys}, cfg, {k: clean.normalize_names(raw_of[k]) for k in keys})
    typed = {k: infer.cast(clean_of[k], decided[k], cfg) for k in keys}
    clock.mark("types")
    renamed, mapping = harmonize.harmonize_many(typed, cfg, memory)
    clock.mark("harmonize")
    decisions = mapping.collect() if mapping is not None else []          # local table
    unsure: dict = {k: set() for k in keys}
    final = {k: {} for k in keys}
    for r in decisions:
        if r["needs_review"]:
            unsure[(r["domain"], r["entity"])].add(r["raw_column"])
        final[(r["domain"], r["entity"])][r["raw_column"]] = r["final_column"]

    # pass 2 - write Silver; everything below reads the written Silver (pruned
    # Parquet, this run only) instead of re-reading and re-cleaning Bronze
    # A file is flagged for the columns it has itself (by its header; without one for any of its entity's)
    flags = []
    for r in todo:
        key = (r["domain"], r["entity"])
        own = set(clean.names_of(header_names(headers[r["path"]]))) if r["path"] in headers else final[key].keys()
        flags.append((r["path"], bool(own & unsure[key])))
    flagged = C.local_df(spark, flags, "_bronze_path string, flagged boolean") if flags else None
    parts = catalog.select(F.col("path").alias("_bronze_path"), "year", "month")
    if flagged is not None:
        parts = parts.join(flagged, "_bronze_path", "left")
    silver_cols, schemas = {}, {}
    for key in keys:
        domain, entity = key
        silver = add_lineage(renamed[key], catalog, run_id)
        silver_cols[key] = [c for c in silver.columns if c != "_src_row"]
        schemas[key] = silver.schema
        out = silver.join(parts, "_bronze_path", "left").withColumn("_needs_review", F.col("_needs_review") | F.coalesce("flagged", F.lit(False))).drop("flagged").withColumns(
            {"domain": F.lit(domain), "entity": F.lit(entity), "attempt": F.lit(attempt)})
        write_partitioned(out, silver_root, SILVER_PARTITIONS, mode="append")
        clock.mark(f"write {domain}.{entity}")

    per_file = []
    if keys:
        store.append("silver_schemas", C.local_df(spark, [(k[0], k[1], attempt, schemas[k].json()) for k in keys],
                                                  "domain string, entity string, attempt string, schema string"))
        written = {k: _silver_files(spark, silver_root, k, schemas[k], [attempt]).select(*silver_cols[k]) for k in keys}
        # three small per-file tables, each computed once for all entities
        raw_counts = _union([_raw_counts(raw_of[k], any(f in CSV_LIKE for f in groups[k]))
                             for k in keys]).checkpoint(eager=True)
        out_counts = _union([written[k].groupBy("_bronze_path").agg(F.count(F.lit(1)).alias("rows_out"))
                             for k in keys]).join(flagged.withColumnRenamed("flagged", "needs_review"), "_bronze_path", "left").checkpoint(eager=True)
        nulls = _union([profile.null_profile(written[k], by=["_bronze_path"]).withColumns(
            {"domain": F.lit(k[0]), "entity": F.lit(k[1])}) for k in keys]).checkpoint(eager=True)
        # Q5 column profile: null % + type label + mapping decision
        labels = C.local_df(spark, [(k[0], k[1], final[k].get(c, c), v[0]) for k in keys for c, v in decided[k].items()],
                            "domain string, entity string, column string, type_label string")
        maps = mapping.select("domain", "entity", F.col("final_column").alias("column"),
                              F.col("raw_column").alias("mapped_from"), "method")
        ke = ["domain", "entity", "column"]
        prof_cols = (nulls.withColumnRenamed("_bronze_path", "source_file")
                     .join(F.broadcast(labels), ke, "left").join(F.broadcast(maps), ke, "left"))
        n_cols = C.local_df(spark, [(k[0], k[1], len(silver_cols[k]) - 1) for k in keys],
                            "domain string, entity string, column_count int")
        removed = raw_counts.join(out_counts, "_bronze_path").select(
            "_bronze_path", (F.col("n_nonempty") - F.col("rows_out")).alias("duplicates_removed"))
        prof_sum = (nulls.groupBy("domain", "entity", "_bronze_path")
                    .agg(F.max("rows").alias("row_count"), F.round(100 - F.avg("null_pct"), 2).alias("completeness"))
                    .join(F.broadcast(n_cols), ["domain", "entity"], "left")
                    .join(removed, "_bronze_path", "left").withColumnRenamed("_bronze_path", "source_file"))
        # Q4: drift of every entity against its previous load, one job
        prev = store.read("profile_columns")
        if prev is not None:
            cur = C.local_df(spark, [(k[0], k[1], c) for k in keys for c in silver_cols[k] if c != "_bronze_path"],
                             "domain string, entity string, column string")
            last = prev.groupBy("domain", "entity").agg(F.max("recorded_at").alias("recorded_at"))
            store.append("schema_drift", profile.drift(prev.join(last, ["domain", "entity", "recorded_at"], "left_semi"), cur,
                                                       ["domain", "entity"]).withColumn("run_id", F.lit(run_id)))
        now = datetime.now(timezone.utc)        # one moment for all rows of a run
        store.append("profile_columns", prof_cols.withColumns({"run_id": F.lit(run_id), "recorded_at": F.lit(now)}))
        store.append("profile_summary", prof_sum.withColumn("run_id", F.lit(run_id)))
        per_file = [out_counts.join(raw_counts.select("_bronze_path", "rows_in"), "_bronze_path", "right")
                    .withColumnRenamed("_bronze_path", "path")]
    mappings = [mapping] if mapping is not None else []

    counts = _union(per_file) if per_file else None
    results = gated
    if counts is not None:
        results = results.join(counts, "path", "left")
    else:
        results = results.withColumns({"rows_in": F.lit(None).cast("bigint"), "rows_out": F.lit(None).cast("bigint"),
                                       "needs_review": F.lit(None).cast("boolean")})
    # one row per file, read by three appends below: computed once
    results = results.withColumn("run_id", F.lit(run_id)).checkpoint(eager=True)

    # unstructured pass-through (S13): bytes + lineage, partitioned like Silver
    copied = gated.where(F.col("status") == "COPIED").select("path").collect()
    if copied:
        binf = spark.read.format("binaryFile").load([f"{bronze_root.rstrip('/')}/{r['path']}" for r in copied])
        b = binf.select(F.regexp_replace("path", r"^.*?" + CAT._quote(bronze_root.rstrip("/")) + "/", "").alias("path"),
                        "content")
        b = b.join(catalog.select("path", "domain", "entity", "year", "month", "checksum", F.lit(attempt).alias("attempt")), "path")
        write_partitioned(b.withColumnRenamed("path", "_bronze_path"), f"{silver_root}/_binary", SILVER_PARTITIONS)

    # logs and state (append-only / new versions)
    if mappings:
        resolved = _union(mappings)
        # against the last version, which another run may have written since this one read it
        store.update("mapping_memory", lambda last: harmonize.upsert_memory(memory if last is None else last, resolved))
    # publishing: one row per path; what this attempt wrote counts from here on
    done = results.where(F.col("status").isin("SUCCESS", "COPIED")).select(
        "path", F.col("checksum").alias("out_checksum"), F.lit(attempt).alias("attempt"), F.current_timestamp().alias("written_at"))
    store.update("silver_outputs", lambda last: _replaced(last, done))
    store.append("processing_log", results.drop("on_disk", "out_checksum", "uri", *[c for c in CAT.FOUND if c != "checksum"]))
    store.append("lineage_log", file_lineage(results, run_id, silver_root))
    store.append("review_queue", review_queue(results).select("run_id", "path", "domain", "entity", "status", "needs_review"))
    if new_files is None or known is None:
        store.replace("catalog", catalog)
    else:
        # new and changed files only; CAT.latest reads the last row of a path
        store.append("catalog", catalog.join(known.select("path", "size_bytes", "mtime"), ["path", "size_bytes", "mtime"], "left_anti").select(*known.columns))
    clock.mark("profiles+logs")
    return RunResult(catalog, results, mappings)


def _replaced(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """``old`` with the rows of the paths in ``new`` replaced by ``new``'s."""
    if old is None:
        return new
    return old.join(new.select("path"), "path", "left_anti").unionByName(new, allowMissingColumns=True)


def _silver_files(spark: SparkSession, silver_root: str, key: tuple[str, str], schema: T.StructType, attempts: list[str]) -> DataFrame:
    """The rows that some attempts, which shared a schema, wrote for one entity."""
    whole = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in SILVER_PARTITIONS]])
    return (spark.read.schema(whole).option("basePath", silver_root)
            .parquet(f"{silver_root}/domain={key[0]}/entity={key[1]}").where(F.col("attempt").isin(attempts)))


def widest(types: list[T.DataType]) -> T.DataType:
    """The type that holds all of ``types`` without loss of rows: one type stays, numbers
    become long or double, dates timestamps, anything else text."""
    if len(set(types)) == 1:
        return types[0]
    if all(star.type_class(t) == "numeric" for t in types):
        whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
        return T.LongType() if all(isinstance(t, whole) for t in types) else T.DoubleType()
    if all(star.type_class(t) == "datetime" for t in types):
        return T.TimestampType()
    return T.StringType()


def widened_union(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column whose type differs gets the widest one."""
    types: dict[str, list[T.DataType]] = {}
    for df in frames:
        for f in df.schema.fields:
            types.setdefault(f.name, []).append(f.dataType)
    wide = {c: widest(t) for c, t in types.items()}
    return _union([df.select(*[F.col(f"`{c}`").cast(wide[c]).alias(c) for c in df.columns]) for df in frames])


def silver_entities(spark: SparkSession, silver_root: str, store: TableStore, keys: list[tuple[str, str]] | None = None,
                    applied: dict[tuple[str, str], set[str]] | None = None) -> dict[tuple[str, str], DataFrame]:
    """One DataFrame per (domain, entity) of the published rows; attempts are read by
    schema, and a column whose type changed between runs is widened. With ``applied`` the rows of these
    attempts are left out and not read; the columns and types stay those of all attempts."""
    schemas, outputs = store.read("silver_schemas"), store.read("silver_outputs")
    if schemas is None or outputs is None:
        return {}
    live = outputs.select(F.col("path").alias("_bronze_path"), "attempt")
    used = schemas.join(outputs.select("attempt").distinct(), "attempt", "left_semi").collect()     # a row per run and entity
    groups: dict[tuple[str, str], dict[str, list[str]]] = {}
    for r in used:
        groups.setdefault((r["domain"], r["entity"]), {}).setdefault(r["schema"], []).append(r["attempt"])
    out = {}
    for key in sorted(groups if keys is None else keys):
        frames = []
        for schema, attempts in sorted(groups[key].items()):
            wanted = sorted(set(attempts) - (applied or {}).get(key, set()))
            shape = T.StructType.fromJson(json.loads(schema))
            frames.append(_silver_files(spark, silver_root, key, shape, wanted).join(live, ["_bronze_path", "attempt"], "left_semi").drop(*SILVER_PARTITIONS)
                          if wanted else spark.createDataFrame([], shape))
        out[key] = widened_union(frames)
    return out


def _store_new(store: TableStore, name: str, old: DataFrame | None, appended: DataFrame, unique: list[str],
               sort_within: list[str] | None = None) -> None:
    """Append what is new; the table is rewritten when a column's type has widened.
    Each column of ``unique`` must hold no value twice among the new rows."""
    for column in unique:
        check_unique(appended, [column])
    if old is None:
        store.replace(name, appended, sort_within=sort_within)
    elif dict(old.dtypes) == dict(appended.dtypes):
        store.append(name, appended)
    else:
        store.replace(name, widened_union([old, appended]), sort_within=sort_within)


def _raw_counts(raw: DataFrame, csv_like: bool) -> DataFrame:
    """Per file: rows read and rows left after P1-P4 (before de-duplication)."""
    cleaned = raw.transform(clean.normalize_names)
    if csv_like:
        cleaned = clean.na_tokens(cleaned)
    cleaned = clean.trim_strings(cleaned)
    business = [c for c in cleaned.columns if not c.startswith("_")]
    nonempty = F.greatest(*[F.col(f"`{c}`").isNotNull() for c in business]) if len(business) > 1 else \
        F.col(f"`{business[0]}`").isNotNull()
    return cleaned.groupBy("_bronze_path").agg(F.count(F.lit(1)).alias("rows_in"),
                                               F.count_if(nonempty).alias("n_nonempty"))


class GoldState:
    """Which attempts each Gold table has taken in (table ``gold_state``: name, attempt, status, last_id).

    A load is noted as pending before its table is written and as applied after its index is. A table
    whose last load is still pending may or may not hold it: its index is then made anew from the table
    itself, and the load is repeated against that. So a run after a failure gives no row twice and every
    row the key it had."""

    def __init__(self, spark: SparkSession, store: TableStore):
        self.spark, self.store = spark, store
        state = store.read("gold_state")
        self.applied: dict[str, set[str]] = {}
        self.open: set[str] = set()
        self.last_id: dict[str, int] = {}
        for r in sorted(state.collect() if state is not None else [], key=lambda r: r["at"]):       # a row per table, run and status
            if r["status"] == "pending":
                self.open.add(r["name"])
            else:
                self.open.discard(r["name"])
                self.applied.setdefault(r["name"], set()).update(r["attempts"])
                self.last_id[r["name"]] = r["last_id"]

    def note(self, name: str, attempts: set[str], status: str, last_id: int | None = None) -> None:
        row = (name, sorted(attempts), status, last_id, datetime.now(timezone.utc))
        self.store.append("gold_state", C.local_df(self.spark, [row], "name string, attempts array<string>, status string, last_id long, at timestamp"))

    def load_fact(self, name: str, batch: DataFrame, attempts: set[str], full_reload: bool) -> None:
        """I3 with the checksum index: only the index buckets of the batch's checksums are read."""
        index, old = f"keys_{name}", None if full_reload else self.store.read(name)
        self.note(name, attempts, "pending")
        known = last_id = None
        if old is not None:
            stored = self.store.read(index)
            if stored is None or name in self.open or name not in self.last_id:
                self.store.replace(index, incremental.index_rows(old), partition_by=[incremental.BUCKET])
                stored, last_id = self.store.read(index), incremental.max_key(old, "fact_id")
            else:
                last_id = self.last_id[name]
            known = incremental.touched(stored, batch)
        _, appended = incremental.load_fact(old, batch, full_reload, known=known, last_id=last_id)
        appended = appended.drop("_src_row").checkpoint(eager=True)        # written twice below, and must be one thing
        n = appended.count()
        if n or old is None:
            _store_new(self.store, name, old, appended, ["fact_id", "_row_checksum"],
                       sort_within=[c for c in appended.columns if c.endswith("_date_key")][:1] or None)
            rows = incremental.index_rows(appended)
            if old is None:
                self.store.replace(index, rows, partition_by=[incremental.BUCKET])
            else:
                self.store.append(index, rows, partition_by=[incremental.BUCKET])
        self.note(name, attempts, "applied", (last_id or 0) + n)


def silver_to_gold(spark: SparkSession, silver_root: str, store: TableStore, cfg: C.Config,
                   full_reload: bool = False) -> DataFrame:
    """Classify, dim_date, dimensions, facts; returns a manifest.

    Change propagation: each table takes in the published attempts it has not applied yet; Silver rows of
    other attempts are not read (but for boolean columns, whose NULLs decide a class), and a
    table without a new attempt is left alone."""
    ents = silver_entities(spark, silver_root, store)
    if not ents:
        raise ValueError("no Silver entities")
    cats = [star.column_catalog(df, d, e) for (d, e), df in ents.items()]
    classes = {(r["domain"], r["entity"]): r["class"] for r in
               star.classify(_union(cats), cfg.override_df(spark)).collect()}
    state = GoldState(spark, store)
    shared = Counter(e for (d, e) in ents if classes[(d, e)] == "dimension")
    # an entity of several domains is qualified
    name_of = {(d, e): f"fact_{d}_{e}" if classes[(d, e)] == "fact" else f"dim_{e if shared[e] == 1 else f'{d}_{e}'}" for d, e in ents}
    live: dict[tuple[str, str], set[str]] = {}
    outputs = store.read("silver_outputs").select("attempt").distinct()
    for r in store.read("silver_schemas").join(outputs, "attempt", "left_semi").select("domain", "entity", "attempt").collect():     # a row per run and entity
        live.setdefault((r["domain"], r["entity"]), set()).add(r["attempt"])
    applied = {} if full_reload else {k: state.applied.get(n, set()) if n not in state.open and store.exists(n) else set() for k, n in name_of.items()}
    new = {k: live[k] - applied.get(k, set()) for k in ents}
    changed = [k for k in ents if new[k]]
    fresh = silver_entities(spark, silver_root, store, changed, applied) if changed else {}
    manifest = []
    frames = [(df, star.datetime_columns(df)) for df in fresh.values()]
    if any(c for _, c in frames):
        dd = star.dim_date([(f, c) for f, c in frames if c])
        old = None if full_reload else store.read("dim_date")
        full, appended = incremental.load_dim_date(old, dd, full_reload)
        (store.replace if old is None else store.append)("dim_date", appended)
    if store.exists("dim_date"):
        manifest.append(("dim_date", "dim", None))
    dims: dict[tuple[str, str], tuple[str, DataFrame, str]] = {}
    for (d, e), df in ents.items():
        if classes[(d, e)] != "dimension":
            continue
        table = name_of[(d, e)]
        name, nat = table[len("dim_"):], star.natural_id(df)
        if (d, e) in fresh:
            dim, _ = star.dimension(fresh[(d, e)], nat)
            state.note(table, new[(d, e)], "pending")
            old = None if full_reload else store.read(table)
            full, appended = incremental.load_dimension(old, dim, name, nat, full_reload)
            _store_new(store, table, old, appended, [f"{name}_key", nat])
            state.note(table, new[(d, e)], "applied")
        dims[(d, e)] = (name, store.read(table), nat)
        manifest.append((table, "dim", None))
    for (d, e), df in ents.items():
        if classes[(d, e)] != "fact":
            continue
        table = name_of[(d, e)]
        if (d, e) in fresh:
            f = star.fact(fresh[(d, e)], e, {n: (dim, nat) for (_, entity), (n, dim, nat) in dims.items() if entity != e})
            state.load_fact(table, f, new[(d, e)], full_reload)
        manifest.append((table, "fact", None))
    rows = [(n, k, fct, store.read(n).count()) for n, k, fct in manifest]   # footer counts
    return C.local_df(spark, rows, "name string, kind string, fact string, rows long")


def gold_olap(spark: SparkSession, store: TableStore, reference_measures: bool = False, keep_unchanged: bool = False) -> DataFrame:
    """The lattice of every fact, written partitioned by cuboid. ``keep_unchanged``: cuboids made from
    all attempts their fact has applied stay as they are."""
    names, state = store.names(), GoldState(spark, store)
    dim_keys = {f"{n[len('dim_'):]}_key" for n in names if n.startswith("dim_") and n != "dim_date"}
    rows = []
    for n in names:
        if not n.startswith("fact_"):
            continue
        applied = state.applied.get(n, set())
        if keep_unchanged and applied and applied == state.applied.get(f"cuboids_{n}") and n not in state.open and store.exists(f"cuboids_{n}"):
            counts = store.read(f"cuboids_{n}").groupBy("cuboid").count().collect()     # one row per cuboid
            rows += [(f"cuboid_{n}_{r['cuboid']}", "cuboid", n, r["count"]) for r in counts]
            continue
        f = store.read(n)
        keys = sorted(set(f.columns) & dim_keys)
        date_keys = cube.date_key_columns(f, sorted(dim_keys))
        ms = cube.measures(f, reference_measures)
        if f.isEmpty():
            # An empty fact still gets an apex (count 0), so validation sees it
            lat = cube.lattice(f, [], None, ms)
        else:
            sizes = {k: store.read(f"dim_{k[:-len('_key')]}").count() for k in keys}      # footer counts
            lat = cube.lattice_by_parents(f, keys, date_keys[0] if date_keys else None, ms, sizes)
        # partitioned on write: every task writes its share of every cuboid, so
        # a large cuboid never lands in one task
        path = store.replace(f"cuboids_{n}", lat, partition_by=["cuboid"])
        state.note(f"cuboids_{n}", applied, "applied")
        counts = spark.read.parquet(path).groupBy("cuboid").count().collect()   # one row per cuboid
        rows += [(f"cuboid_{n}_{r['cuboid']}", "cuboid", n, r["count"]) for r in counts]
    return C.local_df(spark, rows, "name string, kind string, fact string, rows long")


def validate_gold(spark: SparkSession, store: TableStore, manifest: DataFrame) -> DataFrame:
    """V1-V4: the manifest, and every cuboid of every fact against the fact."""
    findings = [validate.manifest_findings(manifest)]
    dim_keys = {f"{n[len('dim_'):]}_key" for n in store.names() if n.startswith("dim_") and n != "dim_date"}
    for r in manifest.where(F.col("kind") == "fact").collect():
        lat = store.read(f"cuboids_{r['name']}")
        f = store.read(r["name"])
        if lat is None:
            continue
        ms = [m for m in (c[:-4] for c in lat.columns if c.endswith("_sum")) if m in f.columns]
        keys = sorted(set(f.columns) & dim_keys & set(lat.columns))
        date_keys = cube.date_key_columns(f, sorted(dim_keys)) if "year" in lat.columns else []
        chk = validate.lattice_check(f, lat, keys, date_keys[0] if date_keys else None, ms)
        findings.append(chk.where(~F.col("ok")).select(
            F.concat(F.lit(f"cuboid_{r['name']}_"), F.col("cuboid"), F.lit(": measure '"), F.col("measure"), F.lit("' mismatch")).alias("finding")))
    return _union(findings)


def run(spark: SparkSession, bronze_root: str, lake_root: str, cfg: C.Config | None = None,
        run_id: str = "run", full_reload: bool = False, size_limit: int | None = None, strict: bool = False) -> dict:
    """The whole pipeline; returns summary DataFrames. ``strict`` raises if validation
    finds anything (the findings are stored either way)."""
    cfg = cfg or C.Config.load()
    store = TableStore(spark, f"{lake_root.rstrip('/')}/tables")
    silver_root = f"{lake_root.rstrip('/')}/silver"
    res = bronze_to_silver(spark, bronze_root, silver_root, store, cfg, run_id, size_limit)
    out = {"status": status_summary(res.results)}
    try:
        manifest = silver_to_gold(spark, silver_root, store, cfg, full_reload)
    except ValueError:
        return out
    cubes = gold_olap(spark, store, keep_unchanged=not full_reload)
    manifest = manifest.unionByName(cubes)
    store.replace("validation_findings", validate_gold(spark, store, manifest))
    out.update(manifest=manifest, findings=store.read("validation_findings"))
    if strict:
        validate.raise_on_findings(out["findings"])
    return out
