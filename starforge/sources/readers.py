"""Format readers S7-S11: one Spark read per (format, header) group, not per file.

Every reader returns string-typed business columns (typing is ``infer``)
plus ``_bronze_path`` (from ``_metadata.file_path``) and ``_src_row``, a
per-file row order used for "first row" semantics.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.config import NA_TOKENS, local_df
from starforge.functions.json import flatten
from starforge.sources.catalog import found, plain
from starforge.sources.scan import can_open, csv_records, json_elements


def _rel(path_col, root: str | None):
    if not root:
        return path_col
    r = root.rstrip("/")
    return F.regexp_replace(path_col, r"^(file:)?" + r.replace(".", r"[.]") + "/", "")


def _with_lineage(df: DataFrame, root: str | None) -> DataFrame:
    return (df.withColumn("_bronze_path", _rel(F.col("_metadata.file_path"), root))
            .withColumn("_src_row", F.monotonically_increasing_id()))


def scanned_files(spark: SparkSession, paths: list[str], fmt: str, **sizes: int) -> DataFrame:
    """The scan of some files, taken to be of one format whatever their names (see ``sources.catalog.found``, also for ``sizes``), with uri and size_bytes."""
    listing = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("uri"), F.col("length").alias("size_bytes"))
    return found(listing.withColumn("format", F.lit(fmt)), **sizes).join(listing, "uri")


def _of(scanned: DataFrame, paths: list[str]) -> DataFrame:
    """The rows of some files; joined, as a list of thousands of paths would go along with every task."""
    wanted = local_df(scanned.sparkSession, [(p,) for p in sorted({_strip_uri(p) for p in paths})], "__path string")
    return scanned.join(F.broadcast(wanted), plain(F.col("uri")) == F.col("__path"), "left_semi")


def csv_layout(scanned: DataFrame) -> dict[str, tuple[str, str, bool]]:
    """path -> (encoding, header line, fields span lines) of scanned CSV files. Files that are not
    UTF-8 are read as Latin-1."""
    out = {}
    for r in scanned.select("uri", "utf8", "header", "spans_lines").collect():      # one row per file
        encoding = "UTF-8" if r["utf8"] else "ISO-8859-1"
        out[_strip_uri(r["uri"])] = (encoding, None if r["header"] is None else bytes(r["header"]).decode(encoding), r["spans_lines"])
    return out


def header_names(header: str) -> list[str]:
    """Column names of a header line, as Spark's CSV reader gives them: an empty name is ``_c`` and its
    place, a repeated one gets its place behind it."""
    import csv
    from collections import Counter
    raw = next(csv.reader([header]), [])
    seen = Counter(n.lower() for n in raw if n)
    return [f"_c{k}" if not n else f"{n}{k}" if seen[n.lower()] > 1 else n for k, n in enumerate(raw)]


def _csv_in_ranges(scanned: DataFrame, header: str) -> DataFrame:
    """CSV files whose fields span lines, cut into records by many tasks; each record is parsed by
    Spark's own CSV parser."""
    names = header_names(header)
    ddl = ", ".join(f"c{k} string" for k in range(len(names)))
    rows = csv_records(scanned).where((F.col("at") > 0) & (F.col("record") != ""))
    parsed = rows.select("uri", "at", F.from_csv("record", ddl, {"escape": '"', "multiLine": "true"}).alias("r"))
    return parsed.select(*[F.when(~F.col(f"r.c{k}").isin(NA_TOKENS), F.col(f"r.c{k}")).alias(n) for k, n in enumerate(names)],
                         F.col("uri").alias("_bronze_path"), F.col("at").alias("_src_row"))


def read_csv(spark: SparkSession, paths: list[str], root: str | None = None, scanned: DataFrame | None = None) -> DataFrame:
    """Header row, all columns text, pandas' NA markers -> NULL.

    Files are grouped by (encoding, header line, fields span lines). A group without line breaks in
    fields is one CSV read in splits; the others are cut into records by their scan, in ranges. Groups
    are unioned by name (missing columns NULL). ``scanned``: the files' scan, if the caller has it.
    """
    scanned = _of(scanned, paths) if scanned is not None else scanned_files(spark, paths, ".csv")
    layout = csv_layout(scanned)
    by_group: dict[tuple[str, str, bool], list[str]] = {}
    for p in paths:
        by_group.setdefault(layout[_strip_uri(p)], []).append(p)
    parts = []
    for (encoding, header, multi), files in sorted(by_group.items(), key=str):
        if multi and header and can_open(files[0]):
            df = _csv_in_ranges(_of(scanned, files), header)
            parts.append(df.withColumn("_bronze_path", _rel(F.col("_bronze_path"), root)))
            continue
        df = (spark.read.option("header", True).option("inferSchema", False).option("encoding", encoding)
              .option("multiLine", multi).option("escape", '"').csv(files))
        df = df.select(*[F.when(~F.col(f"`{c}`").isin(NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in df.columns],
                       "_metadata")
        parts.append(_with_lineage(df, root).drop("_metadata"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _strip_uri(p: str) -> str:
    return "/" + p[5:].lstrip("/") if p.startswith("file:") else p


def read_json(spark: SparkSession, paths: list[str], root: str | None = None, scanned: DataFrame | None = None) -> DataFrame:
    """JSON array of records; nested records flattened (``a.b`` -> ``a_b``), lists as JSON text.

    JSON lines are read in splits; a file of one array is cut at its elements, in ranges; only a file
    that is one other value is read whole. Spark sorts inferred fields by name; the order of the first
    record's keys is restored so "first ``_id`` column" rules see the source order.
    """
    scanned = _of(scanned, paths) if scanned is not None else scanned_files(spark, paths, ".json")
    kinds = {_strip_uri(r["uri"]): r["kind"] for r in scanned.select("uri", "kind").collect()}      # one row per file
    in_ranges = can_open(paths[0])
    parts = []
    for kind in ("array", "value", "lines"):
        files = [p for p in paths if (kinds.get(_strip_uri(p)) or "value") == kind]
        if not files:
            continue
        if kind == "array" and in_ranges:
            df = _json_in_ranges(_of(scanned, files), root)
        else:
            df = spark.read.option("multiLine", kind != "lines").option("primitivesAsString", True).json(files)
            df = _with_lineage(df.select("*", "_metadata"), root).drop("_metadata")
        order = _json_key_order(spark, files)
        flat_cols = flatten(df.drop("_bronze_path", "_src_row")).columns
        cols = sorted(flat_cols, key=lambda c: (order.get(c, order.get(c.split("_")[0], len(order))), c))
        parts.append(_json_select(df, cols))
    return _by_name(parts)


def as_text(t: T.DataType) -> T.DataType:
    """A type with its leaves as text."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in t.fields])
    return T.ArrayType(as_text(t.elementType)) if isinstance(t, T.ArrayType) else T.StringType()


def _json_in_ranges(scanned: DataFrame, root: str | None) -> DataFrame:
    """The elements of one-array files, cut out by many tasks; one pass merges their schemas. Elements
    that are no records are text in a column ``value``."""
    rows = json_elements(scanned)
    record = F.ltrim(F.regexp_replace("record", r"^[\t\r\n ]+", "")).startswith("{")
    seen = rows.agg(F.schema_of_variant_agg(F.when(record, F.try_parse_json("record"))).alias("schema"), F.max(~record).alias("bare")).first()
    parts = (seen["schema"] or "VOID").split("`")           # every other part is a quoted name
    text = "`".join(p if k % 2 else p.replace("OBJECT<", "STRUCT<") for k, p in enumerate(parts))
    schema = T._parse_datatype_string(text)
    fields = as_text(schema).fields if isinstance(schema, T.StructType) else []
    rows = rows.withColumn("__r", F.from_json("record", T.StructType(fields)))
    columns = [F.col("__r").getField(f.name).alias(f.name) for f in fields]
    if seen["bare"]:
        columns = [c for c, f in zip(columns, fields) if f.name != "value"] + [F.when(~record, F.trim("record")).alias("value")]
    return rows.select(*columns, _rel(F.col("uri"), root).alias("_bronze_path"), F.col("at").alias("_src_row"))


def _by_name(parts: list[DataFrame]) -> DataFrame:
    """Union by name; the lineage columns stay last."""
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in ("_bronze_path", "_src_row")], "_bronze_path", "_src_row")


def _json_select(df: DataFrame, cols: list[str]) -> DataFrame:
    flat = flatten(df)
    keep = [c for c in cols if c in flat.columns]
    return flat.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in keep], "_bronze_path", "_src_row")


def _json_key_order(spark: SparkSession, paths: list[str]) -> dict[str, int]:
    """Key order of the first record of the first file (a bounded head read)."""
    head = spark.read.text(paths[:1], wholetext=False).limit(200).collect()
    text = "".join(r[0] for r in head)
    import re
    keys = re.findall(r'"([^"\\]+)"\s*:', text)
    out: dict[str, int] = {}
    for k in keys:
        out.setdefault(k, len(out))
    return out


def read_xml(spark: SparkSession, paths: list[str], root: str | None = None, row_tag: str | None = None,
             scanned: DataFrame | None = None) -> DataFrame:
    """Repeated children of the root are rows; attributes and child text are columns. The row tag
    comes from the files' scan; Spark's reader then splits the files at it."""
    if row_tag:
        tags = {_strip_uri(p): row_tag for p in paths}
    else:
        scanned = _of(scanned, paths) if scanned is not None else scanned_files(spark, paths, ".xml")
        tags = {_strip_uri(r["uri"]): r["row_tag"] for r in scanned.select("uri", "row_tag").collect()}     # one row per file
    parts = []
    for tag in sorted({t for t in tags.values() if t}):
        files = [p for p in paths if tags.get(_strip_uri(p)) == tag]
        df = (spark.read.format("xml").option("rowTag", tag).option("attributePrefix", "")
              .option("inferSchema", False).load(files))
        df = _with_lineage(df.select("*", "_metadata"), root).drop("_metadata")
        business = [c for c in df.columns if c not in ("_bronze_path", "_src_row")]
        parts.append(df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in business], "_bronze_path", "_src_row"))
    if not parts:
        raise ValueError(f"no row tag in any of {len(paths)} XML files")
    return _by_name(parts)


XLSX_CELL_SCHEMA = "path string, sheet int, row int, col int, value string"


def _xlsx_cells(batches):
    """Workbook bytes -> (path, sheet, row, col, value) cells (stdlib zip + XML)."""
    import io
    import re
    import zipfile
    import xml.etree.ElementTree as ET

    import pandas as pd

    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}

    def col_index(ref):
        letters = re.match(r"[A-Z]+", ref).group(0)
        n = 0
        for ch in letters:
            n = n * 26 + (ord(ch) - 64)
        return n - 1

    for pdf in batches:
        out = []
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                z = zipfile.ZipFile(io.BytesIO(content))
            except zipfile.BadZipFile:
                continue
            shared = []
            if "xl/sharedStrings.xml" in z.namelist():
                for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns):
                    shared.append("".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")))
            sheets = sorted((n for n in z.namelist() if re.match(r"xl/worksheets/[^/]+\.xml$", n)),
                            key=lambda n: [int(x) for x in re.findall(r"\d+", n)] or [0])
            if {"xl/workbook.xml", "xl/_rels/workbook.xml.rels"} <= set(z.namelist()):      # the workbook's own order
                target = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
                rel = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
                named = [target.get(s.get(rel), "") for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{{{ns['m']}}}sheet")]
                ordered = [n.lstrip("/") if n.startswith("/") else f"xl/{n}" for n in named]
                sheets = [n for n in ordered if n in sheets] or sheets
            for si, name in enumerate(sheets):
                root = ET.fromstring(z.read(name))
                for r_i, row in enumerate(root.iter(f"{{{ns['m']}}}row")):
                    for c in row.findall("m:c", ns):
                        v = c.find("m:v", ns)
                        is_ = c.find("m:is", ns)
                        if c.get("t") == "s" and v is not None:
                            val = shared[int(v.text)]
                        elif c.get("t") == "inlineStr" and is_ is not None:
                            val = "".join(t.text or "" for t in is_.iter(f"{{{ns['m']}}}t"))
                        else:
                            val = v.text if v is not None else None
                        if val is not None:
                            out.append((path, si, r_i, col_index(c.get("r")), val))
        yield pd.DataFrame(out, columns=["path", "sheet", "row", "col", "value"])


def read_xlsx(spark: SparkSession, paths: list[str], root: str | None = None) -> DataFrame:
    """First sheet of each workbook that has rows below its header; a header name that
    repeats gets the suffix ``.1``, ``.2``, ...

    Decoding runs on executors (``mapInPandas`` over ``binaryFile``); cells
    are then pivoted back to rows with DataFrame operations.
    """
    cells = spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(
        _xlsx_cells, XLSX_CELL_SCHEMA)
    first = cells.where(F.col("row") > 0).groupBy("path").agg(F.min("sheet").alias("sheet"))
    cells = cells.join(first, ["path", "sheet"], "left_semi")
    nth = F.row_number().over(Window.partitionBy("path", "value").orderBy("col")) - 1      # within one header
    header = cells.where(F.col("row") == 0).withColumn("nth", nth).select(
        "path", "col", F.when(F.col("nth") > 0, F.concat_ws(".", "value", "nth")).otherwise(F.col("value")).alias("name"))
    body = cells.where(F.col("row") > 0).join(header, ["path", "col"], "inner")
    # header names in column order (schema-sized metadata)
    names = [r[0] for r in header.groupBy("name").agg(F.min("col").alias("c")).orderBy("c", "name").collect()]
    wide = body.groupBy("path", "row").pivot("name", names).agg(F.first("value"))
    out = wide.select(*[F.col(f"`{n}`") for n in names],
                      _rel(F.col("path"), root).alias("_bronze_path"), F.col("row").cast("long").alias("_src_row"))
    return out


READERS = {".csv": read_csv, ".json": read_json, ".xml": read_xml, ".xlsx": read_xlsx}


def read_group(spark: SparkSession, paths: list[str], fmt: str, root: str | None = None,
               scanned: DataFrame | None = None) -> DataFrame:
    """Dispatch on the lower-cased extension. ``scanned``: rows of the catalog, if there is one."""
    if fmt not in READERS:
        raise ValueError(f"unsupported extension {fmt}")
    if fmt == ".xlsx":
        return read_xlsx(spark, paths, root)
    return READERS[fmt](spark, paths, root, scanned=scanned)
