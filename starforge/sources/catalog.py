"""Bronze catalog S1-S6 as DataFrame transforms.

Listing uses Spark's file listing (metadata only). What a file holds is found out by one pass over
byte ranges (``sources.scan``): fingerprint, encoding, header, whether it can be decoded, and where
its records can be cut. Files whose path, size and time are those of the last catalog are not read
again. ``update`` takes in some new files without looking at the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.session import ensure_checkpoint_dir
from starforge.sources import scan as SCAN

# Trailing stem tokens stripped from the entity name: 4 to 8 digits (dates
# like 2026 or 20260601); 14-digit upload stamps are stripped too.
DATE_TOKEN = r"[0-9]{4,8}|[0-9]{14}"
STRUCTURED_FORMATS = [".csv", ".xlsx", ".xls", ".json", ".xml"]
READABLE_FORMATS = [f for f in STRUCTURED_FORMATS if f != ".xls"]      # the binary format has no reader here
UNSTRUCTURED_FORMATS = [".png", ".jpg", ".jpeg", ".gif", ".mp3", ".wav", ".pdf"]

# What the scan of a file found out, kept in the catalog.
FOUND = ["checksum", "utf8", "header", "spans_lines", "kind", "row_tag", "decodable", "problem", "problem_at", "splits"]


def relative(uri: Column, root: str) -> Column:
    return F.regexp_replace(uri, r"^.*?" + _quote(root.rstrip("/").split("://")[-1]) + "/", "")


def list_files(spark: SparkSession, root: str, with_content: bool = True) -> DataFrame:
    """Every file under ``root`` -> path (relative), uri, size_bytes, mtime; ``with_content`` (S3) adds FOUND."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    out = df.select(relative(F.col("path"), root).alias("path"), F.col("path").alias("uri"),
                    F.col("length").alias("size_bytes"), F.col("modificationTime").alias("mtime"))
    return with_found(out) if with_content else out


def found(listing: DataFrame, range_bytes: int = SCAN.RANGE, leaf: int = SCAN.LEAF) -> DataFrame:
    """(uri, FOUND) of listed files, each read once in ranges; the elements of one-array JSON files and
    JSON lines are parsed where they lie."""
    spark = listing.sparkSession
    ensure_checkpoint_dir(spark)
    kind = F.col("format") if "format" in listing.columns else format_of(F.col("uri"))
    files = listing.select("uri", kind.alias("format"), "size_bytes")
    scanned = SCAN.scan(files, range_bytes, leaf).checkpoint(eager=True)       # read again below, and by the readers
    json_files = scanned.filter("decodable and kind is not null").join(files, "uri")
    rows = json_files.select("uri", "kind").collect() if not json_files.isEmpty() else []       # a row per JSON file
    problems = []
    if any(r["kind"] == "array" for r in rows) and SCAN.can_open(rows[0]["uri"]):
        problems.append(SCAN.json_problems(json_files.filter("kind = 'array'"), spark))
    for kind in ("lines", "value", *(["array"] if not problems else [])):
        paths = [r["uri"] for r in rows if r["kind"] == kind]
        if paths:
            text = spark.read.text(paths, wholetext=kind != "lines").select(F.col("_metadata.file_path").alias("file"), F.trim("value").alias("v"))
            text = text.withColumn("v", F.trim(F.regexp_replace("v", "^\ufeff", "")))
            bad = text.filter((F.col("v") != "") & F.try_parse_json("v").isNull()).select("file").distinct()
            problems.append(files.join(bad, plain(F.col("uri")) == plain(F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B")))), "left_semi")
                            .select("uri", F.lit(None).cast("long").alias("problem_at")))
    if not problems:
        return scanned
    bad = problems[0]
    for more in problems[1:]:
        bad = bad.unionByName(more)
    bad = bad.select("uri", F.col("problem_at").alias("__at"), F.lit(True).alias("__bad")).checkpoint(eager=True)      # the files are parsed once, not by every reader of the scan
    ok = F.col("__bad").isNull()
    return scanned.join(bad, "uri", "left").withColumns({
        "decodable": F.col("decodable") & ok,
        "problem": F.when(ok, F.col("problem")).otherwise(F.lit("JSON: syntax")),
        "problem_at": F.coalesce("__at", "problem_at")}).drop("__at", "__bad")


def plain(uri: Column) -> Column:
    """A URI without the ``file:`` in front, however many slashes follow it."""
    return F.regexp_replace(uri, "^file:/*", "/")


def with_found(listing: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """The listing with FOUND; files that ``previous`` (a catalog) has with this path, size and time are not read."""
    if previous is None or not {"uri", "mtime", "size_bytes", *FOUND} <= set(previous.columns):
        return listing.join(found(listing), "uri")
    same = ["path", "size_bytes", "mtime"]
    old = previous.select(*same, *FOUND)
    todo = listing.join(old.select(*same), same, "left_anti")
    kept = listing.join(old, same)
    if todo.isEmpty():
        return kept.select(*listing.columns, *FOUND)
    return kept.select(*listing.columns, *FOUND).unionByName(todo.join(found(todo), "uri").select(*listing.columns, *FOUND))


def _quote(s: str) -> str:
    import re
    return re.escape(s)


def stem_of(path: Column) -> Column:
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.regexp_replace(name, r"[.][^.]*$", "")


def format_of(path: Column) -> Column:
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.lower(F.regexp_extract(name, r"([.][^.]*)$", 1))


def domain_of(path: Column) -> Column:
    """First directory, or 'unknown' for files at the root."""
    return F.when(F.instr(path, "/") > 0, F.substring_index(path, "/", 1)).otherwise(F.lit("unknown"))


def entity_of(path: Column) -> Column:
    """Stem minus trailing ``_``-tokens that are date-like; empty -> 'unknown'."""
    stripped = F.regexp_replace(stem_of(path), rf"(^|_)({DATE_TOKEN})(_({DATE_TOKEN}))*$", "")
    return F.coalesce(F.nullif(stripped, F.lit("")), F.lit("unknown"))


def with_domain_entity(df: DataFrame, path_col: str = "path") -> DataFrame:
    """S2 + format."""
    p = F.col(path_col)
    return df.withColumns({"domain": domain_of(p), "entity": entity_of(p), "format": format_of(p)})


def source_date(stem: Column) -> tuple[Column, Column]:
    """Rightmost 8-digit token -> (YYYY, MM); 4-digit -> (YYYY, '00'); else ('unknown', '00')."""
    toks = F.filter(F.split(stem, "_"), lambda x: x.rlike(r"^([0-9]{8}|[0-9]{4})$"))
    last = F.try_element_at(toks, F.lit(-1))
    year = F.coalesce(F.substring(last, 1, 4), F.lit("unknown"))
    month = F.when(F.length(last) == 8, F.substring(last, 5, 2)).otherwise(F.lit("00"))
    return year, month


def with_source_date(df: DataFrame, path_col: str = "path") -> DataFrame:
    y, m = source_date(stem_of(F.col(path_col)))
    return df.withColumns({"year": y, "month": m})


def first_of_checksum(catalog: DataFrame) -> DataFrame:
    """``duplicate_of`` = the earliest-seen other path with the same checksum.

    (checksum, first path) via map-side ``min(struct(first_seen, path))``,
    then a join: a checksum held by a third of all files is reduced to one
    row per task before the shuffle, never gathered in one window.
    """
    firsts = catalog.groupBy("checksum").agg(F.min(F.struct("first_seen", "path")).alias("__f"))
    j = catalog.join(firsts, "checksum", "left")
    return j.withColumn("duplicate_of", F.when(F.col("__f.path") != F.col("path"), F.col("__f.path"))).drop("__f")


def merge(listing: DataFrame, previous: DataFrame | None, now: Column | None = None) -> DataFrame:
    """Keep ``first_seen`` of known paths, refresh ``last_seen``; vanished paths drop out."""
    now = now if now is not None else F.current_timestamp()
    if previous is None:
        return listing.withColumns({"first_seen": now, "last_seen": now, "is_new": F.lit(True)})
    prev = previous.select("path", F.col("first_seen").alias("__prev_first"))
    j = listing.join(prev, "path", "left")
    return (j.withColumn("first_seen", F.coalesce("__prev_first", now))
            .withColumn("last_seen", now)
            .withColumn("is_new", F.col("__prev_first").isNull())
            .drop("__prev_first"))


def build(spark: SparkSession, root: str, previous: DataFrame | None = None) -> DataFrame:
    """Catalog of a Bronze root: path, domain, entity, format, size, checksum, seen, duplicate_of."""
    listing = with_domain_entity(with_found(list_files(spark, root, with_content=False), previous))
    return first_of_checksum(merge(listing, previous))


def update(listing: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Catalog rows of some files (path, uri, size_bytes, mtime) alone: only they are read. Earlier files
    count as firsts of a checksum through the rows of ``previous`` that share it."""
    new = merge(with_domain_entity(with_found(listing, previous)), previous)
    if previous is None:
        return first_of_checksum(new)
    others = previous.join(new.select("path"), "path", "left_anti").join(new.select("checksum").distinct(), "checksum", "left_semi")
    both = new.withColumn("__new", F.lit(True)).unionByName(others.select("path", "checksum", "first_seen"), allowMissingColumns=True)
    return first_of_checksum(both).filter("__new").drop("__new")


def latest(catalog: DataFrame) -> DataFrame:
    """One row per path of a catalog that updates were appended to: the one seen last."""
    rest = [c for c in catalog.columns if c != "path"]
    return catalog.groupBy("path").agg(F.max_by(F.struct(*rest), "last_seen").alias("r")).select("path", "r.*")
