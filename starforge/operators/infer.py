"""Type inference T0-T5 in one aggregate pass.

``column_stats`` computes, for every column at once, the number of non-NULL
values and how many of them look boolean / numeric / integral / datetime; a
value that repeats is looked at once. Only k rows of statistics reach the driver; the cast is one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge import config as C
from starforge.functions.dates import ANY_SHAPE, parse_datetime

# Text that counts as a number (pandas' to_numeric accepts these; Spark's cast
# alone would also take '1d' or 'NaN').
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?([iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"       # and the value fits a bigint

STAT_FIELDS = ["nonnull", "bool_hits", "num_hits", "int_hits", "dt_hits"]


def _text(c: Column) -> Column:
    return c.cast("string")


def bool_value(c: Column, cfg: C.Config) -> Column:
    """Vocabulary map: lower(trim(text)) in true/false values, anything else NULL."""
    t = F.lower(F.trim(_text(c)))
    return F.when(t.isin(cfg.true_values), F.lit(True)).when(t.isin(cfg.false_values), F.lit(False))


def numeric_value(c: Column) -> Column:
    t = F.trim(_text(c))
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double"))


def integer_value(c: Column) -> Column:
    t = F.trim(_text(c))
    return F.when(t.rlike(INTEGER_PATTERN), t.try_cast("bigint"))


# Dates are the dear cells (a parse each). A column is counted by distinct value, each looked at once, if in
# the first SAMPLE rows (of the table, or of a cheaper form of it) most values have a date's shape and fewer
# than REPEATED of them are different. This decides the path only; every cell is counted on either.
SAMPLE = 10_000
REPEATED = 0.5


def _cells(df: DataFrame, cols: list[str]) -> DataFrame:
    """(position, t): the trimmed text of every cell."""
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("p"), _text(F.col(f"`{c}`")).alias("v")) for i, c in enumerate(cols)]))
    return df.select(cells.alias("s")).select(F.col("s.p").alias("position"), F.trim(F.col("s.v")).alias("t"))


def repeated_dates(frames: list[tuple[DataFrame, list[str]]]) -> list[list[int]]:
    """Per frame the positions of the columns of repeated dates, measured on its first rows in one job."""
    parts = [_cells(df.limit(SAMPLE), cols).withColumn("k", F.lit(k)) for k, (df, cols) in enumerate(frames) if cols]
    out: list[list[int]] = [[] for _ in frames]
    if not parts:
        return out
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    share = both.groupBy("k", "position", "t").agg(F.count("t").alias("n")).groupBy("k", "position").agg(
        F.count("t").alias("different"), F.sum("n").alias("n"), F.sum(F.when(F.col("t").rlike(ANY_SHAPE), F.col("n"))).alias("dates"))
    for r in share.where((F.col("different") < REPEATED * F.col("n")) & (2 * F.col("dates") > F.col("n"))).collect():      # a row per column
        out[r["k"]].append(r["position"])
    return out


def _flags(t: Column, vocab: list[str]) -> Column:
    """What a text looks like, as bits: 1 a flag, 2 a number, 4 a bigint, 8 a date. Each test is made only
    where the ones before leave room: no number has a date's shape."""
    number = t.rlike(NUMBER_PATTERN)
    return (F.when(F.lower(t).isin(vocab), 1).otherwise(0)
            + F.when(number, F.lit(2) + F.when(integer_value(t).isNotNull(), 4).otherwise(0))
            .when(parse_datetime(t).isNotNull(), 8).otherwise(0)).cast("tinyint")


def column_stats(df: DataFrame, cols: list[str] | None = None, cfg: C.Config | None = None,
                 repeated: list[int] | None = None) -> DataFrame:
    """Long table: column, position, rows, nonnull, bool_hits, num_hits, int_hits, dt_hits.

    ``repeated``: positions of the columns whose values repeat (see :func:`repeated_dates`).
    One scan: cells are unpivoted to (position, text) and counted by what the text looks like, reduced
    map-side to a row per column and task. Columns in ``repeated`` are first counted by text, and each
    distinct text is looked at once, weighted by its count.
    """
    cfg = cfg or C.Config.load()
    cols = cols if cols is not None else list(df.columns)
    vocab = [v.lower() for v in cfg.true_values + cfg.false_values]
    t = F.col("t")
    cells = _cells(df, cols).withColumn("some", t.isNotNull())
    looks = F.when(t.isNotNull(), _flags(t, vocab))
    if repeated:
        by_value = F.col("position").isin(repeated)
        seen = cells.select("position", "some", F.when(by_value, t).alias("t"), F.when(~by_value, looks).alias("bits")) \
            .groupBy("position", "some", "t", "bits").agg(F.count(F.lit(1)).alias("n")) \
            .select("position", "some", "n", F.coalesce("bits", looks, F.lit(0)).cast("int").alias("bits"))
    else:
        seen = cells.select("position", "some", F.coalesce(looks, F.lit(0)).cast("int").alias("bits"), F.lit(1).alias("n"))
    hits = lambda bit: F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(bit) > 0, F.col("n"))), F.lit(0)).cast("bigint")
    stats = seen.groupBy("position").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("some"), F.col("n"))), F.lit(0)).cast("bigint").alias("nonnull"),
        hits(1).alias("bool_hits"), hits(2).alias("num_hits"), hits(4).alias("int_hits"), hits(8).alias("dt_hits"))
    names = C.local_df(df.sparkSession, [(i, c) for i, c in enumerate(cols)], "position int, column string")
    return (stats.join(F.broadcast(names), "position")
            .select("column", "position", "rows", *STAT_FIELDS))


def label_expr() -> Column:
    """First matching rule of T0-T4 over a stats row."""
    nn = F.col("nonnull")
    return (F.when(nn == 0, F.lit("empty"))
            .when(F.col("bool_hits") / nn >= C.BOOL_THRESHOLD, F.lit("boolean"))
            .when(F.col("num_hits") / nn >= C.NUMERIC_THRESHOLD, F.lit("numeric"))
            .when(F.col("dt_hits") / nn >= C.DATETIME_THRESHOLD, F.lit("datetime"))
            .otherwise(F.lit("string")))


def decide(stats: DataFrame) -> DataFrame:
    """Adds ``label`` and ``integral`` (numeric values all integer text)."""
    return (stats.withColumn("label", label_expr())
            .withColumn("integral", (F.col("label") == "numeric") & (F.col("int_hits") == F.col("num_hits"))))


def labels(df: DataFrame, cols: list[str] | None = None, cfg: C.Config | None = None) -> dict[str, tuple[str, bool]]:
    """column -> (label, integral). Collects one row per column (schema-sized)."""
    rows = decide(column_stats(df, cols, cfg)).select("column", "label", "integral").collect()
    return {r["column"]: (r["label"], bool(r["integral"])) for r in rows}


def cast_column(c: Column, label: str, integral: bool, cfg: C.Config) -> Column:
    if label == "boolean":
        return bool_value(c, cfg)
    if label == "numeric":
        return integer_value(c) if integral else numeric_value(c)
    if label == "datetime":
        return parse_datetime(F.trim(_text(c)))
    return c


def cast(df: DataFrame, decided: dict[str, tuple[str, bool]], cfg: C.Config | None = None) -> DataFrame:
    """One projection applying the decided types; untyped columns unchanged."""
    cfg = cfg or C.Config.load()
    out = []
    for c in df.columns:
        if c in decided:
            label, integral = decided[c]
            out.append(cast_column(F.col(f"`{c}`"), label, integral, cfg).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def infer_and_cast(df: DataFrame, cols: list[str] | None = None, cfg: C.Config | None = None):
    """Returns (typed DataFrame, {column: label})."""
    cfg = cfg or C.Config.load()
    cols = cols if cols is not None else [c for c in df.columns if not c.startswith("_")]
    decided = labels(df, cols, cfg)
    return cast(df, decided, cfg), {c: v[0] for c, v in decided.items()}


def labels_many(frames: dict, cfg: C.Config | None = None, samples: dict | None = None) -> dict:
    """Type decisions of many DataFrames in one job.

    ``frames``: key -> (DataFrame, columns). The per-frame long statistics are
    unioned, so all entities are decided by one action that returns one row
    per column (schema-sized). ``samples``: key -> the same table in a form whose first rows are
    cheap to get (not de-duplicated yet); columns of repeated dates in it are counted by value.
    """
    cfg = cfg or C.Config.load()
    keys = list(frames)
    if not keys:
        return {}
    repeated = repeated_dates([(samples[k], frames[k][1]) for k in keys]) if samples else [[] for _ in keys]
    parts = [column_stats(df, cols, cfg, repeated[i]).withColumn("__k", F.lit(i)) for i, (df, cols) in
             ((i, frames[k]) for i, k in enumerate(keys)) if cols]
    out = {k: {} for k in keys}
    if not parts:
        return out
    allstats = parts[0]
    for p in parts[1:]:
        allstats = allstats.unionByName(p)
    for r in decide(allstats).select("__k", "column", "label", "integral").collect():
        out[keys[r["__k"]]][r["column"]] = (r["label"], bool(r["integral"]))
    return out
