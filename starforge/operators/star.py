"""Star-schema operators C1-C7: classify, dimensions, dim_date, facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.functions import dates as D
from starforge.operators.joins import null_safe_left_join

ID_SUFFIX = "_id"
DIM_LINEAGE = ["_bronze_path", "_file_checksum"]
NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
DATETIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def type_class(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, NUMERIC_TYPES):
        return "numeric"
    if isinstance(dtype, DATETIME_TYPES):
        return "datetime"
    return "string"


def business_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def datetime_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if not f.name.startswith("_") and isinstance(f.dataType, DATETIME_TYPES)]


def column_catalog(df: DataFrame, domain: str, entity: str) -> DataFrame:
    """(domain, entity, column, position, type_class, null_free) of one typed entity.

    ``null_free`` matters only for booleans (a NULL-free boolean counts as
    numeric), so only boolean columns are counted - in one aggregate.
    """
    spark = df.sparkSession
    fields = [(i, f.name, type_class(f.dataType)) for i, f in enumerate(df.schema.fields)]
    bools = [n for _, n, t in fields if t == "boolean"]
    null_free = {}
    if bools:
        row = df.agg(*[F.count_if(F.col(f"`{b}`").isNull()).alias(f"n{i}") for i, b in enumerate(bools)]).first()
        null_free = {b: row[f"n{i}"] == 0 for i, b in enumerate(bools)}
    rows = [(domain, entity, n, i, t, bool(null_free.get(n, True))) for i, n, t in fields]
    from starforge.config import local_df
    return local_df(spark, rows,
                    "domain string, entity string, column string, position int, type_class string, null_free boolean")


def classify(columns: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """C1 + C2 over a column catalog.

    fact if >= 2 id columns, or >= 1 numeric non-id column (NULL-free booleans
    count), or >= 2 datetime columns; otherwise dimension. An override of
    'dimension'/'fact' for (domain, entity) wins.
    """
    b = columns.where(~F.col("column").startswith("_"))
    is_id = F.col("column").endswith(ID_SUFFIX)
    is_num = (F.col("type_class") == "numeric") | ((F.col("type_class") == "boolean") & F.col("null_free"))
    stats = b.groupBy("domain", "entity").agg(
        F.count_if(is_id).alias("n_id"),
        F.count_if(is_num & ~is_id).alias("n_measure"),
        F.count_if(F.col("type_class") == "datetime").alias("n_date"),
    )
    rule = F.when((F.col("n_id") >= 2) | (F.col("n_measure") >= 1) | (F.col("n_date") >= 2),
                  F.lit("fact")).otherwise(F.lit("dimension"))
    out = stats.withColumn("heuristic", rule)
    if overrides is None:
        return out.withColumn("class", F.col("heuristic")).withColumn("overridden", F.lit(False))
    ov = overrides.where(F.col("forced").isin("dimension", "fact"))
    return (out.join(F.broadcast(ov), ["domain", "entity"], "left")
            .withColumn("class", F.coalesce("forced", "heuristic"))
            .withColumn("overridden", F.col("forced").isNotNull())
            .drop("forced"))


def natural_id(df: DataFrame) -> str:
    """First ``*_id`` business column, else the first business column."""
    business = business_columns(df)
    ids = [c for c in business if c.endswith(ID_SUFFIX)]
    return ids[0] if ids else business[0]


def dimension(df: DataFrame, nat: str | None = None, order_cols: list[str] | None = None):
    """C4: business columns + 2 lineage columns, first row per natural id.

    "First" is the smallest ``order_cols`` value (default: ``_bronze_path``,
    ``_src_row`` when present). ``min_by`` is an algebraic aggregate, so a hot
    natural id is reduced map-side before the shuffle. A NULL id is one group.
    Returns (DataFrame, natural id column).
    """
    nat = nat or natural_id(df)
    keep = business_columns(df) + [c for c in DIM_LINEAGE if c in df.columns]
    if order_cols is None:
        order_cols = [c for c in ("_bronze_path", "_src_row") if c in df.columns] or keep
    rest = [c for c in keep if c != nat]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    order = F.struct(*[F.col(f"`{c}`") for c in order_cols])
    if not rest:
        return df.select(nat).distinct(), nat
    agg = df.groupBy(nat).agg(F.min_by(row, order).alias("__r"))
    return agg.select(nat, *[F.col(f"__r.`{c}`").alias(c) for c in rest]).select(*keep), nat


def collect_dates(frames: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Distinct calendar dates over datetime columns of many frames."""
    parts = []
    for df, cols in frames:
        if cols:
            parts.append(df.select(F.explode(F.array(*[F.to_date(F.col(f"`{c}`")) for c in cols])).alias("date")))
    if not parts:
        raise ValueError("no datetime columns")
    return reduce(DataFrame.unionByName, parts).where(F.col("date").isNotNull()).distinct()


def dim_date(frames: list[tuple[DataFrame, list[str]]] | DataFrame) -> DataFrame:
    """Observed dates (not a calendar) with their attributes.

    The distinct is a partially aggregated hash aggregate: the shuffle carries
    at most (#tasks x #distinct dates) rows whatever the fact size.
    """
    dates = frames if isinstance(frames, DataFrame) else collect_dates(frames)
    return dates.select(*D.calendar_attributes(F.col("date")))


def with_date_keys(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``<col>_key`` YYYYMMDD for every datetime business column."""
    cols = cols if cols is not None else datetime_columns(df)
    return df.withColumns({f"{c}_key": D.date_key(F.col(f"`{c}`")) for c in cols})


def resolve_fk(fact_df: DataFrame, dim_df: DataFrame, nat: str, key_col: str) -> DataFrame:
    """Fact ⟕ dim on the natural id (NULL matches NULL), adds ``key_col``."""
    lookup = dim_df.select(F.col(nat).alias("__nat"), F.col(key_col))
    return null_safe_left_join(fact_df, lookup, nat, "__nat")


def fact(df: DataFrame, entity: str, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Date keys + one ``<dim>_key`` per other dimension whose natural id
    is a fact column. ``dims``: entity -> (dim DataFrame with key, natural id)."""
    out = with_date_keys(df)
    for dim_entity, (dim_df, nat) in dims.items():
        if dim_entity == entity or nat not in out.columns:
            continue
        out = resolve_fk(out, dim_df, nat, f"{dim_entity}_key")
    return out


def fk_match(fact_df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Matched / total per resolved key (one aggregate)."""
    aggs = [F.count(F.lit(1)).alias("total")] + [F.count(F.col(k)).alias(k) for k in key_cols]
    wide = fact_df.agg(*aggs)
    structs = [F.struct(F.lit(k).alias("key_col"), F.col(k).alias("matched")) for k in key_cols]
    return wide.select("total", F.explode(F.array(*structs)).alias("s")).select("s.key_col", "s.matched", "total")
