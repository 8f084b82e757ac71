"""Drill-through and read operators: R1-R3, P11-P13, L1-L6."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.functions import dates as D
from starforge.operators.cube import date_key_columns


def coerce_literal(value, dtype: T.DataType) -> Column:
    """Filter text -> the column's type (int if parseable, else text)."""
    if isinstance(value, str) and not isinstance(dtype, T.StringType):
        return F.lit(value).try_cast(dtype)
    return F.lit(value).cast(dtype)


def date_filter(key: Column, year: int | None, month: int | None) -> Column:
    """year/month on a YYYYMMDD key as a range predicate (pushed to the scan)."""
    if year is not None and month is not None:
        lo = year * 10000 + month * 100
        return key.between(lo + 1, lo + 31)
    if year is not None:
        return key.between(year * 10000 + 101, year * 10000 + 1231)
    return D.key_month(key) == month


def rows(fact: DataFrame, filters: dict, date_role: str | None = None, limit: int | None = None) -> DataFrame:
    """Fact rows of one cube cell, lineage columns intact.

    ``year``/``month`` apply to ``date_role`` (default: the first date key in
    name order, the cuboid's primary date key). Unknown filter columns raise.
    """
    types = {f.name: f.dataType for f in fact.schema.fields}
    out = fact
    year, month = filters.get("year"), filters.get("month")
    if year is not None or month is not None:
        if date_role is None:
            keys = date_key_columns(fact)
            if not keys:
                raise ValueError("no date key to filter year/month on")
            date_role = keys[0]
        out = out.where(date_filter(F.col(date_role), None if year is None else int(year),
                                    None if month is None else int(month)))
    for col, val in filters.items():
        if col in ("year", "month"):
            continue
        if col not in types:
            raise KeyError(f"unknown filter column {col!r}")
        out = out.where(F.col(col) == coerce_literal(val, types[col]))
    return out.limit(limit) if limit else out


def trace(drilled: DataFrame) -> DataFrame:
    """Cube cell -> Bronze files (path, checksum, rows)."""
    return drilled.groupBy("_bronze_path", "_file_checksum").agg(F.count(F.lit(1)).alias("n_rows"))


def page(df: DataFrame, order_by: list[str], limit: int = 100, offset: int = 0) -> DataFrame:
    """L1: one page in a stable order, with the table's total row count."""
    if not 1 <= limit <= 5000 or offset < 0:
        raise ValueError("limit must be 1..5000 and offset >= 0")
    total = df.count()   # one scalar (a COUNT(*); footer metadata for a plain Parquet scan)
    return df.orderBy(*order_by).offset(offset).limit(limit).withColumn("total_rows", F.lit(total).cast("bigint"))


def export_records(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text, NaN as NULL."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            out.append(D.iso_text(c).alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.nanvl(c, F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def monthly_trend(by_month_df: DataFrame, measure: str) -> DataFrame:
    """L3: label 'Mon ''yy', value = the chosen ``_sum`` measure (NULL -> 0), in time order."""
    d = F.make_date(F.col("year"), F.col("month"), F.lit(1))
    return (by_month_df.where(F.col("year").isNotNull())
            .select((F.col("year") * 12 + F.col("month")).alias("period"),
                    F.date_format(d, "MMM ''yy").alias("label"),
                    F.coalesce(F.col(f"{measure}_sum").cast("double"), F.lit(0.0)).alias("value"))
            .orderBy("period"))


def label_column(dim_df: DataFrame, key_col: str) -> Column:
    """``name`` if it is text, else the first text attribute that is neither
    ``_...`` nor ``..._key``, else the key itself."""
    fields = [f for f in dim_df.schema.fields]
    names = {f.name: f.dataType for f in fields}
    if "name" in names and isinstance(names["name"], T.StringType):
        return F.col("name")
    for f in fields:
        if isinstance(f.dataType, T.StringType) and not f.name.startswith("_") and not f.name.endswith("_key"):
            return F.col(f"`{f.name}`")
    return F.col(key_col).cast("string")


def topk_by_dim(by_dim_df: DataFrame, dim_df: DataFrame, key_col: str, measure: str, k: int = 15) -> DataFrame:
    """Top-k members by the measure (desc, ties by key) with their label.

    ``orderBy + limit`` plans as TakeOrderedAndProject (a per-task top-k, then
    a merge of k rows per task); only the k winners are joined to the labels.
    """
    m = F.coalesce(F.col(f"{measure}_sum").cast("double"), F.lit(0.0))
    top = (by_dim_df.where(F.col(key_col).isNotNull())
           .select(F.col(key_col), m.alias("value"))
           .orderBy(F.col("value").desc(), F.col(key_col).asc()).limit(k))
    labels = (dim_df.select(F.col(key_col), label_column(dim_df, key_col).alias("label"))
              .join(F.broadcast(top.select(key_col)), key_col, "left_semi"))   # <= k rows
    w = Window.orderBy(F.col("value").desc(), F.col(key_col).asc())
    return (top.join(labels, key_col, "left")
            .select(F.row_number().over(w).alias("rank"), key_col,
                    F.coalesce(F.col("label"), F.col(key_col).cast("string")).alias("label"), "value"))
