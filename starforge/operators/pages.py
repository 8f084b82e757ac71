"""L1 at any depth: pages of a table kept in order, found through a directory of its files.

``write`` lays a table out in files of about ``rows_per_file`` rows, sorted inside and by range from file to
file. ``directory`` has a row per file: its rows and how many come before it. ``page`` looks up the files
a page overlaps and sorts only these, so neither the offset nor the table's size matters: a page of up
to ``rows_per_file`` rows opens two files, or three where ranges came out smaller, and no task holds
more than their rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROWS_PER_FILE = 1_000_000


def write(df: DataFrame, order_by: list[str], path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """The table at ``path`` in the order of ``order_by`` (which should tell all rows apart; NULLs first)."""
    files = max(1, math.ceil(df.count() / rows_per_file))
    df.repartitionByRange(files, *order_by).sortWithinPartitions(*order_by).write.parquet(path)


def directory(spark: SparkSession, path: str, order_by: list[str]) -> DataFrame:
    """(file, rows, before): one row per file, from the order columns alone. The files are sorted, so the
    first row of each tells its place (the least of a struct would be found by sorting every row)."""
    file, table = F.col("_metadata.file_path").alias("file"), spark.read.parquet(path)
    first = table.where("_metadata.row_index = 0").select(file, F.struct(*[F.col(f"`{c}`") for c in order_by]).alias("first"))
    files = table.groupBy(file).agg(F.count("*").alias("rows")).join(first, "file")
    w = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)      # over files, not rows
    return files.select("file", "rows", F.coalesce(F.sum("rows").over(w), F.lit(0)).alias("before"))


def page(spark: SparkSession, files: DataFrame, order_by: list[str], limit: int = 100, offset: int = 0) -> DataFrame:
    """One page, with the table's total row count; ``files`` is the (stored) directory."""
    if not 1 <= limit <= 5000 or offset < 0:
        raise ValueError("limit must be 1..5000 and offset >= 0")
    rows = files.agg(F.sum("rows").alias("n")).first()["n"] or 0
    opened = files.where((F.col("before") < offset + limit) & (F.col("before") + F.col("rows") > offset)) \
        .select(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))).alias("file"), "before").orderBy("before").collect()     # the files of one page
    if not opened:
        anyone = files.select(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))).alias("file")).first()
        if anyone is None:
            raise ValueError("the directory has no file")
        return spark.read.parquet(anyone["file"]).limit(0).withColumn("total_rows", F.lit(rows).cast("bigint"))
    here = spark.read.parquet(*[r["file"] for r in opened])
    return here.orderBy(*order_by).offset(offset - opened[0]["before"]).limit(limit).withColumn("total_rows", F.lit(rows).cast("bigint"))
