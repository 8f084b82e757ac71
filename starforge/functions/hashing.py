"""Row and content checksums (SHA-256, hex)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELD_SEP = "\u001f"
NULL_MARK = "\\N"


def _canonical(c: Column, dtype: T.DataType) -> Column:
    """Type-tagged canonical text of one value, so '1' (string) != 1 (long)."""
    if isinstance(dtype, T.StringType):
        tag, txt = "s", c
    elif isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        tag, txt = "i", c.cast("string")
    elif isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        tag, txt = "f", c.cast("double").cast("string")
    elif isinstance(dtype, T.BooleanType):
        tag, txt = "b", c.cast("string")
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        tag, txt = "t", F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(dtype, T.DateType):
        tag, txt = "d", F.date_format(c, "yyyy-MM-dd")
    else:
        tag, txt = "j", F.to_json(F.struct(c.alias("v")))
    return F.coalesce(F.concat(F.lit(tag + ":"), txt), F.lit(NULL_MARK))


def row_checksum(df: DataFrame, cols: list[str] | None = None) -> Column:
    """SHA-256 over the business columns (names not starting with '_').

    Order- and type-sensitive, independent of the source file. NULLs are
    marked explicitly, so (NULL, 'a') and ('a', NULL) differ.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    names = cols if cols is not None else [n for n in df.columns if not n.startswith("_")]
    parts = [_canonical(F.col(f"`{n}`"), fields[n]) for n in names]
    return F.sha2(F.concat_ws(FIELD_SEP, *parts), 256)


def content_checksum(c: Column) -> Column:
    """SHA-256 of file bytes (or text)."""
    return F.sha2(c, 256)
