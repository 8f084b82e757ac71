"""JSON text columns -> flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def infer_schema(df: DataFrame, col: str) -> str:
    """Merged schema of a JSON text column over *all* rows.

    ``schema_of_variant_agg`` is a JVM aggregate (reduced map-side): one DDL
    string reaches the driver.
    """
    ddl = df.select(F.schema_of_variant_agg(F.parse_json(F.col(col)))).first()[0]
    return ddl.replace("OBJECT<", "STRUCT<")


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Recursive struct flatten: ``a.b`` -> ``a_b``; arrays and maps -> JSON text."""
    out = []

    def walk(prefix: list[str], dtype: T.DataType, expr):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(prefix + [f.name], f.dataType, expr.getField(f.name))
        elif isinstance(dtype, (T.ArrayType, T.MapType)):
            out.append(F.to_json(expr).alias(sep.join(prefix)))
        else:
            out.append(expr.alias(sep.join(prefix)))

    for f in df.schema.fields:
        walk([f.name], f.dataType, F.col(f"`{f.name}`"))
    return df.select(*out)


def flatten_column(df: DataFrame, col: str, schema: str | None = None) -> DataFrame:
    """Parse a JSON text column and replace it by its flattened fields (``col_field``)."""
    ddl = schema or infer_schema(df, col)
    parsed = df.withColumn(col, F.from_json(F.col(col), ddl))
    return flatten(parsed)
