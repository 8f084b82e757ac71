"""Cleaning operators P1-P6, each a ``DataFrame -> DataFrame`` for ``df.transform``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.functions.names import dedupe_names, normalize_name
from starforge.functions.text import null_na_tokens, trim_ws


# Columns added by the readers (lineage); they pass through P1 unchanged.
SYSTEM_COLUMNS = ("_bronze_path", "_src_row")


def names_of(raw: list[str]) -> list[str]:
    """Normalised names; names that collide get ``_dupN``."""
    return dedupe_names([normalize_name(c) for c in raw])


def normalize_names(df: DataFrame) -> DataFrame:
    """Normalise every column name (see :func:`names_of`)."""
    raw = [c for c in df.columns if c not in SYSTEM_COLUMNS]
    new = dict(zip(raw, names_of(raw)))
    return df.toDF(*[new.get(c, c) for c in df.columns])


def _string_cols(df: DataFrame, skip_system: bool = True) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and not (skip_system and f.name.startswith("_"))]


def na_tokens(df: DataFrame, cols: list[str] | None = None, tokens=None) -> DataFrame:
    """Whole-field NA markers -> NULL on string columns (CSV/spreadsheet input)."""
    targets = set(cols if cols is not None else _string_cols(df))
    return df.select(*[null_na_tokens(F.col(f"`{c}`"), tokens).alias(c) if c in targets else F.col(f"`{c}`")
                       for c in df.columns])


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip white space of all string columns in one projection."""
    targets = set(_string_cols(df))
    return df.select(*[trim_ws(F.col(f"`{c}`")).alias(c) if c in targets else F.col(f"`{c}`")
                       for c in df.columns])


def drop_empty_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows whose (business) columns are all NULL."""
    subset = cols if cols is not None else [c for c in df.columns if not c.startswith("_")]
    return df.na.drop(how="all", subset=subset) if subset else df


def dedup_rows(df: DataFrame, per: list[str] | None = None) -> DataFrame:
    """P5: exact-row de-duplication (NULL equals NULL), optionally per source file.

    ``per`` names lineage columns that scope the de-duplication (e.g.
    ``_bronze_path``): the key is business columns + ``per``. Map-side partial
    aggregation makes a hot duplicate cost one row per task in the shuffle. Of equal
    rows the smallest ``_src_row`` stays.
    """
    business = [c for c in df.columns if not c.startswith("_")]
    key = business + [c for c in (per or []) if c not in business]
    if [c for c in df.columns if c not in key] == ["_src_row"]:
        return df.groupBy(*[F.col(f"`{c}`") for c in key]).agg(F.min("_src_row").alias("_src_row")).select(
            *[F.col(f"`{c}`") for c in df.columns])
    return df.dropDuplicates(key)


def clean(df: DataFrame, per: list[str] | None = None, csv_like: bool = False) -> DataFrame:
    """P1 -> (P4) -> P2 -> P3 -> P5 in that order (typing is ``infer``)."""
    out = normalize_names(df)
    if csv_like:
        out = na_tokens(out)
    return out.transform(trim_strings).transform(drop_empty_rows).transform(lambda d: dedup_rows(d, per))


def first_per_key(df: DataFrame, keys: list[str], order_cols: list[str] | None = None) -> DataFrame:
    """Keep the first row per key, "first" = smallest ``order_cols`` (default: all columns).

    ``min_by`` is reduced map-side, so a key holding a large share of the rows
    sends one row per task through the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order_cols = order_cols or rest
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]),
                                         F.struct(*[F.col(f"`{c}`") for c in order_cols])).alias("__r"))
    return agg.select(*keys, *[F.col(f"__r.`{c}`").alias(c) for c in rest]).select(*df.columns)
