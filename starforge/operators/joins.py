"""NULL-safe key joins. Whether a side is broadcast is the planner's choice (its byte
threshold, and AQE's sizes at run time); these helpers give no hints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_left_join(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """``left ⟕ right`` where NULL matches NULL (pandas merge semantics).

    ``<=>`` stays an equi-join: Spark plans it as a hash/sort-merge join on the
    key plus its NULL flag. The right key column is dropped from the output.
    """
    rk = right_key or key
    r = right.withColumnRenamed(rk, "__rk") if rk == key else right
    rk2 = "__rk" if rk == key else rk
    return left.join(r, left[key].eqNullSafe(r[rk2]), "left").drop(rk2)


def null_safe_anti_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key (NULL included) does not occur in ``right``."""
    r = right.select(F.col(key).alias("__rk")).distinct()
    return left.join(r, left[key].eqNullSafe(r["__rk"]), "left_anti")
