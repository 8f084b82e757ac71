"""Column-name normalisation (P1) for driver-side schema work and as a column expression."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_name(name) -> str:
    """strip, lower, runs of non [a-z0-9] -> '_', trim '_'; empty -> 'unnamed'."""
    s = str(name).strip().lower()
    s = re.sub(r"[^a-z0-9]+", "_", s).strip("_")
    return s or "unnamed"


def normalize_name_col(c: Column) -> Column:
    """The same rule as a column expression (for column-catalog tables)."""
    s = F.regexp_replace(F.lower(F.trim(c)), r"[^a-z0-9]+", "_")
    s = F.regexp_replace(s, r"^_+|_+$", "")
    return F.when(s == "", F.lit("unnamed")).otherwise(s)


def dedupe_names(names: list[str]) -> list[str]:
    """2nd, 3rd ... occurrence of a name gets ``_dup2``, ``_dup3`` (column order)."""
    used: set[str] = set()
    out = []
    for n in names:
        final, k = n, 1
        while final in used:
            k += 1
            final = f"{n}_dup{k}"
        used.add(final)
        out.append(final)
    return out


def identifier(text: str) -> str:
    """Identifier clean used for upload names: strip, lower, space and '-' -> '_'."""
    return str(text).strip().lower().replace(" ", "_").replace("-", "_")
