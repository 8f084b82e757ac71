"""Configuration: alias map, fallback rules, classification overrides.

Configuration is small (bounded by the number of configured columns, not by
data) and is turned into DataFrames that the planner broadcasts.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starforge.functions.names import normalize_name

CONF_DIR = Path(__file__).resolve().parent.parent / "conf"

# The NA markers pandas' CSV/Excel readers turn into missing
# values by default (exact, case-sensitive match of the whole field).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Thresholds of the type rules (share of non-NULL values).
BOOL_THRESHOLD = 0.9
NUMERIC_THRESHOLD = 0.7
DATETIME_THRESHOLD = 0.7

# Methods of the harmoniser.
AUTO_APPROVED_METHODS = ("alias",)
NEEDS_REVIEW_METHODS = ("heuristic_range", "fallback")
UNNAMED_COLUMN_PATTERN = r"^(unnamed|col|column|field)_?[0-9]*$"


def local_df(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A small in-memory table as a ``LocalRelation`` (built through Arrow from
    pandas): no RDD, no job to materialise it, and the planner knows its size."""
    import pandas as pd
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    pdf = pd.DataFrame(rows, columns=[f.name for f in st.fields])
    if not rows:
        return spark.createDataFrame([], st)
    return spark.createDataFrame(pdf, st)


def _load_yaml(path: Path) -> dict:
    if not path.exists():
        return {}
    with open(path, encoding="utf-8") as fh:
        return yaml.safe_load(fh) or {}


@dataclass
class Config:
    aliases: dict = field(default_factory=dict)
    name_rules: list = field(default_factory=list)       # [(contains, maps_to|None)]
    range_rules: list = field(default_factory=list)      # [(min, max, maps_to)]
    true_values: list = field(default_factory=list)
    false_values: list = field(default_factory=list)
    overrides: dict = field(default_factory=dict)

    @classmethod
    def load(cls, aliases: str | Path | None = None, heuristics: str | Path | None = None,
             overrides: str | Path | None = None) -> "Config":
        a = _load_yaml(Path(aliases) if aliases else CONF_DIR / "aliases.yaml")
        h = _load_yaml(Path(heuristics) if heuristics else CONF_DIR / "heuristics.yaml")
        o = _load_yaml(Path(overrides) if overrides else CONF_DIR / "overrides.yaml")
        bmap = h.get("boolean_value_map", {})
        return cls(
            aliases=a,
            name_rules=[(r["contains"], r.get("maps_to")) for r in h.get("name_contains", [])],
            range_rules=[(r["min"], r["max"], r.get("maps_to")) for r in h.get("numeric_range_guess", [])],
            true_values=list(bmap.get("true_values", [])),
            false_values=list(bmap.get("false_values", [])),
            overrides=o,
        )

    @classmethod
    def driver(cls) -> "Config":
        """Configuration for the TPC-H-like driver tables."""
        return cls.load(aliases=CONF_DIR / "driver_aliases.yaml",
                        overrides=CONF_DIR / "driver_overrides.yaml")

    # -- DataFrame forms -------------------------------------------------
    def alias_rows(self) -> list[tuple]:
        """(domain, entity, canonical, canon_order, alias_norm), canonical included."""
        rows = []
        for domain, entities in (self.aliases or {}).items():
            for entity, block in (entities or {}).items():
                for order, (canonical, alias_list) in enumerate((block or {}).items()):
                    names = {normalize_name(canonical)} | {normalize_name(a) for a in alias_list or []}
                    for n in sorted(names):
                        rows.append((str(domain), str(entity), str(canonical), order, n))
        return rows

    def alias_df(self, spark: SparkSession) -> DataFrame:
        schema = "domain string, entity string, canonical string, canon_order int, alias_norm string"
        return local_df(spark, self.alias_rows(), schema)

    def override_rows(self) -> list[tuple]:
        rows = []
        for domain, entities in (self.overrides or {}).items():
            for entity, cls_ in (entities or {}).items():
                rows.append((str(domain), str(entity), str(cls_)))
        return rows

    def override_df(self, spark: SparkSession) -> DataFrame:
        return local_df(spark, self.override_rows(), "domain string, entity string, forced string")


MEMORY_SCHEMA = T.StructType([
    T.StructField("domain", T.StringType()),
    T.StructField("entity", T.StringType()),
    T.StructField("raw_column", T.StringType()),
    T.StructField("mapped_column", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("approved", T.BooleanType()),
    T.StructField("first_seen", T.TimestampType()),
    T.StructField("last_seen", T.TimestampType()),
])


def empty_memory(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MEMORY_SCHEMA)
