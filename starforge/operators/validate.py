"""Validation V1-V6: findings as DataFrames (empty = pass)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.operators import cube


def apex_check(fact: DataFrame, apex_df: DataFrame, ms: list[str] | None = None,
               rel_tol: float = 1e-9, abs_tol: float = 1e-6) -> DataFrame:
    """V3: apex sum and count against an independent recomputation.

    A relative tolerance: parallel summation order changes the low bits of
    large float sums, so a fixed 1e-6 would fail at scale.
    """
    expected = cube.apex(fact, ms).select(
        "measure", F.col("sum").alias("expected_sum"), F.col("count").alias("expected_count"))
    got = apex_df.select("measure", F.col("sum").alias("actual_sum"), F.col("count").alias("actual_count"))
    j = expected.join(got, "measure", "full_outer")
    tol = F.greatest(F.lit(abs_tol), F.abs(F.col("expected_sum")) * rel_tol)
    ok = (F.col("actual_sum").isNotNull() & F.col("expected_sum").isNotNull()
          & (F.abs(F.col("expected_sum") - F.col("actual_sum")) <= tol)
          & (F.col("expected_count") == F.col("actual_count")))
    return j.withColumn("ok", F.coalesce(ok, F.lit(False)))


def _weight(keys: list[str]) -> Column:
    """A number up to 2^31 that depends on a group's key, NULL keys included; 2^31 without a key."""
    if not keys:
        return F.lit(1 << 31).cast("bigint")
    marked = [x for k in keys for x in (F.col(f"`{k}`").isNull(), F.col(f"`{k}`").cast("string"))]
    return F.pmod(F.xxhash64(*marked), F.lit((1 << 31) - 1)) + 1


def _marks(measure: Column, count: Column, weight: Column) -> list[Column]:
    """Linear in the rows: summed over groups or over the facts they were made of, they are equal."""
    scaled = measure.cast("double") * (weight.cast("double") / float(1 << 31))
    return [F.coalesce(F.sum(count.cast("decimal(20,0)") * weight.cast("decimal(10,0)")), F.lit(0)).cast("decimal(38,0)"),
            F.coalesce(F.sum(scaled), F.lit(0.0)), F.coalesce(F.sum(F.abs(scaled)), F.lit(0.0)), F.coalesce(F.sum(count), F.lit(0)).cast("bigint")]


MARKS = ["count_mark", "sum_mark", "size", "values"]


def fact_marks(fact: DataFrame, dim_keys: list[str], date_key: str | None, ms: list[str]) -> DataFrame:
    """(cuboid, measure, MARKS) from the fact in one pass without grouping."""
    df, ms = cube._prepared(cube.with_month(fact, date_key) if date_key else fact, ms)
    sets = cube.lattice_sets(dim_keys, date_key is not None)
    aggs, structs = [], []
    for i, (name, keys) in enumerate(sets):
        for j, m in enumerate(ms):
            c = F.col(f"`{m}`")
            for mark, col in zip(MARKS, _marks(c, c.isNotNull().cast("bigint"), _weight([k for k in keys if k != "month_name"]))):
                aggs.append(col.alias(f"{mark}_{i}_{j}"))
            structs.append(F.struct(F.lit(name).alias("cuboid"), F.lit(m).alias("measure"), *[F.col(f"{x}_{i}_{j}").alias(x) for x in MARKS]))
    return df.agg(*aggs).select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def lattice_marks(lattice: DataFrame, dim_keys: list[str], date_key: str | None) -> DataFrame:
    """The same from the stored groups of every cuboid."""
    ms = [c[:-4] for c in lattice.columns if c.endswith("_sum")]
    weight = None
    for name, keys in cube.lattice_sets(dim_keys, date_key is not None):
        w = _weight([k for k in keys if k != "month_name"])
        weight = F.when(F.col("cuboid") == name, w) if weight is None else weight.when(F.col("cuboid") == name, w)
    lat = lattice.withColumn("__w", weight)
    per = lat.groupBy("cuboid").agg(*[col.alias(f"{mark}_{j}") for j, m in enumerate(ms)
                                      for mark, col in zip(MARKS, _marks(F.col(f"`{m}_sum`"), F.col(f"`{m}_count`"), F.col("__w")))])
    structs = [F.struct(F.lit(m).alias("measure"), *[F.col(f"{x}_{j}").alias(x) for x in MARKS]) for j, m in enumerate(ms)]
    return per.select("cuboid", F.explode(F.array(*structs)).alias("s")).select("cuboid", "s.*")


def lattice_check(fact: DataFrame, lattice: DataFrame, dim_keys: list[str], date_key: str | None, ms: list[str],
                  rel_tol: float = 1e-9, abs_tol: float = 1e-6) -> DataFrame:
    """V3 for every cuboid: (cuboid, measure, values, ok). A group that is wrong, missing or moved to another
    key changes its cuboid's marks, also where all totals still add up; only a change of a sum below
    ``rel_tol`` of the whole cuboid is taken for rounding."""
    want = fact_marks(fact, dim_keys, date_key, ms)
    got = lattice_marks(lattice, dim_keys, date_key).select("cuboid", "measure", *[F.col(x).alias(f"got_{x}") for x in MARKS])
    tol = F.greatest(F.lit(abs_tol), F.greatest("size", "got_size") * rel_tol)
    ok = (F.col("count_mark") == F.col("got_count_mark")) & (F.abs(F.col("sum_mark") - F.col("got_sum_mark")) <= tol)
    return want.join(got, ["cuboid", "measure"], "full_outer").select(
        "cuboid", "measure", F.coalesce("values", F.lit(0)).alias("values"), F.coalesce(ok, F.lit(False)).alias("ok"))


def manifest_findings(manifest: DataFrame) -> DataFrame:
    """V1, V2, V4 over a manifest (name, kind, fact, rows).

    kind in {dim, fact, cuboid}; ``fact`` names the fact a cuboid belongs to.
    """
    facts = manifest.where(F.col("kind") == "fact")
    cuboids = manifest.where(F.col("kind") == "cuboid")
    counts = manifest.agg(F.count_if(F.col("kind") == "fact").alias("nf"),
                          F.count_if(F.col("kind") == "cuboid").alias("nc"))
    none_fact = counts.where(F.col("nf") == 0).select(F.lit("no fact tables").alias("finding"))
    none_cube = counts.where(F.col("nc") == 0).select(F.lit("no cuboid tables").alias("finding"))
    apexes = cuboids.where(F.col("name").endswith("_apex")).select(F.col("fact").alias("name"))
    missing = facts.join(apexes, "name", "left_anti").select(
        F.concat(F.lit("missing apex cuboid for "), F.col("name")).alias("finding"))
    empty = cuboids.where(F.col("rows") == 0).select(F.concat(F.col("name"), F.lit(" is empty")).alias("finding"))
    return none_fact.unionByName(none_cube).unionByName(missing).unionByName(empty)


def raise_on_findings(findings: DataFrame) -> None:
    """V5: fail with the number of findings and the first of them (all are in ``findings``)."""
    n = findings.count()
    if n:
        shown = findings.orderBy("finding").limit(20).collect()
        raise AssertionError(f"validation failed with {n} findings:\n" + "\n".join(f"  - {r[0]}" for r in shown))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """V6: key values that occur more than once (map-side partial counts)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
