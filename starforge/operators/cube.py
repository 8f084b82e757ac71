"""OLAP cuboids A1-A7.

``lattice`` computes apex, by-month, by-dimension and month x dimension in
**one** ``groupingSets`` pass: Spark expands each row once per grouping set,
aggregates partially map-side, and shuffles only partial aggregates.
``lattice_by_parents`` groups the fact by the finest cuboids only and sums up every coarser one from
the smallest that holds it; the pipeline uses it. The ``grouping_id`` tells a NULL key (kept as its own group, as pandas'
``dropna=False``) from a rolled-up key.

Aggregates per measure: ``sum`` (0 over an all-NULL group), ``count``
(non-NULL), ``mean`` (NULL over an all-NULL group).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.functions import dates as D
from starforge.operators.star import NUMERIC_TYPES, datetime_columns

RECORD_COUNT = "_record_count"


def measures(df: DataFrame, reference_measures: bool = False) -> list[str]:
    """A1: numeric (and boolean) columns that are not keys.

    Default excludes ``_``-prefixed lineage and ``*_id`` identifiers;
    ``reference_measures=True`` keeps them, as the reference does.
    """
    out = []
    for f in df.schema.fields:
        n = f.name
        if n.endswith("_key") or n == "fact_id":
            continue
        if not isinstance(f.dataType, NUMERIC_TYPES + (T.BooleanType,)):
            continue
        if not reference_measures and (n.startswith("_") or n.endswith("_id")):
            continue
        out.append(n)
    return out


def date_key_columns(df: DataFrame, dim_keys: list[str] | None = None) -> list[str]:
    """The keys made from the fact's datetime columns, in name order. A fact without
    these columns is judged by names: ``*_key`` columns that aren't in ``dim_keys`` (or,
    where the dimensions aren't known, ``*_date_key``)."""
    own = {f"{c}_key" for c in datetime_columns(df)} & set(df.columns)
    if own:
        return sorted(own)
    if dim_keys is None:
        return sorted(c for c in df.columns if c.endswith("_date_key") or c == "date_key")
    return sorted(c for c in df.columns if c.endswith("_key") and c not in dim_keys and c != "fact_id")


def _prepared(fact: DataFrame, ms: list[str]) -> tuple[DataFrame, list[str]]:
    """Booleans as 0/1; no measure -> constant ``_record_count`` (A2)."""
    if not ms:
        return fact.withColumn(RECORD_COUNT, F.lit(1)), [RECORD_COUNT]
    types = {f.name: f.dataType for f in fact.schema.fields}
    casts = {m: F.col(f"`{m}`").cast("int") for m in ms if isinstance(types[m], T.BooleanType)}
    return (fact.withColumns(casts) if casts else fact), ms


def measure_aggs(ms: list[str]) -> list[Column]:
    """sum / count / mean per measure. ``mean`` is written as sum/count so it
    shares their aggregation buffers (Spark de-duplicates equal aggregates):
    two buffer fields per measure cross the shuffle instead of four."""
    out = []
    for m in ms:
        c = F.col(f"`{m}`")
        s, n = F.sum(c), F.count(c)
        out += [F.coalesce(s, F.lit(0)).alias(f"{m}_sum"),
                n.alias(f"{m}_count"),
                F.when(n > 0, s.cast("double") / n).alias(f"{m}_mean")]
    return out


def with_month(fact: DataFrame, date_key: str) -> DataFrame:
    """year, month, month_name straight from the YYYYMMDD key (no dim_date join)."""
    k = F.col(date_key)
    return fact.withColumns({
        "year": D.key_year(k),
        "month": D.key_month(k),
        "month_name": D.month_name(D.key_to_date(k)),
    })


def apex(fact: DataFrame, ms: list[str] | None = None) -> DataFrame:
    """A3: long shape (measure, sum, count, mean), one global aggregate then unpivot."""
    ms = measures(fact) if ms is None else ms
    df, ms = _prepared(fact, ms)
    wide = df.agg(*measure_aggs(ms))
    structs = [F.struct(F.lit(m).alias("measure"), F.col(f"{m}_sum").cast("double").alias("sum"),
                        F.col(f"{m}_count").alias("count"), F.col(f"{m}_mean").alias("mean")) for m in ms]
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def by_month(fact: DataFrame, date_key: str, ms: list[str] | None = None) -> DataFrame:
    """A4: year, month, month_name of the primary date key; NULL month kept."""
    ms = measures(fact) if ms is None else ms
    df, ms = _prepared(with_month(fact, date_key), ms)
    return df.groupBy("year", "month", "month_name").agg(*measure_aggs(ms))


def by_dim(fact: DataFrame, dim_key: str, ms: list[str] | None = None) -> DataFrame:
    """A5: slice by one dimension key; NULL key kept."""
    ms = measures(fact) if ms is None else ms
    df, ms = _prepared(fact, ms)
    return df.groupBy(dim_key).agg(*measure_aggs(ms))


def by_month_dim(fact: DataFrame, date_key: str, dim_key: str, ms: list[str] | None = None) -> DataFrame:
    """Year x month x dimension key."""
    ms = measures(fact) if ms is None else ms
    df, ms = _prepared(with_month(fact, date_key), ms)
    return df.groupBy("year", "month", dim_key).agg(*measure_aggs(ms))


def lattice_sets(dim_keys: list[str], with_month_sets: bool) -> list[tuple[str, list[str]]]:
    """(cuboid suffix, grouping columns) in the reference's naming."""
    sets = [("apex", [])]
    if with_month_sets:
        sets.append(("by_month", ["year", "month", "month_name"]))
    for k in sorted(dim_keys):
        sets.append((f"by_{k}", [k]))
        if with_month_sets:
            sets.append((f"by_month_{k}", ["year", "month", k]))
    return sets


def lattice(fact: DataFrame, dim_keys: list[str], date_key: str | None = None,
            ms: list[str] | None = None) -> DataFrame:
    """Every cuboid of one fact in a single grouping-sets aggregate.

    Output: ``cuboid`` + all grouping columns (NULL when rolled up) + the
    measure aggregates. Split with ``where(cuboid == ...)`` or write
    partitioned by ``cuboid``. ``month_name`` is a function of (year, month),
    so it is derived after the aggregate, once per output row.
    """
    ms = measures(fact) if ms is None else ms
    df = fact
    if date_key:
        k = F.col(date_key)
        df = fact.withColumns({"year": D.key_year(k), "month": D.key_month(k)})
    df, ms = _prepared(df, ms)
    sets = lattice_sets(dim_keys, date_key is not None)
    group_cols = (["year", "month"] if date_key else []) + sorted(dim_keys)
    if not group_cols:
        return df.agg(*measure_aggs(ms)).select(F.lit("apex").alias("cuboid"), "*")
    sets = [(n, [c for c in cols if c != "month_name"]) for n, cols in sets]

    def gid_of(cols):
        # grouping_id bit i (MSB first) is 1 when group column i is rolled up
        v = 0
        for i, c in enumerate(group_cols):
            if c not in cols:
                v |= 1 << (len(group_cols) - 1 - i)
        return v
    names = F.create_map(*[x for name, cols in sets for x in (F.lit(gid_of(cols)), F.lit(name))])
    g = df.groupingSets([[F.col(c) for c in cols] for _, cols in sets], *[F.col(c) for c in group_cols])
    out = g.agg(F.grouping_id(*group_cols).alias("__gid"), *measure_aggs(ms))
    out = out.withColumn("cuboid", names[F.col("__gid")])
    keys = list(group_cols)
    if date_key:
        mname = F.when(F.col("cuboid") == "by_month",
                       D.month_name(F.make_date(F.col("year"), F.col("month"), F.lit(1))))
        out = out.withColumn("month_name", mname)
        keys = ["year", "month", "month_name"] + sorted(dim_keys)
    return out.select("cuboid", *keys, *[c for c in out.columns if c not in keys and c not in ("__gid", "cuboid")])


def _buffers(ms: list[str]) -> list[Column]:
    """What is summed up per measure: sum (NULL over no value) and count."""
    return [x for m in ms for x in (F.sum(F.col(f"`{m}`")).alias(f"{m}__s"), F.count(F.col(f"`{m}`")).alias(f"{m}__n"))]


def _merged(part: DataFrame, ms: list[str]) -> list[Column]:
    """The same over groups that are already summed up; types don't widen."""
    types = dict(part.dtypes)
    return [F.sum(F.col(f"`{m}__{x}`")).cast(types[f"{m}__{x}"]).alias(f"{m}__{x}") for m in ms for x in "sn"]


def _finished(ms: list[str]) -> list[Column]:
    out = []
    for m in ms:
        s, n = F.col(f"`{m}__s`"), F.col(f"`{m}__n`")
        out += [F.coalesce(s, F.lit(0)).alias(f"{m}_sum"), n.alias(f"{m}_count"), F.when(n > 0, s.cast("double") / n).alias(f"{m}_mean")]
    return out


def smallest_key(df: DataFrame, dim_keys: list[str], sizes: dict[str, int] | None) -> str:
    """The dimension key of the fewest members: by ``sizes`` (rows of the dimension tables) where known,
    else estimated in one pass over the key columns."""
    if len(dim_keys) == 1:
        return dim_keys[0]
    if sizes is None or not set(dim_keys) <= set(sizes):
        row = df.agg(*[F.approx_count_distinct(F.col(f"`{k}`"), 0.05).alias(k) for k in dim_keys]).first()     # one scalar per key
        sizes = {k: row[k] for k in dim_keys}
    return min(sorted(dim_keys), key=lambda k: sizes[k])


def lattice_by_parents(fact: DataFrame, dim_keys: list[str], date_key: str | None = None,
            ms: list[str] | None = None, sizes: dict[str, int] | None = None) -> DataFrame:
    """The same table as :func:`lattice`, each cuboid from its smallest computed parent (sums of
    doubles may differ in the last bits, as they are added in another order).

    Only the finest cuboids (month x dimension, or the dimensions where there is no date) are grouped
    from the fact, which is expanded once per dimension. By-dimension cuboids are summed up from their
    month x dimension cuboid, by-month from the one of the smallest dimension (``sizes``: key -> members,
    estimated if not given), the apex from by-month. The finest groups are shuffled once; the
    further steps read that shuffle again and move groups, not facts.

    Output: ``cuboid`` + all grouping columns (NULL when rolled up) + the measure aggregates. Split with
    ``where(cuboid == ...)`` or write partitioned by ``cuboid``. ``month_name`` is a function of
    (year, month), so it is derived after the aggregate, once per output row.
    """
    ms = measures(fact) if ms is None else ms
    df = fact
    if date_key:
        k = F.col(date_key)
        df = fact.withColumns({"year": D.key_year(k), "month": D.key_month(k)})
    df, ms = _prepared(df, ms)
    dims = sorted(dim_keys)
    month = ["year", "month"] if date_key else []
    group_cols = month + dims
    if not group_cols:
        return df.agg(*_buffers(ms)).select(F.lit("apex").alias("cuboid"), *_finished(ms))
    prefix = "by_month_" if month else "by_"
    finest_sets = {f"{prefix}{k}": [*month, k] for k in dims} or {"by_month": month}
    if len(finest_sets) == 1:
        (name, cols), = finest_sets.items()
        finest = df.groupBy(*cols).agg(*_buffers(ms)).withColumn("cuboid", F.lit(name))
    else:
        # grouping_id has bit i (from the left) set where group column i is rolled up
        gid = {sum(1 << (len(group_cols) - 1 - i) for i, c in enumerate(group_cols) if c not in cols): name for name, cols in finest_sets.items()}
        names = F.create_map(*[F.lit(x) for kv in gid.items() for x in kv])
        finest = df.groupingSets([[F.col(c) for c in cols] for cols in finest_sets.values()], *[F.col(c) for c in group_cols]) \
            .agg(F.grouping_id(*group_cols).alias("__gid"), *_buffers(ms)).withColumn("cuboid", names[F.col("__gid").cast("int")]).drop("__gid")
    buffers = [f"`{m}__{x}`" for m in ms for x in "sn"]
    least = smallest_key(df, dims, sizes) if dims else None
    # cuboid -> the coarser ones summed up from it
    further = {f"by_month_{k}": [f"by_{k}", *(["by_month"] if k == least else [])] for k in dims} if month else {f"by_{least}": ["apex"]}
    kept = {"by_month": month, "apex": [], **{f"by_{k}": [k] for k in dims}}

    def summed_up(part: DataFrame, targets: dict[str, list[str]]) -> DataFrame:
        to = F.create_map(*[x for name, ts in targets.items() for x in (F.lit(name), F.array(*map(F.lit, ts)))])
        # a filter on the cuboid before the explode would be pushed below the shuffle of ``part``, which would then be done twice
        here = part.withColumn("cuboid", F.explode_outer(to[F.col("cuboid")])).where(F.col("cuboid").isNotNull())
        names = {t for ts in targets.values() for t in ts}
        keys = [F.when(F.col("cuboid").isin([t for t in names if c in kept[t]]), F.col(f"`{c}`")).alias(c) for c in group_cols if c in part.columns]
        here = here.select("cuboid", *keys, *buffers)
        return here.groupBy("cuboid", *[c for c in group_cols if c in part.columns]).agg(*_merged(part, ms))

    parts = [finest]
    if dims:
        parts.append(summed_up(finest, further))
    if month:
        parts.append(summed_up(parts[-1], {"by_month": ["apex"]}))
    # Of a plan's equal parts Spark numbers the columns of all but the first anew, and an Expand that kept its numbers is not
    # seen to be the same: its groups would be shuffled twice. This first part is empty, and goes when the plan is optimised.
    out = finest.where(F.lit(False))
    for p in parts:
        out = out.unionByName(p)
    keys = list(group_cols)
    if date_key:
        mname = F.when(F.col("cuboid") == "by_month", D.month_name(F.make_date(F.col("year"), F.col("month"), F.lit(1))))
        out = out.withColumn("month_name", mname)
        keys = ["year", "month", "month_name", *dims]
    return out.select("cuboid", *keys, *_finished(ms))


def lattice_apex(lattice_df: DataFrame) -> DataFrame:
    """The apex row of a lattice in the stored apex shape (measure, sum, count, mean)."""
    ms = [c[: -len("_sum")] for c in lattice_df.columns if c.endswith("_sum")]
    structs = [F.struct(F.lit(m).alias("measure"), F.col(f"{m}_sum").cast("double").alias("sum"),
                        F.col(f"{m}_count").alias("count"), F.col(f"{m}_mean").alias("mean")) for m in ms]
    return (lattice_df.where(F.col("cuboid") == "apex")
            .select(F.explode(F.array(*structs)).alias("s")).select("s.*"))


def cuboid(lattice_df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """One cuboid out of a lattice, with only its own key columns."""
    ms = [c for c in lattice_df.columns if c.endswith(("_sum", "_count", "_mean"))]
    return lattice_df.where(F.col("cuboid") == name).select(*keys, *ms)
