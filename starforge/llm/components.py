"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, root) of every id in ``edges`` (a, b): root is the smallest id of its component.

    Alternates two steps until nothing changes: every id's larger neighbours are joined to
    the smallest id around it (large star), then its smaller ones (small star). Each round
    is written to the shared folder; the number of rounds grows with the logarithm of the
    longest path. An id with very many neighbours is only ever aggregated and joined."""

    def star(e: DataFrame) -> DataFrame:
        """One star step over directed rows (u, v): v of u's neighbourhood are joined to its minimum."""
        least = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()

    both = lambda e: e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    down = lambda e: e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = materialize(down(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v")), "edges")
    state = None
    while True:
        wide = both(current)
        least = wide.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = down(wide.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"))
        current = materialize(down(star(large)), "edges")
        now = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == now:
            return current.select(F.col("u").alias("id"), F.col("v").alias("root")) \
                .unionByName(current.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
        state = now
