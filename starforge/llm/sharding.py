"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows with equal texts form a group that stays together. Groups are spread by hash over
tasks of about ``GROUPS_PER_TASK`` groups. Each task starts from one partial partition
per group (its bytes, then zeros), and repeatedly combines the two partial partitions of
largest spread, one ordered downwards and the other upwards, until one is left. What
the tasks leave - ``shards`` sums each - is combined by the same rule, at most
``FAN_IN`` partial partitions per task and level, until one partition remains. Only
sums travel between levels, never groups.

Nulls: a null text is empty; null ids are placed like others. Empty tables give empty
results. Repeated rows have a slot each. Other columns are not read. A single group
larger than a shard's share stays whole: its shard is as large as that group.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starforge.llm.common import materialize, read_table

SHARDS = 24
GROUPS_PER_TASK = 20_000
FAN_IN = 500
ROWS_PER_SLOT_BUCKET = 50_000


def karmarkar_karp(sums: np.ndarray) -> np.ndarray:
    """Label, in the combined partition, of every subset of each partial partition.

    ``sums`` has a row per partial partition and a column per subset."""
    n, k = sums.shape
    order = [np.argsort(-row, kind="stable") for row in sums]
    values = [row[o] for row, o in zip(sums, order)]
    heap = [(-int(v[0] - v[-1]), i) for i, v in enumerate(values)]
    heapq.heapify(heap)
    made: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = values[a] + values[b][::-1]
        o = np.argsort(-both, kind="stable")
        values.append(both[o])
        made.append((a, b, o))
        heapq.heappush(heap, (-int(values[-1][0] - values[-1][-1]), len(values) - 1))
    label: list[np.ndarray | None] = [None] * len(values)
    if values:
        label[-1] = np.arange(k)
    for t in range(len(made) - 1, -1, -1):
        a, b, o = made[t]
        m = label[n + t]
        label[a], label[b] = np.empty(k, np.int64), np.empty(k, np.int64)
        label[a][o], label[b][k - 1 - o] = m, m
    out = np.empty((n, k), np.int64)
    for i in range(n):
        out[i, order[i]] = label[i]
    return out


def place_groups(groups: DataFrame, shards: int, groups_per_task: int = GROUPS_PER_TASK, fan_in: int = FAN_IN) -> DataFrame:
    """key and shard of every group of ``groups`` (key string, bytes long)."""
    tasks = max(1, math.ceil(groups.count() / groups_per_task))

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = np.zeros((len(pdf), shards), np.int64)
        pdf = pdf.sort_values(["bytes", "key"], ascending=[False, True])
        sums[:, 0] = pdf["bytes"]
        return pd.DataFrame({"key": pdf["key"], "bytes": pdf["bytes"], "node": pdf["node"], "subset": karmarkar_karp(sums)[:, 0]})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, row = np.unique(pdf["node"], return_inverse=True)
        sums = np.zeros((len(nodes), shards), np.int64)
        sums[row, pdf["subset"]] = pdf["bytes"]
        label = karmarkar_karp(sums)
        return pd.DataFrame({"node": np.repeat(nodes, shards), "subset": np.tile(np.arange(shards), len(nodes)),
                             "up": int(pdf["up"].iloc[0]), "up_subset": label.ravel(), "bytes": sums.ravel()})

    leaves = materialize(
        groups.withColumn("node", F.pmod(F.xxhash64("key"), F.lit(tasks))).groupBy("node")
        .applyInPandas(combine, "key string, bytes long, node long, subset long"), "kk_leaves")
    level = leaves.groupBy("node", "subset").agg(F.sum("bytes").alias("bytes"))
    shard_of = None         # (node, subset) of a leaf -> subset at the current level
    while tasks > 1:
        merged = materialize(level.withColumn("up", F.floor(F.col("node") / fan_in)).groupBy("up")
                             .applyInPandas(merge, "node long, subset long, up long, up_subset long, bytes long"), "kk_level")
        step = merged.select(F.col("node").alias("at"), F.col("subset").alias("at_subset"), "up", "up_subset")
        shard_of = merged.select("node", "subset", "up", "up_subset") if shard_of is None else \
            shard_of.withColumnsRenamed({"up": "at", "up_subset": "at_subset"}).join(step, ["at", "at_subset"]) \
            .select("node", "subset", "up", "up_subset")
        level = merged.groupBy(F.col("up").alias("node"), F.col("up_subset").alias("subset")).agg(F.sum("bytes").alias("bytes"))
        tasks = math.ceil(tasks / fan_in)
    if shard_of is None:
        return leaves.select("key", F.col("subset").cast("int").alias("shard"))
    return leaves.join(shard_of, ["node", "subset"]).select("key", F.col("up_subset").cast("int").alias("shard"))


def shard(docs: DataFrame, shards: int = SHARDS, overhead: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; slots run from 0 in each shard."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = materialize(docs.select(
        "doc_id", (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("key")), "shard_rows")
    groups = materialize(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "shard_groups")
    buckets = max(1, math.ceil(rows.count() / ROWS_PER_SLOT_BUCKET))
    placed = materialize(
        rows.join(place_groups(groups, shards), "key").drop("key")
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets))), "shard_placed")
    # slots: rows are numbered within (shard, bucket), buckets within a shard by running counts
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n")) \
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    number = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    return placed.withColumn("number", number).join(offsets, ["shard", "bucket"]) \
        .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("number") - 1).alias("slot"))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: all documents in shards of near equal bytes (law ``bytes``)."""
    return shard(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
