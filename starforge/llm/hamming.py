"""Exact top-k search of binary codes by incremental multi-index hashing.

A vector's code has a bit per component (set where it is not negative). A shard of at
most about ``SHARD_ROWS`` rows cuts the codes into segments of about log2(rows) bits and
sorts its rows by each segment's value. A query visits, segment by segment, the values
at distance r = 0, 1, 2, ... from its own; every row met is verified. Once segments
0..a were searched to radius r and the others to r - 1, all codes within
``segments * r + a`` are known, so the search ends when the k-th verified distance is
not larger. Shards are exact, hence so is the merge of their answers by
(distance, id). Queries travel to the shards in blocks of ``BLOCK_QUERIES``.

Nulls: rows with a null id or vector, or an empty vector, are not indexed and ask
nothing; null components count as negative. Codes are compared with codes of the same
length only. Ties go to the smaller id. Repeated rows are found once each; repeated
queries are answered once. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starforge.llm.common import materialize, read_table

K = 10
SHARD_ROWS = 32_768
BLOCK_QUERIES = 2_048
QUERY_EVERY = 50
MAX_SEGMENT_BITS = 20


class MultiIndex:
    """The codes of one shard (rows of packed bits, all of ``bits`` bits)."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, bits: int):
        self.ids, self.bits = ids, bits
        self.words = self._words(codes)
        width = min(MAX_SEGMENT_BITS, max(1, round(math.log2(max(2, len(ids))))))
        self.cuts = np.linspace(0, bits, max(1, round(bits / width)) + 1).astype(int)
        self.segments = len(self.cuts) - 1
        values = self._values(codes)
        self.order = [np.argsort(v, kind="stable") for v in values]
        self.sorted = [v[o] for v, o in zip(values, self.order)]
        self.masks = {w: np.split(np.argsort(np.bitwise_count(np.arange(1 << w)), kind="stable"),
                                  np.cumsum([math.comb(w, r) for r in range(w)])) for w in set(np.diff(self.cuts).tolist())}

    @staticmethod
    def _words(codes: np.ndarray) -> np.ndarray:
        pad = -codes.shape[1] % 8
        return np.ascontiguousarray(np.pad(codes, ((0, 0), (0, pad)))).view(np.uint64)

    def _values(self, codes: np.ndarray) -> list[np.ndarray]:
        on = np.unpackbits(codes, axis=1)[:, :self.bits].astype(np.int64)
        return [on[:, a:b] @ (1 << np.arange(b - a)) for a, b in zip(self.cuts[:-1], self.cuts[1:])]

    def search(self, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances of the k nearest, nearest first, ties by id."""
        k = min(k, len(self.ids))
        word, values = self._words(code[None])[0], [int(v[0]) for v in self._values(code[None])]
        seen = np.zeros(len(self.ids), bool)
        places, distances, count = [], [], 0
        for r in range(int(np.diff(self.cuts).max()) + 1):
            for a in range(self.segments):
                masks = self.masks[int(self.cuts[a + 1] - self.cuts[a])]
                if r < len(masks):
                    probes = masks[r] ^ values[a]
                    low = np.searchsorted(self.sorted[a], probes, "left")
                    size = np.searchsorted(self.sorted[a], probes, "right") - low
                    at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
                    new = self.order[a][at]
                    new = new[~seen[new]]
                    seen[new] = True
                    places.append(new)
                    distances.append(np.bitwise_count(self.words[new] ^ word).sum(axis=1))
                    count += len(new)
                if count >= k:
                    found = np.concatenate(distances)
                    if np.partition(found, k - 1)[k - 1] <= self.segments * r + a:
                        place = np.concatenate(places)
                        best = np.lexsort((self.ids[place], found))[:k]
                        return place[best], found[best]
        place, found = np.concatenate(places), np.concatenate(distances)
        best = np.lexsort((self.ids[place], found))[:k]
        return place[best], found[best]


def binary_codes(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """id, bits and code (packed) of every row with an id and a vector."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(column).alias("v")) \
        .filter(F.col("id").isNotNull() & (F.size("v") > 0))

    def run(batches):
        for batch in batches:
            codes = [np.packbits([x is not None and x >= 0 for x in v]).tobytes() for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.compute.list_value_length(batch.column("v")), pa.array(codes, pa.binary())],
                                             ["id", "bits", "code"])

    return rows.mapInArrow(run, "id long, bits int, code binary")


def top_k(index: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, neighbor_id and distance: the k nearest rows of ``index`` (id, bits,
    code) for each of ``queries`` (alike)."""
    shards = max(1, math.ceil(index.count() / shard_rows))
    blocks = max(1, math.ceil(queries.count() / block_queries))
    left = index.withColumn("shard", F.pmod(F.xxhash64("id", "code"), F.lit(shards))) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.distinct().withColumn("block", F.pmod(F.xxhash64("id", "code"), F.lit(blocks)).cast("int")) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asked):
            bits = int(rows["bits"].iloc[0])
            unpack = lambda c: np.frombuffer(b"".join(c), np.uint8).reshape(len(c), -1)
            found = MultiIndex(rows["id"].to_numpy(), unpack(rows["code"]), bits)
            for q, raw_code, code in zip(asked["id"], asked["code"], unpack(asked["code"])):
                place, distance = found.search(code, k)
                out.append(pd.DataFrame({"query_id": q, "query_code": raw_code, "neighbor_id": found.ids[place], "distance": distance.astype(np.int32)}))
        columns = ["query_id", "query_code", "neighbor_id", "distance"]
        return pd.concat(out)[columns] if out else pd.DataFrame(columns=columns)

    keys = ["bits", "shard", "block"]
    local = left.groupBy(*keys).cogroup(right.groupBy(*keys)) \
        .applyInPandas(run, "query_id long, query_code binary, neighbor_id long, distance int")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_code").orderBy("distance", "neighbor_id"))
    return local.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", "distance")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: the 10 nearest codes of every embedding whose id is divisible by 50, itself included."""
    index = materialize(binary_codes(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "codes")
    return top_k(index, index.filter(F.col("id") % QUERY_EVERY == 0))


ORACLE_SQL = """
WITH code AS (
  SELECT vec_id,
         CAST(list_sum(list_transform(range(1, 33), lambda i: CASE WHEN embedding[i] >= 0 THEN CAST(1 AS BIGINT) << CAST(i - 1 AS BIGINT) ELSE 0 END)) AS BIGINT) AS lo,
         CAST(list_sum(list_transform(range(33, 65), lambda i: CASE WHEN embedding[i] >= 0 THEN CAST(1 AS BIGINT) << CAST(i - 33 AS BIGINT) ELSE 0 END)) AS BIGINT) AS hi
  FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id, CAST(bit_count(xor(q.lo, v.lo)) + bit_count(xor(q.hi, v.hi)) AS INTEGER) AS distance
  FROM code q, code v WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank, neighbor_id, distance
FROM pairs QUALIFY rank <= 10
"""
