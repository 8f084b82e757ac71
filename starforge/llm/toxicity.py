"""Toxicity scores from a factorization machine over hashed terms.

Words are lower-cased (A-Z) runs of digits, a-z and non-ASCII characters. A word and
its beginnings of 5 and 7 bytes (inflected and compounded forms share them) are terms,
hashed to ``2 ** BITS`` slots; a text is the set of its slots. The machine adds to the linear
weights the inner products of latent vectors of every pair of terms, so a pair such as
an insult beside a group's name can count more, or less, than its parts. It is fitted
in numpy on at most ``TRAIN_ROWS`` labelled documents, taken evenly by a hash of the id,
and its arrays (bounded by ``BITS`` and ``FACTORS``) go to the tasks that score.

Nulls: a null text is empty; rows with a null label don't train; a null doc_id is kept.
Empty texts get the score of the bias alone. Without any labelled row the score is 0.
Repeated rows are scored alike. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import ALNUM_TO_SPACE, crc_column, crc_of_id, per_text, raw, read_table, split_batches

BITS = 18
FACTORS = 4
TRAIN_ROWS = 8_000          # labelled documents the machine is fitted on, at most
TRAIN_TERMS = 4_000         # distinct terms of one training document, at most (smallest hashes)
MIN_DOCS = 3                # training documents a term needs
MIN_Z = 4.0                 # how far its share among toxic documents differs, in standard errors
COMMON = 0.2                # a term of this share of the training documents is kept as a partner of others
THRESHOLD = 0.7
CACHE_TERMS = 400_000


PREFIXES = (5, 7)           # bytes of a word's beginning that are terms of their own


class TermHasher:
    """The distinct term slots of a text."""

    def __init__(self, bits: int):
        self.mask, self.cache = (1 << bits) - 1, {}

    def slots(self, text: bytes | None) -> np.ndarray:
        terms = set(text.lower().translate(ALNUM_TO_SPACE).split()) if text else set()
        if len(self.cache) > CACHE_TERMS:
            self.cache.clear()
        cache, mask = self.cache, self.mask
        for t in terms.difference(cache):
            cache[t] = (zlib.crc32(t) & mask, *(zlib.crc32(t[:n], n) & mask for n in PREFIXES if len(t) >= n))
        return np.unique(np.fromiter(chain.from_iterable(map(cache.__getitem__, terms)), np.int64))


class FactorizationMachine:
    """y = b + sum w_i + 1/2 sum_f ((sum v_if)^2 - sum v_if^2) over a text's term slots."""

    def __init__(self, bits: int = BITS, factors: int = FACTORS):
        self.bits = bits
        self.bias = -50.0
        self.w = np.zeros(1 << bits, np.float32)
        self.v = np.zeros((1 << bits, factors), np.float32)

    def fit(self, rows: list[np.ndarray], labels: np.ndarray, epochs: int = 15, rate: float = 0.3, l1: float = 1e-4, seed: int = 7):
        """AdaGrad on logistic loss, minibatch size 1, soft-thresholded linear weights."""
        known = self._informative(rows, labels)
        rows = [r[known[r]] for r in rows]
        rng = np.random.default_rng(seed)
        self.v[known] = rng.normal(0, 0.01, (int(known.sum()), self.v.shape[1]))
        p = min(max(labels.mean(), 1e-3), 1 - 1e-3)
        self.bias = float(np.log(p / (1 - p)))
        gw, gv = np.full(len(self.w), 1e-2, np.float32), np.full(self.v.shape, 1e-2, np.float32)
        gb = 1.0
        for _ in range(epochs):
            for k in rng.permutation(len(rows)):
                r = rows[k]
                v = self.v[r]
                total = v.sum(axis=0)
                y = self.bias + self.w[r].sum() + 0.5 * float((total * total - (v * v).sum(axis=0)).sum())
                g = 1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[k]
                gb += g * g
                self.bias -= 0.1 * g / np.sqrt(gb)
                if not len(r) or abs(g) < 1e-3:
                    continue
                gw[r] += g * g
                step = rate / np.sqrt(gw[r])
                w = self.w[r] - step * g
                self.w[r] = np.sign(w) * np.maximum(np.abs(w) - step * l1 * 10, 0)
                dv = g * (total - v) + 1e-3 * v
                gv[r] += dv * dv
                self.v[r] = v - 0.3 * rate * dv / np.sqrt(gv[r])
        return self

    def _informative(self, rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
        """The slots the machine learns: those tied to the label, and common ones."""
        none, size = np.zeros(0, np.int64), 1 << self.bits
        toxic = np.bincount(np.concatenate([none, *(r for r, y in zip(rows, labels) if y)]), minlength=size)
        clean = np.bincount(np.concatenate([none, *(r for r, y in zip(rows, labels) if not y)]), minlength=size)
        n1, n0 = max(labels.sum(), 1), max(len(labels) - labels.sum(), 1)
        share = (toxic + clean) / (n1 + n0)
        error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
        tied = np.abs(toxic / n1 - clean / n0) >= MIN_Z * error
        return (toxic + clean >= MIN_DOCS) & (tied | (share >= COMMON))

    def score(self, r: np.ndarray) -> float:
        v = self.v[r]
        total = v.sum(axis=0)
        y = self.bias + float(self.w[r].sum()) + 0.5 * float((total * total - (v * v).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(y, -30, 30))))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int, bits: int = BITS) -> tuple[list[np.ndarray], np.ndarray]:
    """Term slots and labels of at most ``limit`` labelled documents, those with the
    smallest hash of the id; only slots travel to the driver."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")) \
        .filter(crc_column() % 3 != 1) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = per_text(docs, ["doc_id"]).filter(crc_column() % 3 != 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = TermHasher(bits)
        for batch in split_batches(batches):
            slots = [hasher.slots(t)[:TRAIN_TERMS].astype("<i4").tobytes() for t in raw(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(slots, pa.binary())], ["toxic", "slots"])

    rows = texts.join(F.broadcast(known), "doc_id").select("toxic", "text") \
        .mapInArrow(run, "toxic int, slots binary").collect() if limit else []
    rows.sort(key=lambda r: (r["toxic"], r["slots"]))
    return [np.frombuffer(r["slots"], "<i4").astype(np.int64) for r in rows], np.array([r["toxic"] for r in rows], np.float64)


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> FactorizationMachine:
    rows, y = training_rows(docs, labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")), limit)
    model = FactorizationMachine()
    return model.fit(rows, y) if len(rows) else model


def score(docs: DataFrame, model: FactorizationMachine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted (score at least ``threshold``) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        hasher = TermHasher(machine.bits)
        for batch in split_batches(batches):
            scores = np.array([machine.score(hasher.slots(t)) for t in raw(batch)], np.float64)
            ids = batch.column("doc_id")
            held = [crc_of_id(i) % 3 == 1 for i in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(held), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return per_text(docs, ["doc_id"]).mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: toxicity of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
