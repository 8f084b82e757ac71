"""Language identification with a byte convolutional network in numpy.

A text's UTF-8 bytes, mapped to ``CLASSES`` byte classes, are cut into windows of
``WINDOW`` bytes. Filters of widths 2, 3 and 4 run over each window, max pooling takes
every filter's largest response, and a softmax layer gives the languages'
probabilities; a text's prediction is the mean log-probability over all its windows,
weighted by their bytes. Since the input is one-hot, a filter's response is a sum of
table entries; the tables of pairs of classes (and of triples) are laid out once per
task, so a convolution is a gather.

The network is trained on windows of a bounded, documented sample: about
``DOCS_PER_LANGUAGE`` labelled documents of each language (chosen by a hash of the id,
so the sample is alike at any size) and at most ``WINDOWS_PER_DOC`` windows of each.
Prediction reads whole texts.

Nulls: a null text, or one without a letter, is ``und`` with score 0; rows with a null
language don't train; a null doc_id is kept. With nothing to learn from every text is
``und``. Ties go to the language that sorts first. Repeated rows are predicted alike.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import crc_column, per_text, raw, read_table, released, split_batches

WINDOW = 256
CLASSES = 64
WIDTHS = (2, 3, 4)
FILTERS = 16
DOCS_PER_LANGUAGE = 800
WINDOWS_PER_DOC = 4
CHUNK = 96                  # windows convolved at once
MIN_SCORE = 0.3             # the pipeline's stage rejects texts scored lower
UNKNOWN = "und"
HAS_LETTER = r"\p{L}"


def byte_classes() -> np.ndarray:
    """Class of each byte: 0 padding, 1 other ASCII, 2 white space, 3 digit, 4-29 letters
    without case, 30-45 lead bytes, 46-63 continuation bytes (both folded)."""
    c = np.ones(256, np.uint8)
    c[[9, 10, 11, 12, 13, 32]] = 2
    c[48:58] = 3
    c[97:123] = c[65:91] = np.arange(4, 30)
    c[0xC0:] = 30 + np.arange(64) % 16
    c[0x80:0xC0] = 46 + np.arange(64) % 18
    return c


BYTE_CLASS = byte_classes()


def windows_of(texts: list[bytes], limit: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded class windows, the number of the text each belongs to, and its bytes.
    ``limit`` spreads that many windows over a text (training only)."""
    cells, owner, size = [], [], []
    for k, t in enumerate(texts):
        n = max(1, -(-len(t) // WINDOW))
        line = np.zeros(n * WINDOW, np.uint8)
        line[:len(t)] = BYTE_CLASS[np.frombuffer(t, np.uint8)]
        grid = line.reshape(n, WINDOW)
        take = np.arange(n) if limit is None or n <= limit else np.linspace(0, n - 1, limit).astype(int)
        cells.append(grid[take])
        owner.append(np.full(len(take), k))
        size.append(np.minimum(WINDOW, np.maximum(1, len(t) - take * WINDOW)))
    if not cells:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(cells), np.concatenate(owner), np.concatenate(size)


class ByteConvNet:
    """Filters (width, class, filter) per width, then a linear layer over the pooled responses."""

    def __init__(self, languages: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.filters = {w: rng.normal(0, 0.3, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.dense = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.offset = np.zeros(len(languages), np.float32)
        self.tables: dict | None = None

    # -- training ---------------------------------------------------------
    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 5):
        """Adam on the cross-entropy; the gradient of a max goes to the winning position."""
        rng = np.random.default_rng(seed)
        params = [*self.filters.values(), *self.bias.values(), self.dense, self.offset]
        first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(order), batch):
                rows = order[at:at + batch]
                t += 1
                for p, g, m, v in zip(params, self._gradient(x[rows].astype(np.int64), y[rows]), first, second):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        return self

    def _gradient(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        n, places, pooled = len(x), {}, []
        for w, f in self.filters.items():
            span = x.shape[1] - w + 1
            response = f[0][x[:, :span]]
            for j in range(1, w):
                response += f[j][x[:, j:j + span]]
            places[w] = response.argmax(axis=1)
            pooled.append(np.take_along_axis(response, places[w][:, None, :], 1)[:, 0] + self.bias[w])
        hidden = np.concatenate(pooled, axis=1)
        active = np.maximum(hidden, 0)
        p = softmax(active @ self.dense + self.offset)
        p[np.arange(n), y] -= 1
        p /= n
        back = (p @ self.dense.T) * (hidden > 0)
        filters, bias = [], []
        for k, (w, f) in enumerate(self.filters.items()):
            part = back[:, k * FILTERS:(k + 1) * FILTERS]
            g = np.zeros_like(f)
            for j in range(w):
                np.add.at(g[j], (np.take_along_axis(x, places[w] + j, 1), np.arange(FILTERS)[None, :]), part)
            filters.append(g)
            bias.append(part.sum(axis=0))
        return [*filters, *bias, active.T @ p, p.sum(axis=0)]

    # -- prediction -------------------------------------------------------
    def _layout(self) -> dict:
        f2, f3, f4 = (self.filters[w] for w in WIDTHS)
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(-1, FILTERS)
        triple = (pair(f3[0], f3[1])[:, None, :] + f3[2][None, :, :]).reshape(-1, FILTERS)
        return {"pair": pair(f2[0], f2[1]), "triple": triple, "front": pair(f4[0], f4[1]), "back": pair(f4[2], f4[3])}

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of each window and language."""
        if self.tables is None:
            self.tables = self._layout()
        t, out = self.tables, []
        for at in range(0, len(x), CHUNK):
            c = x[at:at + CHUNK].astype(np.int32)
            two = c[:, :-1] * CLASSES + c[:, 1:]
            three = two[:, :-1] * CLASSES + c[:, 2:]
            pooled = [t["pair"][two].max(axis=1), t["triple"][three].max(axis=1),
                      (t["front"][two[:, :-2]] + t["back"][two[:, 2:]]).max(axis=1)]
            hidden = np.concatenate([p + self.bias[w] for p, w in zip(pooled, WIDTHS)], axis=1)
            out.append(np.log(softmax(np.maximum(hidden, 0) @ self.dense + self.offset) + 1e-9))
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)))

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        if not texts:
            return [], np.zeros(0)
        x, owner, size = windows_of(texts)
        total = np.zeros((len(texts), len(self.languages)))
        np.add.at(total, owner, self.log_probabilities(x) * size[:, None])
        p = softmax(total / np.bincount(owner, size)[:, None])
        best = p.argmax(axis=1)
        return [self.languages[k] for k in best], p[np.arange(len(texts)), best]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def training_sample(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> list:
    """(lang, windows) rows of about ``per_language`` documents of each language: the
    share of a language's ids, by hash, that gives that many. Texts are cut to their
    sampled windows before they travel."""
    usable = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text")) \
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_column() % 3 != 1) & F.col("text").rlike(HAS_LETTER))
    counts = {r["lang"]: r["n"] for r in docs.filter(F.col("lang").isNotNull() & (crc_column() % 3 != 1))
              .groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, per_language / n))])
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_batches(batches):
            cells = [windows_of([t], WINDOWS_PER_DOC)[0].tobytes() for t in raw(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("lang"), pa.array(cells, pa.binary())],
                                             ["doc_id", "lang", "cells"])

    rows = chosen.mapInArrow(run, "doc_id string, lang string, cells binary").collect()
    return sorted(rows, key=lambda r: (r["lang"], r["doc_id"] or "", r["cells"]))


def fit(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> ByteConvNet | None:
    rows = training_sample(docs, per_language)
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    grids = [np.frombuffer(r["cells"], np.uint8).reshape(-1, WINDOW) for r in rows]
    y = np.repeat([languages.index(r["lang"]) for r in rows], [len(g) for g in grids])
    x = np.concatenate(grids)
    # short texts: some windows keep only their first 16 or 64 bytes
    short = x.copy()
    short[::2, 16:] = 0
    short[1::2, 64:] = 0
    pick = slice(None, None, 3)
    return ByteConvNet(languages).fit(np.concatenate([x, short[pick]]), np.concatenate([y, y[pick]]))


def predict_partition(shared, columns: list[str]):
    """For ``mapInArrow`` over (columns..., text, letters): adds lang_pred and score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in split_batches(batches):
            texts, letters = raw(batch), batch.column("letters").to_pylist()
            where = [k for k, has in enumerate(letters) if has] if net else []
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            found, p = net.predict([texts[k] for k in where]) if net else ([], np.zeros(0))
            for k, name in zip(where, found):
                lang[k] = name
            score[where] = p
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(lang, pa.string()), pa.array(score)], [*columns, "lang_pred", "score"])

    return run


def has_letter():
    return F.coalesce(F.col("text").rlike(HAS_LETTER), F.lit(False)).alias("letters")


def predict(docs: DataFrame, net: ByteConvNet | None) -> DataFrame:
    """doc_id, lang_pred and score of every whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(net)
    return per_text(docs, ["doc_id"]).select("doc_id", "text", has_letter()) \
        .mapInArrow(predict_partition(shared, ["doc_id"]), f"doc_id {kind}, lang_pred string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: the language of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select("doc_id", (crc_column() % 3 == 1).alias("held_out"), "lang_pred", "score")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: texts without a letter, and those the network is unsure of
    (score below MIN_SCORE), are rejected; the others stay as they are."""
    shared = spark.sparkContext.broadcast(fit(docs))
    row = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"), has_letter())
    kept = row.mapInArrow(released(predict_partition(shared, ["row"])),
                          f"row {row.schema['row'].dataType.simpleString()}, lang_pred string, score double")
    return kept.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SCORE)).select("row.*")
