"""Spelling variants found with a bit-sliced position index over the vocabulary.

Words are counted over all texts (:func:`vocabulary`). Two words are near if one inserted,
deleted or replaced code point turns one into the other. A word's form is its most frequent
near word, if that is at least ``DOMINANCE`` times as frequent; its root is where the chain
of forms ends.

Two near words of which the shorter has m letters agree in their first m // 2 letters or in
their last m - m // 2. So every word goes, for m = its length and for m one less, to the
buckets of its beginning and of its end. Keys are packed into buckets of about ``TILE``
words of one m and one side; a key with more words than that is cut into chunks, every pair
of which meets once, so no task holds more than two chunks. In a bucket a bitset over its
words is kept per (position, letter). A recurrence over the positions runs for all words of
the bucket at once, 64 of the others in a machine word: the set without an error so far,
the set with one replaced letter, and, looking one position ahead, the set with one letter
inserted. A pair that agrees at both sides counts at its beginning only, so every pair is
found once; what leaves a bucket is a count and the best near word per word, never pairs.

Nulls: a null text has no words; a null id counts as the empty text before the colon. Rows
that repeat are counted each. Ties among near words go to the smallest in code-point order.
Empty tables give empty results; a run of letters of any length is one word. Other columns
are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import materialize, per_text, raw, read_table, split_batches

RUN = re.compile("[a-zÀ-ÿ]+")
SLIP = 97                   # an occurrence whose hash it divides loses a letter
MIN_LETTERS = 5
MIN_COUNT = 3
DOMINANCE = 2
TILE = 4_096
TILE_LETTERS = 1 << 22      # letters of a tile at most, so tiles of very long words are smaller
HELD_WORDS = 200_000        # distinct words a task counts before it passes them on


# -- the vocabulary -----------------------------------------------------------
def written(run: str, n: int, crc: int) -> str:
    """The run as this document has it: with a letter lost where its hash says so."""
    h = zlib.crc32(run.encode(), crc)
    if h % SLIP:
        return run
    at = h % n
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of at least MIN_LETTERS letters and MIN_COUNT occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        rows = lambda: pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
        for batch in split_batches(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), raw(batch)):
                if not text:
                    continue
                crc = zlib.crc32(b":" if doc is None else f"{doc}:".encode())
                for w, n in Counter(RUN.findall(text.lower().decode())).items():
                    size = len(w)
                    if size >= MIN_LETTERS:
                        w = written(w, size, crc)
                        if len(w) >= MIN_LETTERS:
                            total[w] += n
            if len(total) >= HELD_WORDS:
                yield rows()
                total.clear()
        if total:
            yield rows()

    return per_text(docs, ["doc_id"]).mapInArrow(run, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


# -- one bucket ---------------------------------------------------------------
def letters(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.array(words, f"U{length}").view(np.uint32).reshape(len(words), length) if words else np.zeros((0, length), np.uint32)


class PositionIndex:
    """Per (position, letter) the bitset of the words that have the letter there."""

    def __init__(self, chars: np.ndarray):
        self.chars, self.n = chars, len(chars)
        self.width = -(-self.n // 64)

    def full(self) -> np.ndarray:
        bits = np.zeros(self.width * 64, np.uint8)
        bits[:self.n] = 1
        return np.packbits(bits, bitorder="little").view(np.uint64)

    def at(self, position: int, wanted: np.ndarray) -> np.ndarray:
        """For each wanted letter, the bitset of the words with it at the position."""
        have, code = np.unique(self.chars[:, position], return_inverse=True)
        member = np.zeros((len(have) + 1, self.width * 64), np.uint8)       # the last row: a letter no word has here
        member[code, np.arange(self.n)] = 1
        sets = np.packbits(member, axis=1, bitorder="little").view(np.uint64)
        row = np.minimum(np.searchsorted(have, wanted), len(have) - 1)
        return sets[np.where(have[row] == wanted, row, len(have))]


def pairs_of(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) of the set bits."""
    q, word = np.nonzero(bits)
    if not len(q):
        return q, q
    inside = np.unpackbits(np.ascontiguousarray(bits[q, word]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(inside)
    return q[at], word[at] * 64 + bit


def replaced(query: np.ndarray, index: PositionIndex, same: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words of one length that agree in the first ``same`` letters and differ in one later."""
    m = query.shape[1]
    none = np.repeat(index.full()[None], len(query), axis=0)
    one = np.zeros_like(none)
    for i in range(m):
        hit = index.at(i, query[:, i])
        if i >= same:
            one = (one & hit) | (none & ~hit)
        none &= hit
    return pairs_of(one)


def inserted(query: np.ndarray, index: PositionIndex, same: int, apart: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a word and one with a letter more, inserted behind the first ``same`` letters;
    with ``apart`` > 0 only those that differ within the last ``apart`` letters of the query,
    read from the end (the pairs that agree there are found at the other side)."""
    m = query.shape[1]
    none = np.repeat(index.full()[None], len(query), axis=0)
    one = np.zeros_like(none)
    agree = none.copy() if apart else None
    ahead = index.at(0, query[:, 0])
    for i in range(m):
        here = ahead if i == 0 else index.at(i, query[:, i])
        shifted = index.at(i + 1, query[:, i])
        if i >= same:
            one = (one | none) & shifted
        none &= here
        if apart and i >= m - apart:
            agree &= shifted
    one |= none
    return pairs_of(one & ~agree if apart else one)


def near_in(short: tuple[list[str], list[str]], long: tuple[list[str], list[str]], m: int, at_end: bool, within: bool):
    """(a, b) word pairs of two chunks (or within one) that are near and share the bucket's key.
    ``short`` and ``long``: words of m and of m + 1 letters of either chunk."""
    k = m // 2
    turn = (lambda w: [x[::-1] for x in w]) if at_end else (lambda w: w)
    same, apart = (m - k, k) if at_end else (k, 0)
    sets = [[letters(turn(w), n) for w in side] for side, n in ((short, m), (long, m + 1))]
    out = []

    def add(q, w, qs, ws, once=False):
        for a, b in zip(q.tolist(), w.tolist()):
            if not once or a < b:
                out.append((qs[a], ws[b]))

    if len(sets[0][0]) and len(sets[0][1]):
        add(*replaced(sets[0][0], PositionIndex(sets[0][1]), same), short[0], short[1], once=within)
    for a, b in ((0, 1),) if within else ((0, 1), (1, 0)):
        if len(sets[0][a]) and len(sets[1][b]):
            add(*inserted(sets[0][a], PositionIndex(sets[1][b]), same, apart), short[a], long[b])
    return out


NEAR = "word string, n_near long, best_n long, best string"


def near_words(table: pa.Table) -> pa.Table:
    """For ``applyInArrow`` on one bucket: NEAR rows, the near words met there."""
    m, at_end, i, j = (table.column(c)[0].as_py() for c in ("m", "at_end", "i", "j"))
    words, sizes, chunk = (table.column(c).to_pylist() for c in ("word", "size", "chunk"))
    count = dict(zip(words, table.column("n").to_pylist()))
    pick = lambda size, c: [w for w, s, x in zip(words, sizes, chunk) if s == size and x == c]
    pairs = near_in((pick(m, i), pick(m, j)), (pick(m + 1, i), pick(m + 1, j)), m, at_end, i == j)
    n_near: Counter = Counter()
    best: dict[str, tuple[int, str]] = {}
    for a, b in pairs:
        for x, y in ((a, b), (b, a)):
            n_near[x] += 1
            found = (-count[y], y)
            if x not in best or found < best[x]:
                best[x] = found
    return pa.table({"word": pa.array(list(n_near), pa.string()), "n_near": pa.array(list(n_near.values()), pa.int64()),
                     "best_n": pa.array([-best[x][0] for x in n_near], pa.int64()), "best": pa.array([best[x][1] for x in n_near], pa.string())})


# -- all buckets --------------------------------------------------------------
def buckets(words: DataFrame, tile: int) -> DataFrame:
    """(m, at_end, bucket, i, j, chunk, word, n, size): every word in the buckets of its keys."""
    size, m = F.length("word"), F.col("m")
    keyed = words.select("word", "n", size.alias("size"), F.explode(F.array(size, size - 1)).alias("m")).filter(m >= MIN_LETTERS) \
        .select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("at_end")) \
        .withColumn("key", F.when(F.col("at_end"), F.expr("right(word, m - m div 2)")).otherwise(F.expr("left(word, m div 2)")))
    limit = F.greatest(F.lit(2), F.least(F.lit(tile), (F.lit(TILE_LETTERS) / m).cast("int")))
    keys = materialize(keyed.groupBy("m", "at_end", "key").agg(F.count("*").alias("words")), "keys")
    packed = keys.filter(F.col("words") <= limit).groupBy("m", "at_end").agg(F.ceil(F.sum("words") / F.first(limit)).alias("buckets"))
    large = keys.filter(F.col("words") > limit).select("m", "at_end", "key", F.ceil(F.col("words") / limit).alias("chunks"))
    rows = keyed.join(large, ["m", "at_end", "key"], "left").join(packed, ["m", "at_end"], "left")
    alone = F.col("chunks").isNull()
    rows = rows.withColumn("chunk", F.when(alone, F.lit(0)).otherwise(F.pmod(F.xxhash64("word"), "chunks")).cast("int")) \
        .withColumn("bucket", F.when(alone, F.pmod(F.xxhash64("key"), "buckets").cast("string")).otherwise(F.concat(F.lit(":"), "key")))
    other = F.when(alone, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), (F.col("chunks") - 1).cast("int")))
    return rows.select("*", F.explode(other).alias("other")) \
        .select("m", "at_end", "bucket", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "word", "n", "size")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): where following forms ends. Each round doubles the steps
    taken; counts at least double along a chain, so a handful of rounds does."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        now = step.drop("moved")
        if step.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = materialize(vocabulary(docs), "words")
    near = buckets(words, tile).groupBy("m", "at_end", "bucket", "i", "j").applyInArrow(near_words, NEAR) \
        .groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first"))
    found = -F.col("first.less")
    dominant = found >= DOMINANCE * F.col("n")
    known = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(dominant, F.col("first.best")).alias("form"), F.when(dominant, found).alias("form_n")), "near")
    return known.join(roots(known.filter("form is not null")), "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    """op12: the variants among the words of all documents."""
    return variants(read_table(spark, sf_dir, "documents"))
