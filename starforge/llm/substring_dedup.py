"""Substring deduplication with super-k-mer partitioning.

Words are separated by ASCII white space and compared as they are. A window is ``WINDOW``
consecutive words of one text; a word goes if a window that covers it also starts in a
text with a smaller id. Windows are judged on the input.

The minimiser of a window is the smallest hash among its runs of ``MINIMISER`` words.
Consecutive windows that share it form a super-k-mer. First only (minimiser, id) rows
are shuffled: a minimiser met under one id alone can't belong to a shared window. The
others' super-k-mers travel as one packed string of words to their minimiser's bucket,
where the windows are laid out as rows of word numbers and sorted: equal rows are equal
windows, and the smallest id among them decides. A minimiser with more than ``HOT_RUNS``
super-k-mers (a passage that very many texts share) would make one bucket grow with the
corpus; its windows are spread singly by a 128-bit digest, aggregated on the map side to
their smallest id, and joined back (runtime skew handling splits that join). Texts stay in a
table bucketed by block; marks and spans come to them, they are not shuffled.

Nulls: a null text has no words; rows with a null id lose nothing and take nothing from
others. Rows with one id never take words from each other. Texts shorter than a window
stay whole. Empty tables give empty results; repeated rows a row each. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import BlockTable, materialize, mix64, ordered, raw, read_table, release, split_batches

WINDOW = 50
MINIMISER = 8
HOT_RUNS = 2_000
RUNS_PER_BUCKET = 5_000


def factors(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


def run_hash(h: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive entries of ``h``."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j, c in enumerate(factors(length, seed)):
            out += h[j:j + n] * c
    return mix64(out)


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries, by doubling; none of fewer entries."""
    if len(a) < width:
        return a[:0]
    out, have = a, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def word_hashes(words: list[bytes] | pa.Array, seed: int = 0) -> np.ndarray:
    code = (words if isinstance(words, pa.Array) else pa.array(words, pa.binary())).dictionary_encode()
    table = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in code.dictionary.to_numpy(zero_copy_only=False)], np.uint64)
    return table[code.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)


class Runs:
    """Super-k-mers of some texts: text number, first window, windows, minimiser of each."""

    def __init__(self, texts: list[bytes | None], window: int, minimiser: int):
        split = [t.split() if t else [] for t in texts]
        self.words = [w for s in split for w in s]
        size = np.array([len(s) for s in split], np.int64)
        self.begin = np.concatenate(([0], np.cumsum(size)))
        self.hashes = word_hashes(self.words)
        least = sliding_min(run_hash(self.hashes, minimiser, 1), window - minimiser + 1)
        owner = np.repeat(np.arange(len(texts)), size)
        start = np.arange(len(least))
        valid = start + window <= self.begin[owner[start] + 1]
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (owner[start][1:] != owner[start][:-1])
        first = np.flatnonzero(new)
        label = np.cumsum(new) - 1
        self.windows = np.bincount(label[valid], minlength=len(first)) if len(first) else np.zeros(0, np.int64)
        self.text = owner[first]
        self.at = first                                     # place in self.words
        self.start = first - self.begin[self.text]          # place in the text
        self.minimiser = least[first].view(np.int64)


MARKS = "block long, pos int, m long"
SPANS = "block long, pos int, start int, end int"


def text_blocks(docs: DataFrame, **rest) -> BlockTable:
    """doc_id and text of all rows (and what else a caller wants back)."""
    return BlockTable(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                  F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                                  *[c.alias(n) for n, c in rest.items()]))


def minimisers(blocks: BlockTable, window: int, minimiser: int) -> DataFrame:
    """(m, doc_id, block, pos) of every super-k-mer of the rows with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_batches(batches):
            runs = Runs(raw(batch), window, minimiser)
            take = pa.array(runs.text)
            yield pa.RecordBatch.from_arrays([pa.array(runs.minimiser), *(batch.column(c).take(take) for c in ("doc_id", "block", "pos"))],
                                             ["m", "doc_id", "block", "pos"])

    return blocks.rows.filter("doc_id is not null").select("doc_id", "block", "pos", "text") \
        .mapInArrow(run, "m long, doc_id long, block long, pos int")


def chosen(runs: Runs, pos: np.ndarray, marks: pa.Table) -> np.ndarray:
    """Numbers of the super-k-mers whose minimiser is among their row's marks."""
    own = np.stack((pos[runs.text].astype(np.int64), runs.minimiser), 1) if len(runs.text) else np.zeros((0, 2), np.int64)
    wanted = np.stack((marks.column("pos").to_numpy().astype(np.int64), marks.column("m").to_numpy()), 1)
    pair = np.dtype([("p", np.int64), ("m", np.int64)])
    flat = lambda a: np.ascontiguousarray(a).view(pair).ravel()
    return np.flatnonzero(np.isin(flat(own), flat(wanted))) if len(own) and len(wanted) else np.zeros(0, np.int64)


def marked_rows(texts: pa.Table, marks: pa.Table) -> pa.RecordBatch:
    """The rows of a block that have marks."""
    return ordered(texts.filter(pa.compute.is_in(texts.column("pos"), marks.column("pos").combine_chunks())))


def packed_runs(blocks: BlockTable, marks: DataFrame, window: int, minimiser: int) -> DataFrame:
    """(m, doc_id, block, pos, start, words) of the marked super-k-mers."""

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        batch = marked_rows(texts, found)
        runs = Runs(raw(batch), window, minimiser)
        keep = chosen(runs, batch.column("pos").to_numpy(), found)
        take = pa.array(runs.text[keep])
        words = [b" ".join(runs.words[a:a + n + window - 1]) for a, n in zip(runs.at[keep].tolist(), runs.windows[keep].tolist())]
        return pa.table({"m": pa.array(runs.minimiser[keep]), **{c: batch.column(c).take(take) for c in ("doc_id", "block", "pos")},
                         "start": pa.array(runs.start[keep].astype(np.int32)), "words": pa.array(words, pa.binary())})

    return blocks.beside(marks).applyInArrow(run, "m long, doc_id long, block long, pos int, start int, words binary")


def count_windows(window: int):
    """For ``applyInArrow``: the SPANS that a smaller id also has, in one bucket."""

    def run(table: pa.Table) -> pa.Table:
        ids, start = table.column("doc_id").to_numpy(), table.column("start").to_numpy().astype(np.int64)
        split = [w.split() for w in table.column("words").to_pylist()]
        size = np.array([len(s) for s in split], np.int64)
        code = pa.array([w for s in split for w in s], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int32)
        n = size - window + 1
        row = np.repeat(np.arange(len(split)), n)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        place = np.repeat(np.cumsum(size) - size, n) + offset
        rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(code, window)[place])
        order = np.argsort(rows.view(np.dtype((np.void, 4 * window))).ravel(), kind="stable")
        by_words = rows[order]
        new = np.concatenate(([True], (by_words[1:] != by_words[:-1]).any(axis=1)))
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        least = np.full(int(new.sum()), np.iinfo(np.int64).max)
        np.minimum.at(least, group, ids[row])
        hit = np.flatnonzero(least[group] < ids[row])
        # consecutive windows of one super-k-mer make one span
        r, o = row[hit], offset[hit]
        cut = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (o[1:] != o[:-1] + 1)))) if len(hit) else np.zeros(0, np.int64)
        last = np.concatenate((cut[1:], [len(hit)]))[:len(cut)] - 1
        a = start[r[cut]] + o[cut]
        b = start[r[last]] + o[last] + window
        return pa.table({**{c: pa.array(table.column(c).to_numpy()[r[cut]]) for c in ("block", "pos")},
                         "start": pa.array(a.astype(np.int32)), "end": pa.array(b.astype(np.int32))})

    return run


def hot_windows(blocks: BlockTable, marks: DataFrame, window: int, minimiser: int) -> DataFrame:
    """(w1, w2, doc_id, block, pos, start) of each window of the marked super-k-mers: a 128-bit
    digest and its place."""

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        batch = marked_rows(texts, found)
        runs = Runs(raw(batch), window, minimiser)
        keep = chosen(runs, batch.column("pos").to_numpy(), found)
        n = runs.windows[keep]
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(runs.at[keep], n) + offset
        take = pa.array(np.repeat(runs.text[keep], n))
        one = run_hash(runs.hashes, window, 2)
        two = run_hash(word_hashes(runs.words, 1), window, 3)
        return pa.table({"w1": pa.array(one[at].view(np.int64)), "w2": pa.array(two[at].view(np.int64)),
                         **{c: batch.column(c).take(take) for c in ("doc_id", "block", "pos")},
                         "start": pa.array((np.repeat(runs.start[keep], n) + offset).astype(np.int32))})

    return blocks.beside(marks).applyInArrow(run, "w1 long, w2 long, doc_id long, block long, pos int, start int")


def shared_spans(blocks: BlockTable, window: int = WINDOW, minimiser: int = MINIMISER, hot_runs: int = HOT_RUNS) -> DataFrame:
    """SPANS (in words) of the rows of :func:`text_blocks` that share a window with a smaller id."""
    runs = materialize(minimisers(blocks, window, minimiser), "minimisers")
    buckets = max(1, math.ceil(runs.count() / RUNS_PER_BUCKET))
    shared = runs.groupBy("m").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")) \
        .filter("low < high").select("m", (F.col("n") > hot_runs).alias("hot"))
    marks = materialize(runs.select("m", "block", "pos").join(shared, "m").select("block", "pos", "m", "hot"), "marks")
    spans = packed_runs(blocks, marks.filter("not hot").drop("hot"), window, minimiser) \
        .groupBy(F.pmod("m", F.lit(buckets)).alias("bucket")).applyInArrow(count_windows(window), SPANS)
    hot = marks.filter("hot").drop("hot")
    if not hot.isEmpty():
        single = materialize(hot_windows(blocks, hot, window, minimiser), "hot_windows")
        least = single.groupBy("w1", "w2").agg(F.min("doc_id").alias("low"))
        spans = spans.unionByName(single.join(least, ["w1", "w2"]).filter("low < doc_id")
                                  .select("block", "pos", "start", (F.col("start") + window).alias("end")))
    return materialize(spans, "spans")


def gone(spans: np.ndarray, n: int) -> np.ndarray:
    """Which of a text's n words its (start, end) spans cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, spans[:, 0], 1)
    np.add.at(edge, spans[:, 1], -1)
    return np.cumsum(edge[:n]) > 0


def spans_of(batch: pa.RecordBatch, found: pa.Table) -> list[np.ndarray]:
    """The (start, end) spans of each row of a block."""
    pos = found.column("pos").to_numpy()
    order = np.argsort(pos, kind="stable")
    both = np.stack([found.column(c).to_numpy()[order].astype(np.int64) for c in ("start", "end")], 1)
    edge = np.searchsorted(pos[order], batch.column("pos").to_numpy())
    end = np.searchsorted(pos[order], batch.column("pos").to_numpy(), side="right")
    return [both[a:b] for a, b in zip(edge, end)]


def digests(texts: pa.Table, found: pa.Table) -> pa.Table:
    batch, out = ordered(texts), []
    for text, spans in zip(raw(batch), spans_of(batch, found)):
        words = text.split()
        drop = gone(spans, len(words))
        kept = b" ".join(w for w, d in zip(words, drop.tolist()) if not d)
        out.append((len(words), int(drop.sum()), hashlib.sha256(kept).hexdigest()))
    return pa.table({"doc_id": batch.column("doc_id"), "n_words": pa.array([x[0] for x in out], pa.int64()),
                     "n_removed": pa.array([x[1] for x in out], pa.int64()), "kept_sha256": pa.array([x[2] for x in out], pa.string())})


def removed(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    blocks = text_blocks(docs)
    out = blocks.beside(shared_spans(blocks, **options)).applyInArrow(digests, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    out = materialize(out, "removed")
    blocks.drop()
    return out


def query(spark, sf_dir: str) -> DataFrame:
    """op7: words removed from every document."""
    return removed(read_table(spark, sf_dir, "documents"))


def cut_text(text: bytes, spans: np.ndarray) -> bytes:
    """``text`` without the words in ``spans`` and the white space inside them."""
    inside = np.frombuffer(text, np.uint8)
    space = (inside == 0x20) | ((inside >= 0x09) & (inside <= 0x0D))
    edges = np.flatnonzero(np.diff(np.concatenate(([0], ~space, [0])).astype(np.int8)))
    starts = edges[::2]
    drop = np.flatnonzero(np.diff(np.concatenate(([0], gone(spans, len(starts)), [0])).astype(np.int8)))
    out, at = [], 0
    for a, b in zip(drop[::2].tolist(), drop[1::2].tolist()):
        out.append(text[at:starts[a]])
        at = int(starts[b]) if b < len(starts) else len(text)
    return b"".join([*out, text[at:]])


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: repeated passages are cut out of the later documents;
    documents without a word left by that go. n_chars follows the text."""
    rest = [c for c in docs.columns if c != "text"]
    blocks = text_blocks(docs, rest=F.struct(*rest), bare=F.col("text").isNull())
    kind = docs.select(F.struct(*rest).alias("rest")).schema["rest"].dataType.simpleString()

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        batch = ordered(texts)
        old, spans = raw(batch), spans_of(batch, found)
        cut = [len(s) > 0 for s in spans]
        new = [cut_text(t, s) if c else t for t, s, c in zip(old, spans, cut)]
        bare = batch.column("bare").to_pylist()
        keep = pa.array([not c or bool(t.split()) for t, c in zip(new, cut)])
        new = pa.array([None if b else t for t, b in zip(new, bare)], pa.binary()).cast(pa.string())
        release()
        return pa.table({"rest": batch.column("rest"), "text": new, "cut": pa.array(cut)}).filter(keep)

    out = blocks.beside(shared_spans(blocks)).applyInArrow(run, f"rest {kind}, text string, cut boolean")

    def column(c: str):
        if c == "text":
            return F.col("text")
        own = F.col(f"rest.`{c}`")
        return F.when(F.col("cut"), F.length("text").cast(docs.schema[c].dataType)).otherwise(own).alias(c) if c == "n_chars" else own.alias(c)

    out = materialize(out.select(*[column(c) for c in docs.columns]), "cut")
    blocks.drop()
    return out
