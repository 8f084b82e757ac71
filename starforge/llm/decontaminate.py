"""Benchmark decontamination with a generalised suffix automaton of the test items.

Words are lower-cased (A-Z) runs of digits, a-z and non-ASCII characters. The
items' words build one automaton per block of at most ``BLOCK_WORDS`` item words
(blocks bound what is broadcast; the benchmark may be of any size, documents are
scanned once per block). A document's words walk it, tracking the longest match
that ends at each word: a match of at least ``window`` words covers the last
``window`` of them, and an item shorter than that must match as a whole.

Nulls: a null text (document or item) has no words; null item ids take part under
the empty name; a null doc_id is kept. Items without words are ignored. Empty
tables: no items means nothing is hit. Repeated documents give a row each; repeated
items count once per distinct id. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import ALNUM_TO_SPACE, per_text, raw, read_table, released, split_batches

WINDOW = 13
BLOCK_WORDS = 200_000
MIN_COVERAGE = 1 / 20       # of a document's words, for it to count as contaminated


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().translate(ALNUM_TO_SPACE).split() if text else []


class SuffixAutomaton:
    """All substrings of several word sequences, and which items hold their windows."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        places = []
        for name, words in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            places.append((number[name], ids))
            last = 0
            for c in ids:
                last = self._extend(last, c)
        n = len(self.link)
        # windows: state of the last `window` words -> items; short items: state -> (length, item)
        self.items_at: list[set[int]] = [set() for _ in range(n)]
        short_at: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for item, ids in places:
            if 0 < len(ids) < window:
                short_at[self._locate(ids)].append((len(ids), item))
            else:
                state = size = 0
                for c in ids:
                    state, size = self._step(state, size, c)
                    if size >= window:
                        state, size = self._shorten(state, size)
                        self.items_at[state].add(item)
        #: per state, its own short items and, longest first, those of shorter suffixes
        self.short_at = short_at
        self.above: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for state in sorted(range(1, n), key=self.length.__getitem__):
            up = self.link[state]
            self.above[state] = short_at[up] + self.above[up]
        self.least = min([window, *(len(ids) for _, ids in places if ids)])

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def _step(self, state: int, size: int, c: int) -> tuple[int, int]:
        """The longest suffix of the text read so far that is in the automaton."""
        nxt, link, length = self.next, self.link, self.length
        while state and c not in nxt[state]:
            state = link[state]
            size = length[state]
        to = nxt[state].get(c)
        return (0, 0) if to is None else (to, size + 1)

    def _shorten(self, state: int, size: int) -> tuple[int, int]:
        """The state of the last ``window`` words of a match."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state, min(size, self.window)

    def _locate(self, ids: list[int]) -> int:
        state = 0
        for c in ids:
            state = self.next[state][c]
        return state

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """The [start, end) spans covered by windows, as starts and ends by place; the items found."""
        ids = np.array(list(map(self.vocab.get, words, [-1] * len(words))), np.int64)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).astype(np.int8), [0]))))
        spans, found = [], set()
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a < self.least:
                continue
            state = size = 0
            for i, c in enumerate(ids[a:b].tolist(), a + 1):
                state, size = self._step(state, size, c)
                covered = 0
                if size >= self.window:
                    state, size = self._shorten(state, size)
                    found |= self.items_at[state]
                    covered = self.window
                if self.above[state] or self.short_at[state]:
                    whole = [x for x in self.short_at[state] if x[0] <= size] + self.above[state]
                    found.update(item for _, item in whole)
                    covered = max([covered, *(n for n, _ in whole)])
                if covered:
                    spans.append((i - covered, i))
        return np.array(spans, np.int64).reshape(-1, 2), found


def covered(spans: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in any span."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, spans[:, 0], 1)
    np.add.at(edge, spans[:, 1], -1)
    return np.cumsum(edge[:n]) > 0


def item_blocks(benchmark: DataFrame, id_column: str, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in blocks of at most ``block_words`` words (a single longer item is a block),
    fetched one block at a time."""
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("name"),
                            F.col("text").cast("string").alias("text"))
    for row in rows.toLocalIterator():
        words = words_of(row["text"].encode() if row["text"] else None)
        if not words:
            continue
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((row["name"], words))
        size += len(words)
    if block:
        yield block


def scan_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_id: str = "item_id",
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, spans (covered word ranges, sorted, disjoint),
    n_hit, and items (sorted ids of the items found).

    With more than one block of items, each block scans the documents and passes on
    what it found; a document's spans never leave its row, so nothing is shuffled."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = per_text(docs, ["doc_id"]).select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<string>").alias("items"), F.array().cast("array<long>").alias("spans"))
    schema = f"doc_id {kind}, text string, n_words long, n_hit long, items array<string>, spans array<long>"
    blocks = 0
    for block in item_blocks(benchmark, item_id, block_words):
        blocks += 1
        out = out.mapInArrow(_scanner(docs.sparkSession.sparkContext.broadcast(SuffixAutomaton(block, window))), schema)
    if not blocks:
        out = out.mapInArrow(_scanner(docs.sparkSession.sparkContext.broadcast(SuffixAutomaton([], window))), schema)
    return out


def _scanner(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in split_batches(batches):
            n_words, n_hit, items, spans = [], [], [], []
            before = zip(batch.column("items").to_pylist(), batch.column("spans").to_pylist())
            for text, (old_items, old_spans) in zip(raw(batch), before):
                words = words_of(text)
                found, names = automaton.scan(words)
                hit = covered(np.concatenate([found, np.array(old_spans, np.int64).reshape(-1, 2)]), len(words))
                n_words.append(len(words))
                n_hit.append(int(hit.sum()))
                items.append(sorted({*old_items, *(automaton.names[k] for k in names)}))
                spans.append(np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.int64()))],
                ["doc_id", "text", "n_words", "n_hit", "items", "spans"])

    return run


def contaminated(min_coverage: float = MIN_COVERAGE):
    """Whether a row of :func:`scan_documents` has hits that reach the coverage limit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * round(1 / min_coverage) >= F.col("n_words"))


def remove_spans(text: str, spans: list[int], limit: int) -> str:
    """``text`` without the covered word ranges of at least ``limit`` words."""
    data = text.encode()
    edges = np.flatnonzero(np.diff(np.concatenate(
        ([0], np.frombuffer(data.lower().translate(ALNUM_TO_SPACE), np.uint8) != 0x20, [0])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        if b - a >= limit:
            out.append(data[at:starts[a]])
            at = int(ends[b - 1])
    return b"".join([*out, data[at:]]).decode()


def excise(scanned: DataFrame, min_span: int = WINDOW) -> DataFrame:
    """doc_id and text of every scanned document, without its spans of at least ``min_span`` words."""
    cut = F.udf(lambda text, spans: remove_spans(text, spans, min_span) if text and spans else text, "string")
    touched = F.expr(f"exists(sequence(1, size(spans), 2), k -> element_at(spans, k + 1) - element_at(spans, k) >= {int(min_span)})")
    return scanned.select("doc_id", F.when((F.size("spans") > 0) & touched, cut("text", "spans")).otherwise(F.col("text")).alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: per document, the words and items that a window of the benchmark covers."""
    scanned = scan_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return scanned.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: documents whose covered words reach the coverage limit go;
    all others stay as they are."""
    row = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), F.col("text"))
    automata = [spark.sparkContext.broadcast(SuffixAutomaton(block, WINDOW))
                for block in item_blocks(read_table(spark, sf_dir, "benchmark"), "item_id", BLOCK_WORDS)]
    if not automata:
        return docs

    def run(batches):
        for batch in split_batches(batches):
            keep = []
            for text in raw(batch):
                words = words_of(text)
                hit = covered(np.concatenate([a.value.scan(words)[0] for a in automata]), len(words)).sum() if words else 0
                keep.append(not (hit > 0 and hit * round(1 / MIN_COVERAGE) >= len(words)))
            yield batch.select(["row"]).filter(pa.array(keep))

    kept = row.mapInArrow(released(run), f"row {row.schema['row'].dataType.simpleString()}")
    return kept.select("row.*")


ORACLE_SQL = """
WITH doc AS (
  SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS name, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT name, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT name, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc CROSS JOIN sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, name, grams.n AS n, i FROM grams JOIN win ON grams.n = win.n AND grams.g = win.g),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hits)) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS joined FROM (SELECT DISTINCT doc_id, name FROM hits) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN places USING (doc_id) LEFT JOIN names USING (doc_id)
"""
