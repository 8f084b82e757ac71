"""N-gram Jaccard join of documents with a MinHash LSH forest.

A text's shingles are its runs of ``SHINGLE`` words (lower-cased A-Z, separated by ASCII
white space; a shorter text is one shingle of all its words). Texts with equal shingle
sets form one class; a class is represented by its smallest id. The forest has ``TREES``
tries over signatures of ``DEPTH`` minimum hashes each. Matched prefixes are shortened
from the full depth until pairs at the threshold are found with the target recall:
``1 - (1 - threshold ** depth) ** trees`` (see :func:`prefix_depth`).

No pairs are emitted: in a trie's bucket every member is tied to the bucket's smallest
member and to its neighbour in trie order. Ties whose signatures agree in less than
``LOOSE`` of their places are dropped (two members of a bucket that are similar enough
can't both be that far from what they are tied to in all trees). The ties' connected
components hold all candidates. Exact verification then compares every pair of a
component by its whole shingle sets, in tiles of at most ``TILE`` x ``TILE`` texts as a
matrix product; tiles return, per text, how many others reach the threshold and a
spanning forest of these links, never the pairs.

Nulls: a null or empty text has no shingles and no links; a row with a null id is
returned with a null class and compared with nothing. Repeated rows and equal texts
count as links of each other. Rows under one id with other texts are different documents
of one name. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import materialize, raw, read_table, split_batches
from starforge.llm.components import connected_components
from starforge.llm.substring_dedup import factors, run_hash, word_hashes

SHINGLE = 5
THRESHOLD = (4, 5)          # 0.8, as a fraction
TREES = 32
DEPTH = 8                   # minimum hashes of one trie's full prefix
RECALL = 0.9999
LOOSE = 0.3
TILE = 800
BIN = 400                   # texts of small components verified in one task


def prefix_depth(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix, shortened from ``depth``, at which a pair at the threshold meets
    in some tree with the target recall."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(texts: list[bytes | None], shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    split = [t.lower().split() if t else [] for t in texts]
    h = word_hashes([w for s in split for w in s])
    runs = run_hash(h, shingle, 5)
    out, at = [], 0
    for s in split:
        n = len(s)
        out.append(np.unique(runs[at:at + n - shingle + 1]) if n >= shingle else run_hash(h[at:at + n], n, 6) if n else np.zeros(0, np.uint64))
        at += n
    return out


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """(texts, count) minimum hashes of non-empty sets."""
    a, b = factors(count, 8).astype(np.uint32) | np.uint32(1), factors(count, 9).astype(np.uint32)
    out = np.full((len(sets), count), np.iinfo(np.uint32).max, np.uint32)
    for k, s in enumerate(sets):
        x = (s >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(x), 1024):
            m = np.multiply.outer(a, x[at:at + 1024])
            m += b[:, None]
            m ^= m >> np.uint32(15)
            m *= np.uint32(0x85EBCA6B)
            np.minimum(out[k], m.min(axis=1), out=out[k])
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, tag (tells texts under one id apart) and text of the rows with an id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.filter(F.col("doc_id").isNotNull()) \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))


def sign(docs: DataFrame, trees: int, depth: int, prefix: int) -> DataFrame:
    """doc_id, tag, set digest (null without shingles), trie keys (the prefix's hash per
    tree) and a byte of every minimum hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_batches(batches):
            sets = shingle_sets(raw(batch))
            sig = signatures(sets, trees * depth)
            grid = sig.reshape(-1, trees, depth)[:, :, :prefix].astype(np.uint64)
            keys = np.zeros(grid.shape[:2], np.uint64)
            for j, c in enumerate(factors(prefix, 10)):
                keys = keys * np.uint64(0x9E3779B97F4A7C15) + (grid[:, :, j] + np.uint64(1)) * c
            some = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tag"),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array([k if ok else None for k, ok in zip(keys.view(np.int64), some)], pa.list_(pa.int64())),
                 pa.array([(x >> np.uint32(24)).astype(np.uint8).tobytes() if ok else None for x, ok in zip(sig, some)], pa.binary())],
                ["doc_id", "tag", "digest", "keys", "sig"])

    return docs.mapInArrow(run, "doc_id long, tag long, digest binary, keys array<long>, sig binary")


def forest_ties(classes: DataFrame, trees: int, depth: int) -> DataFrame:
    """(a, b): ties of classes (id, keys) inside the tries' buckets: to the smallest member and
    to the neighbour in trie order. Rows are sorted by (tree, prefix, full prefix) within
    partitions and read as a stream; a bucket is never held."""
    rows = classes.select("id", "sig", F.posexplode("keys").alias("tree", "key")) \
        .select("id", "tree", "key", F.substring("sig", F.col("tree") * depth + 1, F.lit(depth)).alias("path")) \
        .repartition("tree", "key").sortWithinPartitions("tree", "key", "path", "id").select("id", "tree", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = key = first = last = None
        for batch in batches:
            ids, t, k = (batch.column(c).to_numpy() for c in ("id", "tree", "key"))
            if not len(ids):
                continue
            new = np.concatenate(([tree is None or t[0] != tree or k[0] != key], (t[1:] != t[:-1]) | (k[1:] != k[:-1])))
            head = np.where(new, np.arange(len(ids)), -1)
            np.maximum.accumulate(head, out=head)
            lead = np.where(head >= 0, ids[np.maximum(head, 0)], first if first is not None else 0)
            before = np.concatenate(([last if last is not None else 0], ids[:-1]))
            old = np.flatnonzero(~new)
            pairs = np.unique(np.concatenate((np.stack((lead[old], ids[old]), 1), np.stack((before[old], ids[old]), 1))), axis=0) \
                if len(old) else np.zeros((0, 2), np.int64)
            tree, key, first, last = t[-1], k[-1], lead[-1], ids[-1]
            yield pa.RecordBatch.from_arrays([pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").filter("a <> b").distinct()


def loosely_alike(ties: DataFrame, classes: DataFrame, loose: float) -> DataFrame:
    """The ties whose signatures agree in at least ``loose`` of their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("x", "y"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= loose)) if batch.num_rows else batch.select(["a", "b"])

    sig = classes.select("id", "sig")
    return ties.join(sig.withColumnsRenamed({"id": "a", "sig": "x"}), "a").join(sig.withColumnsRenamed({"id": "b", "sig": "y"}), "b") \
        .select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def linked(one: list[np.ndarray], two: list[np.ndarray] | None, threshold: tuple[int, int]) -> np.ndarray:
    """Which pairs of sets (of one list, or across two) reach the threshold, exactly."""
    sets = one + (two or [])
    size = np.array([len(s) for s in sets])
    values, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    _, code, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count[code] > 1                        # only these meet
    code, row = code[shared], row[shared]
    _, code = np.unique(code, return_inverse=True)
    n, m = len(one), len(sets)
    common = np.zeros((n, m if two is None else m - n), np.float32)
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, 8192):
        a, b = np.searchsorted(code, (low, low + 8192))
        block = np.zeros((m, int(code[b - 1]) - low + 1), np.float32)
        block[row[a:b], code[a:b] - low] = 1
        common += block[:n] @ (block if two is None else block[n:]).T
    union = size[:n, None] + (size[None, :] if two is None else size[None, n:]) - common
    return common * threshold[1] >= union * threshold[0]


def spanning(adjacent: np.ndarray) -> np.ndarray:
    """Smallest connected position of each row of a square boolean matrix."""
    label = np.arange(len(adjacent))
    while True:
        low = np.minimum(label, np.where(adjacent, label[None, :], len(label)).min(axis=1, initial=len(label)))
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def verify_tile(threshold: tuple[int, int]):
    """For ``applyInArrow`` over (component, side, id, copies, shingles): per text the copies
    linked to it, and a smaller text it is connected with in this tile. Sides 0 and 1 are
    the two chunks of a tile across chunks; -1 is a tile of one chunk with itself."""

    def run(table: pa.Table) -> pa.Table:
        comp, ids = table.column("component").to_numpy(), table.column("id").to_numpy()
        side, copies = table.column("side").to_numpy(), table.column("copies").to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        out_id, out_links, out_to = [], [], []
        order = np.lexsort((ids, comp))
        for group in np.split(order, np.flatnonzero(np.diff(comp[order])) + 1):
            if side[group[0]] == -1:
                nodes = group
                adjacent = linked([sets[k] for k in nodes], None, threshold)
                np.fill_diagonal(adjacent, False)
            else:
                left, right = group[side[group] == 0], group[side[group] == 1]
                nodes = np.concatenate((left, right))
                adjacent = np.zeros((len(nodes), len(nodes)), bool)
                if len(left) and len(right):
                    adjacent[:len(left), len(left):] = linked([sets[k] for k in left], [sets[k] for k in right], threshold)
                    adjacent |= adjacent.T
            rank = np.argsort(ids[nodes], kind="stable")
            nodes, adjacent = nodes[rank], adjacent[np.ix_(rank, rank)]
            out_id.append(ids[nodes])
            out_links.append(adjacent @ copies[nodes])
            out_to.append(ids[nodes][spanning(adjacent)])
        return pa.table({"id": np.concatenate(out_id), "links": np.concatenate(out_links).astype(np.int64), "to": np.concatenate(out_to)})

    return run


def shingles_of(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["component", "chunk", "chunks", "id", "copies"]
        for batch in split_batches(batches):
            sets = pa.array([s.tobytes() for s in shingle_sets(raw(batch))], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), sets], [*names, "shingles"])

    return docs.mapInArrow(run, "component long, chunk int, chunks int, id long, copies long, shingles binary")


def near_duplicates(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, trees: int = TREES, depth: int = DEPTH,
                    recall: float = RECALL, loose: float = LOOSE, tile: int = TILE) -> DataFrame:
    """doc_id, tag, class_id (the smallest id of its near-duplicate group) and n_links (other
    documents that reach the threshold) of every row of :func:`keyed`."""
    prefix = prefix_depth(threshold[0] / threshold[1], trees, depth, recall)
    signed = materialize(sign(docs, trees, depth, prefix), "signatures")
    # one row per shingle set; ``id`` numbers sets (ids may repeat, sets don't)
    number = F.xxhash64("digest")
    classes = materialize(
        signed.filter("digest is not null").groupBy("digest")
        .agg(F.min(F.struct("doc_id", "tag", "keys", "sig")).alias("r"), F.count("*").alias("copies"))
        .select(number.alias("id"), F.col("r.doc_id").alias("doc_id"), F.col("r.tag").alias("tag"),
                F.col("r.keys").alias("keys"), F.col("r.sig").alias("sig"), "copies"), "classes")
    ties = loosely_alike(forest_ties(classes, trees, depth), classes, loose)
    candidate = materialize(connected_components(ties), "candidates")
    sizes = candidate.groupBy("root").agg(F.ceil(F.count("*") / tile).cast("int").alias("chunks"))
    members = candidate.join(sizes, "root").join(classes.select("id", "doc_id", "tag", "copies"), "id") \
        .select("doc_id", "tag", F.col("root").alias("component"), F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"),
                "chunks", "id", "copies")
    bins = max(1, math.ceil(candidate.count() / BIN))
    sets = shingles_of(docs.join(members, ["doc_id", "tag"]).dropDuplicates(["doc_id", "tag"])
                       .select("text", "component", "chunk", "chunks", "id", "copies"))
    # a text meets the chunks before its own as side 1, those after as side 0
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    tiles = sets.withColumn("other", other).select(
        "component", "id", "copies", "shingles",
        F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("component"), F.lit(bins))).otherwise(F.col("component")).alias("t0"),
        F.when(F.col("chunks") == 1, -1).otherwise(F.least("chunk", "other")).alias("t1"),
        F.when(F.col("chunks") == 1, -1).otherwise(F.greatest("chunk", "other")).alias("t2"),
        F.when(F.col("chunk") == F.col("other"), -1).otherwise((F.col("chunk") > F.col("other")).cast("int")).alias("side"))
    found = materialize(tiles.groupBy("t0", "t1", "t2").applyInArrow(verify_tile(threshold), "id long, links long, to long"), "links")
    root = connected_components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    named = root.join(classes.select("id", "doc_id"), "id")
    leader = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    group = named.join(leader, "root").select("id", "class_id")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    summary = materialize(
        classes.select("id", "doc_id", "copies").join(links, "id", "left").join(group, "id", "left")
        .select("id", F.coalesce("class_id", "doc_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        "summary")
    rows = signed.select("doc_id", "tag", number.alias("id"), F.col("digest").isNull().alias("bare"))
    return rows.filter("not bare").join(summary, "id").select("doc_id", "tag", "class_id", "n_links") \
        .unionByName(rows.filter("bare").select("doc_id", "tag", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: the near-duplicate group and number of links of every document."""
    docs = read_table(spark, sf_dir, "documents")
    unnamed = docs.filter(F.col("doc_id").isNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return near_duplicates(keyed(docs)).select("doc_id", "class_id", "n_links").unionByName(unnamed)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: of each near-duplicate group the document with the smallest id
    stays (once, if it is repeated); rows with a null id stay."""
    found = materialize(near_duplicates(keyed(docs)), "near")
    # several texts may have the group's smallest id; the smallest tag among them stays
    first = found.filter("doc_id = class_id").groupBy("class_id").agg(F.min("tag").alias("__tag")) \
        .select(F.col("class_id").alias("__id"), "__tag")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("__id"),
                       F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("__tag"))
    kept = rows.join(first, ["__id", "__tag"]).dropDuplicates(["__id", "__tag"]).select("row.*")
    return kept.unionByName(rows.filter(F.col("__id").isNull()).select("row.*"))
