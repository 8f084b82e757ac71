"""Conversation prefix trie with a node table per block, addressed by minimal perfect hashing.

Every conversation is rebuilt (:func:`paths`): the first h original turns of conversation
c - c % 20, then its own turns after its first h, with h = crc32(decimal c) % 4. A node is a
distinct sequence of first turns, named by a 128-bit digest of (parent's digest, last turn).

Turns are reduced to 128-bit digests and word counts before anything is shuffled, dealt out by
c - c % 20 and streamed in order, so that a conversation's head is at hand when it is needed.
A task cuts what it rebuilds into blocks of about ``BLOCK_ROWS`` path entries. In a block the
distinct digests are enumerated and get slots from a minimal perfect hash, every slot is
verified against the digest it holds, and member counts are scattered into flat arrays. So a
node that all conversations share travels once per block. The blocks' counts are summed by
digest; the block that holds a node's smallest member owns the node. Each block then takes the
values of the nodes it owns (words saved, childless or not) and adds them up through the array
of parent slots, deepest first. A block holds all ancestors of its nodes, so these sums over
blocks are the sums over whole subtrees.

The members that end at a node are hashed in numeric order: id ranges of 1,024 are joined to
strings first, then one task streams a node's strings through SHA-256.

Nulls: a null turn comes first, a null role or text is empty; rows with a null conversation
are left out (they belong to none). Ties in turn are ordered by the digest of (role, text);
repeated rows are turns like others. A conversation absent from the table is not rebuilt.
Very long texts are hashed whole. A conversation is a path, so one block keeps 16 bytes and a
few numbers of each of its turns. An empty table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import materialize, mix64, read_table

HEAD = 3                    # h is at most 3
SPAN = 20                   # conversations c - c % 20 lend their head to 20 others
BLOCK_ROWS = 100_000
IDS_PER_CHUNK_BITS = 10
ROOT = hashlib.md5(b"").digest()


class SlotTable:
    """Minimal perfect hash of distinct 128-bit digests: levels of bit arrays, in each of which a
    digest that is alone at its place has found its slot. ``digest[slot]`` verifies a look-up."""

    LOAD = 1.5

    def __init__(self, digests: np.ndarray):
        """``digests``: n x 2 uint64, distinct."""
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []      # (bit, slots before it) per level
        rest, used = digests, 0
        while len(rest):
            size = int(len(rest) * self.LOAD) + 1
            at = self._place(rest, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append((alone, used + np.cumsum(alone) - alone))
            used += int(alone.sum())
            rest = rest[~alone[at]]
        self.digest = np.zeros((len(digests), 2), np.uint64)
        self.digest[self._slots(digests)] = digests

    @staticmethod
    def _place(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = mix64(digests[:, 0] + mix64(digests[:, 1] + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)))
        return (h % np.uint64(size)).astype(np.int64)

    def _slots(self, digests: np.ndarray) -> np.ndarray:
        slot, rest = np.full(len(digests), -1), np.arange(len(digests))
        for level, (alone, before) in enumerate(self.levels):
            at = self._place(digests[rest], level, len(alone))
            hit = alone[at]
            slot[rest[hit]] = before[at[hit]]
            rest = rest[~hit]
        return slot

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """Slot of each digest; -1 for one that is not in the table."""
        slot = self._slots(digests)
        known = slot >= 0
        slot[known] = np.where((self.digest[slot[known]] == digests[known]).all(axis=1), slot[known], -1)
        return slot


def as_digests(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint64).reshape(-1, 2)


def as_binary(digests: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(digests).tobytes()
    return pa.array([raw[k:k + 16] for k in range(0, len(raw), 16)], pa.binary())


class Block:
    """Path entries of some rebuilt conversations: one per (conversation, depth)."""

    def __init__(self):
        self.conv, self.depth, self.words, self.digest, self.parent = [], [], [], [], []
        self.ends: list[tuple[bytes, int]] = []

    def add(self, conv: int, turns: list[tuple[bytes, int]], depth: int, last: bytes) -> bytes:
        """Turns of one conversation below the node ``last``; the node they lead to."""
        for digest, words in turns:
            depth += 1
            node = hashlib.md5(last + digest).digest()
            self.conv.append(conv)
            self.depth.append(depth)
            self.words.append(words)
            self.digest.append(node)
            self.parent.append(last)
            last = node
        return last

    def start(self, conv: int) -> None:
        self.conv.append(conv)
        self.depth.append(0)
        self.words.append(0)
        self.digest.append(ROOT)
        self.parent.append(ROOT)

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        path, up = as_digests(self.digest), as_digests(self.parent)
        flat = path.view([("a", np.uint64), ("b", np.uint64)]).ravel()
        table = SlotTable(np.unique(flat).view(np.uint64).reshape(-1, 2))
        slot, above = table.slots(path), table.slots(up)
        if (slot < 0).any() or (above < 0).any():
            raise AssertionError("a path entry is missing from its node table")
        n = len(table.digest)
        members = np.bincount(slot, minlength=n)
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, slot, np.array(self.conv, np.int64))
        parent, depth, words = (np.zeros(n, np.int64) for _ in range(3))
        for out, values in ((parent, above), (depth, np.array(self.depth)), (words, np.array(self.words))):
            out[slot] = values
        up_digest = as_binary(table.digest[parent]).to_pylist()
        yield batch("node", n, block=np.full(n, block), slot=np.arange(n), digest=as_binary(table.digest),
                    parent=pa.array([None if d == 0 else u for d, u in zip(depth.tolist(), up_digest)], pa.binary()),
                    parent_slot=parent, depth=depth, words=words, n=members, conv_id=least)
        m = len(self.ends)
        yield batch("end", m, digest=pa.array([d for d, _ in self.ends], pa.binary()), conv_id=np.array([c for _, c in self.ends], np.int64))


ENTRY = "kind string, block long, slot long, digest binary, parent binary, parent_slot long, depth long, words long, n long, conv_id long"


def batch(kind: str, rows: int, **columns) -> pa.RecordBatch:
    arrays, names = [pa.array([kind] * rows, pa.string())], ["kind"]
    for field in ENTRY.split(", ")[1:]:
        name, is_binary = field.split()[0], field.endswith("binary")
        got = columns.get(name)
        arrays.append(pa.nulls(rows, pa.binary() if is_binary else pa.int64()) if got is None else pa.array(got, pa.binary() if is_binary else pa.int64()))
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names)


def taken(conv: int) -> int:
    """How many first turns a conversation takes from the head of its span."""
    return zlib.crc32(str(conv).encode()) % 4


def rebuild(block_rows: int):
    """For ``mapInArrow`` over turns in order: ENTRY rows of blocks of rebuilt conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        block, base, conv, head = Block(), None, None, []
        seen = skip = depth = 0
        last = ROOT
        for got in batches:
            for b, c, digest, words in zip(*(got.column(k).to_pylist() for k in ("base", "conv_id", "digest", "words"))):
                if c != conv:
                    if conv is not None:
                        block.ends.append((last, conv))
                        if len(block.conv) >= block_rows:
                            yield from block.rows(number)
                            block, number = Block(), number + 1
                    if b != base:
                        base, head = b, []
                    conv, seen, skip = c, 0, 0
                    block.start(c)
                    last, depth = ROOT, 0
                    if c != b:          # the span's first conversation takes its head from itself
                        skip = taken(c)
                        last, depth = block.add(c, head[:skip], 0, ROOT), len(head[:skip])
                if c == b and seen < HEAD:
                    head.append((digest, words))
                if seen >= skip:
                    last, depth = block.add(c, [(digest, words)], depth, last), depth + 1
                seen += 1
        if conv is not None:
            block.ends.append((last, conv))
            yield from block.rows(number)

    return run


def paths(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """ENTRY rows: ``node`` rows, one per (block, distinct prefix), and ``end`` rows, one per conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    small = turns.filter("conv_id is not null").select(
        (conv - conv % SPAN).alias("base"), conv.alias("conv_id"), F.col("turn").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = ["base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "digest"]
    return small.repartition("base").sortWithinPartitions(*order).drop("turn").mapInArrow(rebuild(block_rows), ENTRY)


def accumulate(table: pa.Table) -> pa.Table:
    """For ``applyInArrow`` on a block's nodes: what the nodes owned here add to each node's
    subtree, and the parents of the owned ones."""
    column = lambda c: table.column(c).to_numpy()
    slot, n = column("slot"), table.num_rows
    parent, depth, leaves, saved, first = (np.zeros(n, np.int64) for _ in range(5))
    own = np.zeros(n, bool)
    for out, name in ((parent, "parent_slot"), (depth, "depth"), (own, "own"), (leaves, "leaf"), (saved, "saved"), (first, "first")):
        out[slot] = column(name)
    leaves, saved = leaves * own, saved * own
    by_depth = np.argsort(depth, kind="stable")
    edge = np.searchsorted(depth[by_depth], np.arange(int(depth.max()) + 2))
    for d in range(int(depth.max()), 0, -1):
        here = by_depth[edge[d]:edge[d + 1]]
        np.add.at(leaves, parent[here], leaves[here])
        np.add.at(saved, parent[here], saved[here])
    above = pa.array(first[parent], mask=~own | (depth == 0))
    return pa.table({"digest": table.column("digest"), "n_leaves": pa.array(leaves[slot]), "saved_tokens": pa.array(saved[slot]),
                     "parent_conv_id": above.take(pa.array(slot))})


def end_hashes(ends: DataFrame) -> DataFrame:
    """(digest, ends_sha256): SHA-256 of the ids that end at each node, ascending, joined by commas."""
    chunk = ends.groupBy("digest", F.shiftright("conv_id", IDS_PER_CHUNK_BITS).alias("chunk")) \
        .agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        out = lambda: pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], ["digest", "ends_sha256"])
        for got in batches:
            done = []
            for digest, ids in zip(got.column("digest").to_pylist(), got.column("ids").to_pylist()):
                if digest != node:
                    if node is not None:
                        done.append((node, sha.hexdigest()))
                    node, sha = digest, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in done], pa.binary()), pa.array([h for _, h in done])], ["digest", "ends_sha256"])
        if node is not None:
            yield out()

    return chunk.repartition("digest").sortWithinPartitions("digest", "chunk").drop("chunk").mapInArrow(run, "digest binary, ends_sha256 string")


def trie(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, and digest and parent_digest."""
    entries = materialize(paths(turns, block_rows), "entries")
    local = entries.filter("kind = 'node'")
    total = local.groupBy("digest").agg(
        F.sum("n").alias("n_convs"), F.min(F.struct("conv_id", "block")).alias("owner"), F.min("parent").alias("parent"),
        F.max("depth").alias("depth"), F.max("words").alias("words"))
    total = materialize(total, "totals")
    children = total.filter("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "digest")
    nodes = materialize(total.join(children, "digest", "left").select(
        "digest", "parent", "depth", "n_convs", F.col("owner.conv_id").alias("conv_id"), F.col("owner.block").alias("owner_block"),
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "nodes")
    known = nodes.select("digest", "owner_block", F.col("conv_id").alias("first"), "saved", (F.col("n_children") == 0).cast("long").alias("leaf"))
    sums = local.select("digest", "block", "slot", "parent_slot", "depth").join(known, "digest") \
        .withColumn("own", F.col("block") == F.col("owner_block")).drop("owner_block") \
        .groupBy("block").applyInArrow(accumulate, "digest binary, n_leaves long, saved_tokens long, parent_conv_id long") \
        .groupBy("digest").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("parent_conv_id").alias("parent_conv_id"))
    ends = end_hashes(entries.filter("kind = 'end'").select("digest", "conv_id"))
    return nodes.join(sums, "digest").join(ends, "digest", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        F.lower(F.hex("digest")).alias("digest"), F.lower(F.hex("parent")).alias("parent_digest"))


def query(spark, sf_dir: str) -> DataFrame:
    """op13: the trie of all rebuilt conversations."""
    return trie(read_table(spark, sf_dir, "conversations"))
