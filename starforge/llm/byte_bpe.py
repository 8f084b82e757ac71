"""Byte-level BPE encoding and decoding on length-bucketed numpy matrices.

A text is split by the tokenizer's pattern; the distinct pieces of a batch are
laid out as rows of padded matrices, one matrix per length bucket. In every
round each row merges its leftmost pair of minimum rank (ranks come from a
hashed pair table), the matrix is compacted by one column, and rows without a
mergeable pair leave. Pieces longer than ``MATRIX_MAX`` bytes, for which a round
per merge would be quadratic, keep the same rule on a linked list with a heap.

Nulls: a null text is the empty text (no tokens); a null id stays null. Empty
tables give empty results; repeated rows give one result each; other columns of
the input are not read. Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starforge.llm.common import per_text, raw, read_table, released, split_batches

MATRIX_MAX = 256            # bytes of a piece handled by the matrices
CACHE_PIECES = 300_000      # encoded pieces a task remembers
BUCKETS = np.array([2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 64, 128, MATRIX_MAX])
NONE = np.int32(np.iinfo(np.int32).max)
IDS = "n_tokens long, token_ids array<int>, round_trip boolean"
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}


def load_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a ``.tiktoken`` file."""
    with open(path, "rb") as fh:
        pairs = [line.split() for line in fh if line.strip()]
    vocab: list[bytes] = [b""] * (1 + max(int(r) for _, r in pairs))
    for token, rank in pairs:
        vocab[int(rank)] = base64.b64decode(token)
    return vocab


class PairTable:
    """(left id, right id) -> rank of the joined token; open addressing, vectorised lookups."""

    MULT = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, vocab: list[bytes]):
        ids = {t: i for i, t in enumerate(vocab) if t}
        keys, values = [], []
        for token, rank in ids.items():
            for cut in range(1, len(token)):
                a, b = ids.get(token[:cut]), ids.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        self.bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        k, v = np.array(keys, np.int64), np.array(values, np.int32)
        slot = self._slot(k)
        self.probes = 0
        while len(k):
            free = self.keys[slot] == -1
            _, first = np.unique(np.where(free, slot, -1), return_index=True)
            first = first[free[first]]
            self.keys[slot[first]], self.values[slot[first]] = k[first], v[first]
            left = np.ones(len(k), bool)
            left[first] = False
            k, v, slot = k[left], v[left], (slot[left] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, k: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((k.astype(np.uint64) * self.MULT) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NONE where they don't merge (a negative id never does)."""
        key = left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where((found == key) & (left >= 0), self.values[slot], NONE)
        todo = np.flatnonzero((found != key) & (found != -1))
        while len(todo):
            slot_t = (slot[todo] + 1) & ((1 << self.bits) - 1)
            slot[todo] = slot_t
            found = self.keys[slot_t]
            hit = found == key[todo]
            out[todo[hit]] = self.values[slot_t[hit]]
            todo = todo[~hit & (found != -1)]
        return out


class BytePairCodec:
    """Encodes pieces and decodes ids for one vocabulary."""

    def __init__(self, vocab: list[bytes]):
        self.vocab = vocab
        self.whole = {t: i for i, t in enumerate(vocab) if t}
        self.byte_id = np.array([self.whole.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.byte_id < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        self.pairs = PairTable(vocab)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        lengths = np.zeros(len(pieces), np.int64)
        for i, piece in enumerate(pieces):
            known = self.whole.get(piece)
            if known is not None:
                out[i] = known.to_bytes(4, "little")
            else:
                lengths[i] = len(piece)
        for low, width in zip([0, *BUCKETS[:-1]], BUCKETS):
            rows = np.flatnonzero((lengths > low) & (lengths <= width))
            for at in range(0, len(rows), max(64, (1 << 20) // int(width))):
                self._matrix(rows[at:at + max(64, (1 << 20) // int(width))], pieces, lengths, int(width), out)
        for i in np.flatnonzero(lengths > MATRIX_MAX):
            out[i] = np.array(self._linked(pieces[i]), "<u4").tobytes()
        return out

    def _matrix(self, rows: np.ndarray, pieces: list[bytes], lengths: np.ndarray, width: int, out: list[bytes]) -> None:
        data = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(len(rows), width)
        ids = np.where(np.arange(width) < lengths[rows][:, None], self.byte_id[data], np.int32(-1))
        rank = self.pairs.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        size = lengths[rows].copy()
        while True:
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), np.int64)
            best = rank[np.arange(len(rows)), at] if rank.shape[1] else np.full(len(rows), NONE)
            done = best == NONE
            if done.any():
                for row, line, n in zip(rows[done].tolist(), ids[done].astype("<u4"), size[done].tolist()):
                    out[row] = line[:n].tobytes()
                live = ~done
                rows, ids, rank, size, at, best = rows[live], ids[live], rank[live], size[live], at[live], best[live]
            if not len(rows):
                return
            # merge: the pair's left cell takes the joined id, its right cell goes
            n, w = ids.shape
            line = np.arange(n)
            ids[line, at] = best
            keep = np.ones((n, w), bool)
            keep[line, at + 1] = False
            ids = ids[keep].reshape(n, w - 1)
            keep = np.ones((n, w - 1), bool)
            keep[line, at] = False
            rank = rank[keep].reshape(n, w - 2)
            size -= 1
            for left in (at - 1, at):
                ok = np.flatnonzero((left >= 0) & (left < w - 2))
                rank[ok, left[ok]] = self.pairs.rank(ids[ok, left[ok]], ids[ok, left[ok] + 1])

    def _linked(self, piece: bytes) -> list[int]:
        """The same merges for one long piece: O(n log n) with a heap of (rank, place)."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        ahead, back = list(range(1, n + 1)), list(range(-1, n - 1))
        start = self.pairs.rank(np.array(ids[:-1]), np.array(ids[1:]))
        current = dict(zip(range(n - 1), start.tolist()))
        heap = [(r, i) for i, r in current.items() if r != NONE]
        heapq.heapify(heap)
        vocab, whole = self.vocab, self.whole
        while heap:
            r, i = heapq.heappop(heap)
            if current.get(i) != r:
                continue
            j = ahead[i]
            ids[i] = r
            current.pop(j, None)
            ids[j] = -1
            ahead[i] = ahead[j]
            if ahead[j] < n:
                back[ahead[j]] = i
            for k in (back[i], i):
                if k >= 0:
                    nxt = ahead[k]
                    new = whole.get(vocab[ids[k]] + vocab[ids[nxt]]) if nxt < n else None
                    if new is None:
                        current.pop(k, None)
                    else:
                        current[k] = new
                        heapq.heappush(heap, (new, k))
        return [x for x in ids if x >= 0]


class TextEncoder:
    """Whole texts to ids; the ids of up to CACHE_PIECES distinct pieces are remembered."""

    def __init__(self, codec: BytePairCodec, pattern: str):
        import regex
        self.codec, self.find = codec, regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [self.find(t) if t else [] for t in texts]
        used = set().union(*split)
        new = list(used.difference(self.known))
        if len(self.known) + len(new) > CACHE_PIECES:
            self.known.clear()
            new = list(used)
        self.known.update(zip(new, self.codec.encode_pieces([p.encode() for p in new])))
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]


def encode_partition(vocab: list[bytes], pattern: str, digest: bool):
    """A function for ``mapInArrow``: doc_id, and the token ids with whether they decode to
    the text again, or digests of ids and decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(BytePairCodec(vocab), pattern)
        token = vocab.__getitem__
        names, kinds = zip(*((f.split()[0], ARROW[f.split()[1]]) for f in (DIGESTS if digest else IDS).split(", ")))
        for batch in split_batches(batches):
            rows = []
            for text, data in zip(raw(batch), encoder.encode(batch.column("text").to_pylist())):
                ids = np.frombuffer(data, "<u4")
                decoded = b"".join(map(token, ids.tolist()))
                rows.append((len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(decoded).hexdigest()) if digest
                            else (len(ids), ids.astype(np.int32), decoded == (text or b"")))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    return run


def encode(docs: DataFrame, vocab: list[bytes], pattern: str, digest: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``token_ids`` and ``round_trip`` (they decode to the text) of
    every whole text, or, with ``digest``, digests of the ids and of the decoded bytes."""
    out = DIGESTS if digest else IDS
    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_text(docs, ["doc_id"]).mapInArrow(encode_partition(vocab, pattern, digest), f"doc_id {kind}, {out}")


def decode(encoded: DataFrame, vocab: list[bytes]) -> DataFrame:
    """``doc_id`` and ``bytes`` of every row of :func:`encode` (null ids: no bytes)."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = [b"".join(map(vocab.__getitem__, ids or ())) for ids in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "token_ids").mapInArrow(run, f"doc_id {kind}, bytes binary")


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[list[bytes], str]:
    import public_tokenizers
    return load_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN


def query(spark, sf_dir: str) -> DataFrame:
    """op9: digests of the ids and of the round trip of every document."""
    return encode(read_table(spark, sf_dir, "documents"), *public_vocabulary(), digest=True)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's last stage: doc_id, n_tokens, token_ids and round_trip of every document."""
    vocab, pattern = public_vocabulary()
    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_text(docs, ["doc_id"]).mapInArrow(released(encode_partition(vocab, pattern, False)), f"doc_id {kind}, {IDS}")
