"""Suffix-array deduplication by merging Burrows-Wheeler transforms of shards.

A window is ``WINDOW`` consecutive bytes of one text; a byte goes if a window that covers it
also starts in a text with a smaller id, or earlier in the same text. Windows are judged on
the input.

Equal windows have equal minimisers (the smallest hash among their runs of ``MINIMISER``
bytes), and consecutive windows with one minimiser are one string of text. That deals the
suffixes out so that no task needs those of another:

1. every block of texts sends its distinct minimisers, packed, to buckets of the hash range
   and learns which of them occur twice or more anywhere (one bit each comes back);
2. the strings of these minimisers travel to their bucket, each distinct one once a block;
   equal strings are settled there at once, all but the first are repeats;
3. the strings that are left are dealt out over shards. Each shard sorts its suffixes once and
   keeps the transform: the letter before each suffix, in suffix order. The transforms are
   merged by refining the interleave of the shards: an order by the first h letters and the
   letters before give, by one stable counting sort of a byte-sized array, the order by h + 1
   letters. Places where neighbours differ are carried along, so after WINDOW bytes an interval
   without such a place is the set of equal windows, and its smallest place keeps its bytes.
   Letters are ``STEP`` bytes, so a merge takes WINDOW / STEP rounds; no suffix is sorted again.

A minimiser whose distinct strings exceed ``HOT_BYTES`` (a line that very many texts have in
different surroundings) would make one bucket grow with the corpus. Its windows are spread by a
128-bit digest instead, each distinct one once a block. Texts stay in a table bucketed by block and are never shuffled.

Nulls: a null text is empty; rows with a null id lose nothing and take nothing from others.
Rows with one id never take bytes from each other. Texts shorter than a window stay whole; very
long ones are hashed in overlapping pieces. Repeated rows give a row each; empty tables give
empty results. Spans are cut at bytes, so what is left need not be valid UTF-8. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import BlockTable, lean, lean_pair, materialize, mix64, ordered, raw, read_table
from starforge.llm.substring_dedup import sliding_min
from starforge.llm.suffix_tree import bucket_edges, pack, steps, unpack
from starforge.session import shuffle_partitions

WINDOW = 100
MINIMISER = 24
STEP = 4                    # bytes a letter; divides WINDOW
BLOCK_BYTES = 8 << 20
PIECE = 1 << 16             # bytes hashed at a time
LONGEST_RUN = 4_096         # windows of one string
KEYS_PER_BUCKET = 500_000
BUCKET_BYTES = 1 << 20      # of strings
HOT_BYTES = 2 << 20
UNIT_BYTES = 60_000         # merged together, unless one minimiser has more
MAX_SHARDS = 64


# -- windows, minimisers, strings ----------------------------------------------
def rolling(data: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hash of every run of ``length`` bytes, put together from runs of powers of two."""
    values = mix64(np.arange(256, dtype=np.uint64) + np.uint64((seed + 1) << 32))
    factor = mix64(np.arange(1, 129, dtype=np.uint64) + np.uint64((seed + 1) << 40)) | np.uint64(1)
    power, size, out, have, left, k = values[data], 1, None, 0, length, 0
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                if out is None:
                    out, have = power, size
                else:
                    n = max(0, len(data) - have - size + 1)
                    out, have = power[:n] * factor[k] + out[size:size + n], have + size
            left, k = left >> 1, k + 2
            if left:
                n = max(0, len(data) - 2 * size + 1)
                power, size = power[:n] * factor[k + 1] + power[size:size + n], 2 * size
        return out[:max(0, len(data) - length + 1)]


class Runs:
    """Strings of consecutive windows with one minimiser, in some joined texts: text number, first
    byte in the text, windows and minimiser of each; ``at`` is the first byte in ``data``, ``again``
    whether the minimiser occurs twice in the string, so that it may have equal windows of its own."""

    def __init__(self, rows: list[int], offsets: list[int], parts: list[bytes], window: int, minimiser: int):
        self.data = b"".join(parts)
        size = np.array([len(p) for p in parts], np.int64)
        end = np.cumsum(size)
        hashes = rolling(np.frombuffer(self.data, np.uint8), minimiser, 0)
        least = sliding_min(hashes, window - minimiser + 1)
        part = np.repeat(np.arange(len(parts)), size)[:len(least)]
        place = np.arange(len(least))
        valid = place + window <= end[part]
        same = np.zeros(len(least), bool)       # as the window before
        same[1:] = valid[1:] & valid[:-1] & (least[1:] == least[:-1])
        first = np.flatnonzero(valid & ~same)
        if len(first):
            label = np.cumsum(valid & ~same) - 1
            cut = valid & ((place - first[np.maximum(label, 0)]) % LONGEST_RUN == 0)
            first, label = np.flatnonzero(cut), np.cumsum(cut) - 1
        else:
            label = np.zeros(0, np.int64)
            valid = valid[:0]
        self.windows = np.bincount(label[valid], minlength=len(first))
        self.again = np.zeros(len(first), bool)
        # a window that begins with its minimum, and the next one has the same minimum
        self.again[label[np.flatnonzero(same[1:] & (hashes[:max(0, len(least) - 1)] == least[:-1]))]] = True
        self.at = first
        self.row = np.array(rows, np.int64)[part[first]]
        self.start = first - (end - size)[part[first]] + np.array(offsets, np.int64)[part[first]]
        self.minimiser = mix64(least[first])    # minima are small numbers; this spreads them


def runs_of(texts: list[bytes], window: int, minimiser: int) -> Iterator[Runs]:
    """The runs of all texts, about PIECE bytes at a time; longer texts in overlapping parts."""
    rows, offsets, parts, held = [], [], [], 0
    for row, text in enumerate(texts):
        for a in range(0, max(1, len(text) - window + 1), PIECE):
            part = text[a:a + PIECE + window - 1] if len(text) > PIECE else text
            if len(part) < window:
                continue
            if held and held + len(part) > 2 * PIECE:
                yield Runs(rows, offsets, parts, window, minimiser)
                rows, offsets, parts, held = [], [], [], 0
            rows.append(row)
            offsets.append(a)
            parts.append(part)
            held += len(part)
    if parts:
        yield Runs(rows, offsets, parts, window, minimiser)


class BlockRuns:
    """A block's texts by pos, and the runs of those with an id."""

    def __init__(self, table: pa.Table, window: int, minimiser: int):
        self.window = window
        batch = ordered(table)
        ids = batch.column("doc_id")
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        pieces = list(runs_of([t if known else b"" for t, known in zip(raw(batch), ids.is_valid().to_pylist())], window, minimiser))
        self.data = b"".join(p.data for p in pieces)
        begin = np.cumsum([0, *(len(p.data) for p in pieces)])
        joined = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
        self.at = joined((p.at + b for p, b in zip(pieces, begin)), np.int64)
        self.size = joined((p.windows for p in pieces), np.int64) + window - 1
        self.row, self.start = (joined((getattr(p, c) for p in pieces), np.int64) for c in ("row", "start"))
        self.minimiser, self.again = joined((p.minimiser for p in pieces), np.uint64), joined((p.again for p in pieces), bool)
        self.keys, self.number = np.unique(self.minimiser, return_inverse=True)

    def strings(self, which=slice(None)) -> list[bytes]:
        return [self.data[a:a + n] for a, n in zip(self.at[which].tolist(), self.size[which].tolist())]


def block_keys(buckets: int, window: int, minimiser: int):
    """For ``applyInArrow`` on a block: per bucket the distinct minimisers, and of each the bytes of its
    distinct strings, doubled, plus 1 where it occurs twice."""

    def run(table: pa.Table) -> pa.Table:
        block = BlockRuns(table, window, minimiser)
        digest = np.array([xxhash.xxh3_64_intdigest(x) for x in block.strings()], np.uint64)
        order = np.lexsort((digest, block.number))
        k, d = block.number[order], digest[order]
        fresh = np.concatenate(([True], (k[1:] != k[:-1]) | (d[1:] != d[:-1]))) if len(k) else np.zeros(0, bool)
        size = np.bincount(k, block.size[order] * fresh, len(block.keys))
        twice = np.bincount(k, 1 + block.again[order], len(block.keys)) > 1
        info = (2 * np.minimum(size, 1 << 30) + twice).astype(np.uint32)
        edge = bucket_edges(block.keys, buckets).tolist()
        rows = [(b, pack(steps(block.keys[x:y])), pack(info[x:y])) for b, (x, y) in enumerate(zip(edge[:-1], edge[1:])) if y > x]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([table.column("block")[0].as_py()] * len(rows), pa.int64()),
                         "keys": pa.array([r[1] for r in rows], pa.binary()), "info": pa.array([r[2] for r in rows], pa.binary())})

    return run


def find_repeated(hot_bytes: int):
    """For ``applyInArrow`` on a bucket of minimisers: per block 0, 1 (repeated) or 2 (repeated and
    hot) for each of its keys; on block -1 the bytes of the strings that are repeated and not hot,
    and of the hot ones."""

    def run(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for k in table.column("keys").to_pylist()]
        info = [unpack(v, np.uint32) for v in table.column("info").to_pylist()]
        flat, value = np.concatenate(keys), np.concatenate(info)
        distinct, number, count = np.unique(flat, return_inverse=True, return_counts=True)
        size = np.bincount(number, value >> 1)
        repeated = (count > 1) | (np.bincount(number, value & 1) > 0)
        state = np.where(repeated, np.where(size > hot_bytes, 2, 1), 0).astype(np.uint8)
        cut = np.cumsum([len(k) for k in keys])[:-1]
        parts = [pack(s) for s in np.split(state[number], cut)]
        n, bucket = len(parts) + 1, table.column("bucket")[0].as_py()
        return pa.table({"block": pa.array([*table.column("block").to_pylist(), -1], pa.int64()), "bucket": pa.array([bucket] * n, pa.int32()),
                         "state": pa.array([*parts, b""], pa.binary()), "size": pa.array([0] * (n - 1) + [int(size[state == 1].sum())], pa.int64()),
                         "hot": pa.array([0] * (n - 1) + [int(size[state == 2].sum())], pa.int64())})

    return run


STATES = "block long, bucket int, state binary, size long, hot long"


def states_of(block: BlockRuns, answers: pa.Table) -> np.ndarray:
    """State of each of the block's keys."""
    got = sorted(zip(answers.column("bucket").to_pylist(), answers.column("state").to_pylist()))
    return np.concatenate([np.zeros(0, np.uint8), *(unpack(s, np.uint8) for _, s in got)])


class Firsts:
    """Settles equal strings met in order of (id, row, start): whether one is a repeat."""

    def __init__(self):
        self.seen: dict[bytes, tuple] = {}
        self.rows: set[tuple] = set()       # further rows of an id that have a string

    def repeats(self, string: bytes, doc: int, row) -> bool:
        got = self.seen.get(string)
        if got is None:
            self.seen[string] = (doc, row)
            return False
        if doc > got[0] or row == got[1] or (string, row) in self.rows:
            return True
        self.rows.add((string, row))        # another row of the same id
        return False


PACKED = "kind string, bucket int, block long, m binary, more binary, ids binary, pos binary, starts binary, sizes binary, letters binary"
SPANS = "block long, pos binary, starts binary, ends binary"
LOCAL, STRINGS, HOT = "local", "strings", "hot"


def squeezed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(1).compress(data)


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, numbers of its entries)."""
    order = np.argsort(bucket, kind="stable")
    edge = np.flatnonzero(np.concatenate(([True], bucket[order][1:] != bucket[order][:-1], [True]))) if len(order) else [0]
    for a, b in zip(edge[:-1], edge[1:]):
        yield int(bucket[order[a]]), order[a:b]


def packed_strings(buckets: int, hot_buckets: int, window: int, minimiser: int):
    """For a cogrouped ``applyInArrow``: PACKED rows of the block's distinct strings of repeated
    minimisers, one per bucket; of the distinct windows of hot ones, likewise; and of the repeats
    found within the block."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if texts.num_rows:
            block = BlockRuns(texts, window, minimiser)
            name, state = texts.column("block")[0].as_py(), states_of(block, answers)[block.number]
            ids = block.ids[block.row]
            k = np.flatnonzero(state > 0)       # of hot ones too: equal strings need no windows
            k = k[np.lexsort((block.start[k], block.row[k], ids[k]))]
            firsts, strings = Firsts(), block.strings(k)
            repeat = np.array([firsts.repeats(*x) for x in zip(strings, ids[k].tolist(), block.row[k].tolist())], bool)
            again = np.flatnonzero(repeat)
            local = [(block.row[k][again], block.start[k][again], (block.start + block.size)[k][again])]
            first = np.flatnonzero(~repeat & (state[k] == 1))
            for bucket, x in by_bucket((mix64(block.minimiser[k[first]]) % np.uint64(buckets)).astype(np.int64)):
                x = first[x]
                y = k[x]
                rows.append((STRINGS, bucket, name, pack(block.minimiser[y]), pack(block.again[y].view(np.uint8)), pack(ids[y]), pack(block.row[y]),
                             pack(block.start[y]), pack(block.size[y]), squeezed(b"".join([strings[z] for z in x.tolist()]))))
            one, two, row, start = hot_windows(block, k[~repeat & (state[k] == 2)])
            if len(one):
                number = numbered_pairs(one, two)
                ids = block.ids[row]
                hit = repeated_windows(ids, row, start, number)
                local.append(as_spans(row[hit], start[hit], window))
                left = np.flatnonzero(~hit)
                for bucket, x in by_bucket((mix64(one[left]) % np.uint64(hot_buckets)).astype(np.int64)):
                    x = left[x]
                    rows.append((HOT, bucket, name, pack(one[x]), pack(two[x]), pack(ids[x]), pack(row[x]), pack(start[x]), None, None))
            gone = [np.concatenate(x) for x in zip(*local)]
            if len(gone[0]):
                rows.append((LOCAL, None, name, None, None, None, pack(gone[0]), pack(gone[1]), pack(gone[2] - gone[1]), None))
        names = [f.split()[0] for f in PACKED.split(", ")]
        types = [pa.string(), pa.int32(), pa.int64()] + [pa.binary()] * 7
        return pa.table({c: pa.array([r[x] for r in rows], t) for x, (c, t) in enumerate(zip(names, types))})

    return run


# -- shards and their merge ------------------------------------------------------
def suffix_order(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places of ``data`` in suffix order. ``data`` holds strings that end in a zero (and have none
    inside); ends count as different and follow the order of the strings, which begin at ``first``."""
    n = len(data)
    wide = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    ended = np.zeros(n, bool)
    for k in range(8):
        letter = np.where(ended, np.uint64(0), wide[k:k + n])
        key = (key << np.uint64(8)) | letter
        ended |= letter == 0
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.concatenate(([True], (key[order][1:] != key[order][:-1]) | ended[order][1:]))
    h = 8
    while True:
        start = np.flatnonzero(new)
        rank[order] = start[np.cumsum(new) - 1]                     # a group's rank is its first place
        size = np.diff(np.concatenate((start, [n])))
        if len(start) == n:
            return order
        active = np.flatnonzero(np.repeat(size > 1, size))          # places in the order still undecided
        place = order[active]
        second = rank[place + h]
        sub = np.lexsort((second, rank[place]))
        order[active] = place[sub]
        group, second = rank[place][sub], second[sub]
        new[active] = np.concatenate(([True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])))
        h *= 2


def merged(strings: list[bytes], shard: np.ndarray, window: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, group) of all windows of the strings; equal windows have one group.
    ``shard``: the shard (from 0) of each string."""
    by_shard = np.argsort(shard, kind="stable")
    size = np.array([len(strings[k]) for k in by_shard.tolist()], np.int64)
    plain = b"".join(strings[k] + b"\0" * step for k in by_shard.tolist())      # padding, so that letters can be read at the end
    begin = np.concatenate(([0], np.cumsum(size + step)))[:-1]
    text = np.frombuffer(plain, np.uint8)
    # letters of the transform: numbers of the runs of `step` bytes
    code = np.zeros(len(text) - step + 1, np.uint64)
    for k in range(step):
        code = (code << np.uint64(8)) | text[k:len(text) - step + 1 + k]
    kinds, letter = np.unique(code, return_inverse=True)
    letter = letter.astype(np.uint16 if len(kinds) <= 1 << 16 else np.uint32)
    del code
    number = np.int32 if len(text) < 1 << 31 else np.int64
    # suffix order of each shard, in turn
    which = shard[by_shard]
    suffix = []
    for s in range(int(which.max()) + 1):
        own = np.flatnonzero(which == s)
        joined = np.concatenate([np.concatenate((text[begin[k]:begin[k] + size[k]] + 1, np.zeros(1, np.uint8))) for k in own.tolist()])
        at = np.concatenate([np.arange(begin[k], begin[k] + size[k] + 1) for k in own.tolist()])
        suffix.append(at[suffix_order(joined, begin[own])].astype(number))
    suffix = np.concatenate(suffix)
    owner = (np.searchsorted(begin, suffix, side="right") - 1).astype(number)
    offset = suffix - begin.astype(number)[owner]
    left = size.astype(number)[owner] - offset                      # bytes from here to the string's end
    rounds = window // step
    # the suffixes from `window` bytes on, shard by shard: an order by no letter at all
    interleave = which[owner[(offset >= window) & (left >= 0)]].astype(np.uint8)
    group = np.zeros(len(interleave), np.int64)
    for done in range(rounds + 1):
        here = np.flatnonzero((offset >= step * (rounds - done)) & (left >= step * done))
        place = np.empty(len(here), number)
        place[np.argsort(interleave, kind="stable")] = suffix[here]  # a shard's k-th entry is its k-th suffix
        if done == rounds:
            at = np.searchsorted(begin, place, side="right") - 1
            return by_shard[at], place - begin[at], group
        before = letter[place - step]
        order = np.argsort(before, kind="stable")
        interleave, before, group = interleave[order], before[order], group[order]
        if len(group):
            group = np.cumsum(np.concatenate(([0], (before[1:] != before[:-1]) | (group[1:] != group[:-1]))))


def units(m: np.ndarray, again: np.ndarray, size: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Numbers of the strings merged together: those of a minimiser stay together; a minimiser with one
    string, in which it doesn't follow itself, is left out."""
    order = np.argsort(m, kind="stable")
    start = np.flatnonzero(np.concatenate(([True], m[order][1:] != m[order][:-1], [True]))) if len(order) else [0]
    held, have = [], 0
    for a, b in zip(start[:-1], start[1:]):
        if b - a < 2 and not again[order[a]]:
            continue
        n = int(size[order[a:b]].sum())
        if held and have + n > limit:
            yield np.concatenate(held)
            held, have = [], 0
        held.append(order[a:b])
        have += n
    if held:
        yield np.concatenate(held)


def repeated_windows(ids: np.ndarray, row: np.ndarray, start: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which windows also start earlier: under a smaller id, or before in the same row."""
    low = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(low, group, ids)
    order = np.lexsort((start, row, group))
    g, r, s = group[order], row[order], start[order]
    again = np.concatenate(([False], (g[1:] == g[:-1]) & (r[1:] == r[:-1]) & (s[1:] >= s[:-1])))
    out = np.zeros(len(ids), bool)
    out[order] = again
    return out | (low[group] < ids)


def as_spans(row: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the bytes that windows cover, adjoining ones joined."""
    if not len(row):
        return row, start, start
    order = np.lexsort((start, row))
    r, s = row[order], start[order]
    new = np.concatenate(([True], (r[1:] != r[:-1]) | (s[1:] > s[:-1] + 1)))
    last = np.concatenate((np.flatnonzero(new)[1:], [len(r)])) - 1
    return r[new], s[new], s[last] + length


def merge_bucket(window: int, unit_bytes: int):
    """For ``applyInArrow`` on the PACKED rows of a bucket: SPANS that also occur earlier."""

    def run(table: pa.Table) -> pa.Table:
        blocks, columns = table.column("block").to_pylist(), {}
        for name, kind in (("m", np.uint64), ("more", np.uint8), ("ids", np.int64), ("pos", np.int64), ("starts", np.int64), ("sizes", np.int64)):
            parts = [unpack(x, kind) for x in table.column(name).to_pylist()]
            columns[name] = np.concatenate(parts)
        block = np.repeat(np.arange(len(blocks)), [len(x) for x in parts])      # by number of its row: blocks fit no 32 bits with pos
        row = (block << 32) | columns["pos"]
        strings, rest = [], columns["sizes"].tolist()
        at = 0
        for data, part in zip(table.column("letters").to_pylist(), parts):
            letters, a = zstandard.ZstdDecompressor().decompress(data), 0
            for n in rest[at:at + len(part)]:
                strings.append(letters[a:a + n])
                a += n
            at += len(part)
        order, firsts = np.lexsort((columns["starts"], row, columns["ids"])), Firsts()
        whole = np.zeros(len(row), bool)
        for k in order.tolist():
            whole[k] = firsts.repeats(strings[k], int(columns["ids"][k]), int(row[k]))
        got_row, got_start, got_end = [row[whole]], [columns["starts"][whole]], [(columns["starts"] + columns["sizes"])[whole]]
        left = np.flatnonzero(~whole)
        for unit in units(*(columns[c][left] for c in ("m", "more", "sizes")), unit_bytes):
            k = left[unit]
            same = np.concatenate(([True], columns["m"][k][1:] != columns["m"][k][:-1]))
            turn = np.arange(len(k)) - np.flatnonzero(same)[np.cumsum(same) - 1]     # strings of a minimiser go to different shards
            string, offset, group = merged([strings[x] for x in k.tolist()], turn % MAX_SHARDS, window)
            x = k[string]
            hit = repeated_windows(columns["ids"][x], row[x], columns["starts"][x] + offset, group)
            for out, values in zip((got_row, got_start, got_end), as_spans(row[x][hit], (columns["starts"][x] + offset)[hit], window)):
                out.append(values)
        return span_table(blocks, *(np.concatenate(x) for x in (got_row, got_start, got_end)))

    return run


def span_table(blocks: list[int], row: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    """SPANS, one row per block; ``row`` is (number of the block, pos)."""
    rows = [(blocks[b], pack(row[k] & 0xFFFFFFFF), pack(start[k]), pack(end[k])) for b, k in by_bucket(row >> 32)]
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()),
                     **{c: pa.array([r[k] for r in rows], pa.binary()) for k, c in enumerate(("pos", "starts", "ends"), 1)}})


# -- hot minimisers ----------------------------------------------------------------
def hot_windows(block: BlockRuns, which: np.ndarray):
    """(digest, second digest, row, start) of every window of some of the block's strings."""
    found = [(np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2]
    piece = np.cumsum(block.size[which]) // (8 * PIECE)         # hashed together
    found += [windows_of(block, which[piece == p]) for p in np.unique(piece).tolist()]
    return tuple(np.concatenate(x) for x in zip(*found))


def windows_of(block: BlockRuns, which: np.ndarray):
    """The same for strings of few bytes in all."""
    size, window = block.size[which], block.window
    data = np.frombuffer(b"".join(block.strings(which)), np.uint8)
    n = size - window + 1
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(np.cumsum(size) - size, n) + inside
    return rolling(data, window, 1)[at], rolling(data, window, 2)[at], np.repeat(block.row[which], n), np.repeat(block.start[which], n) + inside


def numbered_pairs(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The number of each entry's pair among the distinct ones."""
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    number = np.empty(len(a), np.int64)
    number[order] = np.cumsum(np.concatenate(([0], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    return number


def merge_hot(window: int):
    """For ``applyInArrow`` on the PACKED rows of a bucket of hot windows: SPANS that also occur earlier."""

    def run(table: pa.Table) -> pa.Table:
        unpacked = {c: [unpack(x, kind) for x in table.column(c).to_pylist()]
                    for c, kind in (("m", np.uint64), ("more", np.uint64), ("ids", np.int64), ("pos", np.int64), ("starts", np.int64))}
        block = np.repeat(np.arange(table.num_rows), [len(x) for x in unpacked["m"]])
        one, two, ids, pos, start = (np.concatenate(x) for x in unpacked.values())
        row = (block << 32) | pos
        hit = repeated_windows(ids, row, start, numbered_pairs(one, two))
        return span_table(table.column("block").to_pylist(), *as_spans(row[hit], start[hit], window))

    return run


# -- all together --------------------------------------------------------------------
def repeated_spans(blocks: BlockTable, n_blocks: int, window: int = WINDOW, minimiser: int = MINIMISER, hot_bytes: int = HOT_BYTES,
                   unit_bytes: int = UNIT_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """SPANS of the bytes that also occur earlier; they may overlap."""
    least = shuffle_partitions(blocks.spark)
    keys = max(least, math.ceil(n_blocks * block_bytes / 45 / KEYS_PER_BUCKET))
    rows = blocks.rows.select("block", "pos", "doc_id", "text")
    states = materialize(rows.groupBy("block").applyInArrow(lean(block_keys(keys, window, minimiser)), "bucket int, block long, keys binary, info binary")
                         .groupBy("bucket").applyInArrow(find_repeated(hot_bytes), STATES), "states")
    total = states.filter("block = -1").agg(F.sum("size").alias("size"), F.sum("hot").alias("hot")).first()
    answers = states.filter("block >= 0").select("block", "bucket", "state")
    buckets, hot_buckets = (max(least, math.ceil((total[c] or 0) / BUCKET_BYTES)) for c in ("size", "hot"))
    strings = materialize(rows.groupBy("block").cogroup(answers.groupBy("block"))
                          .applyInArrow(lean_pair(packed_strings(buckets, hot_buckets, window, minimiser)), PACKED), "strings")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = [pack(unpack(s, np.int64) + unpack(n, np.int64)) for s, n in zip(b.column("starts").to_pylist(), b.column("sizes").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("pos"), b.column("starts"), pa.array(ends, pa.binary())], ["block", "pos", "starts", "ends"])

    spans = strings.filter(F.col("kind") == STRINGS).groupBy("bucket").applyInArrow(lean(merge_bucket(window, unit_bytes)), SPANS) \
        .unionByName(strings.filter(F.col("kind") == LOCAL).select("block", "pos", "starts", "sizes").mapInArrow(local, SPANS))
    if total["hot"]:
        spans = spans.unionByName(strings.filter(F.col("kind") == HOT).groupBy("bucket").applyInArrow(lean(merge_hot(window)), SPANS))
    return materialize(spans, "spans")


def removed(docs: DataFrame, block_bytes: int = BLOCK_BYTES, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    blocks = BlockTable(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), block_bytes)
    n_blocks = blocks.rows.select("block").distinct().count()

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        batch = ordered(texts)
        pos, start, end = (np.concatenate([np.zeros(0, np.int64), *(unpack(x, np.int64) for x in found.column(c).to_pylist())]) for c in ("pos", "starts", "ends"))
        order = np.argsort(pos, kind="stable")
        pos, start, end = pos[order], start[order], end[order]
        edge = np.searchsorted(pos, np.arange(batch.num_rows + 1))
        out = []
        for k, text in enumerate(raw(batch)):
            n, a, b = len(text), edge[k], edge[k + 1]
            if a == b:
                out.append((n, 0, 0, hashlib.sha256(text).hexdigest()))
                continue
            change = np.bincount(start[a:b], minlength=n + 1) - np.bincount(end[a:b], minlength=n + 1)
            gone = np.cumsum(change[:n]) > 0
            begins = gone & ~np.concatenate(([False], gone[:-1]))
            out.append((n, int(gone.sum()), int(begins.sum()), hashlib.sha256(np.frombuffer(text, np.uint8)[~gone].tobytes()).hexdigest()))
        return pa.table({"doc_id": batch.column("doc_id"), **{c: pa.array([x[k] for x in out], pa.int64()) for k, c in enumerate(("n_bytes", "n_removed", "n_spans"))},
                         "kept_sha256": pa.array([x[3] for x in out], pa.string())})

    spans = repeated_spans(blocks, n_blocks, block_bytes=block_bytes, **options)
    out = materialize(blocks.beside(spans).applyInArrow(lean_pair(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), "removed")
    blocks.drop()
    return out


def query(spark, sf_dir: str) -> DataFrame:
    """op11: bytes removed from every document."""
    return removed(read_table(spark, sf_dir, "documents"))
