"""LM scoring with a probabilistic suffix tree over words.

Tokens are a text's words (lower-cased A-Z, separated by ASCII white space), then one
end. The tree's nodes are contexts: the empty one, and the words before a token, as many
as it takes (``score`` can be given a bound). A longer context is of use where it sets
occurrences apart: one that has over 1 - 1 / ``APART`` of its suffix's occurrences is passed
over, and ``PASSED`` of these in a row end the branch, as those inside a passage do that is
always the same. So the depth grows with the logarithm of the largest count, not with the
longest passage. Of the others, a context of at least ``MIN_CONTEXT`` training occurrences is retained
when its own predictions diverge from those of its longest retained suffix: the sum over
its training tokens of the log-ratio of the two, each token left out of its own count,
must reach ``MIN_GAIN`` nats. Next-token distributions are smoothed towards the parent:
(count + MASS * parent) / (context count + MASS); the root is the smoothed unigram
distribution. A token is scored in its longest retained suffix state.

A longer context has a part of the occurrences of its suffix, and MIN_CONTEXT or more, so a
token that follows the suffix w times gains at most log((w - 1 + MASS * p) / ((n - 1 + MASS) * p))
by any longer one, with n the larger of w and MIN_CONTEXT. A context whose training tokens
have less than ``MIN_GAIN`` of such room is not live: nothing longer can be retained, and
nothing longer is counted. Depths end when no context is live or none is frequent; each costs
one round, which asks for the gains of its contexts and for the counts of runs one token longer
(before it is known which of the contexts are live: those are of no use where they are not).

All counts cover all training texts and none is collected or broadcast. Texts are
tokenised once into blocks of about ``BLOCK_BYTES``, kept as packed token numbers in a
table bucketed by block. Per round, a block asks for the totals of its distinct keys
(64-bit hashes of context and token): packed arrays go to the keys' buckets, are summed
there with everybody else's, and the totals return in the order asked, to the round's table,
bucketed alike, where the block left its state: what is known of the tokens whose context is
under test. A round reads the texts, the state and the replies of the round before and nothing
older, so its work follows the tokens still open. A frequent key is thus one entry per block, never one per occurrence. A key frequent enough to be a context also
gets its number within the bucket, under which its gains (in whole SCALEths of a nat, so
that sums don't depend on their order) are gathered.

Nulls: a null text is empty (its end is still a token); a null id counts as the empty
text for the held-out rule and is kept. Empty tables give empty results. Repeated rows
are scored alike and each counts in training. Other columns are not read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import crc_column, lean, lean_pair, materialize, mix64, read_table, released, scratch_path, split_batches
from starforge.llm.substring_dedup import word_hashes
from starforge.session import shuffle_partitions

MIN_CONTEXT = 8
MIN_GAIN = 4.0
MASS = 20.0
APART = 8
PASSED = 3
SCALE = 1024
BASE = 0.1                  # added to every unigram count
BLOCK_BYTES = 15 << 20
PIECE = 1 << 18             # tokens whose logarithms are taken at once
MAX_TABLE_BUCKETS = 50_000
END = np.uint64(0x5EED0F0E2D000001)
NEXT, GAIN = "next", "gain"
RETAINED, LIVE = 1, 2


# -- packed arrays ----------------------------------------------------------
def pack(a: np.ndarray) -> bytes:
    """An array, its bytes sorted into planes and compressed."""
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def steps(keys: np.ndarray) -> np.ndarray:
    """Differences of sorted keys (their leading planes are mostly zero)."""
    return np.diff(keys, prepend=np.uint64(0))


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of sorted keys begins; buckets are ranges of the hash."""
    bounds = (np.arange(buckets + 1, dtype=np.float64) * (2.0 ** 64 / buckets))[:-1].astype(np.uint64)
    return np.concatenate((np.searchsorted(keys, bounds), [len(keys)]))


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and the number of each entry's key among them."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=first[1:])
    number = np.empty(len(keys), np.int32 if len(keys) < 2**31 else np.int64)
    number[order] = np.cumsum(first, dtype=number.dtype) - 1
    return keys[first], number


# -- one block of texts -------------------------------------------------------
def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and the number of tokens of each text (strings)."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    n_parts, parts = pc.list_value_length(words).to_numpy(), words.flatten()
    is_word = pc.binary_length(parts).to_numpy() > 0            # there is an empty part before leading white space
    size = np.bincount(np.repeat(np.arange(len(n_parts)), n_parts)[is_word], minlength=len(n_parts)) + 1
    token = np.full(int(size.sum()), END)
    inner = np.ones(len(token), bool)
    inner[np.cumsum(size) - 1] = False
    token[inner] = word_hashes(parts.filter(pa.array(is_word)).cast(pa.binary()))
    return token, size


class Block:
    """Tokens of a block's texts, and what the rounds so far left open: the contexts under test, the
    candidates for the next depth, and the runs asked for. What is settled is in sums by text."""

    def __init__(self, code: np.ndarray, table: np.ndarray, size: np.ndarray, train: np.ndarray):
        self.code, self.table, self.size, self.learner = code, table, size, train
        self.end = np.cumsum(size)
        self.text = np.repeat(np.arange(len(size), dtype=np.int32), size)
        self.words = np.zeros(0, np.int64)          # totals of the words by key, while the contexts under test are these
        self.asked = np.ones(len(code), bool)       # ends of the runs asked for in the last round
        self.at = np.zeros(0, np.int64)             # tokens whose context is under test, and of each of these:
        self.number = np.zeros(0, np.int32)         # the number of the context among the block's frequent keys
        self.count = np.zeros(0, np.int64)          # training count of context and token
        self.p = np.zeros(0)                        # probability in the longest retained context
        self.inside = np.zeros(0, bool)             # whether a context was retained
        self.passed = np.zeros(0, np.int8)          # contexts passed over in a row so far
        self.longer = np.zeros(0, bool)             # whether the context of one more token is frequent
        self.total = np.zeros(0, np.int64)          # per number: training count of the context
        self.longer_number = np.zeros(0, np.int32)  # of those with a frequent longer context: its number
        self.longer_total = np.zeros(0, np.int64)   # per number of a longer context
        self.numbers: list[tuple[int, bytes]] = []  # (bucket, packed numbers there) of the longer contexts
        self.under_test: list[tuple[int, bytes]] = []           # the same of those under test
        self.base = self.score = np.zeros(len(size))            # by text
        self.n_known = self.n_inside = np.zeros(len(size), np.int64)

    # -- between rounds
    def state(self) -> list[bytes]:
        derived = len(self.words) > 0               # from the words, again
        contexts = () if derived else (self.at, self.number, self.p, self.inside, self.passed)
        at, number, p, inside, passed = contexts or (np.zeros(0, np.int64), self.number[:0], self.p[:0], self.inside[:0], self.passed[:0])
        by_text = [x[:0] if derived else x for x in (self.total, self.base, self.score, self.n_known, self.n_inside)]
        p, values = pd.factorize(p)
        under_test = np.zeros(len(self.code), bool)
        under_test[at] = True
        return [pack(x) for x in (
            self.words, np.packbits(self.asked), np.packbits(under_test), number, p.astype(np.int32), values, np.packbits(inside), passed,
            self.count, np.packbits(self.longer), self.longer_number, self.longer_total, *by_text, np.array([b for b, _ in self.numbers], np.int32))] + [
            n for _, n in self.numbers]

    def restore(self, state: list[bytes], known: dict) -> None:
        kinds = ("i8", "u1", "u1", "i4", "i4", "f8", "u1", "i1", "i8", "u1", "i4", "i8", "i8", "f8", "f8", "i8", "i8", "i4")
        (words, asked, under_test, self.number, p, values, inside, self.passed, self.count, longer, self.longer_number, self.longer_total,
         self.total, self.base, self.score, self.n_known, self.n_inside, buckets) = (unpack(x, k) for x, k in zip(state, kinds))
        bits = lambda x, n: np.unpackbits(x, count=n).view(bool)
        self.asked, self.at = bits(asked, len(self.code)), np.flatnonzero(bits(under_test, len(self.code)))
        self.p, self.inside = values[p], bits(inside, len(p))
        self.numbers = list(zip(buckets.tolist(), state[len(kinds):]))
        if len(words):
            self.learn_words(words, known)
        self.longer = bits(longer, len(self.count))

    # -- runs of tokens
    def far(self, depth: int) -> np.ndarray:
        """Which tokens have more than ``depth`` tokens before them in their text."""
        far = np.ones(len(self.code), bool)
        for place in range(depth + 1):
            far[np.minimum(self.end - self.size + place, self.end - 1)] = False
        return far

    def extend(self, depth: int, at: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Hashes of the runs of ``depth`` tokens before each and the token."""
        with np.errstate(over="ignore"):
            step = lambda words: mix64(words + np.uint64(depth)) * np.uint64(2 * depth + 1)     # noqa: E731
            code = self.code[at - depth]
            return mix64(key + (step(self.table)[code] if len(self.table) < len(code) else step(self.table[code])))

    def runs(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Ends and hashes of the runs asked for in the round of ``depth``."""
        at = np.flatnonzero(self.asked)
        key = self.table[self.code[at]]
        for d in range(1, depth + 1):
            key = self.extend(d, at, key)
        return at, key

    def ask(self, at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys, sorted, and their training counts in this block."""
        keys, inverse = numbered(key)
        return keys, np.bincount(inverse[self.learner[self.text[at]] > 0], minlength=len(keys))

    def ask_words(self) -> tuple[np.ndarray, np.ndarray]:
        """The same for the words."""
        order = np.argsort(self.table)
        return self.table[order], np.bincount(self.code[self.learner[self.text] > 0], minlength=len(order))[order]

    def learn_words(self, totals: np.ndarray, known: dict) -> np.ndarray:
        """Takes in the totals of the words, puts all contexts of one token under test and returns the tokens' counts."""
        order, often = np.argsort(self.table), totals >= MIN_CONTEXT
        word, rank = np.empty(len(order), totals.dtype), np.empty(len(order), np.int32)
        word[order], rank[order] = totals, np.cumsum(often) - 1
        p, everywhere = (word + BASE) / (known["N"] + BASE * (known["V"] + 1)), slice(None)
        self.base = self.score = self.per_text(everywhere, np.log10(p)[self.code])
        self.n_known = self.per_text(everywhere, (word > 0)[self.code]).astype(np.int64)
        self.n_inside = np.zeros(len(self.size), np.int64)
        frequent = (word >= MIN_CONTEXT)[self.code]
        frequent[self.end - 1] = False
        self.at = np.flatnonzero(frequent) + 1
        self.number, self.p, self.total, self.words = rank[self.code[self.at - 1]], p[self.code[self.at]], totals[often], totals
        self.inside, self.passed = np.zeros(len(self.at), bool), np.zeros(len(self.at), np.int8)
        return word[self.code]

    def learn(self, depth: int, totals: np.ndarray, numbers: list[tuple[int, bytes]], known: dict) -> tuple[np.ndarray, np.ndarray]:
        """Takes in the totals of the runs of ``depth``, and returns those to ask for next (ends and hashes).

        These are the runs one token longer whose count can matter: as a prediction, the context is
        frequent enough and under test, and the shorter run occurs in training at all; as the next
        token's context, it may be frequent and its suffix is under test. Both follow from the run's
        tokens alone."""
        self.under_test, self.numbers = self.numbers, numbers
        totals = totals.astype(np.int32) if totals.max(initial=0) < 2**31 else totals
        at, key = self.runs(depth)
        if depth == 0:
            count = found = self.learn_words(totals.astype(np.int64), known).astype(totals.dtype)
        else:
            _, inverse = numbered(key)
            found, count = totals[inverse], np.zeros(len(self.code), totals.dtype)
            count[at] = found
            self.count = count[self.at].astype(np.int64)
        follows = np.ones(len(self.code), bool)
        follows[self.end - 1] = False
        tested = np.zeros(len(self.code) + 1, bool)
        tested[self.at[self.passed < PASSED]] = True
        follows &= tested[1:]
        ends = (found >= MIN_CONTEXT) & follows[at]
        if depth:
            often = totals >= MIN_CONTEXT
            rank = (np.cumsum(often) - 1).astype(np.int32)
            longer = np.zeros(len(self.code) + 1, bool)
            longer[at[ends] + 1] = True
            self.longer, self.longer_number, self.longer_total = longer[self.at], rank[inverse[ends]], totals[often].astype(np.int64)
            del inverse

        far = self.far(depth)[at]
        at, key, here, context = at[far], key[far], found[far], ends[far]
        before = count[at - 1]
        keep = (tested[at] & (before >= MIN_CONTEXT) & (here >= 1)) | (context & ((before >= MIN_CONTEXT) | ~self.asked[at - 1]))
        at, key = at[keep], key[keep]
        self.asked = np.zeros(len(self.code), bool)
        self.asked[at] = True
        return at, self.extend(depth + 1, at, key)

    # -- contexts
    def within(self, part, own=0) -> np.ndarray:
        """Probabilities of tokens in the contexts under test; ``own`` is taken out of its counts."""
        return (np.maximum(self.count[part] - own, 0) + MASS * self.p[part]) / (np.maximum(self.total[self.number[part]] - own, 0) + MASS)

    def ask_gain(self) -> np.ndarray:
        """Per frequent key, as a context: the log-ratio its training tokens here gain by it, and
        the room they leave to longer ones with it retained and with it not."""
        sums = np.zeros((3, len(self.total)))
        for begin in range(0, len(self.at), PIECE):
            part = slice(begin, begin + PIECE)
            number, p, passed = self.number[part], self.p[part], self.passed[part]
            train, follows = self.learner[self.text[self.at[part]]], np.maximum(self.count[part], 1)
            least = np.maximum(follows, MIN_CONTEXT) - 1 + MASS
            tested, still_open = np.where(passed == 0, train, 0), np.where(passed < PASSED, train, 0)
            gain = np.log(self.within(part, tested) / p) * tested
            rooms = [np.maximum(np.log((follows - 1 + MASS * x) / (least * x)), 0) * still_open for x in (self.within(part), p)]
            for total, x in zip(sums, (gain, *rooms)):
                total += np.bincount(number, x, len(total))
        gain, *rooms = sums * SCALE
        return np.stack((np.rint(gain), *map(np.ceil, rooms))).astype(np.int64)

    def learn_gain(self, verdict: np.ndarray) -> None:
        """``verdict``: per frequent key RETAINED, LIVE, both or none. The contexts of one more token
        are under test from now on, where frequent and live."""
        sent = verdict[self.number]
        node = np.flatnonzero(sent & RETAINED)
        better = self.within(node)
        self.score = self.score + self.per_text(self.at[node], np.log10(better) - np.log10(self.p[node]))
        self.n_inside = self.n_inside + self.per_text(self.at[node[~self.inside[node]]], 1).astype(np.int64)
        self.p[node], self.inside[node] = better, True
        self.next_contexts(sent & LIVE > 0)

    def next_contexts(self, live: np.ndarray) -> None:
        keep = self.longer & live
        number = self.longer_number[keep[self.longer]]
        like_suffix = APART * self.longer_total[number] > (APART - 1) * self.total[self.number[keep]]
        self.passed = np.where(like_suffix, self.passed[keep] + 1, 0).astype(np.int8)
        self.at, self.p, self.inside, self.words = self.at[keep], self.p[keep], self.inside[keep], self.words[:0]
        self.number, self.total = number, self.longer_total

    def per_text(self, at: np.ndarray | slice, values) -> np.ndarray:
        text = self.text[at]
        return np.bincount(text, np.broadcast_to(values, len(text)), len(self.size))


# -- rounds -------------------------------------------------------------------
STATE = "state"
ROUND = "block long, kind string, bucket int, state array<binary>, keys binary, amounts binary, totals binary, numbers binary"


def restored(texts: pa.Table, last: pa.Table, rounds: list[tuple[str, int]], known: dict, final: bool = False) -> tuple[Block, tuple | None]:
    """The block with what the rounds so far brought, and the runs to ask for next."""
    code, table, size, train = (unpack(texts.column(c)[0].as_py(), kind)
                                for c, kind in (("codes", np.int32), ("words", np.uint64), ("sizes", np.int64), ("train", np.int64)))
    block, got = Block(code, table, size, train), {}
    for kind, bucket, totals, numbers, state in zip(*(last.column(c).to_pylist() for c in ("kind", "bucket", "totals", "numbers", "state"))):
        got.setdefault(kind, []).append((bucket, totals, numbers))
        if kind == STATE:
            block.restore(state, known)
    if not rounds:
        return block, None
    depth = rounds[-1][1]
    gains, answers = sorted(got.get(GAIN, [])), sorted(got.get(NEXT, []))
    if depth >= 2:
        block.learn_gain(np.concatenate([np.zeros(0, np.uint8), *(unpack(t, np.uint8) for _, t, _ in gains)]))
    if final and depth:
        return block, None
    totals = np.concatenate([np.zeros(0, np.int64), *(unpack(t, np.int64) for _, t, _ in answers)])
    return block, block.learn(depth, totals, [(bucket, n) for bucket, _, n in answers], known)


class Tables:
    """The blocks, and a table for each round with the blocks' state, what they ask and the replies,
    all bucketed by block; blocks and state are never shuffled. They are the tables of a database
    below the shared folder; a round's goes when the next one's is written."""

    def __init__(self, docs: DataFrame, block_bytes: int):
        self.spark, self.database, self.n_rounds = docs.sparkSession, f"starforge_suffix_tree_{uuid.uuid4().hex}", 0
        self.spark.sql(f"CREATE DATABASE {self.database} LOCATION '{scratch_path(self.spark, self.database)}'")
        rows = docs.select("doc_id", (crc_column() % 10 != 0).cast("long").alias("train"), F.col("text").cast("string").alias("text"))
        self.buckets = min(MAX_TABLE_BUCKETS, max(shuffle_partitions(self.spark), 2 * rows.rdd.getNumPartitions()))
        kind = rows.schema["doc_id"].dataType.simpleString()
        self._write(rows.mapInArrow(released(self._cut(block_bytes)), f"block long, doc_ids array<{kind}>, train binary, sizes binary, codes binary, words binary"),
                    "blocks")
        self._write(self.spark.createDataFrame([], ROUND), "round0")

    def _write(self, df: DataFrame, name: str, mode: str = "error") -> None:
        df.write.bucketBy(self.buckets, "block").mode(mode).saveAsTable(f"{self.database}.{name}")

    @staticmethod
    def _cut(block_bytes: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            block = TaskContext.get().partitionId() << 32
            ids, train, sizes, parts, held = [], [], [], [], 0

            def row() -> pa.RecordBatch:
                code, table = pd.factorize(np.concatenate(parts))
                common = np.argsort(-np.bincount(code), kind="stable")      # small numbers for frequent words
                number = np.empty(len(common), np.int32)
                number[common] = np.arange(len(common), dtype=np.int32)
                return pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)),
                     *(pa.array([pack(x)], pa.binary()) for x in (np.concatenate(train), np.concatenate(sizes), number[code], table[common]))],
                    ["block", "doc_ids", "train", "sizes", "codes", "words"])

            for batch in split_batches(batches):
                n = int(pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0)
                if held and held + n > block_bytes:
                    yield row()
                    block, ids, train, sizes, parts, held = block + 1, [], [], [], [], 0
                token, size = tokens(batch.column("text"))
                ids.append(batch.column("doc_id"))
                train.append(batch.column("train").to_numpy())
                sizes.append(size)
                parts.append(token)
                held += n + 1
            if parts:
                yield row()

        return run

    @property
    def blocks(self) -> DataFrame:
        return self.spark.table(f"{self.database}.blocks")

    @property
    def last(self) -> DataFrame:
        return self.spark.table(f"{self.database}.round{self.n_rounds}")

    def ask(self, got: DataFrame) -> DataFrame:
        """Keeps a round's states and questions, and returns the questions."""
        self._write(got, f"round{self.n_rounds + 1}")
        self.spark.sql(f"DROP TABLE {self.database}.round{self.n_rounds}")
        self.n_rounds += 1
        return self.last.filter("keys is not null").select("block", "kind", "bucket", "keys", "amounts")

    def reply(self, got: DataFrame) -> Iterator:
        """Adds the answers to the round, and returns their sums."""
        empty = [F.lit(None).cast(t).alias(c) for c, t in (("state", "array<binary>"), ("keys", "binary"), ("amounts", "binary"))]
        rows = got.select("block", "kind", "bucket", *empty, "totals", "numbers")
        self._write(rows.repartition(self.buckets, "block"), f"round{self.n_rounds}", "append")
        return self.last.filter("block = -1").select("kind", "totals").toLocalIterator()

    def cogrouped(self):
        """Each block beside its state and the replies to it."""
        last = self.last.filter("keys is null and block <> -1").select("block", "kind", "bucket", "state", "totals", "numbers")
        return self.blocks.groupBy("block").cogroup(last.groupBy("block"))

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.database} CASCADE")


def ask(tables: Tables, rounds: list[tuple[str, int]], known: dict, kind: str, depth: int, buckets: int) -> DataFrame:
    """The rows of a round: every block's state, and what it wants to know: counts of runs of
    ``depth`` and the gains of the contexts of one token less."""

    def run(texts: pa.Table, last: pa.Table) -> pa.Table:
        block, wanted = restored(texts, last, rounds, known)
        keys, counts = block.ask(*wanted) if wanted else block.ask_words()
        edge = bucket_edges(keys, buckets).tolist()
        rows = [(NEXT, k, pack(steps(keys[a:b])), pack(counts[a:b])) for k, (a, b) in enumerate(zip(edge[:-1], edge[1:])) if b > a]
        if depth > 1:
            gains, a = block.ask_gain(), 0
            for bucket, numbers in block.under_test:
                n = len(unpack(numbers, np.int64))
                if n:
                    rows.append((GAIN, bucket, numbers, pack(gains[:, a:a + n].ravel())))
                a += n
        name = texts.column("block")[0].as_py()
        return pa.Table.from_pylist([{"block": name, "kind": STATE, "state": block.state()}] + [
            {"block": name, "kind": kind, "bucket": bucket, "keys": k, "amounts": v} for kind, bucket, k, v in rows], schema)

    binary = pa.binary()
    schema = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("bucket", pa.int32()), ("state", pa.list_(binary)), ("keys", binary),
                        ("amounts", binary), ("totals", binary), ("numbers", binary)])
    return tables.cogrouped().applyInArrow(lean_pair(run), ROUND)


def answer(asked: DataFrame) -> DataFrame:
    """Replies, and the bucket's number of keys with a positive total, sum of totals and number
    of frequent keys or live contexts (block -1, as an array of three longs)."""

    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind")[0].as_py()
        keys = [np.cumsum(unpack(k, np.int64 if kind == GAIN else np.uint64)) for k in table.column("keys").to_pylist()]
        amounts = np.concatenate([unpack(v, np.int64).reshape(3 if kind == GAIN else 1, -1) for v in table.column("amounts").to_pylist()], axis=1)
        flat = np.concatenate(keys)
        distinct, number = (None, flat) if kind == GAIN else numbered(flat)
        totals, *room = (np.bincount(number, x).astype(np.int64) for x in amounts)
        if kind == GAIN:
            retained = totals >= MIN_GAIN * SCALE
            often = np.where(retained, *room) >= MIN_GAIN * SCALE
            sent = (RETAINED * retained + LIVE * often).astype(np.uint8)
        else:
            often = totals >= MIN_CONTEXT
            sent = totals
        rank = np.cumsum(often) - 1
        edge = np.cumsum([0, *(len(k) for k in keys)])
        parts = [number[a:b] for a, b in zip(edge[:-1], edge[1:])]
        numbers = [b""] * len(parts) if kind == GAIN else [pack(np.diff(rank[n[often[n]]], prepend=0)) for n in parts]
        total = np.array([(totals > 0).sum(), totals.sum(), often.sum()], np.int64)
        bucket = table.column("bucket")[0].as_py()
        return pa.table({"block": pa.array([*table.column("block").to_pylist(), -1], pa.int64()),
                         "kind": pa.array([kind] * (len(parts) + 1)), "bucket": pa.array([bucket] * (len(parts) + 1), pa.int32()),
                         "totals": pa.array([*(pack(sent[n]) for n in parts), total.tobytes()], pa.binary()),
                         "numbers": pa.array([*numbers, b""], pa.binary())})

    return asked.groupBy("kind", "bucket").applyInArrow(lean(run), "block long, kind string, bucket int, totals binary, numbers binary")


def score(docs: DataFrame, max_depth: float = math.inf, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """With contexts of up to ``max_depth`` words: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, and the number of
    tokens scored in a context (n_in_context) of every whole text."""
    spark = docs.sparkSession
    kind_of_id = docs.schema["doc_id"].dataType.simpleString()
    tables = Tables(docs, block_bytes)
    buckets = max(shuffle_partitions(spark), math.ceil(tables.blocks.count() / 2))
    rounds: list[tuple[str, int]] = []
    known = {"N": 0, "V": 0}

    def ask_all(depth: int) -> tuple[list[int], int]:
        """One round: the three sums of the runs of ``depth``, and how many contexts of one token less are live."""
        asked = tables.ask(ask(tables, rounds, known, NEXT, depth, buckets))
        sums = {NEXT: np.zeros(3, np.int64), GAIN: np.zeros(3, np.int64)}
        for r in tables.reply(answer(asked)):
            sums[r["kind"]] += np.frombuffer(r["totals"], np.int64)
        rounds.append((NEXT, depth))
        return sums[NEXT].tolist(), int(sums[GAIN][2]) if depth > 1 else 1

    (known["V"], known["N"], first), live = ask_all(0)
    depth, frequent = 0, [first]
    while frequent[-2:][0] and live and max(depth, 1) <= max_depth:
        depth += 1
        sums, live = ask_all(depth)
        frequent.append(sums[2])

    def run(texts: pa.Table, last: pa.Table) -> pa.Table:
        block, _ = restored(texts, last, rounds, known, final=True)
        return pa.table({
            "doc_id": texts.column("doc_ids").combine_chunks().flatten(), "held_out": pa.array(block.learner == 0),
            "n_tokens": pa.array(block.size), "n_known": pa.array(block.n_known),
            "train_tokens": pa.array(np.full(len(block.size), known["N"], np.int64)),
            "base_score": pa.array(block.base), "score": pa.array(block.score), "n_in_context": pa.array(block.n_inside)})

    scored = materialize(
        tables.cogrouped().applyInArrow(
            lean_pair(run), f"doc_id {kind_of_id}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_in_context long"),
        "scored")
    tables.drop()
    return scored


def query(spark, sf_dir: str) -> DataFrame:
    """op1: log10 probability of every document under the suffix tree."""
    return score(read_table(spark, sf_dir, "documents"))
