import hashlib

import numpy as np
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from starforge.llm import byte_bpe as B

VOCAB, PATTERN = B.public_vocabulary()
ENCODING = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(VOCAB)}, special_tokens={})
ENCODER = B.TextEncoder(B.BytePairCodec(VOCAB), PATTERN)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text("ab the'sing \n\t  é1漢", max_size=60)), max_size=6))
def test_ids_equal_the_library(texts):
    for text, ids in zip(texts, ENCODER.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == ENCODING.encode_ordinary(text)


def test_long_pieces():
    for n in (B.MATRIX_MAX - 1, B.MATRIX_MAX, B.MATRIX_MAX + 1, 6_000):
        for unit in ("a", "ab", "the", "xyzé"):
            text = (unit * n)[:n]
            assert np.frombuffer(ENCODER.encode([text])[0], "<u4").tolist() == ENCODING.encode_ordinary(text)


def test_odd_rows(spark, docs_of, odd_rows):
    got = B.encode(docs_of(odd_rows), VOCAB, PATTERN, digest=True).collect()
    want = []
    for i, t in odd_rows:
        ids = np.array(ENCODING.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    encoded = B.encode(docs_of(odd_rows), VOCAB, PATTERN)
    assert all(r["round_trip"] for r in encoded.collect())
    decoded = B.decode(encoded, VOCAB).collect()
    assert sorted((r["doc_id"], bytes(r["bytes"])) for r in decoded if r["doc_id"]) == sorted((i, (t or "").encode()) for i, t in odd_rows if i)
    assert B.encode(docs_of(odd_rows[:1]).limit(0), VOCAB, PATTERN).count() == 0
