import random
import zlib

import numpy as np
import pytest

from starforge.llm import language_id as L
from starforge.llm import toxicity as T
from tests.conftest import SF001

SYLLABLES = {"aa": ["ka", "lo", "mi", "ter"], "bb": ["schu", "ung", "ein", "ß"], "cc": ["ção", "nh", "éa", "ou"]}


def sentence(rnd, lang, n=40):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(1)
    rows = [(k, sentence(rnd, lang, rnd.randint(3, 60)), lang) for k in range(360) for lang in [rnd.choice(list(SYLLABLES))]]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !?", "bb"), (1003, sentence(rnd, "cc", 20_000), "cc"),
             (None, sentence(rnd, "aa"), "aa"), (1004, sentence(rnd, "bb"), None), (1004, sentence(rnd, "bb"), None)]
    return rows


def test_language_held_out(spark, labelled, tmp_path):
    spark.createDataFrame([(*r, "x", "y") for r in labelled], "doc_id long, text string, lang string, score string, letters string") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    got = L.query(spark, str(tmp_path)).collect()
    assert len(got) == len(labelled)
    truth = {i: lang for i, _, lang in labelled if i is not None and i < 1000}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) == r["held_out"] for r in got if r["doc_id"] is not None)
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) >= 0.97
    named = {r["doc_id"]: r for r in got}
    for i in (1000, 1001, 1002):
        assert (named[i]["lang_pred"], named[i]["score"]) == ("und", 0.0)
    assert named[1003]["lang_pred"] == "cc" and named[1004]["lang_pred"] == "bb" and named[None]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = L.stage(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == len(labelled) - 3
    nothing = L.predict(docs.limit(5), None)
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
    assert L.predict(docs.limit(0), L.fit(docs.limit(0))).count() == 0


def test_convolution_equals_its_definition():
    rng = np.random.default_rng(1)
    net = L.ByteConvNet(["a", "b"])
    x = rng.integers(0, L.CLASSES, (3, L.WINDOW)).astype(np.uint8)
    hidden = []
    for w in L.WIDTHS:
        r = np.array([[sum(net.filters[w][j][line[t + j]] for j in range(w)) for t in range(L.WINDOW - w + 1)] for line in x])
        hidden.append(r.max(axis=1) + net.bias[w])
    want = np.log(L.softmax(np.maximum(np.concatenate(hidden, 1), 0) @ net.dense + net.offset))
    assert np.allclose(net.log_probabilities(x), want, atol=1e-4)


def test_whole_texts_count():
    x, owner, size = L.windows_of([b"a" * 700, b"", b"b" * 256])
    assert owner.tolist() == [0, 0, 0, 1, 2] and size.tolist() == [256, 256, 188, 1, 256]


def test_toxicity_held_out(spark):
    got = {r["doc_id"]: r for r in T.query(spark, SF001).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    held = [(got[i]["score"], y) for i, y in labels.items() if got[i]["held_out"]]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([[p > n for n in neg] for p in pos]) >= 0.8          # area under the curve; labels hold noise
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got.values())


def test_toxicity_odd_rows(spark, docs_of, odd_rows):
    labels = spark.createDataFrame([(1, 1, 1), (5, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    docs = docs_of(odd_rows)
    assert T.score(docs, T.fit(docs, labels)).count() == len(odd_rows)
    none = T.score(docs, T.fit(docs, labels.limit(0))).collect()
    assert max(r["score"] for r in none) < 1e-9
    assert T.score(docs.limit(0), T.FactorizationMachine()).count() == 0


def test_pairs_are_learned():
    """Toxic only when both terms meet: additive weights can't tell, the machine can."""
    rng = np.random.default_rng(1)
    rows, y = [], []
    for _ in range(1500):
        a, b = rng.integers(0, 2, 2)
        rows.append(np.array(sorted([*([3] if a else []), *([9] if b else []), *rng.integers(20, 60, 4)])))
        y.append(float(a and b))
    y = np.array(y)
    m = T.FactorizationMachine(bits=6).fit([np.unique(r) for r in rows], y, epochs=40)
    p = np.array([m.score(np.unique(r)) for r in rows])
    assert ((p >= 0.5) == (y == 1)).mean() >= 0.97
    assert abs(float(m.v[3] @ m.v[9])) > 0.3
