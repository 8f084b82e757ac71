import gzip
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starforge.llm import warc as W
from starforge.llm.common import scratch_path


def round_trip(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x")).withColumn("first", F.lit(1))
    path = scratch_path(spark, "warc-test")
    W.write(df, path, **options)
    return path, W.read(spark, path).collect()


def test_records_come_back(spark):
    magic = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc"
    rnd = random.Random(1)
    rows = [(k, f"http://a/{k}", rnd.choice(["é", "x\r\n\r\n", magic]) * rnd.randint(0, 400)) for k in range(60)]
    rows += [(100, None, None), (101, "u", ""), (102, "u\r\nX: y", magic), (103, "u", magic), (103, "u", magic), (None, "u", magic), (104, "u", "é" * 900)]
    _, got = round_trip(spark, rows, segment_bytes=100)
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = Counter()
    for i, _, html in rows:
        body = (html or "").encode()
        revisit = i is not None and first[html or ""] < i
        want[(None if i is None else str(i), len(body), W.base32_sha1(body), "revisit" if revisit else "response",
              str(first[html or ""]) if revisit else None, None if revisit else body)] += 1
    assert Counter((r["row_id"], r["size"], r["digest"], r["record_type"], r["refers_to"],
                    None if r["payload"] is None else bytes(r["payload"])) for r in got) == want
    assert not any(r["problem"] for r in got)


def test_small_payloads_are_never_revisits(spark):
    _, got = round_trip(spark, [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcd"), (4, "u", "abcd")], min_bytes=4)
    assert {r["row_id"]: r["refers_to"] for r in got} == {"1": None, "2": None, "3": None, "4": "3"}


def test_empty_table(spark):
    path = scratch_path(spark, "warc-none")
    W.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert W.read(spark, path).count() == 0


def test_damage_is_reported(spark, tmp_path):
    whole = list(W.response_records(1, "u", b"x" * 500, 200))
    short = list(W.response_records(2, "u", b"y" * 500, 200))
    wrong = W.record([("WARC-Type", "response"), ("WARC-Record-ID", W.record_id(3, "Z")), ("WARC-Payload-Digest", "sha1:Z")], W.HTTP + W.chunked(b"abc"))
    lost = W.revisit_record(4, "u", "D", 99)
    with gzip.open(tmp_path / "a.warc.txt.gz", "wb") as fh:
        fh.write(b"".join(r + b"\r\n\r\n" for r in [*whole[::-1], short[0], *short[2:], wrong, lost]) + whole[0][:60])
    got = {r["row_id"]: (r["size"], r["problem"]) for r in W.read(spark, str(tmp_path)).collect() if r["row_id"]}
    assert got["1"] == (500, None)          # segments in any order
    assert got["2"][1] == "a segment is missing"
    assert "digest" in got["3"][1] and "missing" in got["4"][1]


def test_chunked_framing():
    for n in (0, 1, 9, 10, 11):
        assert W.unchunked(W.chunked(b"z" * n, 10)) == b"z" * n
    assert W.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: t\r\n\r\n") == b"abc"
    for bad in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            W.unchunked(bad)


def test_damaged_numbers_end_no_job():
    """Sizes that are no numbers come back with a reason; no loop, no crash."""
    for body in (b"5\r\nhello\r\n  -8\r\n0\r\n\r\n", b"+5\r\nhello\r\n0\r\n\r\n", b"0x5\r\nhello\r\n0\r\n\r\n", b"1_0\r\nhello\r\n0\r\n\r\n", b"\r\n0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            W.unchunked(body)
    assert W.unchunked(b"5;x=y\r\nhello\r\n0\r\n\r\n") == b"hello"
    ok = {"warc-record-id": "<urn:x-page:1:0>", "warc-type": "response", "content-length": "3"}
    for name, value in (("content-length", "ten"), ("warc-segment-number", "-1"), ("warc-segment-number", "1e3"), ("warc-segment-number", "9" * 30),
                        ("warc-segment-total-length", "0x10"), ("content-length", "+3")):
        got = W.parse({**ok, name: value}, b"abc", True)
        assert got["problem"] == f"no number in {name}" and got["segment"] is None and got["origin"] is None
