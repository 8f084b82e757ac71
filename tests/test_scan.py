import csv
import hashlib
import io
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from starforge.sources import scan as S


def files(spark, paths):
    return spark.createDataFrame([("file:" + p, os.path.splitext(p)[1].lower(), os.path.getsize(p)) for p in paths],
                                 "uri string, format string, size_bytes long")


def write(folder, name, data):
    p = os.path.join(folder, name)
    with open(p, "wb") as fh:
        fh.write(data if isinstance(data, bytes) else data.encode())
    return p


def pieces(data, fmt, cut):
    """A file's ranges of the given lengths, scanned one by one, and folded."""
    out, at = [], 0
    for k, n in enumerate(cut):
        out.append(S.scan_range(io.BytesIO(data), "u", fmt, len(data), k, at, n, 1 << 20))
        at += n
    return S.fold("u", out)


def cuts(rng, size):
    out = []
    while sum(out) < size:
        out.append(min(size - sum(out), rng.randint(1, 9)))
    return out or [0]


@pytest.mark.parametrize("seed", range(6))
def test_csv_states_and_records_of_any_ranges(seed):
    rng = random.Random(seed)
    rows = [["a", "b\nc", 'he said "x"']] + [["".join(rng.choice('xé,"\n\r 1') for _ in range(rng.randint(0, 6))) for _ in range(3)] for _ in range(30)]
    text = io.StringIO(newline="")
    csv.writer(text, lineterminator="\n").writerows(rows)
    data = (b"\xef\xbb\xbf" if seed % 2 else b"") + text.getvalue().encode()
    whole = pieces(data, ".csv", [len(data)])
    for _ in range(20):
        got = pieces(data, ".csv", cuts(rng, len(data)))
        assert {k: got[k] for k in got if k not in ("splits", "checksum")} == {k: whole[k] for k in whole if k not in ("splits", "checksum")}
        assert got["utf8"] and got["spans_lines"]
        records = [r for s in got["splits"] for r in S.csv_record_bytes(io.BytesIO(data), len(data), s["offset"], s["length"], s["state"])]
        assert [r[0] for r in records] == sorted({r[0] for r in records})
        joined = "\n".join(r[1].decode().removeprefix("\ufeff") for r in records)
        assert list(csv.reader(io.StringIO(joined, newline=""))) == rows


def test_utf8_validity_of_any_ranges():
    rng = random.Random(3)
    for k in range(60):
        data = bytearray("aé漢😀z".encode() * rng.randint(1, 4))
        if k % 2:
            data[rng.randrange(len(data))] = rng.choice([0xFF, 0x80, 0xC3])
        if k % 5 == 0:
            data = data[:-2] + bytearray([0xE6, 0xBC])
        try:
            want = bool(bytes(data).decode() or True)
        except UnicodeDecodeError:
            want = False
        for _ in range(10):
            assert pieces(bytes(data), ".csv", cuts(rng, len(data)))["utf8"] == want


@pytest.mark.parametrize("seed", range(6))
def test_json_states_and_elements_of_any_ranges(seed):
    rng = random.Random(seed)
    odd = ['\\', '"', '\\"', "[", "]", "{", ",", "\n", "é", "x"]
    values = [{"k": "".join(rng.choice(odd) for _ in range(rng.randint(0, 7))), "n": [k, {"m": None}]} for k in range(12)] + ["a,b", 3, [], {}]
    rng.shuffle(values)
    data = json.dumps(values, ensure_ascii=bool(seed % 2), indent=seed % 3 or None).encode()
    for _ in range(20):
        got = pieces(data, ".json", cuts(rng, len(data)))
        assert got["decodable"] and got["kind"] == "array"
        found = [e for s in got["splits"] for e in S.json_element_bytes(io.BytesIO(data), len(data), s["offset"], s["length"], s["state"], s["depth"], len(got["header"]))]
        assert all(closed for _, _, closed in found)
        assert [json.loads(text) for _, text, _ in sorted(found)] == values


@pytest.mark.parametrize("text, ok", [("[]", True), (" [ ] \n", True), ("[1", False), ('["a]', False), ("[1]]", False), ('[{"a": "\\\\"}]', True)])
def test_json_brackets(text, ok):
    rng = random.Random(1)
    data = text.encode()
    assert all(pieces(data, ".json", cuts(rng, len(data)))["decodable"] == ok for _ in range(10))


@pytest.mark.parametrize("text, at", [('[1, tru, 3]', 3), ('[1] x', 3), ('[1,,2]', 3), ('[{"a": 1}, {"b" 2}]', 10), ('[1, 2', 3), ('[1][2]', 3)])
def test_json_problem_offsets(spark, tmpdir_path, text, at):
    p = write(tmpdir_path, "x.json", text)
    scanned = S.scan(files(spark, [p])).join(files(spark, [p]), "uri")
    got = S.json_problems(scanned, spark).collect()
    assert (len(got) == 1 and got[0]["problem_at"] in (at, at + 1)) or not scanned.first()["decodable"]


def test_fingerprint_does_not_depend_on_ranges(spark, tmpdir_path):
    rng = random.Random(2)
    data = bytes(rng.randrange(256) for _ in range(10_000))
    paths = [write(tmpdir_path, n, d) for n, d in (("a.bin", data), ("b.bin", data), ("c.bin", data[:-1]), ("e.bin", b""), ("s.bin", b"short"))]
    want = hashlib.sha256("".join(hashlib.sha256(data[k:k + 512]).hexdigest() for k in range(0, len(data), 512)).encode()).hexdigest()
    for range_bytes in (512, 1_000, 4_096, 1 << 20):
        got = {os.path.basename(r["uri"]): r["checksum"] for r in S.scan(files(spark, paths), range_bytes, 512).collect()}
        assert got["a.bin"] == got["b.bin"] == want != got["c.bin"]
        assert got["e.bin"] == hashlib.sha256(b"").hexdigest() and got["s.bin"] == hashlib.sha256(b"short").hexdigest()


def test_large_sparse_file_is_many_tasks(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "big.bin")
    with open(p, "wb") as fh:
        fh.truncate(5 << 30)
    f = files(spark, [p])
    per_task = S.ranges(f, 64 << 20).groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 20 and max(r["count"] for r in per_task) < 20
    got = S.scan(f, 64 << 20).first()
    leaf = hashlib.sha256(bytes(S.LEAF)).hexdigest()
    assert got["checksum"] == hashlib.sha256((leaf * ((5 << 30) // S.LEAF)).encode()).hexdigest()
    assert sum(s["length"] for s in got["splits"]) == 5 << 30


def test_xml_and_workbooks(spark, tmpdir_path):
    paths = [write(tmpdir_path, "a.xml", "<?xml version='1.0'?><!-- <x> --><rows><rec id='1'><v>1</v></rec></rows>"), write(tmpdir_path, "b.xml", "<rows><rec></rows>"),
             write(tmpdir_path, "c.xlsx", b"not a zip")]
    got = {os.path.basename(r["uri"]): r for r in S.scan(files(spark, paths)).collect()}
    assert got["a.xml"]["row_tag"] == "rec" and got["a.xml"]["decodable"]
    assert not got["b.xml"]["decodable"] and got["b.xml"]["problem_at"] > 0 and not got["c.xlsx"]["decodable"]


def test_whole_files_where_a_store_has_no_positions(spark, tmpdir_path, monkeypatch):
    paths = [write(tmpdir_path, "a.csv", 'h,i\n"x\ny",1\n'), write(tmpdir_path, "b.json", '[{"a": 1}]')]
    by_position = sorted(map(str, S.scan(files(spark, paths)).collect()))
    monkeypatch.setattr(S, "can_open", lambda uri: False)
    assert sorted(map(str, S.scan(files(spark, paths)).collect())) == by_position


def test_small_ranges_and_files_share_tasks(spark, tmpdir_path):
    """A task takes LEAF bytes at least, and a range reads its own bytes and the end of its last record only."""
    from starforge.sources.readers import read_json, scanned_files
    big, rows = os.path.join(tmpdir_path, "big.json"), [{"k": i, "s": "x]" * (i % 9)} for i in range(4_000)]
    with open(big, "w") as f:
        json.dump(rows, f)
    small = []
    for i in range(40):
        small.append(os.path.join(tmpdir_path, f"small{i}.json"))
        with open(small[-1], "w") as f:
            json.dump([{"k": 10_000 + i, "s": "y"}], f)
    found = scanned_files(spark, [big, *small], ".json", range_bytes=256, leaf=256)
    elements = S.json_elements(found)
    assert elements.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    listing = found.select("uri", "size_bytes", F.lit(".json").alias("format"))
    assert S.ranges(listing, 256).rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    got = read_json(spark, [big, *small], scanned=found)
    want = sorted((str(r["k"]), r["s"]) for r in [*rows, *({"k": 10_000 + i, "s": "y"} for i in range(40))])
    assert sorted((r["k"], r["s"]) for r in got.select("k", "s").collect()) == want
    read = []

    class Counted(io.BytesIO):
        def read(self, n=-1):
            data = super().read(n)
            read.append(len(data))
            return data

    size = os.path.getsize(big)
    with open(big, "rb") as f:
        text = f.read()
    list(S.json_element_bytes(Counted(text), size, 0, 256, S.OUTSIDE, 0, 0))
    assert sum(read) < 2_000 < size
