"""WARC archives: writing records, reading them back, reassembling segments.

Writing: one record per row, an HTTP response whose payload travels in chunked
transfer framing. Blocks over ``SEGMENT_BYTES`` are segmented: the record holds
segment 1, continuation records name it as their origin and carry their number, the
last one the total length. Of records with equal payloads (of at least ``min_bytes``)
the one with the smallest id is the response, the others are revisits without payload.
Files are gzip-compressed text files of Spark's writer whose line separator is the two
line ends after a WARC block, so executors write them wherever Spark can.

Reading: the text reader cuts a file at the version line; a cut inside a block is
joined again by the record's Content-Length (compressed files are never split, so the
parts arrive in order). Continuations are grouped by origin identifier, ordered by
number, checked for gaps and for the total length, and the chunked framing is decoded.

Nulls: a null payload is empty, a null url is left out; a row with a null id is always
a response and can't be referred to. Empty tables write and read nothing. Rows that
repeat id and payload give identical records; each row comes back. Other columns are
not read. Damaged records come back with the reason in ``problem``.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.llm.common import materialize, raw, read_table, scratch_path, split_batches

VERSION = "WARC/1.1"
END = "\r\n\r\n"
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
DATE = "1970-01-01T00:00:00Z"       # pages carry no capture time
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    out = [b"%X\r\n%b\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        digits = body[at:end].split(b";")[0].strip(b" \t")
        if not digits or digits.strip(b"0123456789abcdefABCDEF"):
            raise ValueError("a chunk's size is no hexadecimal number")
        size = int(digits, 16)
        at = end + 2
        if size == 0:
            if not body.endswith(b"\r\n"):
                raise ValueError("the last chunk isn't closed")
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk isn't as long as it says")
        out.append(body[at:at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no end of the HTTP header")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def record_id(row_id, digest: str) -> str:
    return f"<urn:x-page:{'' if row_id is None else row_id}:{digest}>"


def response_records(row_id, url: str | None, payload: bytes, segment_bytes: int) -> Iterator[bytes]:
    digest = base32_sha1(payload)
    name, block = record_id(row_id, digest), HTTP + chunked(payload)
    target = [("WARC-Target-URI", " ".join(url.split()))] if url and url.strip() else []
    common = [("WARC-Date", DATE), *target]
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", name), *common, ("WARC-Payload-Digest", f"sha1:{digest}"),
             ("Content-Type", "application/http; msgtype=response")]
    yield record(first + ([("WARC-Segment-Number", "1")] if len(parts) > 1 else []), parts[0])
    for k, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if k == len(parts) else []
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{k}>"), *common,
                      ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(k)), *last], part)


def revisit_record(row_id, url: str | None, digest: str, refers_to) -> bytes:
    target = [("WARC-Target-URI", " ".join(url.split()))] if url and url.strip() else []
    return record([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(row_id, digest)), ("WARC-Date", DATE), *target,
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Refers-To", record_id(refers_to, digest))], b"")


def write(pages: DataFrame, path: str, id_column: str = "page_id", url: str = "url", payload: str = "html",
          min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write ``pages`` as WARC files below ``path``."""
    rows = pages.select(F.col(id_column).alias("id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    digests = rows.select("id", F.sha1(F.col("payload").cast("binary")).alias("sha"), F.octet_length("payload").alias("size")) \
        .filter((F.col("size") >= min_bytes) & F.col("id").isNotNull())
    groups = digests.groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    revisits = digests.join(groups.select("sha", "first"), "sha").filter("id > first").select("id", "sha", "first").distinct()
    keyed = rows.withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    marked = keyed.join(revisits, ["id", "sha"], "left").select("id", "url", "payload", "first")

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_batches(batches, "payload"):
            out: list[bytes] = []
            for row_id, link, body, first in zip(batch.column("id").to_pylist(), batch.column("url").to_pylist(),
                                                 raw(batch, "payload"), batch.column("first").to_pylist()):
                if first is None:
                    out.extend(response_records(row_id, link, body, segment_bytes))
                else:
                    out.append(revisit_record(row_id, link, base32_sha1(body), first))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    marked.mapInArrow(frame, "record binary").select(F.col("record").cast("string").alias("value")) \
        .write.option("lineSep", END).option("compression", "gzip").text(path)


RECORD = ("record_id string, type string, row_id string, segment int, origin string, total long, digest string, "
          "refers_to string, size long, payload binary, block binary, problem string")


def whole_number(text: str | bytes | None) -> int | None:
    """A header's number of ASCII digits, below 2^63; None for anything else."""
    text = text.decode("latin-1") if isinstance(text, bytes) else text or ""
    text = text.strip(" \t")
    return int(text) if text and len(text) < 19 and not text.strip("0123456789") else None


def parse(headers: dict[str, str], block: bytes, with_payload: bool) -> dict:
    """A row of RECORD; whole responses are decoded, segments keep their block. A header number that is
    none is told in ``problem``, and the record is not decoded."""
    name, kind = headers.get("warc-record-id", ""), headers.get("warc-type", "")
    number, total = headers.get("warc-segment-number"), headers.get("warc-segment-total-length")
    segment = whole_number(number)
    out = {"record_id": name, "type": kind, "row_id": id_of(name), "segment": segment if segment is not None and segment < 1 << 31 else None,
           "origin": headers.get("warc-segment-origin-id", name) if number else None, "total": whole_number(total),
           "digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None, "refers_to": headers.get("warc-refers-to")}
    wrong = [k for k, v, n in (("content-length", headers.get("content-length", "0"), whole_number(headers.get("content-length", "0"))),
                               ("warc-segment-number", number, out["segment"]), ("warc-segment-total-length", total, out["total"])) if v and n is None]
    if wrong:
        return out | {"segment": None, "origin": None, "problem": f"no number in {', '.join(wrong)}"}
    if number:
        return out | {"block": block}
    return out | (decoded(block, out["digest"], with_payload) if kind == "response" else {})


def id_of(name: str) -> str | None:
    """The row id inside a record id of :func:`record_id`."""
    return name.strip("<>").split(":")[2] or None if name.startswith("<urn:x-page:") else None


def decoded(block: bytes, digest: str | None, with_payload: bool) -> dict:
    try:
        payload = payload_of(block)
    except ValueError as e:
        return {"problem": f"broken response: {e}"}
    found = base32_sha1(payload)
    return {"size": len(payload), "digest": found, "payload": payload if with_payload else None,
            "problem": None if digest in (None, found) else "the payload doesn't have its digest"}


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archives below ``path``, in RECORD's columns."""
    magic = f"{VERSION}\r\n"
    lines = spark.read.option("lineSep", magic).text(path) \
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD.split(", ")]
        schema = pa.schema([pa.field(n, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}.get(f.split()[1], pa.string()))
                            for n, f in zip(names, RECORD.split(", "))])
        open_file, text, need = None, b"", 0

        def close() -> Iterator[dict]:
            if text.strip():
                head, _, rest = text.partition(b"\r\n\r\n")
                headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n"))}
                size = whole_number(headers.get("content-length", "0")) or 0
                row = parse(headers, rest[:size], with_payload)
                if len(rest) < size:
                    row = {**row, "block": None, "payload": None, "size": None, "problem": "the file ends inside the record"}
                yield row

        def whole(part: bytes) -> bool:
            head, gap, rest = part.partition(b"\r\n\r\n")
            for line in head.split(b"\r\n") if gap else ():
                if line[:15].lower() == b"content-length:":
                    size = whole_number(line[15:])
                    return size is None or len(rest) >= size
            return False

        for batch in split_batches(batches, "value"):
            rows: list[dict] = []
            for file, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
                if file != open_file:
                    rows.extend(close())
                    open_file, text = file, value
                elif not text.strip() or whole(text):
                    rows.extend(close())
                    text = value
                else:                   # the version line was part of a block
                    text = text + magic.encode() + value
            yield pa.RecordBatch.from_pylist(rows, schema)
        yield pa.RecordBatch.from_pylist(list(close()), schema)

    return lines.mapInArrow(run, RECORD)


def reassemble(records: DataFrame, with_payload: bool = True) -> DataFrame:
    """Responses made of segments: row_id, digest, size, payload, problem; one row per copy."""
    parts = records.filter("segment is not null and problem is null") \
        .groupBy("origin").agg(F.max("row_id").alias("row_id"), F.max("digest").alias("digest"), F.max("total").alias("total"),
                               F.sum((F.col("segment") == 1).cast("int")).alias("copies"),
                               F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                blocks = {p["segment"]: p["block"] for p in row["parts"]}
                block = b"".join(blocks.values())
                if list(blocks) != list(range(1, len(blocks) + 1)) or row["total"] is None:
                    got = {"problem": "a segment is missing"}
                elif len(block) != row["total"]:
                    got = {"problem": "the segments don't have the total length"}
                else:
                    got = decoded(block, row["digest"], with_payload)
                rows.append({"record_id": row["origin"], "row_id": row["row_id"], "copies": max(1, row["copies"])}
                            | {"digest": row["digest"]} | got)
            yield pa.RecordBatch.from_pylist(rows, pa.schema(
                [("record_id", pa.string()), ("row_id", pa.string()), ("copies", pa.int32()), ("digest", pa.string()),
                 ("size", pa.int64()), ("payload", pa.binary()), ("problem", pa.string())]))

    whole = parts.select("origin", "row_id", "digest", "total", F.col("copies").cast("int").alias("copies"), "parts").mapInArrow(
        run, "record_id string, row_id string, copies int, digest string, size long, payload binary, problem string")
    return whole.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per archived row: row_id, size, digest, record_type, refers_to (row id),
    problem and, with ``with_payload``, the payload (of a revisit: null)."""
    records = materialize(read_records(spark, path, with_payload), "records")
    columns = ["record_id", "row_id", "size", "digest", "payload", "problem"]
    responses = records.filter("type = 'response' and (segment is null or problem is not null)").select(*columns) \
        .unionByName(reassemble(records, with_payload).select(*columns))
    first = responses.filter("problem is null").groupBy("record_id").agg(F.max("size").alias("r_size"), F.max("digest").alias("r_digest"))
    revisits = records.filter("type = 'revisit'").select("row_id", "digest", F.col("refers_to").alias("record_id")) \
        .join(first, "record_id", "left") \
        .select("row_id", F.col("r_size").alias("size"), "digest", F.lit(None).cast("binary").alias("payload"),
                F.lit("revisit").alias("record_type"), F.split(F.regexp_replace("record_id", "[<>]", ""), ":")[2].alias("refers_to"),
                F.when(F.col("r_size").isNull(), "the record referred to is missing")
                .when(F.col("r_digest") != F.col("digest"), "the record referred to has another digest").alias("problem"))
    answered = responses.select("row_id", "size", "digest", "payload", F.lit("response").alias("record_type"),
                                F.lit(None).cast("string").alias("refers_to"), "problem")
    return answered.unionByName(revisits)


def query(spark, sf_dir: str) -> DataFrame:
    """op2: writes the archive of all pages and reads it back."""
    pages = read_table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    write(pages, path)
    kind = pages.schema["page_id"].dataType
    return read(spark, path, with_payload=False).select(
        F.col("row_id").cast(kind).alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
