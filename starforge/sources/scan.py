"""Files in byte ranges: one distributed pass that fingerprints a file and finds where its records begin.

Executors read ranges of about ``RANGE`` bytes, so a file of any size is many tasks. What a
range means depends on what comes before it (is it inside a quoted field, a JSON string, a
character?), so each range reports a *transition* instead: for every state it could begin in,
the state it ends in. Composing the transitions in order gives each range its true first state;
a second pass can then cut any range into whole records on its own (:func:`csv_records`,
:func:`json_elements`).

* fingerprint: SHA-256 of every ``LEAF`` bytes, then of the joined hex digests. It doesn't depend on
  the ranges. A file of one leaf has that leaf's digest, the plain SHA-256 of its bytes.
* CSV: quotes seen so far, odd or even; whether a line break lies inside a field; the header.
* UTF-8: bytes before the first whole character and after the last one.
* JSON: in a string, in one behind a backslash, or outside, with the change of bracket depth.
* XML and workbooks are walked by one streaming task per file (bounded memory), which also gives
  the row tag.

Bytes are read by position with ``pyarrow.fs`` (local and shared folders, S3, GCS, ABFS, HDFS and
viewfs where libhdfs is installed). Where it can't open a store, Spark's ``binaryFile`` reader
hands over whole files (below 2 GB each) and every file is one range.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAF = 4 << 20
RANGE = 8 * LEAF
CHUNK = 4 << 20
HEADER_BYTES = 1 << 20                  # a header line is looked for in so many bytes
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2      # of a JSON string; ESCAPED: inside, behind a backslash
WHITE = b" \t\r\n"


# -- reading by position --------------------------------------------------------
def opened(uri: str):
    """A seekable file for a URI as Spark writes it (``file:/a b``, ``s3a://...``)."""
    from urllib.parse import quote

    from pyarrow import fs
    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem().open_input_file("/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else uri)
    store, path = fs.FileSystem.from_uri(quote(re.sub(r"^s3[an]:", "s3:", uri), safe=":/@"))
    return store.open_input_file(path)


def can_open(uri: str) -> bool:
    """Whether tasks can read this store by position."""
    try:
        opened(uri).close()
        return True
    except (pa.ArrowInvalid, NotImplementedError, OSError):
        return False


def chunks(f, offset: int, length: int, first: int | None = None) -> Iterator[bytes]:
    """Bytes of a range, CHUNK at a time, or ``first`` and then twice as many each time where that is less."""
    f.seek(offset)
    size = max(1, min(CHUNK, first or CHUNK))
    while length > 0:
        data = f.read(min(size, length))
        size = min(CHUNK, 2 * size)
        if not data:
            return
        yield data
        length -= len(data)


# -- transitions ------------------------------------------------------------------
def unescaped_quotes(data: np.ndarray) -> tuple[np.ndarray, int]:
    """Places of the quotes not behind an odd number of backslashes, counting from the start of
    ``data``, and the place of the quote (if any, else -1) that is judged the other way if the byte before ``data`` escapes its first."""
    q = np.flatnonzero(data == 0x22)
    run = np.zeros(len(q), np.int64)
    active = np.flatnonzero(q > 0)
    while len(active):
        active = active[(q[active] - run[active] > 0) & (data[np.maximum(q[active] - run[active] - 1, 0)] == 0x5C)]
        run[active] += 1
    leading = q[run == q]
    return q[run % 2 == 0], int(leading[0]) if len(leading) else -1


class JsonPart:
    """What a piece of JSON does, for each state it may begin in: the state behind it, the change of
    depth, and the lowest depth on the way."""

    def __init__(self, end=(0, 1, 2), depth=(0, 0, 0), low=(0, 0, 0)):
        self.end, self.depth, self.low = list(end), list(depth), list(low)

    @staticmethod
    def of(piece: bytes) -> JsonPart:
        data = np.frombuffer(piece, np.uint8)
        plain, leading = unescaped_quotes(data)
        flipped = plain if leading < 0 else np.setxor1d(plain, [leading])
        bracket = np.flatnonzero((data == 0x5B) | (data == 0x7B) | (data == 0x5D) | (data == 0x7D))
        step = np.where((data[bracket] == 0x5B) | (data[bracket] == 0x7B), 1, -1)
        tail = 0
        while tail < len(data) and data[-1 - tail] == 0x5C:
            tail += 1
        out = JsonPart()
        for s in (OUTSIDE, INSIDE, ESCAPED):
            quotes = flipped if s == ESCAPED else plain
            inside = s != OUTSIDE
            here = (np.searchsorted(quotes, bracket) + inside) % 2 == 0
            depth = np.cumsum(step[here])
            out.depth[s], out.low[s] = (int(depth[-1]), min(0, int(depth.min()))) if len(depth) else (0, 0)
            ends_inside = (len(quotes) + inside) % 2 == 1
            behind = tail - (s == ESCAPED and tail == len(data) > 0)
            out.end[s] = (ESCAPED if behind % 2 else INSIDE) if ends_inside else OUTSIDE
            if s == ESCAPED and not len(data):
                out.end[s] = ESCAPED
        return out

    def then(self, later: JsonPart) -> JsonPart:
        s = range(3)
        return JsonPart([later.end[self.end[k]] for k in s], [self.depth[k] + later.depth[self.end[k]] for k in s],
                        [min(self.low[k], self.depth[k] + later.low[self.end[k]]) for k in s])


class Utf8Part:
    """Bytes before the first whole character, whether the rest is valid, and bytes behind the last one."""

    def __init__(self):
        self.head, self.ok, self.size = b"", True, 0
        self.decoder = codecs.getincrementaldecoder("utf-8")()

    def add(self, data: bytes) -> None:
        if len(self.head) == self.size:             # nothing but continuation bytes so far
            n = 0
            while n < len(data) and len(self.head) + n < 3 and 0x80 <= data[n] <= 0xBF:
                n += 1
            self.head += data[:n]
            self.size += len(data)
            data = data[n:]
        else:
            self.size += len(data)
        if self.ok and data:
            try:
                self.decoder.decode(data)
            except UnicodeDecodeError:
                self.ok = False

    @property
    def tail(self) -> bytes:
        return self.decoder.getstate()[0] if self.ok else b""


class CsvPart:
    """Quotes odd or even; whether a line break lies in a field, for either state at the start."""

    def __init__(self):
        self.odd, self.broken = 0, [False, False]

    def add(self, piece: bytes) -> None:
        if b'"' not in piece:
            if b"\n" in piece:
                self.broken[1 - self.odd] = True
            return
        data = np.frombuffer(piece, np.uint8)
        quotes, breaks = np.flatnonzero(data == 0x22), np.flatnonzero(data == 0x0A)
        parity = (np.searchsorted(quotes, breaks) + self.odd) % 2
        for s in (0, 1):
            self.broken[s] |= bool((parity != s).any())
        self.odd = (self.odd + len(quotes)) % 2


def header_of(data: bytes) -> bytes | None:
    """The first record's bytes; None if it doesn't end here."""
    data = data.removeprefix(b"\xef\xbb\xbf")
    at = -1
    while (at := data.find(b"\n", at + 1)) >= 0:
        if data.count(b'"', 0, at) % 2 == 0:
            return data[:at].rstrip(b"\r")
    return None


# -- the pass over ranges -------------------------------------------------------------
PIECE = ("uri string, part long, offset long, length long, leaves array<string>, odd int, broken array<boolean>, head binary, tail binary, valid boolean, "
         "whole boolean, json_end array<int>, json_depth array<long>, json_low array<long>, header binary, kind string, row_tag string, problem string, problem_at long")
SCAN = ("uri string, checksum string, utf8 boolean, header binary, spans_lines boolean, kind string, row_tag string, decodable boolean, problem string, "
        "problem_at long, splits array<struct<offset:long,length:long,state:int,depth:long>>")


def walk_xml(f, size: int) -> tuple[str | None, str | None, int | None]:
    """(row tag, problem, its byte) of an XML file, read as a stream: the row tag is the first child of the root."""
    from xml.parsers import expat
    parser, names, at = expat.ParserCreate(), [], [0]

    def start(name, _):
        if len(names) < 2:
            names.append(name)

    parser.StartElementHandler = start
    try:
        for data in chunks(f, 0, size):
            parser.Parse(data, False)
        parser.Parse(b"", True)
    except expat.ExpatError as e:
        return None, f"XML: {expat.ErrorString(e.code)}", max(0, parser.ErrorByteIndex)
    return names[1] if len(names) > 1 else None, None, None


def walk_workbook(f) -> str | None:
    """What is wrong with a workbook, if anything; entries are read one after the other."""
    import zipfile
    try:
        with zipfile.ZipFile(f) as z:
            bad = z.testzip()
            if bad:
                return f"workbook: damaged entry {bad}"
            if not any(n.startswith("xl/worksheets/") for n in z.namelist()):
                return "workbook: no sheet"
    except Exception as e:                  # whatever the decoder raises, the file fails and the run goes on
        return f"workbook: {type(e).__name__}"
    return None


def scan_range(f, uri: str, fmt: str, size: int, part: int, offset: int, length: int, leaf: int) -> dict:
    """The PIECE row of one range."""
    leaves, csv, utf8, json_part = [], CsvPart(), Utf8Part(), JsonPart()
    sha, filled, start = hashlib.sha256(), 0, b""
    for data in chunks(f, offset, length):
        view = memoryview(data)
        while len(view):
            n = min(leaf - filled, len(view))
            sha.update(view[:n])
            filled, view = filled + n, view[n:]
            if filled == leaf:
                leaves.append(sha.hexdigest())
                sha, filled = hashlib.sha256(), 0
        if fmt in (".csv", ".json"):
            utf8.add(data)
        if fmt == ".csv":
            csv.add(data)
        if fmt == ".json":
            json_part = json_part.then(JsonPart.of(data))
        if part == 0 and len(start) < HEADER_BYTES:
            start += data[:HEADER_BYTES - len(start)]
    if filled or (part == 0 and not size):
        leaves.append(sha.hexdigest())
    row = {"uri": uri, "part": part, "offset": offset, "length": length, "leaves": leaves, "odd": csv.odd, "broken": csv.broken, "head": utf8.head,
           "tail": utf8.tail, "valid": utf8.ok, "whole": len(utf8.head) == utf8.size, "json_end": json_part.end, "json_depth": json_part.depth,
           "json_low": json_part.low, "header": None, "kind": None, "row_tag": None, "problem": None, "problem_at": None}
    if part == 0 and fmt == ".csv":
        if length < min(size, HEADER_BYTES):            # ranges shorter than a header: read on
            start = b"".join(chunks(f, 0, min(size, HEADER_BYTES)))
        row["header"] = header_of(start) if size > len(start) or b"\n" in start else start.removeprefix(b"\xef\xbb\xbf")
    elif part == 0 and fmt == ".json":
        if length < min(size, HEADER_BYTES):
            start = b"".join(chunks(f, 0, min(size, HEADER_BYTES)))
        row["kind"] = json_kind(start)
        text = start.removeprefix(b"\xef\xbb\xbf")
        row["header"] = start[:len(start) - len(text.lstrip(WHITE))]        # what stands before the value
    elif part == 0 and fmt == ".xml":
        row["row_tag"], row["problem"], row["problem_at"] = walk_xml(f, size)
    elif part == 0 and fmt == ".xlsx":
        f.seek(0)
        row["problem"] = walk_workbook(f)
    return row


def json_kind(start: bytes) -> str:
    """``array`` (one array of records), ``lines`` (its first line with text is a whole object) or ``value``."""
    text = start.removeprefix(b"\xef\xbb\xbf").lstrip(WHITE)
    if text.startswith(b"["):
        return "array"
    line = text.split(b"\n", 1)[0].strip()
    return "lines" if line.startswith(b"{") and line.endswith(b"}") else "value"


def fold(uri: str, pieces: list[dict]) -> dict:
    """The SCAN row of a file from its ranges in order."""
    leaves = [x for p in pieces for x in p["leaves"]]
    first = pieces[0]
    utf8, carry = True, codecs.getincrementaldecoder("utf-8")()
    odd, spans, state, depth, low, splits = 0, False, OUTSIDE, 0, 0, []
    for p in pieces:
        splits.append((p["offset"], p["length"], odd if first["kind"] is None else state, depth))
        try:
            carry.decode(p["head"])
            if not p["whole"]:
                utf8 = utf8 and p["valid"] and not carry.getstate()[0]
                carry = codecs.getincrementaldecoder("utf-8")()
                carry.decode(p["tail"])
        except UnicodeDecodeError:
            utf8 = False
        spans, odd = spans or p["broken"][odd], (odd + p["odd"]) % 2
        low = min(low, depth + p["json_low"][state])
        depth, state = depth + p["json_depth"][state], p["json_end"][state]
    utf8 = utf8 and not carry.getstate()[0]
    problem, at = first["problem"], first["problem_at"]
    if first["kind"] is not None:
        if not utf8:
            problem = "JSON: not UTF-8"
        elif first["kind"] != "lines" and (state != OUTSIDE or depth or low < 0):
            problem = "JSON: string left open" if state != OUTSIDE else "JSON: brackets don't match"
    return {"uri": uri, "checksum": leaves[0] if len(leaves) == 1 else hashlib.sha256("".join(leaves).encode()).hexdigest(), "utf8": utf8,
            "header": first["header"], "spans_lines": spans, "kind": first["kind"], "row_tag": first["row_tag"], "decodable": problem is None,
            "problem": problem, "problem_at": at, "splits": [dict(zip(("offset", "length", "state", "depth"), s)) for s in splits]}


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def ranges(files: DataFrame, range_bytes: int) -> DataFrame:
    """(uri, format, size_bytes, part, offset, length), dealt out so that a task has about one range,
    or many small ones."""
    spark = files.sparkSession
    last = F.greatest(F.ceil(F.col("size_bytes") / range_bytes) - 1, F.lit(0))
    parts = files.select("uri", "format", "size_bytes", F.explode(F.sequence(F.lit(0), last)).alias("part")).withColumns(
        {"offset": F.col("part") * range_bytes}).withColumn("length", F.least(F.lit(range_bytes), F.col("size_bytes") - F.col("offset")))
    total = files.agg(F.sum("size_bytes").alias("bytes"), F.count("*").alias("n")).first()     # two scalars
    return parts.repartition(_tasks(spark, total["bytes"], total["n"], range_bytes), "uri", "part")


def _tasks(spark: SparkSession, size: int | None, n: int, range_bytes: int) -> int:
    """Tasks for ``n`` files or ranges of ``size`` bytes in all: one a range, but LEAF bytes each at least."""
    return int(min(100_000, max((size or 0) // max(range_bytes, LEAF), min(n, 2 * spark.sparkContext.defaultParallelism), 1)))


def scan(files: DataFrame, range_bytes: int = RANGE, leaf: int = LEAF) -> DataFrame:
    """SCAN rows of files (uri, format, size_bytes). ``range_bytes`` is rounded up to whole leaves
    for the fingerprint's sake."""
    range_bytes = -(-range_bytes // leaf) * leaf
    schema = arrow_schema(PIECE)
    some = files.select("uri").first()
    if some is None:
        return files.sparkSession.createDataFrame([], SCAN)
    by_position = can_open(some["uri"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        for batch in batches:
            for r in batch.to_pylist():
                f = opened(r["uri"]) if by_position else io.BytesIO(r["content"])
                try:
                    row = scan_range(f, r["uri"], r["format"], r["size_bytes"], r["part"], r["offset"], r["length"], leaf)
                finally:
                    f.close()
                yield pa.RecordBatch.from_pylist([row], schema)

    if by_position:
        todo = ranges(files, range_bytes)
    else:
        todo = whole_files(files).withColumns({"part": F.lit(0).cast("long"), "offset": F.lit(0).cast("long"), "length": F.col("size_bytes")})
    pieces = todo.mapInArrow(run, PIECE)
    names = [x.name for x in schema if x.name != "uri"]
    per_file = pieces.groupBy("uri").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("pieces"))    # a row per range: RANGE bytes each
    out = arrow_schema(SCAN)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([fold(r["uri"], r["pieces"]) for r in batch.to_pylist()], out)

    return per_file.mapInArrow(folded, SCAN)


def whole_files(files: DataFrame) -> DataFrame:
    """The files with their bytes, by Spark's reader, for stores that can't be read by position."""
    spark = files.sparkSession
    paths = [r["uri"] for r in files.select("uri").collect()]       # file names
    content = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("uri"), "content")
    return files.join(content, "uri")


# -- records of a range --------------------------------------------------------------------
def csv_record_bytes(f, size: int, offset: int, length: int, inside: int) -> Iterator[tuple[int, bytes]]:
    """(first byte, bytes) of the records that begin behind a line break of this range (or at the file's start)."""
    end, odd, at = offset + length, inside, offset
    open_at, held = (0, []) if offset == 0 else (None, [])
    for data in chunks(f, offset, size - offset, length):
        array = np.frombuffer(data, np.uint8)
        quotes, breaks = np.flatnonzero(array == 0x22), np.flatnonzero(array == 0x0A)
        breaks = breaks[(np.searchsorted(quotes, breaks) + odd) % 2 == 0]
        done = 0
        for b in breaks.tolist():
            if open_at is not None:
                held.append(data[done:b])
                yield open_at, b"".join(held)
            if at + b >= end:           # the next record belongs to the next range
                return
            open_at, held, done = at + b + 1, [], b + 1
        if open_at is not None:
            held.append(data[done:])
        odd, at = (odd + len(quotes)) % 2, at + len(data)
        if open_at is None and at >= end:
            return
    if open_at is not None and open_at < size:
        yield open_at, b"".join(held)


def json_element_bytes(f, size: int, offset: int, length: int, state: int, depth: int, begin: int) -> Iterator[tuple[int, bytes, bool]]:
    """(first byte, bytes, closed) of the elements of a one-array file whose ``[`` or ``,`` lies in this
    range; ``begin`` is the place of the file's first ``[``. What stands outside the array comes as an
    element that isn't closed."""
    end, at = offset + length, offset
    open_at, held, first = None, [], False
    for data in chunks(f, offset, size - offset, length):
        array = np.frombuffer(data, np.uint8)
        plain, leading = unescaped_quotes(array)
        quotes = plain if state != ESCAPED or leading < 0 else np.setxor1d(plain, [leading])
        inside = state != OUTSIDE
        marks = np.flatnonzero((array == 0x5B) | (array == 0x7B) | (array == 0x5D) | (array == 0x7D) | (array == 0x2C))
        marks = marks[(np.searchsorted(quotes, marks) + inside) % 2 == 0]
        kind = array[marks]
        step = np.where((kind == 0x5B) | (kind == 0x7B), 1, np.where(kind == 0x2C, 0, -1))
        after = depth + np.cumsum(step)
        # opens: '[' from 0 to 1; closes: ']' from 1 to 0; separates: ',' at 1
        here = np.flatnonzero(((step == 1) & (after == 1)) | ((step == -1) & (after == 0)) | ((step == 0) & (after == 1)))
        done, outside_from = 0, 0 if depth == 0 else None
        for p, s in zip(marks[here].tolist(), step[here].tolist()):
            if s == 1:
                between = data[outside_from or 0:p].strip(WHITE) if outside_from is not None else b""
                if outside_from == 0 and at == 0:
                    between = between.removeprefix(b"\xef\xbb\xbf")
                if between and at + p < end:
                    yield at + (outside_from or 0), between, False
                if at + p != begin and at + p < end:        # a second value
                    yield at + p, b"[", False
                outside_from = None
            elif open_at is not None:
                held.append(data[done:p])
                text = b"".join(held)
                if text.strip(WHITE) or not (first and s == -1):
                    yield open_at, text, True
            open_at, held = None, []
            if s == -1:
                outside_from = p + 1
            if at + p >= end:
                return
            if s != -1:
                open_at, done, first = at + p + 1, p + 1, s == 1
        if open_at is not None:
            held.append(data[done:])
        if outside_from is not None:
            rest = data[outside_from:max(0, min(len(data), end - at))].strip(WHITE)
            if rest and not (at == 0 and outside_from == 0 and rest == b"\xef\xbb\xbf"):
                yield at + outside_from, rest, False
        depth = int(after[-1]) if len(after) else depth
        tail = len(data) - len(data.rstrip(b"\\"))
        ends_inside = (len(quotes) + inside) % 2 == 1
        tail -= state == ESCAPED and tail == len(data)
        state, at = ((ESCAPED if tail % 2 else INSIDE) if ends_inside else OUTSIDE), at + len(data)
        if open_at is None and at >= end:
            return
    if open_at is not None:
        yield open_at, b"".join(held), False


RECORD = "uri string, at long, record string, closed boolean"


def _records(splits: DataFrame, cut) -> DataFrame:
    schema = arrow_schema(RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with opened(r["uri"]) as f:
                    rows, held = [], 0
                    for at, data, closed in cut(f, r):
                        rows.append({"uri": r["uri"], "at": at, "record": data.decode("utf-8" if r["utf8"] else "latin-1", "replace"), "closed": closed})
                        held += len(data) + 64
                        if held > CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    return splits.mapInArrow(run, RECORD)


def _splits(scanned: DataFrame) -> DataFrame:
    """A row per range of scanned files (uri, size_bytes, utf8, splits), dealt out so that a task has about
    one range, or many small ones."""
    rows = scanned.select("uri", "size_bytes", "utf8", F.coalesce(F.octet_length("header"), F.lit(0)).alias("begin"),
                          F.explode("splits").alias("s")).select("uri", "size_bytes", "utf8", "begin", "s.*")
    total = rows.agg(F.sum("length").alias("bytes"), F.max("length").alias("longest"), F.count("*").alias("n")).first()     # three scalars
    tasks = _tasks(scanned.sparkSession, total["bytes"], total["n"], total["longest"] or 1)
    return rows.repartition(tasks, "uri", "offset")      # a given number is not coalesced


def csv_records(scanned: DataFrame) -> DataFrame:
    """RECORD rows of CSV files, header included, each range cut by its own task."""
    def cut(f, r):
        for at, data in csv_record_bytes(f, r["size_bytes"], r["offset"], r["length"], r["state"]):
            data = (data.removeprefix(b"\xef\xbb\xbf") if at == 0 else data).removesuffix(b"\r")
            yield at, data, True

    return _records(_splits(scanned), cut)


def json_elements(scanned: DataFrame) -> DataFrame:
    """RECORD rows of one-array JSON files: every element of the array as text."""
    def cut(f, r):
        return json_element_bytes(f, r["size_bytes"], r["offset"], r["length"], r["state"], r["depth"], r["begin"])

    return _records(_splits(scanned), cut)


def json_problems(scanned: DataFrame, spark: SparkSession) -> DataFrame:
    """(uri, problem_at) of one-array files with an element that is no JSON, or text outside the array."""
    bad = json_elements(scanned).filter(~F.col("closed") | F.try_parse_json("record").isNull())
    return bad.groupBy("uri").agg(F.min("at").alias("problem_at"))
