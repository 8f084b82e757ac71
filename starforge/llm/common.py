"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.session import ensure_checkpoint_dir, shuffle_partitions

#: Separator tables for ``bytes.translate``: everything that is not part of a word becomes a space.
#: Words of the contamination rule: digits, a-z and every byte of a non-ASCII character.
ALNUM_TO_SPACE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/starforge-llm-{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and
    what later jobs read survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class BlockTable:
    """Rows with a ``text`` column in blocks of about ``block_bytes``, kept in a table that is
    bucketed by block below the shared folder. A row is named by (block, pos); what later jobs
    find out about rows comes back to them by block, and the texts are never shuffled."""

    def __init__(self, rows: DataFrame, block_bytes: int = 8 << 20):
        self.spark, self.name = rows.sparkSession, f"starforge_texts_{uuid.uuid4().hex}"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            block, pos, size = TaskContext.get().partitionId() << 32, 0, 0
            for batch in split_batches(batches):
                n = int(pa.compute.sum(pa.compute.binary_length(batch.column("text"))).as_py() or 0)
                if size and size + n > block_bytes:
                    block, pos, size = block + 1, 0, 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, block)), pa.array(np.arange(pos, pos + batch.num_rows, dtype=np.int32)), *batch.columns],
                    ["block", "pos", *batch.schema.names])
                pos, size = pos + batch.num_rows, size + n

        schema = ", ".join(["block long", "pos int", *(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)])
        buckets = min(50_000, max(shuffle_partitions(self.spark), 2 * rows.rdd.getNumPartitions()))
        rows.mapInArrow(run, schema).write.option("compression", "zstd").bucketBy(buckets, "block") \
            .option("path", scratch_path(self.spark, self.name)).saveAsTable(self.name)

    @property
    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def beside(self, found: DataFrame):
        """Each block's rows beside what was found for them (``found`` has block and pos)."""
        return self.rows.groupBy("block").cogroup(found.groupBy("block"))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.name}")


def ordered(table: pa.Table) -> pa.RecordBatch:
    """A block's rows by pos, as one batch."""
    return table.sort_by("pos").combine_chunks().to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], table.schema)


def parts(batch: pa.RecordBatch, column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most ``limit`` bytes of ``column`` (one row at least)."""
    offsets = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = offsets[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(offsets, base + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def split_batches(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from parts(batch, column, limit)


def release() -> None:
    """Gives memory that this worker no longer uses back to the system; workers live on between stages,
    and what each has once held would otherwise count against its executor for good."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc
    if trim is not None:
        trim(0)


def released(run):
    """For ``mapInArrow``: ``run``, giving unused memory back after every few batches and at the end."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, out in enumerate(run(batches)):
            yield out
            if k % 8 == 7:
                release()
        release()

    return lean


def lean(run):
    """For ``applyInArrow``: ``run`` on a group, giving unused memory back behind it."""

    def one(table: pa.Table) -> pa.Table:
        out = run(table)
        release()
        return out

    return one


def lean_pair(run):
    """The same for cogroups."""

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        release()
        return out

    return two


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of a string column; None for null."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def crc_of_id(doc_id) -> int:
    """crc32 of an id as text; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def crc_column(column: str = "doc_id"):
    """The same as a column (see :func:`crc_of_id`)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def per_text(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Only the columns an operator reads, under their plain names."""
    return df.select(*keep, F.col(text).cast("string").alias("text"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (Stafford's variant 13), vectorised."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
