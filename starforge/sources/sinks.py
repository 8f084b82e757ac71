"""Parquet sinks S14, S18, S19 and a small versioned table store.

Tables are directories of Snappy Parquet. A table that is read and rewritten
in the same job (mapping memory, full reloads) is written as a new version
and readers take the last committed one, so nothing is
ever overwritten while it is being read.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str = "append") -> None:
    """Silver layout domain=/entity=/year=/month=; dynamic overwrite for reprocessing."""
    (df.write.mode(mode).option("compression", "snappy")
     .partitionBy(*partition_cols).parquet(path))


def check_unique(df: DataFrame, keys: list[str]) -> None:
    """S18 constraint: PK / unique index as a pre-write check."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"duplicate values for key {keys}")


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class Conflict(RuntimeError):
    """Another writer committed first."""


class TableStore:
    """Versioned Parquet tables under one (shared) root folder.

    A version is a folder written under a name of its own and then committed: the file
    ``<name>/_commits/<number>``, which names the folder, is created exclusively. Of two writers of one
    number one succeeds; nothing it wrote is ever overwritten. ``update`` computes a table from its last
    version and, if another writer was faster, computes it again from that one's. (Creation is exclusive
    where the file system makes it so: HDFS and local folders do; on an object store, updates of
    one table belong in one job.)"""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _versions(self, name: str) -> list[int]:
        fs, p = _hadoop_fs(self.spark, f"{self.root}/{name}/_commits")
        if not fs.exists(p):
            return []
        found = (st.getPath().getName() for st in fs.listStatus(p) if st.getLen() > 0)     # an empty one is being written, or was given up
        return sorted(int(n) for n in found if n.isdigit())

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def version(self, name: str) -> int:
        """The number of the last version; 0 without one."""
        return (self._versions(name) or [0])[-1]

    def path(self, name: str, version: int | None = None) -> str:
        fs, p = _hadoop_fs(self.spark, f"{self.root}/{name}/_commits/{self.version(name) if version is None else version}")
        stream = fs.open(p)
        try:
            folder = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return f"{self.root}/{name}/{folder}"

    def read(self, name: str, version: int | None = None) -> DataFrame | None:
        vs = self._versions(name)
        return self.spark.read.parquet(self.path(name, vs[-1] if version is None else version)) if vs else None

    def _commit(self, name: str, number: int, folder: str) -> None:
        fs, p = _hadoop_fs(self.spark, f"{self.root}/{name}/_commits/{number}")
        try:
            out = fs.create(p, False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception):
                raise Conflict(f"{name}: version {number} was committed by another writer") from None
            raise
        out.write(bytearray(folder.encode()))
        out.close()

    def replace(self, name: str, df: DataFrame, sort_within: list[str] | None = None,
                partition_by: list[str] | None = None, based_on: int | None = None) -> str:
        """Write a new version (readers of the old one are unaffected). ``based_on``: the version
        ``df`` was computed from; Conflict if it is no longer the last one."""
        folder = f"{uuid.uuid4().hex}/v={(self.version(name) if based_on is None else based_on) + 1}"
        out = df.sortWithinPartitions(*sort_within) if sort_within else df
        w = out.write.option("compression", "snappy").option("partitionOverwriteMode", "static")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.root}/{name}/{folder}")
        if based_on is not None:
            self._commit(name, based_on + 1, folder)
        else:
            while True:
                try:
                    self._commit(name, self.version(name) + 1, folder)
                    break
                except Conflict:
                    continue
        return f"{self.root}/{name}/{folder}"

    def update(self, name: str, change, tries: int = 10) -> str:
        """``change(last version or None)`` as the next version, computed again whenever another
        writer has committed in between."""
        for _ in range(tries):
            version = self.version(name)
            try:
                return self.replace(name, change(self.read(name, version) if version else None), based_on=version)
            except Conflict:
                continue
        raise Conflict(f"{name}: {tries} times another writer was faster")

    def append(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Append to the current version (no read-then-overwrite)."""
        if not self.exists(name):
            return self.replace(name, df, partition_by=partition_by)
        path = self.path(name)
        df.write.mode("append").option("compression", "snappy").parquet(path, partitionBy=partition_by)
        return path

    def by_kind(self) -> dict[str, list[str]]:
        """The stored star's tables by kind, read from the store itself."""
        names = self.names()
        prefixes = {"dim": "dim_", "fact": "fact_", "cuboid": "cuboids_"}
        return {kind: [n for n in names if n.startswith(p) and self.exists(n)] for kind, p in prefixes.items()}

    def names(self) -> list[str]:
        fs, p = _hadoop_fs(self.spark, self.root)
        if not fs.exists(p):
            return []
        return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())
