"""Spark session helpers.

The library never creates its own cluster settings beyond what a job needs for
deterministic results (UTC session time zone, string partition values).  On a
cluster the checkpoint directory comes from ``spark.checkpoint.dir``; a local
temporary folder is only used when that setting is unset and the master is
local (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every starforge job relies on for correct results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # year=unknown / month=00 partition values must stay strings
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Settings that matter for throughput at scale (runtime re-planning, skew).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "starforge",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**REQUIRED_CONF, **SCALE_CONF, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, read from ``spark.checkpoint.dir``.

    Only when the setting is unset *and* the master is local do we pick a
    scratch folder of our own; on a cluster an unset value is an error because
    a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="starforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
