"""Spark session helpers.

The session settings that the jobs rely on:

* AQE on, with skew-join splitting and partition coalescing, so hot keys in the
  large left joins are split at run time and small shuffles collapse.
* ``spark.sql.session.timeZone`` UTC: all timestamps are zone-less (``timestamp_ntz``),
  but literals and casts stay repeatable across clusters.
* ``spark.checkpoint.dir`` is read from the session.  Only when it is unset (tests,
  local runs) a fresh scratch folder is created for it.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import SparkSession

DEFAULT_CONF: dict[str, str] = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # plans name the whole path of a scan, however long the scratch folder's is
    "spark.sql.maxMetadataStringLength": "1000",
}


#: How jobs write the tables that they store: zstd's files are smaller than those of Spark's default.
STORED = {"compression": "zstd"}


#: Whether Spark removes the shuffle files of a query once it has run (else when the driver's garbage
#: collector meets its plan, which may be long after a job's last step).
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def frees_shuffles(job: Callable) -> Callable:
    """A job of several steps (session first) whose steps each leave no shuffle files on the disks: what
    a step stored is read from there by the next.  Plans that it returns unrun keep theirs."""

    @wraps(job)
    def run(spark: SparkSession, *args, **named):
        before = spark.conf.get(FREE_SHUFFLES)
        spark.conf.set(FREE_SHUFFLES, "true")
        try:
            return job(spark, *args, **named)
        finally:
            spark.conf.set(FREE_SHUFFLES, before)

    return run


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "slicewright",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local"):
        ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.  Where it is unset, a scratch folder stands in
    on a local master (tests, local runs); on a cluster that is an error, as each executor
    would write to a disk of its own."""
    d = checkpoint_dir(spark)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="slicewright-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])
