"""Session helpers: a tuned builder and the shared folder for lineage cuts and outputs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app: str = "prefpairs",
    driver_memory: str | None = None,
) -> SparkSession:
    """Session with the settings this package relies on (UI off, AQE on, UTC).

    ``driver_memory`` matters in local mode only, where the driver runs the tasks.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Plans here are built from many small column expressions; capturing the Python
        # call site for each one costs ~10 driver round trips per call. Errors still
        # carry the Spark-side context.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # JSON objects with a repeated key keep the last value, as Python's json.loads
        # does (the audit then agrees with the original on such lines).
        "spark.sql.variant.allowDuplicateKeys": "true",
    }
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Only when it is unset and the master is local (tests, laptops) is a local folder
    created and registered; on a cluster an unset value is an error, since a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    d = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        d = tempfile.mkdtemp(prefix="prefpairs-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def listing_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` in which folders are listed by a few tasks a slot.

    A table of many small folders is otherwise listed by a task each (up to 10,000), which takes
    the scheduler longer than the listing.
    """
    listing = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            listing.conf.set(key, value)
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    listing.conf.set(setting, str(min(int(spark.conf.get(setting)), 4 * spark.sparkContext.defaultParallelism)))
    return listing


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared folder for one output."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
