"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a cluster session should carry.  Nothing in the package depends on
# them for right results; they only steer the physical plan.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # building wide plans: do not look up the call site of every expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # archives and vectors travel to Python workers: bound a batch by bytes too
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def builder(app_name: str = "tidewire") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app_name)
    for key, value in CLUSTER_CONF.items():
        b = b.config(key, value)
    return b


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    ``spark.checkpoint.dir`` decides.  Where it is unset a session on one machine
    (tests) gets a temporary folder, chosen once and remembered in the session;
    on a cluster that is an error, since each executor would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not named:
        master = spark.sparkContext.master
        if master.startswith("local-cluster") or not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="tidewire-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/tidewire/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside drop their shuffle files as they end; else these stay until the driver
    happens to collect its garbage.

    For steps that store what they make: a DataFrame run inside and run again shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def hadoop_path(spark: SparkSession, path: str):
    """The path with its file system, so that any storage Spark reads works."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.delete(p, True)
