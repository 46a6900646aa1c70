"""Session construction and the shared scratch location."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, partitions: int | None = None,
                  app: str = "laborlens") -> SparkSession:
    """A session tuned for the analytics here: AQE on (runtime broadcast
    conversion from measured sizes, partition coalescing, skew-join split),
    UI off, UTC.  ``partitions`` sizes the shuffle; on a cluster leave it to
    the cluster defaults and AQE."""
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
        # checkpointed blocks / feature frames are removed once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("LABORLENS_DRIVER_MEMORY", "7g")
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which the driver and
    all executors share.  In local mode, where one machine holds everything,
    a folder of our own serves if none is named; elsewhere that is an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="laborlens-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, with the file
    system that Spark resolves it on."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint_root(spark))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return f"{fs.makeQualified(root).toString().rstrip('/')}/laborlens/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table into the shared folder and read it back:
    several branches of a query then read it instead of re-deriving it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def local_path(p: str) -> str:
    return p[len("file:"):] if p.startswith("file:") else p


__all__ = ["build_session", "checkpoint_root", "scratch_path", "stage", "shuffle_partitions", "local_path"]
