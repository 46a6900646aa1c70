"""ST1: incremental landing of posting/event files with duplicate removal.

Files arriving in ``in_dir`` are read as a stream.  The keys that have
landed are the state of a streaming aggregate in RocksDB: per key the time
of the first and of the last micro-batch that held it, and the row that its
first batch chose.  A key whose first batch is the current one is new and is
written; any other has landed, however long ago, so no event-time bound
discards a late one.  A batch looks its own keys up in the store and reads
nothing of what was landed before.  The state holds a copy of each landed
row on the executors' disks, its checkpoint only what a batch has changed.

Each batch is a folder of its own: one that is run again after a failure
overwrites it, and the stream's checkpoint makes a restart resume with the
next batch.  ``availableNow`` processes what is there and stops.
:func:`compact_landed` merges the folders of earlier batches.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffle_partitions

_FOLDER = re.compile(r"(?:_batch=(\d+)|_merged=(\d+)-(\d+))$")


def land_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema: T.StructType,
                key: str, event_time: str, fmt: str = "json", max_files_per_trigger: int | None = None) -> None:
    """Run the landing over the files that are there.

    A key's row is the latest by event time (ties by the other columns) of
    the first batch that holds the key.  Rows without a key can't be told to
    be repeats: each is a key of its own, and all are landed."""
    s = spark.newSession()     # the state store is a setting of the session
    s.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    s.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    s.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(spark)))
    s.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    reader = s.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(in_dir).withColumn(event_time, F.col(event_time).cast("timestamp"))
    others = [c for c in stream.columns if c not in (key, event_time)]
    order = F.struct(event_time, *others)
    rows = stream.withColumns({"_now": F.current_timestamp(), "_solo": F.when(F.col(key).isNull(), F.expr("uuid()"))})
    seen = rows.groupBy(key, "_solo").agg(
        F.min("_now").alias("_first"), F.max("_now").alias("_last"),
        F.max_by(F.struct(event_time, *others), F.struct(-F.unix_micros("_now"), order)).alias("_row"))

    def land(batch: DataFrame, batch_id: int) -> None:
        new = batch.where("_first = _last").select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in stream.columns])
        new.write.mode("overwrite").parquet(f"{out_dir}/_batch={batch_id}")

    (seen.writeStream.outputMode("update").foreachBatch(land).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def _folders(spark: SparkSession, out_dir: str) -> list[tuple[int, int, str]]:
    """(first batch, last batch, path) of the folders that make up the landed
    table: complete ones, and of several that hold a batch the widest."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    found = []
    for st in fs.listStatus(root):
        m = _FOLDER.search(st.getPath().getName())
        if m and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            lo, hi = (int(m[1]), int(m[1])) if m[1] else (int(m[2]), int(m[3]))
            found.append((lo, hi, st.getPath().toString()))
    out: list[tuple[int, int, str]] = []
    for lo, hi, path in sorted(found, key=lambda f: (f[0], -f[1])):
        if not out or lo > out[-1][1]:
            out.append((lo, hi, path))
    return out


def read_landed(spark: SparkSession, out_dir: str) -> DataFrame:
    """Everything that has landed, from merged and single batches."""
    return spark.read.parquet(*[path for _, _, path in _folders(spark, out_dir)])


def compact_landed(spark: SparkSession, out_dir: str, key: str, row_group_bytes: int = 128 << 20) -> None:
    """Merge all landed folders into one, in files of about a row group, each
    sorted by ``key`` within a range of it and with a Bloom filter on it, for
    readers that look keys up.

    The merged folder counts from the moment it is complete, and readers then
    ignore what it covers; that is deleted afterwards.  A run that is stopped
    leaves either the old folders or both, and the next one goes on.  Run it
    between landings."""
    live = _folders(spark, out_dir)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(out_dir).getFileSystem(conf)
    if len(live) > 1:
        lo, hi = live[0][0], live[-1][1]
        size = sum(fs.getContentSummary(jvm.org.apache.hadoop.fs.Path(p)).getLength() for _, _, p in live)
        n = max(1, -(-size // row_group_bytes))
        rows = read_landed(spark, out_dir).repartitionByRange(n, key).sortWithinPartitions(key)
        (rows.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{key}", "true")
         .parquet(f"{out_dir}/_merged={lo}-{hi}"))
        live = _folders(spark, out_dir)
    keep = {p for _, _, p in live}
    for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(out_dir)):
        m = _FOLDER.search(st.getPath().getName())
        path = st.getPath().toString()
        if m and path not in keep and any(lo <= int(m[1] or m[2]) and int(m[1] or m[3]) <= hi for lo, hi, _ in live):
            fs.delete(st.getPath(), True)
