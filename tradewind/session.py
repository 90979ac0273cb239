"""Session defaults and the shared scratch area jobs may write to."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}

# Scratch tables are written once and read a few times: small, and compressed in the heap.
SCRATCH_CODEC = "zstd"

# Needed whoever made the session: a join splits a crowded key even where that costs a shuffle.
SKEW = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# What one task reads, from files or from a shuffle: its sorts and hash tables hold several times that. With larger
# input there are more tasks, not larger ones.
TASK_INPUT = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}
LEAST_SHUFFLE_PARTS = 200  # before adaptive execution merges thin ones; with more, a map task holds its rows to sort them by part


# A reader of Parquet holds this many rows at once, 4096 by itself: of vectors of thousands of numbers that is the heap.
READER_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
WIDE_READER_ROWS = "64"


# A filtered side of a join of at most so many bytes becomes a Bloom filter of the other side, if that reads so many at least.
KEY_FILTERS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64g",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "16k",
}


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def wide_rows(spark: SparkSession):
    """For reads of rows of many KB that begin and end inside."""
    return _set(spark, {READER_ROWS: WIDE_READER_ROWS})


def key_filters(spark: SparkSession):
    """For joins of a few keys with large tables that begin and end inside."""
    return _set(spark, KEY_FILTERS)


def split_crowded_keys(spark: SparkSession) -> None:
    for key, value in SKEW.items():
        spark.conf.set(key, value)


def bound_tasks(spark: SparkSession) -> None:
    """Tasks of the same size whatever the input, for the readers of large tables."""
    for key, value in TASK_INPUT.items():
        spark.conf.set(key, value)
    parts = max(LEAST_SHUFFLE_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))


def get_spark(app_name: str = "tradewind", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC time and dynamic partition overwrite.

    On a cluster leave ``master`` unset. Locally pass ``local[N]``; the shuffle width then
    follows N instead of the cluster default.
    """
    builder = SparkSession.builder.appName(app_name)
    settings = dict(DEFAULTS)
    if master:
        builder = builder.master(master)
        cores = master.removeprefix("local[").removesuffix("]")
        settings["spark.sql.shuffle.partitions"] = cores if cores.isdigit() else "8"
        settings["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "16g")
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    split_crowded_keys(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder beside its warehouse; a cluster session
    must name a folder every executor can reach.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        session = spark.sparkContext.applicationId
        root = _LOCAL_ROOTS[session] = _LOCAL_ROOTS.get(session) or _local_root(spark)
    return f"{root.rstrip('/')}/tradewind-{spark.sparkContext.applicationId}"


# Of local sessions without the setting, which cannot be changed while they run.
_LOCAL_ROOTS: dict[str, str] = {}


def _local_root(spark: SparkSession) -> str:
    """A folder beside the warehouse of a local session, or its JVM's temporary folder where that cannot be written."""
    jvm = spark._jvm
    for folder in (f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch", jvm.System.getProperty("java.io.tmpdir")):
        place = jvm.org.apache.hadoop.fs.Path(folder)
        try:
            if place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place):
                return folder
        except Py4JJavaError:
            continue
    raise RuntimeError("set spark.checkpoint.dir to a folder that can be written")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared scratch folder and reading it back.

    The written table outlives any executor, keeps column pruning and filter pushdown for its
    readers, and makes a plan that reads it twice compute it once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", SCRATCH_CODEC).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.scratch = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete tables of ``materialise`` whose last reader is done."""
    for df in written:
        remove(df.sparkSession, df.scratch)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours in whatever store holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
