"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every plan of this package relies on. All of them can be
# set on an already running session.
SQL_SETTINGS = {
    # source timestamps carry no zone; recency is measured from midnight UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot order or customer is split at run time, even where the split costs
    # one more exchange before the aggregation above the join
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; a cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("buyerlens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; a private one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="buyerlens-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def scratch_path(spark: SparkSession) -> str:
    """A new folder next to the checkpoints, reachable by every executor."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}"


def _store(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder in whatever store its path names; whether there was one."""
    store, target = _store(spark, path)
    return store.delete(target, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file within one store; the folder of the target is made where it is absent."""
    store, old = _store(spark, source)
    new = _store(spark, target)[1]
    store.mkdirs(new.getParent())
    if not store.rename(old, new):
        raise OSError(f"{source} was not renamed to {target}")


def listed(spark: SparkSession, folder: str) -> list[tuple[str, int]] | None:
    """Names and times (milliseconds) in one folder of whatever store its path names; None if it is absent."""
    store, target = _store(spark, folder)
    if not store.exists(target):
        return None
    return [(entry.getPath().getName(), entry.getModificationTime()) for entry in store.listStatus(target)]


def file_names(spark: SparkSession, folder: str) -> list[str] | None:
    found = listed(spark, folder)
    return None if found is None else [name for name, _ in found]


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, compressed or not; empty if there is none."""
    store, target = _store(spark, path)
    java = spark._jvm.java.io
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(target)
    stream = store.open(target)
    reader = java.BufferedReader(java.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


@contextmanager
def releasing_shuffles(spark: SparkSession):
    """Queries made inside delete their shuffle files as they end; for those that are run once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that later passes neither recompute it nor
    depend on the executors that produced it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
