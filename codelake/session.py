"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("codelake")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="codelake-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the checkpoint folder and read it: lineage ends there, and later scans read only
    the columns they need. ``release`` deletes what a session has stored."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/durable-{uuid.uuid4().hex}"
    _stored.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Meanwhile the shuffle files of a query are deleted when it ends, and not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Bytes of input in an Arrow batch whose rows become many Python objects, words and characters.
BATCH_BYTES = 2 << 20


def small_batches() -> None:
    """Lower the session's ``spark.sql.execution.arrow.maxBytesPerBatch``, so that a task's Python holds the objects of few texts."""
    spark, key = SparkSession.getActiveSession(), "spark.sql.execution.arrow.maxBytesPerBatch"
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


_stored: dict[str, list[str]] = {}


def release(spark: SparkSession) -> int:
    """Delete the tables that ``durable`` wrote in this session; for when their results have been written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _stored.pop(spark.sparkContext.applicationId, [])
    for path in map(jvm.org.apache.hadoop.fs.Path, paths):
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def discard(df: DataFrame) -> None:
    """Delete a table that ``durable`` wrote and that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Deal a scan with fewer partitions than cores over all of them; larger scans are left alone."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)


#: Rows of a task that renders, parses or splits each of them.
TASK_ROWS = 200_000


def dealt(scan: DataFrame, key: str, rows: int = TASK_ROWS) -> DataFrame:
    """Deal narrow rows over all cores, and over more tasks the more rows there are: a file's size says little of the work on them."""
    return scan.repartition(max(scan.sparkSession.sparkContext.defaultParallelism, -(-scan.count() // rows)), key)
