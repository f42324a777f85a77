"""Helpers shared by the operators of this package."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts name it: blank and the five controls from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows in an Arrow batch: bounds what a Python worker holds when texts are long.
ROWS_PER_BATCH = 500

_written: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one where it is unset and all runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith(("local[", "local ")) and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="codelake-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, known to :func:`release`."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it: cuts the lineage, survives lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the tables that operators of this session have stored; call it when their results are written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in map(jvm.org.apache.hadoop.fs.Path, paths):
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """Apply ``function`` to Arrow batches of at most ``ROWS_PER_BATCH`` rows; it yields columns by name.

    The session's ``spark.sql.execution.arrow.maxRecordsPerBatch`` is lowered to that many rows.
    """
    few_rows(df.sparkSession)
    names = [f.split()[0] for f in schema.split(",")]
    kinds = None

    def run(batches):
        nonlocal kinds
        if kinds is None:
            kinds = arrow_types(schema)
        for batch in batches:
            for columns in function(batch):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, kind, from_pandas=False)
                     for c, kind in zip((columns[n] for n in names), kinds, strict=True)], names)

    return df.mapInArrow(run, schema)


ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(),
    "binary": pa.binary(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32()),
}


def arrow_types(schema: str) -> list[pa.DataType]:
    return [ARROW[f.split()[1]] for f in schema.split(",")]


def few_rows(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def share_of(key: Column, parts: int) -> Column:
    """crc32 of a key as text, modulo ``parts``; 0 for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % parts, F.lit(0))


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def spread_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a scan over at least as many tasks as there are cores, when it has fewer."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def segments(sizes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of consecutive runs with the given sizes."""
    ends = np.cumsum(np.asarray(sizes, dtype=np.int64))
    return ends - sizes, ends
