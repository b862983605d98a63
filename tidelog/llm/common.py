"""Shared plumbing of the text operators: sessions, shared folders, bounded batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes of one Arrow batch sent to a Python worker.
BATCH_ROWS, BATCH_BYTES = 256, 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches and make sure that a shared checkpoint folder is set.

    On a cluster the folder comes from ``spark.checkpoint.dir`` and must be set; in local mode,
    as in tests, one is made where it is unset.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        if not shared and not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(shared or tempfile.mkdtemp(prefix="tidelog-"))
    return spark


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    prepare(spark)
    root = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{root}/{what}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, what: str) -> DataFrame:
    """df written once to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_saved(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files behind a frame made by ``saved`` that is no longer needed."""
    jvm = spark.sparkContext._jvm
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete saved frames that are no longer needed."""
    for df in frames:
        drop_saved(spark, df)


def tidy(spark: SparkSession) -> None:
    """Let the driver drop the shuffle files of what no frame refers to any more; else they stay until it happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow that gives freed memory back to the system when a task ends, since idle workers stay beside the next stage."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library
