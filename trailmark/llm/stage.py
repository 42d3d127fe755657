"""Tables written to the cluster's shared folder, which cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import ctypes
import functools
import gc
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where it is unset (tests) a folder of our own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="trailmark-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


#: Bytes of a batch handed to Python: texts may be long, and both sides hold a batch in memory.
BATCH_BYTES = "4m"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def text_batches(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches of BATCH_BYTES unless it sets a size of its own. Frames are lazy, so the setting has to stay."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_BYTES)
    return spark


def give_back() -> None:
    """Freed memory goes back to the system: workers stay for a while after a task, and all of an executor's workers count."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def frugal(task):
    """A function over batches that gives memory back when it ends."""

    @functools.wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/trailmark-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that written() returned, once what was made of it is written itself."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def collect_shuffles(spark: SparkSession) -> None:
    """Ask for shuffle files that no plan needs any more to be deleted now, not when the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_written(spark: SparkSession) -> None:
    """Delete every table this package wrote to the shared folder; results that still read them become invalid."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(top):
        for entry in fs.listStatus(top):
            if entry.getPath().getName().startswith("trailmark-"):
                fs.delete(entry.getPath(), True)
