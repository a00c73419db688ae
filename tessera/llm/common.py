"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.session import scratch_path, ship_package

# Fixed value of the task: a word is a run of anything but space and \t \n \v \f \r.
# ``bytes.split()`` splits on exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str, sort: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: later readers neither recompute it nor depend on the
    executors that made it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.sortWithinPartitions(sort) if sort else df).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Delete a table made by ``cut`` that no later step reads."""
    path = getattr(df, "_tessera_path", None)
    if path:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


# Bytes of a batch handed to a Python worker, where the session still has Spark's default of 64 MB:
# the batch, its copy in the worker and what is made of it must fit beside the executor's heap.
BATCH_BYTES = 8 << 20
DEFAULT_BATCH_BYTES = "67108864b"


def workers(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, and bound the batches they get."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == DEFAULT_BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


# What an operator's tasks keep in a Python worker for later ones: how to forget it, by operator.
KEPT: dict[str, Callable[[], None]] = {}


def keep_only(owner: str | None) -> None:
    """Forget what other operators than ``owner`` left in this worker."""
    for other in [k for k in KEPT if k != owner]:
        KEPT.pop(other)()


def give_back() -> None:
    """Hand freed memory back to the system: a worker outlives its tasks, and its heap would stay as large
    as in the largest batch it ever had, beside that of the executor."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def tidy(run: Callable, owner: str | None = None) -> Callable:
    """``run`` over the batches of a task, in a worker that holds nothing of other operators and gives back
    at the task's end what it no longer uses; what ``owner`` registered in ``KEPT`` stays."""

    @functools.wraps(run)
    def task(batches):
        keep_only(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
