"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from worklake.session import ensure_checkpoint_dir, stage

__all__ = ["ensure_checkpoint_dir", "folder", "fresh", "give_back", "read_table", "release", "small_batches", "stage", "text_or_empty", "tree_sum"]

#: Python source of the white space that separates words: space and 0x09-0x0D.
#: ``bytes.split()`` splits at exactly these bytes.
WORD_SPACE = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


#: Rows of a batch between Spark and Python: long texts, and arrays made of them, stay a few MB.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the session's Arrow batches by ``BATCH_ROWS`` (a smaller bound stays); returns ``df``."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of steps that are over.

    They go when the driver collects its garbage, which a job of many steps
    would otherwise reach only after all of them lie on disk.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return memory that a reused Python worker has freed, but still holds from earlier steps, to the system."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries have no such call
        pass


def fresh(name: str, df: DataFrame) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def tree_sum(df: DataFrame, column: str, fan_in: int = 24) -> "object":
    """Sum equal-length float64 vectors held as binary rows, one per partition.

    Rows are first summed in groups on the executors, so that the driver gets
    at most ``fan_in`` vectors however many partitions there are. Returns a
    numpy array, or None without rows.
    """
    import numpy as np
    import pandas as pd

    def add(batches):
        total = None
        for batch in batches:
            for raw in batch[column]:
                v = np.frombuffer(raw, dtype="<f8")
                total = v.copy() if total is None else total + v
        if total is not None:
            yield pd.DataFrame({column: [total.tobytes()]})

    parts = df.select(column).repartition(fan_in).mapInPandas(add, f"{column} binary").collect()
    if not parts:
        return None
    return sum(np.frombuffer(bytes(r[0]), dtype="<f8") for r in parts)
