"""What the training-data operators share: shared folders, worker paths, safe columns."""

from __future__ import annotations

import ctypes
import gc
import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.storage import new_path, shared_folder

T = TypeVar("T")
#: What a Python worker gets at once, at most (a single longer text still comes whole).
BATCH_BYTES, BATCH_ROWS = 16 << 20, 5_000
REPO = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Lets Python workers import this package, and sets a checkpoint folder where none is set.

    A cluster names its shared folder in ``spark.checkpoint.dir``; only when that is unset (tests,
    one machine) a folder of this machine is taken. Bounds the batches that workers get by bytes.
    """
    env = spark.sparkContext.environment
    if REPO not in env.get("PYTHONPATH", ""):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (REPO, env.get("PYTHONPATH", "")) if x)
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        told = int(spark.conf.get(key).rstrip("b"))
        spark.conf.set(key, str(min(told, most) if told > 0 else most))  # 10,000 rows of a long-text table are too much for a worker
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read back: lineage is cut, replicas are the store's."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the tables of ``written`` that df is read from and nothing else reads any longer."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    plain = lambda path: re.sub("^file:/+", "/", path)
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        if os.path.dirname(plain(folder)) == plain(shared_folder(spark)):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


#: What this Python worker holds between tasks: one table, of the operator that ran last.
_held: dict = {}


def held_by_worker(key: tuple, make: Callable[[], T]) -> T:
    """make()'s result, kept for the next task of this worker. A worker serves many operators in turn; what it holds for
    another one is let go first, so that its memory doesn't grow with their number."""
    if key not in _held:
        release_memory()
        _held[key] = make()
    return _held[key]


def release_memory() -> None:
    """Lets go what the worker holds and returns freed memory to the machine."""
    _held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def portions_of(texts: pa.Array, most: int = 8_000_000) -> Iterator[pa.Array]:
    """The texts in order, in slices of about ``most`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield texts.slice(at, to - at)
        at = to


def text_of(col: str) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def crc32_bucket(id_col: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n (null id: as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n
