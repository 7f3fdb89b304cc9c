"""Tables in the folder that driver and executors share: cutting lineage, and replacing a table, or parts of it, safely."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only on one machine, where that is unset, a folder of this machine."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return os.path.join(tempfile.gettempdir(), "folio-checkpoints")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read back."""
    path = new_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


CURRENT = "_CURRENT"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that counts; None before the first one."""
    p, fs = _path(spark, f"{path}/{CURRENT}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        said = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return f"{path}/{said}"


def _point(spark: SparkSession, path: str, said: str, name: str) -> None:
    """Moves the pointer in one step."""
    draft, fs = _path(spark, f"{path}/.{name}")
    out = fs.create(draft)
    out.write(said.encode())
    out.close()
    jvm = spark.sparkContext._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(draft), fs.makeQualified(_path(spark, f"{path}/{CURRENT}")[0]), options)


def swap_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replaces a table: the new version is written whole beside the old one, then a pointer moves in one step.

    A crash before that leaves the old version in force, one after it the new one. The version before the old one goes.
    """
    old = current_version(spark, path)
    name = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    _point(spark, path, name, name)
    fs = _path(spark, path)[1]
    for status in fs.listStatus(_path(spark, path)[0]):
        kept = {name, old and old.rsplit("/", 1)[1]}
        if status.getPath().getName().startswith("v-") and status.getPath().getName() not in kept:
            fs.delete(status.getPath(), True)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The version that counts; an empty table before the first one."""
    at = current_version(spark, path)
    return spark.read.schema(schema).parquet(at) if at else spark.createDataFrame([], schema)


# Tables in buckets by the hash of a key. The pointer names, for every bucket, the version that holds it; a batch writes
# the buckets that it touches and moves the pointer once, for all tables under the path together.

BUCKETS = 64
BUCKET = "_bucket"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, path: str) -> dict | None:
    said = current_version(spark, path)
    return json.loads(said[len(path) + 1 :]) if said else None


def bucket_count(spark: SparkSession, path: str, default: int = BUCKETS) -> int:
    """Fixed when the first batch is written."""
    known = _manifest(spark, path)
    return known["buckets"] if known else default


def touched_buckets(keys: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that hold the keys: a number for each at most."""
    return sorted(r[0] for r in keys.select(bucket_of(F.col(key), buckets)).distinct().collect())


def read_buckets(spark: SparkSession, path: str, schema: str, table: str = "rows", only: list[int] | None = None) -> DataFrame:
    """The rows that count, of all buckets or of some."""
    known = _manifest(spark, path) or {"at": {}}
    found = [f"{path}/{version}/{table}/{BUCKET}={b}" for b, version in known["at"].items() if only is None or int(b) in only]
    fs = _path(spark, path)[1]
    found = [f for f in found if fs.exists(_path(spark, f)[0])]  # a table may have no rows in a bucket
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def replace_buckets(spark: SparkSession, path: str, tables: dict[str, tuple], touched: list[int], buckets: int) -> int:
    """Replaces whole buckets. Tables by name are (rows, key column, columns that a bucket is sorted by); all their rows must
    lie in the touched buckets. Without a key, rows name their bucket themselves.

    A crash before the pointer moves leaves the old rows in force. What neither the new nor the old pointer names goes.
    Returns the number of buckets written.
    """
    if not touched:
        return 0
    old = _manifest(spark, path) or {"buckets": buckets, "at": {}}
    name = f"v-{uuid.uuid4().hex}"
    for table, (rows, key, *order) in tables.items():
        # a large bucket goes to several tasks, and files
        placed = rows.withColumn(BUCKET, bucket_of(F.col(key), buckets)) if key else rows
        placed.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *order).write.partitionBy(BUCKET).parquet(f"{path}/{name}/{table}")
    new = {"buckets": buckets, "at": old["at"] | {str(b): name for b in touched}}
    _point(spark, path, json.dumps(new), name)
    root, fs = _path(spark, path)
    used = {version for known in (old, new) for version in known["at"].values()}
    for status in fs.listStatus(root):
        if status.getPath().getName().startswith("v-") and status.getPath().getName() not in used:
            fs.delete(status.getPath(), True)
    for version in {old["at"][str(b)] for b in touched if str(b) in old["at"]}:  # buckets that only older pointers named
        for table in tables:
            for b in range(buckets):
                if old["at"].get(str(b)) != version and new["at"].get(str(b)) != version:
                    fs.delete(_path(spark, f"{path}/{version}/{table}/{BUCKET}={b}")[0], True)
    return len(touched)


def all_of(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
