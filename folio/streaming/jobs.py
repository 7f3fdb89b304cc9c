"""Incremental jobs as Structured Streaming: re-indexing by content, upsert logs, resumable work and a base that only advances."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators import discovery
from folio.storage import bucket_count, cut, read_buckets, replace_buckets, touched_buckets


def upsert_log(records: DataFrame, path: str, checkpoint: str, key: str, order: str, scalars: list[str], listed: str):
    """A stream of log records merged into one row per key: the last non-empty scalars, the lists in order of arrival.

    Every value keeps the order of its record, list elements their place in it too, so a batch seen again after a failure
    changes nothing, and repeated elements stay. A batch reads and writes the buckets of its keys only.
    """
    spark = records.sparkSession
    schema = log_schema(key, scalars, listed)

    def merge(batch: DataFrame, _: int) -> None:
        have = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
        o = F.col(order).cast("long")
        elements = F.transform(F.coalesce(F.col(listed), F.expr("cast(array() as array<string>)")), lambda v, k: F.struct(o.alias("o"), k.alias("p"), v.alias("v")))
        new = batch.select(key, *[F.when(have(c), F.struct(o.alias("o"), F.col(c).cast("string").alias("v"))).alias(c) for c in scalars], elements.alias(listed))
        buckets = bucket_count(spark, path)
        touched = touched_buckets(new, key, buckets)
        both = read_buckets(spark, path, schema, only=touched).unionByName(new.select(F.col(key).cast("long").alias(key), *scalars, listed))
        merged = both.groupBy(key).agg(*[F.max(c).alias(c) for c in scalars], F.array_sort(F.array_distinct(F.flatten(F.collect_list(listed)))).alias(listed))
        replace_buckets(spark, path, {"rows": (merged, key)}, touched, buckets)

    return records.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def log_schema(key: str, scalars: list[str], listed: str) -> str:
    return ", ".join([f"{key} long", *[f"{c} struct<o:long,v:string>" for c in scalars], f"{listed} array<struct<o:long,p:int,v:string>>"])


def log_rows(spark: SparkSession, path: str, key: str, scalars: list[str], listed: str) -> DataFrame:
    """The merged log as plain columns."""
    return read_buckets(spark, path, log_schema(key, scalars, listed)).select(key, *[F.col(f"{c}.v").alias(c) for c in scalars], F.transform(listed, lambda x: x.v).alias(listed))


INDEXED = "path string, sha256 string, batch long"


def index_changes(documents: DataFrame, path: str, checkpoint: str, order: str | None = None):
    """A stream of (path, sha256) kept as the newest state per path; unchanged documents are not written again.

    Of several rows of a path in a batch the last by ``order`` counts, else the one with the largest digest. Only buckets
    that hold a changed document are written.
    """
    spark = documents.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        buckets = bucket_count(spark, path)
        last = batch.groupBy("path").agg(F.max_by("sha256", F.struct(*([order] if order else []), "sha256")).alias("sha256"))
        known = read_buckets(spark, path, INDEXED, only=touched_buckets(last, "path", buckets))
        new = cut(last.join(known.select("path", "sha256"), ["path", "sha256"], "left_anti").withColumn("batch", F.lit(number).cast("long")))
        touched = touched_buckets(new, "path", buckets)
        kept = read_buckets(spark, path, INDEXED, only=touched).join(new.select("path"), "path", "left_anti")
        replace_buckets(spark, path, {"rows": (kept.unionByName(new), "path")}, touched, buckets)

    return documents.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def todo(manifest: DataFrame, state: DataFrame, key: str = "id") -> DataFrame:
    """Entries of a manifest that are not complete yet; an entry with an error is tried again."""
    done = state.where("complete and error is null").select(key)
    return manifest.join(done, key, "left_anti")


def tool_calls(deltas: DataFrame) -> DataFrame:
    """(conv, index, name, arguments): pieces of streamed calls put together: the last name, all arguments in order."""
    g = deltas.groupBy("conv", "index").agg(F.max_by("name", F.when(F.coalesce("name", F.lit("")) != "", F.col("seq"))).alias("name"), F.array_sort(F.collect_list(F.struct("seq", F.coalesce("arguments", F.lit("")).alias("a")))).alias("p"))
    return g.select("conv", "index", "name", F.array_join(F.transform("p", lambda x: x.a), "").alias("arguments"))


merge_log = discovery.merge_log
