"""Resumable ingest of a manifest: a state row per entry and step, and per page, kept in buckets.

An entry's kind says which steps it needs. A run takes the steps in order: for each it finds the entries that are due, lets
its worker turn them into results, and writes the results to the state in one move before the next step begins. A run that is
killed between a worker and the state repeats that step and no other; workers must give the same result for the same entry.

Defined results: entries of unknown kind are errors. An entry whose needed step failed stops there and is tried again by the
next run; steps that may fail leave their value and the entry goes on. Of entries that repeat an id the one with the smallest
content counts. A null id is left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators import pages as pg
from folio.storage import BUCKETS, bucket_count, cut, read_buckets, replace_buckets, touched_buckets

#: The steps that each kind takes, in order.
STEPS = ("metadata", "item", "file", "attachment", "text", "note")
KINDS = {
    "arxiv": ("metadata", "item", "file", "text", "note"),
    "pdfurl": ("item", "file", "text", "note"),
    "localpdf": ("item", "file", "text", "note"),
    "web": ("item", "file", "text", "note"),
    "localfile": ("item", "attachment", "text", "note"),
    "meta": ("item",),
}
#: Without these an entry can't go on.
NEEDED = ("metadata", "item", "attachment")
STATE = "id string, step string, ok boolean, value string, error string, tries int"
FAILED_PAGE = "*[OCR FAILED FOR THIS PAGE]*"

Worker = Callable[[DataFrame], DataFrame]


def takes(step: str) -> Column:
    return F.col("kind").isin([k for k, steps in KINDS.items() if step in steps])


def _entries(manifest: DataFrame) -> DataFrame:
    rest = [c for c in manifest.columns if c != "id"]
    first = manifest.where("id is not null").groupBy(F.col("id").cast("string").alias("id")).agg(F.min(F.struct(*rest)).alias("e"))
    return first.select("id", "e.*")


def put(spark: SparkSession, path: str, results: DataFrame, buckets: int = BUCKETS) -> int:
    """Merges results (id, step, ok, value, error) into the state: a success stands, tries count up. Returns buckets written."""
    buckets = bucket_count(spark, path, buckets)
    touched = touched_buckets(results, "id", buckets)
    new = results.groupBy(F.col("id").cast("string").alias("id"), "step").agg(F.max(F.struct("ok", "value", "error")).alias("r"))
    new = new.select("id", "step", F.col("r.ok").alias("new_ok"), F.col("r.value").alias("new_value"), F.col("r.error").alias("new_error"), F.lit(True).alias("met"))
    both = read_buckets(spark, path, STATE, only=touched).join(new, ["id", "step"], "full_outer")
    keep = F.coalesce("ok", F.lit(False)) | F.col("met").isNull()
    pick = lambda name: F.when(keep, F.col(name)).otherwise(F.col(f"new_{name}")).alias(name)
    merged = both.select("id", "step", pick("ok"), pick("value"), pick("error"), (F.coalesce("tries", F.lit(0)) + F.when(F.col("met"), 1).otherwise(0)).alias("tries"))
    return replace_buckets(spark, path, {"rows": (merged, "id")}, touched, buckets)


def due(manifest: DataFrame, state: DataFrame, step: str) -> DataFrame:
    """Entries that take this step now, with what earlier steps gave as a map ``done``."""
    known = state.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("ok"), F.struct("step", "value")))).alias("done"),
        F.coalesce(F.bool_or((F.col("step") == step) & F.col("ok")), F.lit(False)).alias("_over"),
    )
    rows = _entries(manifest).where(takes(step)).join(known, "id", "left").where(~F.coalesce("_over", F.lit(False))).drop("_over")
    done = F.coalesce("done", F.expr("cast(map() as map<string,string>)"))
    for before in STEPS[: STEPS.index(step)]:
        if before in NEEDED:
            rows = rows.where(~takes(before) | F.map_contains_key(done, before))
    return rows.withColumn("done", done)


def advance(spark: SparkSession, path: str, manifest: DataFrame, workers: dict[str, Worker], buckets: int = BUCKETS) -> dict[str, int]:
    """One run over all steps; how many results each gave. A worker takes the due entries and returns (id, ok, value, error)."""
    counts = {}
    unknown = _entries(manifest).where(~F.col("kind").isin(list(KINDS)) | F.col("kind").isNull())
    strange = unknown.select("id", F.lit("item").alias("step"), F.lit(False).alias("ok"), F.lit(None).cast("string").alias("value"), F.concat(F.lit("unknown kind "), F.coalesce("kind", F.lit(""))).alias("error"))
    if not strange.isEmpty():
        put(spark, path, strange, buckets)
    for step in STEPS:
        if step not in workers:
            continue
        results = cut(workers[step](due(manifest, read_buckets(spark, path, STATE), step)).select("id", F.lit(step).alias("step"), "ok", "value", "error"))
        counts[step] = results.count()
        put(spark, path, results, buckets)
    return counts


def summary(manifest: DataFrame, state: DataFrame) -> DataFrame:
    """(id, kind, key, file, md, note, error, complete): how far each entry is. error: of its first step that failed."""
    value = lambda step: F.max(F.when((F.col("step") == step) & F.col("ok"), F.col("value")))
    order = F.array_position(F.array(*map(F.lit, STEPS)), F.col("step"))
    facts = state.groupBy("id").agg(
        value("item").alias("key"), value("file").alias("file"), value("attachment").alias("attachment"), value("text").alias("md"), value("note").alias("note"),
        F.min_by("error", F.when(F.col("error").isNotNull(), order)).alias("error"),
    )
    rows = _entries(manifest).join(facts, "id", "left")
    whole = F.col("key").isNotNull() & ((F.col("kind") == "meta") | (F.col("md").isNotNull() & ((F.col("kind") != "localfile") | (F.col("attachment").isNotNull() & F.col("note").isNotNull()))))
    return rows.select("id", "kind", "key", F.coalesce("file", "attachment").alias("file"), "md", "note", "error", whole.alias("complete"))


#: The shares to which a page is shrunk when it is refused.
SHRINK = (1.0, 0.8, 0.65)


def read_pages(spark: SparkSession, path: str, pages: DataFrame, read: Worker, buckets: int = BUCKETS) -> dict[str, int]:
    """Reads the pages (id, page, ...) that the cache doesn't hold. read takes them with a column ``shrink`` and returns
    (id, page, ok, value, error, down): a refused page is tried smaller, one whose endpoint is down waits for the next run."""
    step = F.concat(F.lit("page "), F.col("page").cast("string"))
    counts = {"read": 0, "refused": 0, "down": 0}
    known = read_buckets(spark, path, STATE).where("ok").select("id", "step")
    open_ = cut(pages.withColumn("id", F.col("id").cast("string")).withColumn("step", step).join(known, ["id", "step"], "left_anti"))
    for shrink in SHRINK:
        results = cut(read(open_.drop("step").withColumn("shrink", F.lit(shrink))).select(F.col("id").cast("string").alias("id"), "page", "ok", "value", "error", "down"))
        put(spark, path, results.withColumn("step", step).select("id", "step", "ok", "value", "error"), buckets)
        facts = results.agg(F.count(F.when(F.col("ok"), 1)).alias("read"), F.count(F.when(~F.col("ok") & ~F.col("down"), 1)).alias("refused"), F.count(F.when(~F.col("ok") & F.col("down"), 1)).alias("down")).head()
        counts = {"read": counts["read"] + facts["read"], "refused": facts["refused"], "down": counts["down"] + facts["down"]}
        open_ = cut(open_.join(results.where("not ok and not down").select("id", "page"), ["id", "page"], "left_semi"))
        if not facts["refused"]:
            break
    return counts


def page_texts(pages: DataFrame, state: DataFrame) -> DataFrame:
    """(id, text, failed): the documents put together, a page that isn't read yet as its placeholder."""
    number = F.regexp_extract("step", r"^page (\d+)$", 1)
    have = state.where(F.col("ok") & number.rlike(r"^\d+$")).select("id", number.cast("int").alias("page"), "value")
    rows = pages.select(F.col("id").cast("string").alias("id"), F.col("page").cast("int").alias("page")).distinct().join(have, ["id", "page"], "left")
    body = F.concat(pg.page_mark(F.col("page")), F.lit("\n\n"), F.coalesce("value", F.lit(FAILED_PAGE)))
    all_ = F.array_sort(F.collect_list(F.struct("page", body.alias("body"))))
    return rows.groupBy("id").agg(F.array_join(F.transform(all_, lambda x: x["body"]), "\n\n").alias("text"), F.count(F.when(F.col("value").isNull(), 1)).alias("failed"))
