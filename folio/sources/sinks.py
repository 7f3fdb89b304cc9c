"""Sinks that never lose what they replace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.operators.numbering import numbered


def keep_if_empty(new: Column, old: Column) -> tuple[Column, Column]:
    """(text, status): an empty text never replaces another; status is its length, 0 for nothing written, -1 for kept."""
    empty = F.trim(F.coalesce(new, F.lit(""))) == ""
    had = F.trim(F.coalesce(old, F.lit(""))) != ""
    return F.when(empty, old).otherwise(new), F.when(empty & had, -1).when(empty, 0).otherwise(F.length(new))


def byte_budget(abstract: Column, rest_bytes: Column, limit: int = 3500, step: int = 200, floor: int = 50) -> Column:
    """The abstract cut by ``step`` characters until the whole fits, never below ``floor``; else a placeholder."""
    tries = F.sequence(F.lit(0), F.greatest(F.ceil((F.length(abstract) - floor) / step), F.lit(0)).cast("int"))
    cut = lambda k: F.substring(abstract, F.lit(1), F.greatest(F.length(abstract) - k * step, F.lit(floor)))
    fits = F.filter(F.transform(tries, cut), lambda a: F.octet_length(a) + rest_bytes <= limit)
    return F.coalesce(F.get(fits, F.lit(0)), F.lit("[abstract omitted]"))


def file_manifest(files: DataFrame) -> DataFrame:
    """(path, size, sha256) of a listing with content."""
    return files.select("path", F.length("content").cast("long").alias("size"), F.sha2("content", 256).alias("sha256"))


def abstract_lines(collections: DataFrame, items: DataFrame) -> DataFrame:
    """(coll, n, lines): a dump of each collection's abstracts; n is 0 for its head, then counts its items in order of ``place``.

    collections: coll, name; items: coll, place, key, title, date, venue, doi, abstract, extra. Nulls are empty; a collection without
    items has its head only. Written with ``partitionBy("coll")`` every collection is a file of its own.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = numbered(items, ["coll"], [F.col("place"), F.col("key")], "n")
    counts = items.groupBy("coll").agg(F.count("*").alias("k"))
    head = collections.join(counts, "coll", "left").select("coll", F.lit(0).cast("long").alias("n"), F.concat(F.lit("# "), F.coalesce("name", "coll"), F.lit("  ("), "coll", F.lit(")\n\nTotal candidates: "), F.coalesce("k", F.lit(0)).cast("string"), F.lit("\n")).alias("lines"))
    status = F.trim(F.regexp_extract(text("extra"), r"(?m)^OA status:(.*)$", 1))
    maybe = lambda c, before, after: F.when(text(c) != "", F.concat(F.lit(before), text(c), F.lit(after))).otherwise("")
    body = F.concat(F.lit("## ["), F.col("n").cast("string"), F.lit("] "), text("key"), F.lit("  ("), status, F.lit(", "), F.substring(text("date"), 1, 4), F.lit(")\n**"), text("title"), F.lit("**  \n"), maybe("venue", "*", "*  \n"), maybe("doi", "DOI: ", "  \n"), F.lit("\n"), text("abstract"), F.lit("\n\n---\n"))
    return head.unionByName(rows.join(collections.select("coll"), "coll", "left_semi").select("coll", "n", body.alias("lines")))


def run_report(rows: DataFrame, parts: str, settings: dict[str, int | float | str], files: DataFrame) -> DataFrame:
    """(part, value): a report as JSON lines, first what the run was asked for with the number of files, then the files in
    order, then the rows. Sorted by part it is written with ``write.text`` by ranges."""
    meta = files.agg(F.to_json(F.struct(*(F.lit(v).alias(k) for k, v in settings.items()), F.count("*").alias("files"))).alias("value")).select(F.lit(0).alias("part"), "value")
    listed = files.select(F.lit(1).alias("part"), F.to_json(F.struct("path")).alias("value"))
    return meta.unionByName(listed).unionByName(rows.select(F.lit(2).alias("part"), F.to_json(F.struct(F.struct(*rows.columns).alias(parts))).alias("value")))


def page_audit(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc, page, value): a line of JSON per page with its settings, the mean confidence of its lines to four digits (null if none
    has one) and the lines in order. pages: doc, page, source, rotation, note; lines: doc, page, n, text, conf."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("n", "text", "conf"))), lambda x: F.struct(x["text"].alias("text"), x["conf"].alias("conf")))
    own = lines.groupBy("doc", "page").agg(F.round(F.avg("conf"), 4).alias("mean_conf"), ordered.alias("lines"))
    rows = pages.join(own, ["doc", "page"], "left")
    none = F.expr("cast(array() as array<struct<text:string,conf:double>>)")
    record = F.struct("page", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("rotation", F.lit(0)).alias("rotation"), F.coalesce("note", F.lit("")).alias("note"), "mean_conf", F.coalesce("lines", none).alias("lines"))
    return rows.select("doc", "page", F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def pack(files: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """(contents, manifest) of a package of files: those that are kept, and path, size and sha256 of each, with one row for the whole:
    a null path, all bytes, and the digest of the digests in order of paths."""
    kept = files.where(keep)
    each = file_manifest(kept)
    inner = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "sha256"))), lambda x: x["sha256"]), "")
    whole = each.agg(F.lit(None).cast("string").alias("path"), F.coalesce(F.sum("size"), F.lit(0).cast("long")).alias("size"), F.sha2(inner.cast("binary"), 256).alias("sha256"))
    return kept, each.unionByName(whole)
