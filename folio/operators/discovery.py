"""Finding and acquiring literature: candidates, metadata, decisions and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import text as tx


def normal_doi(doi: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(doi)), r"^https?://(dx\.)?doi\.org/", ""), r"^doi:", "")


def rebuild_abstract(works: DataFrame, id_col: str, index_col: str) -> DataFrame:
    """(id, abstract) from a map of words to places; of two words at one place the later in the map wins. Works stay where they are."""
    placed = F.transform(F.map_entries(index_col), lambda e, at: F.transform(e["value"], lambda place: F.struct(place.alias("place"), at.alias("at"), e["key"].alias("word"))))
    rows = works.select(id_col, F.array_sort(F.flatten(F.filter(placed, lambda p: p.isNotNull()))).alias("p")).where(F.size("p") > 0)
    after = F.concat(F.slice("p", F.lit(2), F.size("p")), F.array(F.lit(None)))
    last = F.filter(F.zip_with("p", after, lambda x, y: F.struct(x.alias("x"), y.alias("y"))), lambda z: z["y"].isNull() | (z["x"]["place"] != z["y"]["place"]))
    return rows.select(id_col, F.array_join(F.transform(last, lambda z: z["x"]["word"]), " ").alias("abstract"))


def rescale(candidates: DataFrame, topic: str, relevance: str, scaled: Column) -> DataFrame:
    """With score: relevance from 1 to 5 within its topic where ``scaled`` holds; 3 for the others and for constant topics."""
    w = Window.partitionBy(topic)
    own = F.when(scaled, F.col(relevance))
    low, high = F.min(own).over(w), F.max(own).over(w)
    score = F.when(~scaled | (high == low) | own.isNull(), F.lit(3.0)).otherwise(1 + 4 * (own - low) / F.nullif(high - low, F.lit(0.0)))
    return candidates.withColumn("score", score)


def not_known(second: DataFrame, first: DataFrame, doi: str = "doi") -> DataFrame:
    """Rows of the second source whose non-empty DOI the first one lacks."""
    return second.join(first.where(F.col(doi) != "").select(doi).distinct(), doi, "left_anti")


def merge_metadata(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Full outer by key; each field from the left unless it is empty there."""
    r = right.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    return left.join(r, key, "full_outer").select(key, *[F.coalesce(F.nullif(F.col(f), F.lit("")), F.col(f"_{f}")).alias(f) for f in fields])


def table_row(cells: list[Column]) -> Column:
    """A row of a pipe table; bars and line ends in cells are replaced."""
    safe = [F.replace(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"[\r\n]+", " "), F.lit("|"), F.lit("/")) for c in cells]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *safe), F.lit(" |"))


def open_url(extra: Column) -> Column:
    return F.nullif(F.regexp_extract(extra, r"OA URL:\s*(\S+)", 1), F.lit(""))


def fetch_plan(url: Column) -> tuple[Column, Column]:
    """(url to fetch, content type): abstract pages become PDFs; web pages and DOI landings have no type."""
    fetched = F.when(url.contains("arxiv.org/abs/"), F.replace(url, F.lit("/abs/"), F.lit("/pdf/"))).otherwise(url)
    kind = F.when(fetched.contains("/pdf/") | fetched.endswith(".pdf"), F.lit("application/pdf")).when(fetched.endswith(".html") | fetched.contains("doi.org/"), F.lit(None)).otherwise(F.lit("application/pdf"))
    return fetched, kind


def row_numbers(spec: Column) -> Column:
    """'1,3,5-8' as the sorted distinct numbers."""
    parts = F.filter(F.transform(F.split(spec, ","), lambda p: F.trim(p)), lambda p: p.rlike(r"^\d+(-\d+)?$"))
    ranges = F.transform(parts, lambda p: F.sequence(F.split(p, "-")[0].cast("int"), F.element_at(F.split(p, "-"), -1).cast("int")))
    return F.array_sort(F.array_distinct(F.flatten(ranges)))


def best_candidates(wanted: DataFrame, candidates: DataFrame) -> DataFrame:
    """The best candidate of each wanted work (id, title, author, year), and whether it resolves it.

    candidates: id, pos, title, family, year, doi. overlap is the share of the wanted title's words; the score adds a quarter
    for a matching author and takes 0.08 a year of distance, up to three. Resolved: overlap 0.55 or more, the
    author matches, both years are known and at most two apart.
    """
    c = candidates.select("id", "pos", "doi", F.col("title").alias("c_title"), F.col("family"), F.col("year").alias("c_year"))
    both = wanted.join(c, "id")
    want, have = tx.word_set(F.col("title")), tx.word_set(F.col("c_title"))
    overlap = F.size(F.array_intersect(want, have)) / F.greatest(F.size(want), F.lit(1))
    author = (tx.fold(F.col("author")) != "") & F.contains(tx.fold(F.col("family")), tx.fold(F.col("author")))
    apart = F.abs(F.col("year") - F.col("c_year"))
    both = both.withColumns({"overlap": overlap, "author_ok": F.coalesce(author, F.lit(False)), "apart": apart})
    score = F.col("overlap") + F.when(F.col("author_ok"), 0.25).otherwise(0.0) - 0.08 * F.least(F.coalesce("apart", F.lit(0)), F.lit(3))
    both = both.withColumn("score", score)
    w = Window.partitionBy("id").orderBy(F.desc("score"), "pos")
    best = both.withColumn("_k", F.row_number().over(w)).where("_k = 1")
    resolved = (F.col("overlap") >= 0.55) & F.col("author_ok") & F.coalesce(F.col("apart") <= 2, F.lit(False))
    return best.select("id", "doi", "overlap", "author_ok", "score", resolved.alias("resolved"))


def first_success(attempts: DataFrame) -> DataFrame:
    """(id, status, n_attempts, url): locations are tried in order up to the first success; attempts (id, pos, url, ok, doi, error)."""
    w = Window.partitionBy("id")
    win = F.min(F.when(F.col("ok"), F.col("pos"))).over(w)
    tried = attempts.withColumn("win", win).where(F.col("win").isNull() | (F.col("pos") <= F.col("win")))
    g = tried.groupBy("id").agg(F.max("doi").alias("doi"), F.max("error").alias("error"), F.count("url").alias("n_attempts"), F.max(F.when(F.col("pos") == F.col("win"), F.col("url"))).alias("url"))
    status = F.when(F.coalesce("doi", F.lit("")) == "", "no_doi").when(F.col("error").isNotNull(), "service_error").when(F.col("n_attempts") == 0, "no_oa").when(F.col("url").isNotNull(), "OK").otherwise("all_failed")
    return g.select("id", status.alias("status"), "n_attempts", "url")


def merge_log(records: DataFrame, key: str, order: str, scalars: list[str], listed: str) -> DataFrame:
    """One row per key: of each scalar the last value that isn't empty, the lists joined in order of arrival."""
    last = [F.max_by(c, F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.col(order))).alias(c) for c in scalars]
    ordered = F.array_sort(F.collect_list(F.struct(order, listed)))
    return records.groupBy(key).agg(*last, F.flatten(F.transform(ordered, lambda x: F.coalesce(x[listed], F.expr("cast(array() as array<string>)")))).alias(listed))


def resolve_dois(wanted: DataFrame, candidates: DataFrame) -> DataFrame:
    """(id, status, doi, overlap) of every wanted entry: resolved, unresolved with the best candidate, or without any."""
    best = best_candidates(wanted, candidates).select("id", "doi", "overlap", "resolved")
    out = wanted.select("id").join(best, "id", "left")
    return out.select("id", F.when(F.coalesce("resolved", F.lit(False)), "resolved").otherwise("unresolved").alias("status"), "doi", "overlap")


def doi_list(resolved: DataFrame) -> DataFrame:
    """(doi): the resolved ones, each once."""
    return resolved.where("status = 'resolved'").select(normal_doi(F.col("doi")).alias("doi")).distinct()
