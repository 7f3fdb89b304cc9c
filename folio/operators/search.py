"""Ranking: an inverted index with BM25, vectors with cosine, fusion, and the cuts after it."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.functions import text as tx
from folio.functions import vector as vx
from folio.storage import cut

K1, B, FLOOR = 1.2, 0.75, 1e-6
PREFIX = 6


def postings(chunks: DataFrame, id_col: str = "cid", text_col: str = "text") -> DataFrame:
    """(term, cid, tf); terms are folded runs of letters and digits of any script."""
    texts = chunks.select(F.col(id_col).alias("cid"), F.col(text_col).alias("text")).repartition("cid")  # texts are moved once, not their terms
    terms = texts.select("cid", F.explode(tx.index_words(F.col("text"))).alias("term"))
    return terms.groupBy("term", "cid").agg(F.count("*").alias("tf"))


def write_index(chunks: DataFrame, path: str, id_col: str = "cid", text_col: str = "text") -> None:
    """Stores postings in ranges of terms, so that a question reads the row groups of its terms, the chunks' lengths
    and their totals."""
    postings(chunks, id_col, text_col).repartitionByRange("term", "cid").sortWithinPartitions("term", "cid").write.mode("overwrite").parquet(f"{path}/postings")
    lengths = chunks.sparkSession.read.parquet(f"{path}/postings").groupBy("cid").agg(F.sum("tf").alias("dl"))
    lengths.write.mode("overwrite").parquet(f"{path}/lengths")
    _totals(chunks.sparkSession.read.parquet(f"{path}/lengths")).write.mode("overwrite").parquet(f"{path}/totals")


def ask_index(spark: SparkSession, path: str, question: str) -> DataFrame:
    """bm25 of a stored index: only the question's terms, the lengths of their chunks and one row of totals are read."""
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    return bm25(read("postings"), question, read("lengths"), read("totals"))


def query_terms(question: str) -> list[tuple[str, bool]]:
    """(term, is a prefix): words, folded as the index folds its own, of six characters or more search by their first six."""
    words = re.findall(r"[^\W_]+", tx.folded(question))
    return list(dict.fromkeys((w[:PREFIX], True) if len(w) >= PREFIX else (w, False) for w in words))


def question_terms(question: Column) -> Column:
    """The same of a column of questions: an array of (term, is_prefix) in order of first occurrence; null asks nothing."""
    one = lambda w: F.struct(F.substring(w, 1, PREFIX).alias("term"), (F.length(w) >= PREFIX).alias("is_prefix"))
    return F.array_distinct(F.transform(tx.index_words(question), one))


def _totals(lengths: DataFrame) -> DataFrame:
    return lengths.agg(F.count("*").alias("docs"), F.avg("dl").alias("avgdl"))


def bm25(index: DataFrame, question: str, lengths: DataFrame | None = None, totals: DataFrame | None = None) -> DataFrame:
    """(cid, score) of the chunks that hold a term; terms are alternatives.

    A prefix is expanded against the terms of the index and counts as one term: its frequencies add up and its
    document frequency is that of any of its words. The inverse document frequency is ln((N - n + .5) / (n + .5)),
    1e-6 where that isn't positive. A chunk's length is the number of its tokens. lengths and totals: as stored.
    """
    asked = query_terms(question) or [("", False)]
    # conditions on the term itself reach the scan of a stored index
    matches = [F.startswith("term", F.lit(q)) if prefix else F.col("term") == q for q, prefix in asked]
    own = [f"tf{k}" for k in range(len(asked))]  # a column a term: equal chunks add up in one order
    sums = [F.sum(F.when(m, F.col("tf"))).alias(c) for m, c in zip(matches, own, strict=True)]
    if lengths is None:
        rows = cut(index.groupBy("cid").agg(F.sum("tf").alias("dl"), *sums))  # one pass over the texts
        lengths = rows
    else:
        rows = index.where(reduce(or_, matches)).groupBy("cid").agg(*sums).join(lengths, "cid")
    totals = _totals(lengths) if totals is None else totals
    df = rows.agg(*(F.count(c).alias(f"n{k}") for k, c in enumerate(own)))
    rows = rows.where(F.coalesce(*own).isNotNull()).crossJoin(F.broadcast(df)).crossJoin(F.broadcast(totals))  # one row each

    def part(k: int) -> Column:
        tf, n = F.col(own[k]), F.col(f"n{k}")
        idf = F.log((F.col("docs") - n + 0.5) / (n + 0.5))
        idf = F.when(idf <= 0, F.lit(FLOOR)).otherwise(idf)
        return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))

    score = reduce(lambda done, k: done + F.coalesce(part(k), F.lit(0.0)), range(len(asked)), F.lit(0.0))
    return rows.select("cid", score.alias("score"))


def top(scored: DataFrame, k: int, score: str = "score", tie: str = "cid") -> DataFrame:
    """The k best, with rank from 0."""
    best = scored.orderBy(F.col(score).desc(), tie).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.col(score).desc(), tie)) - 1)


def vector_scores(vectors: DataFrame, query: list[float], id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(cid, score): cosine with the query."""
    norm = sum(x * x for x in query) ** 0.5 or 1.0
    unit = F.array(*[F.lit(x / norm) for x in query])
    return vectors.select(F.col(id_col).alias("cid"), vx.cosine(F.col(vec_col), unit).alias("score"))


def fuse(lists: list[DataFrame], k: int = 60) -> DataFrame:
    """Reciprocal rank fusion of lists (cid, score, rank from 0): cid, rrf_score, score (of the last list that holds it), first (its order of appearance)."""
    all_lists = None
    for n, part in enumerate(lists):
        part = part.select("cid", "score", "rank", F.lit(n).alias("list"))
        all_lists = part if all_lists is None else all_lists.unionByName(part)
    return all_lists.groupBy("cid").agg(F.sum(1.0 / (k + F.col("rank") + 1)).alias("rrf_score"), F.max_by("score", "list").alias("score"), F.min(F.struct("list", "rank")).alias("first"))


def one_per_page(hits: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The best hit of each (path, page), then the first ``limit``."""
    w = Window.partitionBy("path", "page").orderBy(*order)
    return hits.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n").orderBy(*order).limit(limit)


def primary_first(hits: DataFrame, primary: Column, order: list[Column], n: int, support: int) -> DataFrame:
    """Hits of the primary title lead, others support: the split comes before the cut.

    At most ``support`` others; as many primary ones as fill n, at least one. place orders the result.
    """
    mine = one_per_page(hits.where(primary), order, n)
    other = one_per_page(hits.where(~primary), order, max(support, 0))
    room = other.agg(F.greatest(F.lit(n) - F.count("*"), F.lit(1)).alias("room"))  # one row
    mine = mine.withColumn("_k", F.row_number().over(Window.orderBy(*order))).crossJoin(F.broadcast(room)).where("_k <= room").drop("room").withColumn("grp", F.lit(0))
    other = other.withColumn("_k", F.row_number().over(Window.orderBy(*order))).withColumn("grp", F.lit(1))
    return mine.unionByName(other).withColumn("place", F.row_number().over(Window.orderBy("grp", "_k"))).where(F.col("place") <= n).drop("_k", "grp")


def changed_documents(current: DataFrame, indexed: DataFrame) -> DataFrame:
    """Documents to index again: new ones and those whose content changed. Both: path, sha256."""
    return current.join(indexed.select("path", "sha256"), ["path", "sha256"], "left_anti")


def gone_documents(current: DataFrame, indexed: DataFrame) -> DataFrame:
    """Indexed documents whose file is no longer there."""
    return indexed.join(current.select("path"), "path", "left_anti")


def rerank(hits: DataFrame, passages: DataFrame, question: str, embed: Callable[[Column], Column], candidates: int = 20, n: int = 5) -> DataFrame:
    """The best ``candidates`` hits (cid, score), both sides embedded anew by one model and ordered by its cosine with the question.

    embed makes a vector of a text column; passages: cid, text. The question is marked as such for the model, as are passages.
    """
    best = hits.orderBy(F.desc("score"), "cid").limit(candidates).select("cid", F.col("score").alias("before"))
    asked = hits.sparkSession.range(1).select(embed(tx.for_model(F.lit(question), "query")).alias("_q"))  # one row
    both = passages.join(F.broadcast(best), "cid").crossJoin(F.broadcast(asked))
    scored = both.withColumn("score", vx.cosine(embed(tx.for_model(F.col("text"), "passage")), vx.normalise(F.col("_q")))).drop("_q")
    return scored.orderBy(F.desc("score"), F.desc("before"), "cid").limit(n)
