"""Queries on the index: BM25, vectors, fusion, cuts and incremental indexing."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.functions import vector as vx
from folio.operators import search as se
from folio.operators import stored_index as ix
from folio.storage import cut, new_path

from .lifts import table
from .registry import query

QUESTION = "this thereation pour lichkeit and ciónes worthless"

#: itoks(doc_id, w): what the index takes as words
INDEX_TOKENS = r"itoks AS (SELECT doc_id, regexp_extract_all(lower(strip_accents(text)), '[\p{L}\p{N}]+') AS w FROM documents)"
POSTINGS = INDEX_TOKENS + ", post AS (SELECT term, doc_id AS cid, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM itoks) GROUP BY ALL)"


def index(spark, sf):
    return se.postings(table(spark, sf, "documents"), "doc_id")


@query("m04_postings", f"WITH {POSTINGS} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM post GROUP BY term")
def m04_postings(spark, sf):
    return index(spark, sf).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


@query("m04_lengths", f"WITH {POSTINGS} SELECT cid, CAST(sum(tf) AS BIGINT) AS dl FROM post GROUP BY cid")
def m04_lengths(spark, sf):
    return index(spark, sf).groupBy("cid").agg(F.sum("tf").alias("dl"))


BM25 = POSTINGS + """, q(q, is_prefix) AS (VALUES ('this', false), ('therea', true), ('pour', false), ('lichke', true), ('ciones', true), ('and', false), ('worthl', true)),
lens AS (SELECT cid, sum(tf) AS dl FROM post GROUP BY cid), tot AS (SELECT count(*) AS docs, avg(dl) AS avgdl FROM lens),
m AS (SELECT q, cid, sum(tf) AS tf FROM post JOIN q ON CASE WHEN is_prefix THEN starts_with(term, q) ELSE term = q END GROUP BY ALL),
dfs AS (SELECT q, count(*) AS n FROM m GROUP BY q),
parts AS (SELECT cid, CASE WHEN ln((docs - n + 0.5) / (n + 0.5)) <= 0 THEN 1e-6 ELSE ln((docs - n + 0.5) / (n + 0.5)) END * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl)) AS s FROM m JOIN dfs USING (q) JOIN lens USING (cid), tot),
bm AS (SELECT cid, sum(s) AS score FROM parts GROUP BY cid)"""


@query("o01_bm25", f"WITH {BM25} SELECT cid, round(score, 6) AS score FROM bm")
def o01_bm25(spark, sf):
    return se.bm25(index(spark, sf), QUESTION).select("cid", F.round("score", 6).alias("score"))


@query("k02_stored_index", f"WITH {BM25} SELECT cid, round(score, 6) AS score FROM bm")
def k02_stored_index(spark, sf):
    path = new_path(spark, "index")
    se.write_index(table(spark, sf, "documents"), path, "doc_id")
    return se.ask_index(spark, path, QUESTION).select("cid", F.round("score", 6).alias("score"))


@query("o01_bm25_top", f"WITH {BM25} SELECT cid, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, cid) - 1 AS rank FROM bm QUALIFY rank < 50")
def o01_bm25_top(spark, sf):
    top = se.top(se.bm25(index(spark, sf), QUESTION), 50)
    return top.select("cid", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("f07_query_terms", r"SELECT item_id, x[1:6] AS term, length(x) >= 6 AS is_prefix FROM (SELECT DISTINCT item_id, CASE WHEN length(w) >= 6 THEN w[1:6] ELSE w END AS x FROM (SELECT item_id, unnest(regexp_extract_all(lower(strip_accents(text)), '[\p{L}\p{N}]+')) AS w FROM benchmark))")
def f07_query_terms(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", F.explode(se.question_terms(F.col("text"))).alias("x")).select("item_id", "x.term", "x.is_prefix")


VEC = """v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), q AS (SELECT e AS qe FROM v WHERE vec_id = 0),
cosines AS (SELECT vec_id AS cid, list_inner_product(e, qe) / sqrt(list_inner_product(qe, qe)) / (sqrt(list_inner_product(e, e)) + 1e-9) AS score FROM v, q)"""


def cosines(spark, sf):
    vectors = table(spark, sf, "embeddings")
    question = vectors.where("vec_id = 0").select("embedding").head()[0]  # the one query vector
    return se.vector_scores(vectors, [float(x) for x in question])


@query("x04_cosine", f"WITH {VEC} SELECT cid, round(score, 6) AS score FROM cosines")
def x04_cosine(spark, sf):
    return cosines(spark, sf).select("cid", F.round("score", 6).alias("score"))


@query("x03_normalise", "WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings) SELECT vec_id, round(sqrt(list_inner_product(e, e)), 6) AS norm, round(e[1] / sqrt(list_inner_product(e, e)), 6) AS first FROM v")
def x03_normalise(spark, sf):
    v = table(spark, sf, "embeddings")
    return v.select("vec_id", F.round(vx.length(F.col("embedding")), 6).alias("norm"), F.round(F.get(vx.normalise(F.col("embedding")), F.lit(0)), 6).alias("first"))


@query("o02_vector_top", f"WITH {VEC} SELECT cid, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, cid) - 1 AS rank FROM cosines QUALIFY rank < 50")
def o02_vector_top(spark, sf):
    vectors = table(spark, sf, "embeddings")
    question = [float(x) for x in vectors.where("vec_id = 0").select("embedding").head()[0]]
    top = ix.block_top(ix.vector_blocks(vectors, "vec_id", "embedding"), question, 50)
    return top.select("cid", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("o02_stored_blocks", f"WITH {VEC} SELECT cid, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, cid) - 1 AS rank FROM cosines QUALIFY rank < 50")
def o02_stored_blocks(spark, sf):
    """Several blocks, written and asked."""
    vectors = table(spark, sf, "embeddings")
    question = [float(x) for x in vectors.where("vec_id = 0").select("embedding").head()[0]]
    blocks = cut(ix.vector_blocks(vectors, "vec_id", "embedding", rows=128))
    return ix.block_top(blocks, question, 50).select("cid", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


RRF = BM25 + ", " + VEC.replace("q AS (SELECT e AS qe FROM v WHERE vec_id = 0)", "qv AS (SELECT e AS qe FROM v WHERE vec_id = 0)").replace("FROM v, q)", "FROM v, qv)") + """,
l0 AS (SELECT cid, score, row_number() OVER (ORDER BY score DESC, cid) - 1 AS rank FROM bm QUALIFY rank < 50),
l1 AS (SELECT cid, score, row_number() OVER (ORDER BY score DESC, cid) - 1 AS rank FROM cosines QUALIFY rank < 50),
fused AS (SELECT cid, sum(1.0 / (60 + rank + 1)) AS rrf_score, arg_max(score, l) AS score FROM (SELECT *, 0 AS l FROM l0 UNION ALL SELECT *, 1 FROM l1) GROUP BY cid)"""


@query("w01_rrf", f"WITH {RRF} SELECT cid, round(rrf_score, 9) AS rrf_score, round(score, 6) AS score FROM fused")
def w01_rrf(spark, sf):
    lists = [se.top(se.bm25(index(spark, sf), QUESTION), 50), se.top(cosines(spark, sf), 50)]
    return se.fuse(lists).select("cid", F.round("rrf_score", 9).alias("rrf_score"), F.round("score", 6).alias("score"))


HITS = BM25 + ", hits AS (SELECT cid, score, source AS path, CAST(cid % 3 AS INTEGER) AS page FROM bm JOIN documents d ON d.doc_id = cid)"


def hits(spark, sf):
    places = table(spark, sf, "documents").select(F.col("doc_id").alias("cid"), F.col("source").alias("path"), (F.col("doc_id") % 3).cast("int").alias("page"))
    return se.bm25(index(spark, sf), QUESTION).join(places, "cid")


@query("w02_one_per_page", f"WITH {HITS} SELECT cid, path, page FROM (SELECT *, row_number() OVER (PARTITION BY path, page ORDER BY score DESC, cid) AS k FROM hits) WHERE k = 1 ORDER BY score DESC, cid LIMIT 20")
def w02_one_per_page(spark, sf):
    return se.one_per_page(hits(spark, sf), [F.desc("score"), F.asc("cid")], 20).select("cid", "path", "page")


@query("o03_primary_first", f"""WITH {HITS}, best AS (SELECT *, row_number() OVER (PARTITION BY path, page ORDER BY score DESC, cid) AS k FROM hits),
mine AS (SELECT *, row_number() OVER (ORDER BY score DESC, cid) AS n FROM best WHERE k = 1 AND path = 'src3'), other AS (SELECT *, row_number() OVER (ORDER BY score DESC, cid) AS n FROM best WHERE k = 1 AND path <> 'src3' QUALIFY n <= 3),
both_t AS (SELECT 0 AS g, n, cid, path FROM mine WHERE n <= greatest(8 - (SELECT count(*) FROM other), 1) UNION ALL SELECT 1, n, cid, path FROM other)
SELECT cid, path, row_number() OVER (ORDER BY g, n) AS place FROM both_t QUALIFY place <= 8""")
def o03_primary_first(spark, sf):
    out = se.primary_first(hits(spark, sf), F.col("path") == "src3", [F.desc("score"), F.asc("cid")], 8, 3)
    return out.select("cid", "path", F.col("place").cast("long").alias("place"))


@query("k01_changed_documents", "SELECT 'd' || doc_id AS path, sha256(text) AS sha256 FROM documents WHERE doc_id % 7 = 0 OR doc_id % 5 = 0")
def k01_changed_documents(spark, sf):
    current = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("d"), "doc_id").alias("path"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    indexed = current.where("doc_id % 7 <> 0").withColumn("sha256", F.when(F.col("doc_id") % 5 == 0, F.lit("old")).otherwise(F.col("sha256")))
    return se.changed_documents(current, indexed).select("path", "sha256")


@query("k01_updated_index", f"WITH {BM25.replace('FROM documents)', 'FROM documents WHERE doc_id % 4 <> 3)', 1)} SELECT cid AS doc_id, round(score, 6) AS score FROM bm")
def k01_updated_index(spark, sf):
    """An index of all documents as they were, brought up to date: a quarter is gone, a quarter new, a quarter changed. Each
    document is one chunk here, so that the answer is that of the same documents indexed at once."""
    path = new_path(spark, "index")
    docs = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("d"), "doc_id").alias("path"), F.concat_ws(" ", se.tx.index_words(F.col("text"))).alias("text"))
    docs = cut(docs.where(F.length("text") > 0))
    part = F.col("doc_id") % 4
    before = F.when(part == 1, F.concat("text", F.lit(" pour pour"))).otherwise(F.col("text"))
    ix.update(spark, path, docs.where(part != 0).withColumn("text", before), buckets=8)
    ix.update(spark, path, docs.where(part != 3))
    cid = F.xxhash64("path", F.lit(0), F.lit(0))
    return docs.select("doc_id", cid.alias("cid")).join(ix.ask(spark, path, QUESTION), "cid").select("doc_id", F.round("score", 6).alias("score"))


@query("k01_gone_documents", "SELECT 'd' || doc_id AS path FROM documents WHERE doc_id % 9 = 0")
def k01_gone_documents(spark, sf):
    indexed = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("d"), "doc_id").alias("path"))
    return se.gone_documents(indexed.where("doc_id % 9 <> 0"), indexed).select("path")


@query("w07_same_length", "SELECT doc_id, n_chars, k FROM (SELECT doc_id, n_chars, count(*) OVER (PARTITION BY n_chars) AS k FROM documents) WHERE k >= 3 AND n_chars > 1000")
def w07_same_length(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars").withColumn("k", F.count("*").over(Window.partitionBy("n_chars")))
    return d.where("k >= 3 and n_chars > 1000")
