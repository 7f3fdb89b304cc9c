"""Reports: abstracts of collections, runs with their settings, audits of pages, and packages with their digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.sources import sinks

from .lifts import table
from .registry import query


@query("k08_abstracts", """WITH i AS (SELECT o_custkey AS coll, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS n, o.* FROM orders o)
SELECT 'c' || coll AS coll, n, '## [' || n || '] ' || o_orderkey || '  (' || CASE WHEN o_orderstatus = 'O' THEN 'gold' ELSE '' END || ', ' || strftime(o_orderdate, '%Y') || ')' || chr(10) || '**order ' || o_orderkey || '**  ' || chr(10)
 || CASE WHEN o_orderstatus = 'F' THEN '*' || o_orderpriority || '*  ' || chr(10) ELSE '' END || CASE WHEN o_orderstatus <> 'F' THEN 'DOI: 10.1/' || o_orderkey || '  ' || chr(10) ELSE '' END || chr(10) || CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END || chr(10) || chr(10) || '---' || chr(10) AS lines FROM i
UNION ALL SELECT 'c' || c_custkey, 0, '# ' || c_name || '  (c' || c_custkey || ')' || chr(10) || chr(10) || 'Total candidates: ' || (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) || chr(10) FROM customer""")
def k08_abstracts(spark, sf):
    status = F.col("o_orderstatus")
    items = table(spark, sf, "orders").select(
        F.concat(F.lit("c"), "o_custkey").alias("coll"), F.col("o_totalprice").alias("place"), F.col("o_orderkey").alias("key"), F.concat(F.lit("order "), "o_orderkey").alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.when(status == "F", F.col("o_orderpriority")).alias("venue"), F.when(status != "F", F.concat(F.lit("10.1/"), "o_orderkey")).alias("doi"), F.when(status != "P", F.col("o_orderpriority")).alias("abstract"),
        F.when(status == "O", "note: x\nOA status: gold \nmore").otherwise("note: OA status").alias("extra"),
    )
    names = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("coll"), F.col("c_name").alias("name"))
    return sinks.abstract_lines(names, items)


@query("k24_run_report", """SELECT 0 AS part, '{"k":8,"min_cover":0.05,"files":' || count(*) || '}' AS value FROM documents UNION ALL SELECT 1, '{"path":"d' || doc_id || '"}' FROM documents
UNION ALL SELECT 2, '{"pair":{"a":' || doc_id || ',"lang":"' || lang || '"}}' FROM documents WHERE lang IS NOT NULL AND n_chars > 1000""")
def k24_run_report(spark, sf):
    d = table(spark, sf, "documents")
    pairs = d.where("lang is not null and n_chars > 1000").select(F.col("doc_id").alias("a"), "lang")
    return sinks.run_report(pairs, "pair", {"k": 8, "min_cover": 0.05}, d.select(F.concat(F.lit("d"), "doc_id").alias("path")))


@query("k25_page_audit", """WITH l AS (SELECT o_custkey AS doc, o_orderkey AS page, list('{"text":"line ' || l_linenumber || '","conf":' || CASE WHEN l_linenumber % 2 = 0 THEN 'null' ELSE CAST(l_discount AS VARCHAR) END || '}' ORDER BY l_linenumber, CASE WHEN l_linenumber % 2 = 1 THEN l_discount END NULLS FIRST) AS ls,
 round(avg(CASE WHEN l_linenumber % 2 = 1 THEN l_discount END), 4) AS m FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL)
SELECT o_custkey AS doc, o_orderkey AS page, '{"page":' || o_orderkey || ',"source":"' || CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END || '","rotation":' || CASE WHEN o_orderstatus = 'O' THEN 90 ELSE 0 END || ',"note":"","mean_conf":' || coalesce(CAST(m AS VARCHAR), 'null') || ',"lines":[' || coalesce(array_to_string(ls, ','), '') || ']}' AS value
FROM orders LEFT JOIN l ON doc = o_custkey AND page = o_orderkey""")
def k25_page_audit(spark, sf):
    o, status = table(spark, sf, "orders"), F.col("o_orderstatus")
    pages = o.select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("page"), F.when(status != "P", status).alias("source"), F.when(status == "O", 90).alias("rotation"), F.lit(None).cast("string").alias("note"))
    lines = table(spark, sf, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("page"), F.col("l_linenumber").alias("n"), F.concat(F.lit("line "), "l_linenumber").alias("text"), F.when(F.col("l_linenumber") % 2 == 1, F.col("l_discount")).alias("conf"))
    return sinks.page_audit(pages, lines)


@query("k09_pack", "WITH f AS (SELECT 'd' || doc_id AS path, CAST(strlen(text) AS BIGINT) AS size, sha256(text) AS sha256 FROM documents WHERE n_chars > 500) SELECT path, size, sha256 FROM f UNION ALL SELECT NULL, CAST(sum(size) AS BIGINT), sha256(string_agg(sha256, '' ORDER BY path)) FROM f")
def k09_pack(spark, sf):
    files = table(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("path"), F.col("text").cast("binary").alias("content"), "n_chars")
    return sinks.pack(files, F.col("n_chars") > 500)[1]
