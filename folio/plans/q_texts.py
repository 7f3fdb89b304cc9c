"""The audit of extracted texts: documents as paged texts, with a manifest of what their extraction recorded."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import audit

from .lifts import PAGINATED, paginated, table
from .registry import query

CHECKED = (
    PAGINATED
    + r""",
texts AS (SELECT d.doc_id AS key, replace(CASE WHEN d.doc_id % 5 = 0 THEN d.text ELSE p.text END, 'tion', CASE WHEN d.doc_id % 6 = 0 THEN 'tiоn' ELSE 'tion' END) AS text FROM documents d JOIN paginated p USING (doc_id)),
facts AS (SELECT key, length(text) AS chars, len(regexp_extract_all(text, '(?m)^\{\d+\}-{48}$')) AS marks, regexp_extract_all(text, '[A-Za-zА-Яа-яЁё]{3,}') AS w FROM texts),
entry AS (SELECT doc_id AS key, CASE doc_id % 4 WHEN 0 THEN 'pdftotext' WHEN 1 THEN 'html' WHEN 2 THEN 'ocr' END AS src, 1 + length(text) - length(replace(text, chr(10), '')) AS lines, doc_id % 7 AS less, length(text) + CASE WHEN doc_id % 9 = 0 THEN 100000 ELSE -10 END AS size, doc_id % 11 = 0 AS truncated, quality = 1 AS complete FROM documents LEFT JOIN labels USING (doc_id) WHERE doc_id % 13 <> 0),
judged AS (SELECT f.key, chars, marks, w, count(*) OVER (PARTITION BY chars) AS alike, coalesce(src, 'pdftotext') = 'pdftotext' AS paged, src, (lines + 3) // 4 + CASE WHEN less = 0 THEN 1 ELSE 0 END AS pages, size, coalesce(truncated, false) AS cut, complete FROM facts f LEFT JOIN entry USING (key))
SELECT key, CASE WHEN marks > 0 THEN marks END AS pages, chars, CASE WHEN marks > 0 THEN chars // marks END AS per_page,
 format('{:.1f}', len(list_filter(w, lambda x: regexp_matches(x, '[А-Яа-яЁё]') AND regexp_matches(x, '[A-Za-z]'))) * 100.0::DOUBLE / greatest(len(w), 1)) AS mixed,
 concat_ws('; ', CASE WHEN paged AND marks = 0 THEN 'no page marks' END, CASE WHEN paged AND marks > 0 AND marks < pages THEN marks || '/' || pages || ' pages' END, CASE WHEN src IN ('pdftotext', 'html') AND chars < size THEN chars || ' < manifest ' || size || ' chars' END,
 CASE WHEN cut THEN 'excerpt' END, CASE WHEN alike >= 3 AND chars > 1000 THEN alike || ' files share length ' || chars END, CASE WHEN NOT complete AND NOT cut THEN 'excerpt' END, CASE WHEN NOT complete THEN 'thin' END) AS why FROM judged"""
)


@query("g12_text_audit", f"WITH {CHECKED}")
def g12_text_audit(spark, sf):
    k, own = F.col("doc_id"), table(spark, sf, "documents")
    both = own.select("doc_id", F.col("text").alias("raw")).join(paginated(spark, sf), "doc_id")
    said = F.when(k % 5 == 0, F.col("raw")).otherwise(F.col("text"))
    texts = both.select(k.alias("key"), F.when(k % 6 == 0, F.replace(said, F.lit("tion"), F.lit("tiоn"))).otherwise(said).alias("text"))
    pages = F.floor((F.size(F.split("text", "\n")) + 3) / 4) + F.when(k % 7 == 0, 1).otherwise(0)
    entry = own.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left").where(k % 13 != 0).select(
        k.alias("key"), F.when(k % 4 == 0, "pdftotext").when(k % 4 == 1, "html").when(k % 4 == 2, "ocr").alias("src"), pages.alias("pages"),
        (F.length("text") + F.when(k % 9 == 0, 100000).otherwise(-10)).alias("size"), (k % 11 == 0).alias("truncated"), (F.col("quality") == 1).alias("complete"), F.array(F.lit("excerpt"), F.lit("thin")).alias("flags"),
    )
    return audit.text_check(texts, entry)
