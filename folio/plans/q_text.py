"""Queries on text overlap, pages, chunks and their statistics."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.functions import text as tx
from folio.operators import overlap as ov
from folio.operators import pages as pg
from folio.operators import sheets as sh
from folio.storage import cut

from .lifts import CHUNKS, PAGES, PAGINATED, SHINGLES, TOKENS, paginated, table
from .registry import query


@query("f02_words", f"WITH {TOKENS} SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(list_distinct(w)) AS BIGINT) AS n_distinct, array_to_string(w[1:12], ' ') AS opening FROM toks")
def f02_words(spark, sf):
    w = tx.words(F.col("text"))
    out = table(spark, sf, "documents").select("doc_id", w.alias("w"))
    return out.select("doc_id", F.size("w").cast("long").alias("n_words"), F.size(F.array_distinct("w")).cast("long").alias("n_distinct"), F.array_join(F.slice("w", 1, 12), " ").alias("opening"))


@query("f56_letter_words", r"SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '\p{L}+')) AS BIGINT) AS n_words FROM documents")
def f56_letter_words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.size(tx.letter_words(F.col("text"))).cast("long").alias("n_words"))


@query("f09_shingles", f"WITH {SHINGLES} SELECT doc_id, count(*) AS n_shingles, count(DISTINCT h) AS n_distinct FROM sh GROUP BY doc_id")
def f09_shingles(spark, sf):
    rows = ov.shingle_rows(table(spark, sf, "documents"), "doc_id", "text")
    return rows.groupBy(F.col("id").alias("doc_id")).agg(F.count("*").alias("n_shingles"), F.countDistinct("h").alias("n_distinct"))


PAIRS = SHINGLES + """, own AS (SELECT DISTINCT doc_id, h FROM sh), sizes AS (SELECT doc_id, count(*) AS n FROM own GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM own a JOIN own b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
pairs AS (SELECT a, b, shared, shared / p.n AS cover_a, shared / q.n AS cover_b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE greatest(shared / p.n, shared / q.n) >= 0.05)"""


@query("j08_shingle_pairs", f"WITH {PAIRS} SELECT a, b, shared FROM shared")
def j08_shingle_pairs(spark, sf):
    return ov.pair_counts(ov.shingle_rows(table(spark, sf, "documents"), "doc_id", "text"))


@query("g11_overlap_pairs", f"WITH {PAIRS} SELECT a, b, shared, cover_a, cover_b FROM pairs")
def g11_overlap_pairs(spark, sf):
    return ov.coverage(ov.shingle_rows(table(spark, sf, "documents"), "doc_id", "text"))


@query("o07_top_pairs", f"WITH {PAIRS} SELECT a, b, greatest(cover_a, cover_b) AS cover FROM pairs ORDER BY cover DESC, a, b LIMIT 50")
def o07_top_pairs(spark, sf):
    return ov.top_pairs(ov.shingle_rows(table(spark, sf, "documents"), "doc_id", "text"))


RUNS = PAIRS + """, sides AS (SELECT CASE WHEN cover_a < cover_b THEN b ELSE a END AS src, CASE WHEN cover_a < cover_b THEN a ELSE b END AS dst FROM pairs),
firsts AS (SELECT doc_id AS dst, h, min(pos) AS first FROM sh GROUP BY ALL),
hits AS (SELECT src, dst, sh.pos, first FROM sides JOIN sh ON sh.doc_id = src JOIN firsts USING (dst, h)),
marked AS (SELECT *, CASE WHEN coalesce(pos - lag(pos) OVER (PARTITION BY src, dst ORDER BY pos), 9) > 8 THEN 1 ELSE 0 END AS new FROM hits),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY src, dst ORDER BY pos) AS run FROM marked),
runs AS (SELECT src, dst, min(pos) AS "start", max(pos) + 8 AS "end", arg_min(first, pos) AS other_start FROM numbered GROUP BY src, dst, run HAVING max(pos) + 8 - min(pos) >= 60)"""


@query("w04_shared_runs", f'WITH {RUNS} SELECT src, dst, CAST("start" AS BIGINT) AS start_word, CAST("end" AS BIGINT) AS end_word, CAST(other_start AS BIGINT) AS other_start FROM runs')
def w04_shared_runs(spark, sf):
    runs = ov.runs_in(table(spark, sf, "documents"), "doc_id", "text")
    return runs.select("src", "dst", F.col("start").cast("long").alias("start_word"), F.col("end").cast("long").alias("end_word"), F.col("other_start").cast("long").alias("other_start"))


@query("w06_longest_runs", f'WITH {RUNS} SELECT src, dst, CAST("start" AS BIGINT) AS start_word, CAST("end" AS BIGINT) AS end_word, k AS run_rank FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY "end" - "start" DESC, "start") AS k FROM runs) WHERE k <= 5')
def w06_longest_runs(spark, sf):
    top = ov.longest_runs(ov.runs_in(table(spark, sf, "documents"), "doc_id", "text"))
    return top.select("src", "dst", F.col("start").cast("long").alias("start_word"), F.col("end").cast("long").alias("end_word"), F.col("rank").cast("long").alias("run_rank"))


@query("w05_first_shingle", f"WITH {SHINGLES} SELECT doc_id, count(*) AS n, CAST(sum(CASE WHEN pos = first THEN 1 ELSE 0 END) AS BIGINT) AS n_first FROM (SELECT doc_id, pos, min(pos) OVER (PARTITION BY doc_id, h) AS first FROM sh) GROUP BY doc_id")
def w05_first_shingle(spark, sf):
    rows = ov.shingle_rows(table(spark, sf, "documents"), "doc_id", "text")
    rows = rows.withColumn("first", F.min("pos").over(Window.partitionBy("id", "h")))
    return rows.groupBy(F.col("id").alias("doc_id")).agg(F.count("*").alias("n"), F.sum((F.col("pos") == F.col("first")).cast("long")).alias("n_first"))


@query("f03_pages", f"WITH {PAGES} SELECT doc_id, page, CAST(length(body) AS BIGINT) AS chars, sha256(body) AS sha FROM pages_t")
def f03_pages(spark, sf):
    pages = pg.split_pages(paginated(spark, sf))
    return pages.select("doc_id", "page", F.length("body").cast("long").alias("chars"), F.sha2(F.col("body").cast("binary"), 256).alias("sha"))


@query("f11_paginate", f"WITH {PAGINATED} SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, sha256(text) AS sha FROM paginated")
def f11_paginate(spark, sf):
    return paginated(spark, sf).select("doc_id", F.length("text").cast("long").alias("chars"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"))


@query("f05_chunks", f"WITH {CHUNKS} SELECT doc_id, page, seq, CAST(length(text) AS BIGINT) AS chars, text FROM chunks_t")
def f05_chunks(spark, sf):
    return pg.chunk_pages(pg.split_pages(paginated(spark, sf))).select("doc_id", "page", "seq", F.col("chars").cast("long").alias("chars"), "text")


@query("a24_expected_chunks", f"WITH {CHUNKS}, c AS (SELECT doc_id, count(*) AS chunks, CAST(sum(length(text)) AS BIGINT) AS chars FROM chunks_t GROUP BY doc_id), p AS (SELECT doc_id, count(*) AS marks FROM pages_t GROUP BY doc_id) SELECT doc_id, marks, coalesce(chunks, 0) AS chunks, coalesce(chars, 0) AS chars FROM p LEFT JOIN c USING (doc_id)")
def a24_expected_chunks(spark, sf):
    pages = pg.split_pages(paginated(spark, sf))
    per_page = pages.select("doc_id", pg.chunks_of(F.col("body")).alias("c"))
    chars = F.aggregate("c", F.lit(0).cast("long"), lambda s, x: s + F.length(x))
    return per_page.groupBy("doc_id").agg(F.count("*").alias("marks"), F.sum(F.size("c").cast("long")).alias("chunks"), F.sum(chars).alias("chars"))


@query("a01_index_stats", f"WITH {CHUNKS} SELECT count(DISTINCT doc_id) AS docs, count(*) AS chunks, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS chars, (SELECT count(*) FROM embeddings) AS vectors, (SELECT CAST(coalesce(sum(len(embedding)), 0) AS BIGINT) // greatest(count(*), 1) FROM embeddings) AS dim FROM chunks_t")
def a01_index_stats(spark, sf):
    chunks = pg.chunk_pages(pg.split_pages(paginated(spark, sf)))
    own = chunks.agg(F.countDistinct("doc_id").alias("docs"), F.count("*").alias("chunks"), F.coalesce(F.sum(F.col("chars").cast("long")), F.lit(0)).alias("chars"))
    vectors = table(spark, sf, "embeddings").agg(F.count("*").alias("vectors"), F.coalesce(F.sum(F.size("embedding").cast("long")), F.lit(0)).alias("dims"))
    return own.crossJoin(vectors).select("docs", "chunks", "chars", "vectors", F.expr("dims div greatest(vectors, 1)").alias("dim"))


@query("a05_assess", rf"WITH {PAGES}, b AS (SELECT doc_id, page, length(regexp_replace(body, '^\s+|\s+$', '', 'g')) AS n FROM pages_t), s AS (SELECT doc_id, count(*) AS pages, CAST(sum(n) AS BIGINT) AS chars, CAST(sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) AS BIGINT) AS empty_pages, arg_max(n, page) AS last FROM b GROUP BY doc_id) SELECT doc_id, pages, chars, empty_pages, chars > 0 AND empty_pages = 0 AS complete, concat_ws('; ', CASE WHEN empty_pages > 0 THEN 'empty pages' END, CASE WHEN last < 20 THEN 'thin last page' END) AS flags FROM s")
def a05_assess(spark, sf):
    return pg.assess(pg.split_pages(paginated(spark, sf)), "doc_id")


@query("g09_page_marks", f"WITH {PAGES} SELECT doc_id, marks, lines_n // 4 AS least_pages, marks >= lines_n // 4 AND NOT failed AS complete FROM (SELECT doc_id, count(*) AS marks, bool_or(body LIKE '%OCR FAILED%') AS failed FROM pages_t GROUP BY doc_id) JOIN (SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS lines_n FROM documents) USING (doc_id)")
def g09_page_marks(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.expr("size(split(text, '\\n')) div 4").cast("long").alias("least_pages"))
    marked = paginated(spark, sf).join(docs, "doc_id")
    return marked.select("doc_id", F.regexp_count("text", F.lit(pg.MARK)).cast("long").alias("marks"), "least_pages", sh.marks_complete(F.col("text"), pg.MARK, F.col("least_pages")).alias("complete"))


@query("s02_document_rows", r"""WITH d AS (SELECT 'topic/' || CASE WHEN doc_id % 3 = 0 THEN lpad(CAST(doc_id AS VARCHAR), 8, 'A') ELSE 'x' || doc_id END || '_t.md' AS path, text FROM documents),
l AS (SELECT path, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls FROM d)
SELECT path, CASE WHEN regexp_full_match(string_split(string_split(path, '/')[-1], '_')[1], '[A-Z0-9]{8}') THEN string_split(string_split(path, '/')[-1], '_')[1] END AS key,
substr(regexp_replace(coalesce(ls[1], ''), '^#+\s*', ''), 1, 300) AS title, sha256(text) AS sha256, CAST(length(text) AS BIGINT) AS chars FROM l""")
def s02_document_rows(spark, sf):
    name = F.when(F.col("doc_id") % 3 == 0, F.lpad(F.col("doc_id").cast("string"), 8, "A")).otherwise(F.concat(F.lit("x"), "doc_id"))
    docs = table(spark, sf, "documents").select(F.concat(F.lit("topic/"), name, F.lit("_t.md")).alias("path"), "text")
    return pg.document_rows(docs)


@query("f10_clean_spaces", r"WITH r AS (SELECT doc_id, regexp_replace(replace('  ' || replace(text, ' of ', chr(160) || ' ' || chr(9) || 'of' || chr(13) || ' ') || chr(10) || chr(10) || chr(10) || chr(10) || ' end ', chr(13), ''), '[ \t' || chr(160) || ']+', ' ', 'g') AS a FROM documents) SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(a, ' ?\n ?', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS sha FROM r")
def f10_clean_spaces(spark, sf):
    rough = F.concat(F.lit("  "), F.replace(F.col("text"), F.lit(" of "), F.lit("  \tof\r ")), F.lit("\n\n\n\n end "))
    return table(spark, sf, "documents").select("doc_id", F.sha2(tx.clean_spaces(rough).cast("binary"), 256).alias("sha"))


@query("f46_dense_copy", r"SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, sha256(array_to_string(l, chr(10))) AS sha FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: rtrim(x)), lambda x: x <> '') AS l FROM documents)")
def f46_dense_copy(spark, sf):
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.rtrim(x)), lambda x: x != "")
    return table(spark, sf, "documents").select("doc_id", F.size(lines).cast("long").alias("n_lines"), F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("sha"))


@query("f69_nonempty_lines", "SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, CAST(length(x) AS BIGINT) AS chars FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE trim(x) <> ''")
def f69_nonempty_lines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "x")).where("trim(x) <> ''").select("doc_id", "line_no", F.length("x").cast("long").alias("chars"))


@query("f12_mixed_share", r"WITH t AS (SELECT doc_id, regexp_extract_all(replace(text, 'oua', 'oиa'), '[A-Za-zА-Яа-яЁё]{3,}') AS w FROM documents) SELECT doc_id, len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]') AND regexp_matches(x, '[А-Яа-яЁё]'))) / greatest(len(w), 1) AS mixed_share FROM t")
def f12_mixed_share(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.mixed_share(F.replace(F.col("text"), F.lit("oua"), F.lit("oиa"))).alias("mixed_share"))


@query("f71_cut", "SELECT doc_id, CASE WHEN length(text) > 80 THEN substr(text, 1, 80) || '…' ELSE text END AS short FROM documents")
def f71_cut(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.cut(F.col("text"), 80).alias("short"))


@query("f48_context", "SELECT doc_id, '…' || trim(substr(text, greatest(p - 47, 0) + 1, p - 1 + 46 - greatest(p - 47, 0))) || '…' AS ctx FROM (SELECT doc_id, text, strpos(text, ' the ') AS p FROM documents) WHERE p > 0")
def f48_context(spark, sf):
    at = F.instr("text", " the ") - 1
    return table(spark, sf, "documents").where(at >= 0).select("doc_id", tx.excerpt(F.col("text"), at).alias("ctx"))


@query("f23_jaccard", f"WITH {TOKENS}, s AS (SELECT doc_id, list_distinct(list_filter(w, lambda x: length(x) >= 3)) AS s FROM toks) SELECT a.doc_id, CASE WHEN len(a.s) = 0 OR len(b.s) = 0 THEN 0.0 ELSE len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))) END AS similarity FROM s a JOIN s b ON b.doc_id = a.doc_id + 1")
def f23_jaccard(spark, sf):
    s = cut(table(spark, sf, "documents").select("doc_id", tx.word_set(F.col("text"), 3).alias("s")))  # both sides of the join read it
    after = s.select((F.col("doc_id") - 1).alias("doc_id"), F.col("s").alias("t"))
    return s.join(after, "doc_id").select("doc_id", tx.jaccard(F.col("s"), F.col("t")).alias("similarity"))


VOWELS = "[ً-ٰٟ]"


@query("f27_same_text", rf"""WITH v AS (SELECT doc_id, text, replace(replace(text, 'e', 'e' || chr(1614)), ' ', '  ') AS marked, replace(replace(text, 'e', chr(1614) || 'e'), 'a', CASE WHEN doc_id % 2 = 0 THEN 'a' ELSE 'a' || chr(1615) END) AS moved FROM documents)
SELECT doc_id, regexp_replace(regexp_replace(marked, '{VOWELS}', '', 'g'), '[\s]+', '', 'g') = regexp_replace(regexp_replace(moved, '{VOWELS}', '', 'g'), '[\s]+', '', 'g') AND list_sort(regexp_extract_all(marked, '{VOWELS}')) = list_sort(regexp_extract_all(moved, '{VOWELS}')) AS same,
 regexp_replace(text, '\s+', '', 'g') = regexp_replace(marked, '\s+', '', 'g') AS unmarked FROM v""")
def f27_same_text(spark, sf):
    """Marks that stand before or behind their letter are the same, one too many isn't."""
    fatha, damma = F.lit("َ"), F.lit("ُ")
    marked = F.replace(F.replace("text", F.lit("e"), F.concat(F.lit("e"), fatha)), F.lit(" "), F.lit("  "))
    moved = F.replace(F.replace("text", F.lit("e"), F.concat(fatha, F.lit("e"))), F.lit("a"), F.when(F.col("doc_id") % 2 == 0, "a").otherwise(F.concat(F.lit("a"), damma)))
    return table(spark, sf, "documents").select("doc_id", tx.same_text(marked, moved).alias("same"), tx.same_text(F.col("text"), marked).alias("unmarked"))


@query("w11_running_state", f"""WITH {PAGINATED}, l AS (SELECT doc_id, unnest(x) AS text, generate_subscripts(x, 1) - 1 AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM paginated)),
m AS (SELECT doc_id, line, CASE WHEN text <> '' AND line % 6 = 1 AND NOT starts_with(text, '{{') THEN '## ' || text ELSE text END AS text FROM l),
f AS (SELECT *, CASE WHEN regexp_full_match(text, '\\{{\\d+\\}}-{{48}}') THEN CAST(regexp_extract(text, '\\d+') AS INTEGER) END AS p, CASE WHEN starts_with(text, '## ') THEN substr(trim(regexp_replace(replace(replace(regexp_extract(text, '^#{{1,6}}\\s+(.*\\S)', 1), '**', ''), '__', ''), '\\s+', ' ', 'g')), 1, 200) END AS h FROM m)
SELECT doc_id, CAST(line AS INTEGER) AS line, last_value(p IGNORE NULLS) OVER w AS page, last_value(h IGNORE NULLS) OVER w AS heading FROM f WINDOW w AS (PARTITION BY doc_id ORDER BY line ROWS UNBOUNDED PRECEDING)""")
def w11_running_state(spark, sf):
    rows = paginated(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    headed = F.when((F.col("text") != "") & (F.col("line") % 6 == 1) & ~F.col("text").startswith("{"), F.concat(F.lit("## "), "text")).otherwise(F.col("text"))
    return pg.running_state(rows.withColumn("text", headed), "doc_id").select("doc_id", "line", "page", "heading")


@query("j23_page_labels", "WITH t AS (SELECT o_custkey AS id, o_orderkey AS pos FROM orders), l AS (SELECT o_custkey AS id, o_orderkey AS pos, 'p.' || o_orderkey AS label FROM orders WHERE o_orderstatus = 'F') SELECT t.id, t.pos, l.label FROM t ASOF LEFT JOIN l ON t.id = l.id AND t.pos >= l.pos")
def j23_page_labels(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("pos"), "o_orderstatus")
    return pg.page_labels(o.select("id", "pos"), o.where("o_orderstatus = 'F'").select("id", "pos", F.concat(F.lit("p."), "pos").alias("label")), "id")
