"""Queries on records, files, markdown lines and small reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import records as rc
from folio.functions import text as tx
from folio.operators import acquisition as aq
from folio.operators import geometry as ge
from folio.operators import sheets as sh
from folio.operators import verify as ve

from .lifts import table
from .registry import query

K = "o_orderkey"


def orders(spark, sf):
    return table(spark, sf, "orders")


@query("p06_failed_render", "SELECT doc_id, regexp_matches(text, '(?i)site can.t be reached|ERR_TIMED_OUT|ERR_CONNECTION|ERR_NAME_NOT_RESOLVED|took too long to respond|checking your browser|just a moment|Доступ ограничен') OR length(text) < 250 AS failed FROM documents")
def p06_failed_render(spark, sf):
    return table(spark, sf, "documents").select("doc_id", rc.failed_render(F.col("text")).alias("failed"))


@query("p07_signed_end", "SELECT doc_id, regexp_matches(right(text, 400), '(the|der|le) ') AS signed FROM documents")
def p07_signed_end(spark, sf):
    return table(spark, sf, "documents").select("doc_id", rc.signed_end(F.col("text"), "(the|der|le) ").alias("signed"))


@query("p08_inventory", "SELECT doc_id, CAST(len(m) AS BIGINT) AS n, m[1] AS first, m[-1] AS last FROM (SELECT doc_id, regexp_extract_all(text, '[A-Z][a-z]+') AS m FROM documents)")
def p08_inventory(spark, sf):
    n, first, last = rc.inventory(F.col("text"), "[A-Z][a-z]+")
    return table(spark, sf, "documents").select("doc_id", n.alias("n"), first.alias("first"), last.alias("last"))


@query("p09_valid_pdf", "SELECT doc_id, strlen(text) + 5 * CAST(doc_id % 2 = 0 AS INT) > 5000 AND doc_id % 2 = 0 AS ok FROM documents")
def p09_valid_pdf(spark, sf):
    content = F.concat(F.when(F.col("doc_id") % 2 == 0, "%PDF-").otherwise(""), "text").cast("binary")
    return table(spark, sf, "documents").select("doc_id", rc.valid_pdf(content).alias("ok"))


@query("p14_route", r"SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'DONE' WHEN doc_id % 3 = 0 THEN 'OFFICE' WHEN length(regexp_replace(text, '\s+', '', 'g')) > 300 THEN 'TEXT' ELSE 'OCR' END AS route FROM documents")
def p14_route(spark, sf):
    suffix = F.when(F.col("doc_id") % 3 == 0, "docx").otherwise("pdf")
    return table(spark, sf, "documents").select("doc_id", rc.route(F.col("text"), suffix, F.col("doc_id") % 5 == 0).alias("route"))


@query("p15_secrets", r"SELECT doc_id, concat_ws(',', CASE WHEN regexp_matches(text, '-----BEGIN [A-Z ]*PRIVATE KEY-----') THEN 'private_key' END, CASE WHEN regexp_matches(text, '\bAKIA[0-9A-Z]{16}\b') THEN 'access_key' END, CASE WHEN regexp_matches(text, '(?i)\b(password|token|secret|api_key)\s*=\s*\S+') THEN 'assignment' END, CASE WHEN regexp_matches(text, '://[^/\s:@]+:[^/\s:@]+@') THEN 'url_login' END) AS kinds FROM documents")
def p15_secrets(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(rc.secret_kinds(F.col("text")), ",").alias("kinds"))


@query("p17_skipped_lines", "SELECT doc_id, count(*) FILTER (contains(x, '*') OR starts_with(x, '#')) AS skipped FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents) GROUP BY doc_id")
def p17_skipped_lines(spark, sf):
    skip = F.filter(F.split("text", "\n"), rc.skipped_line)
    return table(spark, sf, "documents").select("doc_id", F.size(skip).cast("long").alias("skipped"))


@query("p21_fallback", "SELECT c_custkey, o_orderkey AS hit FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F' UNION ALL SELECT c_custkey, -1 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def p21_fallback(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    first = orders(spark, sf).where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"), F.col(K).alias("hit"))
    return aq.with_fallback(c, first, c.withColumn("hit", F.lit(-1).cast("long")), "c_custkey")


@query("p22_venue_field", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'publicationTitle' WHEN 1 THEN 'proceedingsTitle' WHEN 2 THEN 'bookTitle' ELSE 'publisher' END AS field FROM part")
def p22_venue_field(spark, sf):
    kind = F.when(F.col("p_size") % 4 == 0, "journalArticle").when(F.col("p_size") % 4 == 1, "conferencePaper").when(F.col("p_size") % 4 == 2, "bookSection").otherwise("report")
    return table(spark, sf, "part").select("p_partkey", rc.venue_field(kind).alias("field"))


@query("p23_excerpt", "SELECT doc_id, CAST(length(substr(text, 1, 1000)) AS BIGINT) AS chars, length(text) > 1000 AS truncated, length(text) <= 1000 AND trim(text) <> '' AS complete FROM documents")
def p23_excerpt(spark, sf):
    text, truncated, complete = rc.excerpt_facts(F.col("text"), 1000)
    return table(spark, sf, "documents").select("doc_id", F.length(text).cast("long").alias("chars"), truncated.alias("truncated"), complete.alias("complete"))


@query("x01_partial_date", "SELECT o_orderkey, year(o_orderdate) || CASE WHEN o_orderkey % 3 <> 0 THEN '-' || month(o_orderdate) ELSE '' END || CASE WHEN o_orderkey % 3 = 1 THEN '-' || day(o_orderdate) ELSE '' END AS date FROM orders")
def x01_partial_date(spark, sf):
    d, k = "o_orderdate", F.col(K)
    parts = F.array(F.year(d), F.when(k % 3 != 0, F.month(d)), F.when(k % 3 == 1, F.day(d)))
    return orders(spark, sf).select(K, rc.partial_date(parts).alias("date"))


@query("x02_year", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS year FROM orders")
def x02_year(spark, sf):
    raw = F.when(F.col(K) % 4 == 0, "n.d.").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return orders(spark, sf).select(K, rc.year_of(raw).alias("year"))


@query("x13_item_key", "SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 8, 'K') AS key FROM orders")
def x13_item_key(spark, sf):
    body = F.concat(F.lit('{"successful": {"0": {"key": "'), F.lpad(F.col(K).cast("string"), 8, "K"), F.lit('", "version": 3}}}'))
    return orders(spark, sf).select(K, rc.item_key(body).alias("key"))


@query("x15_png_size", "SELECT o_orderkey, o_orderkey AS width, o_custkey AS height FROM orders")
def x15_png_size(spark, sf):
    hexed = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), F.lpad(F.hex(K), 8, "0"), F.lpad(F.hex("o_custkey"), 8, "0"))
    width, height = rc.png_size(F.unhex(hexed))
    return orders(spark, sf).select(K, width.alias("width"), height.alias("height"))


@query("x11_quarter_sizes", "SELECT size FROM (SELECT DISTINCT l_discount * 100 + 0.25 * (l_linenumber % 4) AS size FROM lineitem) WHERE round(size * 4, 6) = floor(round(size * 4, 6)) AND round(size * 2, 6) <> floor(round(size * 2, 6))")
def x11_quarter_sizes(spark, sf):
    s = table(spark, sf, "lineitem").select((F.col("l_discount") * 100 + 0.25 * (F.col("l_linenumber") % 4)).alias("size")).distinct()
    return s.where(rc.quarter_size(F.col("size")))


@query("f13_portable_path", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'storage:a/' || o_orderkey WHEN 1 THEN 'home:b/' || o_orderkey ELSE '/tmp/' || o_orderkey END AS path FROM orders")
def f13_portable_path(spark, sf):
    raw = F.concat(F.when(F.col(K) % 3 == 0, "/home/u/storage/a/").when(F.col(K) % 3 == 1, "/home/u/b/").otherwise("/tmp/"), F.col(K).cast("string"))
    return orders(spark, sf).select(K, tx.portable_path(raw, {"/home/u/storage": "storage", "/home/u": "home"}).alias("path"))


@query("f14_plain_quote", "SELECT doc_id, trim(regexp_replace(translate('«' || text || '» — *x*', '—–ёЁ«»“”„' || chr(34) || chr(39) || '*_`' || chr(173), '--еЕ'), '\\s+', ' ', 'g')) AS plain FROM documents")
def f14_plain_quote(spark, sf):
    return table(spark, sf, "documents").select("doc_id", ve.plain(F.concat(F.lit("«"), "text", F.lit("» — *x*"))).alias("plain"))


@query("f20_surnames", r"SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(text, '\p{Lu}[\p{L}\p{N}_''\-]+'), lambda x: lower(strip_accents(x))), lambda f: length(f) >= 2 AND f NOT IN ('the', 'of')))), ' ') AS names FROM documents")
def f20_surnames(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(F.array_sort(ve.surnames(F.col("text"), ["the", "of"])), " ").alias("names"))


@query("f37_headings", r"SELECT o_orderkey, CAST(o_orderkey % 4 AS INTEGER) AS level, CASE WHEN o_orderkey % 4 > 0 THEN 'Title ' || o_orderkey ELSE '' END AS text FROM orders")
def f37_headings(spark, sf):
    line = F.concat(F.expr(f"repeat('#', cast({K} % 4 as int))"), F.lit(" Title "), F.col(K))
    level, text = rc.heading(line)
    return orders(spark, sf).select(K, level.cast("int").alias("level"), text.alias("text"))


@query("f42_table_rows", "SELECT p_partkey, p_brand AS venue FROM part WHERE p_size % 2 = 0")
def f42_table_rows(spark, sf):
    line = F.concat(F.lit("| "), F.when(F.col("p_size") % 2 == 0, F.col("p_partkey").cast("string")).otherwise("#"), F.lit(" | "), "p_brand", F.lit(" | c | d | e | f | g | h |"))
    cells = table(spark, sf, "part").select("p_partkey", rc.table_cells(line).alias("c"))
    return cells.where((F.size("c") >= 8) & F.get("c", F.lit(0)).rlike("^[0-9]+$")).select("p_partkey", F.get("c", F.lit(1)).alias("venue"))


@query("f44_without_tags", "SELECT p_partkey, p_name AS title FROM part")
def f44_without_tags(spark, sf):
    return table(spark, sf, "part").select("p_partkey", rc.without_tags(F.concat(F.lit("<i>"), "p_name", F.lit("</i><sub/>"))).alias("title"))


@query("f49_first_authors", "SELECT c_nationkey, array_to_string(list_sort(list(c_name))[1:6], '; ') AS authors FROM customer GROUP BY c_nationkey")
def f49_first_authors(spark, sf):
    return aq.first_names(table(spark, sf, "customer"), "c_nationkey", ["c_name", "c_custkey"], "c_name").withColumnRenamed("names", "authors")


@query("f52_filled_template", "SELECT p_partkey, p_name || ' (' || p_size || ')' AS text FROM part")
def f52_filled_template(spark, sf):
    return table(spark, sf, "part").select("p_partkey", rc.filled(F.lit("{name} ({n})"), {"name": F.col("p_name"), "n": F.col("p_size")}).alias("text"))


@query("f53_cells", r"SELECT p_partkey, p_name || ' \| ' || p_brand AS cell FROM part")
def f53_cells(spark, sf):
    return table(spark, sf, "part").select("p_partkey", rc.cell(F.concat(F.lit(" "), "p_name", F.lit("\n | "), "p_brand")).alias("cell"))


@query("f55_locations", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'p.{' || (o_orderkey % 50) || '}' ELSE 'line ' || o_orderkey END AS at FROM orders")
def f55_locations(spark, sf):
    return orders(spark, sf).select(K, rc.location(F.when(F.col(K) % 2 == 0, F.col(K) % 50), F.col(K)).alias("at"))


@query("f61_lookalikes", "SELECT doc_id, regexp_matches(t, '[А-Яа-яЁё]') AS cyrillic, regexp_matches(t, '[A-Za-z]') AS latin, translate(t, 'АВЕКМНОРСТХаеорсух', 'ABEKMHOPCTXaeopcyx') = replace(t, 'о', 'o') AS safe FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN replace(text, 'o', 'о') ELSE text END AS t FROM documents)")
def f61_lookalikes(spark, sf):
    t = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("o"), F.lit("о"))).otherwise(F.col("text"))
    d = table(spark, sf, "documents").select("doc_id", t.alias("t"))
    return d.select("doc_id", rc.has_cyrillic(F.col("t")).alias("cyrillic"), rc.has_latin(F.col("t")).alias("latin"), (rc.latinised(F.col("t")) == F.replace("t", F.lit("о"), F.lit("o"))).alias("safe"))


@query("f62_compact", r"SELECT doc_id, CAST(length(regexp_replace(text, '\s+', '', 'g')) AS BIGINT) AS chars FROM documents")
def f62_compact(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.length(rc.compact(F.col("text"))).cast("long").alias("chars"))


@query("f72_figures", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN '*' || p_name || '*' ELSE '![' || p_name || '](x.png)' END AS line FROM part")
def f72_figures(spark, sf):
    line = F.concat(F.lit("!["), "p_name", F.when(F.col("p_size") % 2 == 0, "]()").otherwise("](x.png)"))
    return table(spark, sf, "part").select("p_partkey", rc.figure_or_text(line).alias("line"))


@query("k04_creators", "SELECT c_custkey, 'Anna Maria' AS first, 'X' || c_custkey AS last FROM customer")
def k04_creators(spark, sf):
    first, last = rc.creator(F.concat(F.lit(" Anna Maria X"), "c_custkey", F.lit(" ")))
    return table(spark, sf, "customer").select("c_custkey", first.alias("first"), last.alias("last"))


@query("s26_work_list", "SELECT doc_id, doc_id % 4 = 0 AS skipped FROM documents")
def s26_work_list(spark, sf):
    src = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("a/f"), "doc_id", F.lit(".docx")).alias("path"))
    done = src.where("doc_id % 4 = 0").select(F.concat(F.lit("a/f"), "doc_id", F.lit(".md")).alias("path"))
    return aq.work_list(src, done).select("doc_id", "skipped")


@query("s42_first_url", "SELECT url, min(q) AS q FROM (SELECT o_custkey % 97 AS url, o_orderkey AS q FROM orders) GROUP BY url")
def s42_first_url(spark, sf):
    rows = orders(spark, sf).select((F.col("o_custkey") % 97).alias("url"), F.col(K).alias("q"))
    return aq.first_hits(rows, "url", "q")


@query("a19_mean_confidence", "SELECT l_orderkey AS page, avg(CASE WHEN l_linenumber % 2 = 0 THEN l_discount END) AS conf FROM lineitem GROUP BY l_orderkey HAVING avg(CASE WHEN l_linenumber % 2 = 0 THEN l_discount END) > 0 AND avg(CASE WHEN l_linenumber % 2 = 0 THEN l_discount END) < 0.05")
def a19_mean_confidence(spark, sf):
    conf = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_discount"))
    return sh.doubtful_pages(sh.mean_confidence(table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "page"), "page", conf), 0.05)


@query("a28_collection_size", "SELECT o_orderkey, CAST(CASE o_orderkey % 3 WHEN 0 THEN o_orderkey WHEN 1 THEN 2 ELSE -1 END AS BIGINT) AS size FROM orders")
def a28_collection_size(spark, sf):
    k = F.col(K)
    body = F.when(k % 3 == 0, F.concat(F.lit('{"metadata":{"count":'), k, F.lit("}}"))).when(k % 3 == 1, '{"data":[1,2]}').otherwise('{"x":1}')
    return orders(spark, sf).select(K, rc.collection_size(body).alias("size"))


@query("g04_spreads", "SELECT l_orderkey AS page, bool_or(l_quantity / 5 < 4 AND l_quantity / 5 + 1 < 5) AND bool_or(l_quantity / 5 > 5) AS spread FROM lineitem GROUP BY l_orderkey")
def g04_spreads(spark, sf):
    x = F.col("l_quantity") / 5
    return sh.spreads(table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "page"), "page", x, x + 1, F.lit(10.0))


@query("g05_cut_lines", "SELECT l_orderkey AS page, count(*) AS cut FROM lineitem WHERE l_quantity / 5 < 5 AND l_quantity / 5 + 1 + l_tax * 30 > 5 GROUP BY l_orderkey")
def g05_cut_lines(spark, sf):
    x = F.col("l_quantity") / 5
    return sh.cut_lines(table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "page"), "page", x, x + 1 + F.col("l_tax") * 30, F.lit(5))


@query("o09_worst_sheets", "SELECT l_orderkey AS page, count(*) AS cut FROM lineitem WHERE l_quantity / 5 < 5 AND l_quantity / 5 + 1 + l_tax * 30 > 5 GROUP BY l_orderkey ORDER BY cut DESC, page LIMIT 8")
def o09_worst_sheets(spark, sf):
    return sh.worst_sheets(g05_cut_lines(spark, sf), "page")


@query("g08_junk_references", "SELECT o_custkey % 200 AS ref, count(DISTINCT o_orderkey % 1000) AS docs FROM orders GROUP BY ref HAVING count(DISTINCT o_orderkey % 1000) >= 60")
def g08_junk_references(spark, sf):
    return sh.furniture_references(orders(spark, sf).select((F.col("o_custkey") % 200).alias("ref"), (F.col(K) % 1000).alias("doc")), "ref", "doc", 60)


@query("g19_flow_numbers", "SELECT 'documents' AS step, count(*) AS n FROM documents UNION ALL SELECT 'with text', count(*) FROM documents WHERE n_chars > 1000 UNION ALL SELECT 'judged', count(*) FROM documents SEMI JOIN labels USING (doc_id) UNION ALL SELECT 'good', count(*) FROM documents JOIN labels USING (doc_id) WHERE quality = 1")
def g19_flow_numbers(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return aq.flow_numbers(d, {"documents": F.lit(True), "with text": F.col("n_chars") > 1000, "judged": F.col("quality").isNotNull(), "good": F.col("quality") == 1})


@query("u09_canonical_sets", "SELECT c_nationkey, array_to_string(list_sort(list_distinct(list(c_mktsegment))), ',') AS tags FROM customer GROUP BY c_nationkey")
def u09_canonical_sets(spark, sf):
    return aq.canonical_sets(table(spark, sf, "customer"), "c_nationkey", "c_mktsegment").select("c_nationkey", F.array_join("members", ",").alias("tags"))


@query("u12_first_of_equal_texts", "SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def u12_first_of_equal_texts(spark, sf):
    return aq.first_of_equal(table(spark, sf, "documents"), "text", "doc_id")


@query("o12_log_order", "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_id % 3 = 0 THEN '~' ELSE event_type END, event_id) AS place FROM events")
def o12_log_order(spark, sf):
    path = F.when(F.col("event_id") % 3 != 0, F.col("event_type"))
    return aq.in_log_order(table(spark, sf, "events").select("user_id", "event_id", path.alias("path")), "user_id", "path", "event_id").select("event_id", "place")


@query("o11_url_order", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus <> 'F', o_orderkey) AS place FROM orders")
def o11_url_order(spark, sf):
    return aq.in_url_order(orders(spark, sf).select("o_custkey", K, (F.col("o_orderstatus") == "F").alias("best")), "o_custkey", "best", K).select(K, "place")


@query("j14_identifier_join", "WITH ids AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN 'd' || p_partkey END AS doi, 'a' || (p_partkey % 500) || 'v1' AS arxiv FROM part), d AS (SELECT 'd' || p_partkey AS doi, p_partkey AS item FROM part WHERE p_partkey % 2 = 0), a AS (SELECT 'a' || p_partkey AS arxiv, p_partkey + 100000 AS item FROM part WHERE p_partkey < 400) SELECT k, coalesce(d.item, a.item) AS item FROM ids LEFT JOIN d USING (doi) LEFT JOIN a ON a.arxiv = regexp_replace(ids.arxiv, 'v[0-9]+$', '')")
def j14_identifier_join(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    ids = p.select(k.alias("k"), F.when(k % 3 == 0, F.concat(F.lit("d"), k)).alias("doi"), F.concat(F.lit("a"), k % 500, F.lit("v1")).alias("arxiv"))
    none = F.lit(None).cast("string")
    items = p.where(k % 2 == 0).select(k.alias("item"), F.concat(F.lit("d"), k).alias("doi"), none.alias("arxiv")).unionByName(p.where(k < 400).select((k + 100000).alias("item"), none.alias("doi"), F.concat(F.lit("a"), k).alias("arxiv")))
    return aq.by_identifier(ids, items)


@query("j27_family_names", "SELECT c_custkey, len(list_filter(['iva', 'petr'], lambda s: contains(n, s))) > 0 AS agrees FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'ivanov' WHEN c_custkey % 3 = 1 THEN 'petrova' ELSE 'smith' END AS n FROM customer)")
def j27_family_names(spark, sf):
    name = F.when(F.col("c_custkey") % 3 == 0, "Ivanóv").when(F.col("c_custkey") % 3 == 1, "Petrova").otherwise("Smith")
    return table(spark, sf, "customer").select("c_custkey", rc.any_in_names(F.array(F.lit("iva"), F.lit("petr")), F.array(name)).alias("agrees"))
