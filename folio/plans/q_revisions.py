"""Queries on HTML, revisions, conversations, sinks and incremental jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import records as rc
from folio.operators import acquisition as aq
from folio.operators import align as al
from folio.operators import markup as mk
from folio.sources import readers, sinks
from folio.streaming import jobs

from .lifts import table
from .registry import query


@query("f28_html_markdown")
def f28_html_markdown(spark, sf):
    return table(spark, sf, "pages").select("page_id", mk.markdown_of("html").alias("markdown"))


@query("f31_html_text", r"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->', ' ', 'gs'), '<script\b[^>]*>.*?</script\s*>', ' ', 'gsi'), '<style\b[^>]*>.*?</style\s*>', ' ', 'gsi'), '<noscript\b[^>]*>.*?</noscript\s*>', ' ', 'gsi'), '<nav\b[^>]*>.*?</nav\s*>', ' ', 'gsi'), '<header\b[^>]*>.*?</header\s*>', ' ', 'gsi'), '<footer\b[^>]*>.*?</footer\s*>', ' ', 'gsi') AS t FROM pages),
b AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(t, '<br\s*/?>|</(p|div|li|tr|h[1-6]|table|ul|ol)\s*>', chr(10), 'gi'), '<[^>]*>', ' ', 'g'), '[ \t' || chr(160) || ']+', ' ', 'g') AS t FROM a)
SELECT page_id, regexp_replace(regexp_replace(t, ' ?\n[ \n]*', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS text FROM b""")
def f31_html_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", mk.text_of(F.col("html")).alias("text"))


@query("f33_html_links")
def f33_html_links(spark, sf):
    return table(spark, sf, "pages").select("page_id", mk.links_text(F.col("html"), F.col("url")).alias("text"))


@query("f36_similarity_ratio")
def f36_similarity_ratio(spark, sf):
    return table(spark, sf, "part").select("p_partkey", al.ratio("p_name", "p_type").alias("ratio"))


def revisions(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("pos"), "text")
    returned = c.where("(doc + pos) % 9 <> 0").withColumn("text", F.when(F.col("pos") % 4 == 1, F.concat("text", F.lit(" edited"))).otherwise(F.col("text")))
    master = c.where("(doc + pos) % 11 <> 0").withColumn("text", F.when(F.col("pos") % 6 == 1, F.concat("text", F.lit(" mine"))).otherwise(F.col("text")))
    return c, returned, master


@query("d01_align")
def d01_align(spark, sf):
    sent, returned, _ = revisions(spark, sf)
    side = lambda df, s: df.select("doc", F.lit(s).alias("side"), "pos", "text")
    return al.align_documents(side(sent, "a").unionByName(side(returned, "b")))


@query("g16_three_way_merge")
def g16_three_way_merge(spark, sf):
    return al.three_way(*revisions(spark, sf))


@query("d02_verdicts", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'DROPPED' WHEN o_orderkey % 7 = 0 OR o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 7 = 0 THEN 'ACCEPT' END WHEN o_orderkey % 2 <> 0 THEN 'MINE' WHEN o_orderkey % 4 = 0 THEN 'CONVERGED' ELSE 'CONFLICT' END AS verdict FROM orders")
def d02_verdicts(spark, sf):
    k = F.col("o_orderkey")
    base = F.lit("base")
    theirs = F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 2 == 0, "edit").otherwise("base")
    mine = F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 3 == 0, "base").when((k % 4 == 0) & (k % 2 == 0), "edit").otherwise("other")
    return table(spark, sf, "orders").select("o_orderkey", al.verdict(base, theirs, mine).alias("verdict"))


@query("d04_marked_words")
def d04_marked_words(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    return d.select("doc_id", "line", al.marked("t", F.replace("t", F.lit(" the "), F.lit(" a "))).alias("marked"))


@query("w17_last_turn", "SELECT conv_id, arg_max(text, turn) AS text FROM conversations WHERE role = 'user' GROUP BY conv_id")
def w17_last_turn(spark, sf):
    return table(spark, sf, "conversations").where("role = 'user'").groupBy("conv_id").agg(F.max_by("text", "turn").alias("text"))


@query("a26_conversation_shape", "SELECT conv_id, string_agg(role || ':' || length(text), ' ' ORDER BY turn) AS shape FROM conversations GROUP BY conv_id")
def a26_conversation_shape(spark, sf):
    return aq.conversation_shapes(table(spark, sf, "conversations"))


@query("p20_any_long_turn", "SELECT conv_id, bool_or(length(text) > 400) AS long_turn FROM conversations GROUP BY conv_id")
def p20_any_long_turn(spark, sf):
    return aq.any_turn(table(spark, sf, "conversations"), F.length("text") > 400, "long_turn")


@query("a25_tool_calls", "SELECT user_id AS conv, CAST(event_id % 2 AS INTEGER) AS index, arg_max(event_type, event_id) FILTER (event_type <> 'view') AS name, string_agg(event_id % 10, '' ORDER BY event_id) AS arguments FROM events GROUP BY ALL")
def a25_tool_calls(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("conv"), (F.col("event_id") % 2).cast("int").alias("index"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("name"), (F.col("event_id") % 10).cast("string").alias("arguments"), F.col("event_id").alias("seq"))
    return jobs.tool_calls(e)


@query("t04_todo", "SELECT doc_id AS id FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 6 = 0")
def t04_todo(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    state = d.select("id", (F.col("id") % 3 == 0).alias("complete"), F.when(F.col("id") % 6 == 0, "HTTP 413").alias("error"))
    return jobs.todo(d, state)


@query("k07_keep_if_empty", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'old' END ELSE text END AS text, CAST(CASE WHEN doc_id % 3 = 0 AND doc_id % 2 = 0 THEN -1 WHEN doc_id % 3 = 0 THEN 0 ELSE length(text) END AS BIGINT) AS status FROM documents")
def k07_keep_if_empty(spark, sf):
    new = F.when(F.col("doc_id") % 3 == 0, " ").otherwise(F.col("text"))
    old = F.when(F.col("doc_id") % 2 == 0, "old")
    text, status = sinks.keep_if_empty(new, old)
    return table(spark, sf, "documents").select("doc_id", text.alias("text"), status.cast("long").alias("status"))


@query("k05_byte_budget")
def k05_byte_budget(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.octet_length(sinks.byte_budget(F.col("text"), F.lit(120))).cast("long").alias("bytes"))


@query("k09_file_manifest", "SELECT 'd' || doc_id AS path, CAST(strlen(text) AS BIGINT) AS size, sha256(text) AS sha256 FROM documents")
def k09_file_manifest(spark, sf):
    return sinks.file_manifest(table(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("path"), F.col("text").cast("binary").alias("content")))


@query("s18_payload_shapes", "SELECT o_orderkey, 'k' || o_orderkey AS key FROM orders")
def s18_payload_shapes(spark, sf):
    k = F.col("o_orderkey")
    items = F.concat(F.lit('[{"key":"k'), k, F.lit('"}]'))
    body = F.when(k % 3 == 0, F.concat(F.lit('{"data":'), items, F.lit("}"))).when(k % 3 == 1, F.concat(F.lit('{"items":'), items, F.lit("}"))).otherwise(items)
    return table(spark, sf, "orders").select("o_orderkey", F.explode(readers.payload_rows(body, "struct<key:string>")).alias("x")).select("o_orderkey", "x.key")


@query("x12_tool_result", "SELECT o_orderkey, 'text ' || o_orderkey AS text FROM orders")
def x12_tool_result(spark, sf):
    body = F.concat(F.lit('{"result":{"content":[{"type":"text","text":"text '), "o_orderkey", F.lit('"}]}}'))
    return table(spark, sf, "orders").select("o_orderkey", readers.tool_result(body).alias("text"))


@query("x14_event_lines", "SELECT o_orderkey, CAST(i AS INTEGER) AS i, 'x' || (o_orderkey + i) AS data FROM orders, (SELECT unnest([0, 1]) AS i)")
def x14_event_lines(spark, sf):
    k = F.col("o_orderkey")
    body = F.concat(F.lit("event: m\ndata: x"), k, F.lit("\r\n\r\ndata:x"), k + 1, F.lit("\ndata: [DONE]\n"))
    return table(spark, sf, "orders").select("o_orderkey", F.posexplode(readers.event_lines(body)).alias("i", "data"))


@query("s19_form_feeds", "SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS pages FROM documents")
def s19_form_feeds(spark, sf):
    text = F.concat(F.replace("text", F.lit("\n"), F.lit("\f")), F.lit("\f"))
    return table(spark, sf, "documents").select("doc_id", F.size(readers.page_marks_of_form_feeds(text)).cast("long").alias("pages"))


@query("s22_source_precedence", "SELECT doc_id, CASE WHEN quality = 1 THEN 'pdf' WHEN toxic = 1 THEN 'cache' WHEN n_chars > 500 THEN 'html' END AS src FROM documents LEFT JOIN labels USING (doc_id)")
def s22_source_precedence(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return d.select("doc_id", rc.first_source({"pdf": F.col("quality") == 1, "cache": F.col("toxic") == 1, "html": F.col("n_chars") > 500}).alias("src"))


@query("j26_manifest_reasons", "SELECT doc_id, concat_ws('; ', CASE WHEN quality IS NULL THEN 'not extracted' END, CASE WHEN quality = 0 THEN 'incomplete' END, CASE WHEN n_chars < 200 THEN 'short' END) AS why FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR quality = 0 OR n_chars < 200")
def j26_manifest_reasons(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    why = rc.reasons({"not extracted": F.col("quality").isNull(), "incomplete": F.col("quality") == 0, "short": F.col("n_chars") < 200})
    return d.select("doc_id", why.alias("w")).where("size(w) > 0").select("doc_id", F.array_join("w", "; ").alias("why"))


@query("j33_manifest_refresh", "SELECT doc_id, 'new' AS src FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, 'old' FROM documents WHERE doc_id % 2 = 0 AND doc_id % 3 <> 0")
def j33_manifest_refresh(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    current, previous = d.where("doc_id % 3 = 0").withColumn("src", F.lit("new")), d.where("doc_id % 2 = 0").withColumn("src", F.lit("old"))
    return aq.refreshed(current, previous, "doc_id")


@query("p01_live_items", "SELECT c_custkey, o_custkey IS NOT NULL AS trashed FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ON o_custkey = c_custkey WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def p01_live_items(spark, sf):
    gone = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return aq.live_items(table(spark, sf, "customer"), gone, "c_custkey", "c_mktsegment", ("BUILDING", "MACHINERY"))
