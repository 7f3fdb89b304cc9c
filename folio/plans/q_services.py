"""Queries on recorded services, listings, whole audits, geometry and the emptied trash."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import text as tx
from folio.operators import audit as au
from folio.operators import discovery as di
from folio.operators import geometry as ge
from folio.operators import lint as li
from folio.operators import search as se
from folio.operators import snapshots as sn
from folio.operators import verify as ve
from folio.sources import readers as rd
from folio.sources import services as sv

from .lifts import PAGES, table
from .q_checks import QUOTES, pages, paras
from .registry import query

# services: a recorded answer per part


def works(spark, sf):
    part = table(spark, sf, "part")
    index = F.map_from_arrays(F.array(F.lit("alpha"), F.lit("beta")), F.array(F.array(F.lit(0), F.lit(2)), F.array(F.lit(1))))
    person = F.struct(F.struct(F.col("p_type").alias("display_name")).alias("author"))
    work = F.struct(
        F.concat(F.lit("W"), "p_partkey").alias("id"), F.concat(F.lit("https://doi.org/10.1/"), "p_partkey").alias("doi"), F.col("p_name").alias("title"), (2000 + F.col("p_size") % 20).alias("publication_year"),
        F.array(*[person] * 8).alias("authorships"), F.struct(F.struct(F.col("p_brand").alias("display_name")).alias("source")).alias("primary_location"),
        F.struct(F.lit(True).alias("is_oa"), F.lit("gold").alias("oa_status"), F.lit("http://x").alias("oa_url")).alias("open_access"), index.alias("abstract_inverted_index"), F.col("p_size").alias("cited_by_count"),
    )
    return part.select("p_partkey", F.concat(F.lit("q"), "p_partkey").alias("request"), work.alias("w"))


WORKS = "'openalex' AS source, 'W' || p_partkey AS id, '10.1/' || p_partkey AS doi, p_name AS title, 'alpha beta alpha' AS abstract, CAST(2000 + p_size % 20 AS INTEGER) AS year, p_brand AS venue, 6 AS n_authors, CAST(p_size AS INTEGER) AS cited_by"


def shown(df):
    return df.select("request", "source", "id", "doi", "title", "abstract", "year", "venue", F.size("authors").alias("n_authors"), "cited_by")


@query("s09_openalex_search", f"SELECT 'q' || p_partkey AS request, {WORKS} FROM part")
def s09_openalex_search(spark, sf):
    return shown(sv.openalex_search(works(spark, sf).select("request", F.to_json(F.struct(F.array("w").alias("results"))).alias("body"))))


@query("s10_openalex_by_doi", f"SELECT 'q' || p_partkey AS request, {WORKS} FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT 'q' || p_partkey, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM part WHERE p_partkey % 3 = 0")
def s10_openalex_by_doi(spark, sf):
    asked = works(spark, sf)
    body = F.when(F.col("p_partkey") % 3 != 0, F.to_json("w"))
    out = sv.openalex_by_doi(asked.select("request"), asked.select("request", body.alias("body")))
    return shown(out).withColumn("n_authors", F.when(F.col("n_authors") >= 0, F.col("n_authors")))


def feed(spark, sf):
    entry = F.concat(F.lit("<feed><entry><id>http://arxiv.org/abs/2401."), "p_partkey", F.lit("v2</id><title>"), "p_name", F.lit("\n part</title><summary>s</summary><published>2024-02-03T00:00:00Z</published><author><name>Ann B. "), "p_brand", F.lit("</name></author><author><name>Solo</name></author></entry></feed>"))
    return table(spark, sf, "part").select(F.concat(F.lit("q"), "p_partkey").alias("request"), entry.alias("body"))


@query("s11_arxiv_entries", "SELECT 'q' || p_partkey AS request, '2401.' || p_partkey AS id, p_name || ' part' AS title, 2024 AS year, '2024-02-03' AS date, 'http://arxiv.org/pdf/2401.' || p_partkey || 'v2.pdf' AS oa_url FROM part")
def s11_arxiv_entries(spark, sf):
    return sv.arxiv_entries(feed(spark, sf)).select("request", "id", "title", "year", "date", "oa_url")


@query("s12_arxiv_creators", "SELECT 'q' || p_partkey AS request, unnest([string_split(p_brand, ' ')[-1], 'Solo']) AS last, unnest([trim('Ann B. ' || array_to_string(string_split(p_brand, ' ')[:-2], ' ')), '']) AS rest FROM part")
def s12_arxiv_creators(spark, sf):
    return sv.arxiv_entries(feed(spark, sf)).select("request", F.explode("creators").alias("c")).select("request", "c.*")


def records(spark, sf):
    one = F.struct(F.concat(F.lit("10.1/"), "p_partkey").alias("DOI"), F.array("p_name").alias("title"), F.array(F.struct(F.lit("A").alias("given"), F.col("p_brand").alias("family"))).alias("author"), F.struct(F.array(F.array(2000 + F.col("p_size") % 20)).alias("date-parts")).alias("issued"))
    return table(spark, sf, "part").select("p_partkey", F.concat(F.lit("q"), "p_partkey").alias("request"), one.alias("r"))


@query("s13_crossref_work", "SELECT 'q' || p_partkey AS request, CASE WHEN p_partkey % 4 <> 0 THEN '10.1/' || p_partkey END AS doi FROM part")
def s13_crossref_work(spark, sf):
    r = records(spark, sf)
    body = F.when(F.col("p_partkey") % 4 != 0, F.to_json(F.struct(F.col("r").alias("message"))))
    return sv.crossref_work(r.select("request"), r.select("request", body.alias("body"))).select("request", F.col("record.DOI").alias("doi"))


@query("s14_crossref_search", "SELECT 'q' || p_partkey AS id, CAST(pos AS INTEGER) AS pos, '10.1/' || p_partkey AS doi, p_name AS title, p_brand AS family, CAST(2000 + p_size % 20 AS INTEGER) AS year FROM part, (SELECT unnest(range(5)) AS pos)")
def s14_crossref_search(spark, sf):
    seven = F.to_json(F.struct(F.struct(F.array(*[F.col("r")] * 7).alias("items")).alias("message")))
    return sv.crossref_search(records(spark, sf).select("request", seven.alias("body")))


@query("s15_open_locations", "SELECT 'q' || p_partkey AS request, CAST(place AS INTEGER) AS place, CASE place WHEN 0 THEN 'http://b/' || p_partkey ELSE 'http://a/x.pdf' END AS url FROM part, (SELECT unnest([0, 1]) AS place)")
def s15_open_locations(spark, sf):
    best = F.struct(F.concat(F.lit("http://b/"), "p_partkey").alias("url"))
    other = F.struct(F.lit("http://a/x.pdf").alias("url_for_pdf"), F.lit("http://a/").alias("url"))
    again = F.struct(F.lit("").alias("url_for_pdf"), F.concat(F.lit("http://b/"), "p_partkey").alias("url"))
    body = F.to_json(F.struct(best.alias("best_oa_location"), F.array(again, other, other).alias("oa_locations")))
    return sv.open_locations(table(spark, sf, "part").select(F.concat(F.lit("q"), "p_partkey").alias("request"), body.alias("body")))


@query("s33_page_chain", """WITH RECURSIVE p AS (SELECT o_custkey AS act, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, o_orderkey AS k, min(o_orderkey) OVER (PARTITION BY o_custkey) AS k0 FROM orders),
t AS (SELECT act, n, CASE WHEN k % 23 = 0 THEN '' WHEN k % 19 = 0 THEN 't' || k0 ELSE 't' || k END AS text, CASE WHEN k % 17 = 0 THEN -1 WHEN k % 5 = 0 THEN n + 2 ELSE n + 1 END AS after FROM p),
walk(act, n, after, texts) AS (SELECT act, n, after, [text] FROM t WHERE n = 1 AND text <> '' UNION ALL SELECT t.act, t.n, t.after, list_append(w.texts, t.text) FROM walk w JOIN t ON t.act = w.act AND t.n = w.after WHERE t.text <> '' AND NOT list_contains(w.texts, t.text))
SELECT act, CAST(n AS INTEGER) AS n FROM walk""")
def s33_page_chain(spark, sf):
    """Chains that branch and skip a page, end, come to an empty page, or repeat their first one's text."""
    k, w = F.col("o_orderkey"), se.Window.partitionBy("o_custkey")
    n = F.row_number().over(w.orderBy("o_orderkey"))
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("act"), n.alias("n"), k.alias("k"), F.min(k).over(w).alias("k0"))
    text = F.when(F.col("k") % 23 == 0, " ").when(F.col("k") % 19 == 0, F.concat(F.lit("t"), "k0")).otherwise(F.concat(F.lit("t"), "k"))
    links = F.when(F.col("k") % 17 == 0, F.array(F.lit(1), F.col("n"))).when(F.col("k") % 5 == 0, F.array(F.col("n") + 4, F.lit(1), F.col("n") + 2, F.col("n") + 3)).otherwise(F.array(F.col("n"), F.col("n") + 2, F.col("n") + 1))
    return sv.page_chain(rows.select("act", "n", text.alias("text"), links.alias("links"))).select("act", "n")


@query("s35_first_acceptable", "SELECT o_custkey AS request, min(o_orderkey) AS try FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey")
def s35_first_acceptable(spark, sf):
    body = F.when(F.col("o_orderstatus") == "F", F.repeat(F.lit("x"), 50)).when(F.col("o_orderstatus") == "O", F.lit("short")).otherwise(F.concat(F.lit("страница не найдена"), F.repeat(F.lit("x"), 50)))
    return sv.first_acceptable(table(spark, sf, "orders").select(F.col("o_custkey").alias("request"), F.col("o_orderkey").alias("try"), body.alias("body")), least=50).select("request", "try")


# listings: a file per order


def listing(spark, sf):
    name = F.when(F.col("o_orderkey") % 4 == 0, "x.pdf").when(F.col("o_orderkey") % 4 == 1, ".zotero-ft-cache").when(F.col("o_orderkey") % 4 == 2, "b.HTM").otherwise("c.html")
    return table(spark, sf, "orders").select(F.concat(F.lit("storage/K"), "o_custkey", F.lit("/"), F.col("o_orderkey"), name).alias("path"), (F.col("o_orderkey") % 3).alias("length"))


LISTING = "ls AS (SELECT 'storage/K' || o_custkey || '/' || o_orderkey || CASE o_orderkey % 4 WHEN 0 THEN 'x.pdf' WHEN 1 THEN '.zotero-ft-cache' WHEN 2 THEN 'b.HTM' ELSE 'c.html' END AS path, o_orderkey % 3 AS length, o_custkey AS k FROM orders)"


@query("s03_collected_files", f"WITH {LISTING} SELECT path FROM ls WHERE regexp_matches(lower(path), '\\.(htm|pdf)$') AND NOT regexp_matches(path, '^storage/K1.*$')")
def s03_collected_files(spark, sf):
    return rd.collect_files(listing(spark, sf), ["htm", "pdf"], ["storage/K1*"]).select("path")


@query("s23_attachments", f"WITH {LISTING}, a AS (SELECT 'K' || k AS key, min(path) FILTER (path LIKE '%.pdf') AS pdf, min(path) FILTER (path LIKE '%.html' OR path LIKE '%.htm') AS html FROM ls GROUP BY k) SELECT * FROM a WHERE pdf IS NOT NULL OR html IS NOT NULL")
def s23_attachments(spark, sf):
    return rd.attachments(listing(spark, sf)).select("key", "pdf", "html").where("pdf is not null or html is not null")


@query("s40_missing_entries", "SELECT l_orderkey AS archive, l_linenumber AS entry, CAST(l_quantity AS BIGINT) AS size FROM lineitem WHERE l_linenumber % 3 = 0")
def s40_missing_entries(spark, sf):
    declared = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("archive"), F.col("l_linenumber").alias("entry"), F.col("l_quantity").cast("long").alias("size"))
    return rd.missing_entries(declared, declared.withColumn("size", F.when(F.col("entry") % 3 == 0, F.lit(-1)).otherwise(F.col("size"))))


# whole checks


@query("f15_source_pages", f"WITH {PAGES}, folio AS (SELECT doc_id AS id, page, 100 + page // 2 AS key FROM pages_t) SELECT id, CAST(key AS INTEGER) AS page, CAST(max(page) AS INTEGER) AS mark FROM folio GROUP BY id, key")
def f15_source_pages(spark, sf):
    own = pages(spark, sf)
    numbered = own.withColumn("body", F.concat(F.lit("mark"), "page", F.lit("\n7\n# body "), "body", F.lit("\n "), F.expr("100 + page div 2"), F.lit(" \n")))
    out = ve.source_pages(numbered)
    return out.select("id", "page", F.regexp_extract("body", r"^mark(\d+)\n", 1).cast("int").alias("mark"))


@query("g13_quote_verification", f"""WITH {QUOTES}, c AS (SELECT s.id, s.n, s.page, s.s, q, len(list_filter(s.s, lambda x: NOT contains(b.body, x))) = 0 AS ok FROM segs s JOIN norm USING (id, n, page) JOIN bodies b ON b.id = s.id AND b.page = s.page),
amb AS (SELECT c.id, count(DISTINCT c.n) AS ambiguous FROM c JOIN bodies b ON b.id = c.id AND b.page <> c.page WHERE c.ok AND len(c.s) > 0 AND len(list_filter(c.s, lambda x: NOT contains(b.body, x))) = 0 GROUP BY c.id)
SELECT c.id, count(*) AS declared, count(*) AS quotes, count(*) FILTER (NOT ok) AS failed, coalesce(any_value(ambiguous), 0) AS ambiguous, CASE WHEN count(*) FILTER (ok) > 0 THEN 'ok' ELSE 'not run' END AS control, count(*) FILTER (NOT ok) = 0 AS passed FROM c LEFT JOIN amb USING (id) GROUP BY c.id""")
def g13_quote_verification(spark, sf):
    w = F.filter(F.split("body", r"\s+"), lambda x: x != "")
    rows = pages(spark, sf).select("id", "page", w.alias("w")).where("size(w) >= 20")
    quote = F.concat(F.when((F.col("id") + F.col("page")) % 7 == 0, "spoiltword ").otherwise(""), F.array_join(F.slice("w", 5, 16), " "))
    block = F.concat(F.lit("> "), quote, F.lit("\n> — p. "), "page", F.lit("\n"))
    drafts = rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("page", block.alias("b")))).alias("b")).select("id", F.array_join(F.transform("b", lambda x: x.b), "\n").alias("text"))
    return ve.verify_quotes(drafts, pages(spark, sf))


def sentences_of(spark, sf):
    return paras(spark, sf).select("doc", F.col("line").alias("i"), F.col("text").alias("key"), tx.letter_words(F.col("text")).alias("w"))


@query("j09_similar_sentences")
def j09_similar_sentences(spark, sf):
    return li.similar_sentences(sentences_of(spark, sf))


TERMS = ["license", "ciudad", "wh"]


@query("f51_unglossed")
def f51_unglossed(spark, sf):
    return li.unglossed(table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "text"), TERMS)


CHECKS = {
    "banned": lambda p: li.banned_hits(p, TERMS, "doc").select("doc", F.concat("term", F.lit(" x"), F.col("times").cast("string")).alias("note")),
    "repeated": lambda p: li.repeated_grams(p.select("doc", "text"), 4, 4).select("doc", F.col("gram").alias("note")),
    "shape": lambda p: li.shape(p, "doc").where("longest > 2000").select("doc", F.col("longest").cast("string").alias("note")),
    "punctuation": lambda p: li.punctuation_density(p, "doc").where("per_100 > 40").select("doc", F.round("per_100", 2).cast("string").alias("note")),
}


@query("v03_only_named_checks")
def v03_only_named_checks(spark, sf):
    return li.prose_report(paras(spark, sf).select("doc", "text"), CHECKS, ["banned", "shape"])


# a mirror: a file per order under its customer, items are the customers


def mirror(spark, sf):
    o = table(spark, sf, "orders")
    letters = F.translate(F.lpad(F.hex("o_custkey"), 8, "0"), "01", "GH")
    files = o.select(F.concat(F.lit("lib/f"), (F.col("o_custkey") % 50).cast("string"), F.lit("/"), letters, F.lit("_"), "o_orderkey", F.lit(".md")).alias("path"))
    c = table(spark, sf, "customer")
    key = F.translate(F.lpad(F.hex("c_custkey"), 8, "0"), "01", "GH")
    items = c.where("c_custkey % 5 <> 0").select(key.alias("key"), (F.col("c_custkey") % 3 == 0).alias("trashed"))
    members = c.select(F.concat(F.lit("n"), "c_nationkey").alias("coll"), key.alias("key"))
    pointers = c.where("c_custkey % 10 = 0").select(F.when(F.col("c_custkey") % 20 == 0, F.concat(F.lit("lib/f"), (F.col("c_custkey") % 50).cast("string"), F.lit(" — all"))).otherwise(F.concat(F.lit("lib/none/"), "c_custkey")).alias("pointer"))
    return files, pointers, items, members


MIRROR = """files AS (SELECT 'lib/f' || (o_custkey % 50) || '/' || translate(lpad(upper(to_hex(o_custkey)), 8, '0'), '01', 'GH') || '_' || o_orderkey || '.md' AS path, translate(lpad(upper(to_hex(o_custkey)), 8, '0'), '01', 'GH') AS key, 'lib/f' || (o_custkey % 50) AS folder FROM orders),
items AS (SELECT translate(lpad(upper(to_hex(c_custkey)), 8, '0'), '01', 'GH') AS key, c_custkey % 3 = 0 AS trashed FROM customer WHERE c_custkey % 5 <> 0),
members AS (SELECT 'n' || c_nationkey AS coll, translate(lpad(upper(to_hex(c_custkey)), 8, '0'), '01', 'GH') AS key FROM customer),
named AS (SELECT DISTINCT 'lib/f' || (c_custkey % 50) AS folder FROM customer WHERE c_custkey % 20 = 0),
state AS (SELECT path, f.key, folder, CASE WHEN trashed IS NULL THEN 'absent' WHEN trashed THEN 'trash' ELSE 'live' END AS state FROM files f LEFT JOIN items i ON f.key = i.key),
judged AS (SELECT s.*, state = 'live' OR n.folder IS NOT NULL AS covered FROM state s LEFT JOIN named n ON n.folder = s.folder),
gap AS (SELECT coll, count(*) AS total, count(*) FILTER (key IN (SELECT key FROM state WHERE state = 'live')) AS have FROM members GROUP BY coll),
rolled AS (SELECT folder, count(*) AS total, count(*) FILTER (NOT covered) AS bad FROM judged GROUP BY folder),
whole AS (SELECT 'lib' AS folder, (SELECT count(*) FROM judged) AS total WHERE (SELECT count(*) FROM judged WHERE covered) = 0 UNION ALL SELECT folder, total FROM rolled WHERE total = bad AND (SELECT count(*) FROM judged WHERE covered) > 0),
missing AS (SELECT DISTINCT 'lib/none/' || c_custkey AS pointer, 'lib/none/' || c_custkey AS target FROM customer WHERE c_custkey % 10 = 0 AND c_custkey % 20 <> 0
 UNION SELECT DISTINCT n.folder || ' — all', n.folder FROM named n WHERE n.folder NOT IN (SELECT folder FROM files)),
report AS (SELECT 'orphan' AS section, path AS subject, state AS detail FROM state WHERE state <> 'live' UNION ALL SELECT 'uncovered', path, '' FROM judged WHERE NOT covered UNION ALL SELECT 'folder', folder, CAST(total AS VARCHAR) FROM whole
 UNION ALL SELECT 'missing', pointer, target FROM missing UNION ALL SELECT 'gap', coll, have || ' of ' || total FROM gap WHERE have > 0 AND have < total)"""


@query("g01_whole_mirror_audit", f"WITH {MIRROR} SELECT * FROM report")
def g01_whole_mirror_audit(spark, sf):
    return au.mirror_audit(*mirror(spark, sf))


@query("k11_audit_gate", f"WITH {MIRROR} SELECT count(*) AS findings, count(*) FILTER (section IN ('orphan', 'missing', 'uncovered')) = 0 AS passed FROM report")
def k11_audit_gate(spark, sf):
    return au.audit_passes(au.mirror_audit(*mirror(spark, sf)))


MANIFEST = """top AS (SELECT 'C' || c_custkey AS key, c_mktsegment AS kind, c_name AS title, CASE WHEN c_nationkey % 3 <> 0 THEN n_name END AS creator, CASE WHEN c_nationkey % 2 = 0 THEN 1990 + c_nationkey END AS year, c_acctbal < 0 AS trashed, c_nationkey, c_mktsegment
 FROM customer JOIN nation ON n_nationkey = c_nationkey),
kids AS (SELECT 'C' || o_custkey AS key, count(*) FILTER (o_orderstatus = 'O') AS atts, count(*) FILTER (o_orderstatus = 'F') AS notes FROM orders WHERE o_totalprice >= 50000 GROUP BY o_custkey),
kinds AS (SELECT kind, count(*) AS n FROM (SELECT kind FROM top WHERE NOT trashed UNION ALL SELECT CASE o_orderstatus WHEN 'O' THEN 'attachment' WHEN 'F' THEN 'note' ELSE 'annotation' END FROM orders WHERE o_totalprice >= 50000) GROUP BY kind),
colls AS (SELECT 'n' || n_nationkey AS key, r_name || ' / ' || n_name AS path FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'r' || r_regionkey, r_name FROM region),
lines_t AS (SELECT t.*, '- `' || t.key || '` ' || kind || ' — ' || coalesce(creator || ' ', '') || coalesce('(' || year || ') ', '') || title || CASE WHEN coalesce(atts, 0) > 0 OR coalesce(notes, 0) > 0 THEN ' [' || concat_ws(', ', CASE WHEN atts > 0 THEN atts || ' att' END, CASE WHEN notes > 0 THEN notes || ' note' END) || ']' ELSE '' END AS line
 FROM top t LEFT JOIN kids USING (key) WHERE NOT trashed),
filed AS (SELECT key, 'n' || c_nationkey AS coll FROM top WHERE NOT trashed AND c_mktsegment <> 'MACHINERY'),
manifest AS (SELECT 0 AS part, '' AS section, 1 AS place, '- Items (excl. trash): ' || (SELECT sum(n) FROM kinds) || ' — top-level ' || (SELECT count(*) FROM top WHERE NOT trashed) || ', child attachments ' || coalesce((SELECT n FROM kinds WHERE kind = 'attachment'), 0) || ', child notes ' || coalesce((SELECT n FROM kinds WHERE kind = 'note'), 0) AS line
 UNION ALL SELECT 0, '', 2, '- Collections: ' || count(*) FROM colls
 UNION ALL SELECT 0, '', 3, '- Trash: ' || ((SELECT count(*) FROM top WHERE trashed) + (SELECT count(*) FROM orders WHERE o_totalprice < 50000))
 UNION ALL SELECT 1, '', row_number() OVER (ORDER BY n DESC, kind), '- ' || kind || ': ' || n FROM kinds
 UNION ALL SELECT 2, '', row_number() OVER (ORDER BY lower(path), key), '- `' || key || '` ' || path || ' — ' || coalesce(c, 0) || ' items' FROM colls LEFT JOIN (SELECT coll AS key, count(*) AS c FROM filed GROUP BY coll) USING (key)
 UNION ALL SELECT 3, path || ' (`' || coll || '`)', row_number() OVER (PARTITION BY coll ORDER BY lower(title), l.key), line FROM lines_t l JOIN filed f ON f.key = l.key JOIN colls c ON c.key = f.coll
 UNION ALL SELECT 4, 'Unfiled (no collection)', row_number() OVER (ORDER BY lower(title), key), line FROM lines_t WHERE c_mktsegment = 'MACHINERY'
 UNION ALL SELECT 5, 'Trash', row_number() OVER (ORDER BY key), line FROM (SELECT key, '- `' || key || '` ' || kind || ' — ' || title AS line FROM top WHERE trashed UNION ALL SELECT 'O' || o_orderkey, '- `O' || o_orderkey || '` ' || CASE o_orderstatus WHEN 'O' THEN 'attachment' WHEN 'F' THEN 'note' ELSE 'annotation' END || ' — order ' || o_orderkey FROM orders WHERE o_totalprice < 50000))"""


def manifest(spark, sf):
    """Customers as items of which those in debt are trashed, their orders as children of which cheap ones are trashed, nations in
    regions as collections; machinery is filed nowhere."""
    r, n, c, o = (table(spark, sf, t) for t in ("region", "nation", "customer", "orders"))
    nodes = r.select(F.concat(F.lit("r"), "r_regionkey").alias("key"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("name")).unionByName(n.select(F.concat(F.lit("n"), "n_nationkey").alias("key"), F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.col("n_name").alias("name")))
    key, nation = F.concat(F.lit("C"), "c_custkey").alias("key"), F.col("c_nationkey")
    own = c.join(n, nation == F.col("n_nationkey")).select(key, F.col("c_mktsegment").alias("kind"), F.col("c_name").alias("title"), F.when(nation % 3 != 0, F.col("n_name")).alias("creator"), F.when(nation % 2 == 0, nation + 1990).cast("string").alias("year"), F.lit(None).cast("string").alias("parent"), (F.col("c_acctbal") < 0).alias("trashed"))
    none = F.lit(None).cast("string")
    kind = F.when(F.col("o_orderstatus") == "O", "attachment").when(F.col("o_orderstatus") == "F", "note").otherwise("annotation")
    kids = o.select(F.concat(F.lit("O"), "o_orderkey").alias("key"), kind.alias("kind"), F.concat(F.lit("order "), "o_orderkey").alias("title"), none.alias("creator"), none.alias("year"), F.concat(F.lit("C"), "o_custkey").alias("parent"), (F.col("o_totalprice") < 50000).alias("trashed"))
    members = c.where("c_mktsegment <> 'MACHINERY'").select(F.concat(F.lit("n"), "c_nationkey").alias("coll"), key)
    return au.library_manifest(own.unionByName(kids), sn.paths(nodes), members)


@query("g02_whole_manifest", f"WITH {MANIFEST} SELECT part, section, place, line FROM manifest")
def g02_whole_manifest(spark, sf):
    return manifest(spark, sf)


@query("k10_manifest_text", f"WITH {MANIFEST} SELECT line AS value FROM manifest UNION ALL SELECT unnest(['## Totals', '### Items by type', '## Collections', '## Items by collection']) UNION ALL SELECT CASE part WHEN 5 THEN '## ' ELSE '### ' END || section || ' — ' || count(*) || ' items' FROM manifest WHERE section <> '' GROUP BY part, section")
def k10_manifest_text(spark, sf):
    return au.manifest_text(manifest(spark, sf))


@query("u14_collection_payloads", """SELECT 'n' || n_nationkey AS key, '{"name":"' || n_name || '","parent":"r' || n_regionkey || '","relations":[' || coalesce((SELECT string_agg('"' || x || '"', ',' ORDER BY x) FROM (SELECT DISTINCT 's' || (s_suppkey % 5) AS x FROM supplier WHERE s_nationkey = n_nationkey)), '') || ']}' AS payload FROM nation""")
def u14_collection_payloads(spark, sf):
    collections = table(spark, sf, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("key"), F.col("n_name").alias("name"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    relations = table(spark, sf, "supplier").select(F.concat(F.lit("n"), "s_nationkey").alias("key"), F.concat(F.lit("s"), (F.col("s_suppkey") % 5).cast("string")).alias("relation"))
    return sn.collection_payload(collections, relations)


@query("j34_note_keys", "SELECT 'K' || o_orderkey AS key FROM orders WHERE o_custkey = 7")
def j34_note_keys(spark, sf):
    o = table(spark, sf, "orders")
    items = o.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("K"), "o_orderkey").alias("key")).unionByName(table(spark, sf, "customer").select((-F.col("c_custkey")).alias("id"), F.concat(F.lit("C"), "c_custkey").alias("key")))
    return sn.note_keys(o.select(F.col("o_orderkey").alias("item"), (-F.col("o_custkey")).alias("parent")), items, "C7")


@query("g18_emptied_trash", """WITH nodes AS (SELECT 'c' || c_custkey AS key, CAST(NULL AS VARCHAR) AS parent, c_custkey AS c FROM customer UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, o_custkey FROM orders),
gone AS (SELECT key FROM nodes WHERE c % 6 = 0) SELECT 'nodes' AS what, count(*) AS n FROM nodes WHERE key NOT IN (SELECT key FROM gone) UNION ALL SELECT 'removed', count(*) FROM gone
UNION ALL SELECT 'memberships', count(*) FROM customer WHERE c_custkey % 6 <> 0 UNION ALL SELECT 'tags', count(DISTINCT o_totalprice) FROM orders WHERE o_custkey % 6 <> 0 UNION ALL SELECT 'problems', 0""")
def g18_emptied_trash(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    customer = F.concat(F.lit("c"), "c_custkey")
    nodes = c.select(customer.alias("key"), F.lit(None).cast("string").alias("parent")).unionByName(o.select(F.concat(F.lit("o"), "o_orderkey").alias("key"), F.concat(F.lit("c"), "o_custkey").alias("parent")))
    members = c.select(F.col("c_nationkey").alias("coll"), customer.alias("key"))
    uses = o.select(F.concat(F.lit("o"), "o_orderkey").alias("key"), F.col("o_totalprice").cast("string").alias("tag"))
    left = sn.empty_trash(nodes, c.where("c_custkey % 6 = 0").select(customer.alias("key")), members, {"tags": (uses.select("tag").distinct(), uses, "tag")})
    out = None
    for name, df in left.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("g17_resolved_dois", r"""WITH w AS (SELECT p_partkey AS id, p_name AS title, CASE WHEN p_partkey % 17 <> 0 THEN n_name ELSE '' END AS author, CASE WHEN p_partkey % 13 <> 0 THEN 1994 + p_size % 9 END AS year FROM part JOIN nation ON n_nationkey = p_partkey % 25),
c AS (SELECT l_partkey AS id, l_suppkey AS pos, '10.1/' || l_partkey || '.' || l_suppkey AS doi, CASE WHEN max(l_quantity) > 25 THEN any_value(p_name) ELSE any_value(p_type) || ' other words ' || any_value(p_name) END AS title, any_value(n_name) AS family, year(min(l_shipdate)) AS year
 FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL),
b AS (SELECT w.id, pos, doi, list_distinct(regexp_extract_all(lower(w.title), '[a-z0-9]+')) AS a, list_distinct(regexp_extract_all(lower(c.title), '[a-z0-9]+')) AS z, author <> '' AND contains(lower(family), lower(author)) AS author_ok, abs(w.year - c.year) AS apart FROM w JOIN c USING (id)),
o AS (SELECT *, len(list_intersect(a, z)) / greatest(len(a), 1) AS overlap FROM b),
best AS (SELECT *, overlap + CASE WHEN author_ok THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END - 0.08::DOUBLE * least(coalesce(apart, 0), 3) AS score FROM o QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, pos) = 1)
SELECT w.id, CASE WHEN coalesce(overlap >= 0.55 AND author_ok AND apart <= 2, false) THEN 'resolved' ELSE 'unresolved' END AS status, doi FROM w LEFT JOIN best USING (id)""")
def g17_resolved_dois(spark, sf):
    """Parts as wanted works of a nation; what their suppliers delivered are candidates, by the suppliers' nations."""
    part, n, s = table(spark, sf, "part"), table(spark, sf, "nation"), table(spark, sf, "supplier")
    k = F.col("p_partkey")
    wanted = part.join(n, k % 25 == F.col("n_nationkey")).select(k.alias("id"), F.col("p_name").alias("title"), F.when(k % 17 != 0, F.col("n_name")).alias("author"), F.when(k % 13 != 0, 1994 + F.col("p_size") % 9).alias("year"))
    lines = table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.max("l_quantity").alias("q"), F.year(F.min("l_shipdate")).alias("year"))
    rows = lines.join(part, F.col("l_partkey") == k).join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    title = F.when(F.col("q") > 25, F.col("p_name")).otherwise(F.concat("p_type", F.lit(" other words "), "p_name"))
    found = rows.select(k.alias("id"), F.col("l_suppkey").alias("pos"), F.concat(F.lit("10.1/"), "l_partkey", F.lit("."), "l_suppkey").alias("doi"), title.alias("title"), F.col("n_name").alias("family"), "year")
    return di.resolve_dois(wanted, found).select("id", "status", "doi")


# geometry: a page of pixels per supplier and part, spines per order


@query("a20_content_boxes", "WITH px AS (SELECT l_orderkey AS id, l_linenumber AS x, CAST(l_quantity AS INTEGER) % 10 AS y, CAST(l_discount * 1000 AS INTEGER) AS gray FROM lineitem), dark AS (SELECT * FROM px WHERE gray < 60), c AS (SELECT id, x FROM dark GROUP BY ALL HAVING count(*) >= 1), r AS (SELECT id, y FROM dark GROUP BY ALL HAVING count(*) >= 1) SELECT id, CAST(x0 AS INTEGER) AS x0, CAST(y0 AS INTEGER) AS y0, CAST(x1 AS INTEGER) AS x1, CAST(y1 AS INTEGER) AS y1 FROM (SELECT id, min(x) AS x0, max(x) + 1 AS x1 FROM c GROUP BY id) JOIN (SELECT id, min(y) AS y0, max(y) + 1 AS y1 FROM r GROUP BY id) USING (id)")
def a20_content_boxes(spark, sf):
    px = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("int").alias("x"), (F.col("l_quantity").cast("int") % 10).alias("y"), F.round(F.col("l_discount") * 1000).cast("int").alias("gray"))
    return ge.content_box(px, 60, 0.01, 8, 10)


@query("a22_spines", "SELECT o_custkey, list_sort(list(o_totalprice))[count(*) // 2 + 1] AS median, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY o_custkey")
def a22_spines(spark, sf):
    return ge.spine_range(table(spark, sf, "orders"), "o_custkey", "o_totalprice")


@query("a18_spread_clusters")
def a18_spread_clusters(spark, sf):
    v = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_extendedprice").cast("double")).alias("v"))
    return v.select("l_orderkey", F.explode(ge.spread_clusters(F.col("v"), 5000.0)).alias("c")).select("l_orderkey", "c.*")


@query("o06_failures_first", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'late' ELSE '' END AS why FROM orders")
def o06_failures_first(spark, sf):
    return au.failures_first(table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "late").otherwise("").alias("why")), "why", "o_orderkey")


# rerank: counts of letters stand for a model


def letters(text):
    return F.transform(F.split(F.lit("a e i o n r s t"), " "), lambda c: F.regexp_count(F.lower(text), c).cast("double"))


@query("x17_reranked")
def x17_reranked(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("cid"), "text")
    hits = se.bm25(se.postings(docs), "this and pour worthless")
    return se.rerank(hits, docs, "this and pour worthless", letters).select("cid", F.round("score", 6).alias("score"))
