"""Queries of the mirror audit, the library manifest and discovery."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.operators import acquisition as aq
from folio.operators import audit as au
from folio.operators import discovery as di
from folio.operators.numbering import numbered

from .lifts import table
from .registry import query

#: files: a path per order; pointers: nations and some customers; live: some keys
FILES = """files AS (SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'top' || o_orderkey || '.md' ELSE 'n' || (o_custkey % 25) || '/c' || o_custkey || '/' || CASE WHEN o_orderkey % 3 = 0 THEN lpad(CAST(o_orderkey AS VARCHAR), 8, 'K') ELSE 'f' || o_orderkey END || CASE WHEN o_orderkey % 11 = 0 THEN '.json' ELSE '_x.md' END END AS path, o_orderkey, o_custkey FROM orders),
pointers AS (SELECT 'n' || n_nationkey AS pointer FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT 'n' || (c_custkey % 25) || '/c' || c_custkey FROM customer WHERE c_custkey % 4 = 0),
anc AS (SELECT path, array_to_string(p[1:k], '/') AS folder FROM (SELECT path, string_split(path, '/') AS p, unnest(range(1, len(string_split(path, '/')))) AS k FROM files)),
keys AS (SELECT path, nullif(regexp_extract(regexp_replace(string_split(path, '/')[-1], '\\.[^.]*$', ''), '^([2-9A-NP-Z]{8})(?:_|$)', 1), '') AS key FROM files),
live AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, 'K') AS key FROM orders WHERE o_orderkey % 6 = 0),
cov AS (SELECT path, path IN (SELECT pointer FROM pointers) OR regexp_replace(path, '\\.[^./]*$', '') IN (SELECT pointer FROM pointers) OR path IN (SELECT path FROM anc WHERE folder IN (SELECT pointer FROM pointers)) OR path IN (SELECT path FROM keys WHERE key IN (SELECT key FROM live)) AS covered FROM files)""".replace("\\\\", "\\")


def files(spark, sf):
    o = F.col("o_orderkey")
    name = F.when(o % 3 == 0, F.lpad(o.cast("string"), 8, "K")).otherwise(F.concat(F.lit("f"), o))
    path = F.concat(F.lit("n"), F.col("o_custkey") % 25, F.lit("/c"), "o_custkey", F.lit("/"), name, F.when(o % 11 == 0, ".json").otherwise("_x.md"))
    return table(spark, sf, "orders").select(F.when(o % 97 == 0, F.concat(F.lit("top"), o, F.lit(".md"))).otherwise(path).alias("path"))


def pointers(spark, sf):
    nations = table(spark, sf, "nation").where("n_nationkey % 5 = 0").select(F.concat(F.lit("n"), "n_nationkey").alias("pointer"))
    return nations.unionByName(table(spark, sf, "customer").where("c_custkey % 4 = 0").select(F.concat(F.lit("n"), F.col("c_custkey") % 25, F.lit("/c"), "c_custkey").alias("pointer")))


def live(spark, sf):
    return table(spark, sf, "orders").where("o_orderkey % 6 = 0").select(F.lpad(F.col("o_orderkey").cast("string"), 8, "K").alias("key"))


def covered(spark, sf):
    return au.covered(files(spark, sf), pointers(spark, sf), live(spark, sf))


@query("p02_index_key", f"WITH {FILES} SELECT path, CASE WHEN regexp_full_match(string_split(string_split(path, '/')[-1], '_')[1], '[A-Z0-9]{{8}}') THEN string_split(string_split(path, '/')[-1], '_')[1] END AS key FROM files")
def p02_index_key(spark, sf):
    return files(spark, sf).select("path", au.index_key(F.col("path")).alias("key"))


@query("p03_audit_key", f"WITH {FILES} SELECT path, key FROM keys")
def p03_audit_key(spark, sf):
    return files(spark, sf).select("path", au.audit_key(F.col("path")).alias("key"))


@query("p04_skipped", f"WITH {FILES} SELECT path, regexp_matches(path, '(?i)(^|/)(readme[^/]*|\\.[^/]*|[^/]*\\.(json|tsv|csv|log))$') OR strpos(path, '/') = 0 AS skipped FROM files")
def p04_skipped(spark, sf):
    return files(spark, sf).select("path", au.skipped(F.col("path")).alias("skipped"))


@query("p05_covered", f"WITH {FILES} SELECT path, covered FROM cov")
def p05_covered(spark, sf):
    return covered(spark, sf)


@query("j12_ancestor_join", f"WITH {FILES} SELECT path, folder AS pointer FROM anc JOIN (SELECT DISTINCT pointer FROM pointers) ON folder = pointer")
def j12_ancestor_join(spark, sf):
    rows = files(spark, sf).select("path", F.explode(au.ancestors(F.col("path"))).alias("pointer"))
    return rows.join(pointers(spark, sf).distinct(), "pointer").select("path", "pointer")


@query("a11_folder_rollup", f"WITH {FILES} SELECT folder, count(*) AS total, count(*) FILTER (NOT covered) AS uncovered FROM anc JOIN cov USING (path) GROUP BY folder")
def a11_folder_rollup(spark, sf):
    return au.folder_rollup(covered(spark, sf))


@query("j13_topmost_folders", f"WITH {FILES}, bare AS (SELECT folder FROM anc JOIN cov USING (path) GROUP BY folder HAVING count(*) FILTER (NOT covered) = count(*)) SELECT folder FROM bare b WHERE NOT EXISTS (SELECT 1 FROM bare o WHERE starts_with(b.folder, o.folder || '/'))")
def j13_topmost_folders(spark, sf):
    return au.topmost(au.folder_rollup(covered(spark, sf)).where("uncovered = total").select("folder"))


@query("j11_resolve_pointers", "WITH p AS (SELECT n_name || ' — ' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN ' — more' ELSE '' END AS pointer, n_name, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey), e AS (SELECT n_name || ' — ' || c_custkey AS path FROM p WHERE c_custkey % 3 = 0 UNION SELECT n_name FROM nation WHERE n_nationkey % 2 = 0) SELECT pointer, CASE WHEN n_name || ' — ' || c_custkey IN (SELECT path FROM e) THEN n_name || ' — ' || c_custkey ELSE n_name END AS target FROM p")
def j11_resolve_pointers(spark, sf):
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    full = F.concat("n_name", F.lit(" — "), "c_custkey")
    p = rows.select(F.concat(full, F.when(F.col("c_custkey") % 2 == 0, " — more").otherwise("")).alias("pointer"))
    e = rows.where("c_custkey % 3 = 0").select(full.alias("path")).union(table(spark, sf, "nation").where("n_nationkey % 2 = 0").select("n_name"))
    return au.resolve_pointers(p, e)


@query("j24_mirror_state", f"WITH {FILES}, items AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, 'K') AS key, o_orderkey % 12 = 0 AS trashed FROM orders WHERE o_orderkey % 6 = 0) SELECT path, k.key, CASE WHEN trashed IS NULL THEN 'absent' WHEN trashed THEN 'trash' ELSE 'live' END AS state FROM keys k LEFT JOIN items USING (key)")
def j24_mirror_state(spark, sf):
    items = table(spark, sf, "orders").where("o_orderkey % 6 = 0").select(F.lpad(F.col("o_orderkey").cast("string"), 8, "K").alias("key"), (F.col("o_orderkey") % 12 == 0).alias("trashed"))
    return au.mirror_state(p03_audit_key(spark, sf), items)


GAPS = "gaps AS (SELECT c_nationkey AS coll, count(*) FILTER (c_custkey % 3 = 0 AND c_nationkey % 4 <> 0) AS have, count(*) AS total FROM customer GROUP BY c_nationkey)"


def gaps(spark, sf):
    members = table(spark, sf, "customer").select(F.col("c_nationkey").alias("coll"), F.col("c_custkey").alias("key"))
    return au.collection_gaps(members, members.where("key % 3 = 0 and coll % 4 <> 0"))


@query("j25_collection_gaps", f"WITH {GAPS} SELECT coll, have, total, total - have AS missing FROM gaps WHERE have > 0 AND have < total")
def j25_collection_gaps(spark, sf):
    return gaps(spark, sf)


@query("o08_largest_gaps", f"WITH {GAPS} SELECT coll, total - have AS missing FROM gaps WHERE have > 0 AND have < total ORDER BY missing DESC, coll LIMIT 10")
def o08_largest_gaps(spark, sf):
    return gaps(spark, sf).select("coll", "missing").orderBy(F.desc("missing"), "coll").limit(10)


@query("g01_mirror_audit", f"WITH {FILES} SELECT CASE WHEN regexp_matches(path, '(?i)(^|/)(readme[^/]*|\\.[^/]*|[^/]*\\.(json|tsv|csv|log))$') OR strpos(path, '/') = 0 THEN 'skipped' WHEN covered THEN 'covered' ELSE 'uncovered' END AS finding, count(*) AS n FROM cov GROUP BY finding")
def g01_mirror_audit(spark, sf):
    finding = F.when(au.skipped(F.col("path")), "skipped").when(F.col("covered"), "covered").otherwise("uncovered")
    return covered(spark, sf).groupBy(finding.alias("finding")).agg(F.count("*").alias("n"))


@query("a12_items_by_type", "SELECT p_type AS type, count(*) AS n FROM part GROUP BY p_type")
def a12_items_by_type(spark, sf):
    return table(spark, sf, "part").groupBy(F.col("p_type").alias("type")).agg(F.count("*").alias("n"))


@query("a13_child_tallies", "SELECT o_custkey AS parent, count(*) FILTER (o_orderstatus = 'O') AS atts, count(*) FILTER (o_orderstatus = 'F') AS notes FROM orders GROUP BY o_custkey")
def a13_child_tallies(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("parent")).agg(F.count_if(F.col("o_orderstatus") == "O").alias("atts"), F.count_if(F.col("o_orderstatus") == "F").alias("notes"))


@query("o10_title_order", "SELECT path_no, n_name FROM (SELECT n_name, row_number() OVER (ORDER BY lower(n_name), n_nationkey) AS path_no FROM nation)")
def o10_title_order(spark, sf):
    return numbered(table(spark, sf, "nation"), [], [F.lower("n_name"), F.col("n_nationkey")], "path_no").select("path_no", "n_name")


@query("o10_line_numbers", "SELECT l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey, l_quantity, l_discount, l_tax) AS n, l_orderkey, l_linenumber FROM lineitem")
def o10_line_numbers(spark, sf):
    """Three groups of all order lines, each numbered by many tasks."""
    order = [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")]
    return numbered(table(spark, sf, "lineitem"), ["l_returnflag"], order).select("l_returnflag", "n", "l_orderkey", "l_linenumber")


@query("g02_library_manifest", "SELECT r_name || ' / ' || n_name AS coll, count(*) AS items, CAST(sum(atts) AS BIGINT) AS atts FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT o_custkey, count(*) AS atts FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey GROUP BY ALL")
def g02_library_manifest(spark, sf):
    names = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.concat("r_name", F.lit(" / "), "n_name").alias("coll"))
    atts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("atts"))
    rows = table(spark, sf, "customer").join(names, F.col("c_nationkey") == F.col("n_nationkey")).join(atts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.groupBy("coll").agg(F.count("*").alias("items"), F.sum("atts").alias("atts"))


# discovery


@query("w03_rescale", "SELECT p_partkey, CASE WHEN p_size % 5 = 0 OR hi = lo THEN 3.0 ELSE 1 + 4 * (p_retailprice - lo) / (hi - lo) END AS score FROM (SELECT *, min(CASE WHEN p_size % 5 <> 0 THEN p_retailprice END) OVER w AS lo, max(CASE WHEN p_size % 5 <> 0 THEN p_retailprice END) OVER w AS hi FROM part WINDOW w AS (PARTITION BY p_brand))")
def w03_rescale(spark, sf):
    return di.rescale(table(spark, sf, "part"), "p_brand", "p_retailprice", F.col("p_size") % 5 != 0).select("p_partkey", "score")


@query("o05_by_score", "SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS place FROM part")
def o05_by_score(spark, sf):
    w = Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    return table(spark, sf, "part").select("p_partkey", F.row_number().over(w).cast("long").alias("place"))


@query("j15_not_known", "SELECT p_partkey, doi FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '10.1/' || (p_partkey % 500) END AS doi, p_size FROM part) x WHERE p_size % 5 = 0 AND doi NOT IN (SELECT CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '10.1/' || (p_partkey % 500) END FROM part WHERE p_size % 5 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 2 = 0)")
def j15_not_known(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_size", F.when(F.col("p_partkey") % 7 == 0, "").otherwise(F.concat(F.lit("10.1/"), F.col("p_partkey") % 500)).alias("doi"))
    return di.not_known(rows.where("p_size % 5 = 0"), rows.where("p_size % 5 <> 0 and p_partkey % 2 = 0")).select("p_partkey", "doi")


@query("j16_merge_metadata", "SELECT coalesce(a.k, b.k) AS k, coalesce(nullif(a.title, ''), b.title) AS title, coalesce(nullif(a.venue, ''), b.venue) AS venue FROM (SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END AS title, p_brand AS venue FROM part WHERE p_partkey % 4 <> 0) a FULL JOIN (SELECT p_partkey AS k, upper(p_name) AS title, p_type AS venue FROM part WHERE p_partkey % 5 <> 0) b ON a.k = b.k")
def j16_merge_metadata(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    a = p.where(k % 4 != 0).select(k.alias("k"), F.when(k % 3 == 0, "").otherwise(F.col("p_name")).alias("title"), F.col("p_brand").alias("venue"))
    b = p.where(k % 5 != 0).select(k.alias("k"), F.upper("p_name").alias("title"), F.col("p_type").alias("venue"))
    return di.merge_metadata(a, b, "k", ["title", "venue"])


@query("k03_markdown_table", "SELECT p_partkey, '| ' || concat_ws(' | ', p_partkey, p_brand, replace(p_name, '|', '/'), p_size) || ' |' AS line FROM part")
def k03_markdown_table(spark, sf):
    return table(spark, sf, "part").select("p_partkey", di.table_row([F.col(c) for c in ("p_partkey", "p_brand", "p_name", "p_size")]).alias("line"))


@query("p10_open_url", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN 'https://x.org/' || o_orderkey || '.pdf' END AS url FROM orders")
def p10_open_url(spark, sf):
    extra = F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("DOI: 1\nOA URL: https://x.org/"), "o_orderkey", F.lit(".pdf\nmore"))).otherwise("nothing")
    return table(spark, sf, "orders").select("o_orderkey", di.open_url(extra).alias("url"))


URLS = "CASE o_orderkey % 5 WHEN 0 THEN 'https://arxiv.org/abs/' || o_orderkey WHEN 1 THEN 'https://x.org/' || o_orderkey || '.pdf' WHEN 2 THEN 'https://x.org/a.html' WHEN 3 THEN 'https://doi.org/10.1/' || o_orderkey ELSE 'https://x.org/get/' || o_orderkey END"


@query("p11_fetch_plan", f"SELECT o_orderkey, replace(u, 'arxiv.org/abs/', 'arxiv.org/pdf/') AS url, CASE WHEN u LIKE '%.html' OR u LIKE '%doi.org/%' THEN NULL ELSE 'application/pdf' END AS kind FROM (SELECT o_orderkey, {URLS} AS u FROM orders)")
def p11_fetch_plan(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.expr(URLS).alias("u"))
    url, kind = di.fetch_plan(F.col("u"))
    return rows.select("o_orderkey", url.alias("url"), kind.alias("kind"))


@query("p12_row_numbers", "SELECT s_suppkey, CAST(s_suppkey + i AS INTEGER) AS row_no FROM supplier, (SELECT unnest([0, 2, 4, 5, 6]) AS i)")
def p12_row_numbers(spark, sf):
    k = F.col("s_suppkey")
    spec = F.concat_ws(",", k, k + 2, F.concat(k + 4, F.lit("-"), k + 6), k, F.lit("x"))
    return table(spark, sf, "supplier").select("s_suppkey", F.explode(di.row_numbers(spec)).alias("row_no"))


@query("s41_doi_list", "SELECT o_orderkey, '10.' || (1000 + o_custkey) || '/x' || o_orderkey AS doi FROM orders")
def s41_doi_list(spark, sf):
    o = F.col("o_orderkey")
    head = F.when(o % 4 == 0, "https://doi.org/").when(o % 4 == 1, " DOI:").when(o % 4 == 2, "https://doi.org/doi:").otherwise("")
    raw = F.concat(head, F.lit("10."), F.col("o_custkey") + 1000, F.lit("/X"), o, F.lit(" "))
    return table(spark, sf, "orders").select("o_orderkey", di.normal_doi(raw).alias("doi"))


@query("x05_rebuild_abstract", "SELECT doc_id, array_to_string(string_split(regexp_replace(trim(text), '\\s+', ' ', 'g'), ' '), ' ') AS abstract FROM documents WHERE trim(text) <> ''".replace("\\\\", "\\"))
def x05_rebuild_abstract(spark, sf):
    docs = table(spark, sf, "documents").where("trim(text) <> ''").repartition("doc_id")  # texts are moved once instead of their words
    words = docs.select("doc_id", F.posexplode(F.split(F.regexp_replace(F.trim("text"), r"\s+", " "), " ")).alias("at", "w"))
    index = words.groupBy("doc_id", "w").agg(F.collect_list("at").alias("at")).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "at"))).alias("inv"))
    return di.rebuild_abstract(index, "doc_id", "inv")


RESOLVE = """wanted AS (SELECT p_partkey AS id, p_name AS title, 'Ivanov' AS author, CASE WHEN p_partkey % 10 <> 0 THEN 2000 + p_size % 20 END AS year FROM part),
cand AS (SELECT p_partkey AS id, k AS pos, '10.1/' || p_partkey || '.' || k AS doi, CASE k WHEN 0 THEN p_name ELSE p_name || ' ' || p_brand || ' extra words' END AS title, CASE WHEN (p_partkey + k) % 3 = 0 THEN 'Petrov' ELSE 'Ivanóv' END AS family, 2000 + p_size % 20 + (p_partkey + k) % 5 AS year FROM part, (SELECT unnest([0, 1, 2]) AS k)),
sets AS (SELECT w.id, pos, doi, list_distinct(regexp_extract_all(lower(strip_accents(w.title)), '[a-zа-я0-9]+')) AS a, list_distinct(regexp_extract_all(lower(strip_accents(c.title)), '[a-zа-я0-9]+')) AS b, family LIKE 'Iv%' AS author_ok, abs(w.year - c.year) AS apart FROM wanted w JOIN cand c USING (id)),
scored AS (SELECT id, pos, doi, len(list_intersect(a, b)) / greatest(len(a), 1) AS overlap, author_ok, apart FROM sets),
ranked AS (SELECT *, overlap + CASE WHEN author_ok THEN 0.25::DOUBLE ELSE 0.0 END - 0.08::DOUBLE * least(coalesce(apart, 0), 3) AS score FROM scored)"""


@query("w16_best_candidate", f"WITH {RESOLVE} SELECT id, doi, author_ok, round(score, 6) AS score, overlap >= 0.55 AND author_ok AND coalesce(apart <= 2, false) AS resolved FROM ranked QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, pos) = 1")
def w16_best_candidate(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    wanted = p.select(k.alias("id"), F.col("p_name").alias("title"), F.lit("Ivanov").alias("author"), F.when(k % 10 != 0, 2000 + F.col("p_size") % 20).alias("year"))
    c = p.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    cand = c.select(k.alias("id"), F.col("k").alias("pos"), F.concat(F.lit("10.1/"), k, F.lit("."), "k").alias("doi"), F.when(F.col("k") == 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" "), "p_brand", F.lit(" extra words"))).alias("title"), F.when((k + F.col("k")) % 3 == 0, "Petrov").otherwise("Ivanóv").alias("family"), (2000 + F.col("p_size") % 20 + (k + F.col("k")) % 5).alias("year"))
    return di.best_candidates(wanted, cand).select("id", "doi", "author_ok", F.round("score", 6).alias("score"), "resolved")


@query("j35_first_success", "WITH a AS (SELECT o_custkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos, 'u' || o_orderkey AS url, o_orderstatus = 'F' AS ok, CASE WHEN o_custkey % 9 <> 0 THEN '10.1/x' ELSE '' END AS doi, CASE WHEN o_custkey % 11 = 0 THEN 'HTTP 500' END AS error FROM orders), w AS (SELECT *, min(CASE WHEN ok THEN pos END) OVER (PARTITION BY id) AS win FROM a), g AS (SELECT id, max(doi) AS doi, max(error) AS error, count(*) AS n_attempts, max(CASE WHEN pos = win THEN url END) AS url FROM w WHERE win IS NULL OR pos <= win GROUP BY id) SELECT id, CASE WHEN doi = '' THEN 'no_doi' WHEN error IS NOT NULL THEN 'service_error' WHEN url IS NOT NULL THEN 'OK' ELSE 'all_failed' END AS status, n_attempts, url FROM g")
def j35_first_success(spark, sf):
    c = F.col("o_custkey")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    rows = table(spark, sf, "orders").select(c.alias("id"), F.row_number().over(w).alias("pos"), F.concat(F.lit("u"), "o_orderkey").alias("url"), (F.col("o_orderstatus") == "F").alias("ok"), F.when(c % 9 != 0, "10.1/x").otherwise("").alias("doi"), F.when(c % 11 == 0, "HTTP 500").alias("error"))
    return di.first_success(rows)


@query("a23_merge_log", "SELECT user_id, arg_max(event_type, event_id) FILTER (event_type <> 'view') AS status, arg_max(value, event_id) AS value, array_to_string(list(CAST(event_id AS VARCHAR) ORDER BY event_id) FILTER (event_id % 3 = 0), ',') AS attempts FROM events GROUP BY user_id")
def a23_merge_log(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select("user_id", "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).otherwise("").alias("status"), "value", F.when(F.col("event_id") % 3 == 0, F.array(F.col("event_id").cast("string"))).alias("attempts"))
    out = di.merge_log(rows, "user_id", "event_id", ["status", "value"], "attempts")
    return out.select("user_id", "status", "value", F.when(F.size("attempts") > 0, F.array_join("attempts", ",")).alias("attempts"))


@query("a09_flow_counts", "SELECT count(*) AS total, count(*) FILTER (n_chars > 1000) AS with_text, count(*) FILTER (NOT n_chars > 1000) AS without_text FROM documents")
def a09_flow_counts(spark, sf):
    return aq.flow_counts(table(spark, sf, "documents"), F.col("n_chars") > 1000)


@query("a10_gross_and_distinct", "SELECT o_orderpriority AS grp, count(*) AS gross, count(DISTINCT o_custkey) AS distinct_n FROM orders GROUP BY o_orderpriority")
def a10_gross_and_distinct(spark, sf):
    return aq.gross_and_distinct(table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "grp"), "grp", "o_custkey")


@query("a15_log_rollup", "SELECT count(*) FILTER (starts_with(s, 'OK')) AS ok, count(*) FILTER (starts_with(s, 'skip')) AS skipped, count(*) FILTER (starts_with(s, 'FAIL')) AS failed FROM (SELECT CASE event_type WHEN 'view' THEN 'OK: x' WHEN 'click' THEN 'FAIL: y' ELSE 'skip: z' END AS s FROM events)")
def a15_log_rollup(spark, sf):
    s = F.when(F.col("event_type") == "view", "OK: x").when(F.col("event_type") == "click", "FAIL: y").otherwise("skip: z")
    return table(spark, sf, "events").select(s.alias("s")).transform(aq.log_rollup, "s", {"ok": "OK", "skipped": "skip", "failed": "FAIL"})


@query("a29_last_wins", "SELECT o_custkey AS key, arg_max(o_totalprice, o_orderkey) AS value FROM orders GROUP BY o_custkey")
def a29_last_wins(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.max_by("o_totalprice", "o_orderkey").alias("value"))


@query("w12_first_doi", "SELECT o_custkey AS doi, min(o_orderkey) AS first FROM orders GROUP BY o_custkey")
def w12_first_doi(spark, sf):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return table(spark, sf, "orders").withColumn("k", F.row_number().over(w)).where("k = 1").select(F.col("o_custkey").alias("doi"), F.col("o_orderkey").alias("first"))
