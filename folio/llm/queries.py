"""One query per training-data operator, over whole tables with production parameters."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, exact_dedup, langid, license_scan, line_dedup, media, minhash, packing, prefix_trie, sp_codec, substring_dedup, toxicity, url_rules
from .common import prepare

#: A folder that has the public vocabularies, where they aren't installed.
TOKENIZERS = os.environ.get("FOLIO_TOKENIZERS")

#: The rules of the url query, as (verdict, host, path prefix).
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def vocabulary(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_codec.encode_documents(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), digests_only=True)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.read_media(media.store_texts(table(spark, sf_dir, "documents")))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents")).drop("spans")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    owned, middle = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
    sums = owned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    inertia = {r.cluster: int(r.s) for r in sums.collect()}  # a row per cluster
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    rows = [(k, inertia[k], sum(inertia.values()), digest[k]) for k in inertia]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return owned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.drop_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), family=20)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_url_filter, op3_toxicity, op4_media, op5_license_scan, op6_exact_dedup, op7_line_dedup, op8_near_dedup, op9_language_id, op10_packing,
        op11_centroids, op12_substring_dedup, op13_prefix_trie,
    )
}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {}

ORACLES["op2_url_filter"] = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path FROM h),
r(verdict, rhost, rpath) AS (VALUES ('allow','org','/'),('block','example.org','/es/'),('block','example.org','/en/1'),('allow','com','/fr/'),('block','com','/de/')),
m AS (SELECT page_id, host, path, rhost || rpath AS rule, verdict,
             row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC) AS k
      FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""

ORACLES["op6_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

ORACLES["op7_line_dedup"] = r"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents),
clean AS (SELECT *, trim(regexp_replace(line, '\s+', ' ', 'g')) AS c FROM lines),
t AS (SELECT *, regexp_replace(c, '[^ 0-9]*[0-9][^ ]*', '<*>', 'g') AS m FROM clean),
leafed AS (SELECT *, length(m) - length(replace(m, ' ', '')) AS size, array_to_string(string_split(m, ' ')[1:4], ' ') AS lead FROM t WHERE m <> ''),
exact AS (SELECT m, size, lead, count(DISTINCT doc_id) AS docs, min((doc_id, n)) AS keep FROM leafed GROUP BY ALL),
leaves AS (SELECT size, lead FROM exact GROUP BY ALL HAVING count(*) > 1 AND sum(docs) >= 6),
inner_t AS (SELECT size, lead, m, docs, unnest(string_split(m, ' ')) AS token, generate_subscripts(string_split(m, ' '), 1) AS pos FROM exact SEMI JOIN leaves USING (size, lead)),
tok AS (SELECT size, lead, pos, token, sum(docs) AS d FROM inner_t GROUP BY ALL),
common AS (SELECT size, lead, pos, max((d, token)) AS top, sum(d) AS total FROM tok GROUP BY ALL HAVING 2 * max(d) >= sum(d)),
agreed AS (SELECT i.size, i.lead, i.m, avg(CASE WHEN i.token = coalesce(c.top[2], '<*>') THEN 1.0 ELSE 0.0 END) AS share
           FROM inner_t i LEFT JOIN common c USING (size, lead, pos) GROUP BY ALL),
alike AS (SELECT size, lead, m FROM agreed WHERE share >= 0.8),
wide AS (SELECT size, lead, min((doc_id, n)) AS keep FROM leafed SEMI JOIN alike USING (size, lead, m) GROUP BY ALL HAVING count(DISTINCT doc_id) >= 6),
marked AS (SELECT i.*, i.pos > 4 AND i.token <> '<*>' AND t.d < 6 AS rare FROM inner_t i JOIN tok t USING (size, lead, pos, token)),
shapes AS (SELECT size, lead, m, any_value(docs) AS docs, list(CASE WHEN rare THEN '<*>' ELSE token END ORDER BY pos) AS w, floor(0.2 * count(*) + 1e-9) - count(*) FILTER (rare) AS free,
           coalesce(list(pos) FILTER (pos > 4 AND token <> '<*>' AND NOT rare), []) AS ats FROM marked GROUP BY size, lead, m HAVING free >= 0),
pats AS (SELECT size, lead, m, docs, array_to_string(list_transform(w, lambda x, i: CASE WHEN i = p THEN '<*>' ELSE x END), ' ') AS pattern
         FROM (SELECT *, unnest(list_prepend(0, CASE WHEN free > 0 THEN ats ELSE [] END)) AS p FROM shapes)),
several AS (SELECT p.size, p.lead, pattern, sum(p.docs) AS docs, max(p.docs) AS most, min(keep) AS first FROM pats p JOIN exact e ON e.m = p.m GROUP BY ALL HAVING count(*) > 1 AND sum(p.docs) >= 6),
spread AS (SELECT s.size, s.lead, s.pattern, count(DISTINCT doc_id) AS d FROM several s JOIN pats p USING (size, lead, pattern) JOIN leafed l ON l.m = p.m GROUP BY ALL),
choices AS (SELECT m, 0 AS rank, 0 AS docs, NULL AS first, size || ' ' || lead AS family FROM alike JOIN wide USING (size, lead)
            UNION ALL SELECT p.m, 1, CASE WHEN most >= 6 THEN s.docs ELSE d END, first, s.size || ' ' || s.lead || ' ' || pattern FROM several s JOIN spread USING (size, lead, pattern) JOIN pats p USING (size, lead, pattern) WHERE most >= 6 OR d >= 6
            UNION ALL SELECT m, 2, docs, NULL, m FROM exact WHERE docs >= 6),
chosen AS (SELECT m, rank, family FROM choices QUALIFY row_number() OVER (PARTITION BY m ORDER BY rank, docs DESC, first, family) = 1),
best AS (SELECT m, min(keep) OVER (PARTITION BY rank, family) AS keep FROM chosen JOIN exact USING (m)),
hit AS (SELECT doc_id, n FROM leafed JOIN best USING (m) WHERE (doc_id, n) <> keep),
judged AS (SELECT doc_id, n, line, h.doc_id IS NOT NULL AS gone FROM lines l LEFT JOIN (SELECT DISTINCT doc_id AS doc_id, n FROM hit) h USING (doc_id, n))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '') AS text
FROM judged GROUP BY doc_id
"""

ORACLES["op8_near_dedup"] = r"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.r)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""


def _lloyd_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds unrolled: c<i> are centroids (j, p, x), a<i> owners (rn, j, d)."""
    parts = [
        "kept AS (SELECT row_number() OVER () AS rn, * FROM (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64))",
        "v AS (SELECT rn, unnest(range(64)) AS p, CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM kept)",
        f"s AS (SELECT rn, row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))) - 1 AS j FROM kept QUALIFY j < {k})",
        "c0 AS MATERIALIZED (SELECT j, p, x FROM v JOIN s USING (rn))",
    ]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT rn, (min((d, j)))[2] AS j, min(d) AS d FROM (SELECT rn, j, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{i} c USING (p) GROUP BY rn, j) GROUP BY rn)")
        if i < rounds:
            parts.append(f"m{i} AS (SELECT j, p, sum(x) AS s, count(*) AS n FROM a{i} JOIN v USING (rn) GROUP BY j, p)")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT j, p, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{i} LEFT JOIN m{i} USING (j, p))")
    parts.append(f"h AS (SELECT j, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p)) AS centroid_sha256 FROM c{rounds} GROUP BY j)")
    last = f"a{rounds}"
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(j AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM {last} JOIN kept USING (rn) JOIN h USING (j)"""


ORACLES["op11_centroids"] = _lloyd_sql()

ORACLES["op12_substring_dedup"] = r"""
WITH words AS (SELECT row_number() OVER () AS rn, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
windows AS (SELECT rn, i, array_to_string(w[i + 1:i + 35], ' ') AS run FROM (SELECT rn, w, unnest(range(0, len(w) - 34)) AS i FROM words)),
again AS (SELECT rn, i FROM windows SEMI JOIN (SELECT run FROM windows GROUP BY run HAVING count(*) > 1) USING (run)),
gone AS (SELECT DISTINCT rn, i + unnest(range(35)) AS i FROM again),
each AS (SELECT rn, unnest(range(0, len(w))) AS i, unnest(w) AS word FROM words),
left_over AS (SELECT rn, string_agg(word, ' ' ORDER BY i) AS kept FROM each ANTI JOIN gone USING (rn, i) GROUP BY rn),
lost AS (SELECT rn, count(*) AS n FROM gone GROUP BY rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN left_over USING (rn) LEFT JOIN lost USING (rn)
"""

ORACLES["op13_prefix_trie"] = r"""
WITH tbl AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY n) AS t FROM range(256) r(n)),
turns AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS r,
                 coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
heads AS (SELECT c, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                                    lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 4 AS h FROM (SELECT DISTINCT c FROM turns), tbl),
rebuilt AS (SELECT x.c, r, role, text FROM heads x JOIN turns b ON b.c = x.c - x.c % 20 AND r <= h
            UNION ALL SELECT x.c, r, role, text FROM heads x JOIN turns o ON o.c = x.c AND r > h),
lists AS (SELECT c, coalesce(list({'role': role, 'text': text} ORDER BY r) FILTER (r IS NOT NULL), []) AS l FROM heads LEFT JOIN rebuilt USING (c) GROUP BY c),
paths AS (SELECT c, l, d, md5(CAST(to_json(l[1:d]) AS VARCHAR)) AS key FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM lists)),
nodes AS (SELECT d, key, min(c) AS c, count(*) AS n, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(l) = d), '') AS ends,
                 any_value(CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(l[d].text, '[^\x20\x09-\x0D]+')) END) AS words FROM paths GROUP BY d, key),
up AS (SELECT v.*, p.key AS pkey FROM nodes v LEFT JOIN paths p ON p.c = v.c AND p.d = v.d - 1),
kids AS (SELECT d - 1 AS d, pkey AS key, count(*) AS kids FROM up WHERE d > 0 GROUP BY ALL),
facts AS (SELECT up.*, coalesce(kids, 0) AS kids, (n - 1) * words AS worth FROM up LEFT JOIN kids USING (d, key)),
below AS (SELECT p.d, p.key, count(*) FILTER (f.kids = 0) AS leaves, sum(worth) AS saved FROM facts f JOIN paths p ON p.c = f.c AND p.d <= f.d GROUP BY ALL)
SELECT f.c AS conv_id, f.d AS depth, q.c AS parent_conv_id, f.n AS n_convs, f.kids AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM facts f JOIN below USING (d, key) LEFT JOIN nodes q ON q.d = f.d - 1 AND q.key = f.pkey
"""
