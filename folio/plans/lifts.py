"""The synthetic tables as the structures the operators read, in Spark and as SQL for the reference database.

Every lift is a deterministic rewriting of a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators import pages as pg


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def paginated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): four lines a page, blank lines between them."""
    # a column of its own: named in the lambda, the text would be split again for each of its pages
    lines = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    bodies = F.transform(F.sequence(F.lit(0), F.floor((F.size("lines") - 1) / 4).cast("int")), lambda p: F.array_join(F.slice("lines", p * 4 + 1, F.lit(4)), "\n\n"))
    return lines.select("doc_id", pg.paginate(bodies).alias("text"))


#: paginated(doc_id, text)
PAGINATED = """paginated AS (SELECT doc_id, array_to_string(list_transform(range(0, len(l), 4), lambda i: '{' || (i // 4) || '}' || repeat('-', 48) || chr(10) || array_to_string(l[i + 1:i + 4], chr(10) || chr(10))), chr(10)) AS text
FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""

#: pages_t(doc_id, page, body) from paginated
PAGES = (
    PAGINATED
    + r""",
pages_t AS (SELECT doc_id, CAST(unnest(regexp_extract_all(text, '(?m)^\{(\d+)\}-{48}$', 1)) AS INTEGER) AS page,
  unnest(regexp_split_to_array(text, '(?m)^\{\d+\}-{48}$')[2:]) AS body FROM paginated)"""
)

#: chunks_t(doc_id, page, seq, text) from pages_t
CHUNKS = (
    PAGES
    + r""",
paras AS (SELECT doc_id, page, list_filter(list_transform(regexp_split_to_array(body, '\n\s*\n'), lambda p: regexp_replace(regexp_replace(regexp_replace(p, '^\s+|\s+$', '', 'g'), '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g')), lambda p: p <> '') AS ps FROM pages_t),
steps AS (SELECT doc_id, page, list_reduce(list_transform(ps, lambda p: {'done': []::VARCHAR[], 'cur': '', 'held': '', 'p': p}),
  lambda s, x: CASE
    WHEN length(x.p) < 60 THEN {'done': s.done, 'cur': s.cur, 'held': CASE WHEN s.held <> '' THEN s.held || chr(10) || chr(10) || x.p ELSE x.p END, 'p': ''}
    WHEN s.cur <> '' AND length(s.cur) + length(CASE WHEN s.held <> '' THEN s.held || chr(10) || chr(10) || x.p ELSE x.p END) + 2 > 900
      THEN {'done': list_append(s.done, s.cur), 'cur': CASE WHEN s.held <> '' THEN s.held || chr(10) || chr(10) || x.p ELSE x.p END, 'held': '', 'p': ''}
    ELSE {'done': s.done, 'cur': CASE WHEN s.cur <> '' THEN s.cur || chr(10) || chr(10) ELSE '' END || CASE WHEN s.held <> '' THEN s.held || chr(10) || chr(10) || x.p ELSE x.p END, 'held': '', 'p': ''} END,
  {'done': []::VARCHAR[], 'cur': '', 'held': '', 'p': ''}) AS s FROM paras),
ended AS (SELECT doc_id, page, s.done AS done, CASE WHEN s.held <> '' THEN CASE WHEN s.cur <> '' THEN s.cur || chr(10) || chr(10) || s.held ELSE s.held END ELSE s.cur END AS last FROM steps),
chunks_t AS (SELECT doc_id, page, CAST(generate_subscripts(c, 1) - 1 AS INTEGER) AS seq, unnest(c) AS text FROM (SELECT doc_id, page, CASE WHEN last <> '' THEN list_append(done, last) ELSE done END AS c FROM ended))"""
)

#: toks(doc_id, w): folded words of documents
TOKENS = "toks AS (SELECT doc_id, regexp_extract_all(lower(strip_accents(text)), '[a-zа-я0-9]+') AS w FROM documents)"

#: sh(doc_id, pos, h): shingles of eight words
SHINGLES = TOKENS + ", sh AS (SELECT doc_id, unnest(range(0, greatest(len(w) - 7, 0))) AS pos, unnest(list_transform(range(0, greatest(len(w) - 7, 0)), lambda i: hash(array_to_string(w[i + 1:i + 8], ' ')))) AS h FROM toks)"
