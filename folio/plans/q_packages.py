"""Tables from word boxes, and the text of packages, on parts that are derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import wordboxes
from folio.sources import packages

from .lifts import table
from .registry import query


def boxes(spark, sf):
    """Customers as documents whose orders are lines of three columns, the last of one or two words; a gap after every fifth line,
    some lines without a status, and words of each a little higher or lower."""
    o = table(spark, sf, "orders")
    rows = o.select(F.col("o_custkey").alias("doc"), (F.col("o_orderkey") % 2).cast("int").alias("page"), "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    rows = rows.groupBy("doc", "page").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"))).alias("l")).select("doc", "page", F.posexplode("l").alias("k", "x"))
    y = F.col("k") * 12.0 + F.floor(F.col("k") / 5) * 40.0 + (F.col("x.o_orderkey") % 3)
    word = lambda x0, x1, text, up=0.0: F.struct(F.lit(float(x0)).alias("x0"), (y + up).alias("y0"), F.lit(float(x1)).alias("x1"), (y + up + 8.0).alias("y1"), text.alias("text"))
    first, second = F.split("x.o_orderpriority", " ")[0], F.get(F.split("x.o_orderpriority", " "), F.lit(1))
    words = F.array(word(10, 40, F.col("x.o_orderkey").cast("string")), word(60, 70, F.when(F.col("x.o_totalprice") < 200000, F.col("x.o_orderstatus")), 1.0), word(100, 130, first, 0.5), word(133, 170, second))
    return rows.select("doc", "page", F.explode(words).alias("w")).select("doc", "page", "w.*")


BOXES = """l AS (SELECT o_custkey AS doc, CAST(o_orderkey % 2 AS INTEGER) AS page, row_number() OVER (PARTITION BY o_custkey, o_orderkey % 2 ORDER BY o_orderkey) - 1 AS k, * FROM orders),
w AS (SELECT doc, page, k, unnest([{'x0': 10.0, 'x1': 40.0, 'up': 0.0, 't': CAST(o_orderkey AS VARCHAR)}, {'x0': 60.0, 'x1': 70.0, 'up': 1.0, 't': CASE WHEN o_totalprice < 200000 THEN o_orderstatus END},
 {'x0': 100.0, 'x1': 130.0, 'up': 0.5, 't': string_split(o_orderpriority, ' ')[1]}, {'x0': 133.0, 'x1': 170.0, 'up': 0.0, 't': string_split(o_orderpriority, ' ')[2]}]) AS x, o_orderkey FROM l),
b AS (SELECT doc, page, x.x0 AS x0, x.x1 AS x1, k * 12.0 + (k // 5) * 40.0 + o_orderkey % 3 + x.up AS y0, k * 12.0 + (k // 5) * 40.0 + o_orderkey % 3 + x.up + 8.0 AS y1, x.t AS text FROM w WHERE coalesce(x.t, '') <> ''),
l1 AS (SELECT *, CASE WHEN y0 - max(y1) OVER (PARTITION BY doc, page ORDER BY y0, y1, x0, x1, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0 THEN 1 ELSE 0 END AS nl, CASE WHEN y0 - max(y1) OVER (PARTITION BY doc, page ORDER BY y0, y1, x0, x1, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 14 THEN 1 ELSE 0 END AS nb FROM b),
l2 AS (SELECT *, sum(nl) OVER (PARTITION BY doc, page ORDER BY y0, y1, x0, x1, text ROWS UNBOUNDED PRECEDING) AS line, sum(nb) OVER (PARTITION BY doc, page ORDER BY y0, y1, x0, x1, text ROWS UNBOUNDED PRECEDING) AS block FROM l1),
l3 AS (SELECT *, CASE WHEN x0 - max(x1) OVER (PARTITION BY doc, page, block ORDER BY x0, x1, y0, y1, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 6 THEN 1 ELSE 0 END AS nc FROM l2),
l4 AS (SELECT *, sum(nc) OVER (PARTITION BY doc, page, block ORDER BY x0, x1, y0, y1, text ROWS UNBOUNDED PRECEDING) AS col, dense_rank() OVER (PARTITION BY doc, page, block ORDER BY line) - 1 AS "row" FROM l3),
l5 AS (SELECT *, max("row") OVER (PARTITION BY doc, page, block) + 1 AS nr, max(col) OVER (PARTITION BY doc, page, block) + 1 AS ncol FROM l4),
found AS (SELECT doc, page, block, "row", col, string_agg(text, ' ' ORDER BY x0, text) AS text FROM l5 WHERE nr >= 3 AND ncol >= 2 GROUP BY ALL),
grid AS (SELECT doc, page, block, "row", unnest(range(CAST(ncol AS BIGINT))) AS col FROM (SELECT doc, page, block, ncol, unnest(range(CAST(nr AS BIGINT))) AS "row" FROM (SELECT DISTINCT doc, page, block, nr, ncol FROM l5 WHERE nr >= 3 AND ncol >= 2)))"""


@query("s24_box_tables", f'WITH {BOXES} SELECT doc, page, CAST(block AS INTEGER) AS block, CAST("row" AS INTEGER) AS row_no, CAST(col AS INTEGER) AS col_no, coalesce(text, \'\') AS text FROM grid LEFT JOIN found USING (doc, page, block, "row", col)')
def s24_box_tables(spark, sf):
    return wordboxes.cells(boxes(spark, sf)).select("doc", "page", "block", F.col("row").cast("int").alias("row_no"), F.col("col").cast("int").alias("col_no"), "text")


def escaped(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def word_parts(spark, sf):
    """Documents as word packages: a paragraph a line, in two runs of text each, every fourth with a picture."""
    run = lambda t: F.concat(F.lit('<w:r><w:t xml:space="preserve">'), t, F.lit("</w:t></w:r>"))
    halves = lambda x: F.concat(run(escaped(F.substring(x, 1, 7))), run(escaped(F.substring(x, F.lit(8), F.length(x)))))
    paragraph = lambda x, n: F.concat(F.lit("<w:p><w:pPr/>"), halves(x), F.when(n % 4 == 3, F.lit("<w:drawing/>")).otherwise(F.lit("")), F.lit("</w:p>"))
    xml = F.concat(F.lit("<w:body>"), F.array_join(F.transform(F.split("text", "\n"), paragraph), "<w:p/>\n"), F.lit("</w:body>"))
    return table(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("archive"), F.lit(packages.WORD_PART).alias("entry"), xml.cast("binary").alias("content"))


@query("s28_word_paragraphs", "SELECT 'd' || doc_id AS archive, CAST(n AS INTEGER) AS n, trim(line, ' ') AS text, n % 4 = 3 AS picture FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))")
def s28_word_paragraphs(spark, sf):
    return packages.paragraphs(word_parts(spark, sf))


def slide_parts(spark, sf):
    """Customers as slide packages: an order a slide, named in falling order of keys, dear ones with a table, open ones with notes."""
    o = table(spark, sf, "orders").select(F.concat(F.lit("c"), "o_custkey").alias("archive"), F.col("o_orderkey").alias("k"), "o_orderstatus", "o_totalprice", "o_orderpriority")
    shape = lambda t, kind="": F.concat(F.lit(f"<p:grpSp><p:sp><p:nvPr>{kind}</p:nvPr><p:txBody><a:p><a:r><a:t>"), t, F.lit("</a:t></a:r></a:p><a:p><a:t>&lt;end&gt;</a:t></a:p></p:txBody></p:sp></p:grpSp>"))
    cell = lambda t: F.concat(F.lit("<a:tc><a:p><a:t>"), t, F.lit("</a:t></a:p></a:tc>"))
    grid = F.concat(F.lit("<a:tbl><a:tr h='1'>"), cell(F.lit("key")), cell(F.lit("a|b")), F.lit("</a:tr><a:tr>"), cell(F.col("k").cast("string")), cell(F.col("o_orderpriority")), F.lit("</a:tr></a:tbl>"))
    content = lambda c: c.cast("binary").alias("content")
    name = lambda before, after: F.concat(F.lit(before), "k", F.lit(after)).alias("entry")
    each = [
        o.select("archive", name("ppt/slides/slide", ".xml"), content(F.concat(shape(F.concat(F.lit("order "), "k")), F.when(F.col("o_totalprice") > 100000, grid).otherwise(F.lit(""))))),
        o.where("o_orderstatus = 'O'").select("archive", name("ppt/notesSlides/notesSlide", ".xml"), content(F.concat(shape(F.lit("number")), shape(F.concat(F.lit("say "), "k"), '<p:ph type="body"/>')))),
        o.where("o_orderstatus = 'O'").select("archive", name("ppt/slides/_rels/slide", ".xml.rels"), content(F.concat(F.lit('<Relationships><Relationship Id="rId1" Type="x/notesSlide" Target="../notesSlides/notesSlide'), "k", F.lit('.xml"/></Relationships>')))),
    ]
    keys = o.groupBy("archive").agg(F.sort_array(F.collect_list("k"), asc=False).alias("ks"))
    joined = lambda f: F.array_join(F.transform("ks", f), "")
    each.append(keys.select("archive", F.lit("ppt/presentation.xml").alias("entry"), content(joined(lambda k: F.concat(F.lit('<p:sldId id="1" r:id="r'), k, F.lit('"/>'))))))
    each.append(keys.select("archive", F.lit("ppt/_rels/presentation.xml.rels").alias("entry"), content(joined(lambda k: F.concat(F.lit('<Relationship Target="slides/slide'), k, F.lit('.xml" Id="r'), k, F.lit('"/>'))))))
    out = each[0]
    for df in each[1:]:
        out = out.unionByName(df)
    return out


@query("s27_slides", r"""SELECT 'c' || o_custkey AS archive, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS INTEGER) AS page,
'order ' || o_orderkey || chr(10) || '<end>' || CASE WHEN o_totalprice > 100000 THEN chr(10) || chr(10) || '| key | a\|b |' || chr(10) || '|---|---|' || chr(10) || '| ' || o_orderkey || ' | ' || o_orderpriority || ' |' ELSE '' END
 || CASE WHEN o_orderstatus = 'O' THEN chr(10) || chr(10) || 'Speaker notes:' || chr(10) || chr(10) || 'say ' || o_orderkey || chr(10) || '<end>' ELSE '' END AS text FROM orders""")
def s27_slides(spark, sf):
    return packages.slides(slide_parts(spark, sf))


CLEAN = r"trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(regexp_replace(trim({}, ' '), '^#{{1,6}}\s*', ''), '**', ''), '==', ''), '^\*(.+)\*$', '\1'), '^- ', '– '), '\s+', ' ', 'g'))"


@query("d06_export_check", rf"""WITH l AS (SELECT 'd' || doc_id AS archive, line, n FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))),
made AS (SELECT archive, CASE WHEN n % 4 = 3 THEN 'IMG' ELSE trim(regexp_replace(trim(line, ' '), '\s+', ' ', 'g')) END AS text FROM l),
draft AS (SELECT archive, CASE WHEN n % 4 = 3 THEN 'IMG' ELSE {CLEAN.format("CASE WHEN n % 6 = 1 THEN '## **' || line || '** more' ELSE line END")} END AS text FROM l WHERE n % 4 = 3 OR n % 6 = 1 OR trim(line, ' ') <> ''),
d AS (SELECT archive, text, sum(d) AS d FROM (SELECT *, 1 AS d FROM made UNION ALL SELECT *, -1 FROM draft) GROUP BY ALL HAVING sum(d) <> 0)
SELECT archive, CASE WHEN d > 0 THEN 'package' ELSE 'draft' END AS side, text, CAST(abs(d) AS BIGINT) AS n FROM d""")
def d06_export_check(spark, sf):
    """The packages against drafts with marks in which every sixth line has grown."""
    line = lambda x, n: F.when(n % 4 == 3, F.concat(F.lit("![p]("), n, F.lit(")"))).when(n % 6 == 1, F.concat(F.lit("## **"), x, F.lit("** more"))).when((n % 6 == 2) & (F.trim(x) != "") & ~x.contains("|"), F.concat(F.lit("| "), x, F.lit(" |\n| --- |"))).otherwise(x)
    drafts = table(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("archive"), F.array_join(F.transform(F.split("text", "\n"), line), "\n").alias("text"))
    return packages.export_differences(packages.paragraphs(word_parts(spark, sf)), drafts)
