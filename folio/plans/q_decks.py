"""The whole check of decks: line items as shapes on slides, forty orders a deck."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import deck

from .lifts import table
from .registry import query

SLIDE = (10.0, 5.625)

SHAPES = """shapes AS (SELECT l_orderkey // 40 AS deck, l_orderkey % 40 AS slide, l_linenumber AS i, l_quantity / 5 AS x, l_discount * 40 + l_linenumber % 3 * 0.05::DOUBLE AS y, 1 + l_tax * 30 + l_partkey % 5 * 0.01::DOUBLE AS w, 0.5 + l_linenumber / 4.0::DOUBLE AS h, l_suppkey % 4 = 0 AS picture, l_suppkey % 4 = 1 AS filled,
 CASE WHEN l_suppkey % 4 > 1 THEN l_returnflag || ' part ' || l_partkey || ' of order ' || l_orderkey ELSE '' END AS text, 12 + l_partkey % 9 * 0.75::DOUBLE AS pt, CASE l_suppkey % 3 WHEN 0 THEN 'middle' WHEN 1 THEN 'top' END AS anchor, l_partkey % 50 = 0 AS autofit FROM lineitem),
s AS (SELECT *, x + 0.1::DOUBLE AS x0, y - 0.05::DOUBLE AS y0, x + 0.1::DOUBLE + w * 0.5::DOUBLE AS x1, y - 0.05::DOUBLE + h * 0.5::DOUBLE AS y1 FROM shapes),
c AS (SELECT * FROM s WHERE filled AND w < 0.9::DOUBLE * 10 AND h < 0.9::DOUBLE * 5.625::DOUBLE),
t AS (SELECT * FROM s WHERE text <> ''),
"pairs" AS (SELECT a.deck, a.slide, a.text AS ta, b.text AS tb, a.y AS ay, b.y AS "by", a.pt = b.pt AS same, least(a.x1, b.x1) - greatest(a.x0, b.x0) AS dx, least(a.y1, b.y1) - greatest(a.y0, b.y0) AS dy, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y) AS tall, least(a.h, b.h) AS low FROM t a JOIN t b ON a.deck = b.deck AND a.slide = b.slide AND a.i < b.i),
pics AS (SELECT a.deck, a.slide, a.text AS ta, least(a.x1, b.x + b.w) - greatest(a.x0, b.x) AS dx, least(a.y1, b.y + b.h) - greatest(a.y0, b.y) AS dy FROM t a JOIN s b ON b.picture AND a.deck = b.deck AND a.slide = b.slide AND a.i <> b.i),
sizes AS (SELECT deck, list_sort(list(DISTINCT pt)) AS l FROM t GROUP BY deck),
widths AS (SELECT deck, unnest(list_reduce(list_transform(list_sort(list(round(w, 3))), lambda v: [{'rep': v, 'n': 1, 'spread': 0.0::DOUBLE}]), lambda l, v: CASE WHEN v[1].rep - l[-1].rep <= 0.25 THEN list_append(l[:-2], {'rep': l[-1].rep, 'n': l[-1].n + 1, 'spread': v[1].rep - l[-1].rep}) ELSE list_concat(l, v) END)) AS k FROM s WHERE picture GROUP BY deck),
found AS (SELECT deck, slide, 'W-autofit' AS code, 'normAutofit on ''' || left(text, 30) || '''' AS message FROM t WHERE autofit
 UNION ALL SELECT deck, slide, 'E-bounds', 'text ''' || left(text, 30) || ''' rendered bbox (' || format('{:.2f},{:.2f})-({:.2f},{:.2f}', x0, y0, x1, y1) || ') leaves the slide' FROM t WHERE x1 > 10 + 0.02::DOUBLE OR x0 < -0.02::DOUBLE OR y0 < -0.02::DOUBLE OR y1 > 5.625::DOUBLE + 0.02::DOUBLE
 UNION ALL SELECT deck, slide, 'E-collide', 'text ''' || left(ta, 25) || ''' and ''' || left(tb, 25) || ''' overlap ' || format('{:.2f}x{:.2f}"', dx, dy) FROM "pairs" WHERE dx > 0.08::DOUBLE AND dy > 0.08::DOUBLE
 UNION ALL SELECT deck, slide, 'W-pic', 'text ''' || left(ta, 25) || ''' over picture by ' || format('{:.2f}x{:.2f}"', dx, dy) FROM pics WHERE dx > 0.08::DOUBLE AND dy > 0.08::DOUBLE
 UNION ALL SELECT a.deck, a.slide, 'E-align', format('sibling blocks tops {:.3f}/{:.3f} heights {:.3f}/{:.3f}', a.y, b.y, a.h, b.h) FROM c a JOIN c b ON a.deck = b.deck AND a.slide = b.slide AND a.i < b.i WHERE abs(a.w - b.w) < 0.6::DOUBLE AND abs(a.h - b.h) < 0.6::DOUBLE AND least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y) > 0.5::DOUBLE * least(a.h, b.h) AND (abs(a.y - b.y) > 0.02::DOUBLE OR abs(a.h - b.h) > 0.02::DOUBLE)
 UNION ALL SELECT deck, slide, 'W-stagger', '''' || left(ta, 20) || ''' vs ''' || left(tb, 20) || format(''': tops differ {:.1f}px', abs(ay - "by") * 96) FROM "pairs" WHERE same AND tall > 0.6::DOUBLE * low AND abs(ay - "by") > 0.02::DOUBLE AND abs(ay - "by") <= 0.15::DOUBLE
 UNION ALL SELECT a.deck, a.slide, 'W-center', '''' || left(a.text, 30) || ''' floated at y+' || format('{:.2f}" in {:.2f}" card with anchor=TOP', a.y - b.y, b.h) FROM t a JOIN c b ON a.deck = b.deck AND a.slide = b.slide WHERE coalesce(a.anchor, 'top') = 'top' AND b.x - 0.02::DOUBLE <= a.x AND a.x + a.w <= b.x + b.w + 0.02::DOUBLE AND b.y - 0.02::DOUBLE <= a.y AND a.y + a.h <= b.y + b.h + 0.02::DOUBLE AND a.y - b.y > 0.5::DOUBLE AND b.y + b.h - (a.y + a.h) > 0.3::DOUBLE
 UNION ALL SELECT deck, 0, 'W-tokens', len(l) || ' font sizes (budget 8): [' || array_to_string(l, ', ') || ']' FROM sizes WHERE len(l) > 8
 UNION ALL SELECT deck, 0, 'W-tokens', 'quarter-point sizes (px*0.75 conversion smell): [' || array_to_string(list_filter(l, lambda v: v * 4 = floor(v * 4) AND v * 2 <> floor(v * 2)), ', ') || ']' FROM sizes WHERE len(list_filter(l, lambda v: v * 4 = floor(v * 4) AND v * 2 <> floor(v * 2))) > 0
 UNION ALL SELECT deck, 0, 'W-drift', k.n || format(' near-identical pictures drift {:.1f}px around {:.2f}"', k.spread * 96, k.rep) FROM widths WHERE k.n > 1 AND k.spread > 0.02::DOUBLE)"""


def shapes(spark, sf):
    k, i, part, supp = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    text = F.when(supp % 4 > 1, F.concat("l_returnflag", F.lit(" part "), part, F.lit(" of order "), k))
    own = table(spark, sf, "lineitem").select(
        F.floor(k / 40).alias("deck"), (k % 40).alias("slide"), i.alias("i"), (F.col("l_quantity") / 5).alias("x"), (F.col("l_discount") * 40 + i % 3 * F.lit(0.05)).alias("y"), (1 + F.col("l_tax") * 30 + part % 5 * F.lit(0.01)).alias("w"), (0.5 + i / 4.0).alias("h"),
        (supp % 4 == 0).alias("picture"), (supp % 4 == 1).alias("filled"), text.alias("text"), (12 + part % 9 * F.lit(0.75)).alias("pt"), F.when(supp % 3 == 0, "middle").when(supp % 3 == 1, "top").alias("anchor"), (part % 50 == 0).alias("autofit"),
    )
    return own.withColumns({"sizes": F.array("pt"), "x0": F.col("x") + 0.1, "y0": F.col("y") - 0.05, "x1": F.col("x") + 0.1 + F.col("w") * 0.5, "y1": F.col("y") - 0.05 + F.col("h") * 0.5})


@query("g03_deck_lint", f"WITH {SHAPES} SELECT * FROM found")
def g03_deck_lint(spark, sf):
    return deck.lint(shapes(spark, sf), *SLIDE)


@query("g03_deck_gate", f"WITH {SHAPES} SELECT deck, coalesce(e, 0) AS errors, coalesce(w, 0) AS warnings, coalesce(e, 0) = 0 AS passed FROM (SELECT DISTINCT deck FROM shapes) LEFT JOIN (SELECT deck, count(*) FILTER (code LIKE 'E-%') AS e, count(*) FILTER (code LIKE 'W-%') AS w FROM found GROUP BY deck) USING (deck)")
def g03_deck_gate(spark, sf):
    own = shapes(spark, sf)
    return deck.deck_gate(own, deck.lint_counts(own, *SLIDE))
