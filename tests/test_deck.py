import random
from collections import Counter

from folio.operators import deck

SCHEMA = "deck int, slide int, i int, x double, y double, w double, h double, picture boolean, filled boolean, text string, pt double, sizes array<double>, anchor string, autofit boolean, x0 double, y0 double, x1 double, y1 double, code string, a int"


def shape(i, x, y, w, h, text=None, kind="text", slide=1, pt=12.0, anchor="top", autofit=False, sizes=None):
    box = (x + 0.1, y + 0.05, x + 0.1 + 0.6 * w, y + 0.05 + 0.6 * h) if text else (None,) * 4
    return (7, slide, i, x, y, w, h, kind == "pic", kind == "card" or None, text, pt, sizes or ([pt] if text else None), anchor, autofit or None, *box, "other", 0)


def codes(spark, *shapes, **more):
    return Counter((r.slide, r.code) for r in deck.lint(spark.createDataFrame(list(shapes), SCHEMA), 10.0, 5.6, **more).collect())


def test_each_finding(spark):
    assert codes(spark, shape(1, 1.0, 1.0, 2.0, 1.0, "a"), shape(2, 1.2, 1.2, 2.0, 1.0, "b", pt=14.0)) == {(1, "E-collide"): 1}
    assert codes(spark, shape(1, 9.0, 1.0, 2.0, 1.0, "a")) == {(1, "E-bounds"): 1} and codes(spark, shape(1, 8.0, 1.0, 2.0, 1.0, "a", autofit=True)) == {(1, "W-autofit"): 1}
    assert codes(spark, shape(2, 1.0, 1.0, 2.0, 1.0, "a"), shape(1, 1.0, 1.0, 3.0, 3.0, kind="pic")) == {(1, "W-pic"): 1}
    assert codes(spark, shape(1, 1.0, 1.0, 2.0, 1.0, kind="card"), shape(2, 4.0, 1.1, 2.0, 1.0, kind="card")) == {(1, "E-align"): 1}
    assert codes(spark, shape(1, 1.0, 1.0, 2.0, 1.0, kind="card"), shape(2, 0.0, 0.0, 9.5, 5.6, kind="card")) == {}
    assert codes(spark, shape(1, 1.0, 1.0, 2.0, 1.0, "a"), shape(2, 4.0, 1.1, 2.0, 1.0, "b")) == {(1, "W-stagger"): 1}
    floated = [shape(1, 1.0, 1.0, 3.0, 4.0, kind="card"), shape(2, 1.2, 2.0, 2.0, 1.0, "a", anchor=None)]
    assert codes(spark, *floated) == {(1, "W-center"): 1} and codes(spark, floated[0], shape(2, 1.2, 2.0, 2.0, 1.0, "a", anchor="middle")) == {}
    sizes = [10.0, 10.25, 11.0, 10.75]
    found = deck.lint(spark.createDataFrame([shape(1, 1.0, 1.0, 2.0, 1.0, "a", sizes=sizes)], SCHEMA), 10.0, 5.6, most_sizes=3)
    assert {r.message for r in found.collect()} == {"4 font sizes (budget 3): [10.0, 10.25, 10.75, 11.0]", "quarter-point sizes (px*0.75 conversion smell): [10.25, 10.75]"}
    drift = deck.lint(spark.createDataFrame([shape(k, 1.0, 1.0, w, 1.0, kind="pic", slide=k) for k, w in enumerate([2.0, 2.1, 3.0, 3.01])], SCHEMA), 10.0, 5.6)
    assert [tuple(r) for r in drift.collect()] == [(7, 0, "W-drift", '2 near-identical pictures drift 9.6px around 2.00"')]


def test_slides_gates_and_nothing(spark):
    two = [shape(1, 1.0, 1.0, 2.0, 1.0, "a"), shape(2, 1.0, 1.0, 2.0, 1.0, "b"), shape(1, 9.0, 1.0, 2.0, 1.0, "c", slide=2), shape(3, 1.0, None, 2.0, None, kind="card")]
    assert codes(spark, *two) == {(1, "E-collide"): 1, (2, "E-bounds"): 1} and codes(spark, *two, only_slide=2) == {(2, "E-bounds"): 1}
    calm = spark.createDataFrame([shape(1, 1.0, 1.0, 2.0, 1.0, "a", autofit=True)], SCHEMA)
    found = deck.lint(calm, 10.0, 5.6)
    assert [tuple(r) for r in deck.deck_gate(calm, found).collect()] == [(7, 0, 1, True)] and deck.deck_gate(calm, found, strict=True).head().passed is False
    assert deck.lint(calm.limit(0), 10.0, 5.6).count() == 0


def test_pairs_against_loops(spark):
    rng = random.Random(3)
    near = lambda: rng.choice([1.0, 1.05, 1.2, 2.0, 2.6])
    own = [shape(i, near(), near(), near(), near() + 0.5, *rng.choice([("t", "text"), (None, "pic"), (None, "card")]), slide=s, pt=rng.choice([10.0, 11.0])) for s in range(20) for i in range(6)]
    want = Counter()
    cols = [c.split()[0] for c in SCHEMA.split(", ")]
    rows = [dict(zip(cols, r, strict=True)) for r in own]
    over = lambda a0, a1, b0, b1: min(a1, b1) - max(a0, b0)
    for a in rows:
        for b in rows:
            if a["slide"] != b["slide"] or a["i"] == b["i"]:
                continue
            tall, off = over(a["y"], a["y"] + a["h"], b["y"], b["y"] + b["h"]), abs(a["y"] - b["y"])
            if a["i"] < b["i"] and a["text"] and b["text"]:
                want[a["slide"], "E-collide"] += over(a["x0"], a["x1"], b["x0"], b["x1"]) > 0.08 and over(a["y0"], a["y1"], b["y0"], b["y1"]) > 0.08
                want[a["slide"], "W-stagger"] += a["pt"] == b["pt"] and tall > 0.6 * min(a["h"], b["h"]) and 0.02 < off <= 0.15
            if a["i"] < b["i"] and a["filled"] and b["filled"]:
                want[a["slide"], "E-align"] += abs(a["w"] - b["w"]) < 0.6 and abs(a["h"] - b["h"]) < 0.6 and tall > 0.5 * min(a["h"], b["h"]) and (off > 0.02 or abs(a["h"] - b["h"]) > 0.02)
            if a["text"] and b["picture"]:
                want[a["slide"], "W-pic"] += over(a["x0"], a["x1"], b["x"], b["x"] + b["w"]) > 0.08 and over(a["y0"], a["y1"], b["y"], b["y"] + b["h"]) > 0.08
    got = codes(spark, *own)
    kinds = ("E-collide", "W-stagger", "E-align", "W-pic")
    assert {k: n for k, n in got.items() if k[1] in kinds} == {k: n for k, n in want.items() if n} and all(any(k[1] == c for k in got) for c in kinds)
