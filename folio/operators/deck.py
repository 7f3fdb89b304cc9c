"""The whole check of slide decks: shapes with the measured boxes of their text, findings as errors and warnings.

Shapes are rows (deck, slide, i, x, y, w, h, picture, filled, text, pt, sizes, anchor, autofit, x0, y0, x1, y1)
in inches: x0 to y1 is the box of the text as it is rendered, null without text; sizes are the font sizes that its runs
state, in points, pt the largest in effect; anchor is top, middle, bottom or null. Only the shapes of one slide meet, in one join.

Defined results: a shape without text has a null or blank text and is in no finding on text; a null place or size takes
part in no comparison; null ``picture``, ``filled`` and ``autofit`` are false. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.records import rounded, say, shown
from folio.storage import all_of

from .geometry import spread_clusters

# How deep boxes overlap, what counts as one class, one row, a stagger and a float, in inches.
OVERLAP, LIKE, ROW, SAME_LINE, STAGGER, FLOATED, BELOW, DRIFT, PICTURES, PIXELS = 0.08, 0.6, 0.5, 0.6, 0.15, 0.5, 0.3, 0.02, 0.25, 96
SHAPE = ("i", "x", "y", "w", "h", "picture", "filled", "text", "pt", "sizes", "anchor", "autofit", "x0", "y0", "x1", "y1")


def quoted(text: Column, n: int) -> Column:
    return say("'", F.left(text, F.lit(n)), "'")


def issue(told: Column, code: str, *message: Column | str) -> tuple:
    """When a finding holds, its code and its message."""
    return told, code, message


def told_of(issues: list[tuple]) -> Column:
    """The findings that hold as rows (code, message)."""
    return F.inline(F.array_compact(F.array(*(F.when(told, F.struct(F.lit(code).alias("code"), say(*message).alias("message"))) for told, code, message in issues))))


def counts_of(issues: list[tuple]) -> list[Column]:
    """How many of the findings that hold are errors and warnings."""
    number = lambda kind: sum((F.when(told, 1).otherwise(0) for told, code, _ in issues if code.startswith(kind)), F.lit(0)).cast("long")
    return [number("E-").alias("errors"), number("W-").alias("warnings")]


def right(s: Column) -> Column:
    return s["x"] + s["w"]


def bottom(s: Column) -> Column:
    return s["y"] + s["h"]


def has_text(s: Column) -> Column:
    return s["text"] != ""


def shared(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.least(a1, b1) - F.greatest(a0, b0)


def card(s: Column, width: float, height: float) -> Column:
    """A filled block without text that isn't the slide's ground."""
    return s["filled"] & ~has_text(s) & (s["w"] < 0.9 * width) & (s["h"] < 0.9 * height)


def of_one(s: Column, width: float, height: float, eps: float) -> list[tuple]:
    out = (s["x1"] > width + eps) | (s["x0"] < -eps) | (s["y0"] < -eps) | (s["y1"] > height + eps)
    box = ("(", shown(s["x0"], 2), ",", shown(s["y0"], 2), ")-(", shown(s["x1"], 2), ",", shown(s["y1"], 2), ")")
    return [
        issue(has_text(s) & s["autofit"], "W-autofit", "normAutofit on ", quoted(s["text"], 30)),
        issue(has_text(s) & out, "E-bounds", "text ", quoted(s["text"], 30), " rendered bbox ", *box, " leaves the slide"),
    ]


def of_two(a: Column, b: Column, width: float, height: float, eps: float) -> list[tuple]:
    """What two shapes of a slide show, both ways round; what is alike both ways is told once."""
    once, texts, cards = a["i"] < b["i"], has_text(a) & has_text(b), card(a, width, height) & card(b, width, height)
    dx, dy = shared(a["x0"], a["x1"], b["x0"], b["x1"]), shared(a["y0"], a["y1"], b["y0"], b["y1"])
    px, py = shared(a["x0"], a["x1"], b["x"], right(b)), shared(a["y0"], a["y1"], b["y"], bottom(b))
    tall, apart = shared(a["y"], bottom(a), b["y"], bottom(b)), F.abs(a["y"] - b["y"])
    alike = (F.abs(a["w"] - b["w"]) < LIKE) & (F.abs(a["h"] - b["h"]) < LIKE) & (tall > ROW * F.least(a["h"], b["h"]))
    one_size = (a["pt"] == b["pt"]) & (a["pt"] != 0)
    inside = (b["x"] - eps <= a["x"]) & (right(a) <= right(b) + eps) & (b["y"] - eps <= a["y"]) & (bottom(a) <= bottom(b) + eps)
    top = F.coalesce(a["anchor"], F.lit("top")) == "top"
    return [
        issue(once & texts & (dx > OVERLAP) & (dy > OVERLAP), "E-collide", "text ", quoted(a["text"], 25), " and ", quoted(b["text"], 25), " overlap ", shown(dx, 2), "x", shown(dy, 2), '"'),
        issue(has_text(a) & b["picture"] & (px > OVERLAP) & (py > OVERLAP), "W-pic", "text ", quoted(a["text"], 25), " over picture by ", shown(px, 2), "x", shown(py, 2), '"'),
        issue(once & cards & alike & ((apart > eps) | (F.abs(a["h"] - b["h"]) > eps)), "E-align", "sibling blocks tops ", shown(a["y"], 3), "/", shown(b["y"], 3), " heights ", shown(a["h"], 3), "/", shown(b["h"], 3)),
        issue(once & texts & one_size & (tall > SAME_LINE * F.least(a["h"], b["h"])) & (apart > eps) & (apart <= STAGGER), "W-stagger", quoted(a["text"], 20), " vs ", quoted(b["text"], 20), ": tops differ ", shown(apart * PIXELS, 1), "px"),
        issue(has_text(a) & top & card(b, width, height) & inside & (a["y"] - b["y"] > FLOATED) & (bottom(b) - bottom(a) > BELOW), "W-center", quoted(a["text"], 30), " floated at y+", shown(a["y"] - b["y"], 2), '" in ', shown(b["h"], 2), '" card with anchor=TOP'),
    ]


def listed(values: Column) -> Column:
    return say("[", F.array_join(F.transform(values, lambda v: v.cast("string")), ", "), "]")


def of_deck(shapes: DataFrame, most_sizes: int) -> list[tuple[DataFrame, list[tuple]]]:
    """Findings on a deck's font sizes and the widths of its pictures; slide is 0."""
    sizes = shapes.where("text <> ''").select("deck", F.explode("sizes").alias("s")).where("s <> 0").select("deck", rounded(F.col("s"), 2).alias("s")).distinct()
    each = sizes.groupBy("deck").agg(F.array_sort(F.collect_list("s")).alias("s"))
    quarter = F.filter("s", lambda s: (s * 4 == F.floor(s * 4)) & (s * 2 != F.floor(s * 2)))
    tokens = [
        issue(F.size("s") > most_sizes, "W-tokens", F.size("s"), f" font sizes (budget {most_sizes}): ", listed(F.col("s"))),
        issue(F.size(quarter) > 0, "W-tokens", "quarter-point sizes (px*0.75 conversion smell): ", listed(quarter)),
    ]
    widths = shapes.where("picture").groupBy("deck").agg(F.collect_list(rounded(F.col("w"), 3)).alias("w")).select("deck", F.explode(spread_clusters(F.col("w"), PICTURES)).alias("c"))
    drift = issue((F.col("c.n") > 1) & (F.col("c.spread") > DRIFT), "W-drift", F.col("c.n"), " near-identical pictures drift ", shown(F.col("c.spread") * PIXELS, 1), "px around ", shown(F.col("c.rep"), 2), '"')
    at = lambda df: df.withColumn("slide", F.lit(0))
    return [(at(each), tokens), (at(widths), [drift])]


def checks(shapes: DataFrame, width: float, height: float, eps: float = 0.02, most_sizes: int = 8, only_slide: int | None = None) -> list[tuple[DataFrame, list[tuple]]]:
    """Rows with deck and slide, and the findings on each of them."""
    own = shapes if only_slide is None else shapes.where(F.col("slide") == only_slide)
    flags = {c: F.coalesce(c, F.lit(False)) for c in ("picture", "filled", "autofit")}
    own = own.withColumns(flags | {"text": F.trim(F.coalesce("text", F.lit("")))}).select("deck", "slide", *SHAPE)
    one = own.select("deck", "slide", F.struct(*SHAPE).alias("a"))
    pairs = one.join(one.withColumnRenamed("a", "b"), ["deck", "slide"]).where("a.i <> b.i")
    a, b = F.col("a"), F.col("b")
    return [(one, of_one(a, width, height, eps)), (pairs, of_two(a, b, width, height, eps)), *of_deck(own, most_sizes)]


def lint(shapes: DataFrame, width: float, height: float, **bounds) -> DataFrame:
    """(deck, slide, code, message): errors (E-) and warnings (W-) of decks whose slides are so wide and high; bounds: of ``checks``."""
    return all_of([rows.select("deck", "slide", told_of(issues)) for rows, issues in checks(shapes, width, height, **bounds)])


def lint_counts(shapes: DataFrame, width: float, height: float, **bounds) -> DataFrame:
    """(deck, errors, warnings): how many findings ``lint`` has of a deck, without making them. A deck may have several rows."""
    return all_of([rows.select("deck", *counts_of(issues)) for rows, issues in checks(shapes, width, height, **bounds)])


def deck_gate(shapes: DataFrame, found: DataFrame, strict: bool = False) -> DataFrame:
    """(deck, errors, warnings, passed) from findings or their counts: a deck passes without errors; under the strict gate, without findings."""
    kinds = {"errors": "E-%", "warnings": "W-%"}
    counts = found.groupBy("deck").agg(*(F.sum(F.col("code").like(k).cast("long") if "code" in found.columns else F.col(n)).alias(n) for n, k in kinds.items()))
    each = shapes.select("deck").distinct().join(counts, "deck", "left").select("deck", *(F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in kinds))
    return each.withColumn("passed", (F.col("errors") + (F.col("warnings") if strict else F.lit(0))) == 0)
