"""Boxes on slides, table blocks in text and one-dimensional clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pairs(boxes: DataFrame) -> DataFrame:
    """Pairs of boxes on one slide, i < j; a slide's few boxes meet, never all boxes."""
    cols = ("i", "x", "y", "w", "h")
    return boxes.select("slide", *[F.col(c).alias(f"a_{c}") for c in cols]).join(boxes.select("slide", *[F.col(c).alias(f"b_{c}") for c in cols]), "slide").where("a_i < b_i")


def depth(axis: str, size: str) -> Column:
    return F.least(F.expr(f"a_{axis} + a_{size}"), F.expr(f"b_{axis} + b_{size}")) - F.greatest(F.col(f"a_{axis}"), F.col(f"b_{axis}"))


def collisions(boxes: DataFrame, least: float = 0.08) -> DataFrame:
    """(slide, i, j, dx, dy): boxes that overlap deeper than ``least`` both ways."""
    p = _pairs(boxes).withColumns({"dx": depth("x", "w"), "dy": depth("y", "h")})
    return p.where((F.col("dx") > least) & (F.col("dy") > least)).select("slide", F.col("a_i").alias("i"), F.col("b_i").alias("j"), "dx", "dy")


def misaligned_rows(boxes: DataFrame, eps: float = 0.02, like: float = 0.6) -> DataFrame:
    """(slide, i, j): boxes of one size class that share a row but not top and height."""
    p = _pairs(boxes)
    same = (F.abs(F.col("a_w") - F.col("b_w")) < like) & (F.abs(F.col("a_h") - F.col("b_h")) < like)
    row = depth("y", "h") > 0.5 * F.least("a_h", "b_h")
    off = (F.abs(F.col("a_y") - F.col("b_y")) > eps) | (F.abs(F.col("a_h") - F.col("b_h")) > eps)
    return p.where(same & row & off).select("slide", F.col("a_i").alias("i"), F.col("b_i").alias("j"))


def contained(inner: DataFrame, outer: DataFrame, eps: float = 0.02) -> DataFrame:
    """(slide, i, j, above): inner boxes that lie in outer ones, and how far below the outer's top."""
    a = inner.select("slide", *[F.col(c).alias(f"a_{c}") for c in ("i", "x", "y", "w", "h")])
    b = outer.select("slide", *[F.col(c).alias(f"b_{c}") for c in ("i", "x", "y", "w", "h")])
    p = a.join(b, "slide").where("a_i <> b_i")
    inside = (F.col("b_x") - eps <= F.col("a_x")) & (F.expr("a_x + a_w") <= F.expr("b_x + b_w") + eps) & (F.col("b_y") - eps <= F.col("a_y")) & (F.expr("a_y + a_h") <= F.expr("b_y + b_h") + eps)
    return p.where(inside).select("slide", F.col("a_i").alias("i"), F.col("b_i").alias("j"), (F.col("a_y") - F.col("b_y")).alias("above"))


def greedy_clusters(values: Column, eps: float) -> Column:
    """Array of (rep, n): ascending values join the first cluster whose representative is within eps."""
    kind = "array<struct<rep:double,n:int>>"

    def step(s: Column, v: Column) -> Column:
        near = lambda c: F.abs(c.rep - v) <= eps
        # ascending values can only be near the last cluster
        last = F.element_at(s, -1)
        joined = F.concat(F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0))), F.array(F.struct(last.rep.alias("rep"), (last.n + 1).alias("n"))))
        new = F.concat(s, F.array(F.struct(v.alias("rep"), F.lit(1).alias("n"))))
        return F.when(F.size(s) == 0, new).when(near(last), joined).otherwise(new).cast(kind)

    return F.aggregate(F.array_sort(F.filter(values, lambda v: v.isNotNull())), F.expr(f"cast(array() as {kind})"), step)


def pitches(tops: DataFrame, low: float = 0.3, high: float = 4.0) -> DataFrame:
    """(slide, pitch): distances of neighbouring distinct tops, within bounds; tops (slide, y)."""
    d = tops.select("slide", "y").distinct()
    p = d.select("slide", (F.col("y") - F.lag("y").over(Window.partitionBy("slide").orderBy("y"))).alias("pitch"))
    return p.where((F.col("pitch") > low) & (F.col("pitch") < high))


def table_blocks(lines: DataFrame) -> DataFrame:
    """(doc, block, first, n): runs of consecutive pipe rows; lines (doc, line, text)."""
    rows = lines.where(F.col("text").rlike(r"^\s*\|.*\|\s*$")).select("doc", "line")
    rows = rows.withColumn("block", F.col("line") - F.row_number().over(Window.partitionBy("doc").orderBy("line")))
    return rows.groupBy("doc", "block").agg(F.min("line").alias("first"), F.count("*").alias("n"))


def carried(lines: DataFrame, value: Column, name: str) -> DataFrame:
    """lines with the last value that isn't null at or before each line."""
    w = Window.partitionBy("doc").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn(name, F.last(value, ignorenulls=True).over(w))


def widest_gap(taken: DataFrame, low: int, high: int) -> DataFrame:
    """(page, start, length): the widest run of free bins in [low, high), the first of equals; taken (page, bin)."""
    pages = taken.select("page").distinct()
    bins = pages.select("page", F.explode(F.sequence(F.lit(low), F.lit(high - 1))).alias("bin"))
    free = bins.join(taken.select("page", "bin").distinct(), ["page", "bin"], "left_anti")
    free = free.withColumn("run", F.col("bin") - F.row_number().over(Window.partitionBy("page").orderBy("bin")))
    runs = free.groupBy("page", "run").agg(F.min("bin").alias("start"), F.count("*").alias("length"))
    return runs.groupBy("page").agg(F.max(F.struct("length", (-F.col("start")).alias("before"))).alias("x")).select("page", (-F.col("x.before")).alias("start"), F.col("x.length").alias("length"))


def spread_clusters(values: Column, eps: float) -> Column:
    """greedy_clusters with spread, the largest distance of a member from the representative."""
    own = F.filter(values, lambda v: v.isNotNull())
    clusters = greedy_clusters(own, eps)
    # ascending clusters are apart: a value belongs to the last one whose representative isn't above it
    last = lambda c, k: F.coalesce(F.array_max(F.filter(own, lambda v: (v >= c.rep) & (v - c.rep <= eps))) - c.rep, F.lit(0.0))
    return F.transform(clusters, lambda c, k: F.struct(c.rep.alias("rep"), c.n.alias("n"), last(c, k).alias("spread")))


def content_box(pixels: DataFrame, threshold: int, least: float, width: int, height: int) -> DataFrame:
    """(id, x0, y0, x1, y1) of what is darker than the threshold: from the first to the last column and row in which
    that holds for the share ``least`` of pixels, one at least; blank pages have no row. pixels: id, x, y, gray."""
    dark = pixels.where(F.col("gray") < threshold)

    def ends(axis: str, size: int) -> DataFrame:
        full = dark.groupBy("id", axis).agg(F.count("*").alias("n")).where(F.col("n") >= max(1, int(least * size)))
        return full.groupBy("id").agg(F.min(axis).alias(f"{axis}0"), (F.max(axis) + 1).alias(f"{axis}1"))

    return ends("x", height).join(ends("y", width), "id").select("id", "x0", "y0", "x1", "y1")


def spine_range(spines: DataFrame, by: str, value: str) -> DataFrame:
    """(by, median, low, high); the median is the upper of two."""
    ordered = F.array_sort(F.collect_list(value))
    return spines.groupBy(by).agg(ordered.alias("v")).select(by, F.get("v", F.expr("size(v) div 2")).alias("median"), F.get("v", F.lit(0)).alias("low"), F.element_at("v", -1).alias("high"))


def table_grep(lines: DataFrame, pattern: str, text_col: str = "text") -> DataFrame:
    """Rows of tables with a cell that matches."""
    row = F.regexp_extract(text_col, r"^\s*\|(.+)\|\s*$", 1)
    cells = F.transform(F.split(row, r"\|"), F.trim)
    return lines.where((row != "") & F.exists(cells, lambda c: c.rlike(pattern)))
