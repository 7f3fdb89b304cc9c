"""Tables from the boxes of words on a page: lines by vertical overlap, blocks by vertical gaps, columns by gaps that run
through a whole block, cells by the column that a word lies in.

Everything is windows over a page or a block, which one printed page bounds.

Defined results: words without text, or with a null coordinate, are left out. Words that touch in height are one line. A block is
a table if it has enough lines and at least two columns; others give nothing. Words of a cell are joined by blanks from left to
right, within a line. Equal places are ordered by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _groups(rows: DataFrame, keys: list[str], low: str, high: str, gap: float, name: str, *tie: str) -> DataFrame:
    """rows with the number, from 0, of the run of intervals [low, high] that they lie in; a new run begins after a gap."""
    w = Window.partitionBy(*keys).orderBy(low, high, *tie)
    so_far = F.max(high).over(w.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col(low) - so_far > gap, 1).otherwise(0)
    return rows.withColumn("_new", begins).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_new")


def cells(words: DataFrame, line_gap: float = 0.0, block_gap: float = 14.0, column_gap: float = 6.0, min_rows: int = 3) -> DataFrame:
    """(doc, page, block, row, col, text) of tables; words: doc, page, x0, y0, x1, y1, text. Cells of nothing are empty."""
    keys = ["doc", "page"]
    usable = (F.coalesce(F.trim("text"), F.lit("")) != "") & (F.col("x0") + F.col("x1") + F.col("y0") + F.col("y1")).isNotNull()
    rows = _groups(words.where(usable).select(*keys, "x0", "y0", "x1", "y1", F.trim("text").alias("text")), keys, "y0", "y1", line_gap, "line", "x0", "x1", "text")
    rows = _groups(rows, keys, "y0", "y1", block_gap, "block", "x0", "x1", "text")
    rows = _groups(rows, [*keys, "block"], "x0", "x1", column_gap, "col", "y0", "y1", "text")
    rows = rows.withColumn("row", F.dense_rank().over(Window.partitionBy(*keys, "block").orderBy("line")) - 1)
    whole = Window.partitionBy(*keys, "block")
    rows = rows.withColumns({"n_rows": F.max("row").over(whole) + 1, "n_cols": F.max("col").over(whole) + 1}).where((F.col("n_rows") >= min_rows) & (F.col("n_cols") >= 2))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda x: x["text"]), " ")
    found = rows.groupBy(*keys, "block", "row", "col").agg(text.alias("text"))
    grid = rows.select(*keys, "block", "n_rows", "n_cols").distinct().select(*keys, "block", F.explode(F.sequence(F.lit(0), F.col("n_rows") - 1)).alias("row"), "n_cols")
    grid = grid.select(*keys, "block", "row", F.explode(F.sequence(F.lit(0), F.col("n_cols") - 1)).alias("col"))
    return grid.join(found, [*keys, "block", "row", "col"], "left").select(*keys, "block", "row", "col", F.coalesce("text", F.lit("")).alias("text"))


def tables(found: DataFrame) -> DataFrame:
    """(doc, page, block, header, rows, n_rows): the first line of each table as its header."""
    cell: Column = F.struct("col", F.regexp_replace(F.regexp_replace("text", r"\*\*|__", ""), r"\s+", " ").alias("text"))
    lines = found.groupBy("doc", "page", "block", "row").agg(F.transform(F.array_sort(F.collect_list(cell)), lambda x: x["text"]).alias("cells"))
    whole = lines.groupBy("doc", "page", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "cells"))), lambda x: x["cells"]).alias("all"))
    return whole.select("doc", "page", "block", F.get("all", F.lit(0)).alias("header"), F.slice("all", F.lit(2), F.size("all")).alias("rows"), (F.size("all") - 1).alias("n_rows"))
