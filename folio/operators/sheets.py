"""Scanned sheets: confidence, spreads of two pages, lines that a cut would hurt, marks, and references that are furniture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_confidence(lines: DataFrame, page: str, confidence: Column) -> DataFrame:
    """(page, conf): the mean over lines that have one; null for a page without any."""
    return lines.groupBy(page).agg(F.avg(confidence).alias("conf"))


def doubtful_pages(means: DataFrame, floor: float) -> DataFrame:
    """Pages whose mean is known, above nothing, and below the floor."""
    return means.where((F.col("conf") > 0) & (F.col("conf") < floor))


def spreads(words: DataFrame, page: str, left: Column, right: Column, width: Column, height: Column | None = None, middle: float = 0.5, margin: float = 0.1, ratio: float = 1.15) -> DataFrame:
    """(page, spread): whether a landscape sheet has text that ends left of the middle and text that begins right of it.

    left, right: of the words, in the unit of width. A word counts for the left half if it begins ``margin`` of the width before the
    middle and ends before it. Without a height every sheet is landscape.
    """
    mid = width * middle
    both = F.bool_or((left < mid - width * margin) & (right < mid)) & F.bool_or(left > mid)
    wide = F.lit(True) if height is None else F.bool_and(width >= height * ratio)
    return words.groupBy(page).agg((both & wide).alias("spread"))


def cut_lines(lines: DataFrame, page: str, left: Column, right: Column, spine: Column) -> DataFrame:
    """(page, cut): lines that cross the spine, of sheets that have any."""
    return lines.where((left < spine) & (right > spine)).groupBy(page).agg(F.count("*").alias("cut"))


def worst_sheets(cut: DataFrame, page: str, most: int = 8) -> DataFrame:
    """The sheets with most lines cut; a report of its length."""
    return cut.orderBy(F.desc("cut"), page).limit(most)


def furniture_references(refs: DataFrame, ref: str, doc: str, least: int) -> DataFrame:
    """(ref, docs): references that stand in so many documents that they belong to the site, not to the text."""
    return refs.select(ref, doc).distinct().groupBy(ref).agg(F.count(doc).alias("docs")).where(F.col("docs") >= least)


def marks_complete(text: Column, mark: str, least: Column, failure: str = "OCR FAILED") -> Column:
    """Whether a text has as many page marks as its source has pages, and no page that failed."""
    return (F.regexp_count(text, F.lit(mark)) >= least) & ~text.contains(failure)
