"""Texts that are published in sections: links of a contents page, attempts to render them, and the text put together.

Defined results: a link counts once, at its first place. With a filter of labels, links keep the order of the contents; without,
they are ordered by address. Of a section's attempts the first that didn't fail counts, up to ``ATTEMPTS``; a section of which
all failed, or that was never rendered, is missing and named. A kept section's number is its place among the kept ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import records as rc

from . import pages as pg
from .numbering import numbered

ATTEMPTS = 3


def contents_links(contents: DataFrame, address: str, label: str | None = None, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, k, label, url): markdown links of a contents page to addresses that match, each once, by k from 1. label: of links
    with such a label only, whatever their case."""
    link = rf"\[([^\]]*)\]\(({address})\)"
    all_ = lambda n: F.regexp_extract_all(text_col, F.lit(link), F.lit(n))
    rows = contents.select(F.col(id_col).alias("id"), F.posexplode(F.arrays_zip(all_(1).alias("label"), all_(2).alias("url"))).alias("at", "x")).select("id", "at", "x.label", "x.url")
    if label:
        rows = rows.where(F.col("label").rlike(f"(?i){label}"))
    first = rows.groupBy("id", "url").agg(F.min(F.struct("at", "label")).alias("x")).select("id", "url", "x.at", "x.label")
    return numbered(first, ["id"], [F.col("at") if label else F.col("url")], "k").select("id", "k", "label", "url")


def rendered(links: DataFrame, attempts: DataFrame, wanted: str | None = None) -> DataFrame:
    """links with text and state: kept, missing, empty or other (its text doesn't match what is wanted). attempts: url, attempt, text."""
    clean = rc.without_furniture(F.col("text"))
    # no filter on the cleaned text: it would be cleaned again for every place in the filter that names it
    tried = attempts.where(F.col("attempt").between(0, ATTEMPTS - 1)).select("url", "attempt", F.when(~rc.failed_render(clean), clean).alias("text"))
    good = tried.groupBy("url").agg(F.min_by("text", F.when(F.col("text").isNotNull(), F.col("attempt"))).alias("text"))
    state: Column = F.when(F.col("text").isNull(), "missing").when(F.col("text") == "", "empty")
    if wanted:
        state = state.when(~F.col("text").rlike(f"(?i){wanted}"), "other")
    return links.join(good, "url", "left").select("id", "k", "label", "url", "text", state.otherwise("kept").alias("state"))


def renumbered(sections: DataFrame) -> DataFrame:
    """(id, page, url, text): the kept sections, numbered anew from 1."""
    return numbered(sections.where("state = 'kept'").select("id", "k", "url", "text"), ["id"], [F.col("k")], "page").select("id", F.col("page").cast("int").alias("page"), "url", "text")


def act_texts(sections: DataFrame, source: Column) -> DataFrame:
    """(id, text, kept, chosen, status, missing): the act with a page mark per kept section; PARTIAL if any is missing."""
    facts = sections.groupBy("id").agg(F.count("*").alias("chosen"), F.array_sort(F.collect_list(F.when(F.col("state") == "missing", F.col("url")))).alias("missing"))
    part = F.concat(pg.page_mark(F.col("page")), F.lit("\n\n"), "text")
    bodies = renumbered(sections).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("page", part.alias("t")))).alias("parts"))
    rows = facts.join(bodies, "id")
    head = F.concat(F.lit("*Source: "), source, F.lit(" — "), F.size("parts").cast("string"), F.lit(" of "), F.col("chosen").cast("string"), F.lit(" sections*\n"))
    text = F.concat(head, F.lit("\n\n"), F.array_join(F.transform("parts", lambda p: p["t"]), "\n\n"), F.lit("\n"))
    return rows.select("id", text.alias("text"), F.size("parts").cast("long").alias("kept"), "chosen", F.when(F.size("missing") > 0, "PARTIAL").otherwise("OK").alias("status"), "missing")
