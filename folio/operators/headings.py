"""Headings of markdown: lists, keys, the pages they stand on, and levels set by a reference text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What is a heading, the marks around a table of contents, how much of a title is looked for.
HEADING = r"^(#{1,6})\s+(.*\S)\s*$"
TOC_START, TOC_END = "<!-- toc -->", "<!-- /toc -->"
KEY_CHARS = 60
#: Where a heading stands: before the contents, right above them, behind them.
BEFORE, OWN, BEHIND = 0, 1, 2


def plain_heading(text: Column) -> Column:
    """Without tags and emphasis, single blanks."""
    bare = F.regexp_replace(F.regexp_replace(text, "<[^>]+>", ""), "[*_`]", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def search_key(text: Column) -> Column:
    """For finding a heading in page text: no soft hyphens, single blanks, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.replace(text, F.lit("\u00ad"), F.lit("")), r"\s+", " ")))


def match_key(text: Column) -> Column:
    """For comparing headings: no marks, single blanks, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(text, "[*_`#]", ""), r"\s+", " ")))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(text_col, "\n")).alias("line", "text"))


def headings(docs: DataFrame, levels: list[int] | None = None, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, line, level, title) of headings outside code fences; line counts from 0."""
    fence = F.ltrim("text").startswith("```")
    before = Window.partitionBy("id").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = _lines(docs, id_col, text_col).withColumn("fences", F.sum(fence.cast("int")).over(before))
    level = F.length(F.regexp_extract("text", HEADING, 1))
    rows = rows.where(~fence & (F.col("fences") % 2 == 0) & (level > 0))
    out = rows.select("id", "line", level.alias("level"), plain_heading(F.regexp_extract("text", HEADING, 2)).alias("title"))
    return out.where(F.col("level").isin(levels)) if levels else out


def heading_map(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, line, text) of every line that begins like a heading; line counts from 1."""
    rows = _lines(docs, id_col, text_col)
    return rows.where(F.col("text").rlike("^#{1,6} ")).select("id", (F.col("line") + 1).alias("line"), "text")


def contents_headings(docs: DataFrame, levels: tuple[int, ...] = (2, 3), id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, line, level, title, part): the headings that a table of contents lists, and the one right above its marks (part 1),
    whose level is one of these or 2. Texts without both marks, or without a heading above them, give none.
    Headings between the marks don't count, and fences before the marks don't reach behind them."""
    text = F.col(text_col)
    start, end = F.instr(text, TOC_START), F.instr(text, TOC_END)
    tail = F.substring(text, end + len(TOC_END), F.length(text))
    parts = docs.where((start > 0) & (end > start)).select(F.col(id_col).alias("id"), F.substring(text, F.lit(1), start - 1).alias("head"), tail.alias("tail"), (F.size(F.split(F.substring(text, F.lit(1), end - 1), "\n")) - 1).alias("offset"))
    above = headings(parts, sorted({*levels, 2}), "id", "head")
    last = above.groupBy("id").agg(F.max("line").alias("last"))
    above = above.join(last, "id").withColumn("part", F.when(F.col("line") == F.col("last"), OWN).otherwise(BEFORE)).where((F.col("part") == OWN) | F.col("level").isin(list(levels)))
    below = headings(parts, list(levels), "id", "tail").join(last.select("id"), "id", "left_semi").join(parts.select("id", "offset"), "id").withColumn("line", F.col("line") + F.col("offset")).withColumn("part", F.lit(BEHIND))
    return above.select("id", "line", "level", "title", "part").unionByName(below.select("id", "line", "level", "title", "part"))


def heading_pages(listed: DataFrame, pages: DataFrame, key_chars: int = KEY_CHARS) -> DataFrame:
    """listed with page: the first page, not before the last heading's, that holds the key of a title.

    A heading that no page holds has no page and leaves the place. With a column ``part`` (see ``contents_headings``), what is
    behind the contents is looked for from the page after the contents' own title on, since the contents hold all titles.
    listed: as ``headings``; pages: id, page, body.
    """
    part = F.col("part") if "part" in listed.columns else F.lit(BEHIND).alias("part")
    order = lambda c: F.array_sort(F.collect_list(c))
    own = listed.groupBy("id").agg(order(F.struct("line", "level", "title", part)).alias("heads"))
    bodies = pages.groupBy("id").agg(order(F.struct("page", search_key(F.col("body")).alias("body"))).alias("pages"))
    none = F.expr("cast(null as int)")
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("found"))

    def step(state: Column, head: Column) -> Column:
        key = F.substring(search_key(head["title"]), 1, key_chars)
        rest = F.filter(F.sequence(F.lit(0), F.size("pages") - 1), lambda k: (k >= state["at"]) & F.contains(F.get("pages", k)["body"], key))
        hit = F.when(F.size("pages") > 0, F.get(rest, F.lit(0))).otherwise(none)
        at = F.coalesce(hit, state["at"]) + F.when(head["part"] == OWN, 1).otherwise(0)
        return F.struct(at.alias("at"), F.concat(state["found"], F.array(hit)).alias("found"))

    both = own.join(bodies, "id", "left").withColumn("pages", F.coalesce("pages", F.expr("cast(array() as array<struct<page:int,body:string>>)")))
    found = both.withColumn("found", F.aggregate("heads", start, step)["found"])
    rows = found.select("id", "pages", F.explode(F.arrays_zip("heads", "found")).alias("x"))
    kept = [F.col("x.heads")[c].alias(c) for c in ("line", "level", "title", *(["part"] if "part" in listed.columns else []))]
    return rows.select("id", *kept, F.get("pages", F.col("x.found"))["page"].alias("page"))


#: The form of a table of contents.
TOC_TABLE = ('<table style="width:100%;border-collapse:collapse">', "</table>")
TOC_TITLE, TOC_PAGE = '<tr><td style="padding:1px 0 1px {}em">', '</td><td style="text-align:right;vertical-align:bottom;padding-left:1em">'


def toc_block(paged: DataFrame, levels: tuple[int, ...] = (2, 3)) -> DataFrame:
    """(id, toc): a table of titles, moved in by level, and pages, counted from 1; entries without a page have an empty cell. The
    contents' own title is not listed."""
    rows = paged.where(F.col("part") != OWN) if "part" in paged.columns else paged
    escaped = F.col("title")
    for c, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        escaped = F.replace(escaped, F.lit(c), F.lit(entity))
    indent = ((F.col("level") - min(levels)) * 1.5).cast("double").cast("string")
    before, after = TOC_TITLE.split("{}")
    row = F.concat(F.lit(before), indent, F.lit(after), escaped, F.lit(TOC_PAGE), F.coalesce((F.col("page") + 1).cast("string"), F.lit("")), F.lit("</td></tr>"))
    rows = rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("line", row.alias("row")))).alias("rows"))
    return rows.select("id", F.concat_ws("\n", F.lit(TOC_TABLE[0]), F.array_join(F.transform("rows", lambda r: r["row"]), "\n"), F.lit(TOC_TABLE[1])).alias("toc"))


def with_toc(docs: DataFrame, tocs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """docs with the text between the marks of a table of contents replaced; texts without both marks are unchanged."""
    start, end = F.instr(text_col, TOC_START), F.instr(text_col, TOC_END)
    out = docs.join(tocs.withColumnRenamed("id", id_col), id_col, "left")
    head = F.substring(F.col(text_col), F.lit(1), start + len(TOC_START) - 1)
    tail = F.substring(F.col(text_col), end, F.length(text_col))
    made = F.concat(head, F.lit("\n"), F.col("toc"), F.lit("\n"), tail)
    return out.withColumn(text_col, F.when((start > 0) & (end > start) & F.col("toc").isNotNull(), made).otherwise(F.col(text_col))).drop("toc")


def reference_levels(refs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, key, level) of a reference text: the least level of each heading, 0 for prose lines that are no heading."""
    rows = _lines(refs, id_col, text_col)
    title = F.regexp_extract("text", r"^#{1,6}\s+(.*?)\s*$", 1)
    is_heading = F.col("text").rlike(r"^#{1,6}\s+")
    key = F.when(is_heading, match_key(title)).otherwise(match_key(F.regexp_replace(F.trim("text"), r"^[*_ ]+|[*_ ]+$", "")))
    level = F.when(is_heading, F.length(F.regexp_extract("text", "^(#{1,6})", 1)))
    rows = rows.select("id", key.alias("key"), level.alias("level")).where("key <> ''")
    return rows.groupBy("id", "key").agg(F.coalesce(F.min("level"), F.lit(0)).alias("level"))


def relevelled(docs: DataFrame, refs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, line, text, change): lines whose headings take the level of the reference, or lose their marks where it has
    them as prose; change is relevel, demote or empty. Headings that it doesn't know stay."""
    rows = _lines(docs, id_col, text_col)
    own, title = F.length(F.regexp_extract("text", r"^(#{1,6})\s+", 1)), F.regexp_extract("text", r"^#{1,6}\s+(.*?)\s*$", 1)
    rows = rows.withColumns({"own": own, "title": title}).withColumn("key", F.when(F.col("own") > 0, match_key(F.col("title"))))
    out = rows.join(reference_levels(refs, id_col, text_col), ["id", "key"], "left")
    change = F.when((F.col("level") > 0) & (F.col("level") != F.col("own")), "relevel").when(F.col("level") == 0, "demote").otherwise("")
    text = F.when(change == "relevel", F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), "title")).when(change == "demote", F.col("title")).otherwise(F.col("text"))
    return out.select("id", "line", text.alias("text"), change.alias("change"))
