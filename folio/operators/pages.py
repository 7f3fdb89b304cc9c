"""Paginated texts: page marks, paragraphs, chunks and what is known about completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import text as tx

#: A line of its own: the page number in braces and 48 dashes.
MARK = r"(?m)^\{(\d+)\}-{48}$"
MAX_CHUNK, MIN_CHUNK = 900, 60


def page_mark(number: Column) -> Column:
    return F.concat(F.lit("{"), number.cast("string"), F.lit("}" + "-" * 48))


def paginate(bodies: Column, first: int = 0) -> Column:
    """One text from an array of page bodies."""
    return F.array_join(F.transform(bodies, lambda b, i: F.concat(page_mark(i + first), F.lit("\n"), b)), "\n")


def _cut(docs: DataFrame, text_col: str, keep_unmarked: bool) -> tuple[DataFrame, Column]:
    """The texts with what their marks say, as columns of their own so that each is taken from the text once; their pages from these."""
    text = F.col(text_col)
    numbers = F.transform(F.regexp_extract_all(text, F.lit(MARK), F.lit(1)), lambda n: n.cast("int"))
    rows = docs.withColumns({"_n": numbers, "_b": F.split(text, MARK.replace("(\\d+)", "\\d+"))})
    marked = F.arrays_zip(F.col("_n").alias("page"), F.slice("_b", F.lit(2), F.greatest(F.size("_b"), F.lit(1))).alias("body"))
    whole = F.array(F.struct(F.lit(0).alias("page"), text.alias("body")))
    kind = "array<struct<page:int,body:string>>"
    pages = F.when(F.size("_n") > 0, marked.cast(kind))
    return rows, pages.otherwise(whole.cast(kind)) if keep_unmarked else pages


def page_arrays(docs: DataFrame, text_col: str = "text", keep_unmarked: bool = True) -> DataFrame:
    """The pages of ``split_pages`` as an array of (page, body) instead of the text: they stay with their document."""
    rows, pages = _cut(docs, text_col, keep_unmarked)
    return rows.select(*[c for c in docs.columns if c != text_col], pages.alias("pages"))


def split_pages(docs: DataFrame, text_col: str = "text", keep_unmarked: bool = True) -> DataFrame:
    """A row per page with page and body instead of the text.

    Text before the first mark is dropped; a text without marks is page 0 (or nothing, if not kept).
    """
    rows, pages = _cut(docs, text_col, keep_unmarked)
    rest = [c for c in docs.columns if c != text_col]
    return rows.select(*rest, F.explode(pages).alias("_p")).select(*rest, "_p.page", "_p.body")


def chunks_of(body: Column, most: int = MAX_CHUNK, least: int = MIN_CHUNK) -> Column:
    """The chunks of a page: paragraphs merged up to ``most`` characters.

    A paragraph shorter than ``least`` is held and put before the next one; what is still held at the end
    closes the last chunk.
    """
    paras = F.split(F.regexp_replace(body, tx.HARAKAT, ""), r"\n\s*\n")
    paras = F.transform(paras, lambda p: F.regexp_replace(F.regexp_replace(F.regexp_replace(p, r"^\s+|\s+$", ""), "[ \t]+", " "), r"^\s+|\s+$", ""))
    paras = F.filter(paras, lambda p: p != "")
    nothing = F.lit("")
    zero = F.struct(F.expr("cast(array() as array<string>)").alias("done"), nothing.alias("cur"), nothing.alias("held"))

    def joined(a: Column, b: Column) -> Column:
        return F.when(a != "", F.concat(a, F.lit("\n\n"), b)).otherwise(b)

    def step(s: Column, p: Column) -> Column:
        short = F.length(p) < least
        whole = joined(s.held, p)
        full = (s.cur != "") & (F.length(s.cur) + F.length(whole) + 2 > most)
        held = F.struct(s.done.alias("done"), s.cur.alias("cur"), whole.alias("held"))
        cut = F.struct(F.concat(s.done, F.array(s.cur)).alias("done"), whole.alias("cur"), nothing.alias("held"))
        grown = F.struct(s.done.alias("done"), joined(s.cur, whole).alias("cur"), nothing.alias("held"))
        return F.when(short, held).when(full, cut).otherwise(grown)

    def finish(s: Column) -> Column:
        last = F.when(s.held != "", joined(s.cur, s.held)).otherwise(s.cur)
        return F.when(last != "", F.concat(s.done, F.array(last))).otherwise(s.done)

    return F.aggregate(paras, zero, step, finish)


def chunk_pages(pages: DataFrame, body_col: str = "body") -> DataFrame:
    """A row per chunk: seq (from 0 in its page), chars and text instead of the body."""
    rest = [c for c in pages.columns if c != body_col]
    return pages.select(*rest, F.posexplode(chunks_of(F.col(body_col))).alias("seq", "text")).withColumn("chars", F.length("text"))


def assess(pages: DataFrame, id_col: str, thin: int = 20) -> DataFrame:
    """(id, pages, chars, empty_pages, complete, flags): what the pages tell of an extraction.

    A page whose body is blank is empty. Complete: there is text and no page is empty.
    """
    body = F.regexp_replace("body", r"^\s+|\s+$", "")
    own = pages.select(F.col(id_col), "page", F.length(body).alias("n"))
    out = own.groupBy(id_col).agg(F.count("*").alias("pages"), F.sum("n").alias("chars"), F.sum((F.col("n") == 0).cast("long")).alias("empty_pages"), F.max_by("n", "page").alias("last_chars"))
    flags = F.array_compact(F.array(F.when(F.col("empty_pages") > 0, F.lit("empty pages")), F.when(F.col("last_chars") < thin, F.lit("thin last page"))))
    return out.select(id_col, "pages", "chars", "empty_pages", ((F.col("chars") > 0) & (F.col("empty_pages") == 0)).alias("complete"), F.array_join(flags, "; ").alias("flags"))


def document_rows(docs: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(path, key, title, sha256, chars): key from the file's name, title from the first line that is not blank."""
    lines = F.filter(F.transform(F.split(text_col, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    name = F.element_at(F.split(path_col, "/"), -1)
    head = F.split(name, "_")[0]
    key = F.when(head.rlike("^[A-Z0-9]{8}$"), head)
    title = F.substring(F.regexp_replace(F.coalesce(F.get(lines, F.lit(0)), F.lit("")), r"^#+\s*", ""), 1, 300)
    return docs.select(F.col(path_col).alias("path"), key.alias("key"), title.alias("title"), F.sha2(F.col(text_col).cast("binary"), 256).alias("sha256"), F.length(text_col).cast("long").alias("chars"))


#: Lines that carry on as the heading of what follows.
CARRIED = r"^#{1,6}\s+(.*\S)|^\*\*(.+?)\*\*\s*$"


def running_state(lines: DataFrame, id_col: str = "id") -> DataFrame:
    """lines (id, line, text) with the page and the heading that each stands under, its own included; null before the first."""
    w = Window.partitionBy(id_col).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    page = F.when(F.col("text").rlike(MARK), F.regexp_extract("text", MARK, 1).cast("int"))
    title = F.coalesce(F.nullif(F.regexp_extract("text", CARRIED, 1), F.lit("")), F.nullif(F.regexp_extract("text", CARRIED, 2), F.lit("")))
    clean = F.substring(F.trim(F.regexp_replace(F.regexp_replace(title, r"\*\*|__", ""), r"\s+", " ")), 1, 200)
    return lines.withColumns({"page": F.last(page, ignorenulls=True).over(w), "heading": F.last(clean, ignorenulls=True).over(w)})


def page_labels(tokens: DataFrame, labels: DataFrame, id_col: str = "id") -> DataFrame:
    """tokens (id, pos, ...) with the label of the last page that begins at or before them; labels: id, pos, label."""
    both = tokens.withColumn("_l", F.lit(None).cast("string")).unionByName(labels.select(id_col, "pos", F.col("label").alias("_l")), allowMissingColumns=True).withColumn("_k", F.col("_l").isNull())
    w = Window.partitionBy(id_col).orderBy("pos", "_k").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("label", F.last("_l", ignorenulls=True).over(w)).where("_k").drop("_l", "_k")
