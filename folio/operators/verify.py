"""Checks of quotations, citations and references against their sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import records as rc
from folio.functions import text as tx

#: Page anchors of quotations, and lines of a page number alone.
ANCHOR = r"[—–-]\s*(?:с|стр|p|pp)\.\s*(\d+(?:\s*[—–-]\s*\d+)?)\s*$"
#: Identifiers.
DOI = r"(?i)\b10\.[0-9]{4,9}/[^\s\"'<>{}()\[\]]+"
#: Characters that formatting varies and meaning doesn't.
QUOTES_AND_EMPHASIS = "«»“”„\"'*_`­"


def plain(text: Column) -> Column:
    """Without emphasis, quotation marks and soft hyphens; one kind of dash, ё as е, single blanks."""
    varied = "—–ёЁ" + QUOTES_AND_EMPHASIS
    # letter by letter only where there is something to translate
    text = F.when(reduce(or_, (F.contains(text, F.lit(c)) for c in varied)), F.translate(text, varied, "--еЕ")).otherwise(text)
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def quote_rows(drafts: DataFrame, id_col: str = "id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """(id, n, quote, pages): block quotes that end in a page anchor; a range gives every page between. Columns to keep follow."""
    groups = F.regexp_extract_all(F.concat(F.col(text_col), F.lit("\n")), F.lit(r"(?m)(?:^>.*\n)+"), F.lit(0))
    flat = F.transform(groups, lambda g: F.trim(F.regexp_replace(F.regexp_replace(g, r"(?m)^>\s?", ""), r"\s+", " ")))
    rows = drafts.select(F.col(id_col).alias("id"), *keep, F.posexplode(flat).alias("n", "flat")).where(F.col("flat").rlike(ANCHOR))
    numbers = F.transform(F.regexp_extract_all(F.regexp_extract("flat", ANCHOR, 1), F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("int"))
    rows = rows.select("id", *keep, "n", F.trim(F.regexp_replace("flat", ANCHOR, "")).alias("quote"), numbers.alias("k"))
    first, last = F.get("k", F.lit(0)), F.element_at("k", -1)
    pages = F.when(first <= last, F.sequence(first, last)).otherwise(F.expr("cast(array() as array<int>)"))
    return rows.select("id", "n", "quote", pages.alias("pages"), *keep)


BARE_NUMBER = r"(?m)^[ \t]*(\d{1,4})[ \t]*$"


def source_pages(pages: DataFrame, printed: bool = True, last: bool = True) -> DataFrame:
    """(id, page, body) keyed by the printed page number, the last or first line of digits alone; pages without one
    are left out. Else keyed by their mark. Number lines and heading marks are removed. Of pages with one key the last counts.
    """
    numbers = F.regexp_extract_all("body", F.lit(BARE_NUMBER), F.lit(1))
    key = (F.element_at(F.when(F.size(numbers) > 0, numbers), -1 if last else 1).cast("int")) if printed else F.col("page")
    body = F.regexp_replace(F.regexp_replace("body", BARE_NUMBER, ""), r"(?m)^#+\s*", "")
    rows = pages.select("id", key.alias("key"), F.col("page").alias("mark"), body.alias("body")).where("key is not null")
    return rows.groupBy("id", "key").agg(F.max_by("body", "mark").alias("body")).withColumnRenamed("key", "page")


def verify_quotes(drafts: DataFrame, pages: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """A row per draft: declared, quotes, failed, ambiguous, control, passed.

    Anchors without a quote make the draft fail, so do missing segments, and a negative control that passes: the
    first good quote of eight words or more, its middle word spoilt, must not be found. Ambiguous quotes stand on other
    pages too; that is no failure. control: ok, broken or not run.
    """
    anchors = F.size(F.regexp_extract_all(F.concat(F.col(text_col), F.lit("\n")), F.lit(r"(?m)^>.*" + ANCHOR), F.lit(0)))
    declared = drafts.select(F.col(id_col).alias("id"), anchors.cast("long").alias("declared"))
    quotes = quote_rows(drafts, id_col, text_col)
    checked = check_quotes(quotes, pages)
    good = quotes.join(checked.where("ok").select("id", "n"), ["id", "n"])
    control = good.withColumn("quote", corrupted(F.col("quote"))).where("quote is not null")
    first = control.groupBy("id").agg(F.min("n").alias("n"))
    control = check_quotes(control.join(first, ["id", "n"]), pages).select("id", F.when(F.col("ok"), "broken").otherwise("ok").alias("control"))
    doubtful = elsewhere(good, pages).groupBy("id").agg(F.count_distinct("n").alias("ambiguous"))
    sums = checked.groupBy("id").agg(F.count("*").alias("quotes"), F.sum((~F.col("ok")).cast("long")).alias("failed"))
    out = declared.join(sums, "id", "left").join(doubtful, "id", "left").join(control, "id", "left")
    zero = F.lit(0).cast("long")
    out = out.select("id", "declared", *[F.coalesce(c, zero).alias(c) for c in ("quotes", "failed", "ambiguous")], F.coalesce("control", F.lit("not run")).alias("control"))
    return out.withColumn("passed", (F.col("declared") == F.col("quotes")) & (F.col("quotes") > 0) & (F.col("failed") == 0) & (F.col("control") != "broken"))


def segments(quote: Column, least: int = 12) -> Column:
    """The parts between ellipses, trimmed of marks, longer than ``least``."""
    parts = F.split(plain(quote), r"\[…\]|\[\.\.\.\]|…|\.\.\.")
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(p, r"^[ .,;:\-]+|[ .,;:\-]+$", "")), lambda p: F.length(p) > least)


def check_quotes(quotes: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, n, ok, missing): every segment must stand in the joined text of the cited pages. pages: id, page, body."""
    cited = quotes.select("id", "n", "quote", F.posexplode("pages").alias("at", "page"))
    body = pages.select("id", "page", plain(F.col("body")).alias("body"))
    joined = cited.join(body, ["id", "page"], "left").groupBy("id", "n", "quote").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("body", F.lit("")).alias("body")))).alias("p"))
    hay = F.array_join(F.transform("p", lambda x: x.body), " ")
    missing = F.filter(segments(F.col("quote")), lambda s: ~F.contains(F.col("hay"), s))
    out = joined.withColumn("hay", hay).withColumn("missing", missing)
    return out.select("id", "n", (F.size("missing") == 0).alias("ok"), F.size("missing").alias("missing"))


def elsewhere(quotes: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, n, page): other pages of the same source that hold all segments too."""
    body = pages.select("id", "page", plain(F.col("body")).alias("body"))
    rows = quotes.select("id", "n", "pages", segments(F.col("quote")).alias("s")).where(F.size("s") > 0)
    hit = rows.join(body, "id").where(~F.array_contains("pages", F.col("page")))
    return hit.where(F.forall("s", lambda s: F.contains(F.col("body"), s))).select("id", "n", "page")


def plain_bodies(pages: Column) -> Column:
    """Arrays of (page, body) with plain bodies."""
    return F.transform(pages, lambda x: F.struct(x["page"].alias("page"), plain(x["body"]).alias("body")))


def elsewhere_in(quotes: DataFrame, source: str = "source") -> DataFrame:
    """(id, n, page) as of ``elsewhere``, for quotes that carry the pages of their source (``plain_bodies``): nothing is moved or joined."""
    rows = quotes.where(F.col("id").isNotNull()).select("id", "n", "pages", source, segments(F.col("quote")).alias("s"))
    other = F.filter(source, lambda x: ~F.array_contains("pages", x["page"]) & F.forall("s", lambda s: F.contains(x["body"], s)))
    hits = F.transform(F.when(F.size("s") > 0, other), lambda x: x["page"])
    return rows.select("id", "n", F.explode(hits).alias("page"))


def corrupted(quote: Column, least: int = 8) -> Column:
    """The quote with its middle word spoilt, for quotes of ``least`` words or more: such a quote must fail."""
    words = F.split(quote, " ")
    middle = F.floor(F.size(words) / 2).cast("int")
    return F.when(F.size(words) >= least, F.array_join(F.transform(words, lambda w, k: F.when(k == middle, F.concat(w, F.lit("xq"))).otherwise(w)), " "))


def anchor_guard(declared: DataFrame, quotes: DataFrame) -> DataFrame:
    """(id, declared, extracted): an error for any draft whose anchors and quotations differ in number, those without any quotation
    included. declared: id, declared."""
    found = quotes.groupBy("id").agg(F.count("*").alias("extracted"))
    both = declared.join(found, "id", "full_outer").select("id", F.coalesce("declared", F.lit(0).cast("long")).alias("declared"), F.coalesce("extracted", F.lit(0).cast("long")).alias("extracted"))
    told = F.when(F.col("declared") == F.col("extracted"), F.col("declared")).otherwise(F.raise_error(F.concat(F.lit("anchors without quotes in "), F.col("id").cast("string"))).cast("long"))
    return both.select("id", told.alias("declared"), "extracted")


def expand_citations(group: Column) -> Column:
    """'15–28; 21' as sorted distinct numbers; ranges count both ends in either order."""
    parts = F.transform(F.split(group, r"\s*;\s*"), lambda p: F.transform(F.regexp_extract_all(p, F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("int")))
    parts = F.filter(parts, lambda p: F.size(p) > 0)
    spread = lambda p: F.sequence(F.least(F.get(p, F.lit(0)), F.element_at(p, -1)), F.greatest(F.get(p, F.lit(0)), F.element_at(p, -1)))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, spread))))


def citation_problems(cited: DataFrame, listed: DataFrame) -> DataFrame:
    """(doc, problem, n) from cited (doc, n) and listed (doc, n; a repeated entry is repeated). A null number is left out."""
    c, entries = cited.groupBy("doc").agg(F.collect_set("n").alias("cited")), listed.groupBy("doc").agg(F.collect_list("n").alias("listed"))
    return problem_sets(c.join(entries, "doc", "full_outer")).select("doc", "problem", F.explode("ns").alias("n"))


def problem_sets(texts: DataFrame) -> DataFrame:
    """(doc, problem, ns) of texts (doc, cited, listed): the numbers that a text cites and those of its entries, as arrays; null is
    empty. The numbers stay with their text, so nothing is moved; ns are distinct, and not empty."""
    none = F.expr("cast(array() as array<int>)")
    rows = texts.select("doc", F.coalesce("cited", none).alias("cited"), F.array_sort(F.coalesce("listed", none)).alias("listed"))
    rows = rows.select("doc", "cited", "listed", F.array_distinct("listed").alias("entries"), F.array_max("listed").alias("top"))
    again = F.array_distinct(F.filter("listed", lambda n, i: (i > 0) & (n == F.get("listed", i - 1))))
    gaps = F.when(F.col("top") >= 1, F.array_except(F.sequence(F.lit(1), F.greatest("top", F.lit(1))), "entries")).otherwise(none)
    found = {"DUPLICATE": again, "DANGLING": F.array_except("cited", "entries"), "UNCITED": F.array_except("entries", "cited"), "GAP": gaps}
    return rows.select("doc", F.inline(F.array(*(F.struct(F.lit(p).alias("problem"), ns.alias("ns")) for p, ns in found.items())))).where("size(ns) > 0")


def dois(text: Column) -> Column:
    """DOI tokens without the marks glued to their ends."""
    return F.transform(F.regexp_extract_all(text, F.lit(DOI), F.lit(0)), lambda d: F.regexp_replace(d, r"[.,;:)\]>]+$", ""))


def title_and_venue(context: Column) -> tuple[Column, Column]:
    parts = F.split(context, " // ", 2)
    strip = lambda c: F.regexp_replace(c, r"^[ .,;]+|[ .,;]+$", "")
    return strip(parts[0]), strip(F.coalesce(F.get(parts, F.lit(1)), F.lit("")))


def surnames(context: Column, stop: list[str]) -> Column:
    """Folded capitalised names of two letters or more."""
    tokens = F.regexp_extract_all(context, F.lit(r"\p{Lu}[\p{L}\p{N}_'\-]+"), F.lit(0))
    folded = F.transform(tokens, tx.fold)
    return F.array_distinct(F.filter(folded, lambda f: (F.length(f) >= 2) & ~f.isin(stop)))


#: Words that are no surnames, and say nothing in titles and venues.
CITATION_STOP = (
    "the and of for with on in to a an by from as is at that this be or which but not edition vol volume no pages page doi url isbn issn pp p international journal "
    "review research science studies report based using approach analysis framework study trends bibliometric literature systematic preprint"
).split()


def content_words(text: Column, shortest: int = 3) -> Column:
    """The set of folded words of some length that say something."""
    return F.array_distinct(F.filter(tx.words(text), lambda w: (F.length(w) >= shortest) & ~w.isin(CITATION_STOP)))


def cited_dois(texts: DataFrame, per_line: bool = False, before: int = 600, after: int = 64, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, n, doi, context): each identifier of a text at its first occurrence, with the text around it or, for bibliographies of
    a line an entry, with its line without its identifiers. A null text has none."""
    rows = texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if per_line:
        rows = rows.select("id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    else:
        rows = rows.withColumn("line", F.lit(0))
    # columns of their own: in the generator they would be taken from the text again wherever they are named
    rows = rows.select("id", "line", "text", F.regexp_extract_all("text", F.lit(DOI), F.lit(0)).alias("found"), *([] if per_line else [F.split("text", DOI).alias("between")]))
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("starts"))
    place = F.aggregate(F.arrays_zip(F.col("between").alias("b"), F.col("found").alias("m")), zero, lambda s, x: F.struct((s["at"] + F.length(x["b"]) + F.coalesce(F.length(x["m"]), F.lit(0))).alias("at"), F.concat(s["starts"], F.array(s["at"] + F.length(x["b"]))).alias("starts")))
    starts = F.transform("found", lambda m: F.lit(0)) if per_line else F.slice(place["starts"], F.lit(1), F.size("found"))
    rows = rows.select("id", "line", "text", F.posexplode(F.arrays_zip(F.col("found").alias("m"), starts.alias("start"))).alias("k", "x"))
    raw, start = F.col("x.m"), F.col("x.start")
    around = F.regexp_replace("text", DOI, " ") if per_line else rc.citation_context(F.col("text"), start, start + F.length(raw), before, after)
    rows = rows.select("id", "line", "k", F.regexp_replace(raw, r"[.,;:)\]>]+$", "").alias("doi"), around.alias("context"))
    first = rows.groupBy("id", F.lower("doi").alias("key")).agg(F.min(F.struct("line", "k", "doi", "context")).alias("x"))
    return first.select("id", F.struct("x.line", "x.k").alias("n"), "x.doi", "x.context")


def verify_citations(cited: DataFrame, works: DataFrame, title_floor: float = 0.3, venue_floor: float = 0.4) -> DataFrame:
    """cited (of ``cited_dois``) with status, title_overlap and venue_overlap against the works that services know.

    ERROR: the service failed; NOTFOUND: it knows no such work; else OK or what differs of AUTHORS (no cited surname is a part of any
    family name), TITLE and VENUE (words in common below the floor). What either side lacks is not compared. works: doi, error,
    title, venue, families (an array); of several rows of a doi the first that is no error counts.
    """
    known = works.groupBy(F.lower("doi").alias("key")).agg(F.min(F.struct(F.col("error").isNotNull().alias("failed"), "error", "title", "venue", "families")).alias("w"))
    families = F.filter(F.transform(F.coalesce("w.families", F.expr("cast(array() as array<string>)")), lambda f: tx.fold(F.trim(f))), lambda f: f != "")
    title, venue = content_words(F.regexp_replace(F.coalesce("w.title", F.lit("")), "<[^>]+>", "")), content_words(F.coalesce("w.venue", F.lit("")))
    # once for a work, not for each of its citations
    known = known.select("key", F.struct(F.col("w.failed").alias("failed")).alias("w"), title.alias("wt"), venue.alias("wv"), F.array_join(families, " ").alias("blob"))
    rows = cited.withColumn("key", F.lower("doi")).join(known, "key", "left").drop("key")
    title, venue = title_and_venue(F.col("context"))
    none = F.expr("cast(array() as array<string>)")
    unknown = {"wt": F.coalesce("wt", none), "wv": F.coalesce("wv", none), "blob": F.coalesce("blob", F.lit(""))}
    rows = rows.withColumns(unknown | {"names": surnames(F.col("context"), CITATION_STOP), "t": content_words(title), "v": content_words(venue)})
    both = lambda a, b: (F.size(a) > 0) & (F.size(b) > 0)
    failed = F.coalesce(F.col("w.failed"), F.lit(False))
    overlap = lambda a, b: F.when(both(a, b) & ~failed, tx.jaccard(F.col(a), F.col(b)))
    agrees = F.exists("names", lambda s: F.contains(F.col("blob"), s))
    rows = rows.withColumns({"title_overlap": overlap("t", "wt"), "venue_overlap": overlap("v", "wv")})
    parts = {"AUTHORS": ((F.size("names") > 0) & (F.col("blob") != ""), agrees), "TITLE": (both("t", "wt"), F.coalesce(F.col("title_overlap") >= title_floor, F.lit(True))), "VENUE": (both("v", "wv"), F.coalesce(F.col("venue_overlap") >= venue_floor, F.lit(True)))}
    status = verdict(F.col("w").isNotNull(), failed, parts)
    return rows.select("id", "n", "doi", status.alias("status"), F.round("title_overlap", 2).alias("title_overlap"), F.round("venue_overlap", 2).alias("venue_overlap"))


def verdict(found: Column, error: Column, parts: dict[str, tuple[Column, Column]]) -> Column:
    """ERROR, NOTFOUND, OK, or the names of what differs joined by '/'; parts: name -> (comparable, agrees)."""
    wrong = F.concat_ws("/", *[F.when(can & ~ok, F.lit(name)) for name, (can, ok) in parts.items()])
    return F.when(error, "ERROR").when(~found, "NOTFOUND").when(wrong == "", "OK").otherwise(wrong)
