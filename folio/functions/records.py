"""Predicates and parts of bibliographic records, files and markdown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as tx

#: What browsers and sites show instead of a page.
ERROR_PHRASES = (
    "site can.t be reached", "ERR_TIMED_OUT", "ERR_CONNECTION", "ERR_NAME_NOT_RESOLVED", "took too long to respond", "checking your browser", "just a moment", "Доступ ограничен",
)
ERROR_PAGE = "(?iu)" + "|".join(ERROR_PHRASES)
#: Kinds of secrets and their patterns.
SECRETS = {
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "access_key": r"\bAKIA[0-9A-Z]{16}\b",
    "assignment": r"(?i)\b(password|token|secret|api_key)\s*=\s*\S+",
    "url_login": r"://[^/\s:@]+:[^/\s:@]+@",
}


def failed_render(text: Column, least: int = 250) -> Column:
    return (F.length(text) < least) | text.rlike(ERROR_PAGE)


def valid_pdf(content: Column, least: int = 5000) -> Column:
    return (F.length(content) > least) & (F.substring(content, 1, 5) == F.lit(b"%PDF-"))


def png_size(content: Column) -> tuple[Column, Column]:
    """(width, height) from the header bytes."""
    at = lambda k: F.conv(F.hex(F.substring(content, k, 4)), 16, 10).cast("long")
    return at(17), at(21)


def secret_kinds(text: Column) -> Column:
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(k)) for k, p in SECRETS.items()]))


def route(first_pages: Column, suffix: Column, done: Column) -> Column:
    """How a file gets its text: DONE, TEXT for a text layer of more than 300 characters, OCR, or OFFICE."""
    layer = F.length(F.regexp_replace(first_pages, r"\s+", "")) > 300
    return F.when(done, "DONE").when(suffix != "pdf", "OFFICE").when(layer, "TEXT").otherwise("OCR")


def excerpt_facts(text: Column, most: int) -> tuple[Column, Column, Column]:
    """(text, truncated, complete) of an extraction cut at a number of characters."""
    long = F.length(text) > most
    return F.substring(text, 1, most), long, ~long & (F.trim(text) != "")


def partial_date(parts: Column) -> Column:
    """Date parts joined by dashes, without padding; a null part ends it."""
    known = F.filter(parts, lambda p, k: F.forall(F.slice(parts, F.lit(1), k + 1), lambda q: q.isNotNull()))
    return F.array_join(F.transform(known, lambda p: p.cast("string")), "-")


def year_of(text: Column) -> Column:
    return F.when(F.substring(text, 1, 4).rlike("^[0-9]{4}$"), F.substring(text, 1, 4).cast("int"))


def venue_field(kind: Column) -> Column:
    return F.when(kind == "journalArticle", "publicationTitle").when(kind == "conferencePaper", "proceedingsTitle").when(kind == "bookSection", "bookTitle").otherwise("publisher")


def creator(name: Column) -> tuple[Column, Column]:
    """(first, last): the last word is the family name."""
    parts = F.split(F.trim(name), r"\s+")
    return F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), " "), F.element_at(parts, -1)


def without_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", "")


def cell(text: Column) -> Column:
    return F.trim(F.replace(F.regexp_replace(text, r"\s+", " "), F.lit("|"), F.lit("\\|")))


def table_cells(line: Column) -> Column:
    """The trimmed cells of a pipe row."""
    return F.transform(F.split(F.regexp_extract(line, r"^\s*\|(.*)\|\s*$", 1), r"\|"), lambda c: F.trim(c))


def heading(line: Column) -> tuple[Column, Column]:
    """(level, text) of a markdown heading; 0 and '' for other lines."""
    return F.length(F.regexp_extract(line, r"^(#{1,6})\s+\S", 1)), F.trim(F.regexp_extract(line, r"^#{1,6}\s+(.*)$", 1))


def figure_or_text(line: Column) -> Column:
    """A figure without a file becomes its description in italics."""
    return F.regexp_replace(line, r"^!\[([^\]]+)\]\(\)\s*$", "*$1*")


def location(page: Column, line: Column) -> Column:
    return F.when(page.isNotNull(), F.concat(F.lit("p.{"), page.cast("string"), F.lit("}"))).otherwise(F.concat(F.lit("line "), line.cast("string")))


def filled(template: Column, values: dict[str, Column]) -> Column:
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value.cast("string"))
    return template


def compact(text: Column) -> Column:
    """Without white space, soft hyphens, direction marks and vowel marks."""
    return F.regexp_replace(text, "[\\s­‎‏ـً-ٰٟ]+", "")


#: Cyrillic letters, an Armenian one, and the Latin letters that look like them.
LOOKALIKES = ("АВЕКМНОРСТУХаеорсухкмтвнЅіІјЈՈ", "ABEKMHOPCTYXaeopcyxkmtbhSiIjJn")


def latinised(text: Column) -> Column:
    return F.translate(text, *LOOKALIKES)


def has_latin(text: Column) -> Column:
    return text.rlike("[A-Za-z]")


def has_cyrillic(text: Column) -> Column:
    return text.rlike("[А-Яа-яЁё]")


#: What pages of a bot check say.
BOT_WALL = r"(?i)(making sure you.re not a bot|verify you are (?:a )?human|checking your browser|just a moment|enable javascript and cookies|ddos protection)"


def bot_wall(text: Column, most: int = 4000) -> Column:
    """Whether a short text is the page of a bot check that was taken for a document."""
    return text.rlike(BOT_WALL) & (F.length(text) < most)


def endpoint_down(error: Column) -> Column:
    """Whether an error says that the service can't be reached, not that it refused the request. error: kind, reason."""
    unreachable = "^(ConnectionError|ConnectionRefusedError|ConnectionResetError|ConnectionAbortedError|BrokenPipeError|RemoteDisconnected)$"
    return F.coalesce((error["kind"] != "HTTPError") & F.when(error["kind"] == "URLError", error["reason"]).otherwise(error["kind"]).rlike(unreachable), F.lit(False))


def flat_facts(text: Column, most: int | None = None) -> Column:
    """(text, pages, chars, full_chars, truncated, complete, flags) of a text without pages: pages is null."""
    text = tx.clean_spaces(F.coalesce(text, F.lit("")))
    size = F.length(text)
    long = F.lit(False) if most is None else size > most
    kept = text if most is None else F.substring(text, 1, most)
    flags = F.when(long, F.array(F.lit(f"excerpt: first {most} chars"))).when(size == 0, F.array(F.lit("empty"))).otherwise(F.expr("cast(array() as array<string>)"))
    return F.struct(kept.alias("text"), F.expr("cast(null as int)").alias("pages"), size.alias("chars"), size.alias("full_chars"), long.alias("truncated"), (~long & (size > 0)).alias("complete"), flags.alias("flags"))


def family_names(authors: Column) -> Column:
    """Folded family names of a list of (given, family), blank ones left out."""
    names = F.transform(authors, lambda a: F.trim(F.coalesce(a["family"], F.lit(""))))
    return F.transform(F.filter(names, lambda n: n != ""), tx.fold)


def pointers(extra: Column, root: str) -> Column:
    """What follows ``root/`` to the end of each line, trimmed."""
    found = F.regexp_extract_all(F.coalesce(extra, F.lit("")), F.lit(r"\Q" + root + r"\E/([^\n]+)"), F.lit(1))
    return F.transform(found, lambda x: F.trim(x))


def without_furniture(text: Column) -> Column:
    """Without page marks and web links, whose labels stay; at most one empty line."""
    text = F.regexp_replace(F.regexp_replace(text, r"(?m)^\{\d+\}-+$", ""), r"\[([^\]]*)\]\(https?://[^)]*\)", "$1")
    return F.btrim(F.regexp_replace(text, r"\n{3,}", "\n\n"), F.lit(" \t\n\x0b\f\r"))


def citation_context(text: Column, start: Column, end: Column, before: int = 600, after: int = 64) -> Column:
    """The text around a place [start, end) counted from 0."""
    first = F.greatest(start - before, F.lit(0))
    return F.substring(text, first + 1, end + after - first)


def compare_key(text: Column) -> Column:
    """A paragraph with its citation numbers blanked and single blanks, for comparing versions."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\[[\d–;,\- ]+\]", "[]"), r"\s+", " "))


def rounded(x: Column, digits: int) -> Column:
    """Rounding of the double's exact value, halves to even, as Python's round: 2.675 gives 2.67."""
    return F.replace(F.format_number(x, digits), F.lit(","), F.lit("")).cast("double")  # rounds the binary value; casts to decimal take the printed one


def shown(x: Column, digits: int) -> Column:
    """A number as text with so many digits, rounded as by ``rounded``."""
    return F.replace(F.format_number(x, digits), F.lit(","), F.lit(""))


def say(*parts: Column | str) -> Column:
    """A message of columns and plain words; null if a column is."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def signed_end(text: Column, phrase: str, last: int = 400) -> Column:
    """Whether a phrase that ends a complete act stands in its last characters; null is not."""
    return F.coalesce(F.substring(text, F.greatest(F.length(text) - last + 1, F.lit(1)), F.lit(last)).rlike(phrase), F.lit(False))


def inventory(text: Column, item: str) -> tuple[Column, Column, Column]:
    """How many items (articles, say) a text has, the first and the last; none: 0 and nulls."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(item), F.lit(0))
    return F.size(found).cast("long"), F.get(found, F.lit(0)), F.try_element_at(found, F.lit(-1))


def skipped_line(line: Column) -> Column:
    """Lines that are no prose: with emphasis, or headings."""
    return F.contains(line, F.lit("*")) | F.startswith(line, F.lit("#"))


def item_key(body: Column) -> Column:
    """The key that an answer names, by its form; empty if there is none."""
    return F.regexp_extract(F.coalesce(body, F.lit("")), r'"key":\s*"([A-Z0-9]{8})"', 1)


def collection_size(body: Column) -> Column:
    """What an answer counts itself, else the length of its list, else -1."""
    counted, listed = F.get_json_object(body, "$.metadata.count").cast("long"), F.json_array_length(F.get_json_object(body, "$.data")).cast("long")
    return F.coalesce(counted, listed, F.json_array_length(F.when(F.trim(body).startswith("["), body)).cast("long"), F.lit(-1).cast("long"))


def quarter_size(size: Column, digits: int = 6) -> Column:
    """Sizes of type that are a quarter and no half: nobody sets them on purpose."""
    whole = lambda k: F.round(size * k, digits) == F.floor(F.round(size * k, digits))
    return whole(4) & ~whole(2)


def first_source(sources: dict[str, Column]) -> Column:
    """The name of the first source that is there; null if none is."""
    return F.coalesce(*(F.when(there, F.lit(name)) for name, there in sources.items()))


def reasons(tests: dict[str, Column]) -> Column:
    """The names of the tests that hold, in their order; an unknown test doesn't."""
    return F.array_compact(F.array(*(F.when(holds, F.lit(name)) for name, holds in tests.items())))


def any_in_names(cited: Column, families: Column) -> Column:
    """Whether any cited surname is a part of any folded family name: compound names agree too."""
    return F.exists(cited, lambda s: F.exists(families, lambda f: F.contains(tx.fold(f), s)))
