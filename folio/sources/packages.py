"""Office packages and archives: their entries, nested archives included, and the text of word and slide packages.

Archives come from Spark's own reader of binary files; each task opens the ones it gets and hands on an entry a row. What
can't be read is a row with an error, and so is an entry whose bytes disagree with what the archive declares. The text is taken from
the parts by DataFrame functions.

Defined results: folders are no entries. Archives are nested ``MOST_DEPTH`` deep at most, deeper ones stay entries. Encrypted
entries and those of unknown compression are errors. A null content is an archive that can't be read.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_DEPTH = 4
ENTRIES = "archive string, entry string, size long, content binary, error string"
#: Bytes of entries in one batch, about.
BATCH = 16 << 20


def _walk(archive: str, content: bytes | None, depth: int) -> Iterator[tuple]:
    try:
        package = zipfile.ZipFile(io.BytesIO(content or b""))
    except (zipfile.BadZipFile, ValueError) as error:
        yield archive, None, None, None, str(error)[:200]
        return
    with package:
        for info in package.infolist():
            if info.is_dir():
                continue
            try:
                body = package.read(info)  # checks the size and the checksum that are declared
            except Exception as error:  # noqa: BLE001 - the entry's error
                yield archive, info.filename, info.file_size, None, f"{type(error).__name__}: {error}"[:200]
                continue
            yield archive, info.filename, info.file_size, body, None
            if info.filename.lower().endswith((".zip", ".docx", ".pptx", ".xlsx")) and body[:2] == b"PK" and depth < MOST_DEPTH:
                yield from _walk(f"{archive}!{info.filename}", body, depth + 1)


def entries(archives: DataFrame, name: str = "path", content: str = "content") -> DataFrame:
    """(archive, entry, size, content, error); an entry of a nested archive belongs to ``outer!inner``."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = [c.split()[0] for c in ENTRIES.split(", ")], [pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()]
        out = lambda rows: pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        for batch in batches:
            held, size = [], 0
            for archive, body in zip(batch.column("a"), batch.column("b"), strict=True):
                for row in _walk(archive.as_py(), body.as_py(), 1):
                    held.append(row)
                    size += len(row[3] or b"")
                    if size > BATCH:
                        yield out(held)
                        held, size = [], 0
            if held:
                yield out(held)

    return archives.select(F.col(name).alias("a"), F.col(content).alias("b")).mapInArrow(opened, ENTRIES)


def archive_files(spark: SparkSession, root: str, pattern: str = "*.{zip,docx,pptx}") -> DataFrame:
    """(path, content) of the archives below root."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "content")


def _text(xml: Column, tag: str) -> Column:
    """The texts of the elements, put together, with entities as their characters."""
    joined = F.array_join(F.regexp_extract_all(xml, F.lit(rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), F.lit(1)), "")
    for entity, c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        joined = F.replace(joined, F.lit(entity), F.lit(c))
    return joined


#: How parts of packages are named and marked up.
WORD_PART, PARAGRAPH = "word/document.xml", r"(?s)<w:p[ >].*?</w:p>"
SLIDE, NOTES = r"^ppt/slides/(slide\d+)\.xml$", r"^ppt/notesSlides/(notesSlide\d+)\.xml$"
BLOCK = r"(?s)<p:sp[ >].*?</p:sp>|<a:tbl>.*?</a:tbl>"


def paragraphs(parts: DataFrame) -> DataFrame:
    """(archive, n, text, picture) of the paragraphs of word packages, empty ones included; n from 0. parts: as ``entries``."""
    xml = parts.where(F.col("entry") == WORD_PART).select("archive", F.col("content").cast("string").alias("xml"))
    rows = xml.select("archive", F.posexplode(F.regexp_extract_all("xml", F.lit(PARAGRAPH), F.lit(0))).alias("n", "p"))
    return rows.select("archive", "n", F.trim(_text(F.col("p"), "w:t")).alias("text"), F.contains("p", F.lit("<w:drawing")).alias("picture"))


def _relations(parts: DataFrame) -> DataFrame:
    """(archive, of, id, target): what each part's relations name; targets as file names."""
    found = parts.where(F.col("entry").rlike(r"/_rels/[^/]+\.rels$")).select("archive", F.regexp_extract("entry", r"/_rels/([^/]+)\.rels$", 1).alias("of"), F.explode(F.regexp_extract_all(F.col("content").cast("string"), F.lit(r"(?s)<Relationship\s[^>]*>"), F.lit(0))).alias("r"))
    return found.select("archive", "of", F.regexp_extract("r", r'\bId="([^"]*)"', 1).alias("id"), F.element_at(F.split(F.regexp_extract("r", r'\bTarget="([^"]*)"', 1), "/"), -1).alias("target"))


def _blocks(xml: Column) -> Column:
    """The texts and tables of a slide in order."""
    cell = lambda c: F.replace(F.trim(F.regexp_replace(F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"(?s)<a:p(?:\s[^>]*)?>.*?</a:p>"), F.lit(0)), lambda p: _text(p, "a:t")), " "), r"\s+", " ")), F.lit("|"), F.lit("\\|"))
    row = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(F.regexp_extract_all(r, F.lit(r"(?s)<a:tc[ >].*?</a:tc>"), F.lit(0)), cell), " | "), F.lit(" |"))

    def table(t: Column) -> Column:
        lines = F.regexp_extract_all(t, F.lit(r"(?s)<a:tr[ >].*?</a:tr>"), F.lit(0))
        width = F.size(F.regexp_extract_all(F.coalesce(F.get(lines, F.lit(0)), F.lit("")), F.lit(r"<a:tc[ >]"), F.lit(0)))
        made = F.transform(lines, row)
        return F.array_join(F.concat(F.slice(made, 1, 1), F.array(F.concat(F.lit("|"), F.repeat(F.lit("---|"), width))), F.slice(made, F.lit(2), F.greatest(F.size(made), F.lit(1)))), "\n")

    def frame(sp: Column) -> Column:
        lines = F.transform(F.regexp_extract_all(sp, F.lit(r"(?s)<a:p(?:\s[^>]*)?>.*?</a:p>"), F.lit(0)), lambda p: _text(F.regexp_replace(p, r"<a:br\s*/>", "<a:t>\n</a:t>"), "a:t"))
        return F.regexp_replace(F.array_join(lines, "\n"), r"^\s+|\s+$", "")

    found = F.transform(F.regexp_extract_all(xml, F.lit(BLOCK), F.lit(0)), lambda b: F.when(b.startswith("<a:tbl>"), table(b)).otherwise(frame(b)))
    return F.filter(found, lambda t: t != "")


def slides(parts: DataFrame) -> DataFrame:
    """(archive, page, text) of slide packages in the order that the presentation names them, from 1; tables as rows of cells,
    speaker notes at the end. Slides that the presentation doesn't name are none."""
    text = parts.withColumn("xml", F.col("content").cast("string"))
    named = text.where("entry = 'ppt/presentation.xml'").select("archive", F.posexplode(F.regexp_extract_all("xml", F.lit(r'<p:sldId\s[^>]*?r:id="([^"]*)"'), F.lit(1))).alias("k", "id"))
    relations = _relations(parts)
    order = named.join(relations.where("of = 'presentation.xml'"), ["archive", "id"]).select("archive", (F.col("k") + 1).alias("page"), F.col("target").alias("file"))
    own = text.where(F.col("entry").rlike(SLIDE)).select("archive", F.concat(F.regexp_extract("entry", SLIDE, 1), F.lit(".xml")).alias("file"), F.array_join(_blocks(F.col("xml")), "\n\n").alias("body"))
    notes = text.where(F.col("entry").rlike(NOTES)).select("archive", F.concat(F.regexp_extract("entry", NOTES, 1), F.lit(".xml")).alias("target"), F.array_join(_blocks(F.regexp_extract("xml", r'(?s)(<p:sp[ >](?:(?!</p:sp>).)*type="body".*?</p:sp>)', 1)), "\n\n").alias("notes"))
    noted = relations.where(F.col("target").rlike("^notesSlide")).select("archive", F.col("of").alias("file"), "target").join(notes, ["archive", "target"]).where("notes <> ''").select("archive", "file", "notes")
    rows = order.join(own, ["archive", "file"]).join(noted, ["archive", "file"], "left")
    return rows.select("archive", "page", F.concat("body", F.when(F.col("notes").isNotNull(), F.concat(F.lit("\n\nSpeaker notes:\n\n"), "notes")).otherwise("")).alias("text"))


#: The line of a draft that names an adviser, which is no paragraph of the body.
ADVISER = r"^\*(Научный руководитель|Scientific advis[eo]r):"


def markdown_paragraphs(drafts: DataFrame, name: str = "archive", text: str = "text") -> DataFrame:
    """(archive, text): what a draft's lines become as paragraphs of a package: without marks, cells one by one, pictures as IMG."""
    line = F.trim(F.col("line"))
    rows = drafts.select(F.col(name).alias("archive"), F.explode(F.split(text, "\n")).alias("line")).select("archive", line.alias("s"))
    rows = rows.where((F.col("s") != "") & ~F.col("s").rlike(ADVISER) & ~F.col("s").rlike(r"^\|[\s:|-]+\|$"))
    cells = F.when(F.col("s").startswith("|"), F.split(F.regexp_replace(F.regexp_replace("s", r"^\|", ""), r"\|$", ""), r"(?<!\\)\|")).otherwise(F.array("s"))

    def clean(c: Column) -> Column:
        c = F.replace(F.replace(F.regexp_replace(F.trim(c), r"^#{1,6}\s*", ""), F.lit("**"), F.lit("")), F.lit("=="), F.lit(""))
        return F.regexp_replace(F.regexp_replace(c, r"^\*(.+)\*$", "$1"), "^- ", "– ")

    rows = rows.select("archive", F.explode(F.transform(cells, clean)).alias("c"))
    return rows.select("archive", F.when(F.col("c").startswith("!["), "IMG").otherwise(F.trim(F.regexp_replace("c", r"\s+", " "))).alias("text"))


def export_differences(made: DataFrame, drafts: DataFrame) -> DataFrame:
    """(archive, side, text, n): paragraphs that a package has and its draft lacks, or the other way round, and how many more."""
    text = F.when(F.col("picture"), "IMG").otherwise(F.trim(F.regexp_replace("text", r"\s+", " ")))
    a = made.select("archive", text.alias("text"), F.lit(1).alias("d"))
    b = markdown_paragraphs(drafts).select("archive", "text", F.lit(-1).alias("d"))
    rows = a.unionByName(b).groupBy("archive", "text").agg(F.sum("d").alias("d")).where("d <> 0")
    return rows.select("archive", F.when(F.col("d") > 0, "package").otherwise("draft").alias("side"), "text", F.abs("d").alias("n"))
