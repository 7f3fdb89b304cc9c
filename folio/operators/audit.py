"""Mirror audit: which files, pointers and folders of a corpus agree with a library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.records import say, shown
from folio.storage import all_of

from .numbering import numbered
from .pages import MARK

#: Names that never need an entry in the library.
SKIPPED = r"(?i)(^|/)(readme[^/]*|\.[^/]*|[^/]*\.(json|tsv|csv|log))$"


def index_key(path: Column) -> Column:
    """The key a file is indexed by: eight of A-Z, 0-9 before the first underscore of its name."""
    head = F.split(F.element_at(F.split(path, "/"), -1), "_")[0]
    return F.when(head.rlike("^[A-Z0-9]{8}$"), head)


def audit_key(path: Column) -> Column:
    """The key of the audit: eight characters without 0, 1 and O before an underscore or the name's end."""
    found = F.regexp_extract(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", ""), r"^([2-9A-NP-Z]{8})(?:_|$)", 1)
    return F.nullif(found, F.lit(""))


def skipped(path: Column) -> Column:
    return path.rlike(SKIPPED) | (F.instr(path, "/") == 0)


def ancestors(path: Column) -> Column:
    """All folders above a path, the nearest first."""
    parts = F.split(path, "/")
    n = F.size(parts) - 1
    return F.when(n > 0, F.transform(F.sequence(n, F.lit(1)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))).otherwise(F.expr("cast(array() as array<string>)"))


def stem(path: Column) -> Column:
    return F.regexp_replace(path, r"\.[^./]*$", "")


def covered(files: DataFrame, pointers: DataFrame, live: DataFrame) -> DataFrame:
    """files (path) with covered: a pointer names it, its stem or a folder above it, or its key is live."""
    named = pointers.select("pointer").distinct()
    hit = lambda rows: rows.join(named, rows["at"] == named["pointer"], "left_semi").select("path")
    by_pointer = hit(files.select("path", F.col("path").alias("at")).unionByName(files.select("path", stem(F.col("path")).alias("at"))).unionByName(files.select("path", F.explode(ancestors(F.col("path"))).alias("at"))))
    keys = files.select("path", audit_key(F.col("path")).alias("key"))
    by_key = keys.join(live.select("key").distinct(), "key", "left_semi").select("path")
    ok = by_pointer.unionByName(by_key).distinct().withColumn("covered", F.lit(True))
    return files.join(ok, "path", "left").withColumn("covered", F.coalesce("covered", F.lit(False)))


def resolve_pointers(pointers: DataFrame, existing: DataFrame, dash: str = " — ") -> DataFrame:
    """(pointer, target): the longest prefix of dash-separated parts that exists, else what precedes the first dash."""
    parts = F.split("pointer", dash)
    tries = pointers.select("pointer", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), dash))).alias("target"))
    found = tries.join(existing.select(F.col("path").alias("target")).distinct(), "target", "left_semi").groupBy("pointer").agg(F.max_by("target", F.length("target")).alias("target"))
    return pointers.select("pointer").distinct().join(found, "pointer", "left").select("pointer", F.coalesce("target", parts[0]).alias("target"))


def folder_rollup(files: DataFrame) -> DataFrame:
    """(folder, total, uncovered) for every folder above a file; files (path, covered)."""
    rows = files.select(F.explode(ancestors(F.col("path"))).alias("folder"), "covered")
    return rows.groupBy("folder").agg(F.count("*").alias("total"), F.sum((~F.col("covered")).cast("long")).alias("uncovered"))


def topmost(folders: DataFrame) -> DataFrame:
    """Folders that lie in none of the others."""
    inside = folders.select("folder", F.explode(ancestors(F.col("folder"))).alias("above")).join(folders.select(F.col("folder").alias("above")), "above", "left_semi").select("folder")
    return folders.join(inside.distinct(), "folder", "left_anti")


def mirror_state(files: DataFrame, items: DataFrame) -> DataFrame:
    """files (path, key) by state: live, trash or absent; items (key, trashed)."""
    known = items.groupBy("key").agg(F.min("trashed").alias("trashed"))
    state = F.when(F.col("trashed").isNull(), "absent").when(F.col("trashed"), "trash").otherwise("live")
    keyed = files.where("key is not null").join(known, "key", "left").select("path", "key", state.alias("state"))
    # files without a key match nothing: joined, all of them would meet in one task
    return keyed.unionByName(files.where("key is null").select("path", "key", F.lit("absent").alias("state")))


def collection_gaps(members: DataFrame, mirrored: DataFrame) -> DataFrame:
    """(coll, have, total, missing) of collections that are mirrored in part."""
    m = mirrored.select("key").distinct().withColumn("here", F.lit(1))
    out = members.join(m, "key", "left").groupBy("coll").agg(F.count("here").alias("have"), F.count("*").alias("total"))
    return out.where("have > 0 and have < total").withColumn("missing", F.col("total") - F.col("have"))


def mirror_audit(files: DataFrame, pointers: DataFrame, items: DataFrame, members: DataFrame) -> DataFrame:
    """(section, subject, detail): all findings of a mirror.

    orphan: a file whose key is in the trash or unknown; uncovered: a file that nothing accounts for; folder: the topmost folders
    with uncovered files only; missing: a pointer whose target isn't there; gap: a collection mirrored in part, with
    what it has and should have. files: path; pointers: pointer; items: key, trashed; members: coll, key.
    """
    row = lambda df, section, subject, detail: df.select(F.lit(section).alias("section"), F.col(subject).cast("string").alias("subject"), detail.cast("string").alias("detail"))
    kept = files.where(~skipped(F.col("path"))).select("path", audit_key(F.col("path")).alias("key"))
    states = mirror_state(kept.where("key <> ''"), items)
    live = items.where("not trashed")
    resolved = resolve_pointers(pointers, files.select("path").unionByName(files.select(stem(F.col("path")).alias("path"))).unionByName(files.select(F.explode(ancestors(F.col("path"))).alias("path"))))
    judged = covered(kept.select("path"), resolved.select(F.col("target").alias("pointer")), live)
    whole = folder_rollup(judged).where("total = uncovered")
    there = files.select(F.col("path").alias("target")).unionByName(files.select(stem(F.col("path")).alias("target"))).unionByName(files.select(F.explode(ancestors(F.col("path"))).alias("target"))).distinct()
    missing = resolved.join(there, "target", "left_anti")
    gaps = collection_gaps(members, states.where("state = 'live'").select("key"))
    out = row(states.where("state <> 'live'"), "orphan", "path", F.col("state"))
    for part in (
        row(judged.where("not covered"), "uncovered", "path", F.lit("")),
        row(topmost(whole), "folder", "folder", F.col("total")),
        row(missing, "missing", "pointer", F.col("target")),
        row(gaps, "gap", "coll", F.concat(F.col("have").cast("string"), F.lit(" of "), F.col("total").cast("string"))),
    ):
        out = out.unionByName(part)
    return out


def audit_passes(report: DataFrame, hard: tuple[str, ...] = ("orphan", "missing", "uncovered")) -> DataFrame:
    """(findings, passed): one row; the audit fails on any finding of the hard sections."""
    return report.agg(F.count("*").alias("findings"), (F.count_if(F.col("section").isin(*hard)) == 0).alias("passed"))


def library_manifest(items: DataFrame, collections: DataFrame, members: DataFrame) -> DataFrame:
    """(part, section, place, line) of a library's list in markdown; part, section and place order it.

    Parts: 0 totals, 1 items by type (most first, then by name), 2 collections in order of their paths' lower case, 3 items by
    collection and 4 those in none in order of their titles' lower case, 5 the trash in order of keys. An item's line has its
    creator and year, if any, and how many attachments and notes hang below it. Collections without items give no section.
    items: key, kind, title, creator, year, parent (null: top level), trashed; collections: key, path; members: coll, key.
    Places are told by ranges, so that a section of any size is numbered by several tasks.
    """
    live, top = items.where("not trashed"), items.where("not trashed and parent is null")
    kids = live.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count_if(F.col("kind") == "attachment").alias("atts"), F.count_if(F.col("kind") == "note").alias("notes"))
    text = lambda c: F.col(c).cast("string")
    row = lambda df, part, section, line, a=F.lit(0), b=F.lit(""): df.select(F.lit(part).alias("part"), section.alias("section"), a.cast("long").alias("a"), b.cast("string").alias("b"), text("key").alias("c") if "key" in df.columns else F.lit("").alias("c"), line.alias("line"))

    none = F.lit("")
    count = lambda test: F.count_if(test).cast("string")
    child = F.col("parent").isNotNull()
    totals = items.where("not trashed").agg(F.concat(F.lit("- Items (excl. trash): "), F.count("*").cast("string"), F.lit(" — top-level "), count(~child), F.lit(", child attachments "), count(child & (F.col("kind") == "attachment")), F.lit(", child notes "), count(child & (F.col("kind") == "note"))).alias("line"))
    parts = [
        row(totals, 0, none, F.col("line"), F.lit(0)),
        row(collections.agg(F.concat(F.lit("- Collections: "), F.count("*").cast("string")).alias("line")), 0, none, F.col("line"), F.lit(1)),
        row(items.agg(F.concat(F.lit("- Trash: "), F.count_if("trashed").cast("string")).alias("line")), 0, none, F.col("line"), F.lit(2)),
        row(live.groupBy("kind").agg(F.count("*").alias("n")), 1, none, F.concat(F.lit("- "), "kind", F.lit(": "), text("n")), -F.col("n"), F.col("kind")),
    ]
    filed = members.join(collections.select(F.col("key").alias("coll"), "path"), "coll").join(top.select("key"), "key", "left_semi")
    sizes = filed.groupBy("coll").agg(F.count("*").alias("n"))
    counted = collections.join(sizes.withColumnRenamed("coll", "key"), "key", "left")
    parts.append(row(counted, 2, none, F.concat(F.lit("- `"), text("key"), F.lit("` "), "path", F.lit(" — "), F.coalesce(text("n"), F.lit("0")), F.lit(" items")), F.lit(0), F.lower("path")))
    hung = F.array_compact(F.array(F.when(F.col("atts") > 0, F.concat(text("atts"), F.lit(" att"))), F.when(F.col("notes") > 0, F.concat(text("notes"), F.lit(" note")))))
    said = lambda c, before, after: F.when(F.coalesce(text(c), none) != "", F.concat(F.lit(before), text(c), F.lit(after))).otherwise("")
    line = F.concat(F.lit("- `"), text("key"), F.lit("` "), "kind", F.lit(" — "), said("creator", "", " "), said("year", "(", ") "), "title", F.when(F.size(hung) > 0, F.concat(F.lit(" ["), F.array_join(hung, ", "), F.lit("]"))).otherwise(""))
    lined = top.join(kids, "key", "left").select("key", "title", line.alias("line"))
    parts.append(row(lined.join(filed.select("key", F.concat("path", F.lit(" (`"), text("coll"), F.lit("`)")).alias("section")), "key"), 3, F.col("section"), F.col("line"), F.lit(0), F.lower("title")))
    parts.append(row(lined.join(members.select("key"), "key", "left_anti"), 4, F.lit("Unfiled (no collection)"), F.col("line"), F.lit(0), F.lower("title")))
    parts.append(row(items.where("trashed"), 5, F.lit("Trash"), F.concat(F.lit("- `"), text("key"), F.lit("` "), "kind", F.lit(" — "), "title")))
    return numbered(all_of(parts), ["part", "section"], [F.col("a"), F.col("b"), F.col("c")], "place").select("part", "section", "place", "line")


def manifest_text(manifest: DataFrame) -> DataFrame:
    """(value): the list as lines of markdown in order, section titles included, to be written as text by ranges."""
    titles = {0: "## Totals", 1: "### Items by type", 2: "## Collections", 3: "## Items by collection"}
    sections = manifest.groupBy("part", "section").agg(F.count("*").alias("n"))
    head = F.concat(F.when(F.col("part") == 5, "## ").otherwise("### "), "section", F.lit(" — "), F.col("n").cast("string"), F.lit(" items"))
    named = sections.where("section <> ''").select("part", "section", F.lit(0).cast("long").alias("place"), F.lit(0).alias("k"), head.alias("value"))
    fixed = manifest.sparkSession.createDataFrame([(p, "", 0, -1, t) for p, t in titles.items()], "part int, section string, place long, k int, value string")
    rows = manifest.select("part", "section", "place", F.lit(1).alias("k"), F.col("line").alias("value"))
    return all_of([fixed, named, rows]).orderBy("part", F.lower("section"), "section", "place", "k").select("value")


def failures_first(rows: DataFrame, why: str, key: str) -> DataFrame:
    """Rows with a reason before those without, by key each."""
    return rows.orderBy(F.coalesce(F.col(why), F.lit("")) == "", key)


#: Sources whose text this library extracts itself (the manifest's size binds), and the one whose text is paged.
OWN_SOURCES, PAGED = ("pdftotext", "ft-cache", "html", "none", "external"), "pdftotext"
MIXED_WORD, ONE_LENGTH, LONG = r"[A-Za-zА-Яа-яЁё]{3,}", 3, 1000


def text_check(texts: DataFrame, manifest: DataFrame) -> DataFrame:
    """(key, pages, chars, per_page, mixed, why): every extracted text against its entry in the manifest.

    texts: key, text; manifest: key, src, pages, size, truncated, complete, flags. A text fails for missing page marks or
    fewer than pages, fewer characters than recorded, an excerpt, a length that three long texts share, or the flags of
    an incomplete entry. mixed is the percentage of words with letters of two scripts. A text without an entry, or whose
    entry names no source, counts as paged; a null text is empty; pages and per_page are null without marks. The texts
    themselves aren't shuffled, only what is counted in them.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_extract_all(text, F.lit(MIXED_WORD), F.lit(0))
    mixed = F.size(F.filter(words, lambda w: w.rlike("[А-Яа-яЁё]") & w.rlike("[A-Za-z]"))) * 100.0 / F.greatest(F.size(words), F.lit(1))
    facts = texts.select("key", F.length(text).cast("long").alias("chars"), F.regexp_count(text, F.lit(MARK)).cast("long").alias("marks"), mixed.alias("mixed"))
    alike = facts.where(F.col("chars") > LONG).groupBy("chars").agg(F.count("*").alias("alike")).where(F.col("alike") >= ONE_LENGTH)
    entry = manifest.select("key", "src", F.col("pages").alias("_pages"), "size", "truncated", "complete", "flags")
    rows = facts.join(alike, "chars", "left").join(entry, "key", "left")
    src = F.coalesce("src", F.lit(PAGED))
    few = (src == PAGED) & (F.col("marks") > 0) & (F.col("marks") < F.col("_pages"))
    short = (F.col("size") != 0) & F.col("src").isin(*OWN_SOURCES) & (F.col("chars") < F.col("size"))
    why = F.array_compact(
        F.array(
            F.when((src == PAGED) & (F.col("marks") == 0), "no page marks"),
            F.when(few, say(F.col("marks"), "/", F.col("_pages"), " pages")),
            F.when(short, say(F.col("chars"), " < manifest ", F.col("size"), " chars")),
            F.when(F.col("truncated"), "excerpt"),
            F.when(F.col("alike").isNotNull(), say(F.col("alike"), " files share length ", F.col("chars"))),
        )
    )
    more = F.when(~F.col("complete"), F.array_except(F.coalesce("flags", F.expr("cast(array() as array<string>)")), F.col("why")))
    told = rows.withColumn("why", why).withColumn("why", F.concat("why", F.coalesce(more, F.expr("cast(array() as array<string>)"))))
    pages = F.when(F.col("marks") > 0, F.col("marks"))
    return told.select("key", pages.alias("pages"), "chars", F.floor(F.col("chars") / pages).alias("per_page"), shown(F.col("mixed"), 1).alias("mixed"), F.array_join("why", "; ").alias("why"))
