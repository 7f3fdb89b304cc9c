"""Line deduplication with a log-template tree, in DataFrame functions only.

The tree has a fixed depth: a line is led by its number of tokens, then by its first ``LEAD`` tokens,
where tokens with a digit count as the variable ``<*>``. Lines in one leaf whose tokens agree after that
share a template. A leaf with several such templates is generalised, in two ways:

- At each place the token that most documents hold is constant if at least half of them hold it, else the place
  is variable; the lines that agree with ``AGREE`` of all places share the leaf's template.
- Tokens after the lead that fewer than ``min_docs`` documents hold at their place are variable; then one more
  place is blanked, each in turn. Lines that are equal after that share a pattern, if at most 1 - ``AGREE`` of
  the places are variable without a digit. So other lines in the leaf, however many, cannot hide a family of which
  one field varies over common values and any others over rare ones. A template in several recurring patterns
  joins the one with most documents; among equals the one whose first line comes first.

A template that occurs in ``MIN_DOCS`` documents or more recurs. Its lines are dropped from all documents
but the first (the smallest id, and there its first line), so nothing is lost that stands only once.

Defined results: lines end at "\\n"; blank lines are never templates and stay. Null text stays null, empty
text empty. Rows with equal id and text are one document and get the same result; rows with a null id
are documents by their text. Long texts are handled whole. An empty table gives an empty table. All columns
of the input stay; only the text is replaced. n_lines, n_dropped replace columns of those names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

LEAD, MIN_DOCS, AGREE = 4, 6, 0.8
VARIABLE = "<*>"


def masked(line: Column) -> Column:
    """The line with single blanks, tokens with a digit as variables."""
    odd = line.contains("  ")
    for c in "\t\r\x0b\f":
        odd = odd | line.contains(c)
    line = F.trim(F.when(odd, F.regexp_replace(line, r"\s+", " ")).otherwise(line))  # most lines need no search
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"[^ 0-9]*[0-9][^ ]*", VARIABLE)).otherwise(line)


def templates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_i, _t, n, template, leaf, m) of every line that is not blank: document, place, hashes, masked line."""
    lines = docs.select(F.col(id_col).alias("_i"), F.xxhash64(text_col).alias("_t"), F.posexplode(F.split(text_col, "\n")).alias("n", "line"))
    lines = lines.where(F.col("line").rlike(r"\S")).select("_i", "_t", "n", masked(F.col("line")).alias("m"))  # a filter on m would mask twice
    size = F.length("m") - F.length(F.replace("m", F.lit(" "), F.lit("")))
    return lines.select("_i", "_t", "n", "m", F.xxhash64("m").alias("template"), F.xxhash64(size, F.substring_index("m", " ", LEAD)).alias("leaf"))


def recurring(lines: DataFrame, keys: DataFrame, min_docs: int = MIN_DOCS, agree: float = AGREE) -> DataFrame:
    """(template, keep): the recurring templates and the place that keeps its line. keys: lines without m, written."""
    place = F.struct("_i", "_t", "n")
    by_doc = keys.groupBy("leaf", "template", "_i", "_t").agg(F.min("n").alias("n"))
    exact = written(by_doc.groupBy("leaf", "template").agg(F.count("*").alias("docs"), F.min(place).alias("keep")), "templates")

    leaves = exact.groupBy("leaf").agg(F.count("*").alias("kinds"), F.sum("docs").alias("docs")).where((F.col("kinds") > 1) & (F.col("docs") >= min_docs)).select("leaf")
    inner = lines.join(leaves, "leaf", "left_semi").groupBy("leaf", "template", "m").agg(F.count("*").alias("rows"))
    inner = inner.join(exact.select("template", "docs"), "template").select("leaf", "template", "docs", F.posexplode(F.split("m", " ")).alias("at", "token"))
    inner = written(inner, "tokens")
    tokens = written(inner.groupBy("leaf", "at", "token").agg(F.sum("docs").alias("docs")), "places")
    common = tokens.groupBy("leaf", "at").agg(F.max(F.struct("docs", "token")).alias("top"), F.sum("docs").alias("all")).where("2 * top.docs >= all").select("leaf", "at", F.col("top.token").alias("constant"))
    agreed = inner.join(common, ["leaf", "at"], "left").groupBy("leaf", "template").agg(F.avg((F.col("token") == F.coalesce("constant", F.lit(VARIABLE))).cast("double")).alias("share"))
    alike = agreed.where(F.coalesce("share", F.lit(0.0)) >= agree).select("leaf", "template")
    docs_of = keys.select("leaf", "template", "_i", "_t").join(alike, ["leaf", "template"], "left_semi").select("leaf", "_i", "_t").distinct()
    wide = docs_of.groupBy("leaf").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    general = alike.join(wide, "leaf").select("template", F.col("leaf").alias("family"), F.lit(0).alias("rank"), F.lit(0).cast("long").alias("docs"))

    shared = patterns(inner, tokens, exact, keys, min_docs, agree).select("template", F.col("pattern").alias("family"), F.lit(1).alias("rank"), "docs", "first")
    own = exact.where(F.col("docs") >= min_docs).select("template", F.col("template").alias("family"), F.lit(2).alias("rank"), "docs")
    choices = general.unionByName(own).unionByName(shared, allowMissingColumns=True)
    family = choices.groupBy("template").agg(F.min(F.struct("rank", -F.col("docs"), "first", "family")).alias("x")).select("template", "x.rank", "x.family")
    family = written(family.join(exact.select("template", "keep"), "template"), "families")
    first = family.groupBy("rank", "family").agg(F.min("keep").alias("keep"))
    return family.select("template", "rank", "family").join(first, ["rank", "family"]).select("template", "keep")


def patterns(inner: DataFrame, tokens: DataFrame, exact: DataFrame, keys: DataFrame, min_docs: int, agree: float) -> DataFrame:
    """(template, pattern, docs, first): the templates of every recurring pattern of two templates or more, a place blanked."""
    place = inner.join(tokens.withColumnRenamed("docs", "held"), ["leaf", "at", "token"])
    rare = (F.col("at") >= LEAD) & (F.col("token") != VARIABLE) & (F.col("held") < min_docs)
    sign = F.xxhash64("at", F.when(rare, VARIABLE).otherwise(F.col("token")))
    at = F.when((F.col("at") >= LEAD) & (F.col("token") != VARIABLE) & ~rare, F.struct("at", sign.alias("sign")))
    lines = place.groupBy("leaf", "template").agg(F.first("docs").alias("docs"), F.bit_xor(sign).alias("all"), F.count("*").alias("n"), F.count(F.when(rare, 1)).alias("blank"), F.collect_list(at).alias("ats"))
    free = F.floor((1 - agree) * F.col("n") + 1e-9) - F.col("blank")
    none = F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).cast("long").alias("sign")))
    lines = lines.where(free >= 0).select("leaf", "template", "docs", "all", F.explode(F.concat(none, F.when(free > 0, F.col("ats")).otherwise(F.slice("ats", 1, 0)))).alias("x"))
    blanked = F.xxhash64("leaf", F.col("all").bitwiseXOR(F.when(F.col("x.at") < 0, F.lit(0).cast("long")).otherwise(F.col("x.sign").bitwiseXOR(F.xxhash64("x.at", F.lit(VARIABLE))))))
    lines = written(lines.select("template", "docs", blanked.alias("pattern")).join(exact.select("template", "keep"), "template"), "patterns")
    found = lines.groupBy("pattern").agg(F.count("*").alias("kinds"), F.sum("docs").alias("docs"), F.max("docs").alias("most"), F.min("keep").alias("first")).where((F.col("kinds") > 1) & (F.col("docs") >= min_docs))
    found = lines.select("template", "pattern").join(found, "pattern")
    sure = found.where(F.col("most") >= min_docs).select("template", "pattern", "docs", "first")
    open_ = found.where(F.col("most") < min_docs).select("template", "pattern", "first")  # its templates may share documents
    docs_of = keys.select("template", "_i", "_t").join(open_, "template").select("pattern", "_i", "_t").distinct()
    wide = docs_of.groupBy("pattern").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    return sure.unionByName(open_.join(wide, "pattern").select("template", "pattern", "docs", "first"))


def without(lines: Column, gone: Column) -> Column:
    """The lines but for those at the places of gone (sorted, from 0): runs between them, so that time is linear."""
    n = F.size(gone)
    start = lambda k: F.when(k == 0, 0).otherwise(F.get(gone, k - 1) + 1)
    stop = lambda k, all_: F.when(k == n, F.size(all_)).otherwise(F.get(gone, k))
    runs = lambda all_: F.flatten(F.transform(F.sequence(F.lit(0), n), lambda k: F.slice(all_, start(k) + 1, stop(k, all_) - start(k))))
    return F.get(F.transform(F.array(lines), runs), F.lit(0))  # binds the lines, which would be split for every run


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, agree: float = AGREE) -> DataFrame:
    """docs with the recurring lines dropped from the text, n_lines and n_dropped."""
    lines = templates(docs, id_col, text_col)
    keys = written(lines.drop("m"), "lines")
    found = recurring(lines, keys, min_docs, agree)
    hit = keys.select("_i", "_t", "n", "template").join(found, "template").where(~F.struct("_i", "_t", "n").eqNullSafe(F.col("keep")))
    gone = hit.groupBy("_i", "_t").agg(F.array_sort(F.collect_set("n")).alias("gone"))
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    own = docs.select(F.struct(*rest).alias("row"), F.col(id_col).alias("i"), F.xxhash64(text_col).alias("h"))
    out = own.join(gone, F.col("i").eqNullSafe(F.col("_i")) & (F.col("h") == F.col("_t")), "left")
    lines_of = F.split(F.col("row")[text_col], "\n")
    text = F.when(F.col("gone").isNull(), F.col("row")[text_col]).otherwise(F.array_join(without(lines_of, F.col("gone")), "\n"))
    counts = {"n_lines": F.coalesce(F.size(lines_of), F.lit(0)).cast("long"), "n_dropped": F.coalesce(F.size("gone"), F.lit(0)).cast("long")}
    return out.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in rest], *[v.alias(k) for k, v in counts.items()])
