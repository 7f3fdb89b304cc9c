"""Prose checks: paragraphs, sentences, repetitions, citations and banned terms."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import text as tx
from folio.storage import cut

from .align import alike, ratio_from

SENTENCE_END = "(?<=[.!?…])\\s+(?=[«\"'(\\[]?\\p{L})"


def sentences(text: Column, abbreviations: list[str]) -> Column:
    """Sentences; a piece whose last twelve characters end in an abbreviation or a single letter and a full stop goes on."""
    short = F.array(*[F.lit(a) for a in abbreviations])
    pieces = F.split(text, SENTENCE_END)
    zero = F.struct(F.expr("cast(array() as array<string>)").alias("done"), F.lit("").alias("cur"))

    bound = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))  # noqa: E731  evaluated once

    def add(s: Column, cur: Column) -> Column:
        last = F.lower(F.regexp_extract(F.right(F.rtrim(cur), F.lit(12)), r"(\p{L}+)[^\p{L}]*$", 1))
        short_end = bound(last, lambda w: (F.length(w) == 1) | ((w != "") & F.array_contains(short, w)))
        ended = F.struct(F.concat(s.done, F.array(cur)).alias("done"), F.lit("").alias("cur"))
        return F.when(F.endswith(F.rtrim(cur), F.lit(".")) & short_end, F.struct(s.done.alias("done"), cur.alias("cur"))).otherwise(ended)

    def step(s: Column, p: Column) -> Column:
        return bound(F.when(s.cur == "", p).otherwise(F.trim(F.concat(s.cur, F.lit(" "), p))), lambda cur: add(s, cur))

    return F.filter(F.aggregate(pieces, zero, step, lambda s: F.when(s.cur != "", F.concat(s.done, F.array(s.cur))).otherwise(s.done)), lambda x: F.trim(x) != "")


def repeated_grams(paras: DataFrame, n: int, floor: int, id_col: str = "doc", text_col: str = "text") -> DataFrame:
    """(doc, gram, times): runs of n words that occur ``floor`` times in a document.

    All grams have n words, so one lies in another only if they are equal or letters run on at both ends; such are
    found among the grams that share their inner words.
    """
    words = paras.select(F.col(id_col).alias("doc"), tx.letter_words(F.col(text_col)).alias("w")).where(F.size("w") >= n)
    words = words.repartition("doc")  # a document's words are moved once instead of its grams
    grams = words.select("doc", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - (n - 1)), lambda k: F.array_join(F.slice("w", k, F.lit(n)), " "))).alias("gram"))
    found = cut(grams.groupBy("doc", "gram").agg(F.count("*").alias("times")).where(F.col("times") >= floor))  # read three times
    inner = lambda g: F.array_join(F.slice(F.split(g, " "), 2, n - 2), " ")
    keyed = found.withColumn("key", inner(F.col("gram")))
    other = keyed.select("doc", "key", F.col("gram").alias("longer"))
    inside = keyed.join(other, ["doc", "key"]).where((F.col("gram") != F.col("longer")) & F.contains("longer", "gram")).select("doc", "gram").distinct()
    return found.join(inside, ["doc", "gram"], "left_anti")


def shape(paras: DataFrame, by: str, text_col: str = "text") -> DataFrame:
    """(by, n, mean, median, longest) of paragraph lengths; the median is the upper of two."""
    lengths = paras.select(by, F.length(text_col).alias("n"))
    w = Window.partitionBy(by)
    ranked = lengths.withColumn("k", F.row_number().over(w.orderBy("n")) - 1).withColumn("all", F.count("*").over(w))
    return ranked.groupBy(by).agg(F.count("*").alias("n"), F.avg("n").alias("mean"), F.max(F.when(F.col("k") == F.expr("all div 2"), F.col("n"))).alias("median"), F.max("n").alias("longest"))


def punctuation_density(paras: DataFrame, by: str, text_col: str = "text") -> DataFrame:
    """(by, colons, dashes, per_100) of paragraphs."""
    colons, dashes = F.regexp_count(text_col, F.lit(":")), F.regexp_count(text_col, F.lit(r"(?<=\s)[—–](?=\s)"))
    out = paras.groupBy(by).agg(F.count("*").alias("n"), F.sum(colons.cast("long")).alias("colons"), F.sum(dashes.cast("long")).alias("dashes"))
    return out.select(by, "colons", "dashes", ((F.col("colons") + F.col("dashes")) * 100.0 / F.greatest(F.col("n"), F.lit(1))).alias("per_100"))


def matching_forms(text: Column, patterns: list[str], ignored: list[str]) -> Column:
    """Words that match a pattern and no ignored one."""
    hit = lambda w, ps: [w.rlike(f"(?iu){p}") for p in ps]

    def wanted(w: Column) -> Column:
        yes = F.lit(False)
        for c in hit(w, patterns):
            yes = yes | c
        for c in hit(w, ignored):
            yes = yes & ~c
        return yes

    return F.filter(F.regexp_extract_all(text, F.lit(tx.LETTER_RUN), F.lit(0)), wanted)


def banned_hits(paras: DataFrame, terms: list[str], by: str, text_col: str = "text") -> DataFrame:
    """(by, term, times): whole-word occurrences, case ignored."""
    times = [F.sum(F.regexp_count(text_col, F.lit(rf"(?iu)(?<!\p{{L}}){re.escape(t)}(?!\p{{L}})")).cast("long")).alias(f"n{k}") for k, t in enumerate(terms)]
    counted = paras.groupBy(by).agg(*times)  # all terms in one pass over the texts
    return counted.select(by, F.inline(F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"n{k}").alias("times")) for k, t in enumerate(terms)]))).where("times > 0")


def repeated_citations(refs: DataFrame, window: int) -> DataFrame:
    """(doc, ref, at, again): a reference cited again within the next paragraphs; refs (doc, para, ref)."""
    a = refs.select("doc", "ref", F.col("para").alias("at")).distinct()
    # each place also stands at the paragraphs it reaches, so the band join is an equi-join
    b = a.select("doc", "ref", F.col("at").alias("again"))
    reach = a.select("doc", "ref", "at", F.explode(F.sequence(F.col("at") + 1, F.col("at") + window)).alias("again"))
    return reach.join(b, ["doc", "ref", "again"]).select("doc", "ref", "at", "again")


def similar_candidates(items: DataFrame, shared: int = 3, share_cap: float = 0.08) -> DataFrame:
    """(doc, i, j, shared): sentence pairs of a document with enough rare words in common; items (doc, i, w)."""
    own = items.select("doc", "i", "w").repartition("doc")  # the rest needs no shuffle
    words = own.select("doc", "i", F.explode(F.array_distinct("w")).alias("word"))
    sizes = own.groupBy("doc").agg(F.count("*").alias("n"))
    places = words.groupBy("doc", "word").agg(F.collect_list("i").alias("at")).where(F.size("at") > 1)
    rare = places.join(sizes.hint("shuffle_hash"), "doc").where(F.size("at") <= F.greatest(F.lit(3), F.floor(F.col("n") * share_cap)))
    pairs = rare.select("doc", "at", F.explode("at").alias("i")).select("doc", "i", F.explode(F.filter("at", lambda j: j > F.col("i"))).alias("j"))
    return pairs.groupBy("doc", "i", "j").agg(F.count("*").alias("shared")).where(F.col("shared") >= shared)


def body_lines(lines: DataFrame, stop: str, skip: str) -> DataFrame:
    """Lines before the first that matches ``stop``, without those that match ``skip``; lines (doc, line, text)."""
    end = lines.where(F.col("text").rlike(stop)).groupBy("doc").agg(F.min("line").alias("_end"))
    return lines.join(end, "doc", "left").where((F.col("_end").isNull() | (F.col("line") < F.col("_end"))) & ~F.col("text").rlike(skip)).drop("_end")


def stubs(paras: DataFrame, abbreviations: list[str], limit: int) -> DataFrame:
    """(doc, para, place, words): first or last sentences of at most ``limit`` words, of paragraphs with two or more."""
    s = paras.select("doc", "para", sentences(F.col("text"), abbreviations).alias("s")).where(F.size("s") >= 2)
    n = lambda c: F.size(tx.letter_words(c))
    rows = s.select("doc", "para", F.explode(F.array(F.struct(F.lit("opener").alias("place"), n(F.get("s", F.lit(0))).alias("words")), F.struct(F.lit("closer").alias("place"), n(F.element_at("s", -1)).alias("words")))).alias("x"))
    return rows.select("doc", "para", "x.place", "x.words").where(F.col("words") <= limit)


#: Sentences of a document that are compared with as many others in one row.
BLOCK = 256


def alike_in(floor: float, shared: int):
    """A function of two columns, arrays of (i, key, w): the pairs (i, j, ratio) with i < j, of all that stand in one and the other."""

    @F.pandas_udf("array<struct<i: long, j: long, ratio: double>>")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([alike(x, y, floor, shared) for x, y in zip(left, right, strict=True)], index=left.index, dtype="object")

    return run


def similar_sentences(items: DataFrame, floor: float = 0.75, shared: int = 3, share_cap: float | None = None) -> DataFrame:
    """(doc, i, j, ratio): sentences of a document that nearly repeat. items: doc, i, key (the text compared), w (its words).

    They have ``shared`` different words in common; lengths differ by half of the first's at most; the ratio isn't symmetric, i stands
    first. Every two sentences of a document are compared, in blocks that are dealt anew if there are several. With ``share_cap``
    only words that stand in at most that share of a document's sentences (three at least) count as shared.
    """
    if share_cap is not None:
        pairs = similar_candidates(items, shared, share_cap)
        keys = lambda i, k: items.select("doc", F.col("i").alias(i), F.col("key").alias(k))
        both = pairs.join(keys("i", "ki"), ["doc", "i"]).join(keys("j", "kj"), ["doc", "j"])
        both = both.where(F.abs(F.length("ki") - F.length("kj")) <= F.length("ki") * 0.5)
        return both.select("doc", "i", "j", ratio_from(floor)("ki", "kj").alias("ratio")).where("ratio is not null")
    kind = items.schema["i"].dataType
    said = F.struct(F.col("i").cast("long").alias("i"), "key", F.array_distinct("w").alias("w"))
    parts = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the work is no measure of the bytes, by which fewer would be made
    whole = items.where("doc is not null and i is not null and key is not null").repartition(parts, "doc").groupBy("doc").agg(F.collect_list(said).alias("x"))
    starts = F.sequence(F.lit(1), F.size("x"), F.lit(BLOCK))
    met = F.flatten(F.transform(starts, lambda p: F.transform(F.filter(starts, lambda q: q >= p), lambda q: F.struct(p.alias("p"), q.alias("q")))))
    block = lambda k: F.slice("x", F.col(f"at.{k}"), F.lit(BLOCK)).alias(k)
    several = whole.where(F.size("x") > BLOCK).select("doc", "x", F.explode(met).alias("at")).select("doc", "at", block("p"), block("q"))
    several = several.repartition(parts, "doc", "at").select("doc", "p", F.when(F.col("at.p") != F.col("at.q"), F.col("q")).alias("q"))
    alone = whole.where(F.size("x").between(2, BLOCK)).select("doc", F.col("x").alias("p"), F.lit(None).cast(whole.schema["x"].dataType).alias("q"))
    found = lambda rows: rows.select("doc", F.inline(alike_in(floor, shared)("p", "q")))
    return found(alone).unionByName(found(several)).select("doc", F.col("i").cast(kind).alias("i"), F.col("j").cast(kind).alias("j"), "ratio")


def unglossed(texts: DataFrame, terms: list[str], window: int = 200, id_col: str = "doc", text_col: str = "text") -> DataFrame:
    """(doc, term, at): terms whose first use has no parenthesis within half the window on either side; at counts from 0."""

    def first_use(term: str) -> Column:
        parts = F.split(text_col, r"(?iu)(?<!\p{L})" + re.escape(term), 2)
        return F.when(F.size(parts) > 1, F.length(F.get(parts, F.lit(0))))

    rows = texts.select(F.col(id_col).alias("doc"), F.col(text_col).alias("t"), F.explode(F.array(*[F.struct(F.lit(t).alias("term"), first_use(t).alias("at")) for t in terms])).alias("x"))
    rows = rows.select("doc", "t", "x.*").where("at is not null")
    start = F.greatest(F.col("at") - window // 2, F.lit(0))
    near = F.substring(F.col("t"), start + 1, F.col("at") + F.length("term") + window // 2 - start)
    return rows.where(~near.rlike("[()]")).select("doc", "term", "at")


#: Checks whose findings fail a text under the strict gate.
HARD = ("banned", "similar", "glossing")


def prose_report(paras: DataFrame, checks: dict[str, Callable[[DataFrame], DataFrame]], only: list[str] | None = None) -> DataFrame:
    """(doc, check, note) of the registered checks, or of those named. A check makes (doc, note) of paragraphs."""
    if unknown := set(only or ()) - set(checks):
        raise ValueError(f"unknown checks: {sorted(unknown)}")
    parts = [f(paras).select("doc", F.lit(name).alias("check"), "note") for name, f in checks.items() if only is None or name in only]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def strict_gate(report: DataFrame, hard: tuple[str, ...] = HARD) -> DataFrame:
    """(doc, findings, hard, passed): a document passes without findings of hard checks."""
    hits = F.sum(F.col("check").isin(*hard).cast("long"))
    return report.groupBy("doc").agg(F.count("*").alias("findings"), hits.alias("hard")).withColumn("passed", F.col("hard") == 0)
