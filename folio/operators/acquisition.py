"""Lists of an acquisition: what is to do, what was found where, in which order, and how much of it there is.

Everything is an equi-join or an aggregation with partial results, so that one hot key costs one row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import records as rc

from .numbering import numbered


def _stem(path: Column) -> Column:
    return F.regexp_replace(path, r"\.[^./]*$", "")


def work_list(sources: DataFrame, targets: DataFrame, path: str = "path") -> DataFrame:
    """sources with ``skipped``: a target of the same name, whatever its suffix, is there already. A null path is to do."""
    made = targets.select(_stem(F.col(path)).alias("_stem"), F.lit(True).alias("_made")).where("_stem is not null").distinct()
    return sources.withColumn("_stem", _stem(F.col(path))).join(made, "_stem", "left").select(*sources.columns, F.coalesce("_made", F.lit(False)).alias("skipped"))


def first_hits(hits: DataFrame, by: str, order: str) -> DataFrame:
    """Of hits with one value only the first; nulls are no hits."""
    rest = [c for c in hits.columns if c not in (by, order)]
    first = hits.where(F.col(by).isNotNull()).groupBy(by).agg(F.min(F.struct(order, *rest)).alias("_x"))
    return first.select(by, *(F.col(f"_x.{c}").alias(c) for c in (order, *rest))).select(*hits.columns)


def with_fallback(asked: DataFrame, first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Answers of the first engine; of the second only for what the first found nothing. first, second: key and equal columns."""
    lacking = asked.select(key).distinct().join(first.select(key), key, "left_anti")
    return asked.select(key).distinct().join(first, key).unionByName(second.join(lacking, key, "left_semi"))


def first_names(rows: DataFrame, group: str, order: list[str], name: str, most: int = 6, sep: str = "; ") -> DataFrame:
    """(group, names): the first names of each group, joined. Ranks are taken by ranges, so that no task holds a group."""
    ranked = numbered(rows.select(group, *dict.fromkeys([*order, name])), [group], [F.col(c) for c in order], "_k").where(F.col("_k") <= most)
    return ranked.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", F.col(name).alias("v")))), lambda x: x["v"]), sep).alias("names"))


def flow_counts(rows: DataFrame, has_text: Column) -> DataFrame:
    """(total, with_text, without_text): one row; what is unknown has none."""
    has = F.coalesce(has_text, F.lit(False))
    return rows.agg(F.count("*").alias("total"), F.count_if(has).alias("with_text"), F.count_if(~has).alias("without_text"))


def flow_numbers(rows: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """(step, n): how many rows reach each step, in one pass."""
    counts = rows.agg(*(F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in steps.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("step"), F.col(f"`{c}`").alias("n")) for c in counts.columns))).alias("x")).select("x.step", "x.n")


def gross_and_distinct(picks: DataFrame, group: str, what: str) -> DataFrame:
    """(group, gross, distinct_n): picks, and how many different ones."""
    return picks.groupBy(group).agg(F.count("*").alias("gross"), F.countDistinct(what).alias("distinct_n"))


def log_rollup(lines: DataFrame, column: str, prefixes: dict[str, str]) -> DataFrame:
    """One row: how many lines begin with each prefix; prefixes: name -> prefix."""
    return lines.agg(*(F.count_if(F.startswith(column, F.lit(p))).alias(name) for name, p in prefixes.items()))


def in_log_order(rows: DataFrame, log: str, path: str, key: str) -> DataFrame:
    """rows with their place in each log: by path, rows without one last, then by key."""
    return numbered(rows, [log], [F.coalesce(F.col(path), F.lit("~")), F.col(key)], "place")


def in_url_order(urls: DataFrame, item: str, best: str, key: str) -> DataFrame:
    """urls with their place: an item's best first, then the rest by key."""
    return numbered(urls, [item], [~F.coalesce(F.col(best), F.lit(False)), F.col(key)], "place")


def refreshed(current: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """Current entries, and previous ones that aren't in the batch."""
    return current.unionByName(previous.join(current.select(key), key, "left_anti"))


#: Kinds of items that only hang below others.
CHILD_KINDS = ("attachment", "note", "annotation")


def live_items(items: DataFrame, deleted: DataFrame, key: str, kind: str = "kind", children: tuple[str, ...] = CHILD_KINDS) -> DataFrame:
    """(key, trashed) of items that stand by themselves; an unknown kind does."""
    gone = deleted.select(key).distinct().withColumn("_gone", F.lit(True))
    own = items.where(~F.coalesce(F.col(kind).isin(*children), F.lit(False)))
    return own.join(gone, key, "left").select(key, F.coalesce("_gone", F.lit(False)).alias("trashed"))


def by_identifier(wanted: DataFrame, items: DataFrame, key: str = "k") -> DataFrame:
    """(key, item): the item of the same DOI, else of the same arXiv number, else of that without its version; the smallest of several.

    wanted: key, doi, arxiv; items: item, doi, arxiv. Identifiers are compared in lower case; null and empty ones match nothing.
    """
    norm = lambda c: F.nullif(F.lower(F.trim(F.col(c))), F.lit(""))
    bare = lambda c: F.regexp_replace(norm(c), r"v[0-9]+$", "")
    forms = lambda rows, own: rows.select(own, F.explode(F.array_compact(F.array(*(F.when(v.isNotNull(), F.struct(F.lit(n).alias("rank"), v.alias("v"))) for n, v in enumerate((norm("doi"), norm("arxiv"), bare("arxiv"))))))).alias("x")).select(own, "x.rank", "x.v")
    met = forms(wanted, key).join(forms(items, "item").groupBy("rank", "v").agg(F.min("item").alias("item")), ["rank", "v"])
    best = met.groupBy(key).agg(F.min_by("item", "rank").alias("item"))
    return wanted.select(key).join(best, key, "left")


def first_of_equal(texts: DataFrame, text: str, order: str) -> DataFrame:
    """(order, copies): the first of equal texts, and how many there are; null texts are equal."""
    return texts.groupBy(F.sha2(F.col(text).cast("binary"), 256).alias("_h")).agg(F.min(order).alias(order), F.count("*").alias("copies")).drop("_h")


def canonical_sets(rows: DataFrame, key: str, member: str) -> DataFrame:
    """(key, members): each key's distinct members in order, so that equal sets are equal arrays."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(member)).alias("members"))


def text_audit(texts: DataFrame, key: str, chars: str, shared: int = 3, long: int = 1000, short: int = 200, more: dict[str, Column] | None = None) -> DataFrame:
    """(key, why) of texts that look wrong: several long ones of exactly one length, short ones, and what more tests say."""
    same = texts.where(F.col(chars) > long).groupBy(chars).agg(F.count("*").alias("_k")).where(F.col("_k") >= shared)
    rows = texts.join(same, chars, "left")
    tests = {"same length": F.col("_k").isNotNull(), "short": F.col(chars) < short} | (more or {})
    return rows.select(key, rc.reasons(tests).alias("why")).where(F.size("why") > 0)


def conversation_shapes(turns: DataFrame) -> DataFrame:
    """(conv_id, shape): role and length of each turn, in order."""
    one = F.struct("turn", F.concat_ws(":", "role", F.length("text")).alias("x"))
    return turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["x"]), " ").alias("shape"))


def any_turn(turns: DataFrame, test: Column, name: str) -> DataFrame:
    """(conv_id, name): whether a test holds for any turn of a conversation."""
    return turns.groupBy("conv_id").agg(F.bool_or(F.coalesce(test, F.lit(False))).alias(name))
