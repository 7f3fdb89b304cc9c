"""URL filtering by host and path rules: a sort-merge range join.

A rule (host, path prefix) fits its host and all subdomains; without a path it fits all paths. With the host's labels
reversed and ended by a mark that sorts below all else, host and path make one key in which every rule is an interval: the
keys that start with it. A url stands once for
each suffix of its host, so subdomains meet the rule of every parent host. Keys are range-partitioned and
sorted; a sweep walks keys and rules together and keeps a stack of the rules that are open at the place it
has reached. Rules are nested or disjoint, so the top of the stack is the longest one.

Urls and rules are two tables. Both are dealt to ranges of keys, whose bounds are sampled from the rules, and within a
range to salts: the rules of a range go to each of its salts, so a hot host or key is spread. A task sorts its rows and
sweeps them; rules that begin before a range and are still open at its start are handed to it.

Equal urls are collapsed before the sweep, so a url that fills a third of the table is judged once; the
verdicts are joined back on (host, path), where adaptive execution splits a hot key of the larger side.

Defined results: null urls and urls without ``://`` have an empty host and path, match no rule and get the
default verdict. The rule with the most characters wins; of equally long ones the one with the longer host.
A rule given twice keeps its first verdict. Repeated rows stay repeated; an empty table or an empty rule
list gives the default. Columns of the input with the names of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

ALLOW, BLOCK = "allow", "block"
#: Ranges are made for so many rules each, so many at most.
RULES_A_RANGE, MAX_RANGES = 1_000, 256
#: Ends the host of a key, so that no rule for "com" fits "computer".
HOST_END = "\x00"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host A-Z lower-cased; both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


class Sweep:
    """Walks ascending keys and rules together; the stack holds the rules that are open at the place it has reached."""

    def __init__(self, opened: Iterable[tuple] = ()):
        self.stack: list[tuple] = sorted(opened, key=lambda rule: len(rule[0]))  # (key, ...): each starts with the one before

    def at(self, key: str) -> tuple | None:
        """The longest rule that starts the key."""
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()
        return self.stack[-1] if self.stack else None

    def open(self, rule: tuple) -> None:
        self.at(rule[0])
        self.stack.append(rule)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """(key, verdict, host, path) of rules (verdict, host, path), each key once. Of a table's equal rules allow comes first."""
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(*r, n) for n, r in enumerate(rules)], "verdict string, host string, path string, n long")
    order = [c for c in ("n", "verdict") if c in rules.columns]
    rows = rules.withColumn("key", F.concat(F.array_join(F.reverse(F.split("host", r"\.")), "."), F.lit(HOST_END), "path"))
    return rows.groupBy("key").agg(F.min_by(F.struct("verdict", "host", "path"), F.struct(*order)).alias("r")).select("key", "r.*")


def _bounds(rules: DataFrame, total: int) -> list[str]:
    """Ascending keys at which ranges begin: one for about RULES_A_RANGE rules."""
    ranges = min(MAX_RANGES, total // RULES_A_RANGE)
    if not ranges:
        return []
    picked = rules.where(F.pmod(F.xxhash64("key"), F.lit(max(1, total // (16 * ranges)))) == 0).select("key")  # about 16 a range
    keys = sorted((r.key for r in picked.collect()), key=lambda k: k.encode("utf-8", "surrogatepass"))
    return [keys[k * len(keys) // (ranges + 1)] for k in range(1, ranges + 1)] if keys else []


def _opened(rules: DataFrame, bounds: list[str]) -> dict[int, list[tuple]]:
    """By range: the rules that begin before its bound and contain it. At most a bound's characters each."""
    out: dict[int, list[tuple]] = {k: [] for k in range(len(bounds) + 1)}
    if bounds:
        starts = [(n + 1, b[:k]) for n, b in enumerate(bounds) for k in range(1, len(b))]
        spark = rules.sparkSession
        for r in spark.createDataFrame(starts, "range int, key string").join(rules, "key").collect():
            out[r["range"]].append((r.key, r.verdict, r.host, r.path))
    return out


def _swept(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rank, host_rank, rule, verdict) of the keys that a rule fits. keys: key, host, path."""
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(rules, rules.count())
    opened = _opened(rules, bounds)
    salts = max(1, tasks // (len(bounds) + 1))
    own = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("key"))) if bounds else F.lit(0)
    urls = keys.select(own.alias("range"), F.pmod(F.xxhash64("host", "path"), F.lit(salts)).cast("int").alias("salt"), "key", F.lit(None).cast("string").alias("verdict"), "host", "path")
    heads = rules.select(own.alias("range"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "key", "verdict", "host", "path")
    rows = heads.unionByName(urls).repartition(tasks, "range", "salt").sortWithinPartitions("range", "salt", "key", F.col("verdict").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, walk = None, Sweep()
        for batch in batches:
            out = []
            for part, salt, key, verdict, host, path in zip(*(batch.column(c).to_pylist() for c in ("range", "salt", "key", "verdict", "host", "path")), strict=True):
                if (part, salt) != place:
                    place, walk = (part, salt), Sweep(opened[part])
                if verdict is not None:
                    walk.open((key, verdict, host, path))
                elif rule := walk.at(key):
                    _, said, of, prefix = rule
                    out.append((host, path, len(of) + len(prefix), len(of), of + prefix, said))
            if out:
                kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["host", "path", "rank", "host_rank", "rule", "verdict"])

    return rows.mapInArrow(run, "host string, path string, rank long, host_rank long, rule string, verdict string")


def judge_urls(df: DataFrame, rules: list[tuple[str, str, str]] | DataFrame, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """df with host, path, rule and verdict; rules are (verdict, host, path prefix), a list or a table of these columns."""
    host, path = url_parts(F.col(url_col))
    df = df.drop(*[c for c in ("host", "path", "rule", "verdict") if c != url_col]).withColumns({"host": host, "path": path})
    urls = df.select("host", "path").where(F.col("host") != "").distinct()
    labels = F.split("host", r"\.")
    backwards = F.reverse(labels)
    keys = urls.select("host", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(backwards, F.lit(1), n), "."), F.lit(HOST_END), F.col("path")))).alias("key"))
    hits = _swept(keys, written(rule_table(df.sparkSession, rules), "rules"))
    best = hits.groupBy("host", "path").agg(F.max(F.struct("rank", "host_rank", "rule", "verdict")).alias("_best"))
    rows = df.select(F.struct(*df.columns).alias("row"), "host", "path")  # whatever the columns are called
    out = rows.join(best, ["host", "path"], "left")
    return out.select(*(F.col("row")[c].alias(c) for c in df.columns), F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
