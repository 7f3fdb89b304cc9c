"""Running counts and sums inside groups of any size.

A window over a group puts the whole group into one task. Here rows are dealt to ranges of (keys, order), so that a
large group spans several ranges; each range is summed by itself, and what the group has in earlier ranges is added. Only
the first group of a range can have begun before it, so what is added is at most one row per range, and is broadcast.

Defined results: null keys are one group. Rows that are equal in keys and order are numbered in no set order, but each
once. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.storage import cut

RANGE = "_range"
#: How totals are taken and put together: the aggregate, and what joins two of its results.
KINDS = {"sum": (F.sum, lambda a, b: a + b), "bit_xor": (F.bit_xor, lambda a, b: a.bitwiseXOR(b))}


def ranged(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """df with the number of the range of (keys, order) that each row is in; a table in the shared folder."""
    placed = df.repartitionByRange(*(F.col(k).asc_nulls_first() for k in keys), *order)
    return cut(placed.withColumn(RANGE, F.spark_partition_id()))


def running(df: DataFrame, keys: list[str], order: list[Column], totals: dict[str, tuple[str, Column]]) -> DataFrame:
    """df (of ``ranged``) with totals over the rows of the same keys up to each row: name -> (kind, column)."""
    local = Window.partitionBy(RANGE, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = (Window.partitionBy(*keys) if keys else Window).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    each = df.groupBy(RANGE, *keys).agg(*(KINDS[kind][0](c).alias(f"_before_{name}") for name, (kind, c) in totals.items()))
    earlier = each.select(RANGE, *keys, F.count("*").over(before).alias("_ranges"), *(KINDS[kind][0](f"_before_{name}").over(before).alias(f"_before_{name}") for name, (kind, _) in totals.items()))
    earlier = F.broadcast(earlier.where("_ranges > 0").select(F.col(RANGE).alias("_r"), *(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)), *(f"_before_{name}" for name in totals)))
    same = F.col(RANGE) == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    summed = df.withColumns({name: KINDS[kind][0](c).over(local) for name, (kind, c) in totals.items()}).join(earlier, same, "left")
    whole = {name: F.when(F.col("_r").isNull(), F.col(name)).otherwise(KINDS[kind][1](F.col(name), F.col(f"_before_{name}"))) for name, (kind, _) in totals.items()}
    return summed.select(*df.columns, *(c.alias(name) for name, c in whole.items()))


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str = "n") -> DataFrame:
    """df with the number of each row in its group, from 1."""
    return running(ranged(df, keys, order), keys, order, {name: ("sum", F.lit(1).cast("long"))}).drop(RANGE)
