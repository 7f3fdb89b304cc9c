"""Numbers and sums inside groups that span several ranges."""

import random

from pyspark.sql import functions as F

from folio.operators.numbering import RANGE, numbered, ranged, running


def test_a_group_over_several_ranges(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([None, *range(500)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, at int, v long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = [F.col("at").asc_nulls_first(), F.col("v")]
        placed = ranged(df, ["g"], order)
        assert placed.where("g = 'hot'").select(RANGE).distinct().count() > 1
        got = running(placed, ["g"], order, {"n": ("sum", F.lit(1)), "total": ("sum", F.col("v")), "odd": ("bit_xor", F.col("v"))}).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(rows)
    want = {}
    for g in {r[0] for r in rows}:
        n = total = odd = 0
        for _, at, v in sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
            n, total, odd = n + 1, total + v, odd ^ v
            want[v] = (n, total, odd)
    assert {r.v: (r.n, r.total, r.odd) for r in got} == want


def test_numbers_of_none(spark):
    df = spark.createDataFrame([], "g string, at int")
    assert numbered(df, ["g"], [F.col("at")]).collect() == []
    one = spark.createDataFrame([(None, None), (None, 1)], "g string, at int")
    assert [(r["at"], r.n) for r in numbered(one, ["g"], [F.col("at").asc_nulls_first()]).orderBy("n").collect()] == [(None, 1), (1, 2)]
