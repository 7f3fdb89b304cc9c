"""Tables in buckets, the index that follows its documents, and blocks of vectors."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.operators import search, stored_index
from folio.storage import read_buckets, replace_buckets, touched_buckets


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def size(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_a_batch_writes_its_buckets_only(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k long, v string"
    put = lambda values: spark.createDataFrame(values, schema)
    first = put([(k, "a" * 200) for k in range(400)])
    assert replace_buckets(spark, path, {"rows": (first, "k")}, touched_buckets(first, "k", 16), 16) == 16
    whole = size(tmp_path / "t")
    batch = put([(5, "b")])
    touched = touched_buckets(batch, "k", 16)
    kept = read_buckets(spark, path, schema, only=touched).where("k <> 5")
    assert len(touched) == 1 and replace_buckets(spark, path, {"rows": (kept.unionByName(batch), "k")}, touched, 16) == 1
    assert rows(read_buckets(spark, path, schema)) == sorted((k, "b" if k == 5 else "a" * 200) for k in range(400))
    newest = max((tmp_path / "t").glob("v-*"), key=lambda p: p.stat().st_mtime)
    assert size(newest) < whole / 8
    before = rows(read_buckets(spark, path, schema))
    bad = kept.withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        replace_buckets(spark, path, {"rows": (bad, "k")}, touched, 16)
    assert rows(read_buckets(spark, path, schema)) == before
    for k in range(3):  # what no pointer names any longer goes
        replace_buckets(spark, path, {"rows": (put([(5, str(k))]), "k")}, touched, 16)
    assert len(list((tmp_path / "t").glob("v-*/rows/_bucket=*"))) <= 16 + 2 and ("5", 5) not in rows(read_buckets(spark, path, schema))
    assert rows(read_buckets(spark, str(tmp_path / "none"), schema)) == []


def embed(text):
    return F.transform(F.array(*map(F.lit, "abcdef")), lambda c: F.regexp_count(text, c).cast("double"))


def test_an_index_follows_its_documents(spark, tmp_path):
    path, rng = str(tmp_path / "ix"), random.Random(4)
    words = ["abba", "cab", "deaf", "bead", "fade", "ace", "decade"]
    text = lambda: "{3}" + "-" * 48 + "\n" + "\n\n".join(" ".join(rng.choices(words, k=60)) for _ in range(rng.randrange(4)))
    docs = {f"d{i}": text() for i in range(30)} | {"null": None, "empty": ""}
    frame = lambda d: spark.createDataFrame(list(d.items()), "path string, text string")
    assert stored_index.update(spark, path, frame(docs), embed, buckets=8)["written"] == 32
    assert stored_index.update(spark, path, frame(docs), embed) == {"written": 0, "gone": 0, "buckets": 0}
    docs |= {"d3": text() + " ace", "new": text()}
    del docs["d4"], docs["d5"]
    done = stored_index.update(spark, path, frame(docs), embed)
    assert (done["written"], done["gone"]) == (2, 2) and done["buckets"] <= 4
    stored_index.update(spark, str(tmp_path / "fresh"), frame(docs), embed, buckets=4)
    at_once = lambda name, schema: rows(read_buckets(spark, str(tmp_path / "fresh"), schema, name))
    for name, schema in (("docs", stored_index.DOCS), ("chunks", stored_index.CHUNKS), ("postings", stored_index.POSTINGS)):
        assert rows(read_buckets(spark, path, schema, name)) == at_once(name, schema)
    round_ = lambda df: sorted((r.cid, round(r.score, 6)) for r in df.collect())
    question = "cab decade"
    found = round_(stored_index.ask(spark, path, question))
    chunks = read_buckets(spark, path, stored_index.CHUNKS, "chunks")
    assert found == round_(search.bm25(search.postings(chunks), question)) != []
    q = [1.0, 0.0, 2.0, 0.0, 0.0, 1.0]
    near = stored_index.nearest(spark, path, q, 5)
    plain = search.top(search.vector_scores(chunks.select("cid", embed(search.tx.for_model(F.col("text"), "passage")).alias("v")), q, "cid", "v"), 5)
    assert [round(r.score, 5) for r in near.orderBy("rank").collect()] == [round(r.score, 5) for r in plain.orderBy("rank").collect()]
    assert stored_index.passages(spark, path, near).count() == 5


@pytest.mark.parametrize("rows_in_block", [1, 7, 1000])
def test_blocks_find_the_nearest(spark, rows_in_block):
    rng = np.random.default_rng(rows_in_block)
    vectors = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(60)]
    odd = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0]), (103, [1.0, 2.0]), (104, [0.0] * 4)]
    df = spark.createDataFrame(vectors + odd, "cid long, vector array<double>").repartition(3)
    blocks = stored_index.vector_blocks(df, rows=rows_in_block)
    q = [1.0, -1.0, 0.5, 0.0]
    got = stored_index.block_top(blocks, q, 9).orderBy("rank").collect()
    score = {i: np.dot(v, q) / np.linalg.norm(q) / (np.linalg.norm(v) + 1e-9) for i, v in [*vectors, odd[-1]]}
    want = sorted(score, key=lambda i: (-round(score[i], 6), i))[:9]
    assert [round(r.score, 5) for r in got] == [round(score[i], 5) for i in want]
    assert sum(len(r.ids) for r in blocks.collect()) == 62 and max(len(r.ids) for r in blocks.collect()) <= rows_in_block
    assert stored_index.block_top(blocks.where("dim = 9"), q, 3).count() == 0
