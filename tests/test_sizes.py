"""Results that only larger or rarer inputs tell apart."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from folio.operators import align, discovery, lint, search
from folio.plans import registry


def write(spark, folder, name: str, rows: list[tuple], schema: str) -> str:
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_d05_leaves_single_letters_alone(spark, tmp_path):
    text = "Threinou haea onble a.\nThating the. Tionshou e\nonpeace o, x-paced"
    sf = write(spark, tmp_path, "benchmark", [(1, text), (2, text.replace("Threinou ", "")), (3, text.replace("haea ", "")), (4, ""), (5, "a")], "item_id long, text string")
    got = dict(map(tuple, registry.queries()["d05_reconciled"](spark, sf).collect()))
    want = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    assert got == want


def test_common_length_bounds_the_similarity():
    chance = random.Random(1)
    for n in range(400):
        a, b = ("".join(chance.choice("abc д") for _ in range(chance.randrange(40))) for _ in "ab")
        if n % 3 == 0:
            b = a[: len(a) // 2] + "x" + a[len(a) // 2 + n % 4 :]
        floor, whole = chance.choice((0.0, 0.5, 0.72, 0.75, 1.0)), align.similarity(a, b)
        assert 2.0 * align.common_length(a, b) / max(len(a) + len(b), 1) >= whole or a == b == ""
        assert align.similarity_from(a, b, floor) == (whole if whole >= floor else None)


def test_similar_sentences_move_items_once(spark):
    """No shuffle carries a row per word: all of them deal rows with whole sentences, or pairs."""
    said = ["one two three four five six", "one two three four five sex", "nothing in common here", "one two three four five six"]
    items = spark.createDataFrame([(d, i, s, s.split()) for d in (1, 2) for i, s in enumerate(said)], "doc long, i int, key string, w array<string>")
    got = sorted(tuple(r) for r in lint.similar_sentences(items).collect())
    want = [(d, i, j, align.similarity(said[i], said[j])) for d in (1, 2) for i, j in ((0, 1), (0, 3), (1, 3))]
    assert got == want
    moved = lint.similar_candidates(items)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc#" in moved and "word#" not in "".join(x for x in moved.splitlines() if "Exchange" in x)
    grams = lint.repeated_grams(items.select("doc", F.col("key").alias("text")), 3, 2)
    assert {tuple(r) for r in grams.collect()} >= {(1, "one two three", 3), (2, "four five six", 2)}
    first = grams._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not any("Exchange hashpartitioning(doc" in x and "gram" in x and "partial" in first[k + 1] for k, x in enumerate(first[:-1]))


def test_postings_move_texts_and_equal_chunks_score_alike(spark):
    text = "this thereation pour lichkeit and worthless thereof"
    docs = spark.createDataFrame([(k, text) for k in range(40)] + [(k, "other words " * k) for k in range(40, 90)], "cid long, text string").repartition(7)
    index = search.postings(docs)
    moved = [x for x in index._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x]
    assert len(moved) == 1 and "hashpartitioning(cid#" in moved[0] and "term" not in moved[0]
    best = search.top(search.bm25(index, "this thereation pour lichkeit and worthless"), 40).orderBy("rank").collect()
    assert [r.cid for r in best] == list(range(40)) and len({r.score for r in best}) == 1


def exchanges(df) -> list[str]:
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x]


def test_abstracts_move_texts_once(spark, tmp_path):
    texts = [(k, " the  cat and\tthe dog" * (k % 5) + f" {k}" if k % 4 else " ") for k in range(40)]
    sf = write(spark, tmp_path, "documents", texts, "doc_id long, text string")
    out = registry.queries()["x05_rebuild_abstract"](spark, sf)
    assert len(exchanges(out)) == 1 and "hashpartitioning(doc_id#" in exchanges(out)[0]
    assert sorted(map(tuple, out.collect())) == [(k, " ".join(t.split())) for k, t in texts if t.strip()]
    works = spark.createDataFrame([(1, {"b": [1, 3], "a": [0], "c": [3]}), (2, {"x": None, "y": [7]}), (3, {}), (4, None), (5, {"z": []})], "id long, inv map<string,array<int>>")
    built = discovery.rebuild_abstract(works, "id", "inv")
    assert not exchanges(built)
    assert sorted(map(tuple, built.collect())) == [(1, " ".join(["a", "b", next(w for w in reversed(list(works.where("id = 1").selectExpr("map_keys(inv) k").head().k)) if w in "bc")])), (2, "y")]


def test_grams_are_counted_once(spark):
    """What lies in other grams is told from the counted grams, not from the texts once more."""
    paras = spark.createDataFrame([(1, "one two three one two three one two"), (2, "bone two threes one two three bone two threes one two three")], "doc long, text string")
    grams = lint.repeated_grams(paras, 3, 2)
    assert "Generate" not in grams._jdf.queryExecution().executedPlan().toString()
    want = [(1, "one two three", 2), (1, "three one two", 2), (1, "two three one", 2), (2, "bone two threes", 2), (2, "threes one two", 2), (2, "two threes one", 2)]
    assert sorted(map(tuple, grams.collect())) == want


def test_similar_sentences_leave_no_pair_out(spark, monkeypatch):
    """Words of many sentences count too, in one block and in several."""
    chance = random.Random(3)
    words = "bank pays firms tokens ledger holds going thing".split()
    said = [" ".join(chance.choices(words, k=chance.randint(3, 9))) for _ in range(40)]
    items = spark.createDataFrame([(d, i, s, s.split()) for d in (1, 2, None) for i, s in enumerate(said)] + [(3, 0, "a b c", ["a", "b", "c"]), (4, 0, None, None)], "doc long, i int, key string, w array<string>").repartition(5)
    alike = lambda x, y: len(set(x.split()) & set(y.split())) >= 3 and abs(len(x) - len(y)) <= len(x) * 0.5 and align.similarity(x, y) >= 0.75
    want = [(d, i, j, align.similarity(said[i], said[j])) for d in (1, 2) for i in range(40) for j in range(i + 1, 40) if alike(said[i], said[j])]
    assert len(want) > lint.similar_sentences(items, share_cap=0.08).count()
    for block in (256, 7):
        monkeypatch.setattr(lint, "BLOCK", block)
        found = lint.similar_sentences(items)
        assert sorted(map(tuple, found.collect())) == want and found.schema["i"].dataType == items.schema["i"].dataType
