"""A training corpus from raw documents, in five stages. Each takes (spark, docs, sf_dir) and returns a DataFrame.

Every stage learns and decides on what its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.storage import new_path

from . import langid, line_dedup, minhash, packing, toxicity
from .common import crc32_bucket, prepare
from .queries import vocabulary

HOLDOUT_TOXIC, HOLDOUT_LANG = 3, 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of predicted toxicity."""
    prepare(spark)
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), holdout=HOLDOUT_TOXIC)
    return docs.where(toxicity.score_column(F.col("text"), model) < toxicity.THRESHOLD)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by more than a narrow margin."""
    prepare(spark)
    dictionaries = langid.learn(docs.where(crc32_bucket("doc_id", HOLDOUT_LANG) != 0))
    return docs.where(~langid.language_column(F.col("text"), dictionaries).getField("rejected"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines dropped; a document of which nothing else is left goes."""
    prepare(spark)
    out = line_dedup.drop_lines(docs).where((F.col("n_dropped") == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the document with the smallest id; a row without an id only where no other is alike.

    Rows that repeat id and text are one document. For this rows without an id are numbered by their text, above usual ids.
    """
    prepare(spark)
    unnamed = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), unnamed).alias("i"), "text", F.struct(*docs.columns).alias("row"))
    kept = minhash.near_duplicates(rows, id_col="i").where("kept").select("i").distinct()
    again = rows.groupBy("i").agg(F.count("*").alias("n")).where("n > 1").select("i")
    out = rows.join(kept, "i", "left_semi")
    one = out.join(again, "i", "left_semi").dropDuplicates(["i", "text"])
    return out.join(again, "i", "left_anti").unionByName(one).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", known_language),
    ("lines", drop_boilerplate),
    ("near_duplicates", one_of_each_group),
    ("packing", pack),
]

#: Learned scores and tokenizers are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
