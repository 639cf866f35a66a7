"""A training corpus from ``documents``: classify, apply quality rules, drop near duplicates, mix sources, pack.

Each stage takes (spark, docs, sf_dir) and works on all rows it gets; all but
the last return rows of ``documents`` with its columns. ``run`` writes each
result as Parquet in the shared folder and reads it for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slipway.llm import bestfit, pivotal, repetition, resampling, shingle_join
from slipway.llm.queries import good, table, tokenizer
from slipway.llm.stored import stored, workers_import


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that importance resampling draws."""
    workers_import(spark)
    _, model = resampling.resample(docs, table(spark, sf_dir, "labels"), good())
    return model.sample(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the repetition rules keep."""
    workers_import(spark)
    return repetition.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate component, the one with the smallest id.

    Shingles have five words, documents link from a similarity of 0.8. Of rows that share an
    id one stays; rows with a null id are linked with nothing and stay.
    """
    workers_import(spark)
    found = shingle_join.near_duplicates(docs, words=5, percent=80)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.asc_nulls_last("text")))
    one = docs.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi") \
        .withColumn("row number of the id", first).where(F.col("row number of the id") == 1) \
        .drop("row number of the id")
    return one.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it; documents not taken go."""
    workers_import(spark)
    taken = pivotal.mix_sources(docs).where(F.col("copies") > 0)
    # rows that share id, source and size are told apart by a number, by text and by copies, so reruns agree
    key = ["doc_id", "source", "size"]

    def number(order: str):
        return F.row_number().over(Window.partitionBy(*key).orderBy(order))

    left = docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(pivotal.WORD)), F.lit(0)).cast("long")) \
        .withColumn("number", number("text")).alias("d")
    right = taken.select(*key, "copies").withColumn("number", number("copies")).alias("t")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in (*key, "number")]
    condition = same[0]
    for c in same[1:]:
        condition &= c
    rows = left.join(right, condition).select(*(F.col(f"d.{c}") for c in docs.columns),
                                              F.explode(F.sequence(F.lit(1), F.col("t.copies").cast("int"))))
    return rows.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each copy of a document goes; equal copies are packed one by one."""
    workers_import(spark)
    return bestfit.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("quality classifier", classify), ("quality rules", quality_rules),
          ("n-gram Jaccard join", drop_near_duplicates), ("mixing sources to target weights", mix),
          ("best-fit packing", pack)]

#: the classifier, the mix and the packing have no SQL form; tests/llm holds each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return docs
