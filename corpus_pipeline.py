"""The document pipeline: each stage applies one operator to all that the stage before it kept.

Every stage but the last returns the columns of ``documents``. No stage is expressible in SQL (hashed regression, shingle
components, Markov models), so ``ORACLE_SQL`` is None and tests hold the stages against brute force.

Nulls: a null text is empty; a row without an id passes every stage like any other; in a group of near copies the row of
the least id stays, null ids last, and of rows that repeat each other one. Rows that share an id but not the text are
told apart. Empty tables pass every stage; other columns, whatever their names, come out as they went in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxstrata.llm import mixing, near_copies, packing, quality, secret_scan
from voxstrata.llm.common import documents, stored
from voxstrata.llm.subwords import vocabulary_path

ORACLE_SQL = None


def grade(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ordinal regression on the labels; documents whose chance of the best grade is below a half go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.rate(docs, quality.fit(docs, quality.graded(labels)), least_tail=0.5, keep=True)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash tiles by exclusive-or and bit counts; what meets is linked at a Jaccard similarity of 0.8 or more of its five-word
    shingles, and of each connected group the row of the least id stays."""
    return near_copies.first_copies(docs, least=0.8, shingle=5)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; the documents stay."""
    return secret_scan.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Weighted fair queueing over sources: 150 % of the words, each document twice at most; a row for each time."""
    plan = mixing.mixed(docs, weights=(5, 2, 1), share=1.5, epochs=2).groupBy("doc_id", "mark").agg(F.count_if(F.col("times") == 2).alias("twice"), F.count_if(F.col("times") >= 1).alias("once"))
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("none")).alias("key")
    mark = F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("mark")
    rows = docs.select(F.struct(*docs.columns).alias("doc"), named, mark)  # one column, so no name of the table's can clash
    # rows equal in id and text share the times that the plan gives them
    rows = rows.withColumn("turn", F.row_number().over(Window.partitionBy("key", "mark").orderBy(F.lit(0))))
    rows = rows.join(plan.filter("once > 0").select(named, "mark", "twice", "once"), ["key", "mark"]).filter("turn <= once")
    return rows.select(F.explode(F.array_repeat("doc", F.when(F.col("turn") <= F.col("twice"), 2).otherwise(1))).alias("doc")).select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 ids."""
    return packing.pack_documents(docs, vocabulary_path("byte_bpe_50k.json"), 1024, 2)


STAGES = [("quality", grade), ("near_duplicates", deduplicate), ("secrets", hide_secrets), ("mix", mix), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
