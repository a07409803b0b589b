"""The registered queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import lm_scoring, media, merkle, mixing, packing, quality, secret_scan, sharding, simhash, token_files
from .common import documents
from .subwords import vocabulary_path


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scores(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.tiktoken"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.document_grades(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), least_tail=0.5)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), radius=4, shingle=4, seed=42)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_digests(secret_scan.scan(documents(spark, sf_dir)))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(media.stored_media(documents(spark, sf_dir)))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"), 1024, 2)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"), 2)


def op5_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_fingerprints(documents(spark, sf_dir))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir), weights=(5, 2, 1), share=1.5, epochs=2).drop("mark")


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(documents(spark, sf_dir), 24, law="rows")


QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_simhash": op2_simhash,
    "op3_pack": op3_pack,
    "op4_secrets": op4_secrets,
    "op5_merkle": op5_merkle,
    "op6_mix": op6_mix,
    "op7_shards": op7_shards,
    "op8_quality": op8_quality,
    "op9_media": op9_media,
    "op10_token_files": op10_token_files,
}
ORACLES = {"op6_mix": mixing.ORACLE}
