"""The registered queries of this subpackage and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kvflow.llm import decontaminate, exactdedup, langid, licenses, mixing, quality, secretscan, sharding, simhash, urlfilter
from kvflow.llm.common import table


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exactdedup.duplicate_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents")).taken().select("doc_id", "size", "source_size", "target", "taken")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.predict(docs, quality.fit(quality.sample(docs, table(spark, sf_dir, "labels"))))


QUERIES = {
    "op1_langid": op1_langid,
    "op2_simhash": op2_simhash,
    "op3_licenses": op3_licenses,
    "op4_url_filter": op4_url_filter,
    "op5_sharding": op5_sharding,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_mixing": op7_mixing,
    "op8_secrets": op8_secrets,
    "op9_decontaminate": op9_decontaminate,
    "op10_quality": op10_quality,
}
ORACLE_SQL: dict[str, str] = {"op3_licenses": licenses.ORACLE_SQL, "op4_url_filter": urlfilter.ORACLE_SQL, "op6_exact_dedup": exactdedup.ORACLE_SQL, "op8_secrets": secretscan.ORACLE_SQL, "op9_decontaminate": decontaminate.ORACLE_SQL}
