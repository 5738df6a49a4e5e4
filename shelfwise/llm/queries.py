"""Registered queries of the numbered operators: each over its whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm.common import table


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.fertility import quality_rules
    return quality_rules(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.decontaminate import decontaminate
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.linededup import dedup_lines
    return dedup_lines(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.pii import personal_data
    return personal_data(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.secrets import secret_scan
    return secret_scan(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.quality import quality
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.radix import repeated_bytes
    return repeated_bytes(table(spark, sf_dir, "documents"))


def op11_ns_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.clusters import clustered
    return clustered(table(spark, sf_dir, "embeddings"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.resample import resample
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.exactdedup import duplicates
    return duplicates(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_fertility, op2_toxicity, op3_positional_index, op4_simhash, op5_line_runs,
                                   op6_personal_data, op7_packing, op8_secrets, op9_quality, op10_radix,
                                   op11_ns_clusters, op12_resample, op13_exact)}
