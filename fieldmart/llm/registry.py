"""Queries of the operators on the tables of a folder, and SQL for those that it can express."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from . import alignment, chat, collocations, decontaminate, jaccard, licenses, minhash, mixing, oracle, passages, quality, scoring, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # tasks import this package too: on one machine from here, on a cluster from where it is installed
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scores(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(_table(spark, sf_dir, "pages"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.report(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(_table(spark, sf_dir, "conversations"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.clusters(_table(spark, sf_dir, "documents"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.clusters(_table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_scoring": op1_scoring,
    "op2_toxicity": op2_toxicity,
    "op3_licenses": op3_licenses,
    "op4_quality": op4_quality,
    "op5_mixing": op5_mixing,
    "op6_warc": op6_warc,
    "op7_passages": op7_passages,
    "op8_decontamination": op8_decontamination,
    "op9_chat": op9_chat,
    "op10_jaccard": op10_jaccard,
    "op11_minhash": op11_minhash,
    "op12_collocations": op12_collocations,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL = {
    "op5_mixing": oracle.OP5,
    "op6_warc": oracle.OP6,
    "op8_decontamination": oracle.OP8,
    "op9_chat": oracle.OP9,
    "op10_jaccard": oracle.OP10,
    "op11_minhash": oracle.OP11,
    "op12_collocations": oracle.OP12,
}
