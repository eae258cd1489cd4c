"""The corpus pipeline: STAGES in order, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldmart.llm import decontaminate, jaccard, mixing, passages, toxicity
from fieldmart.llm.common import small_batches, stored


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    small_batches(spark)
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that n-gram Jaccard links join, the one with the least doc_id stays."""
    small_batches(spark)
    return jaccard.clean(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that other documents hold are cut from all but one."""
    small_batches(spark)
    return passages.clean(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    small_batches(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, as they are by now, with how many and in how many whole epochs."""
    small_batches(spark)
    return mixing.mix(docs, whole=True).filter("taken > 0")


STAGES = [
    ("toxicity", toxic),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing sources to target weights", mixture),
]
#: No SQL: neither the toxicity model nor the passages are expressible; tests/llm/test_pipeline.py compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir, each stored in the shared folder before the next reads it.

    Rows of the documents that ``mixing.mix`` takes words of, with their columns, the text as the stages left it, and size, source_size, target, epochs, taken. Null, empty and
    wordless texts pass the first four stages and give nothing to the mix; texts of any length are read whole; repeated
    rows with words leave one in the second stage; of ties the stages' docstrings tell; an empty table gives no rows.
    Further columns stay, whatever their names; the mix's own replace some of the same names.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
