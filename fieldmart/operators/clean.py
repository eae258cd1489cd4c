"""Country filter, exact and newest-per-key deduplication, and what they dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart import codes
from fieldmart.functions.parse import number


def expected_code(country: Column = None) -> Column:
    """The code configured for the row's country; null for others."""
    table = F.create_map(*[F.lit(x) for pair in codes.COUNTRY_CODES.items() for x in pair])
    return F.try_element_at(table, F.lower(F.col("country") if country is None else country))


def country_filter(df: DataFrame) -> DataFrame:
    """Rows whose numeric country code is the one of their country; all rows of countries without a code."""
    return df.filter(expected_code().isNull() | (number(F.col("countrycode")) == expected_code()))


def dedup_exact(df: DataFrame, ignore: Sequence[str] = ("_source_db",)) -> DataFrame:
    """One of every set of rows that agree in all other columns; nulls agree."""
    keys = [c for c in df.columns if c not in ignore]
    extra = [F.min(c).alias(c) for c in df.columns if c in ignore]
    return (df.groupBy(*keys).agg(*extra) if extra else df.distinct()).select(df.columns)


def dedup_latest(df: DataFrame, key: str = "uniqueid", order: str = "extracted_at", tie: str = "row_id", scope: str = "country") -> DataFrame:
    """The newest row of each key within a country, nulls last; rows with a blank key all stay."""
    blank = F.col(key).isNull() | (F.trim(F.col(key)) == "")
    # rows without a key are spread by their tie-break, so that they don't meet in one task
    group = Window.partitionBy(scope, F.when(blank, F.col(tie).cast("string")).otherwise(F.col(key)), blank)
    newest = F.row_number().over(group.orderBy(F.col(order).desc_nulls_last() if order in df.columns else F.lit(0), F.col(tie).desc()))
    return df.withColumn("_place", newest).filter((F.col("_place") == 1) | blank).drop("_place")


def silver(df: DataFrame) -> DataFrame:
    """All three steps for every country at once; rows without a country go."""
    return dedup_latest(dedup_exact(country_filter(df.filter("country is not null")))).drop("_source_db")


def cleaning_audit(df: DataFrame) -> DataFrame:
    """By country: rows, rows with a wrong code, exact copies, older rows of a key."""
    total = df.filter("country is not null").groupBy("country").agg(F.count("*").alias("n_rows"))
    valid = country_filter(df.filter("country is not null"))
    distinct = dedup_exact(valid)
    count = lambda d, name: d.groupBy("country").agg(F.count("*").alias(name))
    joined = total.join(count(valid, "v"), "country", "left").join(count(distinct, "d"), "country", "left").join(count(dedup_latest(distinct), "l"), "country", "left").na.fill(0)
    return joined.select("country", "n_rows", (F.col("n_rows") - F.col("v")).alias("wrong_code"), (F.col("v") - F.col("d")).alias("exact_copies"), (F.col("d") - F.col("l")).alias("older_rows"))
