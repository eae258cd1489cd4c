"""Gold tables: baseline, enrolment and the QC summary."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart import codes

ENROLMENT = ("uniqueid", "subjid", "screening_id", "countrycode", "tabletnum", "health_facility", "consent", "vdate", "starttime", "stoptime", "interviewer_id")


def _consent(strict: bool):
    return F.col("consent").cast("int") if strict else F.trim(F.col("consent")).try_cast("int")


def baseline(silver: DataFrame) -> DataFrame:
    """Rows with a key, without the tracking columns."""
    return silver.filter("uniqueid is not null").drop(*codes.TRACKING)


def enrolment(silver: DataFrame, strict: bool = False) -> DataFrame:
    """Consented rows with a subject id. Text that is no integer counts as no consent, or fails if strict; absent columns are null."""
    columns = [F.col(c) if c in silver.columns else F.lit(None).cast("string").alias(c) for c in ENROLMENT]
    return silver.filter((_consent(strict) == 1) & F.col("subjid").isNotNull()).select(*columns)


def all_marts(silver: DataFrame, created_at: datetime.datetime | None = None) -> dict[str, DataFrame]:
    """Every gold table by name, in the order that they are built."""
    return {"baseline": baseline(silver), "enrollment": enrolment(silver), "qc_checks": qc_summary(silver, created_at)}


def qc_summary(silver: DataFrame, created_at: datetime.datetime | None = None) -> DataFrame:
    """Six counts by country code and device."""
    consented = _consent(False) == 1
    out = silver.groupBy("countrycode", "tabletnum").agg(
        F.count("*").alias("total_records"),
        F.count_if(consented).alias("consented"),
        F.count_if(F.col("subjid").isNotNull() & consented).alias("enrolled"),
        F.count_if(F.col("uniqueid").isNull()).alias("missing_uniqueid"),
        F.count_if(F.col("screening_id").isNull()).alias("missing_screening_id"),
        F.count_if(F.col("mobile_number").isNull() & consented).alias("missing_phone_consented"),
    )
    return out if created_at is None else out.withColumn("created_at", F.lit(created_at))
