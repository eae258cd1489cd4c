"""Sinks: versioned overwrite, publishing, dated snapshots, run audit, guarded CSV."""

from __future__ import annotations

import datetime
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.operators.ordering import ORDERS, in_order
from fieldmart.session import claimed, delete_folder, folders

_NAME = re.compile(r"^[a-z_][a-z0-9_]*$")


def safe_name(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"not a table name: {name!r}")
    return name


def _versions(spark: SparkSession, folder: str, name: str) -> list[tuple[int, str]]:
    """Number and folder of a table's versions, oldest first. A pointer is a file name, '<number>=<folder>', so it is there as a whole or not at all."""
    names = [n for n, _ in folders(spark, f"{folder}/{safe_name(name)}/CURRENT")]
    return sorted((int(n.split("=")[0]), n.split("=")[1]) for n in names if "=" in n)


def overwrite_table(df: DataFrame, folder: str, name: str, keep: int = 2) -> str:
    """Writes a new version beside the old ones, then takes the next number for it; readers see one or the other. Returns its path.

    Numbers are claimed by making a file that must not be there yet, so writers at the same time get different ones and no clock
    decides; the greatest is current. Of the older versions the last keep - 1 stay, for readers that began with them.
    """
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex}"
    place = f"{folder}/{safe_name(name)}"
    df.write.parquet(f"{place}/{version}")
    number = max((n for n, _ in _versions(spark, folder, name)), default=0) + 1
    while not claimed(spark, f"{place}/CURRENT/{number:012d}.claim"):
        number += 1
    claimed(spark, f"{place}/CURRENT/{number:012d}={version}")
    for old, path in _versions(spark, folder, name)[:-keep]:
        delete_folder(spark, f"{place}/CURRENT/{old:012d}={path}")
        delete_folder(spark, f"{place}/{path}")
    return f"{place}/{version}"


def build_marts(marts: dict[str, DataFrame], folder: str) -> list[str]:
    """Writes the tables in their order, each as a new version; a bad name stops before anything is written. Returns their paths."""
    for name in marts:
        safe_name(name)
    return [overwrite_table(df, folder, name) for name, df in marts.items()]


def current(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The version of a table with the greatest number."""
    versions = _versions(spark, folder, name)
    if not versions:
        raise ValueError(f"no version of {name!r} in {folder}")
    return spark.read.parquet(f"{folder}/{name}/{versions[-1][1]}")


def publish_tables(spark: SparkSession, names: list[str], gold: str, prod: str) -> list[str]:
    """Every gold table becomes the current version in prod; a bad name stops before anything is written."""
    for name in names:
        safe_name(name)
    return [overwrite_table(current(spark, gold, name), prod, name) for name in names]


_VERSION = "{name}__v{number:08d}_{mark}"


def _published(spark: SparkSession, database: str, name: str) -> list[str]:
    """A name's version tables in a database, oldest first."""
    made = re.compile(rf"^{name}__v\d{{8}}_[0-9a-f]{{32}}$")
    return sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect() if made.match(r.tableName))


def publish_catalog(tables: dict[str, DataFrame], database: str, keep: int = 1) -> dict[str, str]:
    """Publishes the tables under their names in a database of the catalog; returns the version table behind each.

    A name is a view over one version table. All versions are written before any name is switched, so that a failure leaves the old state;
    switching replaces the view's definition, which is one change in the catalog. Views over the name are bound by name: they stay and
    show the new rows. The greatest version wins, whoever wrote it, so of two publishers at once neither shows parts of both nor brings
    back the older; superseded versions but the last keep - 1 are dropped after the switch. A bad name stops before anything is
    written, and so does a name that a base table has.
    """
    spark, made = next(iter(tables.values())).sparkSession, {}
    for name in [database, *tables]:
        safe_name(name)
    for name in tables:
        if spark.catalog.tableExists(f"{database}.{name}") and spark.catalog.getTable(f"{database}.{name}").tableType != "VIEW":
            raise ValueError(f"{database}.{name} is a table")
    for name, df in tables.items():
        last = max((int(v.rsplit("__v", 1)[1][:8]) for v in _published(spark, database, name)), default=0)
        made[name] = _VERSION.format(name=name, number=last + 1, mark=uuid.uuid4().hex)
        df.write.saveAsTable(f"{database}.{made[name]}")
    for name in tables:
        newest = _published(spark, database, name)[-1]
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {database}.{newest}")
        for old in _published(spark, database, name):
            if old < newest and old not in _published(spark, database, name)[-keep:]:
                spark.sql(f"DROP TABLE IF EXISTS {database}.{old}")
    return made


def snapshot_status(source: DataFrame, store: DataFrame, day: datetime.date) -> DataFrame:
    """What to do with a day's snapshot, by counts: skip (whole), redo (partial) or new."""
    n = source.agg(F.count("*").alias("source_rows"), F.lit(1).alias("one"))
    stored = store.filter(F.col("snapshot_date") == F.lit(day)).agg(F.count("*").alias("stored_rows"), F.lit(1).alias("one"))
    action = F.when((F.col("stored_rows") == F.col("source_rows")) & (F.col("stored_rows") > 0), "skip").when(F.col("stored_rows") > 0, "redo").otherwise("new")
    return n.join(stored, "one").select("source_rows", "stored_rows", action.alias("action"))


def snapshot_append(source: DataFrame, folder: str, day: datetime.date) -> str:
    """Adds the day's snapshot unless it is there; a partial one is replaced as a whole partition."""
    spark = source.sparkSession
    try:
        store = spark.read.parquet(folder)
    except Exception as error:  # no snapshot yet
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        store = source.limit(0).withColumn("snapshot_date", F.lit(day))
    action = snapshot_status(source, store, day).first().action
    if action != "skip":
        source.withColumn("snapshot_date", F.lit(day)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(folder)
    return action


def run_audit(spark: SparkSession, run_id: str, name: str, rows: int, at: datetime.datetime, folder: str) -> None:
    """Appends what a run wrote: run_uuid, file_name, n_rows, extracted_at."""
    spark.createDataFrame([(run_id, name, rows, at)], "run_uuid string, file_name string, n_rows long, extracted_at timestamp").write.mode("append").parquet(folder)


def csv_safe(df: DataFrame) -> DataFrame:
    """Text that a spreadsheet would take as a formula gets a ' before it."""
    return df.withColumns({c: F.when(F.col(c).rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), F.col(c))).otherwise(F.col(c)) for c, kind in df.dtypes if kind == "string"})


def csv_export(df: DataFrame, folder: str, order: Sequence[str] | None = None) -> None:
    """Guarded CSV with a header in each file; with an order (see ``ordering``), the files in the order of their names hold the rows in it."""
    rows = csv_safe(df) if order is None else csv_safe(in_order(df, order))
    rows.write.mode("overwrite").option("header", "true").csv(folder)


def report_exports(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One directory for each report, sorted where ``ordering.ORDERS`` has its name."""
    for name, df in tables.items():
        csv_export(df, f"{folder}/{safe_name(name)}", ORDERS.get(name))
    return {name: f"{folder}/{name}" for name in tables}
