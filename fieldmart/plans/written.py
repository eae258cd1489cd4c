"""Queries that write what they derive into a new shared folder and read it again: landing, ledger, versions, publishing, exports."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.operators import clean, marts
from fieldmart.session import shared_folder, single_file, stored, table
from fieldmart.sources import demo, files, ingest, publish

RUN_AT = datetime.datetime(2001, 6, 30, 12, 0, tzinfo=datetime.UTC)
COLUMNS = ("row_id", "country", "tabletnum", "respondants_age", "dob", "remarks")


def _lines(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """label, at, value: a header and a line of text for each row of every tablet; lines of two tablets have a field too many now and then."""
    cells = {"respondants_age": F.when((F.col("tabletnum") % 4 == 2) & (F.col("row_id") % 50 == 0), "unknown").otherwise(F.col("respondants_age"))}
    text = F.concat_ws(",", *[F.coalesce(cells.get(c, F.col(c)).cast("string"), F.lit("")) for c in columns])
    bad = F.when(F.col("tabletnum").isin("7", "23") & (F.col("row_id") % 5 == 0), ",extra").otherwise("")
    label = F.concat(F.lit("Tablet"), "tabletnum").alias("label")
    head = rows.select(label, F.lit(-1).cast("long").alias("at"), F.lit(",".join(columns)).alias("value")).distinct()
    return head.unionByName(rows.select(label, F.col("row_id").cast("long").alias("at"), F.concat(text, bad).alias("value")))


def folder_of_files(spark: SparkSession, sf_dir: str) -> str:
    """A file for each tablet (label=Tablet<n>): the visits as text; every fourth tablet has older forms without two of the columns."""
    rows, folder = demo.visits(spark, sf_dir), shared_folder(spark, "files")
    old = F.col("tabletnum") % 4 == 1
    lines = _lines(rows.filter(~old), COLUMNS).unionByName(_lines(rows.filter(old), COLUMNS[:4]))
    ordered = lines.repartition("label").sortWithinPartitions("label", "at").select("label", "value")
    # names as of CSV files
    ordered.write.partitionBy("label").option("compression", "none").text(folder)
    return folder


def _label(column: str = "file_path") -> Column:
    return F.regexp_extract(column, "label=(Tablet[0-9]+)", 1).alias("label")


def _landing(f: Callable[[files.Landing], DataFrame]):
    return lambda spark, d: f(files.land(spark, folder_of_files(spark, d), "*.txt"))


def _isolated_rows(landing: files.Landing) -> DataFrame:
    return landing.table(COLUMNS).select(_label(), *COLUMNS)


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = ingest.file_manifest(spark, folder_of_files(spark, sf_dir), "*.txt")
    return manifest.groupBy(_label()).agg(F.count("*").alias("n_files"), F.min(F.col("length") > 0).alias("filled"), F.min(F.col("last_modified").isNotNull()).alias("dated"))


def _text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visits as CSV with a header, read as text alone."""
    folder = shared_folder(spark, "scan")
    demo.visits(spark, sf_dir).select(*COLUMNS).write.option("header", "true").csv(folder)
    return ingest.scan_text_table(spark, folder)


def _provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tablets whose number begins with 1 lie in a place of their own, all others in that of the folder."""
    folder = folder_of_files(spark, sf_dir)
    rows = files.land(spark, folder, "*.txt").table(["row_id"]).withColumn("file_path", ingest.bare_path("file_path"))
    root = f"/{folder.split(':', 1)[-1].lstrip('/')}"
    places = spark.createDataFrame([(f"{root}/", "uganda", "all"), (f"{root}/label=Tablet1", "kenya", "first")], "prefix string, country string, community string")
    out = ingest.add_provenance(rows, places, "run-1", RUN_AT)
    return out.select("row_id", _label(), "country", "community", "run_uuid", "extracted_at", F.col("file_name").startswith("part-").alias("named"))


def _places(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("file", "uganda", "all"), ("/", "uganda", "all")], "prefix string, country string, community string")


def _committed(spark: SparkSession, table_: str, ledger: str) -> DataFrame:
    return ingest.committed(spark, table_, ledger).groupBy(_label()).agg(F.count("*").alias("n_rows"), F.count_distinct("row_id").alias("n_ids"))


def _appended_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run commits some files, one dies between data and ledger, one loads what is left, one finds nothing new."""
    folder, table_, ledger = folder_of_files(spark, sf_dir), shared_folder(spark, "bronze"), shared_folder(spark, "ledger")
    ingest.load_new_files(spark, f"{folder}/label=Tablet1*", _places(spark), table_, ledger, "run-a", RUN_AT, "*.txt")
    lost = files.land(spark, f"{folder}/label=Tablet2*", "*.txt").table()
    lost.withColumn("run_uuid", F.lit("run-b")).write.parquet(f"{table_}/run-b")
    for run in ("run-c", "run-d"):
        ingest.load_new_files(spark, folder, _places(spark), table_, ledger, run, RUN_AT, "*.txt")
    return _committed(spark, table_, ledger)


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same folder as a stream, twice; the second finds nothing new."""
    folder, base = folder_of_files(spark, sf_dir), shared_folder(spark, "stream")
    for _ in range(2):
        ingest.load_stream(spark, folder, _places(spark), f"{base}/table", f"{base}/ledger", f"{base}/checkpoint", "*.txt")
    return _committed(spark, f"{base}/table", f"{base}/ledger")


def _overwritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, rows = shared_folder(spark, "gold"), demo.visits(spark, sf_dir).select("row_id", "country")
    for kept in ("row_id % 2 = 0", "row_id % 3 = 0", "row_id % 5 = 0"):
        publish.overwrite_table(rows.filter(kept), folder, "baseline")
    return publish.current(spark, folder, "baseline")


def _marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every mart, as written; and of the audit of the run."""
    folder = shared_folder(spark, "marts")
    # stored once, as each mart would derive it again
    tables = marts.all_marts(stored(clean.silver(demo.landed(spark, sf_dir)), "silver"))
    publish.build_marts(tables, folder)
    for name in tables:
        publish.run_audit(spark, "run-1", name, publish.current(spark, folder, name).count(), RUN_AT, f"{folder}/audit")
    counted = [publish.current(spark, folder, name).agg(F.lit(name).alias("file_name"), F.count("*").alias("n")) for name in tables]
    return spark.read.parquet(f"{folder}/audit").join(ingest.union_by_name(counted), "file_name")


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a view over a published name shows after the name was published anew."""
    folder = shared_folder(spark, "prod")
    database = "prod_" + folder.rsplit("-", 1)[-1]
    rows = demo.visits(spark, sf_dir).select("row_id", "country", "consent")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    publish.publish_catalog({"baseline": rows.filter("row_id % 2 = 0")}, database)
    spark.sql(f"CREATE VIEW {database}.by_country AS SELECT country, count(*) AS n, count_if(consent = '1') AS consented FROM {database}.baseline GROUP BY country")
    publish.publish_catalog({"baseline": rows}, database)
    versions = spark.sql(f"SHOW TABLES IN {database}").filter("startswith(tableName, 'baseline__v')").count()
    return spark.table(f"{database}.by_country").withColumn("n_versions", F.lit(versions))


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days, the second at first by half; then again."""
    store, rows = shared_folder(spark, "store"), demo.visits(spark, sf_dir).select("row_id", "country")
    done = []
    for day, part in ((0, rows), (1, rows.filter("row_id % 2 = 0")), (1, rows), (1, rows)):
        done.append(publish.snapshot_append(part, store, demo.AS_OF + datetime.timedelta(days=day)))
    counts = spark.read.parquet(store).groupBy("snapshot_date").agg(F.count("*").alias("n"))
    return counts.withColumn("actions", F.lit(" ".join(done)))


def _template_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets of two languages, a file each."""
    folder, k = shared_folder(spark, "templates"), F.col("p_partkey")
    sheet = table(spark, sf_dir, "part").select(F.concat(F.lit(" arm  "), k.cast("string")).alias("Arm name"), F.concat(F.lit("  a   b "), "p_name").alias("Wk 8 SMS"), F.when(k % 3 != 0, F.concat("p_name", F.lit(" [date] "))).alias("Wk 11 SMS"))
    for language, kept in (("English", k % 2 == 0), ("Luganda", k % 5 == 0)):
        single_file(sheet.filter(kept), f"{folder}/{language}.csv")
    return ingest.templates_long(files.template_sheets(spark, folder))


QUERIES = {
    "file_manifest": _manifest,
    "text_scan": _text_scan,
    "landed_files": _landing(lambda x: x.files.select(_label(), "n_rows", F.col("error").isNull().alias("loaded"))),
    "isolated_rows": _landing(_isolated_rows),
    "isolated_failures": _landing(lambda x: x.failures().select(_label())),
    "drifted_column_types": _landing(lambda x: x.column_types()),
    "drifted_missing_columns": _landing(lambda x: ingest.schema_missing_columns(x.column_types())),
    "drifted_type_conflicts": _landing(lambda x: ingest.schema_type_conflicts(x.column_types())),
    "provenance": _provenance,
    "append_exactly_once": _appended_once,
    "append_streamed": _streamed,
    "overwrite_current": _overwritten,
    "marts_with_audit": _marts,
    "publish_views": _published,
    "snapshot_append": _snapshots,
    "template_folder": _template_folder,
}
