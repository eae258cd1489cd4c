"""Landing text snapshots: manifest, newest per device, all-text scans, provenance, ledger, schema drift."""

from __future__ import annotations

import datetime
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.functions import parse
from fieldmart.session import delete_folder, folders
from fieldmart.sources import files

_SNAPSHOT = r"(?i)(?:^|/)(Tablet\d+)_(\d{4}_\d{2}_\d{2}-\d{2}_\d{2}_\d{2})"
_ARCHIVE = r"(?i)^(Tablet\d+)_(\d{4}_\d{2}_\d{2}-\d{2}_\d{2}_\d{2})\.7z$"
_TIME = "yyyy_MM_dd-HH_mm_ss"


def file_manifest(spark: SparkSession, folder: str, pattern: str = "*.[cC][sS][vV]") -> DataFrame:
    """file_path, last_modified and length of the files below a folder; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.col("path").alias("file_path"), F.col("modificationTime").alias("last_modified"), "length")


def latest_snapshot_per_device(paths: DataFrame, excluded: Sequence[str] = (), suffixes: Sequence[str] = ()) -> DataFrame:
    """device, file_path: the newest snapshot folder of each device, without backups and excluded devices.

    Backups are what lies below DataBackup, and paths that end, in any case of letters, with one of ``suffixes``. Paths
    without a device come, with a null device, only if no device is selected at all.
    """
    path = F.regexp_replace("file_path", r"\\", "/")
    rows = paths.select(path.alias("file_path")).filter(~F.col("file_path").contains("/DataBackup/"))
    for suffix in suffixes:
        rows = rows.filter(~F.lower("file_path").endswith(suffix.lower()))
    rows = rows.withColumns({"device": F.nullif(F.regexp_extract("file_path", _SNAPSHOT, 1), F.lit("")), "taken": F.try_to_timestamp(F.regexp_extract("file_path", _SNAPSHOT, 2), F.lit(_TIME))})
    tagged = rows.filter(F.col("device").isNotNull() & F.col("taken").isNotNull() & ~F.lower("device").isin([x.lower() for x in excluded]))
    newest = tagged.groupBy("device").agg(F.max_by("file_path", F.struct("taken", "file_path")).alias("file_path"))
    none = newest.agg((F.count("*") == 0).alias("none"))  # a single row
    loose = rows.filter("device is null").select("device", "file_path", F.lit(True).alias("none")).join(F.broadcast(none), "none").drop("none")
    return newest.unionByName(loose)


def latest_archive_per_device(names: DataFrame) -> DataFrame:
    """device, archive: the newest of each device; other names are ignored."""
    rows = names.select("archive", F.regexp_extract("archive", _ARCHIVE, 1).alias("device"), F.try_to_timestamp(F.regexp_extract("archive", _ARCHIVE, 2), F.lit(_TIME)).alias("taken"))
    return rows.filter((F.col("device") != "") & F.col("taken").isNotNull()).groupBy("device").agg(F.max_by("archive", F.struct("taken", "archive")).alias("archive"))


def scan_text_table(spark: SparkSession, paths: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """All columns as text, blanks as ''."""
    reader = spark.read.option("header", "true").option("inferSchema", "false")
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    return reader.csv(paths).na.fill("")


def read_many_isolated(spark: SparkSession, paths: list[str], columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of the files that load, as text by the columns' names, with their file_path; and the files (file_path, error) that don't.

    Each file is read once (``files.land``) and loads or fails as a whole. Blanks, and columns that a file lacks, are ''.
    """
    landing = files.land(spark, paths)
    return landing.table(columns).na.fill("", list(columns)), landing.failures().select(bare_path("file_path").alias("file_path"), "error")


def bare_path(column: str) -> Column:
    """A local path without its scheme."""
    return F.regexp_replace(column, "^file:/*", "/")


def add_provenance(df: DataFrame, places: DataFrame, run_id: str, extracted_at) -> DataFrame:
    """df (with file_path) and its file name, run, time, and country and community by the longest path prefix of places.

    Each row stays one row: files are placed first, one row for each, and joined by path. Files that no prefix fits have neither.
    """
    files = df.select("file_path").distinct()
    starts = F.transform(F.sequence(F.lit(1), F.length("file_path")), lambda i: F.substring(F.col("file_path"), F.lit(1), i))
    fits = files.withColumn("prefix", F.explode(starts)).join(places, "prefix")
    kept = F.struct(F.length("prefix").alias("length"), "country", "community")
    fits = fits.groupBy("file_path").agg(F.max(kept).alias("place")).select("file_path", "place.country", "place.community")
    own = df.drop("country", "community")  # what the place says replaces what the file says
    fits = own.join(fits, "file_path", "left").select(*own.columns, "country", "community")
    return fits.withColumns({"file_name": F.element_at(F.split("file_path", "/"), -1), "run_uuid": F.lit(run_id), "extracted_at": F.lit(extracted_at), "_source_db": F.col("file_path")})


def incremental_new_files(manifest: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Files whose path and time no ledger row has as loaded."""
    if ledger is None:
        return manifest
    return manifest.join(ledger.filter("loaded").select("file_path", "last_modified"), ["file_path", "last_modified"], "left_anti")


_RUN = re.compile(r"^[A-Za-z0-9-]+$")


def append_once(rows: DataFrame, entries: DataFrame, table: str, ledger: str, run_id: str) -> None:
    """Adds a run's rows (with file_path) and then its ledger entries (file_path, last_modified, loaded, extracted_at), each into a folder of its own.

    The entries make the rows count: ``committed`` shows nothing of a run that ended between the two. Run again under the same id, what it
    left is replaced; under another, its files are loaded anew, as no ledger has them. A run whose entries are there is done: the same
    id changes nothing then.
    """
    if not _RUN.match(run_id):
        raise ValueError(f"not a run id: {run_id!r}")
    if "_SUCCESS" in {name for name, _ in folders(rows.sparkSession, f"{ledger}/{run_id}")}:
        return
    run = F.lit(run_id).alias("run_uuid")
    rows.drop("run_uuid").select("*", run).write.mode("overwrite").parquet(f"{table}/{run_id}")
    entries.drop("run_uuid").select("*", run).write.mode("overwrite").parquet(f"{ledger}/{run_id}")


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(folder)


def committed_files(spark: SparkSession, ledger: str) -> DataFrame:
    """file_path, last_modified, run_uuid: for each loaded version of a file the first run that committed it."""
    entries = _runs(spark, ledger).filter("loaded").groupBy("file_path", "last_modified").agg(F.min(F.struct("extracted_at", "run_uuid")).alias("first"))
    return entries.select("file_path", "last_modified", "first.run_uuid")


def committed(spark: SparkSession, table: str, ledger: str) -> DataFrame:
    """The rows whose run has committed their file, each file version once though several runs raced for it. Columns that a run lacks are null."""
    files = committed_files(spark, ledger).select("run_uuid", "file_path").distinct()
    return _runs(spark, table).join(files, ["run_uuid", "file_path"], "left_semi")


def remove_uncommitted(spark: SparkSession, table: str, ledger: str, older_than: datetime.timedelta) -> list[str]:
    """Deletes the folders of runs that never committed and haven't changed for so long; returns their ids. Runs under way are younger."""
    done = {r.run_uuid for r in _runs(spark, ledger).select("run_uuid").distinct().collect()}  # a row for each run
    now = datetime.datetime.now(datetime.UTC).timestamp()
    lost = [(name, at) for name, at in folders(spark, table) if name not in done and now - at > older_than.total_seconds()]
    for name, _ in lost:
        delete_folder(spark, f"{table}/{name}")
    return sorted(name for name, _ in lost)


def load_new_files(spark: SparkSession, folder: str, places: DataFrame, table: str, ledger: str, run_id: str, extracted_at: datetime.datetime, pattern: str = "*.[cC][sS][vV]") -> files.Landing:
    """One run over a folder: files that the ledger lacks are read once, placed, and committed together with their entries."""
    found = files.contents(spark, folder, pattern)
    listed = files.listed(found)
    known = _runs(spark, ledger).filter("loaded").select("file_path", "last_modified") if folders(spark, ledger) else None
    if known is not None:
        found = found.join(known.select(F.col("file_path").alias("path"), F.col("last_modified").alias("modificationTime")), ["path", "modificationTime"], "left_anti")
        listed = listed.join(known.select(F.regexp_replace("file_path", "^file:/+", "file:/").alias("file_path")), "file_path", "left_anti")
    landing = files.landing_of(found, None, listed)
    _commit(landing, places, table, ledger, run_id, extracted_at)
    return landing


def _commit(landing: files.Landing, places: DataFrame, table: str, ledger: str, run_id: str, extracted_at: datetime.datetime) -> None:
    rows = add_provenance(landing.table(), places, run_id, extracted_at)
    entries = landing.loaded().select("file_path", "last_modified", F.lit(True).alias("loaded"), F.lit(extracted_at).alias("extracted_at"), "n_rows")
    append_once(rows, entries, table, ledger, run_id)


def load_stream(spark: SparkSession, folder: str, places: DataFrame, table: str, ledger: str, checkpoint: str, pattern: str = "*.[cC][sS][vV]") -> None:
    """The same as a stream that takes what is there and ends: its checkpoint knows the files, and a batch that is repeated after a crash has the same run id."""
    source = spark.readStream.format("binaryFile").schema(files.CONTENT).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)

    def batch(found: DataFrame, number: int) -> None:
        _commit(files.landing_of(found), places, table, ledger, f"batch-{number:08d}", datetime.datetime.now(datetime.UTC))

    source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def align_schema(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns in their order; null where absent, others dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def schema_missing_columns(types: DataFrame) -> DataFrame:
    """file, n_columns, missing: columns of the widest file (the first by name) that a file lacks."""
    sizes = types.groupBy("file").agg(F.collect_set("column").alias("columns")).withColumn("n_columns", F.size("columns").cast("long"))
    widest = sizes.agg(F.max_by("columns", F.struct("n_columns", F.transform(F.array_sort("columns"), lambda c: c))).alias("all"), F.lit(1).alias("one"))  # a single row
    joined = sizes.withColumn("one", F.lit(1)).join(F.broadcast(widest), "one")
    missing = F.array_sort(F.array_except("all", "columns"))
    return joined.select("file", "n_columns", missing.alias("m")).filter(F.size("m") > 0).select("file", "n_columns", F.array_join("m", ", ").alias("missing"))


def schema_type_conflicts(types: DataFrame) -> DataFrame:
    """column, dtypes of columns with several types; integers beside floats are none."""
    kinds = types.groupBy("column").agg(F.array_sort(F.collect_set("dtype")).alias("d"))
    return kinds.filter((F.size("d") > 1) & (F.size(F.array_except("d", F.array(F.lit("int64"), F.lit("float64")))) > 0)).select("column", F.array_join("d", ", ").alias("dtypes"))


def coerce_types(df: DataFrame, dates: Sequence[str], numbers: Sequence[str] = ()) -> DataFrame:
    """Named columns as timestamps or doubles; bad text is null; absent columns are passed over."""
    return df.withColumns({**{c: parse.stamp(F.col(c)) for c in dates if c in df.columns}, **{c: parse.number(F.col(c)) for c in numbers if c in df.columns}})


def templates_long(sheet: DataFrame, language: str | None = None) -> DataFrame:
    """Wide sheets (arm, week_8, week_11 and language) to rows; blanks are collapsed, blank arms and messages go."""
    rows = sheet if language is None else sheet.withColumn("language", F.lit(language))
    long = rows.unpivot(["arm", "language"], ["week_8", "week_11"], "which", "text")
    text = F.trim(F.regexp_replace("text", r"[ \t]+", " "))
    out = long.select(F.trim("arm").alias("arm"), "language", F.when(F.col("which") == "week_8", 8).otherwise(11).alias("week"), text.alias("message_text")).filter("arm <> '' and message_text <> ''")
    return out.withColumn("has_placeholder", F.col("message_text").rlike(r"\[.*?\]"))
