"""Session and path helpers shared by every job."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("fieldmart")
    builder = builder.config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder under spark.checkpoint.dir, which every machine sees; in local sessions without it, under a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to a new shared folder and read again: its lineage ends there, and lost executors lose nothing."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks_import_here(spark: SparkSession) -> None:
    """Tasks with Python code import this package: from where it lies if that is no installed one."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Names in a folder and when they last changed (seconds); none if it isn't there."""
    place, system = _file_system(spark, path)
    return [(x.getPath().getName(), x.getModificationTime() / 1000) for x in system.listStatus(place)] if system.exists(place) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    place, system = _file_system(spark, path)
    system.delete(place, True)


def claimed(spark: SparkSession, path: str) -> bool:
    """Makes an empty file unless it is there; of several callers one gets True."""
    place, system = _file_system(spark, path)
    try:
        system.create(place, False).close()
    except Exception as error:
        if "AlreadyExists" not in str(error) and "already exists" not in str(error):
            raise
        return False
    return True


def single_file(df: DataFrame, path: str) -> None:
    """Writes a small table as one CSV file of that name; it comes from one task, so it isn't for tables that grow."""
    spark = df.sparkSession
    folder = f"{path}-{uuid.uuid4().hex}"
    df.coalesce(1).write.option("header", "true").csv(folder)
    part = next(n for n, _ in folders(spark, folder) if n.startswith("part-"))
    (source, system), (target, _) = _file_system(spark, f"{folder}/{part}"), _file_system(spark, path)
    system.rename(source, target)
    delete_folder(spark, folder)
