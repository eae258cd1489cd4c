"""Column expressions and folders that the operators share."""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def alnum_words(text: Column) -> Column:
    """Lower-cased runs of digits, a-z and non-ASCII characters; null has none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_ALNUM), lambda w: w != "")


def space_words(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def n_space_words(text: Column) -> Column:
    """Their number, without building the array of words twice."""
    return F.size(space_words(text)).cast("long")


def id_text(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def crc_mod(doc_id: Column, modulus: int) -> Column:
    return F.crc32(id_text(doc_id).cast("binary")) % modulus


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which every executor sees.

    Where that is unset, as in tests, the checkpoint folder of this session is set to a temporary one first, but only in
    local mode, where there is one machine; on a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current is None:
            if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
            current = spark.sparkContext.getCheckpointDir()
        root = current
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again, which cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Collects the driver's garbage after a round.

    Only then does Spark delete the shuffle files and broadcasts of what nobody holds any more, and the heap shrink again,
    which many small jobs would otherwise let grow to its bound.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Bytes of a batch of rows that goes to a Python worker at most, one row if it is longer.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Batches for Python of this session from now on end at BATCH_BYTES, unless it has a bound of its own.

    By rows alone a batch of long texts has tens of MB, which every copy in the executor and in each worker multiplies.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.conf.get(name, None):
        spark.conf.set(name, BATCH_BYTES)


def documents_only(docs: DataFrame) -> DataFrame:
    """doc_id, text and source (null where absent) of a table with any further columns."""
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), source.alias("source"))


SLOTS = 1 << 26


def slot_bitmap(slots: DataFrame) -> np.ndarray:
    """8 MB with a bit for each of SLOTS slots, set for the longs in the only column, which Spark makes in pieces of 4 KB.

    Tasks use it to leave out most rows that no later join can want; the join itself stays exact.
    """
    slot = F.col(slots.columns[0]).bitwiseAND(F.lit(SLOTS - 1)) + 1
    rows = slots.groupBy(F.bitmap_bucket_number(slot).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    out = np.zeros(SLOTS // 8, np.uint8)
    for r in rows:
        out[(r.piece - 1) * 4096 : r.piece * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


#: Bits of one row of a bitmap of SLOTS bits, as Spark's bitmap functions make them.
PIECE_BITS = 1 << 15


def slot_pieces(keys: DataFrame) -> DataFrame:
    """piece, bits: the same bitmap as rows of 4 KB, SLOTS / PIECE_BITS of them at most, so that it may be broadcast."""
    slot = F.col(keys.columns[0]).bitwiseAND(F.lit(SLOTS - 1)) + 1
    return keys.groupBy(F.bitmap_bucket_number(slot).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))


def maybe_in(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of df whose key, a long, may be among the longs in the only column of keys; no row that is gets lost.

    Costs no shuffle of df, whatever its rows hold.
    """
    slot = F.col(key).bitwiseAND(F.lit(SLOTS - 1))
    pieces = slot_pieces(keys).select(F.col("piece").alias("_piece"), F.col("bits").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", ((slot % PIECE_BITS) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = df.withColumn("_slot", slot).join(F.broadcast(pieces), F.floor(F.col("_slot") / PIECE_BITS) + 1 == F.col("_piece"))  # 8 MB at most
    return joined.filter(F.call_function("shiftright", byte, (slot % 8).cast("int")).bitwiseAND(F.lit(1)) == 1).drop("_piece", "_bits", "_slot")


def in_slots(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & (SLOTS - 1)
    return ((bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool)
