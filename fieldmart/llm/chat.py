"""Cumulative-snapshot collapse of logged conversations and their rendering, in DataFrame functions only.

A log that is written after every turn holds each conversation many times, each time with more turns. A hash of every
prefix of turns is kept: the exclusive or of one hash for each position, role and text, so that it can be
accumulated over parts of a conversation in different tasks. A conversation whose whole hash is the hash of a shorter
prefix of another one is dropped by an anti-join; of equal ones the least id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Turn numbers of one row of the result, whose key is (conv_id, part).
PART = 1024


def _turns(conversations: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    return rows.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())


def positions(conversations: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, turn, role, text, part, at (place in the conversation from 1), two hashes of the prefix that ends here.

    Rows that repeat as a whole count once. Turns are cut into parts by number; places and hashes are
    accumulated within parts, then over the parts of a conversation.
    """
    rows = _turns(conversations).distinct().withColumn("part", F.floor(F.col("turn") / part))
    rows = rows.withColumn("within", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")))
    sizes = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    rows = rows.join(sizes, ["conv_id", "part"]).withColumn("at", F.col("within") + F.col("before")).drop("within", "before")
    own = lambda k: F.xxhash64(F.lit(k), F.col("at"), F.col("role"), F.col("text"))
    rows = rows.withColumns({"x": own(1), "y": own(2)})
    parts = rows.groupBy("conv_id", "part").agg(F.bit_xor("x").alias("px"), F.bit_xor("y").alias("py"))
    parts = parts.select("conv_id", "part", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(c) for c in ("px", "py")])
    upto = Window.partitionBy("conv_id", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(parts, ["conv_id", "part"])
    for own_hash, base, name in (("x", "px", "hx"), ("y", "py", "hy")):
        rows = rows.withColumn(name, F.bit_xor(own_hash).over(upto).bitwiseXOR(F.col(base)))
    return rows.drop("x", "y", "px", "py")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def maximal(at: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of the conversations that no other one extends; the least id of equal ones."""
    last = at.groupBy("conv_id").agg(F.max("at").alias("n_turns"))
    ends = at.select("conv_id", "at", "hx", "hy").join(last, "conv_id")
    whole = ends.filter("at = n_turns").groupBy("at", "hx", "hy").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    prefixes = ends.filter("at < n_turns").select("at", "hx", "hy").distinct()
    return whole.join(prefixes, ["at", "hx", "hy"], "left_anti").select("conv_id", F.col("at").alias("n_turns"), "n_copies")


def collapse(conversations: DataFrame, part: int = PART) -> DataFrame:
    """Maximal conversations, rendered: conv_id, part, n_turns, n_copies, text.

    A conversation of usual length is one row; a longer one has a row for every ``part`` turn numbers, so that no
    conversation is gathered whole. Rows without conv_id or turn belong to no conversation; a null role or text
    counts as empty; turns of the same number come by role and text; rows that repeat as a whole count once; gaps between
    numbers don't count. Of equal conversations the least conv_id stands for all. A text may hold the marks that rendering
    puts around turns: they aren't escaped, so count turns by n_turns. An empty table gives none. Further columns are ignored.
    """
    at = stored(positions(conversations, part), "turns")
    rows = at.join(maximal(at), "conv_id")
    turns = F.sort_array(F.collect_list(F.struct("at", "role", "text")))
    text = F.array_join(F.transform("turns", lambda t: rendered(t["role"], t["text"])), "")
    return rows.groupBy("conv_id", "part", "n_turns", "n_copies").agg(turns.alias("turns")).select("conv_id", "part", "n_turns", "n_copies", text.alias("text"))
