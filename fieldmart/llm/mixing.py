"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Every document draws the key -ln(u) / weight, u from a hash of its id; the least keys come first. A source whose target
is more than its size takes whole epochs first and then the fraction that is left, in key order. Prefix sums are
taken in two levels, over ranges of keys and then within each range, so that a source of any size spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, n_space_words

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_EPOCHS = 2.0
RANGES, SCALES = 4096, 8
SEED = "mix"


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """In (0, 1), from 48 bits of the MD5 of seed and id: the same in every run and engine."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), id_text(doc_id)).cast("binary")), 1, 12), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 48)


def quality(text: Column) -> Column:
    """1 for a text without symbols, less the more of its characters are symbols; in (0, 1]."""
    text = F.coalesce(text, F.lit(""))
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return 1.0 / (1.0 + 20.0 * symbols / F.greatest(F.length(text), F.lit(1)))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS) -> DataFrame:
    """source, source_size -> target. One row for each source comes in; the few sources are ranked in one task.

    The budget, share times all sizes, goes by weight; a target stops at most times its source's size and the rest is
    shared again. Filling by the level cap / weight gives the same in one sorted pass: the sources with the lowest
    levels are capped, the others get weight times what is left over the weights that are left.
    """
    by_source = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("place", (F.row_number().over(by_source) - 1) % len(weights))
    ranked = ranked.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("place")))
    ranked = ranked.withColumn("cap", most * F.col("source_size")).withColumn("level", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy(F.lit(0))
    rising = everything.orderBy("level", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumns({
        "budget": F.sum("source_size").over(everything) * share,
        "all_weights": F.sum("weight").over(everything),
        "capped": F.coalesce(F.sum("cap").over(rising), F.lit(0.0)),
        "capped_weights": F.coalesce(F.sum("weight").over(rising), F.lit(0.0)),
    })
    own = (F.col("budget") - F.col("capped")) / (F.col("all_weights") - F.col("capped_weights"))
    ranked = ranked.withColumn("own", F.when(own < F.col("level"), own))
    # the level at the first source that is not capped holds for all that follow
    first = F.min_by("own", F.when(F.col("own").isNotNull(), F.struct("level", F.col("source").isNull().alias("last"), "source"))).over(everything)
    return ranked.select("source", "source_size", F.least("cap", F.coalesce(F.col("weight") * first, F.col("cap"))).alias("target"))


MIXED = ("size", "source_size", "target", "epochs", "taken")


def mix(docs: DataFrame, weight: Column | None = None, ranges: int = RANGES, seed: str = SEED, whole: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, source, size, source_size, target, epochs, taken.

    The document in which a source's target is reached gives its first words only, so that a source meets its target to
    the word. Null and empty texts have size 0 and give nothing; documents of a null source form a source of their own,
    which comes last; equal keys go by id and text. Repeated rows are documents of their own. weight: any column above 0,
    such as a score of quality, in place of ``quality``. An empty table gives none. Further columns are ignored; with whole, all columns
    of docs come, and size to taken beside them, in place of columns of these names.
    """
    text = F.col("text").cast("string")
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), n_space_words(text).alias("size"), F.xxhash64(text).alias("text_key"), (quality(text) if weight is None else weight).alias("w"), *([F.struct(*[c for c in docs.columns if c not in MIXED]).alias("row")] if whole else []))
    base = base.withColumn("key", -F.log(uniform(F.col("doc_id"), seed)) / F.col("w"))
    # rises with the key, and spreads the keys of weights from 1 down to 1 / 2 ** SCALES evenly
    spread = sum((1.0 - F.exp(-F.col("key") / float(1 << i)) for i in range(SCALES + 1)), F.lit(0.0)) / (SCALES + 1)
    base = base.withColumn("range", F.least(F.floor(spread * ranges), F.lit(ranges - 1)).cast("int")).drop("w")
    by_range = base.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    by_range = by_range.withColumn("before", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
    goal = targets(by_range.groupBy("source").agg(F.sum("range_size").alias("source_size")))
    goal = goal.select(F.col("source").alias("s"), "source_size", "target")
    by_range = by_range.join(goal, F.col("source").eqNullSafe(F.col("s"))).select(F.col("source").alias("s"), F.col("range").alias("r"), "before", "source_size", "target")
    joined = base.join(by_range, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    order = Window.partitionBy("s", "r").orderBy("key", "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, 0)
    joined = joined.withColumn("upto", F.col("before") + F.sum("size").over(order))
    goal_words = F.floor(F.col("target"))
    joined = joined.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(goal_words / F.col("source_size"))).otherwise(0))
    left = goal_words - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - (F.col("upto") - F.col("size"))))
    taken = (F.col("epochs") * F.col("size") + part).cast("long")
    return joined.select(*(["row.*"] if whole else ["doc_id", "source"]), "size", "source_size", "target", F.col("epochs").cast("long").alias("epochs"), taken.alias("taken"))
