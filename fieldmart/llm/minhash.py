"""Near-duplicates by bottom-k sketches of one hash function.

A document's set of shingles is sketched by its KEPT least hash values; a smaller set is its own sketch. Documents with equal
sets form one class. The retained values are indexed by inverted lists, in one global order with those that many classes retain last:
two sketches with as many values in common as a link needs have one among the first of either (a prefix), so only prefixes are
listed. What the lists of two classes have in common is estimated from the union's own sketch: the least KEPT values of both together, of which the
share that both retain estimates their similarity. Pairs that pass are confirmed by their full sets.

A link needs NEEDED values of a full union sketch in common; a pair that reaches the threshold has fewer once in 10^9 times. Where both
sets are their own sketches nothing is estimated, and sizes alone say how many values they must share.

Lists of many near copies stay linear: each list first meets only one class, the purest (whose listed value comes first in its own order: of
near copies, the original). Links are closed to components; lists whose classes all are in one component are done. The classes of the others are listed
anew by their whole sets, counted among themselves: there a link leaves out no more than its share of a set, where a sketch must allow for chance, so that sets
which have more than that to themselves meet nobody. In these lists the purest classes leave, and more meet the list each round. Two classes whose first shared value leaves too few behind it can't link and don't meet, and
what can't link with any size in its list leaves it. Nothing is capped: rounds end when no list is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_slots, slot_bitmap, stored
from .components import components
from .text import SPACED, U, chunks, mixed, shingle_sets

WORDS = 3
#: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Values of a sketch.
KEPT = 256
#: The global order goes by how many classes retain a value: less than the first of these, less than the second, and so on; then by hash. A bitmap tells
#: for each of them; values that fall into one slot of it count as retained by as many, which moves them in the order for all.
LEVELS = (2, 4, 16, 64, 512)
MISSED = 1e-9


@cache
def needed(kept: int = KEPT) -> int:
    """The most values of a full union sketch that a pair at the threshold has in common but for MISSED of cases."""
    p, below = PERCENT / 100, 0.0
    for x in range(kept + 1):
        below += comb(kept, x) * p**x * (1 - p) ** (kept - x)
        if below > MISSED:
            return x
    return kept


def least_shared(n: np.ndarray, whole: bool = False) -> np.ndarray:
    """Of the sketch of a set of n shingles, or of the whole set, how many values a partner at the threshold shares at least."""
    own = -(-PERCENT * n // 100)
    if whole:
        return own
    return np.where(100 * n > PERCENT * KEPT, np.minimum(own, needed()), own)


def _keys(values: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """128 bits of each set, as two longs."""
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mixed(values ^ U(salt)), out=total[1:])
        out.append((total[begin[1:]] - total[begin[:-1]]).view(np.int64))
    return out


def _sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """lo, hi, the sorted shingle hashes of documents lo..hi-1 end to end, where each begins."""
    for chunk in chunks(column):
        words = chunk.words(SPACED)
        yield chunk.lo, chunk.hi, *shingle_sets(words.hashes(), words.first, WORDS)


def _heads(begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first length[i] values of each list, and the bounds of the lists of those."""
    bounds = np.concatenate([[0], np.cumsum(length)])
    return np.arange(bounds[-1]) + np.repeat(begin[:-1] - bounds[:-1], length), bounds


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n, k1, k2 (of the set) and sketch of each document; of equal sets in a batch the first has it, the others none."""
    names = ["doc_id", "n", "k1", "k2", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple[int, int]] = set()
            for lo, hi, got, begin in _sets(batch.column("text")):
                n, (k1, k2) = np.diff(begin), _keys(got, begin)
                new = np.zeros(len(n), bool)
                for i, key in enumerate(zip(k1.tolist(), k2.tolist(), strict=True)):
                    new[i] = key not in seen
                    seen.add(key)
                at, bounds = _heads(begin, np.where(new, np.minimum(n, KEPT), 0))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(got[at].view(np.int64)))
                yield pa.record_batch([batch.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(k1), pa.array(k2), lists], names)

    return docs.mapInArrow(run, "doc_id long, n long, k1 long, k2 long, sketch array<long>")


def full_sets(docs: DataFrame, slots: np.ndarray) -> DataFrame:
    """k1, k2, grams of the sets whose slot is set, a class once for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple[int, int]] = set()
            for _, _, got, begin in _sets(batch.column("text")):
                k1, k2 = _keys(got, begin)
                chosen = []
                for i in np.flatnonzero(in_slots(slots, k1)).tolist():
                    if (key := (int(k1[i]), int(k2[i]))) not in seen:
                        seen.add(key)
                        chosen.append(i)
                if chosen:
                    size = np.diff(begin)[chosen]
                    bounds = np.concatenate([[0], np.cumsum(size)])
                    at = np.arange(bounds[-1]) + np.repeat(begin[chosen] - bounds[:-1], size)
                    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(got[at].view(np.int64)))
                    yield pa.record_batch([pa.array(k1[chosen]), pa.array(k2[chosen]), lists], ["k1", "k2", "grams"])

    return docs.mapInArrow(run, "k1 long, k2 long, grams array<long>")


def _may_link(na: Column, nb: Column) -> Column:
    return 100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)


def estimated(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b), with na and nb, whose union sketch lets them reach the threshold."""
    side = lambda x: known.select(F.col("c").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(_may_link(F.col("na"), F.col("nb")))
    whole = F.greatest("na", "nb") <= KEPT
    union = F.slice(F.array_sort(F.array_union(F.transform("sa", _unsigned), F.transform("sb", _unsigned))), 1, KEPT)
    shared = F.array_intersect("sa", "sb")
    in_union = F.size(F.array_intersect(F.transform(shared, _unsigned), union))
    enough = F.when(whole, (100 + PERCENT) * F.size(shared) >= PERCENT * (F.col("na") + F.col("nb"))).otherwise(in_union >= needed())
    return both.filter(enough).select("a", "b", "na", "nb")


def _unsigned(value: Column) -> Column:
    """A long in the order of its unsigned bits, as hashes are sorted."""
    return value.bitwiseXOR(F.lit(-(1 << 63)))


def sets_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """c, grams of the given classes (k1, k2), stored: one pass over the texts."""
    ends = stored(classes, "ends")
    sets = full_sets(docs, slot_bitmap(ends.select("k1"))).join(ends, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return stored(sets.select(F.struct("k1", "k2").alias("c"), "grams"), "full")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, na, nb) whose full sets reach the threshold."""
    both = pairs.join(sets.select(F.col("c").alias("a"), F.col("grams").alias("ga")), "a").join(sets.select(F.col("c").alias("b"), F.col("grams").alias("gb")), "b")
    return both.filter((100 + PERCENT) * F.size(F.array_intersect("ga", "gb")) >= PERCENT * (F.col("na") + F.col("nb"))).select("a", "b")


def _several(lists: DataFrame, of: str) -> DataFrame:
    """The rows of lists that hold more than one ``of`` (k1, k2)."""
    ends = [f(f"{of}.{k}").alias(f"{f.__name__}{k}") for k in ("k1", "k2") for f in (F.min, F.max)]
    mixed_ = lists.groupBy("list").agg(*ends).filter("mink1 != maxk1 or mink2 != maxk2").select("list")
    return lists.join(mixed_, "list")


def inverted_lists(classes: DataFrame, whole: bool = False) -> DataFrame:
    """list, c, n, rest, own: of each sketch, in the global order, the first values, so far as a link needs them, with how many there are from each on; lists of several classes only.

    A class that several batches have counts for each of them, which moves its values in the order for all. whole: the sketches are whole sets.
    """
    counts = classes.select(F.explode("sketch").alias("value")).groupBy("value").count().filter(F.col("count") >= LEVELS[0])
    counts = stored(counts, "counts")
    bitmaps = classes.sparkSession.sparkContext.broadcast([slot_bitmap(counts.filter(F.col("count") >= least).select("value")) for least in LEVELS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, n = batch.column("sketch"), batch.column("n").to_numpy()
            values, begin = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
            begin = begin - begin[0]
            level = sum((in_slots(b, values).astype(np.int64) for b in bitmaps.value), np.zeros(len(values), np.int64))
            order = np.lexsort((values.view(np.uint64), level, np.repeat(np.arange(len(n)), np.diff(begin))))
            prefix = np.diff(begin) - least_shared(n, whole) + 1
            at, bounds = _heads(begin, prefix)
            rest = np.repeat(np.diff(begin) + bounds[:-1], prefix) - np.arange(len(at))
            kept = level[order[at]] > 0
            own = pa.array(np.repeat(np.arange(len(n)), prefix)[kept])
            yield pa.record_batch([pa.array(values[order[at][kept]]), batch.column("k1").take(own), batch.column("k2").take(own), batch.column("n").take(own), pa.array(rest[kept].astype(np.int32))], ["list", "k1", "k2", "n", "rest"])

    rows = classes.mapInArrow(run, "list long, k1 long, k2 long, n long, rest int").select("list", F.struct("k1", "k2").alias("c"), "n", "rest").distinct()
    return stored(_several(rows, "c").withColumn("own", F.col("c")), "lists")


def _to_share(na: Column, nb: Column, whole: bool) -> Column:
    """The least number of retained values, or of all, that two classes of these sizes share if they link."""
    exact = F.ceil(PERCENT * (na + nb) / (100 + PERCENT))
    return exact if whole else F.when(F.greatest(na, nb) <= KEPT, exact).otherwise(F.lit(needed()))


def _placed(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """The lists with the component of each class, stored."""
    placed = lists.join(roots.withColumnRenamed("node", "c"), "c", "left").select("list", "c", "n", "rest", F.coalesce("root", "c").alias("own"))
    return stored(placed, "placed")


def _promising(lists: DataFrame, whole: bool) -> DataFrame:
    """The rows of lists that some partner of their list's sizes may link with from here on, in lists that hold several components."""
    least = lists.groupBy("list").agg(F.min("n").alias("fewest"))
    smallest = F.greatest("fewest", F.ceil(PERCENT * F.col("n") / 100))
    return _several(lists.join(least, "list").filter(_to_share(F.col("n"), smallest, whole) <= F.col("rest")).drop("fewest"), "own")


def join(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n, k1, k2) and the root of every class that is linked to another (k1, k2, root)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stored(sketches(texts), "sketches")
    rows = found.select("doc_id", "n", "k1", "k2")
    classes = found.filter(F.size("sketch") > 0).select("k1", "k2", "n", "sketch")
    waiting, roots, sets, turn = inverted_lists(classes), None, None, 0
    waiting = stored(_promising(waiting, False), "promising")
    listed = waiting.select("c.k1", "c.k2").distinct()
    known = stored(classes.join(listed, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select(F.struct("k1", "k2").alias("c"), "n", "sketch"), "known")
    while waiting.head(1):
        whole = turn > 0
        # in the first round one class meets each list, then four times as many each time: those that are left in a list are few or much alike
        waiting = waiting.withColumn("share", F.pmod(F.xxhash64("c"), F.lit(4 ** min(turn, 15))))
        purest = F.max(F.struct((F.col("rest") - (F.col("n") if whole else F.least(F.col("n"), F.lit(KEPT)))).alias("place"), F.col("c").alias("pc"), F.col("n").alias("pn"), F.col("own").alias("pown"), F.col("rest").alias("prest"))).alias("p")
        first = stored(waiting.groupBy("list", "share").agg(purest).select("list", "share", "p.pc", "p.pn", "p.pown", "p.prest"), "purest")
        meets = _may_link(F.col("n"), F.col("pn")) & (F.least("rest", "prest") >= _to_share(F.col("n"), F.col("pn"), whole)) & (F.col("own") != F.col("pown"))
        pairs = waiting.join(first.drop("share"), "list").filter(meets)
        pairs = pairs.select(F.least("c", "pc").alias("a"), F.greatest("c", "pc").alias("b")).distinct()
        close = stored(estimated(pairs, known), "close")
        if not whole:
            sets = sets_of(texts, close.select("a.k1", "a.k2").unionByName(close.select("b.k1", "b.k2")).distinct())
        new = stored(confirmed(close, sets), "links")
        if roots is None:
            roots = stored(components(new), "roots")
        elif new.head(1):
            roots = stored(components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(new)), "roots")
        left = waiting.drop("own").join(first.select("list", "share", "pc"), ["list", "share"]).filter("c != pc")
        waiting, turn = stored(_promising(_placed(left, roots), whole), "left"), turn + 1
        if not whole and waiting.head(1):
            # whoever may still link is in one of these lists; later rounds take their pairs from these classes
            sets = sets_of(texts, waiting.select("c.k1", "c.k2").distinct())
            lists = inverted_lists(sets.select("c.k1", "c.k2", F.size("grams").cast("long").alias("n"), F.col("grams").alias("sketch")), True)
            waiting = stored(_promising(_placed(lists.drop("own"), roots), True), "left")
    if roots is None:
        return rows, rows.limit(0).select("k1", "k2", F.struct("k1", "k2").alias("root"))
    return rows, roots.select("node.k1", "node.k2", "root")


def clusters(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id (the least doc_id that links reach), kept (whether it is that one).

    Null and empty texts and texts without words have no shingles, link with nothing and are kept; a shorter text than three
    words is one shingle. Rows with equal sets are linked, repeated ids too: all rows of the least id are kept. A row without
    doc_id belongs to the component that its text gives it, and isn't kept; where no row of a component has an id, it is null and
    all are kept. Texts are read whole. Further columns are ignored; an empty table gives no rows.
    """
    rows, roots = join(docs)
    classes = rows.filter("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")).join(roots, ["k1", "k2"], "left")
    least = classes.filter("root is not null").groupBy("root").agg(F.min("rep").alias("least"))
    placed = classes.join(least, "root", "left").select("k1", "k2", F.coalesce("least", "rep").alias("component_id"))
    # classes without an id take part in their component too
    bare = roots.join(least, "root").select("k1", "k2", F.col("least").alias("bare_id")).join(placed, ["k1", "k2"], "left_anti")
    placed = placed.unionByName(bare.withColumnRenamed("bare_id", "component_id"))
    out = rows.join(placed, ["k1", "k2"], "left").withColumn("component_id", F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), F.col("doc_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))
