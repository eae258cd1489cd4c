"""Exact Jaccard join on word n-grams by vertical partitioning, down to components of linked documents.

Documents with equal sets form one class. All n-grams have one global order: by hash, the ones that many documents
share last. The order is cut into fragments. Two sets that reach the threshold must have, from their first shared n-gram
on, at least as many n-grams left as they have to share; so only prefixes are indexed, and in the bucket of an n-gram only
classes meet that have enough left behind it. For the pairs found, the overlap is counted in every fragment separately and
summed. Rounds keep large groups linear without losing a link: first every bucket meets its purest class only (the one with
the fewest rarer n-grams: of near copies, the original), and the links found are closed to components; then, in buckets
whose classes are still in several components, the next one, and so on while that settles most of what is left; at last
all classes of different components meet that still share a bucket. A pair inside a component needs no link more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_slots, slot_bitmap, stored
from .components import components
from .text import SPACED, U, chunks, mixed, shingle_sets

WORDS = 5
#: 100 * intersection >= PERCENT * union.
PERCENT = 75
FRAGMENTS = 16
#: An n-gram found in so many documents of one batch is counted as common; the most common COMMON of them come last in
#: the order. That bounds what goes to every task; the result doesn't depend on it.
SEEN, COMMON = 3, 1 << 18
#: Longs of the parity bitmap of a set; a larger set has a second one, of a power of two, with a long for WIDE n-grams at most.
PARITY, WIDE = 16, 64
BITS = [f"p{i}" for i in range(PARITY)]


#: Rounds with the buckets' purest classes go on while a round leaves at most this share of the postings.
LEFT = 0.5


def _to_share(na: Column, nb: Column) -> Column:
    """The least overlap with which sets of these sizes reach the threshold."""
    return F.ceil(PERCENT * (na + nb) / (100 + PERCENT))


def _wrapped_sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return (total[begin[1:]] - total[begin[:-1]]).view(np.int64)


def sets_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """lo, hi, the sorted n-gram hashes of documents lo..hi-1 end to end, where each begins, and two keys of each set."""
    for chunk in chunks(column):
        words = chunk.words(SPACED)
        got, begin = shingle_sets(words.hashes(), words.first, WORDS)
        yield chunk.lo, chunk.hi, got, begin, _wrapped_sums(mixed(got ^ U(0x5851F42D4C957F2D)), begin), _wrapped_sums(mixed(got ^ U(0x14057B7EF767814F)), begin)


def _parities(got: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, list[np.ndarray | None]]:
    """For each set, PARITY longs: whether an odd number of its n-grams falls on each bit; and more longs for larger sets."""
    n = len(begin) - 1
    spread = (mixed(got) >> U(3)).astype(np.int64)
    bit = spread & (64 * PARITY - 1)
    odd = np.bincount(np.repeat(np.arange(n), np.diff(begin)) * 64 * PARITY + bit, minlength=n * 64 * PARITY).reshape(n, -1) & 1
    wide: list[np.ndarray | None] = [None] * n
    for i in np.flatnonzero(np.diff(begin) > PARITY * WIDE).tolist():
        size = 64 << (int(begin[i + 1] - begin[i] - 1) // WIDE).bit_length()
        wide[i] = np.packbits((np.bincount(spread[begin[i] : begin[i + 1]] & (size - 1), minlength=size) & 1).astype(np.uint8), bitorder="little").view(np.int64)
    return np.ascontiguousarray(np.packbits(odd.astype(np.uint8), axis=1, bitorder="little").view(np.int64).T), wide


def summaries(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: (doc_id, t1, t2, n, k1, k2, parities) of each document, and -count and hash as n and k1 of n-grams common in a batch."""
    names = ["doc_id", "t1", "t2", "n", "k1", "k2", *BITS, "wide"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = []
            for lo, hi, got, begin, k1, k2 in sets_of(batch.column("text")):
                bits, wide = _parities(got, begin)
                bits = [*map(pa.array, bits), pa.array(wide, pa.list_(pa.int64()))]
                own = [batch.column(c).slice(lo, hi - lo) for c in names[:3]]
                yield pa.record_batch([*own, pa.array(np.diff(begin), pa.int64()), pa.array(k1), pa.array(k2), *bits], names)
                grams.append(got)
            value, count = np.unique(np.concatenate(grams) if grams else np.zeros(0, np.uint64), return_counts=True)
            value, count = value[count >= SEEN].view(np.int64), count[count >= SEEN]
            none = pa.nulls(len(value), pa.int64())
            yield pa.record_batch([none, none, none, pa.array(-count, pa.int64()), pa.array(value), *[none] * (1 + PARITY), pa.nulls(len(value), pa.list_(pa.int64()))], names)

    return docs.mapInArrow(run, ", ".join(f"{x} {'array<bigint>' if x == 'wide' else 'long'}" for x in names))


def _in_order(got: np.ndarray, begin: np.ndarray, common: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of each document in the global order, and their places among the common ones (0: not common)."""
    if not len(common):
        return got, np.zeros(len(got), np.int64)
    at = np.minimum(np.searchsorted(common, got), len(common) - 1)
    place = np.where(common[at] == got, places[at], 0)
    owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((got, place, owner))
    return got[order], place[order]


def prefixes(docs: DataFrame, common: np.ndarray, places: np.ndarray, slots: np.ndarray | None = None) -> DataFrame:
    """gram, k1, k2, n, rest (n-grams from this one on, in order): the prefix of every set; a class once for each batch.

    With slots only n-grams whose slot is set; without, gram alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple[int, int]] = set()
            for _, _, got, begin, k1, k2 in sets_of(batch.column("text")):
                new = np.zeros(len(k1), bool)
                for i, key in enumerate(zip(k1.tolist(), k2.tolist(), strict=True)):
                    new[i] = key not in seen
                    seen.add(key)
                n = np.diff(begin)
                ordered, _ = _in_order(got, begin, common, places)
                length = np.where(new & (n > 0), n - (PERCENT * n + 99) // 100 + 1, 0)
                at = np.arange(length.sum()) + np.repeat(begin[:-1] - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
                gram = ordered[at].view(np.int64)
                if slots is None:
                    yield pa.record_batch([pa.array(gram)], ["gram"])
                    continue
                owner, chosen = np.repeat(np.arange(len(n)), length), in_slots(slots, gram)
                at, gram, owner = at[chosen], gram[chosen], owner[chosen]
                rest = (begin[1:][owner] - at).astype(np.int32)
                yield pa.record_batch([pa.array(gram), pa.array(k1[owner]), pa.array(k2[owner]), pa.array(n[owner].astype(np.int32)), pa.array(rest)], ["gram", "k1", "k2", "n", "rest"])

    return docs.mapInArrow(run, "gram long" if slots is None else "gram long, k1 long, k2 long, n int, rest int")


def fragments(docs: DataFrame, slots: np.ndarray, common: np.ndarray, places: np.ndarray) -> DataFrame:
    """k1, k2, parts (the n-grams of each fragment) of the sets whose slot is set, a class once for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple[int, int]] = set()
            for _, _, got, begin, k1, k2 in sets_of(batch.column("text")):
                chosen = []
                for i in np.flatnonzero(in_slots(slots, k1)).tolist():
                    if (key := (int(k1[i]), int(k2[i]))) not in seen:
                        seen.add(key)
                        chosen.append(i)
                if not chosen:
                    continue
                n = np.diff(begin)[chosen]
                inside = np.concatenate([[0], np.cumsum(n)])
                at = np.arange(inside[-1]) + np.repeat(begin[chosen] - inside[:-1], n)
                ordered, place = _in_order(got[at], inside, common, places)
                owner = np.repeat(np.arange(len(chosen)), n)
                part = np.where(place > 0, FRAGMENTS - 1, ((ordered >> U(32)).astype(np.int64) * (FRAGMENTS - 1)) >> 32)
                cuts = np.concatenate([[0], np.cumsum(np.bincount(owner * FRAGMENTS + part, minlength=len(chosen) * FRAGMENTS))])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(chosen) + 1) * FRAGMENTS, pa.int32()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ordered.view(np.int64))))
                yield pa.record_batch([pa.array(k1[chosen]), pa.array(k2[chosen]), lists], ["k1", "k2", "parts"])

    return docs.mapInArrow(run, "k1 long, k2 long, parts array<array<bigint>>")


def _may_reach(a: str, b: str) -> Column:
    """True for every pair that reaches the threshold: by the sizes, and by the least symmetric difference that parities allow."""
    differ = sum((F.bit_count(F.col(f"{a}.p{i}").bitwiseXOR(F.col(f"{b}.p{i}"))) for i in range(PARITY)), F.lit(0))
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)) & ((100 + PERCENT) * differ <= (100 - PERCENT) * (na + nb))


def _may_still(a: str, b: str) -> Column:
    """As _may_reach, by the wide bitmaps of sets that both have one; the longer is folded to the size of the shorter."""
    wa, wb = F.col(f"{a}.wide"), F.col(f"{b}.wide")
    xor = lambda x, y: x.bitwiseXOR(y)
    half = lambda w: F.zip_with(F.slice(w, F.lit(1), (F.size(w) / 2).cast("int")), F.slice(w, (F.size(w) / 2).cast("int") + 1, (F.size(w) / 2).cast("int")), xor)
    shorter = lambda x, y: F.when(F.size(x) > F.size(y), half(x)).otherwise(x)
    differ = F.aggregate(F.zip_with(shorter(wa, wb), shorter(wb, wa), xor), F.lit(0), lambda total, x: total + F.bit_count(x))
    enough = (100 + PERCENT) * differ <= (100 - PERCENT) * (F.col(f"{a}.n") + F.col(f"{b}.n"))
    return wa.isNull() | wb.isNull() | enough


def verified(pairs: DataFrame, docs: DataFrame, common: np.ndarray, places: np.ndarray) -> DataFrame:
    """The pairs (a, b, na, nb) that reach the threshold: overlaps are counted by fragment and summed for each pair."""
    ends = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
    ends = stored(ends.select("c.k1", "c.k2"), "ends")
    sets = fragments(docs, slot_bitmap(ends.select("k1")), common, places).join(ends, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    sets = stored(sets.select(F.struct("k1", "k2").alias("c"), "parts"), "fragments")
    left = pairs.join(sets.select(F.col("c").alias("a"), F.col("parts").alias("pa")), "a")
    both = left.join(sets.select(F.col("c").alias("b"), F.col("parts").alias("pb")), "b")
    part = F.transform(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1)), lambda i: F.size(F.array_intersect(F.get("pa", i), F.get("pb", i))))
    total = both.select("a", "b", "na", "nb", F.explode(part).alias("overlap")).groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap"))
    return total.filter(100 * F.col("overlap") >= PERCENT * (F.col("na") + F.col("nb") - F.col("overlap"))).select("a", "b")


def _text_keys(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _meet(a: str, b: str) -> Column:
    """Whether two postings of one bucket may be the first shared n-gram of sets that reach the threshold."""
    return F.least(F.col(f"{a}.rest"), F.col(f"{b}.rest")) >= _to_share(F.col(f"{a}.n"), F.col(f"{b}.n"))


def _several(df: DataFrame, k1: str, k2: str) -> DataFrame:
    """gram of the buckets whose rows differ in (k1, k2)."""
    ends = [f(k).alias(f"{f.__name__}{i}") for i, k in enumerate((k1, k2)) for f in (F.min, F.max)]
    return df.groupBy("gram").agg(*ends).filter("min0 != max0 or min1 != max1").select("gram")


def _buckets(texts: DataFrame, common: np.ndarray, places: np.ndarray) -> DataFrame:
    """gram, c, n, rest: the postings of n-grams that several classes have in their prefixes.

    A bitmap of n-grams seen twice leaves out most that no other set has, before anything but n-grams is shuffled.
    """
    twice = stored(prefixes(texts, common, places).groupBy("gram").count().filter("count > 1").select("gram"), "twice")
    index = prefixes(texts, common, places, slot_bitmap(twice))
    shared = index.join(_several(index, "k1", "k2"), "gram").distinct()
    return stored(shared.select("gram", F.struct("k1", "k2").alias("c"), "n", "rest"), "buckets")


def _with_pivots(postings: DataFrame, own: str) -> DataFrame:
    """The postings of classes other than the purest one of their bucket, with that one: pc, pn, prest, pown."""
    first = postings.groupBy("gram").agg(F.min(F.struct((F.col("n") - F.col("rest")).alias("rarer"), F.col("c").alias("pc"), F.col("n").alias("pn"), F.col("rest").alias("prest"), F.col(own).alias("pown"))).alias("p"))
    return stored(postings.join(first.select("gram", "p.pc", "p.pn", "p.prest", "p.pown"), "gram").filter("c != pc"), "met")


def _unsettled(postings: DataFrame, roots: DataFrame) -> DataFrame:
    """The postings, with root, of buckets whose classes are in several components."""
    placed = postings.select("gram", "c", "n", "rest").join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    placed = stored(placed, "placed")
    return stored(placed.join(_several(placed, "root.k1", "root.k2"), "gram"), "unsettled")


def join(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, t1, t2 of the text, n, k1, k2 of the set) and the root of every class that is linked to another (k1, k2, root)."""
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *[k.alias(n) for k, n in zip(_text_keys(text), ("t1", "t2"), strict=True)])
    known = stored(summaries(texts), "sets")
    rows = known.filter("k2 is not null")
    counted = known.filter("k2 is null").groupBy("k1").agg(F.sum(-F.col("n")).alias("count"))
    most = counted.orderBy(F.desc("count"), "k1").limit(COMMON).toArrow()  # COMMON rows at most
    common = most["k1"].to_numpy().view(np.uint64)
    places = np.arange(len(common), 0, -1)
    order = np.argsort(common)
    common, places = common[order], places[order]
    waiting = _buckets(texts, common, places)
    near = waiting.select("c.k1", "c.k2").distinct()
    slim = stored(rows.join(near, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select(F.struct("k1", "k2").alias("c"), "n", *BITS, "wide"), "near")
    links = roots = None
    own, left = "c", waiting.count()
    while True:
        met = _with_pivots(waiting, own)
        may = F.least("rest", "prest") >= _to_share(F.col("n"), F.col("pn"))
        pairs = met.filter(may & (F.col(own) != F.col("pown"))).select(F.least("c", "pc").alias("a"), F.greatest("c", "pc").alias("b")).distinct()
        close = _close(pairs, slim)
        if roots is None or close.head(1):
            found = stored(verified(close, texts, common, places), "links")
            links = found if links is None else links.unionByName(found)
            roots = stored(components(links), "roots")
        # a pivot has met its bucket and leaves it
        waiting, own = _unsettled(met, roots), "root"
        before, left = left, waiting.count()
        if not left:
            return rows, roots.select("node.k1", "node.k2", "root")
        if left > LEFT * before:
            break
    both = waiting.select("gram", "c", "n", "rest", "root").join(slim.drop("n", "wide"), "c")
    both = stored(both, "several")
    x, y = both.alias("x"), both.alias("y")
    met = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.c") < F.col("y.c")) & (F.col("x.root") != F.col("y.root")) & _meet("x", "y") & _may_reach("x", "y"))
    late = met.select(F.col("x.c").alias("a"), F.col("y.c").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")).distinct()
    late = _close(late.select("a", "b"), slim)
    if late.head(1):
        roots = stored(components(links.unionByName(verified(late, texts, common, places))), "roots")
    return rows, roots.select("node.k1", "node.k2", "root")


def _close(pairs: DataFrame, slim: DataFrame) -> DataFrame:
    """The pairs (a, b) that may reach the threshold, with their sizes na and nb."""
    x = slim.select(F.col("c").alias("a"), F.struct("n", *BITS, "wide").alias("x"))
    y = slim.select(F.col("c").alias("b"), F.struct("n", *BITS, "wide").alias("y"))
    met = pairs.join(x, "a").join(y.withColumnRenamed("b", "yb"), (F.col("b") == F.col("yb")) & _may_reach("x", "y")).filter(_may_still("x", "y"))
    return stored(met.select("a", "b", F.col("x.n").alias("na"), F.col("y.n").alias("nb")), "close")


def clusters(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, the least doc_id that links reach.

    Null and empty texts and texts without words have no shingles and link with nothing; a shorter text than five words
    is one shingle. Rows with equal sets are linked, repeated ids too. A row without doc_id belongs to the component
    that its text gives it, or to none. Further columns are ignored.
    """
    rows, roots = join(docs)
    classes = rows.filter("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    joined = classes.join(roots, ["k1", "k2"], "left")
    least = joined.filter("root is not null").groupBy("root").agg(F.min("rep").alias("component_id"))
    joined = joined.join(least, "root", "left").select("k1", "k2", F.coalesce("component_id", "rep").alias("component_id"))
    out = rows.join(joined, ["k1", "k2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(component, F.col("doc_id")).alias("component_id"))


def clean(docs: DataFrame) -> DataFrame:
    """docs with one document of each component: the one with the least id; all columns stay.

    Of rows that repeat that id in the component one stays, the least by a hash of the text; ids that repeat in other
    components, or with texts that link with nothing, don't count as copies. Rows without an id stay only where their
    component has no row with one. Texts without words all stay, repeated ones too. An empty table gives none.
    """
    rows, roots = join(docs)
    named = rows.filter("n > 0").join(roots, ["k1", "k2"], "left").withColumn("own", F.coalesce("root", F.struct("k1", "k2")))
    first = named.groupBy("own").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")).alias("m")).select("m.*", F.lit(True).alias("worded"))
    marks = first.unionByName(rows.filter("n = 0").select(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2", F.lit(False).alias("worded")).distinct())
    marks = marks.withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
    ids, (t1, t2) = docs["doc_id"].cast("long"), _text_keys(docs["text"].cast("string"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(ids, F.lit(0)).alias("doc_id"), ids.isNull().alias("none"), t1.alias("t1"), t2.alias("t2"))
    keys = ["t1", "t2", "doc_id", "none"]
    # one shuffle of the texts, for the join and for repeated rows
    kept = keyed.join(marks, keys).withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))))
    return kept.filter("place = 1 or not worded").select("row.*")
