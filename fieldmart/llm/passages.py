"""Near-duplicate passages across documents, by compact windows over min-hashes of word shingles.

A text is its sequence of 5-word shingles. For a hash function, a node of the Cartesian tree over the hashes is a
compact window (l, c, r): every run of shingles inside l..r that holds c has its min-hash at c. The nodes that span at
least a passage are about two for each passage length. Passages that are alike have, for each function with a chance of their
likeness, a window with the same least shingle; the shingle ANCHOR places beside it, within any passage on one side at
least, narrows the groups. Windows are grouped by function, shingle and anchor; each group meets its least member only, so
that a passage that a third of all documents share makes as many pairs as documents. The windows of a pair of texts are joined
to intervals, over which they are verified shingle by shingle. What isn't like the least member can be like another one only
by shingles that the least one lacks: it is grouped anew, by its group and the least hash of such shingles near it that
others of the group have too (of one in ONE_IN, others in each group that the two are in), and so on until no group
holds several texts, each window in one group at most; so groups of unlike texts fall apart instead of meeting as pairs. As verification is exact, one
function's meeting is enough. Beside that, all windows of shared groups, whether they met or not, are grouped by every run
of the least length around them, whose members are equal, so that no exact repeat is ever lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_slots, let_go, maybe_in, slot_bitmap, stored
from .text import ALNUM, U, chunks, grams, mixed

SHINGLE = 5
LEAST_WORDS = 50
FUNCTIONS = 3
ANCHOR = 12
#: Shingles of two passages in common, of all that either has.
PERCENT = 75
#: Windows whose offsets differ by no more are joined to one interval: words that were put in or left out.
DRIFT = 16
#: One in so many of a group's shingles, by a hash of both, may form a new group of what its least member is unlike.
ONE_IN = 4
#: Windows or runs that a task packs together.
BLOCKS = 1 << 19
_LEVELS = 6


def compact_windows(values: np.ndarray, begin: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """c, l, r (inclusive) of all compact windows of at least ``least`` places within each sequence begin[i]..begin[i+1]."""
    n = len(values)
    room = np.repeat(begin[1:], np.diff(begin)) if n else np.zeros(0, np.int64)
    lo = np.repeat(begin[:-1], np.diff(begin)) if n else np.zeros(0, np.int64)
    bits = max(24, int(n).bit_length())
    # the place is part of the value: the least of a range tells where it is, and of equal ones the first counts
    v = (values >> U(bits) << U(bits)) | np.arange(n, dtype=np.uint64)
    levels = [v]
    for k in range(1, _LEVELS):
        last, half = levels[-1], 1 << (k - 1)
        levels.append(np.minimum(last[: max(len(last) - half, 0)], last[half:]))
    starts = np.flatnonzero(np.arange(n) + least <= room)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    k = min(_LEVELS - 1, least.bit_length() - 1)
    width = 1 << k
    low = levels[k][starts]
    for shift in [*range(width, least - width, width), least - width]:
        low = np.minimum(low, levels[k][starts + shift])
    c = (low & U((1 << bits) - 1)).astype(np.int64)
    c = c[np.concatenate([[True], c[1:] != c[:-1]])]
    own, left, right = v[c], c.copy(), c + 1
    for level in range(_LEVELS - 1, -1, -1):
        step, table = 1 << level, levels[level]
        for side in (0, 1):
            live = np.arange(len(c))
            while len(live):
                if side == 0:
                    at = left[live] - step
                    ok = at >= lo[c[live]]
                else:
                    at = right[live]
                    ok = at + step <= room[c[live]]
                live, at = live[ok], at[ok]
                live = live[table[at] > own[live]]
                if side == 0:
                    left[live] -= step
                else:
                    right[live] += step
                if level < _LEVELS - 1:
                    break
    return c, left, right - 1


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """values cut at ends, a binary for each piece."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


#: Rows packed by _blocks; a row has some ints, each byte of which has a column of its own.
_BINARIES = ["keys", "counts", "buckets"]


def _packed_type(ints: int) -> str:
    return "part int, " + ", ".join(f"{x} binary" for x in (*_BINARIES, *(f"b{i}" for i in range(4 * ints))))


def _blocks(parts: int, keys: np.ndarray, bucket: np.ndarray, owner: np.ndarray, ints: np.ndarray) -> pa.RecordBatch:
    """Rows packed by the part of their bucket: keys of their texts with the number of rows, buckets, and the bytes of the ints one by one, so that they compress."""
    part = (bucket >> U(32)) % U(parts)
    order = np.argsort((part << U(32)) | owner.astype(np.uint64), kind="stable")
    part, owner = part[order], owner[order]
    cut = lambda x: np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)]])
    ends = cut(part)
    texts = np.union1d(ends, cut(owner))
    at = np.searchsorted(texts, ends)
    columns = [_binary(keys[owner[texts[:-1]]].view(np.void(16).dtype).ravel(), at), _binary(np.diff(texts).astype(np.int32), at), _binary(bucket[order], ends)]
    planes = [_binary(x, ends) for x in np.ascontiguousarray(ints[order].astype(np.int32).view(np.uint8).T)]
    return pa.record_batch([pa.array(part[ends[:-1]].astype(np.int32)), *columns, *planes], ["part", *_BINARIES, *(f"b{i}" for i in range(len(planes)))])


def _met_again(batches: Iterator[pa.RecordBatch], ints: int) -> tuple[np.ndarray, np.ndarray]:
    """The packed rows (bucket, k1, k2, ints) whose bucket several texts have, each once and in order, and the row of the least of its bucket."""
    blocks = list(batches)
    joined = lambda name, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for b in blocks for x in b.column(name).to_pylist())])
    bucket = joined("buckets", np.int64)
    order = np.argsort(bucket)
    same = bucket[order[1:]] == bucket[order[:-1]]
    order = order[np.append(False, same)[: len(order)] | np.append(same, False)[: len(order)]]
    if not len(order):
        return np.zeros((3 + ints, 0), np.int64), np.zeros(0, np.int64)
    count = joined("counts", np.int32)
    k1, k2 = joined("keys", np.int64).reshape(-1, 2)[np.repeat(np.arange(len(count)), count)[order]].T
    values = np.stack([joined(f"b{i}", np.uint8)[order] for i in range(4 * ints)], 1).view(np.int32)
    rows = np.stack([bucket[order], k1, k2, *values.T])
    # a text and a place in it have one row of a bucket
    rows = rows[:, np.lexsort(rows[3::-1])]
    differ = rows[:4, 1:] != rows[:4, :-1]
    first = np.append(True, differ[0])
    group = np.cumsum(first) - 1
    several = np.zeros(group[-1] + 1, bool)
    several[group[1:][differ[1:3].any(0) & ~differ[0]]] = True
    keep = np.flatnonzero(np.append(True, differ.any(0)) & several[group])
    place = np.full(rows.shape[1], -1)
    place[keep] = np.arange(len(keep))
    return rows[:, keep], place[np.flatnonzero(first)[group[keep]]]


def windows(texts: DataFrame, least: int, parts: int) -> DataFrame:
    """The windows of every text, once for each batch that holds it, in blocks (see _blocks) of at most about BLOCKS windows together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n, total = [], 0, 0
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("k1", "k2")], 1)
            new = np.zeros(len(keys), bool)
            new[np.unique(keys, axis=0, return_index=True)[1]] = True
            for chunk in chunks(batch.column("text").filter(pa.array(new))):
                rows = np.flatnonzero(new)[chunk.lo : chunk.hi]
                words = chunk.words(ALNUM)
                got, _, begin = grams(words.hashes(), words.first, SHINGLE)
                owner = np.repeat(np.arange(len(rows)), np.diff(begin))
                for f in range(FUNCTIONS):
                    c, left, right = compact_windows(mixed(got ^ U(0x9E3779B97F4A7C15 * (f + 1) & (1 << 64) - 1)), begin, least)
                    for beside in (-ANCHOR, ANCHOR):
                        at = c + beside
                        ok = (at >= left) & (at <= right)
                        mid, at, doc = c[ok], at[ok], owner[c[ok]]
                        with np.errstate(over="ignore"):
                            bucket = mixed(got[mid] + got[at] * U(3) + U(beside > 0))
                        places = np.stack([mid - begin[doc], mid - left[ok], right[ok] - mid], 1).astype(np.int32)
                        waiting.append((bucket >> U(2) << U(2) | U(f), doc + n, places))
                        total += len(mid)
                waiting.append(keys[rows])
                n += len(rows)
                if total >= BLOCKS:
                    yield packed(waiting)
                    waiting, n, total = [], 0, 0
        if total:
            yield packed(waiting)

    def packed(waiting: list) -> pa.RecordBatch:
        keys = np.concatenate([x for x in waiting if not isinstance(x, tuple)])
        return _blocks(parts, keys, *(np.concatenate(x) for x in zip(*(x for x in waiting if isinstance(x, tuple)), strict=True)))

    return texts.select("text", "k1", "k2").mapInArrow(run, _packed_type(3))


def _parts(df: DataFrame) -> int:
    return min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 << 16)


def shared_windows(texts: DataFrame, least: int) -> DataFrame:
    """bucket, c, w, p of the windows whose bucket several texts have, each once; p has c and w of the bucket's least.

    A task has all windows of its buckets, packed; only those of buckets that hold several windows are unpacked.
    """
    names = ["bucket", "k1", "k2", "at", "before", "after", "p1", "p2", "pat", "pbefore", "pafter"]
    kinds = ["int" if x.endswith(("at", "before", "after")) else "long" for x in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, least_of = _met_again(batches, 3)
        for lo in range(0, rows.shape[1], 1 << 16):
            own = slice(lo, lo + (1 << 16))
            columns = [*rows[:, own], *rows[1:, least_of[own]]]
            yield pa.record_batch([pa.array(x, pa.int64()).cast(pa.int32() if k == "int" else pa.int64()) for x, k in zip(columns, kinds, strict=True)], names)

    packed = windows(texts, least, _parts(texts)).repartitionById(_parts(texts), F.col("part"))
    got = packed.mapInArrow(run, ", ".join(map(" ".join, zip(names, kinds, strict=True))))
    side = lambda k1, k2, at, before, after: [F.struct(F.col(k1).alias("k1"), F.col(k2).alias("k2")).alias("c"), F.struct(F.col(at).alias("c"), F.col(before).alias("before"), F.col(after).alias("after")).alias("w")]
    return got.select("bucket", *side(*names[1:6]), F.struct(*side(*names[6:])).alias("p"))


def shingles(texts: DataFrame, slots: np.ndarray) -> DataFrame:
    """k1, k2, grams (the shingles in order) of the texts whose slot is set, once for each batch that holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            new = np.zeros(len(k1), bool)
            new[np.unique(np.stack([k1, k2], 1), axis=0, return_index=True)[1]] = True
            rows = np.flatnonzero(new & in_slots(slots, k1))
            for chunk in chunks(batch.column("text").take(pa.array(rows))):
                own = rows[chunk.lo : chunk.hi]
                words = chunk.words(ALNUM)
                got, _, begin = grams(words.hashes(), words.first, SHINGLE)
                lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(got.view(np.int64)))
                yield pa.record_batch([pa.array(k1[own]), pa.array(k2[own]), lists], ["k1", "k2", "grams"])

    return texts.select("text", "k1", "k2").mapInArrow(run, "k1 long, k2 long, grams array<bigint>")


def _longest(match: np.ndarray, least: int, cost: int) -> tuple[int, int] | None:
    """The longest range of at least ``least`` places with ``cost`` matches or more for every place without."""
    if np.count_nonzero(match) * (cost + 1) < least * cost:
        return None
    total = np.concatenate([[0], np.cumsum(np.where(match, 1, -cost))])
    lowest = np.minimum.accumulate(total)
    begin = np.searchsorted(-lowest, -total, "left")
    end = int(np.argmax(np.arange(len(total)) - begin))
    return (int(begin[end]), end) if end - begin[end] >= least else None


#: Matches asked for each shingle without one; the first is PERCENT of like lengths, the last an unbroken run.
_COSTS = (2 * PERCENT // (100 - PERCENT), 9, 15, 30, 1 << 30)


def alike(a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int, int, int]]:
    """Ranges (a0, a1, b0, b1) of shingles with PERCENT in common, long ones first, then what is left on either side."""
    out: list[tuple[int, int, int, int]] = []
    if min(len(a), len(b)) < least:
        return out
    # small numbers in place of hashes: sorted once, then all sets are tables
    value, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = code[: len(a)], code[len(a) :]

    def table(codes: np.ndarray) -> np.ndarray:
        has = np.zeros(len(value), bool)
        has[codes] = True
        return has

    matches, waiting = table(b)[a], [(0, len(a))]
    while waiting:
        low, high = waiting.pop()
        if high - low < least:
            continue
        for cost in _COSTS:
            found = _longest(matches[low:high], least, cost)
            if found is None:
                continue
            a0, a1 = low + found[0], low + found[1]
            x = table(a[a0:a1])
            inside = _longest(x[b], least, cost)
            if inside is None:
                continue
            y = table(b[slice(*inside)])
            if 100 * np.count_nonzero(x & y) >= PERCENT * np.count_nonzero(x | y):
                out.append((a0, a1, *inside))
                waiting += [(low, a0), (a1, high)]
                break
    return out


def _merged(hits: np.ndarray) -> list[tuple[int, int, int, int, list[int]]]:
    """Intervals (a0, a1, b0, b1) of windows that overlap at about the same offset, with the places that they met at in b."""
    out: list[list] = []
    hits = hits[np.lexsort((*hits.T[::-1], hits[:, 5] - hits[:, 4]))]
    # a hit that several buckets gave counts once
    hits = hits[np.append(True, (hits[1:] != hits[:-1]).any(1))[: len(hits)]]
    for a0, a1, b0, b1, ca, cb in hits.tolist():
        last = out[-1] if out else None
        if last and cb - ca - last[4] <= DRIFT and a0 <= last[1] + DRIFT and a1 >= last[0] - DRIFT:
            last[:5] = min(a0, last[0]), max(a1, last[1]), min(b0, last[2]), max(b1, last[3]), cb - ca
            last[5].append(cb)
        else:
            out.append([a0, a1, b0, b1, cb - ca, [cb]])
    return sorted(((*x[:4], x[5]) for x in out), key=lambda x: x[0] - x[1])


def _pair() -> list[Column]:
    return [F.struct(F.col(f"{x}1").alias("k1"), F.col(f"{x}2").alias("k2")).alias(x) for x in "ab"]


def verified(pairs: DataFrame, arrays: DataFrame, least: int) -> DataFrame:
    """a, b, spans (a0, a1, b0, b1 in words) of pairs with passages in common."""
    left = pairs.join(arrays.select(F.col("c").alias("a"), F.col("grams").alias("ga")), "a")
    low, high = F.array_min(F.transform("hits", lambda h: h["a0"])), F.array_max(F.transform("hits", lambda h: h["a1"]))
    left = left.withColumn("from", low).withColumn("ga", F.slice("ga", F.col("from") + 1, high - F.col("from") + 1))
    both = left.join(arrays.select(F.col("c").alias("b"), F.col("grams").alias("gb")), "b").select(F.col("a.k1").alias("a1"), F.col("a.k2").alias("a2"), F.col("b.k1").alias("b1"), F.col("b.k2").alias("b2"), "hits", "from", "ga", "gb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a1", pa.int64()), ("a2", pa.int64()), ("b1", pa.int64()), ("b2", pa.int64()), ("a0", pa.int32()), ("a9", pa.int32()), ("b0", pa.int32()), ("b9", pa.int32())])
        for batch in batches:
            rows = []
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("a1", "a2", "b1", "b2")), strict=True))
            hits, shifts = batch.column("hits"), batch.column("from").to_numpy()
            every = np.stack([hits.flatten().field(c).to_numpy() for c in ("a0", "a1", "b0", "b1", "ca", "cb")], 1).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(hits).to_numpy())])
            for i, shift in enumerate(shifts.tolist()):
                a, b = (batch.column(c)[i].values.to_numpy() for c in ("ga", "gb"))
                done = np.zeros(len(b), bool)
                for a0, a1, b0, b1, met in _merged(every[ends[i] : ends[i + 1]]):
                    if done[met].all():
                        continue
                    for s, e, p, q in alike(a[a0 - shift : a1 + 1 - shift], b[b0 : b1 + 1], least):
                        rows.append((*keys[i], a0 + s, a0 + e + SHINGLE - 1, b0 + p, b0 + q + SHINGLE - 1))
                        done[b0 + p : b0 + q] = True
            yield pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema).combine_chunks().to_batches()[0] if rows else pa.record_batch([pa.array([], f.type) for f in schema], schema=schema)

    found = both.mapInArrow(run, "a1 long, a2 long, b1 long, b2 long, a0 int, a9 int, b0 int, b9 int")
    return found.select(*_pair(), "a0", "a9", "b0", "b9").distinct()


def exact_runs(found: DataFrame, arrays: DataFrame, least: int) -> DataFrame:
    """Packed (see _blocks): bucket, text and start of every run of ``least`` shingles whose min-hash stands at a found window's place: equal buckets are equal runs.

    The windows of one function will do: each run has one place, and equal runs have the same shingle and anchor there.
    """
    places = sorted({*range(0, least, SHINGLE), least - 1})
    odd = mixed(np.arange(1, len(places) + 1, dtype=np.uint64)) | U(1)
    first = found.filter(F.col("bucket").bitwiseAND(F.lit(3)) == 0)
    rows = first.groupBy("c").agg(F.collect_set("w").alias("at")).join(arrays, "c").select("c.k1", "c.k2", "at", "grams")

    parts = _parts(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, total = [], 0
        for batch in batches:
            k1, k2 = (batch.column(k).to_numpy() for k in ("k1", "k2"))
            for i in range(batch.num_rows):
                got = batch.column("grams")[i].values.to_numpy().view(np.uint64)
                c, before, after = (batch.column("at")[i].values.field(x).to_numpy().astype(np.int64) for x in ("c", "before", "after"))
                low, high = c - np.minimum(before, least - 1), np.minimum(c, c + after - least + 1)
                n = np.maximum(high - low + 1, 0)
                start = np.unique(np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum()))
                with np.errstate(over="ignore"):
                    key = mixed((got[start[:, None] + np.array(places)] * odd).sum(1, dtype=np.uint64))
                waiting.append((k1[i], k2[i], key, start))
                total += len(start)
                if total >= BLOCKS:
                    yield packed(waiting)
                    waiting, total = [], 0
        if total:
            yield packed(waiting)

    def packed(waiting: list) -> pa.RecordBatch:
        k1, k2, key, start = zip(*waiting, strict=True)
        return _blocks(parts, np.stack([k1, k2], 1), np.concatenate(key), np.repeat(np.arange(len(key)), [len(x) for x in key]), np.concatenate(start)[:, None])

    return rows.mapInArrow(run, _packed_type(1))


def _spans(start: np.ndarray, off: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """lo, hi, off of the runs at ``start`` joined along each offset, without those whose places on both sides others cover."""
    order = np.lexsort((start, off))
    start, off = start[order], off[order]
    new = np.concatenate([[True], (np.diff(off) != 0) | (np.diff(start) > least)])
    last = np.append(np.flatnonzero(new)[1:], len(start)) - 1
    lo, hi, off = start[new], start[last] + least, off[new]
    keep, reach, best = np.zeros(len(lo), bool), -1, -1
    for i in np.lexsort((-hi, lo)).tolist():
        if lo[i] > reach and best >= 0:
            keep[best], reach, best = True, hi[best], -1
        if lo[i] > reach:
            keep[i], reach = True, hi[i]
        elif hi[i] > (hi[best] if best >= 0 else reach):
            best = i
    if best >= 0:
        keep[best] = True
    base = int((lo - off).min())
    there = np.zeros(int((hi - off).max()) - base, bool)
    for i in np.flatnonzero(keep).tolist():
        there[lo[i] - off[i] - base : hi[i] - off[i] - base] = True
    for i in np.flatnonzero(~keep).tolist():
        own = there[lo[i] - off[i] - base : hi[i] - off[i] - base]
        if not own.all():
            keep[i] = own[:] = True
    return lo[keep], hi[keep], off[keep]


def exact_passages(runs: DataFrame, least: int) -> DataFrame:
    """a, b, spans (a0, a9, b0, b9 in words) of equal runs in several texts: every place of a run with its first place in the least text.

    Runs that follow one another at the same offset are one passage. The least text's further places have it as a and b.
    """

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The runs with their bucket's least, by their two texts."""
        (_, *rows), least_of = _met_again(batches, 1)
        rows = np.stack([*(x[least_of] for x in rows), *rows])[:, least_of != np.arange(len(least_of))]
        rows = rows[:, np.lexsort(rows[[4, 3, 1, 0]])]
        ends = np.concatenate([[0], np.flatnonzero((rows[[0, 1, 3, 4], 1:] != rows[[0, 1, 3, 4], :-1]).any(0)) + 1, [rows.shape[1]]])
        for lo in range(0, len(ends) - 1 if rows.shape[1] else 0, 1 << 12):
            cuts = ends[lo : lo + (1 << 12) + 1]
            own = rows[:, cuts[0] : cuts[-1]]
            at = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (own[5], own[5] - own[2])], ["start", "off"])
            yield pa.record_batch([*(pa.array(rows[i, cuts[:-1]]) for i in (0, 1, 3, 4)), pa.ListArray.from_arrays(pa.array((cuts - cuts[0]).astype(np.int32)), at)], ["k1", "k2", "b1", "b2", "at"])

    met = runs.repartitionById(_parts(runs), F.col("part")).mapInArrow(grouped, "k1 long, k2 long, b1 long, b2 long, at array<struct<start: int, off: int>>")
    met = met.groupBy("k1", "k2", "b1", "b2").agg(F.flatten(F.collect_list("at")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, flat = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("at")).to_numpy())]), batch.column("at").flatten()
            start, off = (flat.field(x).to_numpy().astype(np.int64) for x in ("start", "off"))
            found = [_spans(start[i:j], off[i:j], least) for i, j in zip(ends[:-1], ends[1:], strict=True)]
            if not found:
                continue
            row = pa.array(np.repeat(np.arange(len(found)), [len(x[0]) for x in found]))
            lo, hi, shift = (np.concatenate(x) for x in zip(*found, strict=True))
            hi = hi + SHINGLE - 1
            places = [pa.array(x.astype(np.int32)) for x in (lo - shift, hi - shift, lo, hi)]
            yield pa.record_batch([*(batch.column(i).take(row) for i in range(4)), *places], ["a1", "a2", "b1", "b2", "a0", "a9", "b0", "b9"])

    spans = met.mapInArrow(run, "a1 long, a2 long, b1 long, b2 long, a0 int, a9 int, b0 int, b9 int")
    return spans.select(*_pair(), "a0", "a9", "b0", "b9")


def _hits(met: DataFrame) -> DataFrame:
    """a, b, hits (a0, a1, b0, b1, ca, cb) of windows that met their bucket's least; the rows that a task reads together have one for each pair of texts."""
    names = ["a1", "a2", "b1", "b2"]
    places = ["a0", "a1", "b0", "b1", "ca", "cb"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, total = [], 0
        for batch in batches:
            waiting.append(batch)
            total += batch.num_rows
            if total >= BLOCKS:
                yield from together(waiting)
                waiting, total = [], 0
        if total:
            yield from together(waiting)

    def together(waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.stack([np.concatenate([b.column(i).to_numpy() for b in waiting]).astype(np.int64) for i in range(10)])
        own, least = rows[:5], rows[5:]
        swap = (own[0] < least[0]) | ((own[0] == least[0]) & (own[1] < least[1]))
        a, b = np.where(swap, own, least), np.where(swap, least, own)
        span = lambda x: (x[2] - x[3], x[2] + x[4])
        rows = np.stack([*a[:2], *b[:2], *span(a), *span(b), a[2], b[2]])
        rows = rows[:, np.lexsort(rows[::-1])]
        differ = rows[:, 1:] != rows[:, :-1]
        new, pair = np.append(True, differ.any(0)), np.append(True, differ[:4].any(0))[: rows.shape[1]]
        rows, pair = rows[:, new], pair[new]
        ends = np.append(np.flatnonzero(pair), rows.shape[1])
        for lo in range(0, len(ends) - 1, 1 << 12):
            cuts = ends[lo : lo + (1 << 12) + 1]
            at = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in rows[4:, cuts[0] : cuts[-1]]], places)
            yield pa.record_batch([*(pa.array(x) for x in rows[:4, cuts[:-1]]), pa.ListArray.from_arrays(pa.array((cuts - cuts[0]).astype(np.int32)), at)], [*names, "hits"])

    flat = met.select(*[F.col(f"{x}{y}").alias(f"{n}{i}") for n, x in (("x", ""), ("y", "p.")) for i, y in enumerate(("c.k1", "c.k2", "w.c", "w.before", "w.after"))])
    found = flat.mapInArrow(run, ", ".join(f"{x} long" for x in names) + ", hits array<struct<" + ", ".join(f"{x}: int" for x in places) + ">>")
    return found.select(*_pair(), "hits")


def _several(df: DataFrame, key: str, k1: str, k2: str, *more: Column) -> DataFrame:
    """The keys of rows that differ in (k1, k2)."""
    ends = [f(k).alias(f"{f.__name__}{i}") for i, k in enumerate((k1, k2)) for f in (F.min, F.max)]
    return df.groupBy(key).agg(*ends, *more).filter("min0 != max0 or min1 != max1").drop("min0", "max0", "min1", "max1")


def _regrouped(rows: DataFrame, arrays: DataFrame, least: int) -> DataFrame:
    """bucket, c, w, open of the rows (with ``pivot``, whether it is its bucket's least) by their bucket and a shingle near them.

    Shingles that the pivot has, or only one text or nothing open, are left out; of the others the least hash counts.
    """
    near = rows.groupBy("c").agg(F.collect_list(F.struct("bucket", "w", "open", "pivot")).alias("at")).join(arrays, "c").select("c.k1", "c.k2", "at", "grams")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "of", "k1", "k2", "at", "before", "after", "open", "pivot"]
        for batch in batches:
            for i in range(batch.num_rows):
                got, at = batch.column("grams")[i].values.to_numpy().view(np.uint64), batch.column("at")[i].values
                bucket = at.field("bucket").to_numpy().view(np.uint64)
                c, before, after = (at.field("w").field(x).to_numpy().astype(np.int64) for x in ("c", "before", "after"))
                flags = [at.field(x).to_numpy(zero_copy_only=False) for x in ("open", "pivot")]
                step = max(1, (1 << 20) // (2 * least))
                for j in range(0, len(c), step):
                    own = slice(j, j + step)
                    low, high = c[own] - np.minimum(before[own], least - 1), c[own] + np.minimum(after[own], least - 1)
                    n = high - low + 1
                    which = np.repeat(np.arange(len(n)), n)
                    shingle = got[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
                    with np.errstate(over="ignore"):
                        key = mixed(bucket[own][which] * U(0x9E3779B97F4A7C15) + mixed(shingle ^ U(0x5851F42D4C957F2D)))
                    chosen = np.flatnonzero(key % U(ONE_IN) == 0)
                    which, key = which[chosen], key[chosen] // U(ONE_IN)
                    order = np.lexsort((key, which))
                    which, key = which[order], key[order]
                    new = np.append(True, (which[1:] != which[:-1]) | (key[1:] != key[:-1]))[: len(key)]
                    which, key = which[new], key[new]
                    longs = [pa.array(np.full(len(key), batch.column(k)[i].as_py())) for k in ("k1", "k2")]
                    yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(bucket[own][which].view(np.int64)), *longs, *[pa.array(x[own][which].astype(np.int32)) for x in (c, before, after)], *[pa.array(f[own][which]) for f in flags]], names)

    keyed = stored(near.mapInArrow(run, "bucket long, of long, k1 long, k2 long, at int, before int, after int, open boolean, pivot boolean"), "near")
    live = _several(keyed, "bucket", "k1", "k2", F.max("pivot").alias("known"), F.max("open").alias("some")).filter("some and not known").select("bucket")
    kept = keyed.join(live, "bucket").groupBy("of", "k1", "k2", "at", "before", "after").agg(F.min("bucket").alias("bucket"), F.max("open").alias("open"))
    w = F.struct(F.col("at").alias("c"), "before", "after").alias("w")
    return stored(kept.select("bucket", F.struct("k1", "k2").alias("c"), w, "open"), "windows")


def repeated(docs: DataFrame, least_words: int = LEAST_WORDS) -> tuple[DataFrame, DataFrame]:
    """Texts (doc_id, k1, k2) and passages (a, b, a0, a9, b0, b9): words b0..b9-1 of text b are like words a0..a9-1 of text a.

    Text a has the smaller hash, so that of any set of like passages the one in the text with the least hash is never a b;
    where that text holds an exact repeat at several places, a and b are the same.
    """
    least = least_words - SHINGLE + 1
    texts = _texts(docs)
    text = F.struct("k1", "k2")
    met = stored(shared_windows(texts, least), "windows")
    found = met.select("bucket", "c", "w")
    needed = stored(found.select("c.k1", "c.k2").distinct(), "needed")
    arrays = shingles(texts, slot_bitmap(needed.select("k1"))).join(needed, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    arrays = stored(arrays.select(text.alias("c"), "grams"), "shingles")
    parts, near = [], arrays
    let_go(docs.sparkSession)
    met = met.withColumn("open", F.lit(True))
    while True:
        hits = _hits(met.filter("c != p.c"))
        pairs = hits.groupBy("a", "b").agg(F.flatten(F.collect_list("hits")).alias("hits"))
        part = stored(verified(pairs, near, least), "passages")
        parts.append(part)
        settled = part.select("a", "b", "b0", "b9").unionByName(part.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("a0").alias("b0"), F.col("a9").alias("b9")))
        settled = settled.groupBy(F.col("a").alias("s"), F.col("b").alias("t")).agg(F.collect_list(F.struct("b0", "b9")).alias("at"))
        inside = F.exists("at", lambda x: (F.col("w.c") >= x["b0"]) & (F.col("w.c") + SHINGLE <= x["b9"]))
        pivot = (F.col("c") == F.col("p.c")) & (F.col("w") == F.col("p.w"))
        marked = met.join(settled, (F.col("p.c") == F.col("s")) & (F.col("c") == F.col("t")), "left")
        marked = marked.select("bucket", "c", "w", pivot.alias("pivot"), (F.col("open") & ~pivot & ~F.coalesce(inside, F.lit(False))).alias("open")).repartition("bucket")
        # all of a bucket that has something left: what is left, what has settled and the pivot
        rest = stored(marked.join(marked.groupBy("bucket").agg(F.max("open").alias("left")).filter("left").select("bucket"), "bucket"), "rest")
        if not rest.head(1):
            break
        # further rounds have no other texts
        near = stored(maybe_in(near, "c.k1", rest.select("c.k1").distinct()), "shingles")
        rows = _regrouped(rest, near, least)
        if not rows.head(1):
            break
        pivots = rows.filter("open").groupBy("bucket").agg(F.min(F.struct("c", "w")).alias("p"))
        # who has settled is still a partner: only what is not settled needs another
        met = stored(rows.join(pivots, "bucket"), "met")
        let_go(docs.sparkSession)
    exact = stored(exact_passages(exact_runs(found, arrays, least), least), "exact")
    passages = exact.limit(0)
    for part in parts:
        passages = passages.unionByName(part)
    # of exact repeats within near ones of the same two texts the longer is enough
    known = passages.select(*[F.col(x).alias(f"n{x}") for x in passages.columns])
    inside = [F.col("na") == F.col("a"), F.col("nb") == F.col("b"), F.col("na0") <= F.col("a0"), F.col("na9") >= F.col("a9"), F.col("nb0") <= F.col("b0"), F.col("nb9") >= F.col("b9")]
    passages = passages.unionByName(exact.join(known, inside, "left_anti"))
    return texts.select("doc_id", "k1", "k2"), passages.distinct()


def _classes(docs: DataFrame, least_words: int) -> DataFrame:
    """k1, k2, rep (least doc_id), n_words of the texts of enough words, and how many documents have each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                own = [batch.column(c).slice(chunk.lo, chunk.hi - chunk.lo) for c in ("doc_id", "k1", "k2")]
                yield pa.record_batch([*own, pa.array(chunk.words(ALNUM).counts, pa.int32())], ["doc_id", "k1", "k2", "n_words"])

    rows = _texts(docs).mapInArrow(run, "doc_id long, k1 long, k2 long, n_words int").filter(F.col("n_words") >= least_words)
    return rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.max("n_words").alias("n_words"), F.count("*").alias("n"))


def report(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, source_id, start, end, source_start, source_end: words of a document that repeat words of the source.

    One row for each passage of each document that has it, the source itself included; documents without repeated
    passages have none. Of equal texts the least doc_id is the one that is compared, and each other one repeats it
    as a whole. Null and empty texts and texts of fewer words have no passages; an empty table gives no rows. Of texts
    alike in two ways, as in ties of a passage with two others, each is reported with the one it was found with. Further columns are ignored.
    """
    texts, passages = repeated(docs, least_words)
    passages = stored(passages, "passages")
    classes = stored(_classes(docs, least_words), "classes")
    rep = classes.select(F.struct("k1", "k2").alias("c"), F.col("rep"))
    span = lambda a, b, *cols: passages.select(F.col(a).alias("s"), F.col(b).alias("c"), *[F.col(x).alias(n) for x, n in zip(cols, ("start", "end", "source_start", "source_end"), strict=True)])
    rows = span("a", "b", "b0", "b9", "a0", "a9").unionByName(span("a", "a", "a0", "a9", "a0", "a9")).distinct()
    rows = rows.join(rep.withColumnRenamed("rep", "doc_id"), "c").join(rep.select(F.col("c").alias("s"), F.col("rep").alias("source_id")), "s")
    names = ["doc_id", "source_id", "start", "end", "source_start", "source_end"]
    whole = [F.lit(0).alias("start"), F.col("n_words").alias("end"), F.lit(0).alias("source_start"), F.col("n_words").alias("source_end")]
    copies = texts.join(classes.filter("n > 1"), ["k1", "k2"]).select("doc_id", F.col("rep").alias("source_id"), *whole)
    return rows.select(names).unionByName(copies.select(names))


def clean(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """docs without repeated passages: the text with the least hash keeps them, the others lose the words.

    Of equal texts of enough words one row stays, with the least doc_id (rows without an id come last). A document that
    loses all its words goes; one that loses some has n_chars, if there is that column, set to its new length. Rows without
    repeated words, null and empty texts stay as they are, repeated ones too. Columns may have any names.
    """
    _, passages = repeated(docs, least_words)
    cuts = passages.filter("a != b").groupBy("b").agg(F.sort_array(F.collect_set(F.struct("b0", "b9"))).alias("cuts")).select("b.k1", "b.k2", "cuts")
    copies = _classes(docs, least_words).filter("n > 1").select("k1", "k2", F.col("rep").alias("rep"), F.lit(True).alias("copied"))
    marks = cuts.join(copies, ["k1", "k2"], "full").select(F.col("k1").alias("m1"), F.col("k2").alias("m2"), "cuts", "rep", "copied")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), docs["doc_id"].cast("long").alias("id"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))
    joined = keyed.join(marks, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")), "left").filter("copied is null or id <=> rep")
    # of rows that repeat id and text the first stays
    place = F.row_number().over(Window.partitionBy("k1", "k2", "id").orderBy(F.lit(0)))
    joined = joined.withColumn("place", place).filter("copied is null or place = 1")
    cuts = F.col("cuts").alias("_" * (1 + max(len(c) for c in docs.columns)))
    joined = joined.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], cuts)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = batch.column(len(names)).is_valid().to_numpy(zero_copy_only=False)
            if not cut.any():
                yield batch.select(list(range(len(names))))
                continue
            at = np.flatnonzero(cut)
            column = batch.column("text").take(pa.array(at))
            new: dict[int, str] = {}
            for chunk in chunks(column):
                words = chunk.words(ALNUM)
                for d in range(chunk.hi - chunk.lo):
                    row, kept, begin = int(at[chunk.lo + d]), bytearray(), int(chunk.bounds[d])
                    left = np.ones(words.first[d + 1] - words.first[d], bool)
                    for s in batch.column(len(names))[row].as_py():
                        left[s["b0"] : s["b9"]] = False
                        first, last = int(words.start[words.first[d] + s["b0"]]), int(words.end[words.first[d] + s["b9"] - 1])
                        kept += chunk.data[begin : max(begin, first)].tobytes()
                        begin = max(begin, last)
                    kept += chunk.data[begin : chunk.bounds[d + 1]].tobytes()
                    new[row] = kept.decode() if left.any() else None
            keep = np.array([new.get(i, "") is not None for i in range(batch.num_rows)])
            columns = []
            for i, name in enumerate(names):
                values = batch.column(i)
                if name == "text":
                    values = pa.array([new[j] if j in new else v.as_py() for j, v in enumerate(values)], values.type)
                elif name == "n_chars":
                    values = pa.array([len(new[j]) if new.get(j) is not None else v.as_py() for j, v in enumerate(values)], values.type)
                columns.append(values)
            yield pa.record_batch(columns, names).filter(pa.array(keep))

    return joined.mapInArrow(run, docs.schema)
