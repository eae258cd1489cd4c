"""Phrase collocations by stripes: each prefix keys an associative counter of the words that follow it.

A stripe holds its prefix, how often that occurs, and the next words with their counts. Tasks count the stripes of a batch; equal
keys meet in one task and are merged elementwise. From the merged stripes come the extensions (phrases of one word more), the totals of
prefixes, and the largest extension that holds a phrase. Stripes of one-word prefixes come first; a longer phrase can't be more frequent than
its parts, so stripes of two-word prefixes are made for frequent extensions only.

The stripe of a very common prefix is cut into PARTS by the next word, so that no task holds the whole; every part has the prefix's total.
Stripes travel packed in buckets of keys, as many as the corpus has words for. Words are 64-bit hashes of language and word until the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_slots, slot_bitmap, stored
from .text import U, Words, _table, chunks, hash_of, mixed

#: Least frequency of a phrase, phrases of a language that are returned, and the share (percent) of its occurrences that makes a longer phrase hold it.
LEAST, BEST, INSIDE = 10, 2000, 50
#: Cuts of a very common prefix's stripe.
PARTS = 64
#: Words of the corpus for each bucket in which stripes are merged, and the least number of buckets.
IN_BUCKET, BUCKETS = 1 << 20, 16
#: Bytes of text whose stripes are counted together.
AT_ONCE = 1 << 21
#: A prefix is very common if it makes this share of all words: at most so many are.
HOT = 4096
PIECE_ENDS = _table(b".,;:!?\n\v\f\r")
IN_PIECES = ~(PIECE_ENDS | _table(b" \t"))
PACKED = "bucket long, keys binary, total binary, sizes binary, next binary, n binary"
STRIPE = "w1 long, w2 long, part int, total long, next array<long>, n array<long>, slots array<long>"


@dataclass
class Pieces:
    """Words of some documents: hashes with the language, and for each whether the next word stands in the same piece."""

    words: Words
    ids: np.ndarray
    goes_on: np.ndarray
    lang: np.ndarray


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([hash_of(x) for x in langs] or [0], np.uint64)


def pieces(batch: pa.RecordBatch) -> Iterator[tuple[Pieces, list[str]]]:
    """The words of a batch (lang, text) in chunks of whole documents, with the languages that ``lang`` numbers."""
    coded = batch.column("lang").dictionary_encode()
    langs, of_doc = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    salt = _lang_hashes(langs)
    for chunk in chunks(batch.column("text"), AT_ONCE):
        words = chunk.words(IN_PIECES)
        lang = np.repeat(of_doc[chunk.lo : chunk.hi], words.counts)
        with np.errstate(over="ignore"):
            ids = mixed(words.hashes() + salt[lang] * U(0x9E3779B97F4A7C15))
        ends = np.cumsum(PIECE_ENDS[chunk.data])
        goes_on = np.zeros(len(ids), bool)
        if len(ids) > 1:
            goes_on[:-1] = ends[words.start[1:]] == ends[words.start[:-1]]
        last = words.first[1:][words.counts > 0] - 1
        goes_on[last] = False
        yield Pieces(words, ids.view(np.int64), goes_on, lang), langs


def pair_slots(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Where a two-word phrase stands in a bitmap."""
    with np.errstate(over="ignore"):
        return mixed(first.view(np.uint64) * U(0xD1342543DE82EF95) + second.view(np.uint64)).view(np.int64)


def _spelled(words: Words, at: np.ndarray) -> pa.Array:
    """The words of these numbers as one text column."""
    start, size = words.start[at], words.end[at] - words.start[at]
    offsets = np.concatenate([[0], np.cumsum(size)])
    data = words.data[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def word_counts(docs: DataFrame) -> DataFrame:
    """id, lang, word, n of the words found LEAST times or more; and, without id and word, n of all words of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, names = [], None
            for p, langs in pieces(batch):
                names = pa.array(langs, pa.string())
                ids, at, n = np.unique(p.ids, return_index=True, return_counts=True)
                found.append((ids, n, names.take(pa.array(p.lang[at])), _spelled(p.words, at)))
                total = np.bincount(p.lang, minlength=len(langs))
                yield pa.record_batch([pa.nulls(len(langs), pa.int64()), names, pa.nulls(len(langs), pa.string()), pa.array(total, pa.int64())], ["id", "lang", "word", "n"])
            if found:
                ids, at, of = np.unique(np.concatenate([f[0] for f in found]), return_index=True, return_inverse=True)
                n = np.bincount(of, np.concatenate([f[1] for f in found]), len(ids)).astype(np.int64)
                lang, word = (pa.concat_arrays([f[i] for f in found]).take(pa.array(at)) for i in (2, 3))
                yield pa.record_batch([pa.array(ids), lang, word, pa.array(n)], ["id", "lang", "word", "n"])

    counted = docs.mapInArrow(run, "id long, lang string, word string, n long").groupBy("id", "lang", "word").agg(F.sum("n").alias("n"))
    return stored(counted.filter((F.col("n") >= LEAST) | F.col("id").isNull()), "words")


@dataclass
class Block:
    """Stripes as arrays: keys (w1, w2 or 0, part), totals, and how many of the next words and counts that follow end to end each has."""

    keys: np.ndarray
    total: np.ndarray
    sizes: np.ndarray
    following: np.ndarray
    n: np.ndarray

    @staticmethod
    def counted(w1: np.ndarray, w2: np.ndarray | None, total: np.ndarray, owner: np.ndarray, following: np.ndarray, n: np.ndarray, hot: np.ndarray) -> Block:
        """Of prefixes with their totals, and of extensions with their prefix's number, next word and count. Every part of a hot prefix has its total."""
        first = np.concatenate([np.flatnonzero(~hot), np.repeat(np.flatnonzero(hot), PARTS)])
        part = np.concatenate([np.zeros(int((~hot).sum()), np.int64), np.tile(np.arange(PARTS), int(hot.sum()))])
        place = np.zeros(len(w1), np.int64)  # of a prefix's first stripe
        place[first[part == 0]] = np.flatnonzero(part == 0)
        of = place[owner] + np.where(hot[owner], following & (PARTS - 1), 0)
        order = np.argsort(of, kind="stable")
        second = np.zeros(len(first), np.int64) if w2 is None else w2[first]
        return Block(np.stack([w1[first], second, part]), total[first], np.bincount(of, minlength=len(first)), following[order], n[order])

    def chosen(self, at: np.ndarray) -> Block:
        """The stripes of these numbers, in their order."""
        begin, sizes = (np.cumsum(self.sizes) - self.sizes)[at], self.sizes[at]
        inner = np.arange(int(sizes.sum())) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        return Block(self.keys[:, at], self.total[at], sizes, self.following[inner], self.n[inner])

    def packed(self, buckets: int) -> pa.RecordBatch:
        """A row for each bucket, with its stripes as bytes."""
        with np.errstate(over="ignore"):
            w1, w2, part = self.keys.view(np.uint64)
            bucket = (mixed(w1 * U(0x9E3779B97F4A7C15) + w2 * U(0xD1342543DE82EF95) + part) % U(buckets)).astype(np.int64)
        held = self.chosen(np.argsort(bucket, kind="stable"))
        number, first = np.unique(np.sort(bucket), return_index=True)
        stripes_ = np.append(first, len(bucket))
        entries = np.append(0, np.cumsum(held.sizes))[stripes_]
        cut = lambda x, bounds, kind: pa.array([np.ascontiguousarray(x[..., a:b], kind).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
        columns = [cut(held.keys, stripes_, np.int64), cut(held.total, stripes_, np.int64), cut(held.sizes, stripes_, np.int32), cut(held.following, entries, np.int64), cut(held.n, entries, np.int32)]
        return pa.record_batch([pa.array(number), *columns], [c.split()[0] for c in PACKED.split(", ")])

    @staticmethod
    def unpacked(batch: pa.RecordBatch) -> Block:
        keys = np.concatenate([np.frombuffer(x.as_buffer(), np.int64).reshape(3, -1) for x in batch.column("keys")], 1)
        flat = lambda c, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in batch.column(c)]).astype(np.int64)
        return Block(keys, flat("total", np.int64), flat("sizes", np.int32), flat("next", np.int64), flat("n", np.int32))

    def after(self, other: Block | None) -> Block:
        if other is None:
            return self
        return Block(np.concatenate([other.keys, self.keys], 1), *[np.concatenate([getattr(x, c) for x in (other, self)]) for c in ("total", "sizes", "following", "n")])

    def merged(self) -> Block:
        """Stripes with equal keys as one, elementwise."""
        order = np.lexsort(self.keys)
        keys = self.keys[:, order]
        new = np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0))
        begin = np.flatnonzero(new)
        stripe = np.empty(len(order), np.int64)
        stripe[order] = np.cumsum(new) - 1
        owner = np.repeat(stripe, self.sizes)
        order_, following, n = np.lexsort((self.following, owner)), self.following, self.n
        owner, following, n = owner[order_], following[order_], n[order_]
        if len(owner):
            first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (following[1:] != following[:-1])))
            owner, following, n = owner[first], following[first], np.add.reduceat(n, first)
        return Block(keys[:, begin], np.add.reduceat(self.total[order], begin), np.bincount(owner, minlength=len(begin)), following, n)

    def frequent(self) -> Block:
        """Stripes and extensions found LEAST times or more."""
        kept = self.n >= LEAST
        owner = np.repeat(np.arange(len(self.total)), self.sizes)[kept]
        slim = Block(self.keys, self.total, np.bincount(owner, minlength=len(self.total)), self.following[kept], self.n[kept])
        return slim.chosen(np.flatnonzero(self.total >= LEAST))

    def rows(self, length: int) -> pa.RecordBatch:
        owner = np.repeat(np.arange(len(self.total)), self.sizes)
        offsets = pa.array(np.append(0, np.cumsum(self.sizes)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int64())) for v in (self.following, self.n, pair_slots(self.keys[0][owner], self.following))]
        second = pa.nulls(len(self.total), pa.int64()) if length == 1 else pa.array(self.keys[1])
        return pa.record_batch([pa.array(self.keys[0]), second, pa.array(self.keys[2].astype(np.int32)), pa.array(self.total), *lists], [c.split()[0] for c in STRIPE.split(", ")])


def stripes(docs: DataFrame, known: np.ndarray, hot: np.ndarray, length: int, buckets: int) -> DataFrame:
    """Unmerged stripes of prefixes of one or two words, packed by bucket. known: a bitmap of frequent words, or of frequent two-word phrases; hot: slots or ids of split prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, _ in pieces(batch):
                if length == 1:
                    fine = in_slots(known, p.ids)
                    owners, prefix = np.unique(p.ids[fine], return_inverse=True)
                    at = np.full(len(p.ids), -1, np.int64)
                    at[fine] = prefix
                    here = np.flatnonzero(fine)
                    here = here[p.goes_on[here]]
                    here = here[fine[here + 1]]
                    following, first, second = at[here + 1], owners, None
                    names, is_hot = owners, np.isin(owners, hot)
                else:
                    starts = np.flatnonzero(p.goes_on)
                    slot = pair_slots(p.ids[starts], p.ids[starts + 1])
                    fine = in_slots(known, slot)
                    starts, slot = starts[fine], slot[fine]
                    owners, index, prefix = np.unique(slot, return_index=True, return_inverse=True)
                    at = np.full(len(p.ids) + 1, -1, np.int64)
                    at[starts] = prefix
                    here = starts[at[starts + 1] >= 0]
                    names, following = np.unique(p.ids[here + 2], return_inverse=True)
                    first, second = p.ids[starts[index]], p.ids[starts[index] + 1]
                    is_hot = np.isin(owners, hot)
                total = np.bincount(prefix, minlength=len(owners))
                code, n = np.unique(at[here] * max(len(names), 1) + following, return_counts=True)
                owner, following = code // max(len(names), 1), code % max(len(names), 1)
                if len(owners):
                    yield Block.counted(first, second, total, owner, names[following], n, is_hot).packed(buckets)

    return docs.mapInArrow(run, PACKED)


def merged(packed: DataFrame, length: int, buckets: int) -> DataFrame:
    """Each key's stripes merged elementwise; stripes and extensions below LEAST go. A bucket is a few million words' stripes, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = None, None
        for batch in batches:
            numbers = batch.column("bucket").to_numpy()
            bounds = np.append(np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])), len(numbers))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if held is not None and numbers[a] != bucket:
                    yield held.merged().frequent().rows(length)
                    held = None
                held, bucket = Block.unpacked(batch.slice(a, b - a)).after(held), numbers[a]
        if held is not None:
            yield held.merged().frequent().rows(length)

    return packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, STRIPE)


def _exact(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)) of counts below 10^15, exact in decimals of 38 digits; at most 1000000, as a is within l and r."""
    whole = lambda c: f"cast({c} as decimal(15,0))"
    return F.expr(f"cast((cast(1000000 as decimal(7,0)) * {whole(a)} * {whole(a)}) div ({whole(l)} * {whole(r)}) as bigint)")


def candidates(one: DataFrame, two: DataFrame) -> DataFrame:
    """w1, w2, w3 (null in two words), a, l, r, score of all candidates that no longer one holds, from merged stripes of one- and two-word prefixes."""
    totals = one.filter("part = 0").select(F.col("w1").alias("word"), F.col("total").alias("f"))
    entry = F.explode(F.arrays_zip("next", "n")).alias("x")
    pairs = stored(one.select("w1", F.col("total").alias("l"), entry).select("w1", F.col("x.next").alias("w2"), F.col("x.n").alias("a"), "l"), "two-words")
    triples = stored(two.select("w1", "w2", F.col("total").alias("l2"), entry).select("w1", "w2", F.col("x.next").alias("w3"), F.col("x.n").alias("a"), "l2"), "three-words")
    of = lambda name, at: totals.select(F.col("word").alias(at), F.col("f").alias(name))
    scored = pairs.join(of("r", "w2"), "w2").withColumn("score", _exact("a", "l", "r"))
    before = two.groupBy("w1", "w2").agg(F.max(F.array_max("n")).alias("more"))  # of its own stripe
    after = triples.groupBy(F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("more"))  # of the stripes that end in it
    held = before.unionByName(after).filter("more is not null").groupBy("w1", "w2").agg(F.max("more").alias("more"))
    free = scored.join(held, ["w1", "w2"], "left").filter(f"more is null or 100 * more < {INSIDE} * a")
    cut = triples.join(pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1")), ["w2", "w3"]).join(of("l1", "w1"), "w1").join(of("r2", "w3"), "w3")
    cut = cut.withColumns({"s1": _exact("a", "l1", "r1"), "s2": _exact("a", "l2", "r2")})
    first = F.col("s1") <= F.col("s2")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    longer = cut.select("w1", "w2", "w3", "a", pick("l1", "l2").alias("l"), pick("r1", "r2").alias("r"), pick("s1", "s2").alias("score"))
    return free.select("w1", "w2", F.lit(None).cast("long").alias("w3"), "a", "l", "r", "score").unionByName(longer)


def ranked(found: DataFrame, words: DataFrame, best: int = BEST) -> DataFrame:
    """The best phrases of each language as text. Parts of a language are cut first, so that none is sorted whole."""
    named = words.filter("id is not null")
    of = lambda i: named.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"t{i}"), *([F.col("lang")] if i == 1 else []))
    spelled = found.join(of(1), "w1").join(of(2), "w2").join(of(3), "w3", "left").withColumn("phrase", F.concat_ws(" ", "t1", "t2", "t3"))
    order = lambda *more: F.row_number().over(Window.partitionBy("lang", *more).orderBy(F.desc("score"), F.desc("a"), "phrase"))
    part = spelled.withColumn("part", F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(PARTS))).withColumn("rank", order("part")).filter(F.col("rank") <= best)
    top = part.withColumn("rank", order()).filter(F.col("rank") <= best)
    n = words.filter("id is null").select("lang", F.col("n").alias("n"))
    return top.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, best: int = BEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two and three words of each language.

    Null texts and texts without words count nothing; a null lang is 'und'. Every row counts, repeated ones and ones without
    doc_id too; further columns are ignored. An empty table, or one without a phrase found ten times, gives no rows. Of equal scores the
    more frequent phrase comes first, then the lesser one by its UTF-8 bytes.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    words = word_counts(texts)
    total = words.filter("id is null").agg(F.sum("n")).first()[0] or 0
    common = words.filter((F.col("id").isNotNull()) & (F.col("n") * HOT >= total)).select("id").toArrow()["id"].to_numpy()  # HOT rows at most
    buckets = max(BUCKETS, total // IN_BUCKET)
    known = slot_bitmap(words.filter("id is not null").select("id"))
    one = stored(merged(stripes(texts, known, common, 1, buckets), 1, buckets), "stripes")
    entries = one.select(F.explode(F.arrays_zip("slots", "n")).alias("x")).select(F.col("x.slots").alias("slot"), F.col("x.n").alias("n"))
    common = entries.filter(F.col("n") * HOT >= total).select("slot").toArrow()["slot"].to_numpy()  # HOT rows at most
    two = stored(merged(stripes(texts, slot_bitmap(entries.select("slot")), common, 2, buckets), 2, buckets), "stripes")
    return ranked(candidates(one, two), words, best)
