"""Language-model scores by online logistic context mixing.

A text is a sequence of bytes, A-Z lower-cased, and an end; each is the path of bits to it in a Huffman tree over the training
bytes, so that the product of its bits' probabilities is a probability over all texts. Predictors look up hashed
contexts (the last three bytes, all so far of the word, that with the word before) with the node of the tree in tables of bit
counts, which all training texts fill. A text is scored from its beginning to its end: the predictors' logits are added with the
weights that a gate picks (how far into a word, which predictors know their context), and the weights follow the error
through the whole text. They do so after stretches that lengthen with the place in the text (STRETCH, LONGER), so that
the texts of a chunk go side by side in few steps; a score depends on nothing but the text and the tables.

A piece is a word with the byte that closes it, or a lone white space or end. Equal pieces have equal bits and contexts but
for the word before, so each different piece of a chunk is prepared once. The tables have a fixed number of slots and so may
go to every task. Word counts have none: they are joined to groups of texts by the words that each group holds.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, stored
from .text import CHUNK, LOWERED, SPACED, U, Words, chunks, mixed, span_hashes, sums_by

FOLDS, HELD_OUT = 7, 2
END = 256
#: Bits of the slot numbers of the tables: last three bytes, word so far, word before and word so far.
BITS = (20, 22, 22)
BASES = tuple(sum(1 << b for b in BITS[:i]) for i in range(len(BITS)))
SLOTS = sum(1 << b for b in BITS)
#: What is added to the counts of either bit; logits are kept as bytes in steps of LOGIT.
LEAST_COUNT, LOGIT = 0.4, 0.1
#: Bits of the first stretch between two changes of a text's weights, and how much longer each is than the one before.
STRETCH, LONGER = 64, 1.2
#: A weight moves by its gradient over FIRM and this much for every bit that its gate has seen.
FIRM, CURVATURE = 30.0, 0.3
#: A piece is cut before these symbols; a gate holds for a part. It has four cells for each: do the last two predictors know the part's context?
CUTS = (0, 2, 5)
#: First weights of the predictors where neither of the last two is known, the second is, the third is, both are.
FIRST = ((1.0, 0.0, 0.0), (0.25, 0.85, 0.0), (0.4, 0.0, 0.7), (0.05, 0.6, 0.55))
#: Slots in one row of the tables as they are summed; tasks whose rows are summed together; input splits whose bits one task counts.
PIECE, TASKS, SPLITS = 4096, 64, 16
#: Bytes of texts that go side by side, and of those whose words are looked up together; bits that are worked on at a time.
SIDE_BY_SIDE, TOGETHER, AT_A_TIME = 2 * CHUNK, 8 * CHUNK, 1 << 16
_SEED = np.array([0x2545F491, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length of each of 257 codes, and for each symbol and place of its code the tree's node (-1: none) and the bit."""
    heap = [(int(c) + 1, i, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    children: dict[int, tuple[int, int]] = {}
    for new in range(len(counts), 2 * len(counts) - 1):
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        children[new] = (a[2], b[2])
        heapq.heappush(heap, (a[0] + b[0], new, new))
    paths: list[list[tuple[int, int]]] = [[] for _ in counts]
    waiting = [(heap[0][2], [])]
    while waiting:
        node, path = waiting.pop()
        if node < len(counts):
            paths[node] = path
        else:
            waiting += [(child, [*path, (node - len(counts), bit)]) for bit, child in enumerate(children[node])]
    longest = max(map(len, paths))
    nodes, bits = np.full((len(counts), longest), -1, np.int16), np.zeros((len(counts), longest), np.uint8)
    for s, path in enumerate(paths):
        for j, (node, bit) in enumerate(path):
            nodes[s, j], bits[s, j] = node, bit
    return np.array([len(p) for p in paths], np.int32), nodes, bits


@dataclass
class Pieces:
    """The pieces of a chunk's texts in order: whose and which each is; the different ones: hash, times, symbols end to end."""

    owner: np.ndarray
    which: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    begin: np.ndarray


def pieces(words: Words) -> Pieces:
    chunk = words.chunk
    n, size = len(chunk.bounds) - 1, len(chunk.data)
    docs = words.docs()
    closing = np.full(len(docs), END)
    closed = words.end < chunk.bounds[docs + 1]
    closing[closed] = words.data[words.end[closed]]
    lone = ~SPACED[words.data]
    lone[words.end[closed]] = False
    gaps = np.flatnonzero(lone)
    last = chunk.bounds[1:] - 1
    ends = np.flatnonzero((np.diff(chunk.bounds) == 0) | ~SPACED[words.data[np.maximum(last, 0)]] if size else np.ones(n, bool))
    gap_docs = np.searchsorted(chunk.bounds, gaps, "right") - 1
    # every text has a place for its end after its bytes
    place = np.concatenate([words.start + docs, gaps + gap_docs, chunk.bounds[1:][ends] + ends])
    order = np.argsort(place, kind="stable")
    owner = np.concatenate([docs, gap_docs, ends])[order]
    word = np.concatenate([np.arange(len(docs)), np.full(len(gaps), -1), np.full(len(ends), -2)])[order]
    with np.errstate(over="ignore"):
        alone = mixed(np.concatenate([words.data[gaps].astype(np.uint64), np.full(len(ends), END, np.uint64)]) + U(0x51ED270B))
        key = np.concatenate([words.hashes() + mixed(closing.astype(np.uint64) + U(1)), alone])[order]
    hashes, first, which, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    w = word[first]
    v = np.maximum(w, 0)
    length = np.where(w >= 0, words.end[v] - words.start[v] + 1 if len(docs) else 1, 1)
    begin = np.concatenate([[0], np.cumsum(length)])
    symbols = np.empty(begin[-1], np.int32)
    body = np.where(w >= 0, length - 1, 0)
    at = np.arange(body.sum()) - np.repeat(np.cumsum(body) - body, body)
    if len(docs):
        symbols[np.repeat(begin[:-1], body) + at] = words.data[np.repeat(words.start[v], body) + at]
        final = closing[v]
    else:
        final = np.full(len(w), END)
    places = place[order][first]
    gap_symbol = words.data[np.minimum(places - owner[first], max(size - 1, 0))] if size else np.zeros(len(w), np.uint8)
    symbols[begin[1:] - 1] = np.where(w >= 0, final, np.where(w == -2, END, gap_symbol))
    return Pieces(owner, which, hashes, counts, symbols, begin)


class Coder:
    """Bits and contexts of pieces."""

    def __init__(self, counts: np.ndarray):
        self.lengths, nodes, bits = huffman(counts)
        self.longest = nodes.shape[1]
        self.nodes, self.bits = nodes.ravel(), bits.ravel()
        n = np.arange(257, dtype=np.uint32)
        with np.errstate(over="ignore"):
            n = (n + np.uint32(1)) * np.uint32(0x9E3779B1)
            n ^= n >> np.uint32(15)
            self.node_hash = n * np.uint32(0x85EBCA77)
            self.node_hash ^= self.node_hash >> np.uint32(13)

    def contexts(self, symbols: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
        """A 32-bit hash of the contexts of each symbol: last three, word so far. None goes back beyond its piece."""
        n = len(symbols)
        start = np.repeat(begin[:-1], np.diff(begin))
        place = np.arange(n) - start
        last = []
        for k in (1, 2, 3):
            x = np.full(n, 0x1FF, np.uint32)
            x[k:] = symbols[:-k] if k < n else 0
            x[place < k] = 0x1FF
            last.append(x)
        with np.errstate(over="ignore"):
            data = np.where(symbols == END, 0, symbols).astype(np.uint8)
            so_far = span_hashes(data, start, np.arange(n)).astype(np.uint32) if n else np.zeros(0, np.uint32)
            return [_spread(x ^ seed) for x, seed in zip((last[0] | last[1] << np.uint32(9) | last[2] << np.uint32(18), so_far), _SEED, strict=False)]

    def coded(self, p: Pieces) -> Coded:
        hashes = self.contexts(p.symbols, p.begin)
        size = self.lengths[p.symbols]
        first = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        where = np.repeat(p.symbols * self.longest, size) + np.arange(first[-1], dtype=np.int32) - np.repeat(first[:-1].astype(np.int32), size)
        node = self.node_hash[self.nodes[where]]
        keys = [np.repeat(h, size) ^ node for h in hashes]
        slots = [(k & np.uint32((1 << b) - 1)).astype(np.int32) + np.int32(base) for k, b, base in zip(keys, BITS, BASES, strict=False)]
        place = np.arange(len(p.symbols)) - np.repeat(p.begin[:-1], np.diff(p.begin))
        cut = np.flatnonzero(np.isin(place, CUTS))
        return Coded(self.bits[where], slots, keys[1], first[p.begin], np.searchsorted(cut, p.begin), first[np.append(cut, len(place))], np.searchsorted(CUTS, place[cut]))


@dataclass
class Coded:
    """Of the different pieces: each bit, its slots for two predictors and key for the third; where each piece's bits and parts begin; each part's first bit and depth."""

    bit: np.ndarray
    slots: list[np.ndarray]
    key: np.ndarray
    first: np.ndarray
    part: np.ndarray
    part_first: np.ndarray
    depth: np.ndarray


def _spread(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x * np.uint32(0xCC9E2D51)
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x1B873593)
        x ^= x >> np.uint32(15)
        return x


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[i]..begin[i]+size[i]-1 for all i, end to end."""
    ends = np.cumsum(size, dtype=np.int64)
    return np.arange(ends[-1] if len(ends) else 0, dtype=np.int32) + np.repeat((begin - ends + size).astype(np.int32), size)


def _before(p: Pieces) -> np.ndarray:
    """For each piece in order a hash of the one before it in its text."""
    out = _spread(p.hashes[p.which].astype(np.uint32) ^ _SEED[2])
    out[1:] = out[:-1]
    out[np.concatenate([[True], p.owner[1:] != p.owner[:-1]])] = _SEED[2]
    return out


def _third(key: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Slots of the third predictor."""
    with np.errstate(over="ignore"):
        x = (key + before) * np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
        return (x & np.uint32((1 << BITS[2]) - 1)).astype(np.int32) + np.int32(BASES[2])


def stretches(most: int) -> np.ndarray:
    """Where the stretches begin, the last at ``most`` bits or beyond."""
    out, width = [0], float(STRETCH)
    while out[-1] < most:
        out.append(out[-1] + int(width))
        width *= LONGER
    return np.array(out)


def _blocks(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of items of about AT_A_TIME bits together."""
    ends, at = np.cumsum(size), 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_A_TIME, "right")))
        yield at, to
        at = to


def text_costs(coder: Coder, table: np.ndarray, p: Pieces, n: int) -> np.ndarray:
    """Natural log of the mixed model's probability of each of the n texts, negated."""
    c = coder.coded(p)
    per_piece = np.diff(c.first)
    ends = np.cumsum(per_piece[p.which])
    at = ends - per_piece[p.which]
    texts = np.flatnonzero(np.concatenate([[True], p.owner[1:] != p.owner[:-1]]))
    at -= np.repeat(at[texts], np.diff(np.append(texts, len(at))))
    bounds = stretches(int(at.max()) + 1)
    stretch = (np.searchsorted(bounds, at, "right") - 1).astype(np.int16)
    order = np.argsort(stretch, kind="stable")
    which, owner, before = p.which[order], p.owner[order], _before(p)[order]
    steps = np.searchsorted(stretch[order], np.arange(len(bounds) + 1), "left")
    known = [table[slots] for slots in c.slots]
    wrong = (1 - c.bit).astype(np.float32)
    per_text, parts = 4 * len(CUTS), np.diff(c.part)
    weights = [np.tile(np.array(w) * LOGIT, len(CUTS) * n) for w in zip(*FIRST, strict=True)]
    seen, cost = np.full(per_text * n, FIRM, np.float64), np.zeros(n)
    for low, high in zip(steps[:-1], steps[1:], strict=True):
        pull, bits_seen = np.zeros((len(BITS), per_text * n)), np.zeros(per_text * n)
        for a, b in _blocks(per_piece[which[low:high]]):
            own = which[low + a : low + b]
            count, bits = parts[own], per_piece[own]
            source, part = _ranges(c.first[own], bits), _ranges(c.part[own], count)
            x = [k[source].astype(np.float32) for k in known]
            x.append(table[_third(c.key[source], np.repeat(before[low + a : low + b], bits))].astype(np.float32))
            first = c.part_first[part]
            size = c.part_first[part + 1] - first
            begin = np.cumsum(size) - size
            whose = np.repeat(owner[low + a : low + b], count)
            cell = whose * per_text + 4 * c.depth[part] + (x[1][begin] != 0) + 2 * (x[2][begin] != 0)
            z = np.zeros(len(source), np.float32)
            for v, w in zip(x, weights, strict=True):
                z += v * np.repeat(w[cell].astype(np.float32), size)
            np.clip(z, -14, 14, out=z)
            odds = np.exp(-z)
            odds += 1
            miss = wrong[source]
            cost += np.bincount(whose, np.add.reduceat(np.log(odds) + miss * z, begin), minlength=n)
            error = 1 - miss - 1 / odds
            bits_seen += np.bincount(cell, size, minlength=per_text * n)
            for i, v in enumerate(x):
                pull[i] += np.bincount(cell, np.add.reduceat(error * v, begin), minlength=per_text * n)
        seen += CURVATURE * bits_seen
        for w, g in zip(weights, pull, strict=True):
            w += LOGIT * LOGIT * g / seen
    return cost


def _byte_counts(train: DataFrame) -> np.ndarray:
    """How often each byte and the end occur in the training texts: one row for each task, then 257 longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(257, np.int64)
        for batch in batches:
            total[END] += batch.num_rows
            for chunk in chunks(batch.column("text")):
                total[:256] += np.bincount(LOWERED[chunk.data], minlength=256)
        yield pa.record_batch([pa.array(np.arange(257)), pa.array(total)], ["symbol", "n"])

    rows = train.select("text").mapInArrow(run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(257, np.int64)
    for r in rows:
        out[r.symbol] = r.n
    return out


def logits(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(np.log((ones + LEAST_COUNT) / (zeros + LEAST_COUNT)) / LOGIT, -127, 127)).astype(np.int8)


def count_bits(coder: Coder, p: Pieces, seen: np.ndarray) -> None:
    """Adds the bits of a chunk to seen, a zero count and a one count for each slot."""
    c = coder.coded(p)
    size = np.diff(c.first)
    times = np.repeat(p.counts.astype(np.int32), size)
    for slots in c.slots:
        np.add.at(seen, 2 * slots.astype(np.int64) + c.bit, times)
    before = _before(p)
    pair, pair_times = np.unique(p.which.astype(np.uint64) << U(32) | before.astype(np.uint64), return_counts=True)
    which, before, pair_times = (pair >> U(32)).astype(np.int64), (pair & U(0xFFFFFFFF)).astype(np.uint32), pair_times.astype(np.int32)
    for a, b in _blocks(size[which]):
        own = size[which[a:b]]
        source = _ranges(c.first[which[a:b]], own)
        np.add.at(seen, 2 * _third(c.key[source], np.repeat(before[a:b], own)).astype(np.int64) + c.bit[source], np.repeat(pair_times[a:b], own))


def _packed(seen: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Counts as one byte each, with the places and counts of those that need more."""
    at = np.flatnonzero(seen >= 255)
    return np.minimum(seen, 255).astype(np.uint8).tobytes(), at.astype(np.int32), seen[at].astype(np.int64)


def _rows(piece: list[int], part: list[int], packed: list[tuple[bytes, np.ndarray, np.ndarray]]) -> pa.Table:
    low, at, more = zip(*packed, strict=True)
    return pa.table([pa.array(piece, pa.int32()), pa.array(part, pa.int32()), pa.array(low, pa.binary()), pa.array(at, pa.list_(pa.int32())), pa.array(more, pa.list_(pa.int64()))], ["piece", "part", "low", "at", "more"])


def _total(table: pa.Table) -> np.ndarray:
    total = np.zeros(2 * PIECE, np.int64)
    for low in table["low"].to_pylist():
        total += np.frombuffer(low, np.uint8)
    at = table["at"].combine_chunks().flatten().to_numpy()
    np.add.at(total, at, table["more"].combine_chunks().flatten().to_numpy() - 255)
    return total


def bit_table(train: DataFrame, counts: np.ndarray) -> np.ndarray:
    """The logits of all slots, from the bits of all training texts. Tasks' counts are summed piece by piece, of many tasks in two levels."""
    text = train.select("text")
    splits = text.rdd.getNumPartitions()
    # a task brings SLOTS counts however few texts it reads, so a few splits share one
    tasks = max(1, min(splits, max(2 * train.sparkSession.sparkContext.defaultParallelism, splits // SPLITS)))
    schema = "piece int, part int, low binary, at array<int>, more array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, seen = Coder(counts), np.zeros(2 * SLOTS, np.int32)
        for batch in batches:
            for chunk in chunks(batch.column("text"), SIDE_BY_SIDE):
                count_bits(coder, pieces(chunk.words(SPACED)), seen)
        part = TaskContext.get().partitionId() // TASKS
        for piece in range(0, SLOTS, PIECE):
            own = seen[2 * piece : 2 * (piece + PIECE)]
            if own.any():
                yield from _rows([piece], [part], [_packed(own)]).to_batches()

    def add(table: pa.Table) -> pa.Table:
        return _rows([table["piece"][0].as_py()], [table["part"][0].as_py()], [_packed(_total(table))])

    def finish(table: pa.Table) -> pa.Table:
        total = _total(table)
        return pa.table([table["piece"].slice(0, 1), pa.array([logits(total[::2], total[1::2]).tobytes()], pa.binary())], ["piece", "logits"])

    rows = text.coalesce(tasks).mapInArrow(run, schema)
    if tasks > TASKS:
        rows = rows.groupBy("piece", "part").applyInArrow(add, schema)
    table = np.zeros(SLOTS, np.int8)
    # a byte for each of SLOTS
    for batch in rows.groupBy("piece").applyInArrow(finish, "piece int, logits binary").toArrow().to_batches():
        for piece, own in zip(batch.column("piece").to_pylist(), batch.column("logits").to_pylist(), strict=True):
            table[piece : piece + PIECE] = np.frombuffer(own, np.int8)
    return table


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
#: Rows of two kinds: a text (place in its group, score), or a word of a group (times in training texts, holders: place and times).
_PARTS = "group long, doc_id long, held_out boolean, place int, n_tokens long, n_bytes long, score double, word long, n long, holders binary"
_NAMES = [f.split()[0] for f in _PARTS.split(", ")]
#: A holder is 4 bytes: its place in the group and, in the low bits, how often it has the word; if more often, it comes again.
_TIMES = 10
#: Texts of a group at most, but for those of the batch that passes it.
_TEXTS = 1 << 20


def _word_rows(group: int, train: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """The words of a group of texts; found: hashes and places of all of its words."""
    word, place = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((place, word))
    word, place = word[order], place[order]
    new = np.concatenate([[True], (word[1:] != word[:-1]) | (place[1:] != place[:-1])]) if len(word) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(word)))
    word, place = word[at], place[at]
    begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else at
    n = np.add.reduceat(times * train[place], begin) if len(word) else times
    most = (1 << _TIMES) - 1
    more = -(-times // most)
    ends = np.cumsum(more)
    part = np.full(int(more.sum()), most)
    part[ends - 1] = times - (more - 1) * most
    held = (np.repeat(place, more) << _TIMES | part).astype(np.int32)
    offsets = 4 * np.append((ends - more)[begin], len(held)).astype(np.int32)
    lists = pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(held.tobytes())])
    none = pa.nulls(len(begin), pa.int64())
    return pa.record_batch([pa.array(np.full(len(begin), group)), none, none.cast(pa.bool_()), none.cast(pa.int32()), none, none, none.cast(pa.float64()), pa.array(word[begin].view(np.int64)), pa.array(n, pa.int64()), lists], _NAMES)


def _parts(base: DataFrame, counts: np.ndarray, table) -> DataFrame:
    """Scores of texts and words of groups of them, see _PARTS. A group has TOGETHER bytes, or a single longer text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task = Coder(counts), TaskContext.get().partitionId()
        group, held, train, found = 0, 0, [], []
        for batch in batches:
            fold = batch.column("held_out").to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column("text"), SIDE_BY_SIDE):
                words, n = chunk.words(SPACED), chunk.hi - chunk.lo
                if held and held + len(chunk.data) > TOGETHER or sum(map(len, train)) > _TEXTS:
                    yield _word_rows(task << 32 | group, np.concatenate(train), found)
                    group, held, train, found = group + 1, 0, [], []
                score = -text_costs(coder, table.value, pieces(words), n) / np.log(10)
                place = sum(map(len, train)) + np.arange(n)
                found.append((words.hashes(), place[words.docs()]))
                train.append(~fold[chunk.lo : chunk.hi])
                held += len(chunk.data)
                longs = [pa.array(x, pa.int64()) for x in (words.counts + 1, np.diff(chunk.bounds))]
                none = pa.nulls(n, pa.int64())
                own = [batch.column(c).slice(chunk.lo, n) for c in ("doc_id", "held_out")]
                yield pa.record_batch([pa.array(np.full(n, task << 32 | group)), *own, pa.array(place.astype(np.int32)), *longs, pa.array(score), none, none, pa.nulls(n, pa.binary())], _NAMES)
        if train:
            yield _word_rows(task << 32 | group, np.concatenate(train), found)

    return base.select("doc_id", "text", "held_out").mapInArrow(run, _PARTS)


def scores(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Null texts are empty: one token, the end. Without training texts all predictors say one half and the base score is 0
    less the logarithm of 1 for every token. Repeated rows and ids are texts of their own, equal texts get equal scores;
    texts of any length are scored whole. bits_per_byte counts the end's bits and is null for an empty text. An empty
    table gives no rows. Further columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), (crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"))
    train = base.filter("not held_out")
    counts = _byte_counts(train)
    table = base.sparkSession.sparkContext.broadcast(bit_table(train, counts))  # a byte for each of SLOTS
    parts = stored(_parts(base, counts, table), "scored")
    texts, words = parts.filter("place is not null"), parts.filter("place is null")
    known = stored(words.groupBy("word").agg(F.sum("n").alias("c")).filter("c > 0"), "words")
    ends, tokens = texts.filter("not held_out").agg(F.count("*"), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    distinct = known.count() + (ends > 0)
    rest = np.log10(tokens + distinct + 1)

    def joined(of: pa.Table, looked: pa.Table) -> pa.Table:
        n = of.num_rows
        place, size = of["place"].to_numpy(), of["n_tokens"].to_numpy()
        holders, c = looked["holders"].to_pylist(), looked["c"].to_numpy()
        each = np.repeat(np.log10(c + 1.0), np.array([len(h) // 4 for h in holders], np.int64))
        held = np.frombuffer(b"".join(holders), np.int32)
        times = held & ((1 << _TIMES) - 1)
        at = np.empty(n, np.int64)
        at[place] = np.arange(n)
        at = at[held >> _TIMES]
        base_score = np.bincount(at, times * each, minlength=n) + np.log10(ends + 1.0) - size * rest
        n_known = np.bincount(at, times, minlength=n).astype(np.int64) + (ends > 0)
        bytes_ = of["n_bytes"].to_numpy()
        per_byte = pa.array(-of["score"].to_numpy() / np.log10(2) / np.maximum(bytes_, 1), mask=bytes_ == 0)
        columns = [of["doc_id"], of["held_out"], of["n_tokens"], pa.array(n_known), pa.array(np.full(n, tokens)), pa.array(base_score), of["score"], per_byte]
        return pa.table(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    looked = words.select(F.col("group").alias("of"), "word", "holders").join(known, "word").select("of", "c", "holders")
    texts = texts.select("group", "doc_id", "held_out", "place", "n_tokens", "n_bytes", "score")
    return texts.groupBy("group").cogroup(looked.groupBy("of")).applyInArrow(joined, SCHEMA)
