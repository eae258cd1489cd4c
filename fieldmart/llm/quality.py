"""Quality rules: a linear-chain conditional random field labels every line as content or boilerplate.

Lines have binary features; the field is fitted by gradient ascent on the likelihood of labelled documents, all lines
of a good document counting as content and all lines of a bad one as boilerplate. Viterbi decoding gives each
document's labels; the share of its words in content lines decides, after two fixed rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import SPACED, Chunk, U, chunks, grams, mixed, span_hashes, sums_by

#: Labelled documents that the field is fitted on at most (the least hashes of their ids), with so many lines at most.
SAMPLE, SAMPLE_LINES = 4096, 128
CONTENT_SHARE = 0.5
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
FEATURES = ("any", "words", "many_words", "symbols", "bars", "upper", "digits", "sentence", "duplicate", "repeats", "shouts", "end")
#: Used where no labels are at hand: weights of content for each feature, and of equal neighbours.
PRIOR = (np.array([0.2, 0.5, 0.3, -3.0, -3.0, -3.0, -1.0, 1.0, -1.0, -3.0, -2.0, 0.0]), np.array([[0.5, -0.5], [-0.5, 0.5]]))


def measured(chunk: Chunk) -> dict[str, np.ndarray]:
    """Counts of each document, and of its lines: their words, features (a bit mask) and where each document's begin."""
    data, n = chunk.data, chunk.hi - chunk.lo
    words = chunk.words(SPACED, lower=False)
    size = len(data)
    char = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbol = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
    # three-word windows found twice or more in their document
    got, at, begin = grams(words.hashes(), words.first, 3)
    with np.errstate(over="ignore"):
        keys = mixed(got + np.repeat(np.arange(n, dtype=np.uint64), np.diff(begin)) * U(0x9E3779B97F4A7C15))
    _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = at[counts[back] > 1]
    repeat = np.zeros(len(words.start) + 2, bool)
    for j in range(3):
        repeat[again + j] = True
    repeat = repeat[: len(words.start)]
    # lines: a document of m newlines has m + 1
    newline = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([chunk.bounds[:-1], newline + 1]))
    per_doc = np.searchsorted(newline, chunk.bounds)
    lines = np.concatenate([[0], np.cumsum(np.diff(per_doc) + 1)])
    if len(newline):  # a newline at the end of a document begins a line there, before the next document's first
        order = np.lexsort((np.concatenate([np.arange(n), np.repeat(np.arange(n), np.diff(per_doc))]), np.concatenate([chunk.bounds[:-1], newline + 1])))
        start = np.concatenate([chunk.bounds[:-1], newline + 1])[order]
    owner = np.repeat(np.arange(n), np.diff(lines))
    end = np.empty_like(start)
    end[:-1] = start[1:] - 1
    end[lines[1:] - 1] = chunk.bounds[1:]
    in_line = np.searchsorted(words.start, np.concatenate([start, [size]]))
    n_words = np.searchsorted(words.start, end) - in_line[:-1]
    filled = n_words > 0
    with np.errstate(over="ignore"):
        line_keys = mixed(span_hashes(data, start, end) + owner.astype(np.uint64) * U(0x9E3779B97F4A7C15))
    _, first_at, line_back, line_counts = np.unique(line_keys, return_index=True, return_inverse=True, return_counts=True)
    duplicate = filled & (line_counts[line_back] > 1)
    later = filled.copy()
    later[first_at] = False
    share = lambda flags: (c := np.concatenate([[0], np.cumsum(flags)]))[end] - c[start]
    length = np.maximum(end - start, 1)
    repeated = np.concatenate([[0], np.cumsum(repeat)])
    stops = np.isin(data, list(b".!?"))
    last = np.where(filled, words.end[np.maximum(in_line[:-1] + n_words - 1, 0)] - 1 if len(words.end) else 0, 0)
    flags = [
        np.ones(len(start), bool), n_words >= 5, n_words >= 20, 20 * (symbol[end] - symbol[start]) > length, share(data == 0x7C) * 5 > n_words * 2,
        2 * share((data >= 0x41) & (data <= 0x5A)) > length * 0.6, 5 * share((data >= 0x30) & (data <= 0x39)) > length, filled & (stops[last] if size else False),
        duplicate, 2 * (repeated[in_line[:-1] + n_words] - repeated[in_line[:-1]]) > n_words, 4 * share(data == 0x21) > n_words, np.isin(np.arange(len(start)), lines[1:] - 1),
    ]
    mask = sum(f.astype(np.int32) << i for i, f in enumerate(flags))
    in_word = SPACED[data]
    return {
        "n_words": words.counts, "word_chars": sums_by(chunk.bounds, ((data & 0xC0) != 0x80) & in_word), "n_symbols": symbol[chunk.bounds[1:]] - symbol[chunk.bounds[:-1]],
        "n_dup_lines": sums_by(lines, later), "n_repeat_words": sums_by(words.first, repeat), "lines": lines, "line_words": n_words, "mask": mask, "chars": char,
    }


def _bits(mask: np.ndarray) -> np.ndarray:
    return ((mask[..., None] >> np.arange(len(FEATURES))) & 1).astype(np.float64)


def fit(masks: list[np.ndarray], labels: np.ndarray, steps: int = 60, rate: float = 0.5, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights of content for each feature, and of neighbouring labels, by gradient ascent with forward-backward sums."""
    order = np.argsort([-len(m) for m in masks], kind="stable")
    longest = len(masks[order[0]])
    padded = np.zeros((len(masks), longest), np.int32)
    for row, i in enumerate(order):
        padded[row, : len(masks[i])] = masks[i]
    n = np.array([len(masks[i]) for i in order])
    live = np.array([int((n > t).sum()) for t in range(longest)])
    x, y, valid = _bits(padded), labels[order], np.arange(longest) < n[:, None]
    weights, pairs = np.zeros(len(FEATURES)), np.zeros((2, 2))
    balance = np.where(y == 1, 0.5 / max((y == 1).mean(), 1e-9), 0.5 / max((y == 0).mean(), 1e-9))
    total = (valid * balance[:, None]).sum()
    for step in range(steps):
        up = np.stack([-(x @ weights) / 2, (x @ weights) / 2], -1)
        forward, backward = np.zeros_like(up), np.zeros_like(up)
        forward[:, 0] = up[:, 0]
        for t in range(1, longest):
            m = live[t]
            before = forward[:m, t - 1, :, None] + pairs
            forward[:m, t] = np.logaddexp(before[:, 0], before[:, 1]) + up[:m, t]
        both = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            m = live[t + 1]
            after = pairs + (up[:m, t + 1] + backward[:m, t + 1])[:, None, :]
            backward[:m, t] = np.logaddexp(after[..., 0], after[..., 1])
            joint = forward[:m, t, :, None] + after
            joint = np.exp(joint - joint.max((1, 2), keepdims=True))
            joint /= joint.sum((1, 2), keepdims=True)
            target = np.zeros((m, 2, 2))
            target[np.arange(m), y[:m], y[:m]] = 1
            both += ((target - joint) * balance[:m, None, None]).sum(0)
        chance = forward + backward
        content = 1.0 / (1.0 + np.exp(np.clip(chance[..., 0] - chance[..., 1], -35, 35)))
        pull = (y[:, None] - content) * valid * balance[:, None]
        speed = rate * 20 / (1 + step / 20)
        weights += speed * (np.einsum("dt,dtf->f", pull, x) / total - l2 * weights)
        pairs += speed * 0.1 * (both / total - l2 * pairs)
    return weights, pairs


def viterbi(mask: np.ndarray, lines: np.ndarray, weights: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The best label of every line; all documents of a chunk go forward line by line, together."""
    gain = _bits(np.arange(1 << len(FEATURES))) @ weights
    up = np.stack([-gain[mask] / 2, gain[mask] / 2], -1)
    counts = np.diff(lines)
    order = np.argsort(-counts, kind="stable")
    begin, counts = lines[:-1][order], counts[order]
    longest = int(counts[0]) if len(counts) else 0
    live = np.searchsorted(-counts, -np.arange(longest), "left")  # documents with more than t lines
    back = np.zeros((len(mask), 2), np.int8)
    best = up[begin].copy()
    final = best.copy()
    for t in range(1, longest):
        m = live[t]
        at = begin[:m] + t
        through = best[:m, :, None] + pairs
        back[at] = through.argmax(1)
        best = through.max(1) + up[at]
        final[:m] = best
    out = np.zeros(len(mask), np.int8)
    label = final.argmax(1)
    for t in range(longest - 1, -1, -1):
        m = live[t]
        at = begin[:m] + t
        out[at] = label[:m]
        label[:m] = back[at, label[:m]]
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Fits on ``sample`` labelled documents at most; PRIOR where there are not both kinds."""
    known = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("quality").cast("int").alias("quality")).filter("l_id is not null and quality in (0, 1)")
    known = known.groupBy("l_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("l_id"), "l_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(known), F.col("doc_id") == F.col("l_id")).select("doc_id", "quality", "text")  # at most ``sample`` ids

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                found = measured(chunk)
                lists = pa.ListArray.from_arrays(pa.array(found["lines"], pa.int32()), pa.array(found["mask"], pa.int32()))
                yield pa.record_batch([batch.column("doc_id").slice(chunk.lo, chunk.hi - chunk.lo), batch.column("quality").slice(chunk.lo, chunk.hi - chunk.lo), lists], ["doc_id", "quality", "lines"])

    table = rows.mapInArrow(lines, "doc_id long, quality int, lines array<int>").filter(F.size("lines") <= SAMPLE_LINES)
    table = table.orderBy("doc_id", "quality", "lines").limit(sample).toArrow()  # ids may repeat; ``sample`` rows at most come here
    got = list(zip(table["doc_id"].to_pylist(), table["quality"].to_pylist(), table["lines"].to_pylist(), strict=True))
    if len({q for _, q, _ in got}) < 2:
        return PRIOR
    return fit([np.array(m, np.int32) for _, _, m in got], np.array([q for _, q, _ in got]))


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"


def judge(docs: DataFrame, field: tuple[np.ndarray, np.ndarray], share: float = CONTENT_SHARE) -> DataFrame:
    """One row for each row of docs, see SCHEMA. Null, empty and wordless texts have counts 0, share 0 and are not kept.

    Repeated rows and ids are judged each by its own text, whole however long; of labellings that tie the one with
    boilerplate first counts; an empty table gives no rows; further columns are ignored.
    """
    weights, pairs = field

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                m = measured(chunk)
                content = viterbi(m["mask"], m["lines"], weights, pairs)
                part = sums_by(m["lines"], m["line_words"] * content) / np.maximum(m["n_words"], 1)
                failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])
                counts = [pa.array(m[c], pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                yield pa.record_batch([batch.column("doc_id").slice(chunk.lo, chunk.hi - chunk.lo), *counts, pa.array(failed), pa.array(part), pa.array(~failed & (part >= share))], [f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``judge`` with a field fitted on the labelled documents, or PRIOR if labels are empty or of one kind."""
    return judge(docs, train(docs, labels))
