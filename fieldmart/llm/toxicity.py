"""Toxicity: logistic regression over hashed word n-grams, skip-grams and word stems, fitted by FTRL-proximal.

Each coordinate has its own learning rate and L1 keeps most weights at exactly zero, so that the model is a short list
of (index, weight) and goes to the tasks as a small broadcast, at most FEATURES entries. One task fits it, on a sample whose
rows and features are bounded; only the weights go to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod
from .text import ALNUM, Chunk, U, chunks, mixed, span_hashes

#: Hashed features, and the labelled rows that a model is fitted on at most (the least hashes of their ids), and how many
#: distinct features these may have together: the row that passes it ends the sample.
FEATURES = 1 << 20
SAMPLE, SAMPLE_FEATURES = 8192, 1 << 25
THRESHOLD = 0.7
#: Bytes of the stems, the beginnings of longer words: inflected forms share them.
STEMS = (4, 6)
FOLDS, HELD_OUT = 3, 1


def features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Document and index of each word, its stems, each pair of neighbours, and each pair with one word between."""
    words = chunk.words(ALNUM)
    hashes, docs = words.hashes(), words.docs()
    ids, owners = [hashes], [docs]
    for stem in STEMS:
        long = words.end - words.start > stem
        ids.append(span_hashes(words.data, words.start[long], words.start[long] + stem) ^ U(stem))
        owners.append(docs[long])
    with np.errstate(over="ignore"):
        for gap in (1, 2):
            same = docs[gap:] == docs[:-gap]
            ids.append(mixed(hashes[:-gap] * U(2 * gap + 1) + hashes[gap:])[same])
            owners.append(docs[gap:][same])
    return np.concatenate(owners), (np.concatenate(ids) & U(FEATURES - 1)).astype(np.int64)


def fit(examples: list[tuple[np.ndarray, int]], epochs: int = 8, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.5, l2: float = 0.01) -> tuple[np.ndarray, np.ndarray, float]:
    """Indices, weights and bias of the non-zero coordinates; examples are (distinct indices, label)."""
    z, n = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    weigh = lambda i: np.where(np.abs(z[i]) > l1, -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2), 0.0)
    for _ in range(epochs):
        for found, label in examples:
            at = np.append(found, FEATURES)
            w = weigh(at)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            root = np.sqrt(n[at])
            z[at] += g - (np.sqrt(n[at] + g * g) - root) / alpha * w
            n[at] += g * g
    w = weigh(np.arange(FEATURES + 1))
    at = np.flatnonzero(w[:-1])
    return at.astype(np.int64), w[at], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = SAMPLE_FEATURES) -> tuple[np.ndarray, np.ndarray, float]:
    """Fits on labelled rows outside the held-out fold, ``sample`` at most; with one class or none, a model of zeros.

    The rows come in the order of a hash of their ids, rows of one id by their features, so that the fit is the same in
    every run. Ids with several labels count as toxic if one of them does. Null and empty texts are rows without features.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("toxic").cast("int").alias("toxic")).filter("l_id is not null and toxic in (0, 1)")
    known = known.filter(crc_mod(F.col("l_id"), FOLDS) != HELD_OUT).groupBy("l_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("l_id"), "l_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(known), F.col("doc_id") == F.col("l_id")).select("doc_id", "toxic", "text")  # at most ``sample`` ids

    def indices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                owner, index = features(chunk)
                pairs = np.unique(owner * (FEATURES * 2) + index)
                begin = np.searchsorted(pairs // (FEATURES * 2), np.arange(chunk.hi - chunk.lo + 1))
                lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(pairs % (FEATURES * 2), pa.int32()))
                yield pa.record_batch([batch.column("doc_id").slice(chunk.lo, chunk.hi - chunk.lo), batch.column("toxic").slice(chunk.lo, chunk.hi - chunk.lo), lists], ["doc_id", "toxic", "found"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples, held = [], 0
        for batch in batches:
            lists, toxic = batch.column("found"), batch.column("toxic").to_numpy()
            begin, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            for i, label in enumerate(toxic.tolist()):
                if len(examples) < sample and held < most:
                    examples.append((values[begin[i] : begin[i + 1]].astype(np.int32), label))
                    held += len(examples[-1][0])
        if len({label for _, label in examples}) == 2:
            at, weights, bias = fit(examples)
            yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(weights, bias))], ["at", "weight"])

    lists = rows.mapInArrow(indices, "doc_id long, toxic int, found array<int>").withColumn("key", F.xxhash64("doc_id"))
    # the sample alone: ``sample`` ids; what repeated ids add is read to the end but not held
    lists = lists.repartition(1).sortWithinPartitions("key", "doc_id", F.size("found"), "found")
    model = lists.select("toxic", "found").mapInArrow(fitted, "at long, weight double").toArrow()  # FEATURES + 1 rows at most
    at, weights = model["at"].to_numpy(), model["weight"].to_numpy()
    return at[at >= 0], weights[at >= 0], float(weights[at < 0].sum())


def _scores(text: pa.Array, dense: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(text), bias)
    for chunk in chunks(text):
        owner, index = features(chunk)
        hit = np.flatnonzero(dense[index])
        pairs = np.unique(owner[hit] * FEATURES + index[hit])
        out[chunk.lo : chunk.hi] += np.bincount(pairs // FEATURES, dense[pairs % FEATURES].astype(np.float64), minlength=chunk.hi - chunk.lo)
    return 1.0 / (1.0 + np.exp(-np.clip(out, -35, 35)))


def _dense(at: np.ndarray, weights: np.ndarray) -> np.ndarray:
    dense = np.zeros(FEATURES, np.float32)
    dense[at] = weights
    return dense


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """doc_id and ``score``, the probability of label 1 for the whole text. Null and empty texts get that of no features."""
    at, weights, bias = model

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = _dense(at, weights)
        for batch in batches:
            yield pa.record_batch([batch.column("doc_id"), pa.array(_scores(batch.column("text"), dense, bias))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scored, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    return crc_mod(doc_id, FOLDS) == HELD_OUT


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted. Rows of a repeated doc_id are scored by their own texts.

    Null, empty and wordless texts get the score of no features; equal texts get equal scores; texts of any length are
    scored whole. An empty docs table gives no rows, an empty labels table 0.5 everywhere. Further columns are ignored.
    """
    rows = score(docs, train(docs, labels))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the documents predicted toxic; all columns stay, whatever their names.

    Each row goes or stays by its own text, repeated rows and ids alike. Null, empty and wordless texts have the score of no
    features, so they stay unless most of the labelled documents are toxic. An empty table gives none.
    """
    at, weights, bias = train(docs, labels)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = _dense(at, weights)
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column("text"), dense, bias) < THRESHOLD))

    return docs.mapInArrow(kept, docs.schema)
