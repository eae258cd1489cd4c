"""Alignment of two tokenizers' tokens over the same bytes.

Each text is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B); the tokens of both tile the bytes of
space + text. ``merge_asof``, keyed by document, finds for each token start the other side's covering token; both directions together
give all overlaps. Overlaps that end together are links, and the ends that both sides have cut the text into groups.
Counts of linked id pairs over the corpus come from one sum by pair; the most frequent TOP pairs then go to every task, all others are
joined, so that neither the pairs nor the links of a document need to fit anywhere.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .text import CHUNK, sums_by

#: So many of the most frequent id pairs are looked up in the tasks (17 bytes each); the rest are joined.
TOP = 1 << 18
#: Fixed value: how the byte-level vocabulary cuts a text into words.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REPORT = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Bytes and decimal text of every id, as arrays that whole id arrays look up."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        text = [str(i).encode() for i in range(len(tokens))]
        self.more, self.last = (np.array([t + end for t in text], object) for end in (b",", b"|"))
        self.final = np.array([t + b";" for t in text], object)

    def joined(self, ids: np.ndarray) -> bytes:
        length = self.length[ids]
        at = np.repeat(self.begin[ids] - np.concatenate([[0], np.cumsum(length)])[:-1], length)
        return self.flat[at + np.arange(len(at))].tobytes()


class ByteLevel(Vocabulary):
    """Ids of texts by the vocabulary file. Its merges are in the order of their ids, so that ids serve as ranks; otherwise its own library encodes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet, vocab = byte_alphabet(), spec["model"]["vocab"]
        special = {t["content"] for t in spec["added_tokens"]}
        tokens = {i: t.encode() if t in special else bytes(alphabet[c] for c in t) for t, i in vocab.items()}
        super().__init__([tokens.get(i, b"") for i in range(max(tokens) + 1)])
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        if all(vocab["".join(m)] == 256 + i for i, m in enumerate(merges)):
            import tiktoken

            self.encode = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks={tokens[i]: i for t, i in vocab.items() if t not in special}, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.encode_special_tokens = True
            self.encode = lambda text: own.encode(text, add_special_tokens=False).ids


class Pieces(Vocabulary):
    def __init__(self, path: str):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        size = own.get_piece_size()
        super().__init__([bytes([int(own.id_to_piece(i)[3:5], 16)]) if own.is_byte(i) else own.id_to_piece(i).replace("▁", " ").encode() for i in range(size)])
        self.encode = own.encode


@lru_cache(maxsize=1)
def _loaded(a: str, b: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(a), Pieces(b)


@dataclass
class Side:
    """The tokens of several documents: ids, the document of each, and where each begins and ends in the bytes of all documents together."""

    ids: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


def _side(vocabulary: Vocabulary, encoded: list[list[int]], base: np.ndarray) -> Side:
    counts = np.array([len(x) for x in encoded], np.int64)
    ids = np.fromiter((i for x in encoded for i in x), np.int64, int(counts.sum()))
    doc = np.repeat(np.arange(len(encoded)), counts)
    length = vocabulary.length[ids]
    end = np.cumsum(length)
    begin = np.concatenate([[0], np.cumsum(counts)])
    before = np.concatenate([[0], end])[begin[:-1]]
    end = end + np.repeat(base - before, counts)
    return Side(ids, doc, end - length, end)


def covering(left: Side, right: Side) -> np.ndarray:
    """For each token of left, the number of the token of right that covers its start."""
    a = pd.DataFrame({"start": left.start, "doc": left.doc})
    b = pd.DataFrame({"start": right.start, "doc": right.doc, "token": np.arange(len(right.ids))})
    return pd.merge_asof(a, b, on="start", by="doc")["token"].to_numpy().astype(np.int64)


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of all pairs whose byte ranges overlap, each pair once."""
    over_a, over_b = covering(a, b), covering(b, a)
    own = np.arange(len(b.ids))
    new = a.start[over_b] != b.start  # equal starts have been found from the other side
    return np.concatenate([np.arange(len(a.ids)), over_b[new]]), np.concatenate([over_a, own[new]])


@dataclass
class Aligned:
    """Sides of the texts that both vocabularies spell out, their links (token numbers), groups by token, and whether each text is among them."""

    a: Side
    b: Side
    link_a: np.ndarray
    link_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    n_groups: int
    spelled: np.ndarray


def align(texts: list[str | None], va: ByteLevel, vb: Pieces) -> Aligned:
    want = [(" " + t).encode() if t else b"" for t in texts]
    encoded = [(va.encode(" " + t), vb.encode(t)) if t else ([], []) for t in texts]
    spelled = np.array([bool(t) and all(v.joined(np.array(ids, np.int64)) == w for v, ids in zip((va, vb), pair, strict=True)) for t, w, pair in zip(texts, want, encoded, strict=True)], bool)
    size = np.where(spelled, [len(w) for w in want], 0)
    base = np.cumsum(size) - size
    a, b = (_side(v, [pair[i] if ok else [] for pair, ok in zip(encoded, spelled, strict=True)], base) for i, v in enumerate((va, vb)))
    ia, ib = overlaps(a, b)
    together = a.end[ia] == b.end[ib]
    ia, ib = ia[together], ib[together]
    order = np.lexsort((ib, ia))
    ia, ib = ia[order], ib[order]
    ends = np.unique(a.end[ia])
    return Aligned(a, b, ia, ib, np.searchsorted(ends, a.end), np.searchsorted(ends, b.end), len(ends), spelled)


def spelled_groups(x: Aligned, va: Vocabulary, vb: Vocabulary, n: int) -> list[bytes]:
    """'a1,a2|b1;a3|b2' of each of n documents."""
    first_b = np.searchsorted(x.group_b, np.arange(x.n_groups + 1))
    first_a = np.searchsorted(x.group_a, np.arange(x.n_groups + 1))
    parts = np.empty(len(x.a.ids) + len(x.b.ids), object)
    last = np.append(x.group_a[1:] != x.group_a[:-1], True) if len(x.group_a) else np.zeros(0, bool)
    parts[np.arange(len(x.a.ids)) + first_b[x.group_a]] = np.where(last, va.last[x.a.ids], va.more[x.a.ids])
    last = np.append(x.group_b[1:] != x.group_b[:-1], True) if len(x.group_b) else np.zeros(0, bool)
    parts[np.arange(len(x.b.ids)) + first_a[x.group_b + 1]] = np.where(last, vb.final[x.b.ids], vb.more[x.b.ids])
    bounds = np.searchsorted(x.a.doc, np.arange(n + 1)) + np.searchsorted(x.b.doc, np.arange(n + 1))
    return [b"".join(parts[i:j].tolist())[:-1] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]


_LINKED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair array<long>, times array<long>"


def linked(docs: DataFrame, a: str, b: str) -> DataFrame:
    """A row for each row of docs (row, doc_id, text) with the counts of its tokens, groups and links, and its linked id pairs with how often each is."""

    def chunk(rows: pa.RecordBatch, lo: int, hi: int) -> pa.RecordBatch:
        va, vb = _loaded(a, b)
        n = hi - lo
        x = align(rows.column("text").slice(lo, n).to_pylist(), va, vb)
        each = lambda doc: np.bincount(doc, minlength=n)
        at, width = x.a.doc[x.link_a], len(vb.length)
        pair, inverse = np.unique(x.a.ids[x.link_a] * width + x.b.ids[x.link_b], return_inverse=True)
        code, times = np.unique(at * max(len(pair), 1) + inverse, return_counts=True)
        own, pair = code // max(len(pair), 1), pair[code % max(len(pair), 1)] if len(pair) else pair
        pair = (pair // width << 32) | pair % width
        bounds = pa.array(np.searchsorted(own, np.arange(n + 1)), pa.int32())
        ends = np.unique(x.a.end[x.link_a], return_index=True)[1]
        groups = spelled_groups(x, va, vb, n)
        digest = [hashlib.sha256(g).hexdigest() if ok else "" for g, ok in zip(groups, x.spelled, strict=True)]
        lists = [pa.ListArray.from_arrays(bounds, pa.array(v, pa.int64())) for v in (pair, times)]
        counts = [pa.array(each(d), pa.int64()) for d in (x.a.doc, x.b.doc, at[ends], at)]
        return pa.record_batch([rows.column("row").slice(lo, n), rows.column("doc_id").slice(lo, n), *counts, pa.array(digest, pa.string()), *lists], [c.split()[0] for c in _LINKED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            offset = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in rows.column("text").cast(pa.large_string())], dtype=np.int64)
            lo = 0
            while lo < rows.num_rows:
                hi = max(lo + 1, int(np.searchsorted(offset, (offset[lo - 1] if lo else 0) + CHUNK, "right")))
                yield chunk(rows, lo, hi)
                lo = hi

    return docs.mapInArrow(run, _LINKED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, n, best: how many links of the corpus join these ids, and whether none joins the B id with another A id more often."""
    counts = rows.select(F.explode(F.arrays_zip("pair", "times")).alias("x")).groupBy("x.pair").agg(F.sum("x.times").alias("n"))
    counts = stored(counts, "pairs").withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))  # a row for each id of vocabulary B at most
    return stored(counts.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counted")


def _looked_up(rows: DataFrame, top: pa.Table, rest: bool) -> DataFrame:
    """Sums of each row over its pairs in top; or, with rest, its other pairs as rows."""
    key = top["pair"].to_numpy()
    order = np.argsort(key)
    key, count, best = key[order], top["n"].to_numpy()[order], top["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)
    shared = rows.sparkSession.sparkContext.broadcast((key, count, best))  # TOP rows at most
    kept = [c for c in rows.columns if c not in ("pair", "times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count, best = shared.value
        for batch in batches:
            lists = batch.column("pair")
            first = lists.offsets.to_numpy().astype(np.int64)
            pair, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            first = first - first[0]
            at = np.minimum(np.searchsorted(key, pair), max(len(key) - 1, 0))
            found = key[at] == pair if len(key) else np.zeros(len(pair), bool)
            if rest:
                owner = np.repeat(batch.column("row").to_numpy(), np.diff(first))[~found]
                yield pa.record_batch([pa.array(owner), pa.array(pair[~found]), pa.array(times[~found])], ["row", "pair", "times"])
            else:
                weight = np.where(found, times, 0)
                at = at if len(key) else at[:0]
                sums = [sums_by(first, weight * v[at] if len(key) else weight) for v in (best, count)]
                yield pa.record_batch([*[batch.column(c) for c in kept], *[pa.array(s, pa.int64()) for s in sums]], [*kept, "n_best", "count_sum"])

    types = dict(rows.dtypes)
    return rows.mapInArrow(run, "row long, pair long, times long" if rest else ", ".join(f"{c} {types[c]}" for c in kept) + ", n_best long, count_sum long")


def report(docs: DataFrame, a: str | None = None, b: str | None = None, top: int = TOP) -> DataFrame:
    """One row for each row of docs: doc_id and the digest of its alignment (REPORT).

    a and b are the paths of the vocabulary files, which every machine must have; by default those of the installed
    public_tokenizers. Special tokens are never made: their strings are plain text. Null and empty texts, and texts that one
    side doesn't spell byte for byte as space + text (one with U+2581, say), have no tokens: zeros, and '' as hash. Repeated
    ids and rows without an id are rows of their own; their links all count. A text is encoded whole, however long.
    Further columns are ignored; an empty table gives no rows.
    """
    if a is None or b is None:
        import public_tokenizers

        a, b = a or public_tokenizers.path("byte_bpe_50k.json"), b or public_tokenizers.path("piece_bpe_32k.model")
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(linked(texts, str(a), str(b)), "linked")
    counted = pair_counts(rows)
    most = counted.orderBy(F.desc("n"), "pair").limit(top).toArrow()
    rare = _looked_up(rows, most, True).join(counted, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    out = _looked_up(rows, most, False).join(rare, "row", "left")
    sums = {"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}
    return out.withColumns(sums).select(*REPORT)
