"""Longest common subsequences of many pairs of names at once, bit by bit."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = 64
_NONE = np.uint32(0xFFFFFFFF)


def _codes(texts: list[str], width: int) -> np.ndarray:
    """A row of code points for each text, padded."""
    return np.array(texts, f"<U{width}").view(np.uint32).reshape(len(texts), width)


def _long(a: str, b: str) -> int:
    """The same for one pair of any length, in Python's integers."""
    at: dict[str, int] = {}
    for j, ch in enumerate(b):
        at[ch] = at.get(ch, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for ch in a:
        same = row & at.get(ch, 0)
        row = ((row + same) | (row - same)) & full
    return len(b) - row.bit_count()


def common_lengths(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair.

    A bit for each letter of the shorter text says whether the subsequence grows there; one addition a letter of the longer text moves all
    of them, for all pairs together. A shorter text of more than 64 letters goes by itself.
    """
    swapped = [(x, y) if len(x) >= len(y) else (y, x) for x, y in zip(a, b, strict=True)]
    size = np.array([[len(x), len(y)] for x, y in swapped], np.int64).reshape(-1, 2)
    out = np.zeros(len(swapped), np.int64)
    short = np.flatnonzero((size[:, 1] <= WORD) & (size[:, 1] > 0))
    for i in np.flatnonzero(size[:, 1] > WORD).tolist():
        out[i] = _long(*swapped[i])
    if not len(short):
        return out
    la, lb = size[short, 0], size[short, 1]
    left, right = _codes([swapped[i][0] for i in short], int(la.max())), _codes([swapped[i][1] for i in short], int(lb.max()))
    right = np.where(np.arange(right.shape[1]) < lb[:, None], right, _NONE)
    row = np.full(len(short), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(left.shape[1]):
            same = np.zeros(len(short), np.uint64)
            for j in range(right.shape[1]):
                same |= (right[:, j] == left[:, i]).astype(np.uint64) << np.uint64(j)
            same = np.where(i < la, same & row, np.uint64(0))
            row = (row + same) | (row - same)
    inside = np.uint64(np.iinfo(np.uint64).max) >> (WORD - lb).astype(np.uint64)
    out[short] = lb - np.bitwise_count(row & inside)
    return out


@F.pandas_udf(T.IntegerType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(common_lengths(a.fillna("").tolist(), b.fillna("").tolist()), dtype="int32")


def name_similarity(a: Column, b: Column) -> Column:
    """2 * (longest common subsequence) / (both lengths); 0 where either is empty or null."""
    la, lb = F.length(a), F.length(b)
    return F.when((la > 0) & (lb > 0), 2.0 * _common(a, b) / (la + lb)).otherwise(0.0)
