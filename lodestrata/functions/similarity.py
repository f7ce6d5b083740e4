"""Similarity of strings (Indel ratios, bit-parallel, in Arrow batches) and of vectors (native)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the shorter string."""
    if len(a) > len(b):
        a, b = b, a
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & at.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    """100 x the normalized Indel similarity; two empty strings are alike."""
    n = len(a) + len(b)
    return 100.0 if n == 0 else 200.0 * lcs_length(a, b) / n


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


#: Windows that are compared at once.
WINDOWS = 1 << 15


def _window_lcs(a: str, codes: np.ndarray) -> np.ndarray:
    """LCS of ``a`` with every window of its length in ``codes``: bit-parallel over ``a``, all windows in step."""
    n, k = len(a), -(-len(a) // 64)
    letters, at = np.unique(np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)
    table = np.zeros((k, len(letters) + 1), np.uint64)  # the last column is for what ``a`` does not have
    for i, x in enumerate(at):
        table[i // 64, x] |= np.uint64(1) << np.uint64(i % 64)
    where = np.minimum(np.searchsorted(letters, codes), len(letters) - 1)
    masks = table[:, np.where(letters[where] == codes, where, len(letters))]
    w = len(codes) - n + 1
    v = np.full((k, w), np.iinfo(np.uint64).max, np.uint64)
    for i in range(n):
        carry = None
        for t in range(k):
            x = v[t]
            u = x & masks[t, i : i + w]
            y = x + u
            over = y < x
            if carry is not None:
                y += carry
                over |= y < carry
            v[t] = y | (x & ~u)
            carry = over.astype(np.uint64)
    if n % 64:
        v[-1] |= ~np.uint64((1 << n % 64) - 1)
    return 64 * k - np.bitwise_count(v).sum(0, dtype=np.int64)


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string and any window of the longer one of up to its length. Empty against text: 0."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    if a in b:
        return 100.0
    n, m = len(a), len(b)
    # windows that stick out at either end are shorter ones: no letter of ``a`` is there
    out = np.full(n - 1, 0xFFFFFFFF, np.uint32)
    codes = np.concatenate([out, np.frombuffer(b.encode("utf-32-le", "surrogatepass"), np.uint32), out])
    end = np.arange(1, m + n)
    size = np.minimum(end, m) - np.maximum(0, end - n)
    best = 0.0
    for lo in range(0, len(end), WINDOWS):
        hi = min(lo + WINDOWS, len(end))
        best = max(best, float((200.0 * _window_lcs(a, codes[lo : hi + n - 1]) / (n + size[lo:hi])).max()))
    return best


@F.pandas_udf(DoubleType())
def token_sort_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else token_sort_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def partial_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else partial_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 where a vector is zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    n = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(n > 0, dot(a, b) / n).otherwise(0.0)
