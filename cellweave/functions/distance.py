"""Edit distances that Spark has no built-in for, as Arrow-batched UDFs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _codes(values, width: int) -> np.ndarray:
    """Column-major character codes, one row per position."""
    joined = "".join(values).encode("latin-1", "replace")
    return np.frombuffer(joined, dtype=np.uint8).reshape(len(values), width).T


def _free_divergence_batch(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edit distance in which moves along the far edge of the shorter alignment are free.

    ``a`` and ``b`` hold one column per string pair; the recurrence runs over the batch at once.
    """
    n, rows = a.shape
    above = [np.full(rows, j, dtype=np.int16) for j in range(n + 1)]
    for i in range(1, n + 1):
        row = [np.full(rows, i, dtype=np.int16)]
        across = 0 if i == n else 1
        for j in range(1, n + 1):
            down = 0 if j == n else 1
            best = np.minimum(above[j - 1] + (a[i - 1] != b[j - 1]), above[j] + down)
            row.append(np.minimum(best, row[j - 1] + across))
        above = row
    return above[n]


def free_divergence_series(s1: pd.Series, s2: pd.Series) -> pd.Series:
    out = np.full(len(s1), np.nan)
    len1, len2 = s1.str.len(), s2.str.len()
    same = (len1 == len2).to_numpy()
    lengths = len1.to_numpy()
    for n in np.unique(lengths[same]):
        rows = np.flatnonzero(same & (lengths == n))
        n = int(n)
        if n == 0:
            out[rows] = 0
            continue
        a = _codes(s1.iloc[rows].tolist(), n)
        b = _codes(s2.iloc[rows].tolist(), n)
        out[rows] = _free_divergence_batch(a, b)
    return pd.Series(out).astype("Int32")


@F.pandas_udf(T.IntegerType())
def _free_divergence(s1: pd.Series, s2: pd.Series) -> pd.Series:
    return free_divergence_series(s1, s2)


def free_divergence(a: Column, b: Column) -> Column:
    """Free divergence of equal-length strings; null when the lengths differ."""
    # Told to be repeatable it would be measured once more, with the strings behind it, for each filter on its result.
    return _free_divergence.asNondeterministic()(a, b)


def edit_distance(a: Column, b: Column, method: str) -> Column:
    if method == "FreeDivergence":
        return free_divergence(a, b)
    if method == "Levenshtein":
        return F.levenshtein(a, b)
    raise ValueError(f"unknown distance method: {method}")
