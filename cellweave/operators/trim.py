"""Quality and adapter trimming of reads, batch-wise over Arrow.

Follows the public description of the usual trimmer: quality trimming takes running sums of
quality minus cutoff from each end; an adapter may start anywhere in the read, needs three bases
of overlap and at most one error per ten aligned adapter bases, insertions and deletions included.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_OVERLAP = 3
ERROR_RATE = 0.1


def _matrix(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters padded with 0, one row per string, and the lengths."""
    lengths = np.array([len(v) for v in values], dtype=np.int32)
    width = int(lengths.max()) if len(values) else 0
    raw = np.array([v.encode("latin-1", "replace") for v in values], dtype=f"S{max(width, 1)}")
    return raw.view(np.uint8).reshape(len(values), max(width, 1)), lengths


def quality_bounds(quals: list[str], cutoff5: int, cutoff3: int) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end position that survive quality trimming."""
    codes, n = _matrix(quals)
    width = codes.shape[1]
    at = np.arange(width)
    phred = codes.astype(np.int32) - 33
    inside = at < n[:, None]

    def kept(scores):
        """Length of the prefix to drop: the last step of the run at its maximum before it turns negative."""
        total = np.cumsum(scores, axis=1)
        open_run = np.cumprod(total >= 0, axis=1).astype(bool)
        best = np.where(open_run, total, -1)
        peak = best.max(axis=1)
        first = best.argmax(axis=1) + 1
        return np.where(peak > 0, first, 0)

    head = kept(np.where(inside, cutoff5 - phred, -1_000_000)) if cutoff5 else np.zeros(len(n), dtype=int)
    back = n[:, None] - 1 - at
    reverse = np.where(back >= 0, np.take_along_axis(phred, np.maximum(back, 0), axis=1), 1_000_000)
    tail = kept(np.where(back >= 0, cutoff3 - reverse, -1_000_000)) if cutoff3 else np.zeros(len(n), dtype=int)
    stop = n - tail
    return np.where(head >= stop, 0, head), np.where(head >= stop, 0, stop)


def find_adapter3(seqs: list[str], adapter: str) -> tuple[np.ndarray, np.ndarray]:
    """Start of the best 3' adapter match per read (read length if none) and whether one was found.

    Nothing beats the whole adapter without errors. Of reads lacking that only those are aligned that hold a part of the
    adapter which an alignment with errors must hold, elsewhere than in a prefix of the adapter that ends the read.
    """
    n = np.array([len(s) for s in seqs], dtype=np.int64)
    at = np.array([s.find(adapter) for s in seqs], dtype=np.int64)
    found = at >= 0
    if len(adapter) < MIN_OVERLAP:
        return np.where(found, at, n), found
    seeds, rest = _seeds(adapter), []
    for i in np.flatnonzero(~found).tolist():
        s = seqs[i]
        # The longest prefix that ends the read as it is; a longer one needs errors to score more.
        start = s.find(adapter[:MIN_OVERLAP])
        while start >= 0 and not adapter.startswith(s[start:]):
            start = s.find(adapter[:MIN_OVERLAP], start + 1)
        at[i], found[i] = (start, True) if start >= 0 else (len(s), False)
        for piece, offset in seeds:
            first = s.find(piece)
            # A part at its place in that prefix leads to no other alignment of more score.
            if first >= 0 and (start < 0 or first != start + offset or s.rfind(piece) != first):
                rest.append(i)
                break
    if rest:
        at[rest], found[rest] = _align_adapter3([seqs[i] for i in rest], adapter)
    return at, found


def _seeds(adapter: str) -> list[tuple[str, int]]:
    """Parts of the adapter and their places: any alignment with errors, within those allowed, holds one unchanged.

    ``e`` errors are allowed from some length on; of ``e`` + 1 pieces of that length one is free of errors.
    """
    allowed = np.floor(np.arange(len(adapter) + 1) * ERROR_RATE).astype(int)
    out = []
    for e in range(1, allowed[-1] + 1):
        size = int(np.argmax(allowed >= e)) // (e + 1)
        out += [(adapter[k * size : (k + 1) * size], k * size) for k in range(e + 1)]
    return out


def _align_adapter3(seqs: list[str], adapter: str) -> tuple[np.ndarray, np.ndarray]:
    """The search for reads that hold the adapter with errors, in part or not at all.

    An alignment is rated by score (+1 match, -1 mismatch, -2 gap), then fewer errors, then the
    earlier start. The three are packed into one integer, so the best of several alignments is a
    plain maximum; one table column is worked out at once for all reads and all adapter prefixes.
    The whole adapter may end anywhere; at the end of the read a prefix of it may stick out.
    """
    codes, n = _matrix(seqs)
    rows, width = codes.shape
    m = len(adapter)
    score_1, error_1 = 1 << 40, 1 << 20
    gap = 2 * score_1 + error_1
    step = np.full((m, 256), -score_1 - error_1, dtype=np.int64)
    step[np.arange(m), np.frombuffer(adapter.encode(), dtype=np.uint8)] = score_1
    slope = (gap * np.arange(m + 1, dtype=np.int64))[:, None]
    column = np.repeat(error_1 - 1 - slope, rows, axis=1)
    allowed = np.floor(np.arange(m + 1) * ERROR_RATE).astype(np.int64)
    best = np.full(rows, np.iinfo(np.int64).min, dtype=np.int64)

    def consider(i, mask):
        rated = column[i]
        errors = -(rated >> 20) & (error_1 - 1)
        better = mask & (errors <= allowed[i]) & ((rated >> 20) > (best >> 20))
        best[better] = rated[better]

    for j in range(1, width + 1):
        live = j <= n
        reach = np.empty_like(column)
        reach[0] = error_1 - 1 - j
        np.maximum(column[:-1] + step[:, codes[:, j - 1]], column[1:] - gap, out=reach[1:])
        column = np.maximum.accumulate(reach + slope, axis=0) - slope
        if m >= MIN_OVERLAP:
            consider(m, live)
        at_end = j == n
        if at_end.any():
            for i in range(MIN_OVERLAP, m):
                consider(i, at_end)
    found = best > np.iinfo(np.int64).min
    return np.where(found, error_1 - 1 - (best & (error_1 - 1)), n), found


def find_adapter5(seqs: list[str], adapter: str) -> tuple[np.ndarray, np.ndarray]:
    """End of the best 5' adapter match (0 if none): the 3' search on reversed reads."""
    n = np.array([len(s) for s in seqs])
    at, found = find_adapter3([s[::-1] for s in seqs], adapter[::-1])
    return np.where(found, n - at, 0), found


_BOUNDS = T.StructType(
    [T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType()), T.StructField("found", T.BooleanType())]
)


def trim_bounds(seq: Column, qual: Column, q5: int, q3: int, adapter: str | None, five_prime: bool = False) -> Column:
    """Struct (lo, hi, found): the 0-based half-open part of a read that survives."""

    @F.pandas_udf(_BOUNDS)
    def bounds(s: pd.Series, q: pd.Series) -> pd.DataFrame:
        if not len(s):
            return pd.DataFrame({"lo": [], "hi": [], "found": []}).astype({"lo": "int32", "hi": "int32", "found": bool})
        lo, hi = quality_bounds(q.tolist(), q5, q3)
        found = np.zeros(len(s), dtype=bool)
        if adapter:
            inner = [x[a:b] for x, a, b in zip(s, lo, hi)]
            if five_prime:
                cut, found = find_adapter5(inner, adapter)
                lo = lo + cut
            else:
                cut, found = find_adapter3(inner, adapter)
                hi = lo + cut
        return pd.DataFrame({"lo": lo.astype("int32"), "hi": hi.astype("int32"), "found": found})

    # Told to be repeatable it would be worked out once more, with the reads behind it, for each filter on its result.
    return bounds.asNondeterministic()(seq, qual)


def _apply(df: DataFrame, k: int, b: Column) -> DataFrame:
    lo, size = b["lo"] + 1, b["hi"] - b["lo"]
    return df.withColumns({c: F.substr(F.col(c), lo, size) for c in (f"seq{k}", f"qual{k}")})


def trim_pairs(
    reads: DataFrame, q5: int, q3: int, adapters: tuple[str | None, str | None],
    min_len: tuple[int, int] = (0, 0), five_prime1: bool = False, require1: bool = False,
) -> DataFrame:
    """Trim both mates and keep pairs whose mates are both long enough.

    ``require1`` also drops pairs whose first mate shows no adapter.
    """
    bounded = reads.withColumns(
        {
            "_b1": trim_bounds(F.col("seq1"), F.col("qual1"), q5, q3, adapters[0], five_prime1),
            "_b2": trim_bounds(F.col("seq2"), F.col("qual2"), q5, q3, adapters[1]),
        }
    )
    if require1:
        bounded = bounded.where("_b1.found")
    out = _apply(_apply(bounded, 1, F.col("_b1")), 2, F.col("_b2")).drop("_b1", "_b2")
    return out.where((F.length("seq1") >= min_len[0]) & (F.length("seq2") >= min_len[1]))


def trim_library(reads: DataFrame, cfg) -> DataFrame:
    """First trimming of a library; with ``trim_tso`` pairs must first show the switch oligo."""
    if cfg.trim_tso:
        reads = trim_pairs(reads, cfg.q5, cfg.q3, (cfg.tso, cfg.tso_rev), five_prime1=True, require1=True)
    return trim_pairs(reads, cfg.q5, cfg.q3, (cfg.a1, cfg.a2), (cfg.mlen1, cfg.mlen2))


def trim_rna(reads: DataFrame, cfg) -> DataFrame:
    """Second trimming of RNA reads: the spacer, then the poly-A.

    Paired runs trim the first mate only; single-end runs keep and trim the second mate, with the
    5' setting as the cutoff for its 3' end.
    """
    for adapter in (cfg.rna_adapter1, cfg.rna_adapter2):
        if cfg.rna_pe:
            reads = trim_pairs(reads, cfg.q5, cfg.q3, (adapter, None), (cfg.mlen1, cfg.mlen2))
        else:
            b = trim_bounds(F.col("seq2"), F.col("qual2"), 0, cfg.q5, adapter)
            reads = _apply(reads.withColumn("_b", b), 2, F.col("_b")).drop("_b")
            reads = reads.where(F.length("seq2") >= cfg.mlen2)
    return reads
