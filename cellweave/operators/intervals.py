"""Interval tools: window tiling, overlap joins, point lookups, unions of intervals.

Spark plans a bare range predicate as a nested loop. Every join here carries an equality on
(keys, bin) as well, so it becomes a hash or sort-merge join that AQE can split when a bin is hot.
All intervals are 0-based half-open unless a function says otherwise. No side is hinted for
broadcast: Catalyst broadcasts only when the measured size is below its threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bin_of(pos: Column, width: int) -> Column:
    return F.floor(pos / F.lit(width)).cast("bigint")


def explode_bins(df: DataFrame, start: str, end: str, width: int, name: str = "bin") -> DataFrame:
    """One row per bin touched by [start, end). Empty intervals give no row."""
    kept = df.where(F.col(start) < F.col(end))
    first, last = bin_of(F.col(start), width), bin_of(F.col(end) - 1, width)
    return kept.withColumn(name, F.explode(F.sequence(first, last)))


def clip_to_bins(df: DataFrame, start: str, end: str, width: int, name: str = "bin") -> DataFrame:
    """As ``explode_bins`` but cut at the bin edges, so the pieces never overlap across bins."""
    out = explode_bins(df, start, end, width, name)
    return out.withColumns(
        {
            start: F.greatest(F.col(start), F.col(name) * width),
            end: F.least(F.col(end), (F.col(name) + 1) * width),
        }
    )


def make_windows(sizes: DataFrame, width: int) -> DataFrame:
    """Tile contigs (chrom, size) into windows of ``width``; the last one is cut short."""
    starts = F.when(F.col("size") > 0, F.sequence(F.lit(0), F.col("size") - 1, F.lit(width)))
    return sizes.select("chrom", "size", F.explode(starts).alias("start")).select(
        "chrom",
        F.col("start").cast("bigint").alias("start"),
        F.least(F.col("start") + width, F.col("size")).cast("bigint").alias("end"),
    )


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    width: int,
) -> DataFrame:
    """Inner join of rows that share ``keys`` and overlap by at least one base.

    A pair that shares several bins is kept only in the first bin both sides touch, so no
    distinct is needed afterwards. Column names other than ``keys`` must not clash.
    """
    ls, le = left_span
    rs, re = right_span
    a = explode_bins(left, ls, le, width, "_bin")
    b = explode_bins(right, rs, re, width, "_bin")
    first_shared = F.greatest(bin_of(F.col(ls), width), bin_of(F.col(rs), width))
    return (
        a.join(b, [*keys, "_bin"])
        .where((F.col(ls) < F.col(re)) & (F.col(rs) < F.col(le)) & (F.col("_bin") == first_shared))
        .drop("_bin")
    )


def point_join(
    points: DataFrame,
    spans: DataFrame,
    keys: Sequence[str],
    pos: str,
    span: tuple[str, str],
    width: int,
    how: str = "inner",
) -> DataFrame:
    """Join each point to every span with start <= pos < end. Points are never replicated."""
    s, e = span
    a = points.withColumn("_bin", bin_of(F.col(pos), width))
    b = explode_bins(spans, s, e, width, "_sbin")
    cond = [F.col(f"_p.{k}") == F.col(f"_s.{k}") for k in keys]
    cond += [
        F.col("_p._bin") == F.col("_s._sbin"),
        F.col(f"_p.{pos}") >= F.col(f"_s.{s}"),
        F.col(f"_p.{pos}") < F.col(f"_s.{e}"),
    ]
    joined = a.alias("_p").join(b.alias("_s"), cond, how)
    keep_right = [F.col(f"_s.{c}") for c in spans.columns if c not in keys]
    return joined.select(*[F.col(f"_p.{c}") for c in points.columns], *keep_right)


def union_within_bins(
    df: DataFrame, keys: Sequence[str], start: str, end: str, width: int
) -> DataFrame:
    """Disjoint pieces covering the union of the intervals of each key, cut at bin edges.

    Cutting first keeps each window partition at no more than ``width`` rows, however many
    intervals one key holds.
    """
    pieces = (
        clip_to_bins(df.select(*keys, start, end), start, end, width)
        .groupBy(*keys, "bin", start)
        .agg(F.max(end).alias(end))
    )
    order = Window.partitionBy(*keys, "bin").orderBy(start)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (reach.isNull() | (F.col(start) > reach)).cast("int")
    island = F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        pieces.withColumn("_opens", opens)
        .withColumn("_island", island)
        .groupBy(*keys, "bin", "_island")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .drop("_island")
    )
