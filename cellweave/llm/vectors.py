"""Integer vectors and the grid of row groups and query groups, shared by the vector searches.

A vector takes part if it is there and all its components are there and finite, and if its row has an id.
Vectors of several lengths count as padded with zeros. Rows of one id are rows of their own; only among
queries an id stands once, with its least vector.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows and queries of one cell of the grid at most (on average): a bound of memory, not of the search.
CELL_ROWS, CELL_QUERIES = 65_536, 4_096
#: Scores that a task holds at a time.
TILE = 1 << 21


def whole_vector(vector: str) -> Column:
    """The vector is there and holds finite numbers only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def integer_vectors(df: DataFrame, vec_id: str, vector: str, factor: int, *more: Column | str) -> DataFrame:
    """vec_id, v (the floors of ``factor`` times each component) and ``more`` for the rows that take part."""
    floors = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(factor))))
    return df.where(whole_vector(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), floors.alias("v"), *more
    )


def shape(vectors: DataFrame) -> tuple[int, int]:
    """(width, bound): the longest vector's length and a bound of every score's size.

    No inner product, nor any part of its sum, is larger than the largest square norm.
    """
    square = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    row = vectors.agg(F.max(F.size("v")), F.max(square)).first()
    width, bound = row[0] or 0, row[1] or 0.0
    if bound >= 2.0**62:
        raise ValueError("components are too large: a score would not fit a long")
    return width, math.ceil(bound * (1 + 1e-9))


def dealt(rows: DataFrame, queries: DataFrame, n_queries: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` and ``queries`` under the keys (block, part): each row meets each query in exactly one cell.

    Queries are cut into blocks and rows into parts, both by number and not by value, so equal vectors, ids or
    labels spread like others. Rows are sent once per block, queries once per part.
    """
    spark = rows.sparkSession
    n_rows = rows.count()
    blocks = max(1, math.ceil(n_queries / CELL_QUERIES))
    parts = max(1, math.ceil(n_rows / CELL_ROWS), min(2 * spark.sparkContext.defaultParallelism, math.ceil(n_rows / 256)))
    number = F.monotonically_increasing_id()
    left = rows.withColumn("part", F.pmod(F.xxhash64(number), F.lit(parts)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    right = queries.withColumn("block", F.pmod(F.xxhash64(number), F.lit(blocks)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    )
    return left, right


def matrix(column: pa.ChunkedArray, width: int, exact: bool) -> np.ndarray:
    """Rows of integer components: doubles where every sum of products stays exact in them, longs else."""
    kind = np.float64 if exact else np.int64
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width).astype(kind)
    out = np.zeros((len(sizes), width), kind)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return (queries @ rows.T).astype(np.int64, copy=False)
