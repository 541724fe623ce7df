"""The exact k best rows of each query, by distributed histogram selection.

Every query meets every row in blocks (``vectors.dealt``); scores are integers.

1. All scores lie in a range that the norms bound. It is cut into ``BINS`` bins; a task counts its scores per
   query and bin, and the counts are summed over all tasks. The bin that holds the k-th score is cut again,
   until a bin is one score wide: the k-th value, and how many scores lie above it. The number of rounds
   follows from the range alone (three at most for components below 2^15 or so).
2. Everything is scored once more: rows above the k-th value are taken, and of the rows that equal it the ones
   with the smallest ids. At most k rows of a query leave a task.

A task's counts go out from the top until they reach k, for bins below hold no k-th value of any larger set.

Defined cases: a vector that is null or holds null, NaN or infinite components takes no part, nor does a row
without an id; rows of the query's own id are not its candidates; equal ids are ranked one after another; fewer
than k candidates give fewer rows, no query or no candidate gives none; other columns are ignored; shorter vectors
count as padded with zeros; scores that might not fit a long raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import stored
from cellweave.llm.vectors import TILE, dealt, integer_vectors, matrix, scores, shape

BINS = 4_096
FACTOR, EVERY, K = 1_024, 100, 10


def _tiles(rows: pa.Table, queries: pa.Table, width: int, exact: bool):
    """(first query of the tile, scores of tile x rows, which of them are the query's own row)."""
    points, wanted = matrix(rows["v"], width, exact), matrix(queries["v"], width, exact)
    ids, own = rows["vec_id"].to_numpy(), queries["query_id"].to_numpy()
    step = max(1, TILE // max(1, len(ids)))
    for at in range(0, len(own), step):
        yield at, scores(wanted[at : at + step], points), own[at : at + step, None] == ids[None, :]


def _histogram(pairs: tuple[DataFrame, DataFrame], width: int, exact: bool, cell: int, k: int) -> DataFrame:
    """query_id, bin, n: how many scores of each query lie in each bin of ``cell`` scores from its ``low`` on."""

    def count(key, rows: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_bin, out_n = [], [], []
        if rows.num_rows and queries.num_rows:
            low, qid = queries["low"].to_numpy(), queries["query_id"].to_numpy()
            for at, score, own in _tiles(rows, queries, width, exact):
                bins = (score - low[at : at + len(score), None]) // cell
                bins[own | (bins < 0) | (bins >= BINS)] = BINS
                for q, row in enumerate(bins):
                    n = np.bincount(row, minlength=BINS + 1)[:BINS]
                    used = np.flatnonzero(n)[::-1]
                    used = used[: np.searchsorted(np.cumsum(n[used]), k) + 1]
                    out_q.append(np.full(len(used), qid[at + q]))
                    out_bin.append(used)
                    out_n.append(n[used])
        return pa.table(
            {name: pa.array(np.concatenate(x) if x else [], pa.int64()) for name, x in (("query_id", out_q), ("bin", out_bin), ("n", out_n))}
        )

    left, right = (side.groupBy("block", "part") for side in pairs)
    found = left.cogroup(right).applyInArrow(count, "query_id long, bin long, n long")
    return found.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))


def _refined(queries: DataFrame, histogram: DataFrame, cell: int, k: int) -> DataFrame:
    """``queries`` with ``low`` moved to the bin of the k-th score, and ``above`` raised by what lies over it.

    A query with fewer than k candidates keeps its lowest bin, so all its rows are taken.
    """
    down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
    summed = histogram.withColumn("upto", F.sum("n").over(down))
    kth = (
        summed.join(queries.select("query_id", "above"), "query_id")
        .where(F.col("above") + F.col("upto") >= k)
        .groupBy("query_id")
        .agg(F.max_by(F.struct("bin", (F.col("upto") - F.col("n")).alias("over")), "bin").alias("at"))
    )
    at = queries.join(kth, "query_id", "left")
    return at.select(
        "query_id",
        "v",
        (F.col("low") + F.coalesce("at.bin", F.lit(0)) * F.lit(cell)).alias("low"),
        (F.col("above") + F.coalesce("at.over", F.lit(0))).alias("above"),
    )


def exact_top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``k`` best ``rows`` (vec_id, v) for each of ``queries`` (query_id, v)."""
    rows = stored(rows.select("vec_id", "v"))
    width, bound = shape(rows.select("v").unionByName(queries.select("v")))
    exact = bound < 1 << 53
    rounds = 1
    while BINS**rounds < 2 * bound + 1:
        rounds += 1
    at = queries.groupBy("query_id").agg(F.min("v").alias("v"))
    at = stored(at.select("query_id", "v", F.lit(-bound).cast("long").alias("low"), F.lit(0).cast("long").alias("above")))
    n_queries = at.count()
    for left in range(rounds - 1, -1, -1):
        cell = BINS**left
        at = stored(_refined(at, _histogram(dealt(rows, at, n_queries), width, exact, cell, k), cell, k))

    def choose(key, found: pa.Table, wanted: pa.Table) -> pa.Table:
        out = [[], [], []]
        if found.num_rows and wanted.num_rows:
            ids, qid = found["vec_id"].to_numpy(), wanted["query_id"].to_numpy()
            low, above = wanted["low"].to_numpy(), wanted["above"].to_numpy()
            for at, score, own in _tiles(found, wanted, width, exact):
                for q, row in enumerate(score):
                    least = low[at + q]
                    over = np.flatnonzero((row > least) & ~own[q])
                    ties = np.flatnonzero((row == least) & ~own[q])
                    if len(ties) > (room := max(0, k - above[at + q])):
                        ties = ties[np.argsort(ids[ties], kind="stable")[:room]]
                    took = np.concatenate([over, ties])
                    for into, x in zip(out, (np.full(len(took), qid[at + q]), ids[took], row[took]), strict=True):
                        into.append(x)
        return pa.table({name: pa.array(np.concatenate(x) if x else [], pa.int64()) for name, x in zip(("query_id", "vec_id", "score"), out, strict=True)})

    left, right = (side.groupBy("block", "part") for side in dealt(rows, at, n_queries))
    best = left.cogroup(right).applyInArrow(choose, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search_embeddings(embeddings: DataFrame, factor: int = FACTOR, every: int = EVERY, k: int = K) -> DataFrame:
    """The k best rows for every row whose id is divisible by ``every``; components become floor(factor * x)."""
    rows = integer_vectors(embeddings, "vec_id", "embedding", factor)
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v")
    return exact_top_k(rows, queries, k)
