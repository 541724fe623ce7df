"""Hard negatives: rows of another label that score just below a positive of the anchor.

Angular triangle filtering: every row stores its norm and its angles to ``REFERENCES`` reference directions.
For an anchor at the angle a to a reference and a row at the angle b, their own angle lies between |a - b| and
min(a + b, 2 pi - a - b); the narrowest interval over all references gives an interval of the cosine, and times
the norms an interval of the score. Intervals are widened by more than all rounding of angles, cosines and
products can come to, so no row is lost; only rows whose interval meets a wanted window are scored, in integers.

1. Positives: of the rows with the anchor's label, the interval's lower ends give a score that the last
   positive reaches at least; rows whose upper end reaches it are scored, and the best ones kept.
2. Negatives: a positive of score p opens the window from 80 to 100 per cent of p. Rows of other labels whose
   interval meets a window of the anchor are scored; per positive the best in its window are kept.

Rows meet anchors in blocks (``vectors.dealt``); a task sends at most ``POSITIVES`` rows per anchor and
``NEGATIVES`` per positive on, so a label or a value that holds a third of all rows loads no task more than others.

Reference directions are the mean vectors of all rows in ``REFERENCES`` groups of labels. Any directions give the
same result; those of the labels prune most where labels are told apart by direction. A zero vector has no angle:
its score is 0, and so is its interval.

Defined cases: a row without id or label, or whose vector is null or holds null, NaN or infinite components takes
no part; ``noisy`` moves labels before anything else; rows of the anchor's own id are not its positives (an anchor
of several rows stands once, as the least (label, vector)); equal ids are ranked one after another; anchors without
positives, and positives without negatives, give no row; other columns are ignored; shorter vectors count as padded
with zeros; scores that might not fit a long raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import stored
from cellweave.llm.vectors import TILE, dealt, integer_vectors, matrix, scores, shape

REFERENCES = 16
FACTOR, EVERY, POSITIVES, NEGATIVES = 256, 100, 5, 5
#: A positive's window in hundredths of its score.
LEAST, MOST = 80, 100
#: More than the error of an angle that arccos has from a cosine off by some 1e-14 (its root where the angle is 0 or pi).
ANGLE_SLACK = 1e-6
SCORE_SLACK = 1e-9
#: Above this share of a tile, scoring the whole tile costs less than picking pairs.
DENSE = 0.05


def noisy(label: Column, vec_id: Column, every: int = 7, classes: int = 10) -> Column:
    """Labels of rows whose id is divisible by ``every`` move to the next class."""
    return F.when(vec_id % every == 0, (label + 1) % classes).otherwise(label)


def reference_directions(vectors: DataFrame, width: int, groups: int = REFERENCES) -> np.ndarray:
    """Unit mean vectors of the rows in ``groups`` groups of labels; ``groups`` x ``width`` numbers reach the driver."""

    def sums(batches):
        total = np.zeros((groups, width))
        for batch in batches:
            points = matrix(pa.chunked_array([batch.column("v")]), width, True)
            total += (batch.column("g").to_numpy() == np.arange(groups)[:, None]).astype(np.float64) @ points
        yield pa.RecordBatch.from_pydict(
            {"g": np.repeat(np.arange(groups, dtype=np.int32), width), "at": np.tile(np.arange(width, dtype=np.int32), groups), "x": total.ravel()}
        )

    grouped = vectors.select(F.pmod(F.xxhash64("label"), F.lit(groups)).cast("int").alias("g"), "v")
    out = np.zeros((groups, width))
    for row in grouped.mapInArrow(sums, "g int, at int, x double").groupBy("g", "at").agg(F.sum("x").alias("x")).collect():
        out[row.g, row.at] = row.x
    norms = np.linalg.norm(out, axis=1)
    return out[norms > 0] / norms[norms > 0, None]


def with_angles(vectors: DataFrame, references: np.ndarray, width: int) -> DataFrame:
    """``vectors`` (vec_id, label, v) with norm and angles to the references."""
    shared = vectors.sparkSession.sparkContext.broadcast(references)  # REFERENCES x width numbers

    def measure(batches):
        for batch in batches:
            points = matrix(pa.chunked_array([batch.column("v")]), width, True)
            norm = np.linalg.norm(points, axis=1)
            cosine = (points @ shared.value.T) / np.where(norm > 0, norm, 1)[:, None]
            angle = np.arccos(np.clip(cosine, -1, 1))
            ends = pa.array(np.arange(len(norm) + 1, dtype=np.int32) * angle.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norm), pa.ListArray.from_arrays(ends, pa.array(angle.ravel()))], [*batch.schema.names, "norm", "angles"]
            )

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(measure, f"vec_id long, label {kind}, v array<long>, norm double, angles array<double>")


def score_bounds(norm: np.ndarray, angles: np.ndarray, norms: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Safe lower and upper bounds of the inner products of points (norm, angles) with others (norms, others)."""
    least = np.zeros((len(norm), len(norms)))
    most = np.full((len(norm), len(norms)), np.pi)
    for a, b in zip(angles.T, others.T, strict=True):
        apart, joined = np.abs(a[:, None] - b[None, :]), a[:, None] + b[None, :]
        np.maximum(least, apart, out=least)
        np.minimum(most, np.minimum(joined, 2 * np.pi - joined), out=most)
    both = norm[:, None] * norms[None, :]
    slack = both * SCORE_SLACK + SCORE_SLACK
    upper = np.cos(np.maximum(least - ANGLE_SLACK, 0)) * both + slack
    lower = np.cos(np.minimum(most + ANGLE_SLACK, np.pi)) * both - slack
    return lower, upper


def _wanted_scores(queries: np.ndarray, points: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, integer score) of the pairs in ``mask``; nothing else is scored but in dense tiles."""
    at, of = np.nonzero(mask)
    if len(at) > DENSE * mask.size:
        return at, of, scores(queries, points)[at, of]
    score = np.empty(len(at), np.int64)
    step = max(1, TILE // max(1, points.shape[1]))
    for i in range(0, len(at), step):
        part = slice(i, i + step)
        score[part] = np.einsum("ij,ij->i", queries[at[part]], points[of[part]]).astype(np.int64)
    return at, of, score


def _best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` first of each group by (score descending, id)."""
    order = np.lexsort((ids, -score, group))
    nth = np.arange(len(order))
    starts = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0]) if len(order) else nth
    return order[nth - np.repeat(starts, np.diff(np.r_[starts, len(order)])) < n]


class _Cell:
    """The rows and anchors of one cell as arrays, and tiles of their bounds."""

    def __init__(self, rows: pa.Table, anchors: pa.Table, width: int, exact: bool):
        self.points, self.wanted = matrix(rows["v"], width, exact), matrix(anchors["v"], width, exact)
        self.ids, self.own = rows["vec_id"].to_numpy(), anchors["anchor_id"].to_numpy()
        self.norms, self.norm = rows["norm"].to_numpy(), anchors["norm"].to_numpy()
        self.others, self.angles = (self._angles(t["angles"]) for t in (rows, anchors))
        code = {x: i for i, x in enumerate(dict.fromkeys(rows["label"].to_pylist() + anchors["label"].to_pylist()))}
        self.labels = np.array([code[x] for x in rows["label"].to_pylist()])
        self.label = np.array([code[x] for x in anchors["label"].to_pylist()])

    @staticmethod
    def _angles(column: pa.ChunkedArray) -> np.ndarray:
        lists = column.combine_chunks()
        return lists.flatten().to_numpy().reshape(len(lists), -1) if len(lists) else np.empty((0, 0))

    def tiles(self):
        step = max(1, TILE // max(1, len(self.ids)))
        for at in range(0, len(self.own), step):
            part = slice(at, at + step)
            lower, upper = score_bounds(self.norm[part], self.angles[part], self.norms, self.others)
            yield part, lower, upper, self.label[part, None] == self.labels[None, :]


def positives_of(rows: DataFrame, anchors: DataFrame, n_anchors: int, width: int, exact: bool, n: int) -> DataFrame:
    """anchor_id, positive_id, positive_score, nth: the ``n`` best rows of the anchor's own label."""

    def choose(key, found: pa.Table, wanted: pa.Table) -> pa.Table:
        out = [[], [], []]
        if found.num_rows and wanted.num_rows:
            cell = _Cell(found, wanted, width, exact)
            for part, lower, upper, same in cell.tiles():
                mask = same & (cell.own[part, None] != cell.ids[None, :])
                if mask.shape[1] > n:  # at least n rows reach the n-th largest lower end
                    floor = -np.partition(np.where(mask, -lower, np.inf), n - 1, axis=1)[:, n - 1]
                    mask &= upper >= floor[:, None]
                at, of, score = _wanted_scores(cell.wanted[part], cell.points, mask)
                took = _best(at, score, cell.ids[of], n)
                for into, x in zip(out, (cell.own[part][at[took]], cell.ids[of[took]], score[took]), strict=True):
                    into.append(x)
        names = ("anchor_id", "positive_id", "positive_score")
        return pa.table({name: pa.array(np.concatenate(x) if x else [], pa.int64()) for name, x in zip(names, out, strict=True)})

    left, right = (side.groupBy("block", "part") for side in dealt(rows, anchors, n_anchors))
    best = left.cogroup(right).applyInArrow(choose, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return best.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= n)


def negatives_of(rows: DataFrame, anchors: DataFrame, n_anchors: int, width: int, exact: bool, n: int) -> DataFrame:
    """The ``n`` best rows of other labels in the window of each positive that ``anchors`` carry (positives)."""

    def choose(key, found: pa.Table, wanted: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if found.num_rows and wanted.num_rows:
            cell = _Cell(found, wanted, width, exact)
            opened = [sorted((p["nth"], p["positive_score"]) for p in ps) for ps in wanted["positives"].to_pylist()]
            # ceil(LEAST * p / MOST) in whole numbers; a window of a negative positive is empty
            low = np.array([min(-(-LEAST * p // MOST) for _, p in ps) for ps in opened])
            high = np.array([max(p for _, p in ps) for ps in opened])
            for part, lower, upper, same in cell.tiles():
                mask = ~same & (upper >= low[part, None]) & (lower <= high[part, None])
                at, of, score = _wanted_scores(cell.wanted[part], cell.points, mask)
                keep = (score >= low[part][at]) & (score <= high[part][at])
                at, of, score = at[keep], of[keep], score[keep]
                most = max(map(len, opened[part]))
                for k in range(most):
                    p = np.array([ps[k][1] if k < len(ps) else -1 for ps in opened[part]])
                    nth = np.array([ps[k][0] if k < len(ps) else 0 for ps in opened[part]])
                    inside = np.flatnonzero((score <= p[at]) & (MOST * score >= LEAST * p[at]) & (p[at] >= 0))
                    took = inside[_best(at[inside], score[inside], cell.ids[of[inside]], n)]
                    for into, x in zip(out, (cell.own[part][at[took]], nth[at[took]], cell.ids[of[took]], score[took]), strict=True):
                        into.append(x)
        names = ("anchor_id", "nth", "negative_id", "negative_score")
        return pa.table({name: pa.array(np.concatenate(x) if x else [], pa.int64()) for name, x in zip(names, out, strict=True)})

    left, right = (side.groupBy("block", "part") for side in dealt(rows, anchors, n_anchors))
    best = left.cogroup(right).applyInArrow(choose, "anchor_id long, nth long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "nth").orderBy(F.desc("negative_score"), "negative_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, references: int = REFERENCES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and v; ``anchors`` has anchor_id, label and v.
    """
    vectors = stored(vectors.select("vec_id", "label", "v"))
    width, bound = shape(vectors.select("v").unionByName(anchors.select("v")))
    exact = bound < 1 << 53
    directions = reference_directions(vectors, width, references)
    rows = stored(with_angles(vectors, directions, width))
    once = anchors.groupBy("anchor_id").agg(F.min(F.struct("label", "v")).alias("least"))
    asked = with_angles(once.select(F.col("anchor_id").alias("vec_id"), "least.label", "least.v"), directions, width)
    asked = stored(asked.withColumnRenamed("vec_id", "anchor_id"))
    n_anchors = asked.count()
    found = stored(positives_of(rows, asked, n_anchors, width, exact, positives))
    windows = found.where("positive_score >= 0").groupBy("anchor_id").agg(F.collect_list(F.struct("nth", "positive_score")).alias("positives"))
    chosen = negatives_of(rows, asked.join(windows, "anchor_id"), n_anchors, width, exact, negatives)
    return chosen.join(found, ["anchor_id", "nth"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine_embeddings(embeddings: DataFrame, factor: int = FACTOR, every: int = EVERY) -> DataFrame:
    """Hard negatives for every row whose id is divisible by ``every``; labels are moved by ``noisy`` first."""
    label = noisy(F.col("label"), F.col("vec_id")).alias("label")
    vectors = integer_vectors(embeddings.where(F.col("label").isNotNull()), "vec_id", "embedding", factor, label)
    anchors = vectors.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "anchor_id")
    return mine_negatives(vectors, anchors)
