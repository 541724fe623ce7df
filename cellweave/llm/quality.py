"""Quality by regularised quadratic discriminant analysis over transformed document statistics.

Each whole text becomes ``FEATURES`` numbers (shares of letter cases, signs and digits, repetition, lengths), transformed
by logarithms or square roots so that each class is nearer to a normal cloud. Class means and covariances are sums
over all training rows, computed as one Spark aggregate. A class covariance is shrunk twice: by ``POOL`` to
the pooled one and by ``RIDGE`` to the diagonal of its variances. The score is the logistic of the difference of the
classes' log densities (Mahalanobis distances from cached Cholesky factors) plus the log prior odds.

Labels are read only where crc32(doc_id as text) mod 4 is not 2; every other labelled row is used, without a bound.

Defined cases: null is the empty text; empty texts have statistics of their own and a score; null doc_id is held out;
several labels of one doc_id count as their maximum; a class without training rows gives score 0 or 1 for the
other; repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import small_batches, stored, text_or_empty
from cellweave.llm.toxicity import held_out

FOLDS, HELD = 4, 2
POOL, RIDGE = 0.05, 0.02
#: Smallest share of the whole variance that a class's own may have: keeps near-constant statistics from deciding alone.
FLOOR = 0.05
FEATURES = 14
_BLOCK = 1 << 20
#: Classes of byte values: 0 letters and bytes beyond ASCII, 1 capitals, 2 digits, 3 blanks, 4 stops and commas, 5 other signs.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 5
_CLASS[[ord(c) for c in ".,;:'\"-()?"]] = 4
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[48:58] = 2
_CLASS[65:91] = 1
_SENTENCE = re.compile(r"[.!?]+\s+|\n+")


def statistics(text: str) -> list[float]:
    data = text.encode()
    n = len(data)
    share = np.zeros(6)
    for at in range(0, n, _BLOCK):
        share += np.bincount(_CLASS[np.frombuffer(data, np.uint8, min(_BLOCK, n - at), at)], minlength=6)
    share /= max(n, 1)
    words = Counter(text.split())
    total, distinct = sum(words.values()), len(words)
    once = sum(1 for c in words.values() if c == 1)
    most = max(words.values(), default=0)
    lengths = sum(len(w) * c for w, c in words.items())
    sentences = [s for s in _SENTENCE.split(text) if s]
    squeezed = len(zlib.compress(data, 1)) / (n + 20)
    return [
        np.log1p(n),
        np.log1p(lengths / max(total, 1)),
        *np.sqrt(share[1:]),
        distinct / (total + 1) ** 0.8 if total else 0.0,
        np.sqrt(once / max(total, 1)),
        np.sqrt(most / (total + 5)),
        np.log(squeezed),
        np.sqrt(1 - len(set(sentences)) / len(sentences)) if sentences else 0.0,
        np.log1p(total / max(len(sentences), 1)),
        np.log1p(len(sentences)) - np.log1p(total),
    ]


def document_statistics(documents: DataFrame) -> DataFrame:
    """doc_id, x: the statistics of every whole text."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(t.as_py()) for t in batch.column("text")], float).reshape(-1, FEATURES)
            values = pa.array(rows.ravel(), pa.float64())
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(ends, values)], ["doc_id", "x"])

    id_type = documents.schema["doc_id"].dataType.simpleString()
    docs = documents.select("doc_id", text_or_empty().alias("text"))
    return docs.mapInArrow(measure, f"doc_id {id_type}, x array<double>")


@dataclass
class QuadraticModel:
    """Per class: log prior, mean, Cholesky factor of the shrunk covariance and half its log determinant."""

    classes: list[tuple[float, np.ndarray, np.ndarray, float] | None]

    def score(self, x: np.ndarray) -> np.ndarray:
        low, high = (self._log_density(c, x) for c in self.classes)
        with np.errstate(invalid="ignore", over="ignore"):
            return np.nan_to_num(1 / (1 + np.exp(np.clip(low - high, -700, 700))), nan=0.0)

    @staticmethod
    def _log_density(c, x: np.ndarray) -> np.ndarray:
        if c is None:
            return np.full(len(x), -np.inf)
        prior, mean, factor, half_log_det = c
        z = np.linalg.solve(factor, (x - mean).T)
        return prior - half_log_det - 0.5 * (z * z).sum(0)


def fit_quality(features: DataFrame, labels: DataFrame, pool: float = POOL, ridge: float = RIDGE) -> QuadraticModel:
    own = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"), FOLDS, HELD))
    own = own.groupBy("doc_id").agg((F.max("quality") > 0).cast("int").alias("label"))
    rows = features.join(own, "doc_id").select("label", *[F.col("x")[i].alias(f"x{i}") for i in range(FEATURES)])
    pairs = [(i, j) for i in range(FEATURES) for j in range(i, FEATURES)]
    sums = rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"x{i}").alias(f"s{i}") for i in range(FEATURES)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in pairs],
    )
    got = {r.label: r for r in sums.collect()}  # two rows
    raw = {}
    for label, r in got.items():
        mean = np.array([r[f"s{i}"] for i in range(FEATURES)]) / r.n
        second = np.zeros((FEATURES, FEATURES))
        for i, j in pairs:
            second[i, j] = second[j, i] = r[f"s{i}_{j}"] / r.n
        raw[label] = (r.n, mean, second - np.outer(mean, mean))
    total = sum(n for n, _, _ in raw.values())
    pooled = sum((n * c for n, _, c in raw.values()), np.zeros((FEATURES, FEATURES))) / max(total, 1)
    floor = FLOOR * np.diag(pooled) + 1e-6
    classes: list = [None, None]
    for label, (n, mean, cov) in raw.items():
        pull = (pool * n + 20) / (n + 20)  # the fewer rows, the nearer to the pooled one
        cov = (1 - pull) * cov + pull * pooled
        cov = (1 - ridge) * cov + ridge * np.diag(np.diag(cov)) + np.diag(np.maximum(floor - np.diag(cov), 0) + 1e-9)
        factor = np.linalg.cholesky(cov)
        classes[label] = (np.log(n / total), mean, factor, np.log(np.diag(factor)).sum())
    return QuadraticModel(classes)


def score_quality(documents: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """A row per document: doc_id, held_out, score, predicted."""
    small_batches(documents.sparkSession)
    features = stored(document_statistics(documents))
    model = documents.sparkSession.sparkContext.broadcast(fit_quality(features, labels))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").flatten(), float).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.value.score(x), pa.float64())], ["doc_id", "score"])

    id_type = documents.schema["doc_id"].dataType.simpleString()
    out = features.mapInArrow(score, f"doc_id {id_type}, score double")
    return out.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
