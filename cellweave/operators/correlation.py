"""Correlation of genes over cells, in blocks.

Genes and cells are numbered. Entries of one block of genes and one block of cells make a dense piece of bounded size, two
pieces of the same cells a block of products, and these are summed over the cells, a bounded number at a time. With the
sums of each gene, products become correlations (absent entries are zeros and need no row). Of each block of correlations
only the first ``n_cut`` partners of a gene go on, so no table holds all pairs of genes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.lineage import cut
from cellweave.operators.ordering import global_index

#: Sides of a dense piece (8 MB), and blocks of products (half a MB each) that are summed by a task.
GENES, CELLS, SUMMED = 256, 4_096, 64


def _multiply(genes: int, cells: int):
    def dense(part: pa.Table, g: str, c: str, value: str) -> np.ndarray:
        out = np.zeros((genes, cells))
        np.add.at(out, (part[g].to_numpy(), part[c].to_numpy()), part[value].to_numpy())
        return out

    def multiply(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.num_rows and right.num_rows
        block = (dense(left, "g", "c", "value") @ dense(right, "og", "oc", "ovalue").T).tobytes() if rows else b""
        names = ("b1", "b2", "part", "block")
        return pa.table(dict(zip(names, ([k.as_py()] if rows else [] for k in key), strict=False)) | {"block": pa.array([block] if rows else [], pa.binary())}).cast(_BLOCKS)

    return multiply


_BLOCKS = pa.schema([("b1", pa.int32()), ("b2", pa.int32()), ("part", pa.int64()), ("block", pa.binary())])
_BLOCK_SCHEMA = "b1 int, b2 int, part bigint, block binary"


def _add(part: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b.as_py()) for b in part["block"])
    one = {c: [part[c][0].as_py()] for c in ("b1", "b2", "part")}
    return pa.table(one | {"block": [total.tobytes()]}).cast(_BLOCKS)


def similar_genes(expr: DataFrame, n_cut: int = 100, digits: int = 12, genes: int = GENES, cells: int = CELLS) -> DataFrame:
    """(gene, other, corr, rank): the ``n_cut`` genes, itself among them, whose values correlate best with a gene's.

    ``expr`` is (cell, gene_id, value) with at most one row per cell and gene; cells are those that it holds. Equal
    correlations (to ``digits`` digits, as sums differ by the order of their parts) go by name. A gene of one value in all
    cells correlates with none, and has no row.
    """
    expr = cut(expr.select("cell", "gene_id", F.col("value").cast("double").alias("value")))
    gene_at, cell_at = cut(global_index(expr, "gene_id")), cut(global_index(expr, "cell"))
    n_genes, n_cells = gene_at.count(), cell_at.count()
    blocks = math.ceil(n_genes / genes)
    number = lambda index, size: (F.floor((F.col(index) - 1) / size), (F.col(index) - 1) % size)
    numbered = expr.join(gene_at.withColumnRenamed("index", "gi"), "gene_id").join(cell_at.withColumnRenamed("index", "ci"), "cell")
    (block, g), (part, c) = number("gi", genes), number("ci", cells)
    entries = cut(numbered.select(block.cast("int").alias("b"), g.cast("int").alias("g"), part.alias("part"), c.cast("int").alias("c"), "value"))
    later = F.sequence(F.col("b"), F.lit(max(blocks - 1, 0)))
    earlier = F.sequence(F.lit(0), F.col("b"))
    left = entries.select(F.col("b").alias("b1"), F.explode(later).alias("b2"), "part", "g", "c", "value")
    own = [F.col(c).alias(f"o{c}") for c in ("g", "c", "value")]
    right = entries.select(F.explode(earlier).alias("b1"), F.col("b").alias("b2"), "part", *own)
    keys = ["b1", "b2", "part"]
    products = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_multiply(genes, cells), _BLOCK_SCHEMA)
    parts = math.ceil(n_cells / cells)
    while parts > 1:
        products = products.withColumn("part", F.floor(F.col("part") / SUMMED)).groupBy(*keys).applyInArrow(_add, _BLOCK_SCHEMA)
        parts = math.ceil(parts / SUMMED)

    # The sums of a block of genes, as one row that joins its products.
    sums = numbered.groupBy(block.cast("int").alias("b"), g.cast("int").alias("g")).agg(
        F.sum("value").alias("x"), F.sum(F.col("value") * F.col("value")).alias("xx")
    )
    own = sums.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("g", "x", "xx"))).alias("sums"))  # ``genes`` entries at most
    ready = products.join(own.select(F.col("b").alias("b1"), F.col("sums").alias("s1")), "b1").join(own.select(F.col("b").alias("b2"), F.col("sums").alias("s2")), "b2")

    def correlate(batches):
        for batch in batches:
            out = [[], [], []]
            for row in batch.to_pylist():
                xy = np.frombuffer(row["block"]).reshape(genes, genes)
                (g1, x1, v1), (g2, x2, v2) = (_margins(row[s], n_cells) for s in ("s1", "s2"))
                cov = n_cells * xy[np.ix_(g1, g2)] - np.outer(x1, x2)
                with np.errstate(divide="ignore", invalid="ignore"):
                    corr = np.round(cov / np.sqrt(np.outer(v1, v2)), digits)
                first, second = g1 + genes * row["b1"] + 1, g2 + genes * row["b2"] + 1
                sides = [(first, second, corr)] + ([(second, first, corr.T)] if row["b1"] != row["b2"] else [])
                for mine, others, values in sides:
                    values = np.where(np.isfinite(values), values, -np.inf)
                    # numbers follow the order of names, so ties keep the smaller name
                    best = np.argsort(-values, axis=1, kind="stable")[:, :n_cut]
                    found = np.take_along_axis(values, best, 1)
                    keep = np.isfinite(found)
                    for into, x in zip(out, (np.repeat(mine, keep.sum(1)), others[best][keep], found[keep]), strict=True):
                        into.append(x)
            yield pa.RecordBatch.from_pydict({n: np.concatenate(x) for n, x in zip(("gi", "oi", "corr"), out, strict=True)})

    pairs = ready.repartition("b1", "b2").mapInArrow(correlate, "gi bigint, oi bigint, corr double")
    order = Window.partitionBy("gi").orderBy(F.desc("corr"), "oi")
    top = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_cut)
    gene = gene_at.select(F.col("gene_id").alias("gene"), F.col("index").alias("gi"))
    other = gene_at.select(F.col("gene_id").alias("other"), F.col("index").alias("oi"))
    return top.join(gene, "gi").join(other, "oi").select("gene", "other", "corr", "rank")


def _margins(sums: list[dict], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the genes, their sums, and n times their sums of squared deviations."""
    g, x, xx = (np.array([s[k] for s in sums]) for k in ("g", "x", "xx"))
    return g, x, n * xx - x * x
