"""Peak-gene association from two matrices to corrected links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.lineage import cut
from cellweave.operators import links


def associate(
    expression: DataFrame, accessibility: DataFrame, genes: DataFrame, peak_gc: DataFrame,
    window_kb: int = 500, run: int = 100, min_cells: int = 5, min_genes: int = 100, min_peaks: int = 100,
) -> dict[str, DataFrame]:
    """mi and links for matrices (cell, gene_id, value) and (cell, peak, value).

    ``peak_gc`` is (peak, gc_content). Intermediate tables are checkpointed because each feeds
    several later joins.
    """
    expr = cut(links.filter_matrix(expression, "gene_id", min_cells, min_genes))
    acc = cut(links.filter_matrix(links.binarise(accessibility), "peak", min_cells, min_peaks))
    info = links.feature_cells(acc, "peak").join(peak_gc, "peak")
    background = links.background_peaks(info, run)
    cells = links.common_cells(expr, acc)
    expr = cut(expr.join(cells, "cell", "left_semi"))
    acc = cut(acc.where("value > 0").join(cells, "cell", "left_semi").select("cell", "peak"))
    peaks = links.peak_table(acc.select("peak").distinct())
    near = links.peaks_near_genes(links.gene_tss(genes), peaks, window_kb)
    near = cut(near.join(expr.select("gene_id").distinct(), "gene_id", "left_semi"))
    n = expr.agg(F.count_distinct("cell").alias("n")).scalar()
    mi = cut(links.mutual_information(links.background_pairs(near, background), expr, acc, n))
    return {"mi": mi, "links": cut(links.link_statistics(mi, near, background))}


def finish(found: DataFrame, genes: DataFrame, alpha: float = 0.05) -> DataFrame:
    """FDR over all links of positive z, with gene name and TSS."""
    return links.merge_links(links.correct_fdr(found, alpha), genes)
