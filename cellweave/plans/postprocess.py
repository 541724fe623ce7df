"""From alignments to molecules, expression reports and chromatin quality."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.config import AssayConfig
from cellweave.lineage import cut
from cellweave.operators import annotation, atac, dge, molecules, report
from cellweave.sources import sinks


def umi_reads(spans: DataFrame, genes: DataFrame, exons: DataFrame, stranded: bool) -> DataFrame:
    """Reads per cell, gene and UMI, before UMIs are collapsed."""
    # Every alignment counts: mates and further alignments share their read's name, so it is no key.
    numbered = spans.withColumn("alignment", F.monotonically_increasing_id())
    hits = annotation.assign_genes(numbered, genes, stranded=stranded)
    exonic = annotation.mark_exonic(hits, exons, "alignment", ["cell_barcode", "genome", "umi"])
    return molecules.count_umis(exonic)


def _molecules(spans: DataFrame, genes: DataFrame, exons: DataFrame, stranded: bool) -> DataFrame:
    counts = cut(umi_reads(spans, genes, exons, stranded))
    return molecules.with_gene_names(molecules.collapse_umis(counts), genes)


def rna_molecules(alignments: DataFrame, genes: DataFrame, exons: DataFrame) -> DataFrame:
    spans = molecules.block_span(molecules.rna_alignments(alignments))
    return _molecules(spans, genes, exons, stranded=True)


def atac_molecules(
    alignments: DataFrame, genes: DataFrame, exons: DataFrame, cfg: AssayConfig, stranded: bool = True
) -> DataFrame:
    """Only forward mates are counted, so with ``stranded`` no gene of the minus strand is hit."""
    usable = molecules.atac_alignments(alignments, cfg.min_mapq, cfg.max_flen)
    return _molecules(molecules.fragment_span(usable), genes, exons, stranded)


@dataclass(frozen=True)
class ExpressionReport:
    threshold: DataFrame
    matrix: DataFrame
    cells: DataFrame
    called: DataFrame
    called_matrix: DataFrame
    genes: DataFrame
    species: DataFrame


def expression_report(
    mols: DataFrame, genes: DataFrame, rna: bool = True, frac_low: float = 0.3, frac_high: float = 0.925,
    cutoff: float = 100, try_iter: int = 10, window: int = 20,
) -> ExpressionReport:
    """Matrix, cell calls and per-species numbers. ``mols`` should be stored: it is read repeatedly."""
    used = dge.genic(mols) if rna else mols
    threshold = cut(
        dge.read_threshold(dge.cell_totals(used), frac_low, frac_high, cutoff, try_iter, window)
    )
    matrix = cut(dge.count_matrix(used, 10))
    cells = cut(dge.cell_metadata(matrix))
    called = dge.called_cells(cells, threshold)
    strict = cut(dge.count_matrix(used, threshold.scalar()))
    return ExpressionReport(
        threshold, matrix, cells, called,
        matrix.join(called.select("cell_barcode"), "cell_barcode", "left_semi"),
        dge.gene_metadata(matrix, genes),
        report.species_summary(used, strict, dge.cell_metadata(strict)),
    )


def write_report(rep: ExpressionReport, path: str) -> None:
    for name, matrix, cells in (
        ("DGE_unfiltered", rep.matrix, rep.cells), ("DGE_filtered", rep.called_matrix, rep.called)
    ):
        # Both matrices keep all genes of the unfiltered one, and line i of genes.csv is row i.
        rows = sinks.write_matrix_market(matrix, f"{path}/{name}", "gene", features=rep.matrix)
        sinks.write_csv(cells, f"{path}/{name}/cell_metadata.csv")
        named = rep.genes.groupBy("gene_id").agg(*[F.min(c).alias(c) for c in rep.genes.columns if c != "gene_id"])
        numbered = named.join(rows.withColumnRenamed("gene", "gene_id"), "gene_id").orderBy("index")
        sinks.write_csv(numbered.select(*rep.genes.columns), f"{path}/{name}/genes.csv")
    sinks.write_csv(rep.species, f"{path}/analysis/species_summary.csv")


def run_lines(
    mols: DataFrame, rep: ExpressionReport, alignments: DataFrame | None = None, cfg: AssayConfig | None = None,
    n_reads: int | None = None, rna: bool = True,
) -> DataFrame:
    """(stage, key, value) of a run: totals, saturation, summary and, for chromatin reads, the filter funnel.

    ``n_reads`` is the number of sequenced reads; without it the reads of all molecules stand in.
    """
    used = dge.genic(mols) if rna else mols
    totals = cut(molecules.molecule_totals(mols))
    total, mapped = (totals.select(c).scalar() for c in ("total_read_count", "mapped_to_gene"))
    summary = report.run_summary(used, rep.called_matrix, total if n_reads is None else F.lit(n_reads), total, mapped)
    lines = [
        report.as_lines(totals, "molecules"),
        report.as_lines(report.saturation(used), "saturation"),
        report.as_lines(summary, "summary"),
        report.as_lines(rep.threshold, "knee"),
    ]
    shares = report.genome_shares(used).select(F.lit("genome").alias("stage"), F.col("genome").alias("key"), F.col("share").alias("value"))
    if alignments is not None and not rna:
        limits = (cfg.min_mapq, cfg.max_flen) if cfg else ()
        lines.append(report.as_lines(molecules.atac_funnel(alignments, *limits), "funnel"))
    out = shares
    for part in lines:
        out = out.unionByName(part)
    return out


def write_run_report(
    mols: DataFrame, rep: ExpressionReport, path: str, alignments: DataFrame | None = None, cfg: AssayConfig | None = None,
    n_reads: int | None = None, rna: bool = True, rrna: DataFrame | None = None, rna_reads: DataFrame | None = None,
) -> None:
    """The run's numbers and plotted tables under {path}/analysis; rRNA share and read lengths if reads are given."""
    used = dge.genic(mols) if rna else mols
    sinks.write_csv(run_lines(mols, rep, alignments, cfg, n_reads, rna).orderBy("stage", "key"), f"{path}/analysis/summary.csv")
    reads = mols.agg(F.sum("counts")).scalar() if n_reads is None else F.lit(n_reads)
    sinks.write_csv(report.subsample_curves(used, rep.called, reads), f"{path}/analysis/subsampling.csv")
    sinks.write_csv(rep.cells.groupBy("umi_count").agg(F.count("*").alias("cells")), f"{path}/analysis/depth_histogram.csv")
    per_genome = rep.matrix.groupBy("cell_barcode", "genome").agg(F.sum("value").alias("umis"), F.count("*").alias("genes"))
    sinks.write_csv(per_genome, f"{path}/analysis/barnyard.csv")
    if rna_reads is not None:
        sinks.write_csv(report.read_lengths(rna_reads), f"{path}/analysis/read_lengths.csv")
        if rrna is not None:
            sinks.write_csv(report.kmer_summary(rna_reads, report.kmer_reference(rrna)), f"{path}/analysis/rrna.csv")


def chromatin_qc(
    spark: SparkSession, reads: DataFrame, tss: DataFrame, cfg: AssayConfig
) -> dict[str, DataFrame]:
    """Per-cell scores, the cells that pass, the overall profile, fragment sizes and medians."""
    scores = cut(atac.tss_scores(reads, tss))
    histogram = atac.tss_insertions(reads, tss)
    passing = atac.filter_cells(scores, cfg.cutumi, cfg.cuttss)
    return {
        "scores": scores,
        "cells": passing,
        "profile": atac.tss_profile(spark, histogram),
        "fragments": atac.fragment_lengths(reads),
        "medians": atac.qc_medians(scores, cfg.cutumi, cfg.cuttss),
        "reads": atac.filter_reads_by_cells(reads, passing),
    }


def region_matrix(
    reads: DataFrame, regions: DataFrame, path: str | None = None, summits: bool = False, binary: bool = False
) -> DataFrame:
    """Counts per region and cell; ``regions`` are windows, promoters or (``summits``) peak summits."""
    spans = atac.extend_summits(regions, 500) if summits else regions
    counts = atac.count_regions(spans, atac.shifted_fragments(reads), binary)
    if path is not None:
        stored = cut(counts)
        sinks.write_matrix_market(stored, path, "peak", kind="integer", feature_file="peaks")
        return stored
    return counts
