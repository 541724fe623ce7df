"""Run summary: saturation, species statistics, rRNA share and depth subsampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.seq import probe_kmers, reference_kmers, reverse_complement
from cellweave.functions.stats import stable_uniform
from cellweave.operators.quantiles import exact_quantiles


def saturation(molecules: DataFrame) -> DataFrame:
    return molecules.agg((1 - F.count("*") / F.sum("counts")).alias("saturation"))


def genome_shares(molecules: DataFrame) -> DataFrame:
    """Molecules and share per genome; the window spans one row per genome."""
    n = molecules.groupBy("genome").agg(F.count("*").alias("molecules"))
    return n.withColumn("share", F.col("molecules") / F.sum("molecules").over(Window.partitionBy()))


def species_summary(molecules: DataFrame, matrix: DataFrame, cells: DataFrame) -> DataFrame:
    """Per called species: cells, exact medians of molecules and genes, share in cells, exonic share.

    Medians run over the cells of the species and count its own molecules and genes only.
    """
    per = matrix.groupBy("cell_barcode", "genome").agg(
        F.sum("value").cast("bigint").alias("umis"), F.count("*").alias("genes")
    )
    called = cells.where("species <> 'multiplet'").select("cell_barcode", F.col("species").alias("genome"))
    own = called.join(per, ["cell_barcode", "genome"])
    medians = exact_quantiles(own, {"median_umis": ("umis", 0.5), "median_genes": ("genes", 0.5)}, ["genome"]).join(
        own.groupBy("genome").agg(F.count("*").alias("n_cells")), "genome"
    )
    in_cells = per.groupBy("genome").agg(F.sum("umis").alias("_in"))
    total = molecules.groupBy("genome").agg(F.count("*").alias("_all"))
    exonic = (
        molecules.join(matrix.select("cell_barcode").distinct(), "cell_barcode", "left_semi")
        .groupBy("genome").agg(F.avg(F.col("exonic").cast("double")).alias("exonic_fraction"))
    )
    return (
        medians.join(in_cells, "genome").join(total, "genome").join(exonic, "genome")
        .select(
            "genome", "n_cells", "median_umis", "median_genes",
            (F.col("_in") / F.col("_all")).alias("fraction_in_cells"),
            "exonic_fraction",
        )
    )


def run_summary(
    molecules: DataFrame, matrix: DataFrame, fastq_reads: Column, total_reads: Column, mapped: Column
) -> DataFrame:
    """One row of run-wide numbers. The three columns are scalars from earlier steps."""
    in_matrix = matrix.agg(
        F.count_distinct("cell_barcode").alias("cells"), F.sum("value").alias("umis")
    )
    mols = molecules.agg(F.count("*").alias("rows"), F.sum("counts").alias("reads"))
    one = mols.withColumns(
        {
            "estimated_cells": in_matrix.select("cells").scalar(),
            "_umis": in_matrix.select("umis").scalar(),
            "number_of_reads": fastq_reads.cast("bigint"),
            "_total": total_reads.cast("double"),
            "_mapped": mapped.cast("double"),
        }
    )
    return one.select(
        "estimated_cells",
        "number_of_reads",
        F.try_divide(F.col("number_of_reads").cast("double"), "estimated_cells").alias("mean_reads_per_cell"),
        (1 - F.try_divide(F.col("rows").cast("double"), "reads")).alias("sequencing_saturation"),
        F.try_divide("_total", F.col("number_of_reads").cast("double")).alias("reads_mapped_to_genome"),
        F.try_divide("_mapped", "_total").alias("reads_mapped_to_gene"),
        F.try_divide(F.col("_umis").cast("double"), "rows").alias("fraction_reads_in_cells"),
    )


def as_lines(row: DataFrame, stage: str) -> DataFrame:
    """(stage, key, value) of a frame of one row of numbers."""
    pairs = [F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in row.columns]
    return row.select(F.lit(stage).alias("stage"), F.inline(F.array(*pairs)))


def kmer_reference(fasta: DataFrame, k: int = 30) -> DataFrame:
    """(kmer, strand) of both strands of the reference lines; 'sense' where a k-mer is on both."""
    both = fasta.select(
        F.inline(
            F.array(
                F.struct(F.lit("sense").alias("strand"), F.col("seq").alias("s")),
                F.struct(F.lit("antisense").alias("strand"), reverse_complement("seq").alias("s")),
            )
        )
    )
    return both.select("strand", F.explode(reference_kmers("s", k)).alias("kmer")).groupBy("kmer").agg(
        F.max("strand").alias("strand")
    )


def kmer_hits(reads: DataFrame, kmers: DataFrame, k: int = 30, id_col: str = "ordinal") -> DataFrame:
    """(id, strand): reads with a probe k-mer in the reference; sense wins over antisense.

    Only probes that meet the reference survive the join, so the grouping sees few rows. The planner's estimate does
    not count the k-mers that a line is exploded into, so the reference would be broadcast at any size: it is merged.
    """
    probes = reads.select(id_col, F.explode(probe_kmers("seq", k)).alias("kmer")).where(
        F.length("kmer") == k
    )
    return probes.join(kmers.hint("merge"), "kmer").groupBy(id_col).agg(F.max("strand").alias("strand"))


def kmer_summary(reads: DataFrame, kmers: DataFrame, k: int = 30) -> DataFrame:
    """Reads seen, sense and antisense hits, and the hit share, over all reads."""
    hits = kmer_hits(reads, kmers, k).agg(
        F.count_if(F.col("strand") == "sense").alias("sense"),
        F.count_if(F.col("strand") == "antisense").alias("antisense"),
    )
    total = reads.agg(F.count("*").alias("n"))
    return hits.withColumn("total_counts", total.scalar()).withColumn(
        "fraction", F.try_divide((F.col("sense") + F.col("antisense")).cast("double"), "total_counts")
    )


def read_lengths(reads: DataFrame) -> DataFrame:
    return reads.groupBy(F.length("seq").alias("length")).agg(F.count("*").alias("n"))


def subsample_curves(
    molecules: DataFrame, cells: DataFrame, reads: Column | int, step: int = 1000, seed: int = 0
) -> DataFrame:
    """(genome, depth, median_genes, median_umis) at depths 0, step, 2*step, ... full depth.

    Thinning a molecule of c reads to a fraction p leaves something with probability
    1 - (1-p)^c. One uniform draw u per molecule therefore tells the fraction from which it is
    seen on: 1 - (1-u)^(1/c). Molecules are counted at the first depth that shows them and summed
    along the depths per cell; they are never repeated per depth. At the full depth all are seen.
    As in the original plot, cells without any molecule at a depth are left out of its median.
    """
    called = cells.where("species <> 'multiplet'").select("cell_barcode", F.col("species").alias("genome"))
    n_cells = called.groupBy("genome").agg(F.count("*").alias("n"))
    if not isinstance(reads, Column):
        reads = F.lit(reads)
    depth = genome_shares(molecules).join(n_cells, "genome").select(
        "genome", (F.col("share") * reads / F.col("n")).alias("full")
    )
    depth = depth.withColumn("last", F.ceil(F.floor("full") / step).cast("int"))
    own = molecules.join(called, ["cell_barcode", "genome"], "left_semi").join(depth, "genome")
    u = stable_uniform(F.col("cell_barcode"), F.col("gene"), F.col("umi"), seed=seed)
    seen_from = 1 - F.pow(1 - u, 1 / F.col("counts"))
    at = F.least(F.greatest(F.ceil(seen_from * F.col("full") / step), F.lit(1)), F.col("last")).cast("int")
    first = own.select("genome", "cell_barcode", "gene", "last", "full", at.alias("at"))
    per_gene = first.groupBy("genome", "cell_barcode", "gene", "last", "full").agg(
        F.min("at").alias("gene_at")
    )
    umis = first.groupBy("genome", "cell_barcode", "last", "full", "at").agg(F.count("*").alias("umis"))
    genes = per_gene.groupBy("genome", "cell_barcode", "last", "full", F.col("gene_at").alias("at")).agg(
        F.count("*").alias("genes")
    )
    steps = (
        umis.withColumn("genes", F.lit(0).cast("bigint"))
        .unionByName(genes.withColumn("umis", F.lit(0).cast("bigint")))
        .groupBy("genome", "cell_barcode", "last", "full", "at")
        .agg(F.sum("umis").alias("umis"), F.sum("genes").alias("genes"))
    )
    order = Window.partitionBy("genome", "cell_barcode").orderBy("at")
    grown = steps.select(
        "genome", "cell_barcode", "last", "full", "at",
        F.sum("umis").over(order).alias("umis"),
        F.sum("genes").over(order).alias("genes"),
        F.coalesce(F.lead("at").over(order) - 1, F.col("last")).alias("until"),
    )
    per_depth = grown.select("genome", "last", "full", "umis", "genes", F.explode(F.sequence("at", "until")).alias("i"))
    curve = exact_quantiles(per_depth, {"median_genes": ("genes", 0.5), "median_umis": ("umis", 0.5)}, ["genome", "i", "last", "full"])
    at_depth = F.when(F.col("i") == F.col("last"), F.floor("full")).otherwise(F.col("i") * step).cast("bigint")
    start = depth.select(
        "genome", F.lit(0).cast("bigint").alias("depth"),
        F.lit(0.0).alias("median_genes"), F.lit(0.0).alias("median_umis"),
    )
    return start.unionByName(
        curve.select("genome", at_depth.alias("depth"), "median_genes", "median_umis")
    )
