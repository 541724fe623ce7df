"""Mutated alleles from pileups of tumor and normal cells."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cellweave.lineage import cut
from cellweave.operators import mutation


def call_mutations(
    tumor: DataFrame, normal: DataFrame, tumor_depth: int = 10, tumor_reads: int = 5,
    normal_depth: int = 3, normal_reads: int = 3,
) -> dict[str, DataFrame]:
    """Tumor sites with two supported alleles, normal counts there, and alleles unlike the wild type."""
    found = cut(mutation.allele_counts(mutation.pileup_sites(tumor, tumor_depth), tumor_reads, 2))
    sites = found.select("chrom", "pos").distinct()
    at_sites = normal.join(sites, ["chrom", "pos"], "left_semi")
    background = mutation.allele_counts(mutation.pileup_sites(at_sites, normal_depth), normal_reads, 1)
    return {
        "tumor": found,
        "sites": mutation.site_bed(found),
        "normal": background,
        "mutated": mutation.mutated_alleles(found, background),
    }
