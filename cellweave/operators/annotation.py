"""GTF rows to gene, exon and bin tables, and the assignment of reads to genes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.seq import genome_from_contig
from cellweave.operators.intervals import bin_of, clip_to_bins, point_join, union_within_bins

GENE_BIN = 10_000
EXON_BIN = 1_000
# Starts are scanned per block of this many bases so that no window covers a whole contig.
SCAN_BLOCK = 1_000_000


def gtf_attribute(attributes: Column, key: str) -> Column:
    """Value of one GTF attribute, '' when absent; the last value wins when a key repeats."""
    found = F.regexp_extract_all(attributes, F.lit(rf'(?:^|; ){key} "?([^";]*)"?'), F.lit(1))
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))


def select_attributes(gtf: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pick GTF columns and attributes by name."""
    fixed = set(gtf.columns)
    return gtf.select(
        *[F.col(n) if n in fixed else gtf_attribute(F.col("Attributes"), n).alias(n) for n in names]
    )


def combine_gtfs(gtfs: dict[str, DataFrame]) -> DataFrame:
    """Union of per-species GTFs with the species put in front of each contig name."""
    out = None
    for rank, (species, gtf) in enumerate(gtfs.items()):
        part = gtf.withColumns(
            {
                "Chromosome": F.concat_ws("_", F.lit(species), F.col("Chromosome").cast("string")),
                "ordinal": F.struct(
                    F.lit(rank).alias("file"), F.monotonically_increasing_id().alias("row")
                ),
            }
        )
        out = part if out is None else out.unionByName(part)
    return out


def gene_table(gtf: DataFrame, splicing: bool = True, biotypes: Sequence[str] | None = None) -> DataFrame:
    """One row per gene: widest span, first contig and strand, last name and biotype seen.

    Without splicing the exon rows stand in for gene rows. ``gtf`` needs an ``ordinal`` column.
    """
    rows = gtf.where(F.col("Feature") == ("gene" if splicing else "exon"))
    a = F.col("Attributes")
    rows = rows.select(
        "Chromosome", "Strand", "Start", "End", "ordinal",
        gtf_attribute(a, "gene_id").alias("gene_id"),
        gtf_attribute(a, "gene_name").alias("gene_name"),
        gtf_attribute(a, "gene_biotype").alias("biotype"),
    )
    if biotypes is not None:
        rows = rows.where(F.col("biotype").isin(list(biotypes)))
    return rows.groupBy("gene_id").agg(
        F.max_by("gene_name", "ordinal").alias("gene_name"),
        genome_from_contig(F.max_by("Chromosome", "ordinal")).alias("genome"),
        F.min_by("Chromosome", "ordinal").alias("chrom"),
        F.min_by("Strand", "ordinal").alias("strand"),
        F.max_by("biotype", "ordinal").alias("biotype"),
        F.min("Start").cast("bigint").alias("start"),
        F.max("End").cast("bigint").alias("end"),
    )


def exon_table(gtf: DataFrame) -> DataFrame:
    """Distinct exon starts per gene with the furthest end; coordinates stay 1-based closed."""
    return (
        gtf.where(F.col("Feature") == "exon")
        .select(gtf_attribute(F.col("Attributes"), "gene_id").alias("gene_id"), "Start", "End")
        .groupBy("gene_id", F.col("Start").cast("bigint").alias("start"))
        .agg(F.max("End").cast("bigint").alias("end"))
    )


def gene_bins(genes: DataFrame, step: int = GENE_BIN) -> DataFrame:
    """(chrom, bin, strand, gene_id) from floor(start) to ceil(end) in steps of ``step``."""
    lo = F.floor(F.col("start") / step) * step
    hi = F.ceil(F.col("end") / step) * step
    return genes.select(
        "chrom", "strand", "gene_id", F.explode(F.sequence(lo, hi, F.lit(step))).alias("bin")
    )


def gene_segments(genes: DataFrame, stranded: bool = True) -> DataFrame:
    """Cut each contig at the gene starts and keep what a containment test needs there.

    For a read starting in a segment, the genes that begin at or before it are known: the
    furthest end among them, its gene, and the second furthest end. A read ending at q lies
    within no gene if q > reach, within ``gene_id`` alone if runner_up < q <= reach, and within
    several otherwise. So a read meets exactly one row here, however many genes pile up.

    The running maxima are taken inside blocks of SCAN_BLOCK bases; a carry per block joins them,
    which keeps every window small even if one contig holds most genes.
    """
    keys = ["chrom", "strand"] if stranded else ["chrom"]
    top = Window.partitionBy(*keys, "start").orderBy(F.desc("end"), "gene_id")
    per_start = (
        genes.select(*keys, "start", "end", "gene_id")
        .withColumn("_rank", F.row_number().over(top))
        .where("_rank <= 2")
        .groupBy(*keys, "start")
        .agg(
            F.max(F.when(F.col("_rank") == 1, F.col("end"))).alias("e1"),
            F.max(F.when(F.col("_rank") == 1, F.col("gene_id"))).alias("g1"),
            F.max(F.when(F.col("_rank") == 2, F.col("end"))).alias("e2"),
        )
        .withColumn("block", bin_of(F.col("start"), SCAN_BLOCK))
    )

    def running(df: DataFrame, parts: list[str], order: str, through: int, names) -> DataFrame:
        reach, gene, runner = names
        w = Window.partitionBy(*parts).orderBy(order)
        upto = w.rowsBetween(Window.unboundedPreceding, through)
        earlier = F.max("e1").over(w.rowsBetween(Window.unboundedPreceding, -1))
        # What each row pushes out of first place is itself or the previous leader.
        pushed = F.greatest(F.col("e2"), F.when(earlier.isNotNull(), F.least(F.col("e1"), earlier)))
        return df.withColumn("_pushed", pushed).withColumns(
            {
                reach: F.max("e1").over(upto),
                gene: F.max_by("g1", "e1").over(upto),
                runner: F.max("_pushed").over(upto),
            }
        ).drop("_pushed")

    inside = running(per_start, [*keys, "block"], "start", 0, ("_reach", "_gene", "_runner"))
    inside = inside.withColumn(
        "_next", F.lead("start").over(Window.partitionBy(*keys, "block").orderBy("start"))
    )
    blocks = inside.groupBy(*keys, "block").agg(
        F.max("_reach").alias("e1"),
        F.max_by("_gene", "_reach").alias("g1"),
        F.max("_runner").alias("e2"),
        F.min("start").alias("first_start"),
    )
    carry = running(blocks, keys, "block", -1, ("c_reach", "c_gene", "c_runner"))
    carry = carry.withColumn(
        "c_next", F.lead("first_start").over(Window.partitionBy(*keys).orderBy("block"))
    ).select(*keys, "block", "c_reach", "c_gene", "c_runner", "c_next")

    both = inside.join(carry, [*keys, "block"])
    leads = F.col("c_reach").isNotNull() & (F.col("c_reach") >= F.col("_reach"))
    reach = F.greatest("_reach", "c_reach")
    runner = F.greatest(
        "_runner", "c_runner",
        F.when(F.col("c_reach").isNotNull(), F.least("_reach", "c_reach")),
    )
    upper = F.least(F.coalesce(F.col("_next"), F.col("c_next"), reach + 1), reach + 1)
    return both.select(
        *keys,
        F.col("start").alias("seg_start"),
        upper.alias("seg_end"),
        reach.alias("reach"),
        F.when(leads, F.col("c_gene")).otherwise(F.col("_gene")).alias("gene_id"),
        runner.alias("runner_up"),
    )


def assign_genes(
    reads: DataFrame,
    genes: DataFrame,
    first: str = "first_pos",
    last: str = "last_pos",
    stranded: bool = True,
    bin_width: int = GENE_BIN,
) -> DataFrame:
    """Add ``gene``: the single gene containing the read, else Intergenic_/Ambiguous_{genome}.

    ``reads`` need chrom, genome and (if stranded) strand. Reads keep their partitioning when
    the segments are small enough to broadcast, and are shuffled once otherwise.
    """
    keys = ["chrom", "strand"] if stranded else ["chrom"]
    hit = point_join(
        reads, gene_segments(genes, stranded), keys, first, ("seg_start", "seg_end"), bin_width, "left"
    )
    q = F.col(last)
    n = F.when(F.col("reach") >= q, F.when(F.col("runner_up") >= q, 2).otherwise(1)).otherwise(0)
    gene = (
        F.when(n == 1, F.col("gene_id").cast("string"))
        .when(n == 2, F.concat_ws("_", F.lit("Ambiguous"), "genome"))
        .otherwise(F.concat_ws("_", F.lit("Intergenic"), "genome"))
    )
    return hit.withColumns({"gene": gene, "in_gene": F.coalesce(n == 1, F.lit(False))}).drop(
        "seg_start", "seg_end", "reach", "gene_id", "runner_up"
    )


def mark_exonic(
    reads: DataFrame,
    exons: DataFrame,
    read_key: str,
    carry: Sequence[str],
    blocks: str = "blocks",
    bin_width: int = EXON_BIN,
) -> DataFrame:
    """(read_key, carry..., gene, exonic): does more than half of the aligned read lie in exons?

    Exons are 1-based closed and compared with 0-based positions as they are. ``read_key``
    must identify a read; ``carry`` are columns that are constant per read.
    """
    size = F.aggregate(blocks, F.lit(0).cast("bigint"), lambda acc, b: acc + b["end"] - b["start"])
    keys = [read_key, *carry, "gene", "_size"]
    spans = reads.where("in_gene").select(
        read_key, *carry, "gene", size.alias("_size"), F.explode(blocks).alias("_b")
    ).select(*keys, F.col("_b.start").alias("bs"), F.col("_b.end").alias("be"))
    parts = clip_to_bins(spans, "bs", "be", bin_width)
    half_open = exons.select(
        F.col("gene_id").cast("string").alias("gene"),
        F.col("start").alias("xs"),
        (F.col("end") + 1).alias("xe"),
    )
    covered = union_within_bins(half_open, ["gene"], "xs", "xe", bin_width)
    shared = F.greatest(
        F.lit(0), F.least(F.col("be"), F.col("xe")) - F.greatest(F.col("bs"), F.col("xs"))
    )
    inside = (
        parts.join(covered, ["gene", "bin"], "left")
        .groupBy(*keys)
        .agg(F.sum(F.when(F.col("xs").isNotNull(), shared).otherwise(0)).alias("_in"))
        .select(read_key, *carry, "gene", (F.col("_in") / F.col("_size") > 0.5).alias("exonic"))
    )
    outside = reads.where(~F.col("in_gene")).select(
        read_key, *carry, "gene", F.lit(False).alias("exonic")
    )
    return inside.unionByName(outside)
