"""Command line: spark-submit this package with a mode. Tables between steps are parquet."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cellweave.config import AssayConfig
from cellweave.lineage import cut
from cellweave.operators import annotation, barcode, circle, intervals, links, molecules, mutation, pileup, trim
from cellweave.plans import demultiplex, mutations, postprocess, regulatory
from cellweave.sources import alignments, bam_regions, fasta, sinks, tables


def _config(path: str | None, spark: SparkSession) -> AssayConfig:
    if path is None:
        return AssayConfig()
    # A configuration is one small file.
    return AssayConfig.from_json(spark.read.text(path, wholetext=True).first()[0])


def _align(spark, path):
    if path.endswith(".bam"):
        return alignments.read_bam(spark, path)
    if path.endswith(".sam"):
        return alignments.read_sam(spark, path)
    return spark.read.parquet(path)


def _reference(spark, genome_dir):
    return spark.read.parquet(f"{genome_dir}/genes"), spark.read.parquet(f"{genome_dir}/exons")


def mkref(spark, a):
    gtf = annotation.combine_gtfs({s: tables.read_gtf(spark, g) for s, g in zip(a.species, a.gtf)})
    annotation.gene_table(gtf, not a.no_splicing).write.mode("overwrite").parquet(f"{a.out}/genes")
    annotation.exon_table(gtf).write.mode("overwrite").parquet(f"{a.out}/exons")
    sinks.write_combined_gtf(gtf, "exon", f"{a.out}/exons.gtf")
    sinks.write_combined_gtf(gtf, "exon" if a.no_splicing else "gene", f"{a.out}/genes.gtf")
    if a.fasta:
        sinks.write_combined_genome(fasta.combined_genome(spark, dict(zip(a.species, a.fasta))), f"{a.out}/genome.fa")


def preprocess(spark, a):
    cfg = _config(a.config, spark)
    whitelists = [tables.read_whitelist(spark, p) for p in a.whitelist]
    samples = tables.read_sample_barcodes(spark, a.sample_bc_list)
    # One row per library: a list of file names, not data.
    rows = tables.read_raw_list(spark, a.raw_list).orderBy("ordinal").collect()
    libraries = {r.lib_id: tables.read_fastq_pair(spark, r.fq1, r.fq2) for r in rows}
    tagged, stats = demultiplex.preprocess(libraries, whitelists, samples, cfg, work_dir=f"{a.out}/trimmed", stats=True)
    tagged.write.mode("overwrite").partitionBy("sample", "tag").parquet(f"{a.out}/split_sample")
    sinks.write_csv(stats, f"{a.out}/stats.csv")
    split = spark.read.parquet(f"{a.out}/split_sample")
    sinks.write_csv(barcode.sample_shares(split), f"{a.out}/sample_shares.csv")
    if a.fastq:
        # RNA reads lose their spacer and poly-A first.
        rna = trim.trim_rna(split.where("tag = 'R'"), cfg)
        sinks.write_fastq(split.where("tag <> 'R'").unionByName(rna.select(*split.columns)), f"{a.out}/fastq")


def postprocess_(spark, a):
    cfg = _config(a.config, spark)
    genes, exons = _reference(spark, a.genome_dir)
    reads = _align(spark, a.alignments)
    rna = a.datatype == "RNA"
    made = postprocess.rna_molecules(reads, genes, exons) if rna else postprocess.atac_molecules(reads, genes, exons, cfg)
    made.write.mode("overwrite").parquet(f"{a.out}/molecules")
    mols = spark.read.parquet(f"{a.out}/molecules")
    rep = postprocess.expression_report(
        mols, genes, rna, a.frac_low, a.frac_high, a.cutoff, a.try_iter, a.window
    )
    postprocess.write_report(rep, a.out)
    postprocess.write_run_report(mols, rep, a.out, reads, cfg, a.n_reads or None, rna)
    if rna:
        return
    kept = molecules.filter_atac_bam(reads, mols, rep.called, cfg.min_mapq, cfg.max_flen)
    kept.write.mode("overwrite").parquet(f"{a.out}/atac_qc/filtered")
    kept = spark.read.parquet(f"{a.out}/atac_qc/filtered")
    qc = postprocess.chromatin_qc(spark, kept, tables.read_bed(spark, a.tssref), cfg)
    for name in ("scores", "profile", "fragments", "medians"):
        sinks.write_csv(qc[name], f"{a.out}/atac_qc/{name}", "\t")
    if a.genome_size:
        regions = intervals.make_windows(tables.read_genome_sizes(spark, a.genome_size), a.bin)
    else:
        regions = tables.read_bed(spark, a.refbed)
    if a.countby == "peak":
        regions = regions.withColumnRenamed("score", "val")
    postprocess.region_matrix(qc["reads"], regions, f"{a.out}/{a.countby}", a.countby == "peak", a.binary)


def rereport(spark, a):
    """Repeat the expression report on stored molecules with other knee settings."""
    genes, _ = _reference(spark, a.genome_dir)
    mols = spark.read.parquet(a.molecules)
    rep = postprocess.expression_report(
        mols, genes, a.datatype == "RNA", a.frac_low, a.frac_high, a.cutoff, a.try_iter, a.window
    )
    postprocess.write_report(rep, a.out)
    postprocess.write_run_report(mols, rep, a.out, n_reads=a.n_reads or None, rna=a.datatype == "RNA")


def link(spark, a):
    genes = spark.read.parquet(f"{a.genome_dir}/genes")
    expr, acc = links.by_gene_id(spark.read.parquet(a.expression), genes), spark.read.parquet(a.accessibility)
    peaks = links.peak_table(acc.select("peak").distinct())
    genome = fasta.read_genome(spark, a.fasta)
    gc = cut(links.gc_content(peaks, genome.withColumn("chrom", links.bare_contig(F.col("chrom")))))
    lost = peaks.join(gc, "peak", "left_anti").first()
    if lost is not None:
        raise ValueError(f"the genome has no sequence for peak {lost.peak}")
    found = regulatory.associate(expr, acc, genes, gc, a.window_kb)["links"]
    sinks.write_links(regulatory.finish(found, genes), a.out)


def _pileup(spark, path, fasta_path):
    """Pileup rows of a file, or of alignments on a genome."""
    if not path.endswith((".bam", ".sam")):
        return tables.read_pileup(spark, path)
    if not fasta_path:
        raise ValueError("pileups of alignments need --fasta")
    return pileup.pileup_rows(_align(spark, path), fasta.read_genome(spark, fasta_path))


def mutate(spark, a):
    tumor, normal = (cut(_pileup(spark, path, a.fasta)) for path in (a.tumor, a.normal))
    out = mutations.call_mutations(tumor, normal)
    for name, df in out.items():
        df.write.mode("overwrite").parquet(f"{a.out}/{name}")
    sinks.write_bed(spark.read.parquet(f"{a.out}/sites"), f"{a.out}/sites.bed")


def cluster(spark, a):
    reads = None
    for batch, path in enumerate(a.alignments):
        part = _align(spark, path).withColumn("batch", F.lit(batch))
        reads = part if reads is None else reads.unionByName(part)
    split = mutation.split_by_cluster(reads, tables.read_clusters(spark, a.clusters), a.suffix)
    if a.bam:
        contigs = alignments.bam_contigs(spark, a.alignments[0])
        sinks.write_bam(split, contigs, a.out, by="label")
    else:
        split.write.mode("overwrite").partitionBy("label").parquet(a.out)


def index(spark, a):
    bam_regions.index_bam(spark, a.alignments, a.out)


def circles(spark, a):
    rows = circle.circle_columns(tables.read_circle_lines(spark, a.input))
    sinks.write_bed(circle.count_circles(circle.select_circles(rows)).select("chrom", "start", "end", "n", "cell_barcode"), a.out)


def convert(spark, a):
    r1, r2, r3 = (tables.read_fastq(spark, f"{a.prefix}_{r}_001.fastq.gz") for r in ("R1", "R2", "R3"))
    pairs = barcode.zip_index_reads(r1, r2, r3)
    for k, name in ((1, "R1"), (2, "R2")):
        line = sinks.fastq_lines(F.col(f"name{k}"), F.col(f"seq{k}"), F.col(f"qual{k}"))
        pairs.orderBy("ordinal").select(line.alias("value")).write.mode("overwrite").text(f"{a.out}/{name}_001.fastq")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cellweave")
    sub = p.add_subparsers(dest="mode", required=True)

    def mode(name, fn, *required, **optional):
        m = sub.add_parser(name)
        m.set_defaults(run=fn)
        m.add_argument("--out", required=True)
        for r in required:
            many = r.endswith("+")
            m.add_argument(f"--{r.rstrip('+')}", required=True, nargs="+" if many else None)
        for o, default in optional.items():
            if isinstance(default, bool):
                m.add_argument(f"--{o}", action="store_true")
            else:
                m.add_argument(f"--{o}", default=default, type=type(default) if default is not None else str)
        return m

    m = mode("mkref", mkref, "species+", "gtf+", no_splicing=False)
    m.add_argument("--fasta", nargs="+")
    mode("preproc", preprocess, "raw_list", "sample_bc_list", "whitelist+", config=None, fastq=False)
    m = mode(
        "postproc", postprocess_, "alignments", "genome_dir", config=None, frac_low=0.3, frac_high=0.925,
        cutoff=10.0, try_iter=20, window=100, tssref=None, refbed=None, genome_size=None, bin=2000, countby="bin", n_reads=0,
        binary=False,
    )
    m.add_argument("--datatype", choices=["RNA", "ATAC"], required=True)
    m = mode(
        "report", rereport, "molecules", "genome_dir", frac_low=0.3, frac_high=0.925, cutoff=10.0, try_iter=20, window=100,
        n_reads=0,
    )
    m.add_argument("--datatype", choices=["RNA", "ATAC"], required=True)
    mode("links", link, "expression", "accessibility", "genome_dir", "fasta", window_kb=500)
    mode("mutations", mutate, "tumor", "normal", fasta=None)
    mode("clusters", cluster, "alignments+", "clusters", suffix=False, bam=False)
    mode("index", index, "alignments")
    mode("circles", circles, "input")
    mode("convert", convert, "prefix")
    return p


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"cellweave-{args.mode}").getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
