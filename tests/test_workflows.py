"""Whole workflows on small files, and the stream of arriving libraries."""

import glob
import random

from pyspark.sql import functions as F

from cellweave.__main__ import main
from cellweave.config import AssayConfig
from cellweave.plans import demultiplex, postprocess
from cellweave.plans import views as V
from cellweave.streaming import arrivals

SF = "/root/testdata/sf0.001"


def test_demultiplex_and_stream_agree(spark, tmp_path):
    cfg = AssayConfig()
    reads = V.view(spark, SF, V.READ_PAIR)
    wls = [V.view(spark, SF, w) for w in (V.WHITELIST1, V.WHITELIST2, V.WHITELIST3)]
    samples = V.view(spark, SF, V.SAMPLE_BC)
    out = demultiplex.preprocess({"LIB1.": reads}, wls, samples, cfg, trimmed=True)
    want = {(r.sample, r.tag): r["count"] for r in out.groupBy("sample", "tag").count().collect()}
    assert want and all(s is not None for s, _ in want)

    index = demultiplex.build_index(wls, cfg)
    tagged = demultiplex.parse_library(reads, index, cfg, "LIB1.")[2]
    tagged.write.parquet(str(tmp_path / "in"))
    stream = arrivals.watch_tagged_reads(spark, str(tmp_path / "in"), tagged.schema)
    query = arrivals.write_by_sample(stream, samples, cfg, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("sample", "tag").count().collect()
    assert {(r.sample, r.tag): r["count"] for r in got} == want


def _reference(tmp_path):
    gtf = []
    for i in range(6):
        s = 1000 + i * 1000
        gtf.append(f'chr1\tx\tgene\t{s}\t{s + 800}\t.\t+\t.\tgene_id "G{i}"; gene_name "N{i}"; gene_biotype "b";')
        gtf.append(f'chr1\tx\texon\t{s}\t{s + 400}\t.\t+\t.\tgene_id "G{i}"; gene_name "N{i}"; gene_biotype "b";')
    (tmp_path / "a.gtf").write_text("\n".join(gtf) + "\n")
    (tmp_path / "a.fa").write_text(">chr1\nACGT\n")
    main(["mkref", "--out", str(tmp_path / "ref"), "--species", "hg", "--gtf", str(tmp_path / "a.gtf"), "--fasta", str(tmp_path / "a.fa")])


def _sam(tmp_path, mapq):
    rng = random.Random(1)
    lines = []
    for c in range(30):
        for k in range(4 * (30 - c) + 12):
            pos = 1000 + rng.randrange(6) * 1000 + rng.randrange(100, 300)
            umi = "".join(rng.choice("ACGT") for _ in range(6))
            for flag in (99, 147):
                p = pos if flag == 99 else pos + 60
                lines.append(f"C{c:02d}:{umi}:{k}\t{flag}\thg_chr1\t{p}\t{mapq}\t40M\t=\t{p}\t{100 if flag == 99 else -100}\t{'A' * 40}\t{'I' * 40}")
    (tmp_path / "x.sam").write_text("\n".join(lines) + "\n")


def test_postprocess_command_line(spark, tmp_path):
    _reference(tmp_path)
    _sam(tmp_path, 255)
    ref, out = str(tmp_path / "ref"), str(tmp_path / "rna")
    main(["postproc", "--out", out, "--alignments", str(tmp_path / "x.sam"), "--genome_dir", ref, "--datatype", "RNA"])
    mols = spark.read.parquet(f"{out}/molecules")
    assert mols.where("gene_name like 'N%'").count() == mols.where("gene like 'G%'").count() > 0
    assert mols.where("gene like 'G%'").select(F.min("exonic")).first()[0] is True
    header = "".join(open(p).read() for p in sorted(glob.glob(f"{out}/DGE_unfiltered/count.mtx/part-*"))).splitlines()
    assert header[0].startswith("%%MatrixMarket") and header[2].split()[1] == "30"

    out = str(tmp_path / "atac")
    (tmp_path / "tss.bed").write_text("hg_chr1\t1200\t1202\n")
    (tmp_path / "size").write_text("hg_chr1\t9000\n")
    (tmp_path / "cfg.json").write_text('{"cutumi": 5, "cuttss": 0}')
    main([
        "postproc", "--out", out, "--alignments", str(tmp_path / "x.sam"), "--genome_dir", ref, "--datatype", "ATAC",
        "--tssref", str(tmp_path / "tss.bed"), "--genome_size", str(tmp_path / "size"), "--config", str(tmp_path / "cfg.json"),
    ])
    assert spark.read.option("header", True).option("sep", "\t").csv(f"{out}/atac_qc/scores").count() > 0
    assert glob.glob(f"{out}/bin/count.mtx/part-*")


def test_report_counts_are_consistent(spark):
    mols = V.view(spark, SF, V.MOLECULE)
    rep = postprocess.expression_report(mols, V.view(spark, SF, V.GENE), cutoff=10, try_iter=20, window=100)
    t = rep.threshold.first()[0]
    called = rep.called.collect()
    assert called and all(r.umi_count > t for r in called)
    assert rep.called_matrix.agg(F.sum("value")).first()[0] == sum(r.umi_count for r in called)


def test_other_commands(spark, tmp_path):
    (tmp_path / "mp").write_text("".join(f"chr1\t{p}\tA\t12\t......CCCCCC\t{'I' * 12}\t{','.join(f'c{i}:u:r' for i in range(12))}\n" for p in (5, 9)))
    (tmp_path / "np").write_text(f"chr1\t5\tA\t6\t......\t{'I' * 6}\t{','.join(f'n{i}:u:r' for i in range(6))}\n")
    main(["mutations", "--out", str(tmp_path / "mut"), "--tumor", str(tmp_path / "mp"), "--normal", str(tmp_path / "np")])
    mutated = spark.read.parquet(str(tmp_path / "mut/mutated")).collect()
    assert len(mutated) == 6 and {(r.pos, r.allele, r.wild_type) for r in mutated} == {(5, "C", "A")}
    assert spark.read.parquet(str(tmp_path / "mut/sites")).count() == 2

    (tmp_path / "x.sam").write_text("C1:U:r\t0\tchr1\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\nC2:U:r\t0\tchr1\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\n")
    (tmp_path / "cl").write_text("C1-0 T\nC1-1 N\n")
    main(["clusters", "--out", str(tmp_path / "cl_out"), "--alignments", str(tmp_path / "x.sam"), str(tmp_path / "x.sam"), "--clusters", str(tmp_path / "cl"), "--suffix"])
    assert {(r.barcode, r.label) for r in spark.read.parquet(str(tmp_path / "cl_out")).collect()} == {("C1-0", "T"), ("C1-1", "N")}


def test_preprocess_command_writes_reports(spark, tmp_path):
    reads = V.view(spark, SF, V.READ_PAIR).orderBy("ordinal").limit(400).collect()
    for lib in (0, 1):
        for k in (1, 2):
            own = reads[lib::2]
            (tmp_path / f"l{lib}_{k}.fq").write_text("".join(f"{r[f'name{k}']}\n{r[f'seq{k}']}\n+\n{r[f'qual{k}']}\n" for r in own))
    (tmp_path / "raw.list").write_text("".join(f"lib\tLIB{lib}aaa.\t{tmp_path}/l{lib}_1.fq\t{tmp_path}/l{lib}_2.fq\n" for lib in (0, 1)))
    for i, w in enumerate((V.WHITELIST1, V.WHITELIST2, V.WHITELIST3)):
        (tmp_path / f"w{i}").write_text("".join(f"{n}\t{r.barcode}\n" for n, r in enumerate(V.view(spark, SF, w).collect())))
    (tmp_path / "samples").write_text("".join(f"{r.sample}\t{r.bc}\n" for r in V.view(spark, SF, V.SAMPLE_BC).collect()))
    out = tmp_path / "run"
    main([
        "preproc", "--out", str(out), "--raw_list", str(tmp_path / "raw.list"), "--sample_bc_list", str(tmp_path / "samples"),
        "--whitelist", *[str(tmp_path / f"w{i}") for i in range(3)], "--fastq",
    ])
    stats = spark.read.option("header", True).csv(str(out / "stats.csv")).collect()
    assert {r.lib_id for r in stats} == {"LIB0aaa.", "LIB1aaa."} and {r.stage for r in stats} == {"barcodes", "perfect", "quality"}
    names = []
    for k in (1, 2):
        lines = "".join(open(p).read() for p in sorted(glob.glob(f"{out}/fastq/R{k}/*/*/part-*"))).splitlines()
        names.append([line.split(":")[:2] for line in lines[::4]])
    assert names[0] == names[1] and names[0]  # mates of both libraries stay in step


def test_filtered_matrix_matches_its_gene_table(spark, tmp_path):
    mols = V.view(spark, SF, V.MOLECULE)
    rep = postprocess.expression_report(mols, V.view(spark, SF, V.GENE), cutoff=10, try_iter=20, window=100)
    postprocess.write_report(rep, str(tmp_path))
    postprocess.write_run_report(mols, rep, str(tmp_path))
    text = lambda name: "".join(open(p).read() for p in sorted(glob.glob(f"{tmp_path}/{name}/part-*"))).splitlines()
    genes = [line.split(",")[0] for line in text("DGE_filtered/genes.csv") if not line.startswith("gene_id")]
    assert genes == text("DGE_filtered/genes.txt") == text("DGE_unfiltered/genes.txt")
    body, cells = text("DGE_filtered/count.mtx")[3:], text("DGE_filtered/barcodes.txt")
    got, want = {}, {}
    for g, c, v in map(str.split, body):
        key = genes[int(g) - 1], cells[int(c) - 1]
        got[key] = got.get(key, 0) + float(v)
    for r in rep.called_matrix.collect():
        want[r.gene, r.cell_barcode] = want.get((r.gene, r.cell_barcode), 0) + r.value
    assert got == want
    keys = {line.split(",")[1] for line in text("analysis/summary.csv")}
    assert {"saturation", "estimated_cells", "total_read_count"} <= keys


def test_sample_numbers_the_reads_it_is_given(spark):
    from cellweave.operators import barcode

    reads = spark.range(3000).select((F.col("id") * 2 + 1).alias("ordinal"))
    got = sorted(r.ordinal for r in barcode.systematic_sample(reads, 300).collect())
    assert got == list(range(1, 6000, 22))  # a step of 11 reaches the end
