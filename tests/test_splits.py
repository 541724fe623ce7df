"""Readers whose records cross file splits, and the writers that go with them."""

import glob
import os
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cellweave.operators import links
from cellweave.sources import alignments, bam_regions, bgzf, fasta, sinks, tables

CONTIGS = [("hg_1", 90_000), ("hg_2", 50_000), ("hg_MT", 16_000)]


def split_at(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")


@pytest.fixture(autouse=True)
def usual_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = [spark.conf.get(n) for n in names]
    yield
    for n, v in zip(names, old, strict=True):
        spark.conf.set(n, v)
    spark.conf.unset("spark.sql.files.minPartitionNum")


def alignment_rows(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        size = rng.choice([0, 1, 7, 50, 51, 50, 50, 3000])
        ref, pos = rng.choice([(c, rng.randrange(s - 4000)) for c, s in CONTIGS] + [("*", -1)])
        mate, mate_pos = rng.choice([(ref, pos + 10 if pos >= 0 else -1), ("hg_2", 77), ("*", -1)])
        seq = "".join(rng.choice("ACGTN") for _ in range(size)) or "*"
        qual = "*" if seq == "*" or rng.random() < 0.1 else "".join(chr(33 + rng.randrange(42)) for _ in seq)
        cigar = "*" if ref == "*" or size < 8 else f"5S{size - 7}M1000N2M"
        tags = rng.choice(["", f"CB:Z:C{i % 7}\tNH:i:{i}", f"AS:i:-{i}\txf:f:0.5\tXA:A:q\tML:B:C,1,2,255\tMM:B:s,-3", "UB:Z:"])
        rows.append(Row(f"A_C{i % 7}:U{i}:r{i}", rng.choice([99, 147, 4, 16, 1024]), ref, pos, rng.choice([0, 255]), cigar, mate, mate_pos, rng.randrange(-500, 500), seq, qual, tags))
    fields = [f.name for f in bgzf.RECORDS]
    return [Row(**dict(zip(fields, r, strict=True))) for r in rows]


def bam_bytes(rows, block=600, contigs=CONTIGS):
    """Blocks that cut records and header anywhere."""
    at = {n: i for i, (n, _) in enumerate(contigs)} | {"*": -1}
    data = bgzf.header(contigs, "@HD\tVN:1.6\n") + b"".join(bgzf.encode(r, at) for r in rows)
    return b"".join(bgzf.pack(data[i : i + block]) for i in range(0, len(data), block)) + bgzf.END_BLOCK


def as_tuples(df):
    return sorted(map(tuple, df.select(*bgzf.RECORDS.names).collect()))


@pytest.mark.parametrize("split", [3_000, 9_000, 1 << 27])
def test_bam_splits_give_the_same_rows(spark, tmp_path, split):
    rows = alignment_rows(120)
    (tmp_path / "a.bam").write_bytes(bam_bytes(rows))
    more = alignment_rows(30, 8)
    turned = [CONTIGS[2], CONTIGS[0], CONTIGS[1]]
    (tmp_path / "b.bam").write_bytes(bam_bytes(more, 5000, turned))
    split_at(spark, split)
    df = alignments.read_bam(spark, str(tmp_path / "*.bam"))
    assert df.rdd.getNumPartitions() > {3_000: 15, 9_000: 5}.get(split, 0)
    assert as_tuples(df) == sorted(map(tuple, rows + more))
    assert {(r.chrom, r["size"]) for r in alignments.bam_contigs(spark, str(tmp_path / "*.bam")).collect()} == set(CONTIGS)


def test_bam_of_a_long_header_and_of_none(spark, tmp_path):
    contigs = [(f"contig_{i:05d}", 1000 + i) for i in range(3_000)]
    rows = [Row(**r.asDict() | {"reference_name": f"contig_{i:05d}", "mate_reference_name": "*", "mate_pos": -1, "pos": 3}) for i, r in enumerate(alignment_rows(60))]
    (tmp_path / "long.bam").write_bytes(bam_bytes(rows, 900, contigs))
    (tmp_path / "none.bam").write_bytes(bam_bytes([]))
    for split in (6_000, 1 << 27):
        split_at(spark, split)
        assert as_tuples(alignments.read_bam(spark, str(tmp_path / "long.bam"))) == sorted(map(tuple, rows))
        assert alignments.read_bam(spark, str(tmp_path / "none.bam")).count() == 0


def test_damaged_bam_is_refused(spark, tmp_path):
    whole = bam_bytes(alignment_rows(100))
    (tmp_path / "cut.bam").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception, match="damaged|cut short|Error"):
        alignments.read_bam(spark, str(tmp_path / "cut.bam")).count()


# ---- FASTQ and FASTA -------------------------------------------------------------------------

def fastq_text(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        seq = "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 1, 30, 75])))
        # qualities that look like other lines
        out.append((f"@r{i} x", seq, "".join(rng.choice("@+I#") for _ in seq)))
    return out


@pytest.mark.parametrize("split", [200, 2_000, 1 << 27])
def test_fastq_splits(spark, tmp_path, split):
    records = {}
    for name, n, end in (("a", 60, "\n"), ("b", 21, ""), ("c", 0, "")):
        records[name] = fastq_text(n, n)
        (tmp_path / f"{name}.fq").write_text("\n".join(f"{r}\n{s}\n+\n{q}" for r, s, q in records[name]) + end)
    split_at(spark, split)
    for name, want in records.items():
        rows = tables.read_fastq(spark, str(tmp_path / f"{name}.fq")).orderBy("ordinal").collect()
        assert [(r.ordinal, r.name, r.seq, r.qual) for r in rows] == [(i, *x) for i, x in enumerate(want)]
    rows = tables.read_fastq(spark, str(tmp_path / "*.fq")).collect()
    assert len(rows) == 81 and len({(r.file, r.ordinal) for r in rows}) == 81


def test_fastq_pair_is_one_join(spark, tmp_path):
    (tmp_path / "a.fq").write_text("".join(f"{r}\n{s}\n+\n{q}\n" for r, s, q in fastq_text(20, 1)))
    df = tables.read_fastq_pair(spark, str(tmp_path / "a.fq"), str(tmp_path / "a.fq"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and "Aggregate" not in plan and "Window" not in plan
    assert df.count() == 20


@pytest.mark.parametrize("text", ["@a\nAC\n+\nII\n@b\nAC\n", "@a\nAC\n+\nIII\n", "a\nAC\n+\nII\n"])
def test_broken_fastq_is_refused(spark, tmp_path, text):
    (tmp_path / "a.fq").write_text(text)
    with pytest.raises(Exception, match="record"):
        tables.read_fastq(spark, str(tmp_path / "a.fq")).count()


@pytest.mark.parametrize("split", [40, 500, 1 << 27])
def test_genome_splits(spark, tmp_path, split):
    rng = random.Random(2)
    contigs = {f"c{i}": "".join(rng.choice("ACGTN") for _ in range(n)) for i, n in enumerate([0, 5, 700, 64, 1])}
    text = "".join(f">{n} about\n" + "".join(s[i : i + 30] + "\n" for i in range(0, len(s), 30)) for n, s in contigs.items())
    (tmp_path / "g.fa").write_text(text)
    split_at(spark, split)
    got = {}
    for r in fasta.read_genome(spark, str(tmp_path / "g.fa"), 64).orderBy("chrom", "offset").collect():
        assert r.offset == len(got.get(r.chrom, "")) and r.offset // 64 == (r.offset + len(r.seq) - 1) // 64
        got[r.chrom] = got.get(r.chrom, "") + r.seq
    assert got == {n: s for n, s in contigs.items() if s}
    peaks = [(f"p{i}", "c2", a, a + w) for i, (a, w) in enumerate([(0, 1), (60, 10), (0, 700), (650, 80), (127, 130)])]
    gc = links.gc_content(spark.createDataFrame(peaks, "peak string, chrom string, start bigint, end bigint"), fasta.read_genome(spark, str(tmp_path / "g.fa"), 64), 64)
    want = {p: 100 * sum(c in "GC" for c in contigs["c2"][a:b]) / len(contigs["c2"][a:b]) for p, _, a, b in peaks}
    assert {r.peak: pytest.approx(r.gc_content) for r in gc.collect()} == want


# ---- written BAM, and regions by index -------------------------------------------------------

def sized(spark):
    return spark.createDataFrame(CONTIGS, "chrom string, size bigint")


def test_bam_writer_round_trip(spark, tmp_path):
    rows = alignment_rows(150)
    (tmp_path / "a.bam").write_bytes(bam_bytes(rows))
    reads = alignments.read_bam(spark, str(tmp_path / "a.bam"))
    plain = reads.drop("cell_barcode", "umi")
    for _ in range(2):  # the second replaces the first
        sinks.write_bam(plain, sized(spark), str(tmp_path / "whole"))
    assert as_tuples(alignments.read_bam(spark, str(tmp_path / "whole/*.bam"))) == sorted(map(tuple, rows))
    assert not glob.glob(str(tmp_path / "whole/_temporary*"))
    sinks.write_bam(reads.withColumnRenamed("cell_barcode", "label"), sized(spark), str(tmp_path / "split"), by="label")
    labels = {r.label for r in reads.select(reads.cell_barcode.alias("label")).distinct().collect()}
    assert {os.path.basename(p) for p in glob.glob(str(tmp_path / "split/*"))} == {f"label={x}" for x in labels}
    one = alignments.read_bam(spark, str(tmp_path / "split/label=C3/*.bam"))
    assert {r.cell_barcode for r in one.collect()} == {"C3"} and one.where("tags not like '%UB:Z:%'").count() == 0
    places = [(CONTIGS.index((r.reference_name, dict(CONTIGS)[r.reference_name])) if r.reference_name != "*" else 9, r.pos) for r in one.collect()]
    assert places == sorted(places)


def test_sam_keeps_mates_and_tags(spark, tmp_path):
    rows = [r for r in alignment_rows(80)]
    (tmp_path / "a.bam").write_bytes(bam_bytes(rows))
    reads = alignments.read_bam(spark, str(tmp_path / "a.bam")).drop("cell_barcode", "umi")
    sinks.write_sam(reads, sized(spark), str(tmp_path / "sam"))
    assert as_tuples(alignments.read_sam(spark, str(tmp_path / "sam"))) == sorted(map(tuple, rows))


def test_failed_bam_write_leaves_nothing(spark, tmp_path):
    (tmp_path / "a.bam").write_bytes(bam_bytes(alignment_rows(40)))
    bad = alignments.read_bam(spark, str(tmp_path / "a.bam")).withColumn("reference_name", F.lit("no_such_contig"))
    with pytest.raises(Exception, match="no_such_contig"):
        sinks.write_bam(bad, sized(spark), str(tmp_path / "out"))
    assert not glob.glob(str(tmp_path / "out/**/*.bam"), recursive=True)


def test_regions_read_their_blocks_only(spark, tmp_path):
    rng = random.Random(6)
    rows = []
    for contig, size in (("hg_1", 3_000_000), ("hg_2", 900_000)):
        for i, pos in enumerate(sorted(rng.randrange(size - 60_000) for _ in range(1500))):
            cigar = rng.choice(["50M", "50M", "20M40000N30M"])
            rows.append(Row(**alignment_rows(1)[0].asDict() | {"qname": f"C:U:{contig}{i}", "flag": 0, "reference_name": contig, "pos": pos, "cigar": cigar, "seq": "A" * 50, "qual": "I" * 50}))
    contigs = [("hg_1", 3_000_000), ("hg_2", 900_000), ("hg_MT", 16_000)]
    (tmp_path / "a.bam").write_bytes(bam_bytes(rows, 3_000, contigs))
    (tmp_path / "b.bam").write_bytes(bam_bytes(rows[::3], 2_000, contigs))
    split_at(spark, 9_000)
    bam_regions.index_bam(spark, str(tmp_path / "*.bam"), str(tmp_path / "index"))
    regions = [("hg_1", 100_000, 120_000), ("hg_1", 119_000, 119_500), ("hg_1", 150_000, 150_001), ("hg_2", 0, 10), ("hg_2", 880_000, 2_000_000), ("hg_9", 5, 9)]
    read = spark.sparkContext.accumulator(0)
    df = bam_regions.fetch_reads(spark, str(tmp_path / "index"), spark.createDataFrame(regions, "chrom string, start bigint, end bigint"), read)
    got = as_tuples(df)
    windows = {(c, w) for c, s, e in regions for w in range(s >> 14, ((e - 1) >> 14) + 1)}
    touch = lambda r: any((r.reference_name, w) in windows for w in range(r.pos >> 14, (r.pos + (50 if r.cigar == "50M" else 40_050) - 1 >> 14) + 1))
    want = [tuple(r) for r in rows + rows[::3] if touch(r)]
    assert len(want) > 50 and got == sorted(want)
    blocks = alignments.bam_blocks(spark, str(tmp_path / "*.bam")).where("length(value) > 0").count()
    assert 0 < read.value < blocks / 3


def test_deep_regions_are_read_some_blocks_at_a_time(spark, tmp_path):
    blank = alignment_rows(1)[0].asDict() | {"flag": 0, "reference_name": "hg_1", "cigar": "50M", "seq": "A" * 50, "qual": "I" * 50}
    rows = [Row(**blank | {"qname": f"C:U:{i}", "pos": 100 + i // 40}) for i in range(4000)]
    (tmp_path / "a.bam").write_bytes(bam_bytes(rows, 3_000, [("hg_1", 50_000)]))
    bam_regions.index_bam(spark, str(tmp_path / "a.bam"), str(tmp_path / "index"))
    place = spark.read.parquet(str(tmp_path / "index")).first()
    with open(tmp_path / "a.bam", "rb") as f:
        parts = [records.num_rows for records, _ in bam_regions._range(f, ["hg_1"], place["first"], place["last"])]
    assert sum(parts) == 4000 and max(parts) < 2000
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        near = bam_regions.fetch_reads(spark, str(tmp_path / "index"), spark.createDataFrame([("hg_1", 0, 9)], "chrom string, start bigint, end bigint"))
        assert near.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert near.count() == 4000


def test_commands_on_bam(spark, tmp_path):
    """Labelled BAM files, an index, and mutations straight from alignments."""
    from cellweave.__main__ import main

    rng = random.Random(5)
    text = "".join(rng.choice("ACGT") for _ in range(400))
    (tmp_path / "g.fa").write_text(">hg_1\n" + "".join(text[i : i + 50] + "\n" for i in range(0, 400, 50)))
    other = "C" if text[120] != "C" else "G"
    blank = alignment_rows(1)[0].asDict() | {"reference_name": "hg_1", "mapq": 60, "cigar": "50M", "mate_reference_name": "*", "mate_pos": -1, "qual": "I" * 50, "tags": "", "flag": 0}

    def reads(name, share):
        out = []
        for i in range(24):
            seq = text[100:120] + (other if i < share else text[120]) + text[121:150]
            out.append(Row(**blank | {"qname": f"{name}{i % 3}:U{i}:r{i}", "pos": 100, "seq": seq}))
        return out

    contigs = [("hg_1", 400)]
    (tmp_path / "t.bam").write_bytes(bam_bytes(reads("t", 12), 500, contigs))
    (tmp_path / "n.bam").write_bytes(bam_bytes(reads("n", 0), 500, contigs))
    main(["mutations", "--out", str(tmp_path / "mut"), "--tumor", str(tmp_path / "t.bam"), "--normal", str(tmp_path / "n.bam"), "--fasta", str(tmp_path / "g.fa")])
    found = spark.read.parquet(str(tmp_path / "mut/mutated")).collect()
    assert {(r.chrom, r.pos, r.allele, r.wild_type) for r in found} == {("hg_1", 121, other, text[120])} and sum(r.n for r in found) == 12
    (tmp_path / "cl").write_text("t0 tumor\nt1 tumor\nt2 rest\n")
    main(["clusters", "--out", str(tmp_path / "by"), "--alignments", str(tmp_path / "t.bam"), "--clusters", str(tmp_path / "cl"), "--bam"])
    assert alignments.read_bam(spark, str(tmp_path / "by/label=tumor/*.bam")).count() == 16
    main(["index", "--out", str(tmp_path / "index"), "--alignments", str(tmp_path / "t.bam")])
    assert spark.read.parquet(str(tmp_path / "index")).select("chrom", "window").collect() == [("hg_1", 0)]
