import glob
import gzip
import random
import struct

import pytest
from pyspark.sql import functions as F

from cellweave.config import AssayConfig
from cellweave.operators import annotation, trim
from cellweave.sources import alignments, fasta, sinks, tables


def _joined(path):
    return "".join(open(p).read() for p in sorted(glob.glob(f"{path}/part-*")))


def _fastq(n, seed=0):
    rng = random.Random(seed)
    return [(f"@r{i} 1", "".join(rng.choice("ACGT") for _ in range(rng.randrange(20, 60)))) for i in range(n)]


@pytest.mark.parametrize("packed", [False, True])
def test_fastq_keeps_order_across_blocks(spark, tmp_path, packed):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = {}
    for k in (1, 2):
        recs = _fastq(500, k)
        text = "".join(f"{n}\n{s}\n+\n{'I' * len(s)}\n" for n, s in recs)
        path = tmp_path / f"r{k}.fq{'.gz' if packed else ''}"
        (gzip.open if packed else open)(path, "wt").write(text)
        want[k] = recs
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        ext = ".gz" if packed else ""
        rows = tables.read_fastq_pair(spark, str(tmp_path / f"r1.fq{ext}"), str(tmp_path / f"r2.fq{ext}")).orderBy("ordinal").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r.name1, r.seq1) for r in rows] == want[1]
    assert [(r.name2, r.seq2) for r in rows] == want[2]
    assert [r.ordinal for r in rows] == list(range(500))


def test_small_tables(spark, tmp_path):
    (tmp_path / "raw").write_text("lib1 ID1.\ta_1.fq a_2.fq\n\n  lib2 ID2. b_1.fq b_2.fq\n")
    assert [r.lib_id for r in tables.read_raw_list(spark, str(tmp_path / "raw")).orderBy("ordinal").collect()] == ["ID1.", "ID2."]
    assert [r.name for r in tables.read_first_words(spark, str(tmp_path / "raw")).orderBy("ordinal").collect()] == ["lib1", "lib2"]
    (tmp_path / "bc").write_text("S1 AAC\nS2 AAG\nS3 AAC\n")
    assert {r.bc: r.sample for r in tables.read_sample_barcodes(spark, str(tmp_path / "bc")).collect()} == {"AAC": "S3", "AAG": "S2"}
    (tmp_path / "mp").write_text('chr1\t5\tA\t2\t.,\t"I\tc1:u:x,c2:u:y\n')
    row = tables.read_pileup(spark, str(tmp_path / "mp")).first()
    assert row.qual == '"I' and row.names == "c1:u:x,c2:u:y"
    (tmp_path / "bed").write_text("chr1\t5\t9\tx\ty\tBC1\n")
    assert tables.read_bed(spark, str(tmp_path / "bed")).first().last == "BC1"
    (tmp_path / "log").write_text("Pairs written (passing filters):      1,234,567 (90.1%)\n")
    assert tables.read_trim_log(spark, str(tmp_path / "log")).first()[0] == 1234567
    (tmp_path / "star").write_text("Uniquely mapped reads number |\t77\nNumber of reads mapped to multiple loci |\t5\n")
    assert tuple(tables.read_aligner_log(spark, str(tmp_path / "star")).first()) == (77, 5)


def test_gtf_to_genes_and_combined_files(spark, tmp_path):
    (tmp_path / "a.gtf").write_text(
        '#comment\nchr1\ts\tgene\t11\t90\t.\t+\t.\tgene_id "G1"; gene_name "n1"; gene_biotype "b";\n'
        'chr1\ts\texon\t11\t40\t.\t+\t.\tgene_id "G1"; gene_name "n1";\n'
        'chr1\ts\texon\t11\t30\t.\t+\t.\tgene_id "G1"; gene_name "n1";\n'
    )
    gtf = annotation.combine_gtfs({"hg": tables.read_gtf(spark, str(tmp_path / "a.gtf"))})
    g = annotation.gene_table(gtf).first()
    assert (g.gene_id, g.gene_name, g.genome, g.chrom, g.start, g.end, g.biotype) == ("G1", "n1", "hg", "hg_chr1", 11, 90, "b")
    assert annotation.gene_table(gtf, splicing=False).first().end == 40
    assert [tuple(r) for r in annotation.exon_table(gtf).collect()] == [("G1", 11, 40)]
    sinks.write_combined_gtf(gtf, "exon", str(tmp_path / "exons"))
    assert _joined(tmp_path / "exons").startswith("Chromosome\tSource")
    (tmp_path / "a.fa").write_text(">chr1 one two three four\nACGT\nAC\n>chr2\nGG\n")
    sinks.write_combined_genome(fasta.combined_genome(spark, {"hg": str(tmp_path / "a.fa")}), str(tmp_path / "genome"))
    assert _joined(tmp_path / "genome").split("\n")[:4] == [">hg_chr1 one two three", "ACGT", "AC", ">hg_chr2 "]


def test_genome_chunks(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">c1 x\nACGTA\nCGT\n>c2\nTT\n")
    rows = [tuple(r) for r in fasta.read_genome(spark, str(tmp_path / "g.fa"), 4).collect()]
    assert rows == [("c1", 0, "ACGT"), ("c1", 4, "ACGT"), ("c2", 0, "TT")]


SAM = "@HD\tVN:1.6\tSO:queryname\nA_C1:U1:r1\t99\thg_1\t101\t255\t5S10M2I3D5M100N8M\t=\t300\t250\tACGT\tIIII\nC2:U2:r2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\n"


def test_sam(spark, tmp_path):
    (tmp_path / "x.sam").write_text(SAM)
    rows = {r.qname: r for r in alignments.read_sam(spark, str(tmp_path / "x.sam")).collect()}
    r = rows["A_C1:U1:r1"]
    assert [tuple(b) for b in r.blocks] == [(100, 110), (113, 118), (218, 226)]
    assert (r.cell_barcode, r.umi, r.genome, r.strand, r.is_proper_pair, r.is_read1, r.read_end) == ("C1", "U1", "hg", "+", True, True, 226)
    assert rows["C2:U2:r2"].is_unmapped
    assert alignments.header_sort_order(spark, str(tmp_path / "x.sam")).first()[0] == "queryname"


def test_bam(spark, tmp_path):
    def record(name, flag, ref, pos, cigar, seq):
        n = name.encode() + b"\0"
        ops = b"".join(struct.pack("<I", ln << 4 | "MIDNSHP=X".index(op)) for ln, op in cigar)
        codes = ["=ACMGRSVTWYHKDBN".index(c) for c in seq] + [0] * (len(seq) % 2)
        packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(codes), 2))
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(n), 255, 0, len(cigar), flag, len(seq), ref, pos + 50, 120)
        body += n + ops + packed + bytes([40] * len(seq))
        return struct.pack("<i", len(body)) + body

    head = b"@HD\tVN:1.6\n"
    data = b"BAM\x01" + struct.pack("<i", len(head)) + head + struct.pack("<i", 1)
    data += struct.pack("<i", 5) + b"hg_1\0" + struct.pack("<i", 1000)
    data += record("C1:U1:a", 99, 0, 100, [(3, "M"), (10, "N"), (2, "M")], "ACGTA") + record("C1:U1:b", 4, -1, -1, [], "AC")
    # Two gzip members, as block compression writes them.
    (tmp_path / "x.bam").write_bytes(gzip.compress(data[:60]) + gzip.compress(data[60:]))
    rows = {r.qname: r for r in alignments.read_bam(spark, str(tmp_path / "*.bam")).collect()}
    a = rows["C1:U1:a"]
    assert (a.pos, a.cigar, a.seq, a.qual, a.tlen, a.mapq) == (100, "3M10N2M", "ACGTA", "IIIII", 120, 255)
    assert [tuple(b) for b in a.blocks] == [(100, 103), (113, 115)]
    assert rows["C1:U1:b"].is_unmapped and rows["C1:U1:b"].reference_name == "*"


def test_matrix_market(spark, tmp_path):
    rng = random.Random(4)
    cells = {(f"g{rng.randrange(30):02d}", f"c{rng.randrange(40):02d}"): rng.randrange(1, 9) for _ in range(300)}
    df = spark.createDataFrame([(g, c, v) for (g, c), v in cells.items()], "gene string, cell_barcode string, value bigint")
    sinks.write_matrix_market(df, str(tmp_path / "m"), "gene", kind="integer")
    lines = _joined(tmp_path / "m/count.mtx").splitlines()
    genes = _joined(tmp_path / "m/genes.txt").split()
    barcodes = _joined(tmp_path / "m/barcodes.txt").split()
    assert genes == sorted({g for g, _ in cells}) and barcodes == sorted({c for _, c in cells})
    assert lines[:3] == ["%%MatrixMarket matrix coordinate integer general", "%", f"{len(genes)} {len(barcodes)} {len(cells)}"]
    got = {(genes[int(r) - 1], barcodes[int(c) - 1]): int(v) for r, c, v in (x.split() for x in lines[3:])}
    assert got == cells


def test_fastq_and_sam_writers(spark, tmp_path):
    tagged = spark.createDataFrame(
        [(1, "S1", "A", "LIB.AAA", "UM", "@r1 x", "AC", "II", "@r1 y", "GG", "##")],
        "ordinal bigint, sample string, tag string, cell_barcode string, umi string, name1 string, seq1 string, qual1 string, name2 string, seq2 string, qual2 string",
    )
    sinks.write_fastq(tagged, str(tmp_path / "fq"))
    assert _joined(tmp_path / "fq/R1/sample=S1/tag=A") == "@A_LIB.AAA:UM:r1\nAC\n+\nII\n"
    (tmp_path / "x.sam").write_text(SAM)
    reads = alignments.read_sam(spark, str(tmp_path / "x.sam"))
    sinks.write_sam(reads, spark.createDataFrame([("hg_1", 1000)], "chrom string, size bigint"), str(tmp_path / "sam"))
    out = _joined(tmp_path / "sam").splitlines()
    assert out[0] == "@SQ\tSN:hg_1\tLN:1000"
    assert out[-1].startswith("A_C1:U1:r1\t99\thg_1\t101\t255\t") and out[-1].endswith("CB:Z:C1\tUB:Z:U1")


def plain_quality(q, c5, c3):
    total = best = start = 0
    for i, ch in enumerate(q):
        total += c5 - (ord(ch) - 33)
        if total < 0:
            break
        if total > best:
            best, start = total, i + 1
    total = best = 0
    stop = len(q)
    for i in range(len(q) - 1, -1, -1):
        total += c3 - (ord(q[i]) - 33)
        if total < 0:
            break
        if total > best:
            best, stop = total, i
    return (0, 0) if start >= stop else (start, stop)


def test_quality_trimming_matches_the_plain_loop():
    rng = random.Random(9)
    quals = ["".join(chr(33 + rng.choice([2, 8, 12, 20, 38])) for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    lo, hi = trim.quality_bounds(quals, 15, 10)
    assert list(zip(lo.tolist(), hi.tolist())) == [plain_quality(q, 15, 10) for q in quals]


def test_adapter_positions():
    adapter = "CTGTCTCTTATACACATCT"
    reads = {
        "ACGTACGTAC" + adapter + "GGG": 10,
        "ACGTACGTAC" + adapter[:7]: 10,
        "ACGTACGTAC" + adapter[:2]: 12,
        "ACGTACGTAC" + adapter[:9] + "A" + adapter[10:]: 10,
        "ACGTACGTAC" + adapter[:5] + adapter[6:] + "AAA": 10,
        adapter + "ACGT": 0,
        "AAAAGGGGAAAAGGGGAAAA": 20,
    }
    at, found = trim.find_adapter3(list(reads), adapter)
    assert at.tolist() == list(reads.values())
    assert found.tolist() == [True, True, False, True, True, True, False]
    end, hit = trim.find_adapter5(["TT" + adapter + "ACGTA"], adapter)
    assert end.tolist() == [2 + len(adapter)] and hit[0]


def test_trim_library_filters_short_mates(spark):
    cfg = AssayConfig(mlen1=10, mlen2=5)
    rows = [(1, "A" * 12, "I" * 12, "ACGTAG", "IIIIII"), (2, "A" * 9, "I" * 9, "ACGTAG", "IIIIII"), (3, "C" * 12 + cfg.a1, "I" * 46, "ACGTAG", "II####")]
    df = spark.createDataFrame(rows, "ordinal bigint, seq1 string, qual1 string, seq2 string, qual2 string")
    out = trim.trim_library(df, cfg).collect()
    assert [(r.ordinal, r.seq1) for r in out] == [(1, "A" * 12)]
    loose = AssayConfig(mlen1=1, mlen2=1)
    kept = {r.ordinal: (r.seq1, r.seq2) for r in trim.trim_library(df, loose).collect()}
    assert kept[3] == ("C" * 12, "AC")


def test_config_round_trip():
    cfg = AssayConfig(mlen1=5)
    assert AssayConfig.from_json(cfg.to_json()) == cfg and cfg.shifted
    with pytest.raises(ValueError):
        AssayConfig.from_json('{"nope": 1}')


def plain_adapter(read, adapter):
    """The same search as one scalar table per read: (score, -errors, -start)."""
    m = len(adapter)
    col = [(-2 * i, -i, 0) for i in range(m + 1)]
    best = None
    for j in range(1, len(read) + 1):
        new = [(0, 0, -j)]
        for i in range(1, m + 1):
            same = read[j - 1] == adapter[i - 1]
            s, e, b = col[i - 1]
            diagonal = (s + 1, e, b) if same else (s - 1, e - 1, b)
            new.append(max([diagonal] + [(s - 2, e - 1, b) for s, e, b in (col[i], new[i - 1])]))
        col = new
        for i in [m] + (list(range(3, m)) if j == len(read) else []):
            s, e, b = col[i]
            if -e <= int(i * 0.1) and (best is None or (s, e) > best[:2]):
                best = (s, e, b)
    return -best[2] if best else len(read)


def test_adapter_search_matches_the_plain_table():
    rng = random.Random(7)
    adapter = "CTGTCTCTTATACACATCT"
    reads = []
    for _ in range(300):
        core = "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 25)))
        piece = list(adapter[: rng.randrange(0, 20)])
        for _ in range(rng.randrange(0, 3)):
            if piece:
                at = rng.randrange(len(piece))
                piece[at : at + 1] = rng.choice([["A"], [], ["C", "G"]])
        tail = "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 0, 6])))
        reads.append(core + "".join(piece) + tail)
    at, _ = trim.find_adapter3(reads, adapter)
    assert at.tolist() == [plain_adapter(r, adapter) for r in reads]
