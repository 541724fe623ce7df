import random

import pytest
from pyspark.sql import functions as F

from cellweave.operators import annotation, intervals


def _spans(rng, n, top, longest):
    out = []
    for i in range(n):
        s = rng.randrange(top)
        out.append((i, rng.choice("ab"), s, s + rng.randrange(0, longest)))
    return out


@pytest.mark.parametrize("width", [7, 64, 1000])
def test_overlap_join_is_exact(spark, width):
    rng = random.Random(width)
    left, right = _spans(rng, 150, 900, 120), _spans(rng, 120, 900, 60)
    a = spark.createDataFrame(left, "i int, chrom string, ls bigint, le bigint")
    b = spark.createDataFrame(right, "j int, chrom string, rs bigint, re bigint")
    got = [(r.i, r.j) for r in intervals.overlap_join(a, b, ["chrom"], ("ls", "le"), ("rs", "re"), width).collect()]
    want = [
        (i, j) for i, c, s, e in left for j, d, t, f in right
        if c == d and s < f and t < e and s < e and t < f
    ]
    assert sorted(got) == sorted(want)


def test_point_join_left_keeps_every_point(spark):
    rng = random.Random(5)
    spans = _spans(rng, 60, 500, 90)
    points = [(k, rng.choice("abc"), rng.randrange(600)) for k in range(200)]
    p = spark.createDataFrame(points, "k int, chrom string, pos bigint")
    s = spark.createDataFrame(spans, "i int, chrom string, s bigint, e bigint")
    got = [(r.k, r.i) for r in intervals.point_join(p, s, ["chrom"], "pos", ("s", "e"), 32, "left").collect()]
    want = []
    for k, c, x in points:
        hits = [i for i, d, a, b in spans if c == d and a <= x < b]
        want += [(k, i) for i in hits] or [(k, None)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_union_within_bins_covers_each_base_once(spark):
    rng = random.Random(3)
    spans = _spans(rng, 80, 300, 40)
    df = spark.createDataFrame(spans, "i int, gene string, xs bigint, xe bigint")
    out = intervals.union_within_bins(df, ["gene"], "xs", "xe", 50).collect()
    for g in "ab":
        want = {x for _, c, s, e in spans if c == g for x in range(s, e)}
        got = [x for r in out if r.gene == g for x in range(r.xs, r.xe)]
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("block", [50, 300, 100_000])
def test_gene_assignment_matches_a_plain_scan(spark, monkeypatch, block):
    monkeypatch.setattr(annotation, "SCAN_BLOCK", block)
    rng = random.Random(block)
    genes = []
    for i in range(60):
        s = rng.randrange(0, 1000, 5)
        genes.append((f"g{i}", "hg_1", rng.choice("+-"), s, s + rng.choice([5, 20, 60, 400, 900])))
    reads = []
    for k in range(400):
        p = rng.randrange(1100)
        reads.append((k, "hg_1", "hg", rng.choice("+-"), p, p + rng.randrange(1, 40)))
    g = spark.createDataFrame(genes, "gene_id string, chrom string, strand string, start bigint, end bigint")
    r = spark.createDataFrame(reads, "k int, chrom string, genome string, strand string, first_pos bigint, last_pos bigint")
    for stranded in (True, False):
        got = {x.k: x.gene for x in annotation.assign_genes(r, g, stranded=stranded, bin_width=37).collect()}
        assert len(got) == len(reads)
        for k, _, _, strand, p, q in reads:
            hits = [i for i, _, s, a, b in genes if (not stranded or s == strand) and a <= p and q <= b]
            want = hits[0] if len(hits) == 1 else "Ambiguous_hg" if hits else "Intergenic_hg"
            assert got[k] == want


def test_windows_tile_the_contig(spark):
    rows = intervals.make_windows(spark.createDataFrame([("c", 4500), ("d", 0)], "chrom string, size bigint"), 2000).collect()
    assert sorted((r.start, r.end) for r in rows) == [(0, 2000), (2000, 4000), (4000, 4500)]


def test_gtf_attributes(spark):
    text = 'gene_id "G1"; gene_name "a b"; gene_id "G2"; level 2;'
    row = spark.createDataFrame([(text,)], "a string").select(
        *[annotation.gtf_attribute(F.col("a"), k).alias(k) for k in ("gene_id", "gene_name", "level", "none")]
    ).first()
    assert tuple(row) == ("G2", "a b", "2", "")
