import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.operators import circle, links, mutation


@pytest.mark.parametrize("seed,k,spread", [(1, 5, 4), (2, 12, 40), (3, 30, 400), (4, 500, 40)])
def test_background_peaks_equal_the_full_ranking(spark, seed, k, spread):
    rng = random.Random(seed)
    peaks = [(f"p{i:03d}", rng.randrange(5, 5 + spread), round(rng.choice([30, 40, 50]) + rng.random() * rng.choice([0, 5]), 1)) for i in range(120)]
    peaks.append(("zz", 5 + 30 * spread, 99.5))
    df = spark.createDataFrame(peaks, "peak string, n_cells bigint, gc_content double")
    got = {(r.peak, r.rank): r.bg_peak for r in links.background_peaks(df, k).collect()}
    for p, n, g in peaks:
        order = sorted((abs(m - n) * abs(h - g), q) for q, m, h in peaks)[:k]
        assert [got[(p, i + 1)] for i in range(len(order))] == [q for _, q in order]
    assert len(got) == len(peaks) * min(k, len(peaks))


def test_fdr_matches_a_plain_step_up(spark):
    rng = np.random.default_rng(0)
    p = np.concatenate([rng.random(300), np.repeat(rng.random(5), 20), 10.0 ** -rng.integers(3, 200, 30)])
    df = spark.createDataFrame([(float(x), 1.0) for x in p] + [(0.001, -1.0)], "pval double, zscore double")
    got = sorted((r.pval, r.pval_adj) for r in links.correct_fdr(df).collect())
    order = np.sort(p)
    adj = np.minimum(1, np.minimum.accumulate((order * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1])
    assert len(got) == len(p)
    assert np.allclose([a for _, a in got], adj, rtol=1e-12)


def test_mutual_information_against_dense_histograms(spark):
    rng = np.random.default_rng(1)
    n = 80
    x = (rng.random((n, 6)) < 0.4).astype(int)
    y = np.where(rng.random((n, 4)) < 0.5, 0, rng.normal(2, 1, (n, 4)))
    y[:, 2] = rng.normal(5, 1, n)
    y[:, 3] = -np.abs(y[:, 3])
    expr = spark.createDataFrame([(str(c), f"g{j}", float(y[c, j])) for c in range(n) for j in range(4) if y[c, j] != 0], "cell string, gene_id string, value double")
    acc = spark.createDataFrame([(str(c), f"p{j}") for c in range(n) for j in range(6) if x[c, j]], "cell string, peak string")
    pairs = spark.createDataFrame([(f"g{i}", f"p{j}") for i in range(4) for j in range(6)], "gene_id string, peak string")
    got = {(r.gene_id, r.peak): r.mi for r in links.mutual_information(pairs, expr, acc, F.lit(n)).collect()}
    for i in range(4):
        for j in range(6):
            h, _, _ = np.histogram2d(x[:, j], y[:, i], 8)
            p = h / n
            e = np.outer(p.sum(1), p.sum(0))
            mi = (p[p > 0] * np.log(p[p > 0] / e[p > 0])).sum()
            assert np.isclose(got[(f"g{i}", f"p{j}")], mi, atol=1e-12)


def test_peak_spanning_the_window_is_left_out(spark):
    tss = spark.createDataFrame([("g", "n", "chr1", 5000)], "gene_id string, gene_name string, chrom string, tss bigint")
    peaks = spark.createDataFrame(
        [("span", "chr1", 3000, 7000), ("left", "chr1", 3000, 4001), ("edge", "chr1", 3000, 4000), ("right", "chr1", 5999, 9000), ("off", "chr1", 6000, 9000)],
        "peak string, chrom string, start bigint, end bigint",
    )
    assert sorted(r.peak for r in links.peaks_near_genes(tss, peaks, 1).collect()) == ["left", "right"]


def test_peak_names(spark):
    rows = links.peak_table(spark.createDataFrame([("hg_chr1:10-20",), ("chr2:5-9",), ("chr3_1_2",)], "peak string")).collect()
    assert [(r.chrom, r.start, r.end) for r in rows] == [("chr1", 10, 20), ("chr2", 5, 9), ("chr3", 1, 2)]


def test_flat_background_gives_an_infinite_score(spark):
    mi = spark.createDataFrame([("g", "a", 0.5), ("g", "b", 0.1), ("g", "c", 0.1)], "gene_id string, peak string, mi double")
    near = spark.createDataFrame([("g", "a")], "gene_id string, peak string")
    bg = spark.createDataFrame([("a", "b"), ("a", "c")], "peak string, bg_peak string")
    row = links.link_statistics(mi, near, bg).first()
    assert row.zscore == float("inf") and row.pval == 0


@pytest.mark.parametrize(
    "text,n,want",
    [
        ("..+4ACAC.+4ACAC.+2AC", 4, [".", ".+ACAC", ".+ACAC", ".+AC"]),
        (".,,-7tttttgtt", 4, [".", ",", ",-tttttgt", "t"]),
        (",$.,,^>.", 5, [",$", ".", ",", ",", "^."]),
        (",.,.*.**.^*.", 10, [",", ".", ",", ".", "*", ".", "*", "*", ".", "^."]),
        ("A-1N", 1, ["A-N"]),
        ("AC", 3, None),
        ("!AC", 2, None),
        ("AC!", 2, ["A", "C"]),
    ],
)
def test_pileup_tokens(spark, text, n, want):
    row = spark.createDataFrame([(text, n)], "text string, n int").select(mutation.pileup_tokens(F.col("text"), F.col("n")).alias("t"))
    assert row.first().t == want


def test_marked_alleles_stay_apart_unless_stripped(spark):
    df = spark.createDataFrame([("^A",), ("A$",), ("^.",), ("*",), (">",), (".$",)], "t string")
    kept = [r[0] for r in df.select(mutation.normalise_allele(F.col("t"), F.lit("g"))).collect()]
    bare = [r[0] for r in df.select(mutation.normalise_allele(F.col("t"), F.lit("g"), True)).collect()]
    assert kept == ["^A", "A$", "g", "D", "S", "g"]
    assert bare == ["A", "A", "g", "D", "S", "g"]


def _circle_line(s1, e1, s2, e2, s3, e3, second, strands="++-", cigar="30M"):
    def rec(s, e, strand, order):
        return ["chr1", str(s), str(e), "cell:UMI:read", ".", ".", strand, cigar, order, "."]

    parts = rec(s1, e1, strands[0], "second" if second == 1 else "first")
    parts += rec(s2, e2, strands[1], "second" if second == 2 else "first") + rec(s3, e3, strands[2], "x")
    return ("\t".join(parts),)


def test_circle_selection(spark):
    lines = [
        _circle_line(500, 560, 100, 160, 120, 550, 2),
        _circle_line(100, 160, 500, 560, 100, 560, 1),
        _circle_line(500, 560, 100, 160, 90, 550, 2),
        _circle_line(500, 560, 100, 160, 120, 550, 1),
        _circle_line(500, 560, 100, 160, 120, 550, 2, "+--"),
        _circle_line(500, 560, 100, 160, 120, 550, 2, cigar="10M10I10D20M30S"),
    ]
    rows = circle.circle_columns(spark.createDataFrame(lines, "value string"))
    out = circle.select_circles(rows).collect()
    assert sorted((r.start, r.end, r.cell_barcode, r.umi) for r in out) == [(100, 560, "cell", "UMI")] * 2
    assert [r.n for r in circle.count_circles(circle.select_circles(rows)).collect()] == [1]


def test_a_pileup_text_is_parsed_once_per_row(spark):
    rows = [("c", 1, "A", 3, "^I.$C+2AC*", "III", "a:1,b:2,c:3"), ("c", 2, "A", 4, "..CC", "IIII", "a:1,b:2,b:3,c:4"), ("c", 3, "A", 2, "^+.+99999999999", "I", "a:1")]
    pileup = spark.createDataFrame(rows, "chrom string, pos int, ref string, depth int, match string, qual string, names string")
    counts = mutation.allele_counts(mutation.pileup_sites(pileup, 2), 1, 2)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "aggregate(" not in plan
    assert {tuple(r) for r in counts.collect()} == {("c", 2, "a", "A", 1), ("c", 2, "b", "A", 1), ("c", 2, "b", "C", 1), ("c", 2, "c", "C", 1)}
    tokens = pileup.select("pos", mutation.pileup_tokens(F.col("match"), F.length("qual")).alias("t"))
    assert dict(map(tuple, tokens.collect())) == {1: ["^.$", "C+AC", "*"], 2: [".", ".", "C", "C"], 3: ["^.+"]}
