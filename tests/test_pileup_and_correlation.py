"""Pileups of alignments, read back to alleles, and correlations in small blocks."""

import random

import numpy as np

from cellweave.operators import correlation, mutation, pileup

GENOME = "ACGTACGTACGTTTGCAACC" * 3
FIELDS = "qname string, flag int, reference_name string, pos bigint, mapq int, cigar string, seq string, qual string"


def genome(spark):
    return spark.createDataFrame([("c1", i, GENOME[i : i + 16]) for i in range(0, len(GENOME), 16)], "chrom string, offset bigint, seq string")


def at(rows, pos):
    return next(((r.depth, r.match, r.names) for r in rows if r.pos == pos), None)


def test_marks_of_a_pileup(spark):
    reads = [
        ("a", 0, "c1", 2, 10, "3S6M4D4M", "TTT" + GENOME[2:8] + GENOME[12:16], "I" * 13),  # a deletion over the end of a piece
        ("b", 16, "c1", 4, 60, "4M2I4M", GENOME[4:8] + "GG" + GENOME[8:12], "I" * 10),
        ("c", 0, "c1", 0, 200, "4M20N4M", GENOME[0:4] + GENOME[24:28], "I" * 8),  # skips
        ("d", 0, "c1", 5, 30, "4M", "NAAA", "I!II"),  # a base too bad, another than the contig's
        ("e", 4, "c1", 5, 30, "4M", "AAAA", "IIII"), ("f", 1, "c1", 5, 30, "4M", "AAAA", "IIII"), ("g", 1024, "c1", 5, 30, "4M", "AAAA", "IIII"),
        ("h", 0, "c1", 5, 0, "*", "AAAA", "IIII"),
    ]
    df = spark.createDataFrame(reads, FIELDS)
    rows = pileup.pileup_rows(df, genome(spark), chunk=16).collect()
    assert at(rows, 1) == (1, "^~.", "c")
    assert at(rows, 3) == (2, ".^+.", "c,a")
    assert at(rows, 4) == (2, "..", "c,a")
    assert at(rows, 5) == (3, ">.^],", "c,a,b")
    assert at(rows, 6) == (4, ">.,^?N", "c,a,b,d")
    assert at(rows, 8) == (4, ">.-4ACGT,+2gg" + ("." if GENOME[7] == "A" else "A"), "c,a,b,d")
    assert at(rows, 9) == (4, ">*," + ("." if GENOME[8] == "A" else "A") + "$", "c,a,b,d")
    assert at(rows, 16) == (2, ">.$", "c,a")
    assert at(rows, 20) is None and at(rows, 28) == (1, ".$", "c")
    tokens = mutation.pileup_tokens
    parsed = pileup.pileup_rows(df, genome(spark), chunk=16)
    assert parsed.where(tokens(parsed.match, parsed.depth).isNull()).count() == 0
    sites = spark.createDataFrame([("c1", 8)], "chrom string, pos bigint")
    assert [r.pos for r in pileup.pileup_rows(df, genome(spark), sites=sites, chunk=16).collect()] == [8]
    assert at(pileup.pileup_rows(df, genome(spark), orphans=True, chunk=16).collect(), 6)[0] == 5


def test_correlation_in_blocks(spark):
    rng = random.Random(3)
    cells, genes = 45, 13
    dense = np.array([[rng.choice([0, 0, 1, 2, 5]) for _ in range(cells)] for _ in range(genes)], float)
    dense[4] = dense[2]  # ties
    dense[7] = 1.0  # constant
    dense[:, 0] += 1  # every cell and gene is there
    dense[7] = 1.0
    rows = [(f"c{c:02d}", f"g{g:02d}", float(dense[g, c])) for g in range(genes) for c in range(cells) if dense[g, c]]
    got = correlation.similar_genes(spark.createDataFrame(rows, "cell string, gene_id string, value double"), 4, genes=4, cells=8).collect()
    kept = sorted({r[0] for r in rows})
    seen = dense[:, [int(c[1:]) for c in kept]]
    with np.errstate(invalid="ignore", divide="ignore"):
        corr = np.round(np.corrcoef(seen), 12)
    want = []
    for g in range(genes):
        best = sorted((-corr[g, o], f"g{o:02d}") for o in range(genes) if np.isfinite(corr[g, o]))[:4]
        want += [(f"g{g:02d}", o, round(-c, 9), i + 1) for i, (c, o) in enumerate(best)]
    assert sorted((r.gene, r.other, round(r.corr, 9), r["rank"]) for r in got) == sorted(want)
