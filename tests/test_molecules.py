import random

import pandas as pd
from pyspark.sql import functions as F

from cellweave.operators import dge, molecules, report
from cellweave.operators.molecules import collapse_group


def plain_collapse(umis, counts):
    """Pair-by-pair restatement for small groups."""
    left = dict(zip(umis, counts))
    for u in umis:
        for v in umis:
            if v != u and sum(x != y for x, y in zip(u, v)) == 1 and v in left and left[v] > left[u]:
                left[v] += left.pop(u)
                break
    return left


def _collapse(umis, counts):
    return {u: c for u, c in zip(umis, collapse_group(umis, counts)) if c}


def test_collapse_examples():
    assert _collapse(["AA", "AC", "CC"], [1, 2, 3]) == {"AC": 3, "CC": 3}
    assert _collapse(["AA", "AC"], [2, 2]) == {"AA": 2, "AC": 2}
    assert _collapse(["AAN", "AAC"], [1, 5]) == {"AAC": 6}


def test_collapse_matches_plain_and_conserves_reads():
    rng = random.Random(0)
    for _ in range(300):
        n = rng.randrange(1, 90)
        umis = sorted({"".join(rng.choice("ACGT") for _ in range(4)) for _ in range(n)})
        counts = [rng.randrange(1, 9) for _ in umis]
        got = _collapse(umis, counts)
        assert got == plain_collapse(umis, counts)
        assert sum(got.values()) == sum(counts)


def test_collapse_does_not_depend_on_batches_or_partitions(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for cell in ("c1", "c2", "c3"):
        for gene in ("g1", "g2", "hot"):
            size = 250 if gene == "hot" else rng.randrange(1, 12)
            umis = sorted({"".join(rng.choice("ACGT") for _ in range(5)) for _ in range(size)})
            counts = [rng.randrange(1, 6) for _ in umis]
            rows += [(cell, "hg", gene, u, c, True) for u, c in zip(umis, counts)]
            want.update({(cell, gene, u): c for u, c in plain_collapse(umis, counts).items()})
    rng.shuffle(rows)
    schema = "cell_barcode string, genome string, gene string, umi string, counts bigint, exonic boolean"
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch, parts in (("7", 1), ("10000", 3), ("64", 8)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            df = spark.createDataFrame(rows, schema).repartition(parts)
            got = {(r.cell_barcode, r.gene, r.umi): r.counts for r in molecules.collapse_umis(df).collect()}
            assert got == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_held_run_spanning_batches():
    frames = [
        pd.DataFrame({"cell_barcode": ["a"], "gene": ["x"], "umi": [u], "counts": [c]})
        for u, c in (("AA", 1), ("AC", 2), ("CC", 3))
    ] + [pd.DataFrame({"cell_barcode": ["b"], "gene": ["x"], "umi": ["AA"], "counts": [1]})]
    out = pd.concat(molecules._collapse_sorted(iter(frames)))
    assert list(zip(out.cell_barcode, out.umi, out.counts)) == [("a", "AC", 3), ("a", "CC", 3), ("b", "AA", 1)]


def test_exonic_counts_the_union_of_exons(spark):
    from cellweave.operators import annotation

    reads = spark.createDataFrame(
        [("r1", "c", "g", True, [(90, 110)]), ("r2", "c", "g", True, [(100, 120)]),
         ("r3", "c", "Intergenic_hg", False, [(0, 10)]), ("r4", "c", "g", True, [(990, 1010), (2000, 2005)])],
        "qname string, cell_barcode string, gene string, in_gene boolean, blocks array<struct<start:bigint,end:bigint>>",
    )
    # Two overlapping exons must not count a base twice; the exon end is inclusive.
    exons = spark.createDataFrame([("g", 95, 99), ("g", 97, 100), ("g", 101, 109), ("g", 985, 1009)], "gene_id string, start bigint, end bigint")
    got = {r.qname: r.exonic for r in annotation.mark_exonic(reads, exons, "qname", ["cell_barcode"]).collect()}
    assert got == {"r1": True, "r2": False, "r3": False, "r4": True}


def test_knee_falls_back_to_the_cutoff(spark):
    few = spark.createDataFrame([("a", 500)], "cell_barcode string, umi_count bigint")
    assert dge.read_threshold(few, cutoff=100).first().threshold == 100
    none = spark.createDataFrame([("a", 5), ("b", 6)], "cell_barcode string, umi_count bigint")
    assert dge.read_threshold(none, cutoff=100).first().threshold == 100


def test_species_needs_more_than_the_purity(spark):
    rows = [("a", "hg", "g1", 90), ("a", "mm", "m1", 10), ("b", "hg", "g1", 91), ("b", "mm", "m1", 9)]
    cells = dge.cell_metadata(spark.createDataFrame(rows, "cell_barcode string, genome string, gene string, value bigint"))
    assert {r.cell_barcode: r.species for r in cells.collect()} == {"a": "multiplet", "b": "hg"}


def test_subsampling_has_the_binomial_mean(spark):
    mols = spark.range(20000).select(
        (F.col("id") % 10).cast("string").alias("cell_barcode"), F.lit("hg").alias("genome"),
        F.col("id").cast("string").alias("gene"), F.col("id").cast("string").alias("umi"),
        F.lit(3).alias("counts"),
    )
    cells = spark.createDataFrame([(str(i), "hg") for i in range(10)], "cell_barcode string, species string")
    curve = {r.depth: r.median_umis for r in report.subsample_curves(mols, cells, 60000, step=1500).collect()}
    assert curve[0] == 0 and curve[6000] == 2000
    for depth in (1500, 3000, 4500):
        want = 2000 * (1 - (1 - depth / 6000) ** 3)
        assert abs(curve[depth] - want) < 60


def test_filter_bam_takes_one_pair_per_umi(spark):
    base = dict(is_unmapped=False, mate_is_unmapped=False, is_secondary=False, reference_name="hg_1", is_proper_pair=True, tlen=100, mapq=60)
    rows = []
    for q, cell, umi in (("c1:u1:b", "c1", "u1"), ("c1:u1:a", "c1", "u1"), ("c2:u1:a", "c2", "u1"), ("c1:u9:a", "c1", "u9")):
        for first in (True, False):
            rows.append(dict(base, qname=q, cell_barcode=cell, umi=umi, is_read1=first))
    reads = spark.createDataFrame(pd.DataFrame(rows))
    mols = spark.createDataFrame([("c1", "u1"), ("c2", "u1")], "cell_barcode string, umi string")
    cells = spark.createDataFrame([("c1",)], "cell_barcode string")
    out = molecules.filter_atac_bam(reads, mols, cells).collect()
    assert sorted((r.qname, r.is_read1) for r in out) == [("c1:u1:a", False), ("c1:u1:a", True)]
