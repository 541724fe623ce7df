"""Digital gene expression: sparse counts, automatic cell calling, species calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.quantiles import exact_quantiles

GRID = 500  # points on the log-log rank curve


def genic(molecules: DataFrame) -> DataFrame:
    return molecules.where(~F.col("gene_name").isin("Intergenic", "Ambiguous"))


def cell_totals(molecules: DataFrame) -> DataFrame:
    """Molecules per cell."""
    return molecules.groupBy("cell_barcode").agg(F.count("*").alias("umi_count"))


def count_matrix(molecules: DataFrame, cutoff: Column | float = 10) -> DataFrame:
    """(cell_barcode, genome, gene, value) for cells with more than 3 and more than ``cutoff`` molecules.

    The matrix stays in coordinate form; it is only made rectangular on export.
    """
    entries = molecules.groupBy("cell_barcode", "genome", "gene").agg(F.count("*").alias("value"))
    floor = F.greatest(F.lit(3.0), F.lit(cutoff) if isinstance(cutoff, (int, float)) else cutoff)
    cells = entries.groupBy("cell_barcode").agg(F.sum("value").alias("_n")).where(F.col("_n") > floor)
    return entries.join(cells.select("cell_barcode"), "cell_barcode", "left_semi")


def gene_metadata(matrix: DataFrame, genes: DataFrame) -> DataFrame:
    """Expressed genes with name and genome."""
    names = genes.select(F.col("gene_id").cast("string").alias("gene"), "gene_name")
    return matrix.select("gene", "genome").distinct().join(names, "gene", "left").select(
        F.col("gene").alias("gene_id"), F.coalesce("gene_name", F.lit("")).alias("gene_name"), "genome"
    )


def species_counts(matrix: DataFrame) -> DataFrame:
    """Molecules and genes per cell and genome."""
    return matrix.groupBy("cell_barcode", "genome").agg(
        F.sum("value").cast("bigint").alias("umi_count"),
        F.count("*").alias("gene_count"),
    )


def cell_metadata(matrix: DataFrame, purity: float = 0.9) -> DataFrame:
    """One row per cell: species if it owns more than ``purity`` of the molecules, else multiplet."""
    per = species_counts(matrix)
    total = F.sum("umi_count")
    top = F.max("umi_count")
    return per.groupBy("cell_barcode").agg(
        F.when(top / total > purity, F.max_by("genome", "umi_count")).otherwise("multiplet").alias("species"),
        total.cast("bigint").alias("umi_count"),
        F.sum("gene_count").cast("bigint").alias("gene_count"),
    )


def barnyard(matrix: DataFrame, genome1: str, genome2: str) -> DataFrame:
    """Per cell the molecules of two genomes and its class at a 9:1 ratio."""
    one = F.coalesce(F.sum(F.when(F.col("genome") == genome1, F.col("value"))), F.lit(0))
    two = F.coalesce(F.sum(F.when(F.col("genome") == genome2, F.col("value"))), F.lit(0))
    per = matrix.groupBy("cell_barcode").agg(
        one.cast("bigint").alias("count1"), two.cast("bigint").alias("count2")
    )
    return per.withColumn(
        "class",
        F.when(F.col("count2") > 9 * F.col("count1"), genome2)
        .when(F.col("count1") > 9 * F.col("count2"), genome1)
        .otherwise("mixed"),
    )


def barnyard_summary(classes: DataFrame) -> DataFrame:
    """Cells per class; the percentage uses a window over at most three rows."""
    n = classes.groupBy("class").agg(F.count("*").alias("cells"))
    return n.withColumn("percent", 100.0 * F.col("cells") / F.sum("cells").over(Window.partitionBy()))


# ---- knee -----------------------------------------------------------------------------------

def depth_histogram(totals: DataFrame) -> DataFrame:
    """Cells per molecule count.

    K distinct counts need at least K(K+1)/2 molecules, so N molecules give at most sqrt(2N)
    rows (1.4 million for 10^12). The steps below may therefore use one ordered window over it.
    """
    return totals.groupBy("umi_count").agg(F.count("*").alias("cells"))


def knee_curve(hist: DataFrame, cutoff: float) -> DataFrame:
    """The log-log rank curve of the cells above ``cutoff`` at GRID evenly spaced log ranks: (i, y).

    Each grid point lies between rank r and r + 1; both depths are read off the histogram by
    merging the wanted ranks into it and carrying the depth along in rank order.
    """
    above = hist.where(F.col("umi_count") > cutoff)
    ranked = above.withColumn(
        "rank", F.sum("cells").over(Window.orderBy(F.desc("umi_count"))).cast("bigint")
    )
    grid = ranked.agg(F.max("rank").alias("k")).where("k >= 2").select(
        "k", F.explode(F.sequence(F.lit(0), F.lit(GRID - 1))).alias("i")
    )
    x = F.col("i") * F.log10(F.col("k").cast("double")) / (GRID - 1)
    lower = F.least(F.floor(F.pow(F.lit(10.0), F.col("x")) + 1e-9).cast("bigint"), F.col("k") - 1)
    grid = grid.withColumn("x", x).withColumn("r", lower)
    asked = grid.select("i", "x", F.col("r"), F.explode(F.array(F.col("r"), F.col("r") + 1)).alias("rank"))
    merged = ranked.select(
        "rank", "umi_count", F.lit(None).cast("int").alias("i"),
        F.lit(None).cast("double").alias("x"), F.lit(None).cast("bigint").alias("r"),
    ).unionByName(asked.withColumn("umi_count", F.lit(None).cast("bigint")))
    down = Window.orderBy(F.desc("rank"), F.col("umi_count").isNull())
    depth = F.last("umi_count", ignorenulls=True).over(
        down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    points = (
        merged.withColumn("depth", depth)
        .where("i is not null")
        .withColumn("y", F.log10(F.col("depth").cast("double")))
        .groupBy("i", "x", "r")
        .agg(F.min_by("y", "rank").alias("y0"), F.max_by("y", "rank").alias("y1"))
    )
    x0, x1 = F.log10(F.col("r").cast("double")), F.log10((F.col("r") + 1).cast("double"))
    y = F.col("y0") + (F.col("y1") - F.col("y0")) * (F.col("x") - x0) / (x1 - x0)
    return points.select("i", y.alias("y"))


def read_threshold(
    totals: DataFrame,
    frac_low: float = 0.3,
    frac_high: float = 0.925,
    cutoff: float = 100,
    try_iter: int = 10,
    window: int = 20,
) -> DataFrame:
    """One row (threshold): the depth a barcode must exceed to be called a cell.

    The steepest drop over ``window`` grid points gives the first choice, half the depth there.
    If the cells above it hold too few or too many of the molecules, the next steepest drops
    are tried at their full depth, and after ``try_iter`` of them the cutoff itself is used.
    """
    hist = depth_histogram(totals)
    curve = knee_curve(hist, cutoff)
    order = Window.orderBy("i")
    steep = (
        curve.withColumn("drop", F.col("y") - F.lead("y", window).over(order))
        .where("drop is not null")
        .withColumn("attempt", F.row_number().over(Window.orderBy(F.desc("drop"), "i")) - 1)
        .where(F.col("attempt") <= try_iter)
    )
    depth = F.pow(F.lit(10.0), F.col("y"))
    choices = steep.select(
        "attempt", F.when(F.col("attempt") == 0, depth * 0.5).otherwise(depth).alias("threshold")
    )
    # Share of molecules in cells above each choice: merge the choices into the histogram.
    mass = F.col("umi_count") * F.col("cells")
    merged = hist.select(
        F.col("umi_count").cast("double").alias("at"), mass.alias("mass"),
        F.lit(None).cast("int").alias("attempt"),
    ).unionByName(
        choices.select(F.col("threshold").alias("at"), F.lit(0).cast("bigint").alias("mass"), "attempt")
    )
    # At equal depth the choice comes first: only strictly deeper cells count.
    down = Window.orderBy(F.desc("at"), F.col("attempt").isNull())
    share = F.sum("mass").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow)) / F.sum(
        "mass"
    ).over(Window.partitionBy())
    tried = merged.withColumn("fraction", share).where("attempt is not null")
    good = F.col("fraction").between(frac_low, frac_high)
    return tried.agg(
        F.coalesce(F.min_by(F.when(good, F.col("at")), F.when(good, F.col("attempt"))), F.lit(float(cutoff)))
        .alias("threshold")
    )


def called_cells(totals: DataFrame, threshold: DataFrame) -> DataFrame:
    """Barcodes deeper than the one-row ``threshold``, used as a scalar subquery."""
    return totals.where(F.col("umi_count") > threshold.select("threshold").scalar())


def knee_summary(totals: DataFrame, threshold: DataFrame) -> DataFrame:
    cells = called_cells(totals, threshold)
    median = exact_quantiles(cells, {"median_umis": ("umi_count", 0.5)}, [])
    return cells.agg(
        F.count("*").alias("n_cells"),
        F.max(threshold.select("threshold").scalar()).alias("read_threshold"),
    ).withColumn("median_umis", median.scalar())
