"""Peak-gene association: nearby peaks, matched background, mutual information, FDR."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.stats import normal_sf
from cellweave.lineage import cut
from cellweave.operators.intervals import bin_of, clip_to_bins, overlap_join
from cellweave.operators.ordering import global_index

MI_BINS = 8


# ---- matrices -------------------------------------------------------------------------------

def binarise(matrix: DataFrame) -> DataFrame:
    return matrix.withColumn("value", F.least(F.col("value"), F.lit(1)))


def feature_cells(matrix: DataFrame, feature: str) -> DataFrame:
    """In how many cells each feature has a positive value."""
    return matrix.where("value > 0").groupBy(feature).agg(F.count("*").alias("n_cells"))


def filter_matrix(matrix: DataFrame, feature: str, min_cells: int = 5, min_features: int = 100) -> DataFrame:
    """Drop features seen in too few cells, then cells with too few of the remaining features."""
    features = feature_cells(matrix, feature).where(F.col("n_cells") >= min_cells)
    kept = matrix.join(features.select(feature), feature, "left_semi")
    cells = (
        kept.where("value > 0").groupBy("cell").agg(F.count("*").alias("_n"))
        .where(F.col("_n") >= min_features)
    )
    return kept.join(cells.select("cell"), "cell", "left_semi")


def common_cells(rna: DataFrame, atac: DataFrame) -> DataFrame:
    return rna.select("cell").distinct().join(atac.select("cell").distinct(), "cell", "left_semi")


def cpm(matrix: DataFrame, target: float = 1e6) -> DataFrame:
    """Scale each cell to ``target`` in total."""
    total = matrix.groupBy("cell").agg(F.sum("value").alias("_t"))
    return matrix.join(total, "cell").withColumn(
        "value", F.try_divide(F.col("value") * target, F.col("_t"))
    ).drop("_t")


def scale_by_batch(matrix: DataFrame, feature: str) -> DataFrame:
    """Divide each feature by its largest absolute value within the batch."""
    top = matrix.groupBy("batch", feature).agg(F.max(F.abs("value")).alias("_m"))
    return matrix.join(top, ["batch", feature]).withColumn(
        "value", F.when(F.col("_m") > 0, F.col("value") / F.col("_m")).otherwise(F.col("value"))
    ).drop("_m")


# ---- peaks and genes ------------------------------------------------------------------------

def parse_peak(peak: Column) -> list[Column]:
    """chrom, start and end of a 'chr:start-end' (species prefix dropped) or 'chr_start_end' name."""
    colon = peak.contains(":")
    span = F.split_part(peak, F.lit(":"), F.lit(2))
    under = F.split(peak, "_")
    chrom = F.when(
        colon, F.element_at(F.split(F.split_part(peak, F.lit(":"), F.lit(1)), "_"), -1)
    ).otherwise(F.get(under, 0))
    start = F.when(colon, F.split_part(span, F.lit("-"), F.lit(1))).otherwise(F.get(under, 1))
    end = F.when(colon, F.split_part(span, F.lit("-"), F.lit(2))).otherwise(F.get(under, 2))
    return [chrom.alias("chrom"), start.cast("bigint").alias("start"), end.cast("bigint").alias("end")]


def peak_table(names: DataFrame) -> DataFrame:
    return names.select("peak", *parse_peak(F.col("peak")))


def resolve_genes(queries: DataFrame, genes: DataFrame) -> DataFrame:
    """(gene, gene_id): match by id, else by name, else by id without its version.

    Names and unversioned ids share one list in annotation order, so the first of either wins.
    ``genes`` may carry an ``ordinal``; otherwise gene_id orders them. Unknown names are left out.
    """
    order = "ordinal" if "ordinal" in genes.columns else "gene_id"
    asked = queries.select("gene").distinct()
    exact = asked.join(genes.select(F.col("gene_id").alias("gene"), F.col("gene_id").alias("_exact")), "gene", "left")
    alias = (
        genes.select(
            "gene_id", F.col(order).alias("_o"),
            F.explode(F.array_distinct(F.array("gene_name", F.split_part("gene_id", F.lit("."), F.lit(1))))).alias("gene"),
        )
        .groupBy("gene")
        .agg(F.min_by("gene_id", "_o").alias("_alias"))
    )
    return (
        exact.join(alias, "gene", "left")
        .select("gene", F.coalesce("_exact", "_alias").alias("gene_id"))
        .where("gene_id is not null")
    )


def by_gene_id(expression: DataFrame, genes: DataFrame) -> DataFrame:
    """(cell, gene_id, value) of a matrix whose genes are ids or names; entries of names of one gene are summed."""
    asked = expression.withColumnRenamed("gene_id", "gene")
    named = asked.join(resolve_genes(asked, genes), "gene")
    return named.groupBy("cell", "gene_id").agg(F.sum("value").alias("value"))


def bare_contig(chrom: Column) -> Column:
    """The contig without the species in front of it, as in peak names and gene starts."""
    return F.element_at(F.split(chrom, "_"), -1)


def gene_tss(genes: DataFrame) -> DataFrame:
    """TSS of each gene on the bare contig: start on the plus strand, end on the minus strand."""
    return genes.select(
        "gene_id", "gene_name",
        bare_contig(F.col("chrom")).alias("chrom"),
        F.when(F.col("strand") == "-", F.col("end")).otherwise(F.col("start")).alias("tss"),
    )


def peaks_near_genes(tss: DataFrame, peaks: DataFrame, window_kb: int = 500) -> DataFrame:
    """(gene_id, peak): peaks with an end strictly inside tss +- window.

    A peak that spans the whole window has both ends outside and is left out.
    """
    w = window_kb * 1000
    windows = tss.select(
        "gene_id", "chrom",
        F.greatest(F.lit(0), F.col("tss") - w).cast("bigint").alias("lo"),
        (F.col("tss") + w).alias("hi"),
    )
    met = overlap_join(
        windows, peaks.select("peak", "chrom", "start", "end"), ["chrom"],
        ("lo", "hi"), ("start", "end"), max(w, 1000),
    )
    inside = ((F.col("lo") < F.col("end")) & (F.col("end") < F.col("hi"))) | (
        (F.col("lo") < F.col("start")) & (F.col("start") < F.col("hi"))
    )
    return met.where(inside).select("gene_id", "peak")


def gc_content(peaks: DataFrame, genome: DataFrame, chunk: int = 65_536) -> DataFrame:
    """(peak, gc_content): percent G or C of [start, end).

    ``genome`` holds pieces (chrom, offset, seq), none of which goes over a multiple of ``chunk``, so no contig has to
    fit in one row.
    """
    pieces = clip_to_bins(peaks.select("peak", "chrom", "start", "end"), "start", "end", chunk)
    text = genome.select("chrom", bin_of(F.col("offset"), chunk).alias("bin"), "offset", "seq")
    low = F.greatest(F.lit(0), F.col("start") - F.col("offset"))
    high = F.least(F.length("seq"), F.col("end") - F.col("offset"))
    part = F.substr("seq", (low + 1).cast("int"), F.greatest(F.lit(0), high - low).cast("int"))
    n_gc = F.length(F.regexp_replace(F.upper(part), "[^GC]", ""))
    return (
        pieces.join(text, ["chrom", "bin"])
        .groupBy("peak")
        .agg(F.try_divide(100.0 * F.sum(n_gc), F.sum(F.length(part))).alias("gc_content"))
    )


# ---- background peaks -----------------------------------------------------------------------

def background_peaks(peaks: DataFrame, n_cut: int = 100) -> DataFrame:
    """(peak, bg_peak, rank): the ``n_cut`` peaks with the smallest |dn|/n * |dGC|/GC.

    ``peaks`` has peak, n_cells and gc_content. Ties go to the smaller name; the peak itself
    scores 0 and takes part. For one peak the divisors are constant, so |dn| * |dGC| ranks alike.

    Peaks of equal (n_cells, gc_content) have the same list, and of each such class only the
    first ``n_cut`` names can appear in any list; work is done per class. Score 0 needs an equal
    n or an equal GC, which two joins on those values give. Only classes still short look further:
    all classes with product up to a bound are found, and the bound grows until none is short.
    """
    k = n_cut
    peaks = cut(peaks.select("peak", "n_cells", "gc_content"))  # read many times below
    by_class = Window.partitionBy("n_cells", "gc_content").orderBy("peak")
    members = peaks.select("peak", "n_cells", "gc_content").withColumn(
        "_r", F.row_number().over(by_class)
    ).where(F.col("_r") <= k).drop("_r")
    classes = peaks.groupBy("n_cells", "gc_content").agg(F.count("*").alias("size"))

    def first_by(col: str) -> DataFrame:
        w = Window.partitionBy(col).orderBy("peak")
        top = members.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
        return top.select(col, F.col("peak").alias("bg_peak"))

    zero = (
        classes.join(first_by("n_cells"), "n_cells").select("n_cells", "gc_content", "bg_peak")
        .union(classes.join(first_by("gc_content"), "gc_content").select("n_cells", "gc_content", "bg_peak"))
        .distinct()
        .withColumn("score", F.lit(0.0))
    )
    zero_n = zero.groupBy("n_cells", "gc_content").agg(F.count("*").alias("have"))
    short = cut(zero_n.where(F.col("have") < k).select("n_cells", "gc_content", "have"))

    found = [zero]
    if not short.isEmpty():
        s = classes.agg(
            F.sum("size").alias("n"),
            (F.max("n_cells") - F.min("n_cells")).alias("dn"),
            (F.max("gc_content") - F.min("gc_content")).alias("dg"),
        ).first()
        area = max(float(s["dn"]), 1.0) * max(float(s["dg"]), 1e-6)
        levels = int(math.log2(max(float(s["dn"]), 1.0))) + 1
        bound = min(area, area * k / (4.0 * s["n"]))
        cells = cut(classes.withColumn("take", F.least("size", F.lit(k))))
        while True:
            pairs = _classes_within(short, cells, bound, levels)
            closer = Window.partitionBy("n_cells", "gc_content").orderBy("score")
            # Classes at equal score compete by name, so they are all kept.
            before = F.sum("take").over(closer) - F.sum("take").over(
                Window.partitionBy("n_cells", "gc_content", "score")
            )
            reached = pairs.withColumn("_before", before)
            total = reached.groupBy("n_cells", "gc_content").agg(F.sum("take").alias("got"))
            state = cut(
                short.join(total, ["n_cells", "gc_content"], "left").withColumn(
                    "done", F.col("have") + F.coalesce("got", F.lit(0)) >= k
                )
            )
            last = bound >= area
            settled = state if last else state.where("done")
            near = reached.join(settled.select("n_cells", "gc_content", "have"), ["n_cells", "gc_content"])
            near = near.where(F.col("have") + F.col("_before") < k)
            other = members.select(
                F.col("n_cells").alias("q_n"), F.col("gc_content").alias("q_gc"), F.col("peak").alias("bg_peak")
            )
            found.append(cut(
                near.join(other, ["q_n", "q_gc"]).select("n_cells", "gc_content", "bg_peak", "score")
            ))
            if last:
                break
            short = state.where(~F.col("done")).select("n_cells", "gc_content", "have")
            if short.isEmpty():
                break
            bound = min(area, bound * 4)

    everything = found[0]
    for part in found[1:]:
        everything = everything.union(part)
    rank = Window.partitionBy("n_cells", "gc_content").orderBy("score", "bg_peak")
    lists = everything.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    return peaks.select("peak", "n_cells", "gc_content").join(
        lists.select("n_cells", "gc_content", "bg_peak", "rank"), ["n_cells", "gc_content"]
    ).select("peak", "bg_peak", "rank")


def _classes_within(short: DataFrame, cells: DataFrame, bound: float, levels: int) -> DataFrame:
    """Class pairs with 0 < |dn| * |dGC| <= bound.

    At level j, |dn| lies in [2^j, 2^(j+1)) and |dGC| within bound / 2^j. Bins of that size make
    each level an equality join that meets only neighbouring bins, and a pair meets once.
    """
    def at_levels(df: DataFrame, n: str, g: str) -> DataFrame:
        out = df.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(levels))))
        step = F.pow(F.lit(2.0), F.col("_j"))
        return out.withColumns(
            {
                "_nb": F.floor(F.col(n) / step).cast("bigint"),
                "_gb": F.floor(F.col(g) * step / (bound * 1.000001)).cast("bigint"),
                "_step": step,
            }
        )

    asks = at_levels(short, "n_cells", "gc_content")
    asks = asks.withColumn("_dn", F.explode(F.array(*[F.lit(d) for d in (-2, -1, 1, 2)])))
    asks = asks.withColumn("_dg", F.explode(F.array(*[F.lit(d) for d in (-1, 0, 1)])))
    asks = asks.withColumns({"_nb": F.col("_nb") + F.col("_dn"), "_gb": F.col("_gb") + F.col("_dg")})
    asks = asks.select("n_cells", "gc_content", "_j", "_nb", "_gb", "_step")
    have = at_levels(
        cells.select(F.col("n_cells").alias("q_n"), F.col("gc_content").alias("q_gc"), "take"), "q_n", "q_gc"
    ).select("q_n", "q_gc", "take", "_j", "_nb", "_gb")
    dn = F.abs(F.col("q_n") - F.col("n_cells"))
    dg = F.abs(F.col("q_gc") - F.col("gc_content"))
    return (
        asks.join(have, ["_j", "_nb", "_gb"])
        .withColumn("score", dn * dg)
        .where((dn >= F.col("_step")) & (dn < 2 * F.col("_step")) & (F.col("score") > 0) & (F.col("score") <= bound))
        .select("n_cells", "gc_content", "q_n", "q_gc", "take", "score")
    )


def similar_genes(corr: DataFrame, n_cut: int = 100) -> DataFrame:
    """The ``n_cut`` most correlated partners per gene of a (gene, other, corr) table."""
    w = Window.partitionBy("gene").orderBy(F.desc("corr"), "other")
    return corr.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n_cut)


# ---- mutual information ---------------------------------------------------------------------

def mutual_information(
    pairs: DataFrame, expr: DataFrame, acc: DataFrame, n_cells: Column, bins: int = MI_BINS
) -> DataFrame:
    """(gene_id, peak, mi) in nats, from an equal-width histogram per axis.

    ``expr`` is (cell, gene_id, value) and ``acc`` (cell, peak) of open peaks; a missing entry is
    0. Cells are numbered and packed 64 to a word: a peak's open cells and a gene's cells of one bin meet as words, and the
    set bits of their conjunction are the joint count, so no row stands for a single cell. The counts for absent entries
    follow from the margins. Both tables are read several times, so pass stored or checkpointed ones.
    """
    spread = expr.groupBy("gene_id").agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.count("*").alias("_stored")
    )
    spread = spread.withColumn("_n", n_cells)
    gap = F.col("_stored") < F.col("_n")
    spread = spread.withColumns(
        {
            "_lo": F.when(gap, F.least(F.col("_lo"), F.lit(0.0))).otherwise(F.col("_lo")),
            "_hi": F.when(gap, F.greatest(F.col("_hi"), F.lit(0.0))).otherwise(F.col("_hi")),
        }
    )

    def bin_no(v: Column) -> Column:
        width = F.col("_hi") - F.col("_lo")
        inner = F.floor(F.try_divide((v - F.col("_lo")) * bins, width))
        # A constant vector falls in the middle of a unit range around its value.
        return F.when(width > 0, F.least(inner, F.lit(bins - 1))).otherwise(bins // 2).cast("int")

    spread = spread.withColumn("_zero", bin_no(F.lit(0.0)))
    binned = expr.join(spread, "gene_id").select(
        "cell", "gene_id", bin_no(F.col("value")).alias("y")
    )
    stored = binned.groupBy("gene_id", "y").agg(F.count("*").alias("ny"))
    absent = spread.select(
        "gene_id", F.col("_zero").alias("y"), (F.col("_n") - F.col("_stored")).alias("ny")
    )
    margin = stored.unionByName(absent).groupBy("gene_id", "y").agg(F.sum("ny").alias("ny")).where("ny > 0")

    open_cells = acc.groupBy("peak").agg(F.count("*").alias("n1"))
    wanted = pairs.select("gene_id", "peak").distinct()
    numbers = global_index(expr, "cell")

    def words(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
        bit = F.expr("shiftleft(1L, cast(index % 64 as int))")
        word = F.floor(F.col("index") / 64).alias("word")
        return rows.join(numbers, "cell").groupBy(*keys, word).agg(F.bit_or(bit).alias(name))

    met = (
        wanted.join(words(acc, ["peak"], "_open"), "peak")
        .join(words(binned, ["gene_id", "y"], "_in"), ["gene_id", "word"])
        .groupBy("gene_id", "peak", "y")
        .agg(F.sum(F.bit_count(F.col("_open").bitwiseAND(F.col("_in")))).alias("n11"))
        .where("n11 > 0")
    )
    met_total = met.groupBy("gene_id", "peak").agg(F.sum("n11").alias("_met"))
    base = (
        wanted.join(open_cells, "peak", "left").join(met_total, ["gene_id", "peak"], "left")
        .join(spread.select("gene_id", "_zero", "_n"), "gene_id")
        .join(margin, "gene_id")
        .join(met, ["gene_id", "peak", "y"], "left")
    )
    n = F.col("_n").cast("double")
    n1 = F.coalesce("n1", F.lit(0))
    here = F.coalesce("n11", F.lit(0)) + F.when(
        F.col("y") == F.col("_zero"), n1 - F.coalesce("_met", F.lit(0))
    ).otherwise(0)

    def term(joint: Column, side: Column) -> Column:
        ratio = joint * n / (side * F.col("ny"))
        return F.when(joint > 0, joint / n * F.ln(ratio)).otherwise(0.0)

    total = term(here, n1) + term(F.col("ny") - here, F.col("_n") - n1)
    return base.groupBy("gene_id", "peak").agg(F.sum(total).alias("mi"))


def link_statistics(mi: DataFrame, near: DataFrame, background: DataFrame) -> DataFrame:
    """(gene_id, peak, mi, zscore, pval) against the mutual information of the background peaks.

    ``mi`` must cover the near pairs and every (gene, background peak). A background without
    spread gives an infinite z in the direction of the difference.
    """
    bg = (
        near.join(background, "peak")
        .join(mi.select("gene_id", F.col("peak").alias("bg_peak"), F.col("mi").alias("bg_mi")), ["gene_id", "bg_peak"])
        .groupBy("gene_id", "peak")
        .agg(F.avg("bg_mi").alias("_mean"), F.stddev_pop("bg_mi").alias("_std"))
    )
    diff = F.col("mi") - F.col("_mean")
    z = F.when(F.col("_std") > 0, F.try_divide(diff, F.col("_std"))).when(
        diff != 0, F.signum(diff) * F.lit(float("inf"))
    )
    return (
        near.join(mi, ["gene_id", "peak"]).join(bg, ["gene_id", "peak"])
        .withColumn("zscore", z)
        .select("gene_id", "peak", "mi", "zscore", normal_sf(F.abs("zscore")).alias("pval"))
    )


def background_pairs(near: DataFrame, background: DataFrame) -> DataFrame:
    """All (gene, peak) whose mutual information is needed, each once."""
    bg = near.join(background, "peak").select("gene_id", F.col("bg_peak").alias("peak"))
    return near.select("gene_id", "peak").union(bg).distinct()


def significant(links: DataFrame, pval: float = 0.05) -> DataFrame:
    return links.where((F.col("pval") < pval) & (F.col("zscore") > 0))


def links_per_gene(links: DataFrame, pval: float = 0.05) -> DataFrame:
    """Significant peaks per tested gene, zero included."""
    hit = (F.col("pval") < pval) & (F.col("zscore") > 0)
    return links.groupBy("gene_id").agg(F.count_if(hit).alias("n_links"))


def correct_fdr(links: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Benjamini-Hochberg over all links with positive z: adds pval_adj and accept.

    Works on distinct p-values with their counts, sorted over range partitions whose bounds follow the data. Ranks and
    the running minimum are taken inside each partition, with one row of carry per partition: the sum of those before it,
    the minimum of those behind it. ``links`` is read twice.
    """
    tested = links.where(F.col("zscore") > 0)
    levels = tested.groupBy("pval").agg(F.count("*").alias("_c"))
    # Checkpointed, so that the partitions hold still.
    levels = cut(levels.orderBy("pval")).withColumn("_block", F.shiftright(F.monotonically_increasing_id(), 33))
    blocks = levels.groupBy("_block").agg(F.sum("_c").alias("_bc"))
    order = Window.orderBy("_block")
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_bc").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_bc").over(Window.partitionBy()).alias("_all"),
    )
    inside = Window.partitionBy("_block").orderBy("pval")
    ranked = levels.join(blocks, "_block").withColumn(
        "_raw",
        F.col("pval") * F.col("_all") / (F.col("_before") + F.sum("_c").over(inside)),
    )
    tail = inside.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = ranked.withColumn("_low", F.min("_raw").over(tail))
    later = ranked.groupBy("_block").agg(F.min("_raw").alias("_bmin")).select(
        "_block", F.min("_bmin").over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_later")
    )
    adjusted = ranked.join(later, "_block").select(
        "pval", F.least(F.lit(1.0), F.col("_low"), F.col("_later")).alias("pval_adj")
    )
    return tested.join(adjusted, "pval").withColumn("accept", F.col("pval_adj") <= alpha)


def merge_links(links: DataFrame, genes: DataFrame) -> DataFrame:
    """Attach gene name and TSS; genes without annotation are dropped one by one."""
    return links.join(gene_tss(genes).drop("chrom"), "gene_id")
