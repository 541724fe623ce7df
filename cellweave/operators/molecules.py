"""Reads to molecules: alignment filters, UMI counting, UMI collapse, read-level deduplication."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOLECULE_KEY = ["cell_barcode", "genome", "gene", "umi"]


# ---- alignment predicates -------------------------------------------------------------------

def is_mito(reference_name: Column) -> Column:
    return reference_name.contains("chrM") | reference_name.contains("mito")


def rna_alignments(reads: DataFrame) -> DataFrame:
    """Primary, uniquely mapped alignments (the aligner marks those with mapq 255)."""
    return reads.where(~F.col("is_secondary") & (F.col("mapq") == 255))


def _paired(reads_ok: Column) -> Column:
    both_mapped = ~F.col("is_unmapped") & ~F.col("mate_is_unmapped")
    return reads_ok & both_mapped & F.col("is_proper_pair") & ~F.col("is_reverse")


def _usable(min_mapq: int, max_flen: int) -> Column:
    return (F.abs(F.col("tlen")) <= max_flen) & (F.col("mapq") >= min_mapq)


def atac_alignments(reads: DataFrame, min_mapq: int = 30, max_flen: int = 1000) -> DataFrame:
    """Forward mates of usable, properly paired, nuclear fragments."""
    nuclear = ~F.col("is_secondary") & ~is_mito(F.col("reference_name"))
    return reads.where(_paired(nuclear) & _usable(min_mapq, max_flen))


def atac_funnel(reads: DataFrame, min_mapq: int = 30, max_flen: int = 1000) -> DataFrame:
    """How many alignments survive each ATAC filter, in one pass."""
    primary = ~F.col("is_secondary")
    mito = is_mito(F.col("reference_name"))
    paired = _paired(primary & ~mito)
    return reads.agg(
        F.count("*").alias("total_reads"),
        F.count_if(primary).alias("uniquely_mapped"),
        F.count_if(primary & mito).alias("chrm_reads"),
        F.count_if(paired).alias("proper_pairs"),
        F.count_if(paired & _usable(min_mapq, max_flen)).alias("usable_pairs"),
    )


def block_span(df: DataFrame, blocks: str = "blocks") -> DataFrame:
    """first_pos and last_pos (inclusive) of an aligned read from its half-open blocks."""
    return df.withColumns(
        {
            "first_pos": F.element_at(F.col(blocks), 1)["start"],
            "last_pos": F.element_at(F.col(blocks), -1)["end"] - 1,
        }
    )


def fragment_span(df: DataFrame) -> DataFrame:
    """Treat the whole ATAC fragment as one block; its far end takes part in the gene test."""
    size = F.abs(F.col("tlen"))
    return df.withColumns(
        {
            "first_pos": F.col("pos"),
            "last_pos": F.col("pos") + size,
            "blocks": F.array(F.struct(F.col("pos").alias("start"), (F.col("pos") + size).alias("end"))),
        }
    )


# ---- counting and collapsing ----------------------------------------------------------------

def count_umis(hits: DataFrame) -> DataFrame:
    """Reads per (cell, genome, gene, umi) and whether most of those reads are exonic."""
    return hits.groupBy(*MOLECULE_KEY).agg(
        F.count("*").alias("counts"),
        (F.avg(F.col("exonic").cast("double")) > 0.5).alias("exonic"),
    )


def collapse_group(umis: list[str], counts: list[int]) -> list[int]:
    """Fold each UMI, in sorted order, into its first neighbour that holds more reads.

    Neighbours differ at one position. Counts grow as UMIs are folded in, so the order matters;
    a UMI folded away ends with 0. Masking one position at a time finds neighbours without
    comparing pairs: the members of a masked bucket differ in that position only.
    """
    near: dict[int, list[int]] = {}
    for pos in range(max(map(len, umis))):
        buckets: dict[str, list[int]] = {}  # one position at a time keeps large groups small
        for idx, umi in enumerate(umis):
            if pos < len(umi):
                buckets.setdefault(umi[:pos] + "." + umi[pos + 1 :], []).append(idx)
        for members in buckets.values():
            if len(members) > 1:
                for idx in members:
                    near.setdefault(idx, []).extend(m for m in members if m != idx)
    left = list(counts)
    for idx in sorted(near):
        for other in sorted(near[idx]):
            if left[other] > left[idx]:
                left[other] += left[idx]
                left[idx] = 0
                break
    return left


def _collapse_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Collapse runs of equal (cell, gene); the last run of a batch waits for the next batch."""
    held: list[pd.DataFrame] = []

    def finish(df: pd.DataFrame) -> pd.DataFrame:
        cell, gene = df["cell_barcode"].to_numpy(), df["gene"].to_numpy()
        edge = np.flatnonzero((cell[1:] != cell[:-1]) | (gene[1:] != gene[:-1])) + 1
        bounds = [0, *edge.tolist(), len(df)]
        umis, counts = df["umi"].tolist(), df["counts"].tolist()
        merged: list[int] = []
        for lo, hi in zip(bounds, bounds[1:]):
            merged += counts[lo:hi] if hi - lo == 1 else collapse_group(umis[lo:hi], counts[lo:hi])
        out = df.assign(counts=merged)
        return out[out["counts"] > 0]

    for batch in batches:
        if batch.empty:
            continue
        cell, gene = batch["cell_barcode"].to_numpy(), batch["gene"].to_numpy()
        tail = len(batch)
        while tail and cell[tail - 1] == cell[-1] and gene[tail - 1] == gene[-1]:
            tail -= 1
        same_run = bool(held) and (
            held[-1]["cell_barcode"].iloc[-1] == cell[0] and held[-1]["gene"].iloc[-1] == gene[0]
        )
        if tail == 0 and (same_run or not held):
            held.append(batch)
            continue
        ready = pd.concat([*held, batch.iloc[:tail]], ignore_index=True)
        held = [batch.iloc[tail:]]
        if len(ready):
            yield finish(ready)
    if held:
        yield finish(pd.concat(held, ignore_index=True))


def collapse_umis(counts: DataFrame) -> DataFrame:
    """Merge UMIs one mismatch apart within each (cell, gene); same columns in and out.

    ``counts`` is one row per (cell, gene, umi), so a group holds at most 4^length rows (about a
    million for a 10-base UMI), whatever the read depth. Groups with one UMI, usually most of them,
    never leave the JVM: both branches read the same shuffle.
    """
    cols = counts.columns
    grouped = counts.repartition("cell_barcode", "gene").withColumn(
        "_n", F.count("*").over(Window.partitionBy("cell_barcode", "gene"))
    )
    single = grouped.where("_n = 1").select(*cols)
    several = (
        grouped.where("_n > 1").select(*cols).sortWithinPartitions("cell_barcode", "gene", "umi")
    )
    return single.unionByName(several.mapInPandas(_collapse_sorted, counts.schema))


def umi_neighbours(umis: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs (umi, neighbour) one mismatch apart within ``keys``, found through masked positions."""
    masked = umis.select(
        *keys, "umi", F.explode(F.sequence(F.lit(1), F.length("umi"))).alias("at")
    ).withColumn(
        "mask",
        F.concat(F.expr("substring(umi, 1, at - 1)"), F.lit("."), F.expr("substring(umi, at + 1)")),
    )
    other = masked.select(*keys, "mask", F.col("umi").alias("neighbour"))
    return masked.join(other, [*keys, "mask"]).where("umi <> neighbour").select(*keys, "umi", "neighbour")


def molecule_totals(molecules: DataFrame) -> DataFrame:
    named = ~F.col("gene_name").isin("Intergenic", "Ambiguous")
    return molecules.agg(
        F.sum("counts").alias("total_read_count"),
        F.sum(F.when(named, F.col("counts")).otherwise(0)).alias("mapped_to_gene"),
        F.count("*").alias("total_umis"),
    )


def with_gene_names(molecules: DataFrame, genes: DataFrame) -> DataFrame:
    """Attach gene_name; the two placeholder genes are named after their prefix."""
    names = genes.select(F.col("gene_id").cast("string").alias("gene"), "gene_name")
    placeholder = F.regexp_extract("gene", "^(Intergenic|Ambiguous)_", 1)
    return molecules.join(names, "gene", "left").withColumn(
        "gene_name", F.coalesce("gene_name", F.nullif(placeholder, F.lit("")), F.lit(""))
    )


# ---- read-level filters on the ATAC alignments ----------------------------------------------

def filter_atac_bam(
    reads: DataFrame,
    molecules: DataFrame,
    cells: DataFrame,
    min_mapq: int = 30,
    max_flen: int = 1000,
) -> DataFrame:
    """Keep the first read pair of every molecule that belongs to a called cell.

    Reads of other molecules go first. The pair is chosen by the smallest read name per (cell, umi) as a plain
    minimum, which combines before the shuffle; its mates follow by read name.
    """
    ok = (
        ~F.col("is_unmapped") & ~F.col("mate_is_unmapped") & ~F.col("is_secondary")
        & ~F.col("reference_name").contains("chrM")
        & F.col("is_proper_pair") & _usable(min_mapq, max_flen)
    )
    kept = reads.where(ok)
    wanted = (
        molecules.select("cell_barcode", "umi")
        .join(cells.select("cell_barcode"), "cell_barcode", "left_semi")
        .distinct()
    )
    first = (
        kept.where("is_read1")
        .select("cell_barcode", "umi", "qname")
        .join(wanted, ["cell_barcode", "umi"], "left_semi")
        .groupBy("cell_barcode", "umi")
        .agg(F.min("qname").alias("qname"))
        .select("qname")
    )
    return kept.join(first, "qname", "left_semi")
