"""From raw read pairs to tagged reads of samples: trim, correct, classify, assign, write."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.config import AssayConfig
from cellweave.lineage import cut
from cellweave.operators import barcode, report, trim


@dataclass(frozen=True)
class BarcodeIndex:
    """Whitelists with their neighbourhoods; sized by the whitelists and reused by all libraries."""

    whitelists: Sequence[DataFrame]
    maps: Sequence[DataFrame]
    prefixes: DataFrame | None
    exact_prefixes: DataFrame | None


def build_index(whitelists: Sequence[DataFrame], cfg: AssayConfig, store: bool = True) -> BarcodeIndex:
    """``store`` checkpoints the maps, which pays when several libraries or large whitelists use them."""
    keep = cut if store else (lambda df: df)
    maps = [keep(barcode.neighbour_map(w, d, cfg.method)) for w, d in zip(whitelists, cfg.bc_edit_dist)]
    if not cfg.shifted:
        return BarcodeIndex(whitelists, maps, None, None)
    fixed = cfg.umi_bc_len[1][0]
    near = cut(barcode.prefix_map(whitelists[0], fixed, 1, cfg.method))  # joined in every branch
    exact = barcode.prefix_map(whitelists[0], fixed, 0, cfg.method)
    return BarcodeIndex(whitelists, maps, near, exact)


def _slice(reads: DataFrame, prefixes: DataFrame | None, cfg: AssayConfig) -> DataFrame:
    return barcode.slice_shifted(reads, prefixes, cfg) if cfg.shifted else barcode.slice_fixed(reads, cfg)


def parse_library(
    reads: DataFrame, index: BarcodeIndex, cfg: AssayConfig, lib_id: str, n_sample: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sliced, corrected, tagged) reads of one library of trimmed pairs with an ordinal.

    Perfect triples come from all reads, or from a systematic sample of ``n_sample``. ``reads`` is scanned more than
    once: pass a stored table.
    """
    triples = None
    if n_sample is not None:
        sample = barcode.systematic_sample(reads, n_sample)
        triples = barcode.perfect_triples(_slice(sample, index.exact_prefixes, cfg), index.whitelists)
    sliced = _slice(reads, index.prefixes, cfg)
    corrected = barcode.correct_barcodes(sliced, index.whitelists, index.maps, triples)
    return sliced, corrected, barcode.tag_and_clip(corrected, cfg, lib_id)


def _store(reads: DataFrame, lib_id: str, work_dir: str | None) -> DataFrame:
    if work_dir is None:
        return cut(reads)
    path = f"{work_dir}/{lib_id}"
    reads.write.mode("overwrite").parquet(path)
    return reads.sparkSession.read.parquet(path)


def preprocess(
    libraries: dict[str, DataFrame], whitelists: Sequence[DataFrame], sample_bc: DataFrame,
    cfg: AssayConfig, trimmed: bool = False, work_dir: str | None = None, stats: bool = False,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Tagged reads of all libraries with their sample; key of ``libraries`` is the library id.

    Trimmed reads are written once, as parquet under ``work_dir`` or else as a checkpoint. With ``stats`` also
    (lib_id, stage, key, value) of the barcodes: match classes, tags, perfect shares and base qualities.
    """
    index = build_index(whitelists, cfg)
    out = numbers = None
    for lib_id, reads in libraries.items():
        kept = reads if trimmed else _store(trim.trim_library(reads, cfg), lib_id, work_dir)
        sliced, corrected, tagged = parse_library(kept, index, cfg, lib_id)
        if stats:
            lines = barcode.run_stats(corrected, tagged).select(F.lit("barcodes").alias("stage"), "key", "value")
            exact = _slice(kept, index.exact_prefixes, cfg)
            lines = lines.unionByName(report.as_lines(barcode.perfect_rates(exact, index.whitelists), "perfect"))
            lines = lines.unionByName(report.as_lines(barcode.quality_summary(sliced, cfg), "quality"))
            lines = lines.withColumn("lib_id", F.lit(lib_id)).select("lib_id", "stage", "key", "value")
            numbers = lines if numbers is None else numbers.unionByName(lines)
        tagged = tagged.withColumn("lib_id", F.lit(lib_id))
        out = tagged if out is None else out.unionByName(tagged)
    split = barcode.split_modalities(barcode.with_sample(out, sample_bc), cfg)
    return (split, numbers) if stats else split
