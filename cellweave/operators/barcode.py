"""Cell barcodes: slicing, fuzzy whitelist lookup, correction by observed perfect triples, tagging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.config import AssayConfig
from cellweave.functions.distance import edit_distance, free_divergence
from cellweave.functions.seq import (
    deletion_variants,
    insertion_variants,
    py_slice,
    q30_fraction,
    reverse_complement,
)
from cellweave.lineage import cut
from cellweave.operators.ordering import global_index

OBS = ["obs1", "obs2", "obs3"]
BCS = ["bc1", "bc2", "bc3"]


# ---- whitelist neighbourhoods ---------------------------------------------------------------

def neighbour_map(whitelist: DataFrame, max_d: int = 1, method: str = "FreeDivergence") -> DataFrame:
    """(obs, barcode, d): the whitelist entries nearest to every string within ``max_d`` edits.

    Built from the whitelist side, so its size follows the whitelist and never the reads.
    Strings within k edits of an equal-length barcode are the barcode with k characters deleted
    and k bases inserted; that superset is then measured exactly. All entries tied at the lowest
    distance are kept. Observed strings holding an N are absent, hence never match.
    """
    wl = whitelist.select("barcode").distinct()
    if max_d == 0:
        return wl.select(F.col("barcode").alias("obs"), "barcode", F.lit(0).alias("d"))
    cores = wl.select("barcode", F.explode(deletion_variants("barcode", max_d)).alias("core"))
    near = cores.select("barcode", F.explode(insertion_variants("core", max_d)).alias("obs")).distinct()
    measured = near.withColumn("d", edit_distance(F.col("barcode"), F.col("obs"), method))
    level = F.rank().over(Window.partitionBy("obs").orderBy("d"))
    return (
        measured.where(F.col("d") <= max_d)
        .withColumn("_level", level)
        .where("_level = 1")
        .select("obs", "barcode", "d")
    )


def prefix_map(
    whitelist: DataFrame, fixed: int, max_d: int = 1, method: str = "FreeDivergence"
) -> DataFrame:
    """(bc1_part, n_prefix, shift): how far a mixed-length round-1 barcode shifts later fields."""
    prefixes = whitelist.groupBy(F.substring("barcode", 1, fixed).alias("barcode")).agg(
        F.max(F.length("barcode") - fixed).alias("shift")
    )
    return (
        neighbour_map(prefixes, max_d, method)
        .join(prefixes, "barcode")
        .groupBy(F.col("obs").alias("bc1_part"))
        .agg(F.count("*").alias("n_prefix"), F.max("shift").alias("shift"))
    )


# ---- slicing --------------------------------------------------------------------------------

def i5_of(name: Column) -> Column:
    """The i5 index: after '+' in the last ':' field of the last word of the read name."""
    field = F.trim(name)
    # What follows the last ':' or white space; a pattern costs more than the rest of the slicing.
    for mark in ": \t\n\x0b\f\r":
        field = F.substring_index(field, mark, -1)
    return F.split_part(field, F.lit("+"), F.lit(2))


def _pick(options: Sequence[int], shift: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), shift + 1)


def slice_shifted(reads: DataFrame, prefixes: DataFrame, cfg: AssayConfig) -> DataFrame:
    """Add obs1..obs3, umi and the field offsets for the mixed-length layout on read 1.

    ``slice_status`` is null when the prefix gives one shift, else no_match or multi_match; then
    the slices are null and the offsets are those of shift 0, which the quality summary needs.
    """
    lens, starts = cfg.umi_bc_len, cfg.umi_bc_starts
    out = reads.withColumn("bc1_part", py_slice("seq1", starts[1], lens[1][0])).join(
        prefixes, "bc1_part", "left"
    )
    known = F.col("n_prefix") == 1
    shift = F.when(known, F.col("shift")).otherwise(0)
    out = out.withColumns(
        {
            "bc1_len": _pick(lens[1], shift),
            "bc2_start": _pick(starts[2], shift),
            "tag_at": _pick(cfg.tag_start, shift),
            "slice_status": F.when(known, F.lit(None).cast("string"))
            .when(F.col("n_prefix") > 1, "multi_match")
            .otherwise("no_match"),
        }
    )
    fields = {
        "obs1": py_slice("seq1", starts[1], F.col("bc1_len")),
        "obs2": F.substr("seq1", F.col("bc2_start") + 1, F.lit(lens[2])),
        "obs3": reverse_complement(F.substring(i5_of(F.col("name1")), 1, cfg.i5_len)),
        "umi": py_slice("seq1", starts[0], lens[0]),
    }
    ok = F.col("slice_status").isNull()
    return out.withColumns({k: F.when(ok, v) for k, v in fields.items()}).drop(
        "n_prefix", "shift", "bc1_part"
    )


def slice_fixed(reads: DataFrame, cfg: AssayConfig) -> DataFrame:
    """Add obs1..obs3 and umi for the fixed layout, which sits on read 2."""
    names = ["umi", *OBS]
    cols = {
        n: py_slice("seq2", s, ln) for n, s, ln in zip(names, cfg.umi_bc_starts, cfg.umi_bc_len)
    }
    return reads.withColumns(
        {**cols, "slice_status": F.lit(None).cast("string"), "tag_at": F.lit(cfg.tag_start)}
    )


# ---- perfect triples and correction ---------------------------------------------------------

def systematic_sample(reads: DataFrame, n_reads: int = 1_000_000) -> DataFrame:
    """Every (skip+1)-th of the given reads in ordinal order, at most ``n_reads``; skip is rounded half to even.

    The reads are numbered first, as ordinals have gaps once reads were trimmed away.
    """
    total = reads.agg(F.count("*").cast("double").alias("total"))
    step = F.bround(total.scalar() / n_reads - 0.5).cast("bigint") + 1
    at = F.col("index") - 1
    chosen = global_index(reads, "ordinal").withColumn("_step", step).where(
        (at % F.col("_step") == 0) & (at < F.col("_step") * n_reads)
    )
    return reads.join(chosen.select("ordinal"), "ordinal", "left_semi")


def _exact_hits(sliced: DataFrame, whitelists: Sequence[DataFrame]) -> DataFrame:
    out = sliced
    for obs, wl in zip(OBS, whitelists):
        dim = wl.select(F.col("barcode").alias(obs)).distinct().withColumn(f"hit_{obs}", F.lit(True))
        out = out.join(dim, obs, "left")
    return out.withColumns({f"hit_{o}": F.coalesce(f"hit_{o}", F.lit(False)) for o in OBS})


def perfect_triples(sliced: DataFrame, whitelists: Sequence[DataFrame]) -> DataFrame:
    """(bc1, bc2, bc3, n): reads whose three barcodes are all exactly on the whitelists."""
    hits = _exact_hits(sliced, whitelists).where("hit_obs1 and hit_obs2 and hit_obs3")
    return hits.groupBy(*[F.col(o).alias(b) for o, b in zip(OBS, BCS)]).agg(F.count("*").alias("n"))


def perfect_rates(sliced: DataFrame, whitelists: Sequence[DataFrame]) -> DataFrame:
    """Share of reads with a perfect triple, each perfect barcode, and a known prefix."""
    hits = _exact_hits(sliced, whitelists)

    def rate(cond):
        return F.avg(cond.cast("double"))

    one, two, three = (F.col(f"hit_{o}") for o in OBS)
    return hits.agg(
        rate(one & two & three).alias("perfect_barcodes_all"),
        rate(one).alias("perfect_barcode1"),
        rate(two).alias("perfect_barcode2"),
        rate(three).alias("perfect_barcode3"),
        rate(F.col("slice_status").isNull()).alias("perfect_barcode1_part"),
    )


def correct_barcodes(
    sliced: DataFrame,
    whitelists: Sequence[DataFrame],
    maps: Sequence[DataFrame],
    triples: DataFrame | None = None,
) -> DataFrame:
    """Add status (perfect, correct, multi_match, no_match) and the corrected bc1..bc3.

    The reads are read once for their distinct triples, which are stored, and once for each side of the result.
    Imperfect triples get their candidates, which must be among ``triples`` or else the perfect triples of
    all reads. The few settled triples are joined to the imperfect reads only; perfect reads and reads without slices,
    which are most, pass by and are not shuffled.
    """
    hits = _exact_hits(sliced, whitelists)
    perfect = F.col("hit_obs1") & F.col("hit_obs2") & F.col("hit_obs3")
    hits = hits.withColumn("_perfect", perfect).drop(*[f"hit_{o}" for o in OBS])
    distinct = cut(hits.where("slice_status is null").select(*OBS, "_perfect").distinct())
    if triples is None:
        triples = distinct.where("_perfect").select(*[F.col(o).alias(b) for o, b in zip(OBS, BCS)])

    candidates = distinct.where("not _perfect").select(*OBS)
    for obs, bc, m in zip(OBS, BCS, maps):
        candidates = candidates.join(m.select(F.col("obs").alias(obs), F.col("barcode").alias(bc)), obs)
    fixed = (
        candidates.join(triples.select(*BCS), BCS, "left_semi")
        .groupBy(*OBS)
        .agg(F.count("*").alias("_n"), *[F.min(b).alias(f"_{b}") for b in BCS])
    )
    sought = ~F.col("_perfect") & F.col("slice_status").isNull()
    blank = {"_n": F.lit(None).cast("bigint"), **{f"_{b}": F.lit(None).cast("string") for b in BCS}}
    joined = hits.where(~sought).withColumns(blank).unionByName(hits.where(sought).join(fixed, list(OBS), "left"))
    one = F.col("_n") == 1
    status = (
        F.when(F.col("_perfect"), "perfect")
        .when(F.col("slice_status").isNotNull(), F.col("slice_status"))
        .when(one, "correct")
        .when(F.col("_n") > 1, "multi_match")
        .otherwise("no_match")
    )
    return joined.select(
        *sliced.columns,
        status.alias("status"),
        *[F.when(F.col("_perfect"), F.col(o)).when(one, F.col(f"_{b}")).alias(b) for o, b in zip(OBS, BCS)],
    )


# ---- modality tag and clipping --------------------------------------------------------------

def tag_of(cut: Column, cfg: AssayConfig) -> Column:
    """A (chromatin), R (RNA) or W (undetermined) by distance to the transposase tag."""
    near, far = cfg.tag_edit_dist
    exact = cut == F.lit(cfg.tag_seq)
    # A whole tag, the usual case, goes to the measure as null and is not measured.
    padded = F.when(~exact, F.rpad(cut, cfg.tag_length, "N"))
    d = F.when(exact, 0).otherwise(free_divergence(padded, F.lit(cfg.tag_seq)))
    return F.when(d <= near, "A").when(d >= far, "R").otherwise("W")


def tag_and_clip(corrected: DataFrame, cfg: AssayConfig, lib_id: str = "") -> DataFrame:
    """Valid reads with their tag, the barcoded read clipped, and the packed cell barcode.

    In the mixed-length layout read 1 is padded with N (quality with its last character) so that
    at least one base is left behind the tag.
    """
    seq, qual = ("seq1", "qual1") if cfg.shifted else ("seq2", "qual2")
    valid = corrected.where(F.col("status").isin("perfect", "correct"))
    if cfg.shifted:
        want = F.greatest(F.col("tag_at") + cfg.tag_length + 1, F.length(seq))
        last = F.substring(qual, -1, 1)
        more = want - F.length(seq)
        valid = valid.withColumns(
            {
                seq: F.concat(F.col(seq), F.repeat(F.lit("N"), more)),
                qual: F.concat(F.col(qual), F.repeat(last, more)),
            }
        )
    else:
        # The layout is only complete when every field had its full length.
        valid = valid.where(
            F.length(F.concat("bc1", "bc2", "bc3", "umi")) == F.lit(sum(cfg.umi_bc_len))
        )
    tagged = valid.withColumn("tag", tag_of(py_slice(seq, F.col("tag_at"), cfg.tag_length), cfg))
    cut_at = F.col("tag_at") + F.when(F.col("tag") == "R", 0).otherwise(cfg.tag_length)
    return tagged.withColumns(
        {
            seq: py_slice(seq, cut_at, F.length(seq)),
            qual: py_slice(qual, cut_at, F.length(qual)),
            "cell_barcode": F.concat(F.lit(lib_id), "bc1", "bc2", "bc3"),
        }
    )


def packed_name(name: str) -> Column:
    """FASTQ name that carries tag, cell and UMI: @{tag}_{cell}:{umi}:{original}."""
    original = F.regexp_replace(F.split_part(F.trim(name), F.lit(" "), F.lit(1)), "^@", "")
    return F.concat(F.lit("@"), "tag", F.lit("_"), "cell_barcode", F.lit(":"), "umi", F.lit(":"), original)


# ---- summaries ------------------------------------------------------------------------------

def status_counts(corrected: DataFrame) -> DataFrame:
    return corrected.groupBy("status").agg(F.count("*").alias("reads"))


def tag_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("tag").agg(F.count("*").alias("reads"))


def quality_summary(sliced: DataFrame, cfg: AssayConfig) -> DataFrame:
    """Mean share of bases at phred 30 or better per field, over all reads."""
    lens, starts = cfg.umi_bc_len, cfg.umi_bc_starts

    def mean(col):
        return F.avg(q30_fraction(col))

    if cfg.shifted:
        bc2_end = F.col("bc2_start") + lens[2]
        return sliced.agg(
            mean(py_slice("qual1", starts[0], lens[0])).alias("umi_q30"),
            mean(py_slice("qual1", starts[1], F.col("bc1_len"))).alias("bc1_q30"),
            mean(py_slice("qual1", F.col("bc2_start"), lens[2])).alias("bc2_q30"),
            F.lit(None).cast("double").alias("bc3_q30"),
            mean(py_slice("qual1", bc2_end, F.length("qual1"))).alias("r1_cdna_q30"),
            mean(F.col("qual2")).alias("r2_cdna_q30"),
        )
    fields = {
        f"{n}_q30": mean(py_slice("qual2", s, ln))
        for n, s, ln in zip(("umi", "bc1", "bc2", "bc3"), starts, lens)
    }
    tail = starts[3] + lens[3]
    return sliced.agg(
        *[c.alias(n) for n, c in fields.items()],
        mean(py_slice("qual2", tail, F.length("qual2"))).alias("r2_cdna_q30"),
        mean(F.col("qual1")).alias("r1_cdna_q30"),
    )


def run_stats(corrected: DataFrame, tagged: DataFrame) -> DataFrame:
    """(key, value) lines of a barcode run: read counts, valid share per tag, match classes."""
    # One row, used below both for its own lines and as the total of the tag shares.
    by_status = cut(
        corrected.agg(
            F.count("*").alias("fastq_reads"),
            *[
                F.count_if(F.col("status") == s).alias(s)
                for s in ("perfect", "correct", "multi_match", "no_match")
            ],
        )
    )
    by_tag = tagged.agg(
        F.count("*").alias("fastq_valid_barcode_reads"),
        *[F.count_if(F.col("tag") == t).alias(t) for t in "ARW"],
    )

    def long(df: DataFrame, keys: dict) -> DataFrame:
        pairs = [F.struct(F.lit(k).alias("key"), v.cast("double").alias("value")) for k, v in keys.items()]
        return df.select(F.inline(F.array(*pairs)))

    n = F.col("fastq_reads")
    status = long(
        by_status,
        {
            "fastq_reads": n,
            "--perfect_match": F.try_divide("perfect", n),
            "--correct_match": F.try_divide("correct", n),
            "multi_match": F.try_divide("multi_match", n),
            "no_match": F.try_divide("no_match", n),
        },
    )
    total = by_status.select("fastq_reads").scalar()
    tags = long(
        by_tag.withColumn("_all", total),
        {
            "fastq_valid_barcode_reads": F.col("fastq_valid_barcode_reads"),
            "--ATAC_valid_barcode_reads": F.col("A"),
            "--RNA_valid_barcode_reads": F.col("R"),
            "--Undetermined_valid_barcode_reads": F.col("W"),
            "fastq_valid_rate": F.try_divide("fastq_valid_barcode_reads", "_all"),
            "--ATAC_valid": F.try_divide("A", "_all"),
            "--RNA_valid": F.try_divide("R", "_all"),
            "--Undetermined_valid": F.try_divide("W", "_all"),
        },
    )
    return status.unionByName(tags)


# ---- samples --------------------------------------------------------------------------------

def with_sample(tagged: DataFrame, sample_bc: DataFrame) -> DataFrame:
    """Attach the sample of each read's round-2 barcode; null when it belongs to none."""
    return tagged.join(sample_bc.select(F.col("bc").alias("bc2"), "sample"), "bc2", "left")


def sample_shares(sampled: DataFrame, by: str = "sample") -> DataFrame:
    """Reads and share per sample (or per barcode), out of all reads."""
    n = sampled.groupBy(by).agg(F.count("*").alias("reads"))
    total = sampled.agg(F.count("*").alias("total"))
    return n.withColumn("share", F.try_divide(F.col("reads").cast("double"), total.scalar()))


def split_modalities(sampled: DataFrame, cfg: AssayConfig) -> DataFrame:
    """Reads of known samples without ATAC reads whose second mate is too short.

    The length limit counts the line end as one character.
    """
    short = (F.col("tag") == "A") & (F.length("seq2") + 1 < cfg.atac_mlen2)
    return sampled.where(F.col("sample").isNotNull() & ~short)


def zip_index_reads(r1: DataFrame, r2: DataFrame, r3: DataFrame) -> DataFrame:
    """Pair reads 1 and 3 of a four-file run and append the i5 sequence (read 2) to both names."""
    a = r1.select("ordinal", F.col("name").alias("name1"), F.col("seq").alias("seq1"), F.col("qual").alias("qual1"))
    i5 = r2.select("ordinal", F.trim("seq").alias("_i5"))
    b = r3.select("ordinal", F.col("name").alias("name2"), F.col("seq").alias("seq2"), F.col("qual").alias("qual2"))
    joined = a.join(i5, "ordinal").join(b, "ordinal")
    return joined.withColumns(
        {n: F.concat(F.trim(n), F.lit("+"), F.col("_i5")) for n in ("name1", "name2")}
    ).drop("_i5")
