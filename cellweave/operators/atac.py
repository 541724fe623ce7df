"""Chromatin accessibility: TSS enrichment, fragment sizes, cell filters, region counts."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cellweave.lineage import cut
from cellweave.operators.intervals import bin_of, overlap_join, point_join
from cellweave.operators.quantiles import exact_quantiles

FLANK = 2000  # bases kept on each side of a TSS
SMOOTH = 50
LONG = 8192  # bases of the longest region that meets its fragments in one bin
TASK_PAIRS = 1 << 22  # pairs of a bin that a task of ``count_regions`` looks through
CHUNK = 14  # bits of the places of TSS that are packed together
CELLS, ROWS, MANY = 128, 1 << 13, 64  # cells and rows that are counted at a time; TSS from which an end is counted by itself


def qc_reads(reads: DataFrame) -> DataFrame:
    """Mapped forward reads with mapq 30 or better."""
    return reads.where(~F.col("is_unmapped") & (F.col("mapq") >= 30) & ~F.col("is_reverse"))


def reads_per_cell(reads: DataFrame) -> DataFrame:
    return qc_reads(reads).groupBy("cell_barcode").agg(F.count("*").alias("umi"))


def tss_regions(tss: DataFrame) -> DataFrame:
    """(chrom, start, end): what ``tss_pairs`` looks at around each TSS."""
    middle = F.floor((F.col("start") + F.col("end")) / 2).cast("bigint")
    return tss.select(
        "chrom", F.greatest(F.lit(0), middle - 2 * FLANK).cast("bigint").alias("start"), (middle + 2 * FLANK).alias("end")
    )


def tss_pairs(reads: DataFrame, tss: DataFrame) -> DataFrame:
    """(cell_barcode, left, right): offsets of both fragment ends from the window start of a TSS.

    A read meets a TSS when it lies within twice the flank; an end outside the window itself, or
    of a fragment of 1000 bases or more, gives null. A read counts once per TSS it meets.
    """
    middle = F.floor((F.col("start") + F.col("end")) / 2).cast("bigint")
    centres = tss.select("chrom", middle.alias("tss"))
    spans = centres.withColumns(
        {
            "w_start": F.greatest(F.lit(0), F.col("tss") - 2 * FLANK).cast("bigint"),
            "w_end": F.col("tss") + 2 * FLANK,
        }
    )
    good = qc_reads(reads)
    width = 4 * FLANK
    if "read_end" in reads.columns:
        good = good.select("chrom", "cell_barcode", "pos", "tlen", "read_end")
        met = overlap_join(good, spans, ["chrom"], ("pos", "read_end"), ("w_start", "w_end"), width)
    else:
        good = good.select("chrom", "cell_barcode", "pos", "tlen")
        met = point_join(good, spans, ["chrom"], "pos", ("w_start", "w_end"), width)
    size = F.abs(F.col("tlen"))
    begin = F.col("tss") - FLANK

    def offset(end: Column) -> Column:
        inside = (end >= begin) & (end < F.col("tss") + FLANK - 1) & (size - 9 < 1000)
        return F.when(inside, end - begin)

    return met.select(
        "cell_barcode",
        offset(F.col("pos") + 4).alias("left"),
        offset(F.col("pos") + size - 5).alias("right"),
    )


def insertion_histogram(pairs: DataFrame) -> DataFrame:
    """Tn5 insertions per cell and offset, in long form."""
    ends = pairs.select("cell_barcode", F.explode(F.array("left", "right")).alias("offset"))
    return ends.where("offset is not null").groupBy("cell_barcode", "offset").agg(F.count("*").alias("n"))


def tss_insertions(reads: DataFrame, tss: DataFrame, by: Sequence[str] = ("cell_barcode",)) -> DataFrame:
    """(*by, offset, n): what ``insertion_histogram`` counts over ``tss_pairs``, without a row per read and TSS.

    Equal ends and equal TSS are counted before they meet, so an end meets at most one row per base of the window,
    however many TSS and reads there are. With ``by`` the ends of a group go to one task, which has all TSS, and are
    counted there: no row per end and TSS, or per offset, is shuffled.
    """
    at = F.floor((F.col("start") + F.col("end")) / 2).cast("bigint")
    centres = tss.select("chrom", at.alias("tss")).where(F.col("tss") > -2 * FLANK).groupBy("chrom", "tss").agg(F.count("*").alias("_m"))
    size = F.abs(F.col("tlen"))
    good = qc_reads(reads).where(size - 9 < 1000)
    if "read_end" in reads.columns:
        good = good.where((F.col("pos") < F.col("read_end")) & (F.col("read_end") > 0))
    else:
        good = good.where(F.col("pos") >= 0)
    ends = good.select("chrom", *by, F.explode(F.array(F.col("pos") + 4, F.col("pos") + size - 5)).alias("_at"))
    if by:
        return _insertions_by(ends, centres, by)
    spans = centres.select("chrom", "_m", (F.col("tss") - FLANK).alias("w_start"), (F.col("tss") + FLANK - 1).alias("w_end"))
    ends = ends.groupBy("chrom", "_at").agg(F.count("*").alias("_n"))
    met = point_join(ends, spans, ["chrom"], "_at", ("w_start", "w_end"), 2 * FLANK)
    return met.groupBy((F.col("_at") - F.col("w_start")).alias("offset")).agg(F.sum(F.col("_n") * F.col("_m")).alias("n"))


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chrom, TSS and how often each stands) to (chrom, bytes): steps from TSS to TSS, and the numbers."""
    for batch in batches:
        of, data = batch.column("_all"), []
        bounds, flat = of.offsets.to_numpy(), of.values
        tss, m = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("tss", "_m"))
        for a, b in zip(bounds, bounds[1:], strict=False):
            order = np.argsort(tss[a:b])
            data.append(zlib.compress(np.diff(tss[a:b][order], prepend=0).tobytes() + m[a:b][order].tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column("chrom"), pa.array(data, pa.binary())], ["chrom", "_data"])


class _Centres:
    """The TSS of all contigs: 16 bytes each."""

    def __init__(self, packed: list[tuple[str, bytes]]):
        parts: dict[str, list[np.ndarray]] = {}
        for chrom, data in packed:
            steps, m = np.frombuffer(zlib.decompress(data), np.int64).reshape(2, -1)
            parts.setdefault(chrom, []).append(np.stack([np.cumsum(steps), m]))
        none = [np.zeros((2, 0), np.int64)]
        self.bounds: dict[str, tuple[int, int]] = {}
        joined, at = none, 0
        for chrom in parts:
            own = np.concatenate(sorted(parts[chrom], key=lambda x: x[0, 0]), axis=1)
            self.bounds[chrom] = (at, at + own.shape[1])
            joined, at = [*joined, own], at + own.shape[1]
        self.tss, self.m = np.concatenate(joined, axis=1)

    def near(self, chroms: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past the last TSS whose windows hold each place."""
        codes = chroms.dictionary_encode()
        number, first, past = codes.indices.to_numpy(zero_copy_only=False), np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for i, chrom in enumerate(codes.dictionary.to_pylist()):
            a, b = self.bounds.get(chrom, (0, 0))
            here = np.flatnonzero(number == i)
            first[here] = a + np.searchsorted(self.tss[a:b], at[here] - FLANK + 2)
            past[here] = a + np.searchsorted(self.tss[a:b], at[here] + FLANK, "right")
        return first, past

    def add(self, sums: np.ndarray, cell: np.ndarray, at: np.ndarray, n: np.ndarray, first: np.ndarray, past: np.ndarray) -> None:
        """Count ``n`` at each end's offsets in its cell's row of ``sums``."""
        met = past - first
        for i in np.flatnonzero(met >= MANY):
            near = slice(first[i], past[i])
            sums[cell[i]][at[i] + FLANK - self.tss[near]] += n[i] * self.m[near]  # no TSS stands twice, so no offset does
        few = np.flatnonzero((met > 0) & (met < MANY))
        met = met[few]
        end = np.repeat(few, met)
        near = np.arange(len(end)) + np.repeat(first[few] - (np.cumsum(met) - met), met)
        np.add.at(sums, (cell[end], at[end] + FLANK - self.tss[near]), n[end] * self.m[near])


def _changes(columns: Iterable[pa.Array], n: int) -> np.ndarray:
    """Which of the ``n`` rows differ from the row before; the first one does."""
    new = np.zeros(n, bool)
    new[:1] = True
    for column in columns:
        codes = pc.dictionary_encode(column, null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return new


def _insertions_by(ends: DataFrame, centres: DataFrame, by: Sequence[str]) -> DataFrame:
    """(*by, offset, n) of ``ends`` (chrom, *by, _at) around ``centres`` (chrom, tss, _m).

    Ends are dealt by group; the TSS go packed to each task, ahead of them. Sorted ends pass by and a few groups'
    counts are held at a time, so a task holds the TSS and no more, however many groups and ends it has.
    """
    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = centres.where(F.col("chrom").isNotNull()).groupBy("chrom", F.shiftright("tss", CHUNK).alias("_chunk")).agg(F.collect_list(F.struct("tss", "_m")).alias("_all"))
    packed = lists.select("chrom", "_all").mapInArrow(_packed, "chrom string, _data binary")
    marks = packed.withColumn("_task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    rows = ends.where(F.col("chrom").isNotNull() & F.col("_at").isNotNull()).withColumn("_task", F.pmod(F.xxhash64(*by), F.lit(tasks)).cast("int"))
    dealt = rows.unionByName(marks, allowMissingColumns=True).repartitionById(tasks, "_task").drop("_task")
    dealt = dealt.sortWithinPartitions(F.col("_data").isNull(), *by, "chrom", "_at")
    names = [*by, "offset", "n"]

    def out(groups: list[pa.Array], sums: np.ndarray) -> pa.RecordBatch:
        row, offset = np.nonzero(sums)
        return pa.RecordBatch.from_arrays([*[c.take(pa.array(row)) for c in groups], pa.array(offset), pa.array(sums[row, offset])], names)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, centres, held, last = [], None, None, None  # the group under way: its row of ``by`` and its counts
        for batch in batches:
            ahead = batch.num_rows - batch.column("_data").null_count
            marks += zip(batch.column("chrom")[:ahead].to_pylist(), batch.column("_data")[:ahead].to_pylist(), strict=True)
            if ahead == batch.num_rows:
                continue
            if centres is None:
                centres, marks = _Centres(marks), []
            batch = batch.slice(ahead)
            group = _changes([batch.column(c) for c in by], batch.num_rows)
            new = group | _changes([batch.column("chrom"), batch.column("_at")], batch.num_rows)
            # Equal ends of a group stand together: a row for each, and how many there are.
            begin = np.flatnonzero(new)
            n = np.diff(begin, append=batch.num_rows)
            number = np.cumsum(group)[begin] - 1
            batch = batch.take(pa.array(begin))
            at = batch.column("_at").to_numpy()
            first, past = centres.near(batch.column("chrom"), at)
            a = 0
            while a < len(at):
                b = min(a + ROWS, int(np.searchsorted(number, number[a] + CELLS)))
                part, own = slice(a, b), number[a:b] - number[a]
                sums = np.zeros((own[-1] + 1, 2 * FLANK - 1), np.int64)
                centres.add(sums, own, at[part], n[part], first[part], past[part])
                rows = pa.array(a + np.flatnonzero(np.diff(own, prepend=-1)))
                groups = [batch.column(c).take(rows) for c in by]
                if held is not None and all(x[0].as_py() == y[0].as_py() for x, y in zip(held, groups, strict=True)):
                    sums[0] += last
                elif held is not None:
                    yield out(held, last[None])
                yield out([c[:-1] for c in groups], sums[:-1])
                held, last, a = [c[-1:] for c in groups], sums[-1].copy(), b
        if held is not None:
            yield out(held, last[None])

    fields = [*[StructField(c, ends.schema[c].dataType) for c in by], StructField("offset", LongType()), StructField("n", LongType())]
    return dealt.mapInArrow(count, StructType(fields))


def tss_scores(reads: DataFrame, tss: DataFrame) -> DataFrame:
    """(cell_barcode, umi, tss_score): smoothed centre over mean flank insertions.

    Only two sums per cell are needed, so no per-offset table is built. With an empty flank the
    score is infinite when the centre holds insertions and null otherwise.
    """

    def hits(inside) -> Column:
        return sum(
            F.sum(F.when(inside(F.col(c)), 1).otherwise(0)) for c in ("left", "right")
        ).cast("double")

    half = SMOOTH // 2
    centre = hits(lambda o: o.between(FLANK - half, FLANK + half - 1)) / SMOOTH
    flank = hits(lambda o: (o < 100) | (o >= 2 * FLANK - 100)) / 200
    per = tss_pairs(reads, tss).groupBy("cell_barcode").agg(centre.alias("_c"), flank.alias("_f"))
    score = F.when(F.col("_f") > 0, F.try_divide("_c", "_f")).when(
        F.col("_c") > 0, F.lit(float("inf"))
    )
    return per.join(reads_per_cell(reads), "cell_barcode").select(
        "cell_barcode", "umi", score.alias("tss_score")
    )


def tss_profile(spark: SparkSession, histogram: DataFrame) -> DataFrame:
    """Insertions of all cells per offset, scaled by the flank mean, raw and smoothed.

    The grid has 4000 rows whatever the data size; its windows run on the aggregated profile.
    """
    per = histogram.groupBy("offset").agg(F.sum("n").alias("n"))
    grid = spark.range(2 * FLANK).withColumnRenamed("id", "offset").join(per, "offset", "left")
    n = F.coalesce("n", F.lit(0)).cast("double")
    outer = (F.col("offset") < 100) | (F.col("offset") >= 2 * FLANK - 100)
    flank = F.sum(F.when(outer, n)).over(Window.partitionBy()) / 200
    moving = Window.orderBy("offset").rowsBetween(-(SMOOTH // 2), SMOOTH // 2 - 1)
    scaled = F.try_divide(n, F.col("_f"))
    return grid.withColumn("_f", flank).select(
        "offset",
        n.cast("bigint").alias("n"),
        scaled.alias("enrichment"),
        F.try_divide(F.sum(n).over(moving) / SMOOTH, F.col("_f")).alias("smoothed"),
    )


def fragment_lengths(reads: DataFrame, limit: int = 1000) -> DataFrame:
    """Reads and share per template length below ``limit``."""
    n = qc_reads(reads).where(F.col("tlen") < limit).groupBy("tlen").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def filter_cells(scores: DataFrame, cut_umi: float = 100, cut_tss: float = 4) -> DataFrame:
    """Cells that reach both cutoffs. An infinite score passes; null and NaN do not."""
    s = F.col("tss_score")
    return scores.where((F.col("umi") >= cut_umi) & ~F.isnan(s) & (s >= cut_tss))


def filter_reads_by_cells(reads: DataFrame, cells: DataFrame) -> DataFrame:
    return reads.join(cells.select("cell_barcode"), "cell_barcode", "left_semi")


def qc_medians(scores: DataFrame, cut_umi: float = 100, cut_tss: float = 4) -> DataFrame:
    """Cells and exact medians before and after the cell filter."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("stage"), "umi", "tss_score")

    kept = filter_cells(scores, cut_umi, cut_tss)
    both = cut(side(scores, "total").unionByName(side(kept, "filtered")))
    stages = scores.sparkSession.createDataFrame([("total",), ("filtered",)], "stage string")
    medians = exact_quantiles(both, {"median_umi": ("umi", 0.5), "median_tss": ("tss_score", 0.5)}, ["stage"])
    sizes = both.groupBy("stage").agg(F.count("*").alias("cells"))
    # A stage without cells has a row too.
    out = stages.join(sizes, "stage", "left").join(medians, "stage", "left")
    return out.select(F.coalesce("cells", F.lit(0)).alias("cells"), "median_umi", "median_tss", "stage")


# ---- regions --------------------------------------------------------------------------------

def extend_summits(summits: DataFrame, size: int = 500) -> DataFrame:
    """Widen 1-base summits to about ``size`` bases, clipped at 0; the name loses its path."""
    half = size / 2

    def toward_zero(c: Column) -> Column:
        return F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)).cast("bigint")

    return summits.select(
        "chrom",
        F.greatest(F.lit(0), toward_zero(F.col("start") - F.lit(half))).cast("bigint").alias("start"),
        toward_zero(F.col("end") + F.lit(half - 1)).alias("end"),
        F.element_at(F.split("name", "/"), -1).alias("name"),
        "val",
        F.lit(".").alias("strand"),
    )


def shifted_fragments(reads: DataFrame) -> DataFrame:
    """Fragments as intervals with the usual +4/-5 transposase shift at their ends."""
    size = F.abs(F.col("tlen"))
    return qc_reads(reads).select(
        "chrom",
        (F.col("pos") + 4).alias("frag_start"),
        (F.col("pos") + size - 5).alias("frag_end"),
        "cell_barcode",
    )


def region_name() -> Column:
    return F.concat(
        "chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string")
    )


def _region_pairs(frags: DataFrame, spots: DataFrame, reach: int, width: int) -> DataFrame:
    """Pairs of ``frags`` and ``spots`` no longer than ``reach``, with ``_bin``: the one bin where a spot starts.

    Both sides are cut into as many tasks as their pairs need, and all pairs of a spot are in one of them.
    """
    start = F.explode(F.sequence(bin_of(F.col("frag_start") - reach + 1, width), bin_of(F.col("frag_end") - 1, width)))
    a = frags.withColumn("_bin", start)
    b = spots.withColumn("_bin", bin_of(F.col("start"), width))
    key = ["chrom", "_bin"]
    sizes = a.groupBy(*key).agg(F.count("*").alias("_a")).join(b.groupBy(*key).agg(F.count("*").alias("_b")), key)
    # One number: pairs that share a bin.
    pairs = sizes.agg(F.sum(F.col("_a").cast("double") * F.col("_b"))).first()[0] or 0
    tasks = 1 + int(pairs / TASK_PAIRS)
    met = a.repartition(tasks, *key).join(b.repartition(tasks, *key), key)
    return met.where((F.col("frag_start") < F.col("end")) & (F.col("start") < F.col("frag_end")))


def count_regions(
    regions: DataFrame, fragments: DataFrame, binary: bool = False, width: int = 2048
) -> DataFrame:
    """(peak, cell_barcode, value): fragments of each cell overlapping each region.

    Fits windows, promoters and peaks alike; the result stays in coordinate form. Equal fragments of a cell and equal
    regions are counted before they meet. A region of up to ``LONG`` bases meets its fragments in the bin of its start,
    so its pairs are counted where they arise and are not shuffled; longer ones are cut into bins.
    """
    span = ["chrom", "start", "end"]
    frags = fragments.where("frag_start < frag_end").groupBy("chrom", "frag_start", "frag_end", "cell_barcode").agg(F.count("*").alias("_n"))
    frags = cut(frags)
    spots = cut(regions.where(F.col("start") < F.col("end")).groupBy(*span).agg(F.count("*").alias("_m")))
    size = F.col("end") - F.col("start")
    longest = spots.agg(F.max(F.when(size <= LONG, size)).alias("near"), F.max(size).alias("all")).first()
    value = F.sum(F.col("_n") * F.col("_m")).alias("value")
    reach = longest["near"] or 0
    near = _region_pairs(frags, spots.where(size <= LONG), reach, width).groupBy("_bin", *span, "cell_barcode")
    out = near.agg(value).drop("_bin")
    if (longest["all"] or 0) > LONG:
        far = overlap_join(frags, spots.where(size > LONG), ["chrom"], ("frag_start", "frag_end"), ("start", "end"), max(width, LONG))
        out = out.unionByName(far.groupBy(*span, "cell_barcode").agg(value))
    value = F.lit(1).cast("bigint") if binary else F.col("value")
    return out.select(region_name().alias("peak"), "cell_barcode", value.alias("value"))
