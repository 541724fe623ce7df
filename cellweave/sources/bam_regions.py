"""Regions of coordinate-sorted BAM files by a stored index, so that only the blocks of those regions are read.

The index has a row per file, contig and window of 2^WINDOW bases: the places of the first and the last record that
overlap it. It is one pass over the files, a sum per window and a small Parquet table. A fetch joins the windows of the
regions with it and reads, in tasks, only the block ranges found.

Ranges are read by place, for which Spark has no reader: the files must be on a file system that pyarrow opens by URI
(local or mounted folders, HDFS with its native library, S3, GCS). Whole files (``alignments.read_bam``) need none.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.sources import bgzf
from cellweave.sources.alignments import BLOCKS, _Records, bam_blocks, bam_plan, read_blocks, with_alignment_columns
from cellweave.sources.splits import file_system, map_splits

WINDOW = 14
#: Windows whose blocks are read together: a megabase at most.
RUN = 64
_INDEX = "file bigint, chrom string, window bigint, first bigint, last bigint"


class _Places(_Records):
    """Window and place of a split's records. A place is (offset of the block in the file) << 16 | (offset in its data)."""

    def __init__(self, key, plan, at: int):
        super().__init__(key, plan)
        self.names = np.array([*self.contigs, "*"], object) if plan else None
        self.at, self.past, self.blocks = at, 0, []  # file offset of the next block; data bytes given up; (data offset, file offset)
        self.total = 0

    def feed(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(values), BLOCKS):
            for block in values.slice(at, BLOCKS):
                raw = block.as_py()
                if raw and self.plan:
                    self.blocks.append((self.total, self.at))
                    data = bgzf.unpack(raw)
                    self.total += len(data)
                    self.data += data
                self.at += len(raw) + len(bgzf.BLOCK_HEAD) if raw else 0
            if self.plan:
                yield from self.records(False)

    def records(self, rest: bool) -> Iterator[pa.RecordBatch]:
        if self.skip > len(self.data):
            return
        data = bytes(self.data)
        starts, end = bgzf.record_starts(data, self.skip)
        if starts:
            ref, low, high = bgzf.spans(data, starts)
            at = np.array(starts) + self.past
            begin, offset = np.array(self.blocks, np.int64).T
            block = np.searchsorted(begin, at, "right") - 1
            place = offset[block] << 16 | (at - begin[block])
            keep = ref >= 0
            ref, low, high, place = ref[keep], low[keep] >> WINDOW, (high[keep] - 1) >> WINDOW, place[keep]
            n = high - low + 1
            window = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(window), self.file)), pa.array(self.names[np.repeat(ref, n)], pa.string()), pa.array(window)]
                + [pa.array(np.repeat(place, n))] * 2,
                ["file", "chrom", "window", "first", "last"],
            )
        self.past += end
        self.blocks = self.blocks[max(0, sum(b <= self.past for b, _ in self.blocks) - 1) :]
        self.data, self.skip = bytearray(data[end:]), 0
        if rest and self.data:
            raise ValueError("a record's borders don't agree over two splits, or the file is cut short")


def index_bam(spark: SparkSession, path: str, out: str) -> None:
    """Write the index of coordinate-sorted BAM files as a Parquet table. Unsorted files are indexed too, but read wide."""
    blocks = bam_blocks(spark, path)
    name, size = F.col("_metadata.file_path"), F.octet_length("value")
    pieces = read_blocks(spark, path).select(name.alias("path"), F.col("_metadata.file_block_start").alias("start"), size.alias("size")).where("size > 0")
    sizes = pieces.groupBy("path", "start").agg(F.sum(F.col("size") + len(bgzf.BLOCK_HEAD)).alias("size"))
    offsets: dict[tuple[int, int], int] = {}
    paths: dict[int, str] = {}
    total = 0
    for row in sizes.withColumn("file", F.xxhash64("path")).orderBy("file", "start").toLocalIterator():  # a row per split
        total = total if row.file in paths else 0
        paths[row.file] = row.path
        offsets[row.file, row.start] = total
        total += row["size"]
    plan = {key: (skip, more, [n for n, _ in contigs]) for key, (skip, more, contigs) in bam_plan(spark, path).items()}
    shared = spark.sparkContext.broadcast((plan, offsets))
    places = map_splits(blocks, _INDEX, lambda key: _Places(key, shared.value[0].get(key), shared.value[1].get(key, 0)))
    windows = places.groupBy("file", "chrom", "window").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    names = spark.createDataFrame(list(paths.items()), "file bigint, path string")
    named = windows.join(F.broadcast(names), "file")  # a row per input file
    named.drop("file").repartitionByRange("chrom", "window").sortWithinPartitions("chrom", "window").write.mode("overwrite").parquet(out)


def _blocks_from(f, at: int) -> Iterator[tuple[int, bytes]]:
    """(offset, data) of the blocks from ``at`` on."""
    f.seek(at)
    while head := f.read(18):
        if head[:16] != bgzf.BLOCK_HEAD:
            raise ValueError("no block begins here: the index is of another file")
        raw = head[16:] + f.read(struct.unpack("<H", head[16:])[0] - 17)
        yield at, bgzf.unpack(raw)
        at += len(raw) + 16


def _range(f, contigs: list[str], first: int, last: int) -> Iterator[tuple[pa.RecordBatch, int]]:
    """The records from place ``first`` to ``last``, some blocks' at a time, and how many blocks were read for them."""
    data, past, skip, stop, n = bytearray(), 0, first & 0xFFFF, None, 0
    for at, block in _blocks_from(f, first >> 16):
        if at == last >> 16:
            stop = past + len(data) + (last & 0xFFFF)
        data += block
        n += 1
        if stop is None and n < BLOCKS:
            continue
        held = bytes(data)
        starts, end = bgzf.record_starts(held, skip)
        if starts:
            yield bgzf.decode(held, [s for s in starts if stop is None or past + s <= stop], contigs), n
            n = 0
        if stop is not None and past + end > stop:
            return
        data, past, skip = bytearray(held[end:]), past + end, 0
    raise ValueError("the last record of a range is missing: the index is of another file")


def fetch_reads(spark: SparkSession, index: str, regions: DataFrame, blocks_read=None) -> DataFrame:
    """The alignment table of the reads that overlap a window of ``regions`` (chrom, start, end), each read once.

    A join with the regions themselves stays to the caller. ``blocks_read``, an accumulator, adds up the blocks read.
    A range begins at its first window's first record; reads that also overlap an earlier range belong to that one.
    Ranges are dealt to as many tasks as the session shuffles to, and read some blocks at a time: what a task holds does
    not grow with the depth of its ranges.
    """
    last = F.shiftright(F.greatest("end", F.col("start") + 1) - 1, WINDOW)
    wanted = regions.select("chrom", F.explode(F.sequence(F.shiftright(F.greatest("start", F.lit(0)), WINDOW), last)).alias("window"))
    found = spark.read.parquet(index).join(wanted.distinct(), ["chrom", "window"])
    order = Window.partitionBy("path", "chrom").orderBy("window")
    before = F.lag("window").over(order)
    new = before.isNull() | (before < F.col("window") - 1) | (F.col("window") % RUN == 0)
    runs = found.withColumn("before", F.coalesce(before, F.lit(-1))).withColumn("run", F.sum(new.cast("long")).over(order))
    ranges = runs.groupBy("path", "chrom", "run").agg(
        F.min("before").alias("before"), F.min("window").alias("low"), F.max("window").alias("high"), F.min("first").alias("first"), F.max("last").alias("last")
    )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contigs: dict[str, list[str]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                system, path = file_system(row["path"])
                with system.open_input_file(path) as f:
                    if row["path"] not in contigs:
                        head = b""
                        for _, data in _blocks_from(f, 0):
                            head += data
                            if bgzf.header_end(head) is not None:
                                break
                        contigs[row["path"]] = [n for n, _ in bgzf.references(head)]
                    for records, n in _range(f, contigs[row["path"]], row["first"], row["last"]):
                        if blocks_read is not None:
                            blocks_read.add(n)
                        begin = records.column("pos").to_numpy()
                        end = begin + np.maximum(bgzf.cigar_spans(records.column("cigar").to_pylist()), 1)
                        mine = (begin >> WINDOW > row["before"]) & (begin >> WINDOW <= row["high"]) & ((end - 1) >> WINDOW >= row["low"])
                        same = np.array([c == row["chrom"] for c in records.column("reference_name").to_pylist()], bool)
                        yield records.filter(pa.array(mine & same))

    # Ranges are a few numbers each, so their size says nothing about the work: the number of tasks is named.
    spread = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "chrom", "run")
    return with_alignment_columns(spread.mapInArrow(read, bgzf.RECORD_SCHEMA))
