"""SAM text and BAM readers to the alignment table."""

from __future__ import annotations

import glob
import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cellweave.sources import bgzf
from cellweave.sources.splits import map_splits, notes_of, split_rows

# Fixed values of the SAM format: bit of each flag.
FLAG_BITS = {
    "is_proper_pair": 2,
    "is_unmapped": 4,
    "mate_is_unmapped": 8,
    "is_reverse": 16,
    "is_read1": 64,
    "is_read2": 128,
    "is_secondary": 256,
}
#: Blocks that are decoded at a time, and bytes of a stream without blocks.
BLOCKS, STREAM = 32, 1 << 21

def cigar_blocks(pos: Column, cigar: Column) -> Column:
    """Half-open aligned blocks; deletions and skips leave gaps, insertions and clips take no room."""
    sizes = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1))
    ops = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2))
    block = "array<struct<start:bigint,end:bigint>>"
    start = F.struct(pos.cast("bigint").alias("at"), F.array().cast(block).alias("blocks"))

    def step(acc, item):
        size = item["size"].cast("bigint")
        op = item["op"]
        after = acc["at"] + F.when(op.isin("M", "=", "X", "D", "N"), size).otherwise(F.lit(0))
        piece = F.array(F.struct(acc["at"].alias("start"), (acc["at"] + size).alias("end")))
        blocks = F.when(op.isin("M", "=", "X"), F.concat(acc["blocks"], piece)).otherwise(acc["blocks"])
        return F.struct(after.alias("at"), blocks.alias("blocks"))

    zipped = F.zip_with(sizes, ops, lambda s, o: F.struct(s.alias("size"), o.alias("op")))
    return F.aggregate(zipped, start, step)["blocks"]


def with_alignment_columns(raw: DataFrame) -> DataFrame:
    """Decode flags, barcode and blocks of raw alignment fields."""
    from cellweave.functions.seq import cell_from_qname, genome_from_contig, umi_from_qname

    flags = {n: F.col("flag").bitwiseAND(b) != 0 for n, b in FLAG_BITS.items()}
    blocks = cigar_blocks(F.col("pos"), F.col("cigar"))
    return raw.withColumns(flags).withColumns(
        {
            "chrom": F.col("reference_name"),
            "genome": genome_from_contig("reference_name"),
            "strand": F.when(F.col("is_reverse"), "-").otherwise("+"),
            "cell_barcode": cell_from_qname("qname"),
            "umi": umi_from_qname("qname"),
            "blocks": blocks,
            "read_end": F.coalesce(F.try_element_at(blocks, F.lit(-1))["end"], F.col("pos") + 1),
        }
    )


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """SAM text, split across tasks like any text; header lines are skipped."""
    items = F.split("value", "\t")
    body = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != ""))
    mate = F.get(items, 6)
    raw = body.select(
        F.get(items, 0).alias("qname"),
        F.get(items, 1).cast("int").alias("flag"),
        F.get(items, 2).alias("reference_name"),
        (F.get(items, 3).cast("bigint") - 1).alias("pos"),
        F.get(items, 4).cast("int").alias("mapq"),
        F.get(items, 5).alias("cigar"),
        F.when(mate == "=", F.get(items, 2)).otherwise(mate).alias("mate_reference_name"),
        (F.get(items, 7).cast("bigint") - 1).alias("mate_pos"),
        F.get(items, 8).cast("bigint").alias("tlen"),
        F.get(items, 9).alias("seq"),
        F.get(items, 10).alias("qual"),
        F.array_join(F.slice(items, 12, 10_000), "\t").alias("tags"),
    )
    return with_alignment_columns(raw)


def header_sort_order(spark: SparkSession, path: str) -> DataFrame:
    """Sort order named in a SAM header: queryname, coordinate or unsorted."""
    head = spark.read.text(path).where(F.col("value").startswith("@HD"))
    return head.select(F.coalesce(F.nullif(F.regexp_extract("value", r"SO:(\w+)", 1), F.lit("")), F.lit("unsorted")).alias("sort_order"))


# ---- BAM ---------------------------------------------------------------------------------------

def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The compressed blocks of BAM files as text that never was: the sixteen bytes that begin each block divide them.

    So Spark's text source splits the files. Each row is a block without these bytes; a file's first one is empty.
    """
    return spark.read.options(lineSep=bgzf.BLOCK_HEAD.decode("latin-1"), encoding="ISO-8859-1").text(path)


def bam_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value): the compressed blocks of BAM files, each without its head, in file order within a split."""
    return split_rows(read_blocks(spark, path)).select("file", "start", F.col("value").cast("binary").alias("value"))


class _Blocks:
    """The data of one split's blocks."""

    def __init__(self, key: tuple[int, int]):
        self.file, self.start = key
        self.data, self.first = bytearray(), True

    def take(self, values: pa.Array) -> None:
        for block in values:
            raw = block.as_py()
            if raw:
                self.data += bgzf.unpack(raw)
            elif not self.first:
                raise ValueError("an empty block")
            self.first = False


class _Head(_Blocks):
    """Notes what comes before a split's first record, and whether it holds one; the file's first split has the header."""

    found = None

    def search(self, whole: bool) -> None:
        if self.found is None:
            data = bytes(self.data)
            self.found = bgzf.header_end(data) if self.start == 0 and len(data) >= 12 else bgzf.first_record(data, whole) if self.start else None

    def feed(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        if self.found is None:
            self.take(values)
            self.search(False)
        return iter(())

    def close(self) -> Iterator[pa.RecordBatch]:
        self.search(True)
        head = bytes(self.data) if self.found is None else bytes(self.data[: self.found])
        names = ["file", "start", "head", "found"]
        yield pa.RecordBatch.from_pydict(dict(zip(names, ([self.file], [self.start], [head], [self.found is not None]), strict=True)))


class _Records(_Blocks):
    """The records that begin in a split; the last one ends with bytes of the splits behind it."""

    def __init__(self, key: tuple[int, int], plan: tuple[int, bytes, list[str]] | None):
        super().__init__(key)
        self.plan = plan
        if plan:
            self.skip, self.more, self.contigs = plan

    def records(self, rest: bool) -> Iterator[pa.RecordBatch]:
        if self.skip > len(self.data):
            return
        data = bytes(self.data)
        starts, at = bgzf.record_starts(data, self.skip)
        if starts:
            yield bgzf.decode(data, starts, self.contigs)
        self.data, self.skip = bytearray(data[at:]), 0
        if rest and self.data:
            raise ValueError("a record's borders don't agree over two splits, or the file is cut short")

    def feed(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        if not self.plan:
            return
        for at in range(0, len(values), BLOCKS):
            self.take(values.slice(at, BLOCKS))
            yield from self.records(False)

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.plan:
            self.data += self.more
            yield from self.records(True)


def bam_plan(spark: SparkSession, path: str) -> dict[tuple[int, int], tuple[int, bytes, list[tuple[str, int]]]]:
    """(file, start): (bytes before its first record, bytes of its last record in later splits, contigs) per split with records."""
    notes = notes_of(map_splits(bam_blocks(spark, path), "file bigint, start bigint, head binary, found boolean", _Head))
    plan = {}
    for file, splits in notes.items():
        held = []  # (start, bytes to skip, pieces of later splits)
        for start, (head, found) in splits.items():
            if held:
                held[-1][2].append(bytes(head))
            if found or not held:
                held.append((start, len(head), []))
        # A header may run over several splits; those before its end then hold no record of their own.
        start, _, pieces = held[0]
        whole = bytes(splits[start][0]) + b"".join(pieces)
        skip = bgzf.header_end(whole)
        if skip is None:
            raise ValueError("a BAM file ends within its header")
        held[0] = (start, skip, pieces)
        contigs = bgzf.references(whole)
        plan |= {(file, start): (skip, b"".join(pieces), contigs) for start, skip, pieces in held}
    return plan


class _BamFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class BamReader(DataSourceReader):
    """BAM files of any other gzip framing, one task each: a stream without block heads has no place to start from."""

    def __init__(self, pattern: str):
        self.pattern = pattern

    def partitions(self):
        paths = sorted(glob.glob(self.pattern))
        if not paths:
            raise FileNotFoundError(self.pattern)
        return [_BamFile(p) for p in paths]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        # A series of gzip members, which gzip reads as one stream.
        with gzip.open(partition.path, "rb") as f:
            held = f.read(STREAM)
            while (skip := bgzf.header_end(held)) is None:
                more = f.read(STREAM)
                if not more:
                    raise ValueError(f"a BAM file ends within its header: {partition.path}")
                held += more
            contigs = [n for n, _ in bgzf.references(held)]
            while held:
                starts, at = bgzf.record_starts(held, skip)
                if starts:
                    yield bgzf.decode(held, starts, contigs)
                more = f.read(STREAM)
                if not more and at < len(held):
                    raise ValueError(f"a BAM file is cut short: {partition.path}")
                held, skip = held[at:] + more, 0


class BamSource(DataSource):
    @classmethod
    def name(cls):
        return "bam"

    def schema(self):
        return bgzf.RECORD_SCHEMA

    def reader(self, schema):
        return BamReader(self.options["path"])


def has_blocks(spark: SparkSession, path: str) -> bool:
    """Whether the files begin with a block head; looks at the first piece of a file."""
    row = bam_blocks(spark, path).where("start = 0").first()
    return row is not None and not row.value


def read_bam(spark: SparkSession, path: str) -> DataFrame:
    """The alignment table of BAM files: fields of the SAM text, positions from 0, decoded flags and aligned blocks.

    Files are cut into splits like any text (``spark.sql.files.maxPartitionBytes``). A first pass finds each split's
    first record by its form and CHAIN records that follow; the second decodes what begins in the split and closes its
    last record with the bytes before the next split's first. Both must meet to the byte, so a wrong start raises an
    error instead of giving other rows. Files with other gzip framing are read by one task each, from a path that
    executors see.
    """
    if not has_blocks(spark, path):
        spark.dataSource.register(BamSource)
        return with_alignment_columns(spark.read.format("bam").load(path))
    plan = spark.sparkContext.broadcast(
        {key: (skip, more, [n for n, _ in contigs]) for key, (skip, more, contigs) in bam_plan(spark, path).items()}
    )
    raw = map_splits(bam_blocks(spark, path), bgzf.RECORD_SCHEMA, lambda key: _Records(key, plan.value.get(key)))
    return with_alignment_columns(raw)


def bam_contigs(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, size) of the headers of BAM files, in the order of the first."""
    sizes: dict[str, int] = {}
    for _, _, contigs in bam_plan(spark, path).values():
        sizes |= {n: size for n, size in contigs if n not in sizes}
    return spark.createDataFrame(list(sizes.items()), "chrom string, size bigint")
