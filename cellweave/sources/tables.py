"""Readers for the small text tables, annotation files and tool outputs. Schemas are explicit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.sources.splits import map_splits, notes_of, split_rows

GTF_SCHEMA = (
    "Chromosome string, Source string, Feature string, Start bigint, End bigint, "
    "Score string, Strand string, Frame string, Attributes string"
)
PILEUP_SCHEMA = "chrom string, pos bigint, ref string, depth int, match string, qual string, names string"
MOLECULE_SCHEMA = (
    "cell_barcode string, genome string, gene string, gene_name string, umi string, counts bigint, exonic boolean"
)
LINK_SCHEMA = (
    "row string, peak_index string, mi double, zscore double, pval double, gene_id string, gene_name string, "
    "tss bigint, pval_adj double, accept string, peak string"
)


def _words(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines split at white space, in file order."""
    lines = spark.read.text(path).withColumn("ordinal", F.monotonically_increasing_id())
    trimmed = F.trim(F.regexp_replace("value", r"\s+", " "))
    return lines.select("ordinal", F.split(trimmed, " ").alias("w")).where(F.col("w")[0] != "")


def read_raw_list(spark: SparkSession, path: str) -> DataFrame:
    """library, lib_id, fq1, fq2 per line."""
    names = ("library", "lib_id", "fq1", "fq2")
    return _words(spark, path).select("ordinal", *[F.get("w", i).alias(n) for i, n in enumerate(names)])


def read_first_words(spark: SparkSession, path: str) -> DataFrame:
    return _words(spark, path).select("ordinal", F.col("w")[0].alias("name"))


def read_sample_barcodes(spark: SparkSession, path: str) -> DataFrame:
    """(sample, bc); the last line wins when a barcode repeats."""
    return (
        _words(spark, path)
        .groupBy(F.get("w", 1).alias("bc"))
        .agg(F.max_by(F.get("w", 0), "ordinal").alias("sample"))
    )


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """(id, barcode) of a tab-separated whitelist."""
    return spark.read.schema("id string, barcode string").option("sep", "\t").csv(path)


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    return _words(spark, path).select(F.get("w", 0).alias("barcode"), F.get("w", 1).alias("label"))


def read_genome_sizes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("chrom string, size bigint").option("sep", "\t").csv(path)


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """Nine GTF columns; quotes stay in the attribute text."""
    return spark.read.schema(GTF_SCHEMA).options(sep="\t", comment="#", quote="").csv(path)


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, the fourth to sixth field if present, and the last field."""
    items = F.split("value", "\t")
    return spark.read.text(path).where("value <> ''").select(
        F.get(items, 0).alias("chrom"),
        F.get(items, 1).cast("bigint").alias("start"),
        F.get(items, 2).cast("bigint").alias("end"),
        F.get(items, 3).alias("name"),
        F.get(items, 4).alias("score"),
        F.get(items, 5).alias("strand"),
        F.element_at(items, -1).alias("last"),
    )


def read_pileup(spark: SparkSession, path: str) -> DataFrame:
    """Seven columns of a pileup with read names; base qualities may contain quote characters."""
    return spark.read.schema(PILEUP_SCHEMA).options(sep="\t", quote="", escape="").csv(path)


def read_circle_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_molecules(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MOLECULE_SCHEMA).option("header", True).csv(path)


def read_cell_list(spark: SparkSession, path: str) -> DataFrame:
    """First column of a cell table with a header line."""
    cells = spark.read.option("header", True).csv(path)
    return cells.select(F.col(cells.columns[0]).alias("cell_barcode"))


def read_links(spark: SparkSession, path: str) -> DataFrame:
    links = spark.read.schema(LINK_SCHEMA).options(sep="\t", header=True).csv(path)
    return links.drop("row", "peak_index").withColumn("accept", F.col("accept") == "True")


def _number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).cast("bigint")


def read_trim_log(spark: SparkSession, path: str) -> DataFrame:
    """Read pairs written by the adapter trimmer, from its log."""
    lines = spark.read.text(path).where(F.col("value").contains("Pairs written"))
    return lines.select(_number(F.regexp_extract("value", r"([\d,]+) \(", 1)).alias("pairs_written"))


def read_aligner_log(spark: SparkSession, path: str) -> DataFrame:
    """(uniquely_aligned, multimapping) from the aligner's final log."""
    lines = spark.read.text(path)
    field = F.trim(F.split_part("value", F.lit("|"), F.lit(1)))
    value = _number(F.trim(F.split_part("value", F.lit("|"), F.lit(2))))
    return lines.agg(
        F.max(F.when(field == "Uniquely mapped reads number", value)).alias("uniquely_aligned"),
        F.max(F.when(field == "Number of reads mapped to multiple loci", value)).alias("multimapping"),
    )


# ---- line-numbered text ---------------------------------------------------------------------

def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): global line numbers of text files, plain or gzipped.

    Spark cuts plain files into blocks. Row ids grow by one inside a block, and the lines of the
    blocks before it (one small row per block) give the offset, so no file has to fit one task.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    blocks = lines.groupBy("file", "_block").agg(F.min("_id").alias("_lo"), F.count("*").alias("_n"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "file", "_block", "_lo", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return lines.join(offsets, ["file", "_block"]).select(
        "file", (F.col("_id") - F.col("_lo") + F.col("_offset")).alias("line_no"), "value"
    )


class _LineCount:
    """Notes a split's number of lines and its first three, which may end the record begun before it."""

    def __init__(self, key: tuple[int, int]):
        self.key, self.n, self.head = key, 0, []

    def feed(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        if len(self.head) < 3:
            self.head += values.slice(0, 3 - len(self.head)).to_pylist()
        self.n += len(values)
        return iter(())

    def close(self) -> Iterator[pa.RecordBatch]:
        head = pa.array([self.head], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array([self.key[0]]), pa.array([self.key[1]]), pa.array([self.n]), head], ["file", "start", "n", "head"])


class _FastqRecords:
    """The records that begin in a split, numbered through the file; the last one ends with lines of later splits."""

    def __init__(self, key: tuple[int, int], plan: tuple[int, int, list[str]]):
        self.file = key[0]
        self.ordinal, self.skip, self.more = plan
        self.held = pa.array([], pa.string())

    def feed(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        skipped = min(self.skip, len(values))
        self.skip -= skipped
        lines = pa.concat_arrays([self.held, values.slice(skipped)])
        n = len(lines) // 4
        self.held = lines.slice(4 * n)
        if n:
            at = np.arange(n) * 4
            name, seq, plus, qual = (lines.take(pa.array(at + k)) for k in range(4))
            good = pc.and_(pc.and_(pc.starts_with(name, "@"), pc.starts_with(plus, "+")), pc.equal(pc.utf8_length(seq), pc.utf8_length(qual)))
            if not pc.all(good).as_py():
                raise ValueError(f"not a four-line record: {name.filter(pc.invert(good))[0]}")
            ordinal = pa.array(np.arange(self.ordinal, self.ordinal + n))
            self.ordinal += n
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, self.file)), ordinal, name, seq, qual], ["file", "ordinal", "name", "seq", "qual"])

    def close(self) -> Iterator[pa.RecordBatch]:
        yield from self.feed(pa.array(self.more, pa.string()))
        if any(self.held.to_pylist()):
            raise ValueError(f"the file ends within a record: {self.held[0]}")


def fastq_plan(rows: DataFrame) -> dict[tuple[int, int], tuple[int, int, list[str]]]:
    """(file, start): (number of the split's first record, lines before it, lines of its last record in later splits)."""
    plan = {}
    for file, splits in notes_of(map_splits(rows, "file bigint, start bigint, n bigint, head array<string>", _LineCount)).items():
        before, following = 0, list(splits.items())
        for k, (start, (n, _)) in enumerate(following):
            wanted, more = -(before + n) % 4, []
            for _, (_, head) in following[k + 1 :]:
                if len(more) >= wanted:
                    break
                more += head
            plan[file, start] = (-(-before // 4), min(-before % 4, n), more[:wanted] if n > -before % 4 else [])
            before += n
    return plan


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, name, seq, qual) of four-line FASTQ records; ``file`` is a number for the file.

    The lines of each split are counted first; with them every split knows its place in the file, takes up after the
    record that runs into it, and ends its own last record with the next split's first lines. Nothing is shuffled.
    A record that is not ``@``, bases, ``+`` and as many qualities raises an error, and so does a file that ends
    within a record. Gzipped files are one split each.
    """
    rows = split_rows(spark.read.text(path))
    plan = spark.sparkContext.broadcast(fastq_plan(rows))
    return map_splits(rows, "file bigint, ordinal bigint, name string, seq string, qual string", lambda key: _FastqRecords(key, plan.value[key]))


def read_fastq_pair(spark: SparkSession, path1: str, path2: str) -> DataFrame:
    """Mates in lock-step, matched by their ordinal; one file per side."""
    def side(path, k):
        return read_fastq(spark, path).select(
            "ordinal", *[F.col(c).alias(f"{c}{k}") for c in ("name", "seq", "qual")]
        )

    return side(path1, 1).join(side(path2, 2), "ordinal")


def read_fasta_lines(spark: SparkSession, path: str) -> DataFrame:
    """(seq) lines of a FASTA with one line per sequence, as short references have."""
    return spark.read.text(path).where(~F.col("value").startswith(">") & (F.col("value") != "")).select(
        F.trim("value").alias("seq")
    )
