"""Genome FASTA in chunks, and the combined multi-species reference."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.sources.splits import map_splits, notes_of, split_rows

CHUNK = 65_536


class _ContigEnds:
    """Notes the last header in a split, and how many bases stand before its first header and after its last."""

    def __init__(self, key: tuple[int, int]):
        self.key, self.before, self.after, self.name = key, 0, 0, None

    def feed(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        lines = pc.ascii_trim_whitespace(values)
        sizes = pc.binary_length(lines).to_numpy().astype(np.int64)
        heads = np.flatnonzero(pc.starts_with(lines, ">").to_numpy(zero_copy_only=False))
        if self.name is None:
            self.before += int(sizes[: heads[0]].sum() if len(heads) else sizes.sum())
        if len(heads):
            self.name, self.after = _contig(lines[int(heads[-1])].as_py()), int(sizes[heads[-1] + 1 :].sum())
        elif self.name is not None:
            self.after += int(sizes.sum())
        return iter(())

    def close(self) -> Iterator[pa.RecordBatch]:
        row = zip(("file", "start", "before", "after", "name"), (*self.key, self.before, self.after, self.name), strict=True)
        yield pa.RecordBatch.from_pydict({k: pa.array([v], pa.string() if k == "name" else pa.int64()) for k, v in row})


class _Pieces:
    """The bases of a split in pieces that end where a multiple of ``chunk`` is met, a header stands or the split ends."""

    def __init__(self, plan: tuple[str | None, int], chunk: int):
        self.chunk = chunk
        self.contig, self.offset = plan
        self.lines: list[str] = []
        self.size = 0

    def cut(self, whole: bool) -> list[tuple[str | None, int, str]]:
        out, text, at = [], "".join(self.lines), 0
        while at < len(text):
            end = at + self.chunk - self.offset % self.chunk
            if end > len(text) and not whole:
                break
            piece = text[at:end]
            out.append((self.contig, self.offset, piece))
            self.offset += len(piece)
            at += len(piece)
        self.lines, self.size = [text[at:]], len(text) - at
        return out

    def batch(self, out: list) -> Iterator[pa.RecordBatch]:
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["chrom", "offset", "seq"])

    def feed(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        out = []
        for line in pc.ascii_trim_whitespace(values).to_pylist():
            if line.startswith(">"):
                out += self.cut(True)
                self.contig, self.offset = _contig(line), 0
            elif line:
                if self.contig is None:
                    raise ValueError("bases before the first header of a FASTA")
                self.lines.append(line)
                self.size += len(line)
                if self.size >= 4 * self.chunk:
                    out += self.cut(False)
        yield from self.batch(out)

    def close(self) -> Iterator[pa.RecordBatch]:
        yield from self.batch(self.cut(True))


def _contig(header: str) -> str:
    return (header[1:].split() or [""])[0]


def genome_plan(rows: DataFrame) -> dict[tuple[int, int], tuple[str | None, int]]:
    """(file, start): (contig in which the split begins, offset of its first base in it)."""
    plan = {}
    for file, splits in notes_of(map_splits(rows, "file bigint, start bigint, before bigint, after bigint, name string", _ContigEnds)).items():
        contig, offset = None, 0
        for start, (before, after, name) in splits.items():
            plan[file, start] = (contig, offset)
            contig, offset = (contig, offset + before) if name is None else (name, after)
    return plan


def read_genome(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """(chrom, offset, seq): pieces of contigs, none over a multiple of ``chunk``.

    A first pass notes where each split's contigs begin and end; running over these notes gives each split its contig and
    offset, so files are cut anywhere and read in many tasks. A chunk that a split cuts comes in two pieces.
    """
    rows = split_rows(spark.read.text(path))
    plan = spark.sparkContext.broadcast(genome_plan(rows))
    return map_splits(rows, "chrom string, offset bigint, seq string", lambda key: _Pieces(plan.value[key], chunk))


def combined_header(line: Column, species: str) -> Column:
    """FASTA header with the species before the contig; the next three words are kept."""
    words = F.split(line, r"\s+")
    kept = F.slice(words, 2, 3)
    name = F.regexp_replace(F.get(words, 0), "^>", "")
    return F.concat_ws(" ", F.concat(F.lit(f">{species}_"), name), F.array_join(kept, " "))


def combined_genome(spark: SparkSession, fastas: dict[str, str]) -> DataFrame:
    """(file, line_no, value): the lines of all species' FASTAs with renamed contigs, in order."""
    from cellweave.sources.tables import numbered_lines

    out = None
    for rank, (species, path) in enumerate(fastas.items()):
        lines = numbered_lines(spark, path)
        header = F.col("value").startswith(">")
        part = lines.select(
            F.lit(rank).alias("file"), "line_no",
            F.when(header, combined_header(F.col("value"), species)).otherwise(F.col("value")).alias("value"),
        )
        out = part if out is None else out.unionByName(part)
    return out
