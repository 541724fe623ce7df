"""Formats whose records run over the borders of Spark's file splits.

Spark cuts a file into splits and gives each its rows in order. A first pass leaves one small note per split (such as
how many records it holds, or the bytes before its first record). Running over the notes in file order tells each
split where it stands and what it still needs of its successor, so a second pass makes whole records in place:
no shuffle of the data, and no task that reads more than its splits. Files come through Spark's own file system.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Notes reach the driver and every task. At 128 MB a split, notes of 400 bytes come to this much at some 20 TB.
NOTE_BYTES = 64 << 20


def split_rows(lines: DataFrame) -> DataFrame:
    """(file, start, value): the rows of text files, with a number for the file and the start of the split."""
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def map_splits(rows: DataFrame, schema: str, worker: Callable[[tuple[int, int]], object]) -> DataFrame:
    """Each split's values, in order, through a worker of its own: ``feed(values)`` and ``close()`` yield record batches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, at_work = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            file, start = (batch.column(c).to_numpy() for c in ("file", "start"))
            change = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
            for a, b in zip([0, *change], [*change, batch.num_rows], strict=True):
                if key != (file[a], start[a]):
                    if at_work is not None:
                        yield from at_work.close()
                    key = (file[a], start[a])
                    at_work = worker((int(file[a]), int(start[a])))
                yield from at_work.feed(batch.column("value").slice(a, b - a))
        if at_work is not None:
            yield from at_work.close()

    return rows.mapInArrow(run, schema)


def notes_of(notes: DataFrame) -> dict[int, dict[int, tuple]]:
    """file: {start: note}, in file order. Notes have file, start and more columns; strings and bytes count towards NOTE_BYTES."""
    found: dict[int, dict[int, tuple]] = {}
    size = 0
    for file, start, *note in notes.toLocalIterator():
        size += 32 + sum(len(x) if isinstance(x, (str, bytes, bytearray, list)) else 8 for x in note)
        if size > NOTE_BYTES:
            raise ValueError("too many file splits for one read: raise spark.sql.files.maxPartitionBytes, or read fewer files at once")
        found.setdefault(file, {})[start] = tuple(note)
    return {file: dict(sorted(by_start.items())) for file, by_start in found.items()}


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it; Spark writes local URIs with one slash."""
    if path.startswith("file:/") or ":/" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/") if path.startswith(("file:", "/")) else path
    return fs.FileSystem.from_uri(path)
