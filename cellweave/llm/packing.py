"""Bounded-space online packing of token sequences.

Each partition packs its own documents as they come. At most ``OPEN`` windows of ``WINDOW`` tokens are open.
A document's whole windows are cut off and emitted at once. The remainder goes into the open window with
the least room that holds it (best fit). When none holds it, the fullest window is topped up with
the head of the remainder, so that it is full, and emitted; the rest is placed again. At the end of a
partition its open windows are leftovers: partitions are merged in groups of ``FAN_IN``, level by level,
each leftover window being an item placed best-fit-decreasing into the others' room, until one group is left.
Only the placement of pieces takes part there (a few numbers each), at most ``FAN_IN * OPEN`` windows in a group.

Pieces are written once as a table before leftovers are merged, so that a lost executor cannot
pack twice. Token ids come from the tokenizer's own encoding of each distinct white-space-free chunk: its
pre-tokens never hold white space, so a text's ids are those of its chunks in order.

Defined cases: null is the empty text (its one id is the end id); repeated rows are packed each; a text of any
length is cut; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import small_batches, stored, text_or_empty, tokenizer_path
from cellweave.llm.token_counts import special_strings

WINDOW, OPEN, FAN_IN = 2048, 16, 64
END_ID = 1
_CACHE = 400_000
#: New words that are encoded at once.
TOGETHER = 1_000
_ENCODERS: dict[str, "ChunkEncoder"] = {}
_PIECE = "start long, length long, ids_crc32 long, doc_tokens long"


class ChunkEncoder:
    """Ids (as little-endian unsigned 32-bit bytes) of texts, chunk by chunk, through bounded caches.

    A chunk of plain Latin letters, digits and signs is lower-cased and cut as the tokenizer does it, and new
    words are encoded by the tokenizer many at a time. Any other chunk is encoded by the tokenizer as it is.
    """

    #: The tokenizer's pattern, for characters below U+0180 less those excluded by ``plain``.
    words = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+").findall
    plain = re.compile(r"[!-~¡-©«¬®-±´¶-¸»¿-įı-ž]+").fullmatch
    odd_space = re.compile("[\x1c-\x1f]").search

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = special_strings(path)
        self.special = re.compile("|".join(map(re.escape, special)) or r"\Z.").search
        vocabulary = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_end[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.chunk_ids: dict[str, bytes] = {}
        self.word_ids: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn_words(self, words: list[str]) -> None:
        for k in range(0, len(words), TOGETHER):
            some = words[k : k + TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = (np.flatnonzero(self.word_end[ids]) + 1).tolist()
            if len(ends) == len(some) and ends[-1] == len(ids):
                raw = ids.tobytes()
                got = [raw[4 * start : 4 * end] for start, end in zip([0, *ends], ends)]  # noqa: B905
            else:
                got = [self._whole(w) for w in some]
            self.word_ids.update(zip(some, got, strict=True))

    def _learn(self, chunks: Iterable[str]) -> None:
        if len(self.chunk_ids) > _CACHE:
            self.chunk_ids.clear()
        if len(self.word_ids) > _CACHE:
            self.word_ids.clear()
        single: list[str] = []
        cut: dict[str, list[str]] = {}
        for c in chunks:
            if c.isascii() and c.isalpha():
                single.append(c)
            elif self.plain(c) and not self.special(c):
                cut[c] = self.words(c.lower())
            else:
                self.chunk_ids[c] = self._whole(c)
        lower = list(map(str.lower, single))
        word = self.word_ids
        self._learn_words(list({*lower, *(w for ws in cut.values() for w in ws)} - word.keys()))
        self.chunk_ids.update(zip(single, map(word.__getitem__, lower), strict=True))
        for c, ws in cut.items():
            self.chunk_ids[c] = word[ws[0]] if len(ws) == 1 else b"".join([word[w] for w in ws])

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """The texts' ids, in order."""
        for k in range(0, len(texts), 256):
            some = texts[k : k + 256]
            split = [None if self.odd_space(t) else t.split() for t in some]
            known = self.chunk_ids.get
            found = [None if chunks is None else list(map(known, chunks)) for chunks in split]
            gaps = [[i for i, ids in enumerate(parts) if ids is None] if parts and None in parts else () for parts in found]
            new = {chunks[i] for chunks, at in zip(split, gaps, strict=True) for i in at}
            if new:
                self._learn(new)
                for chunks, parts, at in zip(split, found, gaps, strict=True):
                    for i in at:
                        parts[i] = self.chunk_ids[chunks[i]]
            for t, parts in zip(some, found, strict=True):
                yield self._whole(t) if parts is None else b"".join(parts)


def _encoder(path: str) -> ChunkEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


class OpenWindows:
    """The open windows of one partition; rows leave as (document, start, length, window, offset)."""

    def __init__(self, window: int, most: int):
        self.size, self.most = window, most
        self.rooms: list[tuple[int, int]] = []  # (room, window), sorted
        self.next = 0

    def place(self, tokens: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, window, offset) of each piece of a document of so many tokens."""
        start = 0
        while tokens - start >= self.size:
            yield start, self.size, self.next, 0
            self.next += 1
            start += self.size
        while start < tokens:
            rest = tokens - start
            k = bisect_left(self.rooms, (rest, -1))
            if k < len(self.rooms):
                length, (room, window) = rest, self.rooms.pop(k)
            elif len(self.rooms) < self.most:
                length, room, window = rest, self.size, self.next
                self.next += 1
            else:
                length, window = self.rooms.pop(0)
                room = length
            yield start, length, window, self.size - room
            if room > length:
                insort(self.rooms, (room - length, window))
            start += length


def _pack_partition(path: str, window: int, most: int, schema: pa.Schema):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, windows = _encoder(path), OpenWindows(window, most)
        end = array("I", [END_ID]).tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for key, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist()), strict=True):
                ids += end
                tokens = len(ids) // 4
                for start, length, seq, offset in windows.place(tokens):
                    piece = ids if length == tokens else ids[4 * start : 4 * (start + length)]
                    rows.append((key, start, length, zlib.crc32(piece), tokens, part, seq, offset, 0))
            columns = zip(*rows, strict=True) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        # A row for each window left open tells how much of it is used.
        left = {f.name: [] for f in schema}
        for room, seq in windows.rooms:
            for name, value in zip(left, (None, None, None, None, None, part, seq, None, window - room), strict=True):
                left[name].append(value)
        yield pa.RecordBatch.from_pydict(left, schema=schema)

    return pack


def _merge_leftovers(window: int):
    """A group of leftover windows (part, seq, used) to (part, seq, into_part, into_seq, shift), best fit decreasing."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["used", "part", "seq"], ascending=[False, True, True])
        rooms: list[tuple[int, int, int]] = []
        out = []
        for part, seq, used in zip(group["part"], group["seq"], group["used"], strict=True):
            k = bisect_left(rooms, (used, -1, -1))
            room, into_part, into_seq = rooms.pop(k) if k < len(rooms) else (window, part, seq)
            out.append((part, seq, into_part, into_seq, window - room))
            if room > used:
                insort(rooms, (room - used, into_part, into_seq))
        return pd.DataFrame(out, columns=["part", "seq", "into_part", "into_seq", "shift"])

    return merge


def pack_documents(
    documents: DataFrame, tokenizer: str = "word_bpe_49k.json", window: int = WINDOW, open_windows: int = OPEN, fan_in: int = FAN_IN
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    small_batches(documents.sparkSession)
    id_field = documents.schema["doc_id"]
    path = tokenizer_path(tokenizer)
    names = f"doc_id {id_field.dataType.simpleString()}, {_PIECE}, part long, seq long, offset long, used long"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(names))
    docs = documents.select("doc_id", text_or_empty().alias("text"))
    rows = stored(docs.mapInArrow(_pack_partition(path, window, open_windows, schema), names))
    pieces = rows.where("length is not null")
    moves = _levels(rows.where("length is null").select("part", "seq", "used"), window, fan_in)
    placed = pieces.join(moves, ["part", "seq"], "left")
    part, seq = F.coalesce("into_part", "part"), F.coalesce("into_seq", "seq")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.shiftleft(part, 36) + seq).alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )


def _levels(left: DataFrame, window: int, fan_in: int) -> DataFrame:
    """part, seq, into_part, into_seq, shift of every leftover window, merged level by level."""
    parts = left.agg(F.max("part")).first()[0]
    level = left.withColumns({"into_part": F.col("part"), "into_seq": F.col("seq"), "shift": F.lit(0).cast("long")})
    moves, at = stored(level), 1
    while parts is not None and at <= parts:
        at *= fan_in
        # What a window holds by now stands under the window it went into.
        used = moves.groupBy(F.col("into_part").alias("part"), F.col("into_seq").alias("seq")).agg(F.sum("used").alias("used"))
        step = used.groupBy(F.floor(F.col("part") / at).alias("group")).applyInPandas(
            _merge_leftovers(window), "part long, seq long, into_part long, into_seq long, shift long"
        )
        step = step.select(F.col("part").alias("p"), F.col("seq").alias("s"), F.col("into_part").alias("ip"), F.col("into_seq").alias("is"), F.col("shift").alias("more"))
        joined = moves.join(step, (F.col("into_part") == F.col("p")) & (F.col("into_seq") == F.col("s")))
        moves = stored(joined.select("part", "seq", "used", F.col("ip").alias("into_part"), F.col("is").alias("into_seq"), (F.col("shift") + F.col("more")).alias("shift")))
    return moves.drop("used")
