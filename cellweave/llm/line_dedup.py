"""Substring deduplication by hashing lines (or paragraphs) and the sentences in them.

Each text is cut into units: lines, or paragraphs divided by blank lines. A unit is cut into sentences, after ``.``, ``!`` or ``?``
and blanks. Units and sentences are normalised (lower case, every run of characters other than letters and digits one
space, trimmed) and hashed to 128 bits, each kind by itself. Over the whole corpus the earliest occurrence of each digest
stays, ranked by doc_id, nulls first, and place in the text; every later one is a repeat.

Removed are repeated units of at least ``MIN_WORDS`` normalised words, and runs of consecutive repeated sentences of at least
``RUN_WORDS`` words together, which is how a passage pasted into a line of its own words is found. A shorter repeat says too
little to be called a copy and stays. Every removed span keeps its offsets in the original text.

With ``span_words`` also goes every window of that many consecutive words that stands earlier, wherever sentences and lines end
(``repeated_spans``). Within a text it does so only if it does not overlap its first occurrence.

Digests are written once as a table. Repeats inside a text are settled where it is read. Across texts the earliest occurrence
is an aggregate minimum that combines before the shuffle, so a line in a third of all documents costs one row per task. Occurrences
are then marked by a join of the digests that occur more than once, to which only rows go that a table of bits of these digests
lets pass; a digest held by many rows is split by the adaptive skew join.

Defined cases: ``doc_id`` must be of a whole number's type; null and empty texts have no units and stay as they are; a text is cut whole whatever its length;
rows of one doc_id take nothing from each other (as rows without one), so repeated rows give repeated rows;
other columns pass through untouched. A kept text is the kept units joined by their own separators; in a unit that loses
sentences or words the others are joined by one space, and a unit that loses all of them goes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from xxhash import xxh3_128_digest

from cellweave.llm.common import free_prefix, small_batches, stored, text_key, text_or_empty

MIN_WORDS, RUN_WORDS = 5, 30
SPAN_WORDS, ANCHOR_WORDS = 50, 15
#: Anchors that occur twice are told by 2^ANCHOR_BITS bits at most (128 MB). More anchors cost time there, no repeats.
ANCHOR_BITS, _CHUNK_BITS = 30, 15
_FLUSH = 200_000
SEPARATORS = {"line": "\n", "paragraph": "\n\n"}
SENTENCE_END = r"(?<=[.!?])[ \t]+"
_WORD = re.compile(r"[^\W_]+")


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))


def _spread(separator: str, min_words: int):
    """Arrow batches of texts to a row per unit (place -1, -2, ...) and per sentence (place 0, 1, ...) with its digest."""
    schema = pa.schema([("doc", pa.int64()), ("text_key", pa.int64()), ("place", pa.int32()), ("high", pa.int64()), ("low", pa.int64()), ("again", pa.bool_())])

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, words_of = re.compile(SENTENCE_END).split, _WORD.findall
        for batch in batches:
            docs, keys, places, digests, again = [], [], [], [], []
            for doc, key, text in zip(batch.column("doc").to_pylist(), batch.column("text_key").to_pylist(), batch.column("text"), strict=True):
                seen, before, nth = set(), len(places), 0
                for k, unit in enumerate(text.as_py().lower().split(separator)):
                    own = []
                    for sentence in split(unit):
                        words = words_of(sentence)
                        if words:
                            digest = xxh3_128_digest(" ".join(words).encode("utf-8", "replace"))
                            places.append(nth)
                            digests.append(digest)
                            again.append(digest in seen)
                            seen.add(digest)
                            own += words
                        nth += 1
                    if len(own) >= min_words:
                        digest = xxh3_128_digest(" ".join(own).encode("utf-8", "replace"), 1)
                        places.append(-1 - k)
                        digests.append(digest)
                        again.append(digest in seen)
                        seen.add(digest)
                docs += [doc] * (len(places) - before)
                keys += [key] * (len(places) - before)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            columns = [docs, keys, places, halves[:, 0].copy(), halves[:, 1].copy(), again]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return spread


def _later(rows: DataFrame) -> DataFrame:
    """doc, text_key, place of the ``rows`` whose digest stands earlier.

    Most digests stand once. A table of bits of those that don't lets a task drop the rows that can meet none before the
    join; a row that it keeps for nothing meets none there.
    """
    once = rows.where("not again")
    firsts = stored(once.groupBy("high", "low").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1"))
    table = rows.sparkSession.sparkContext.broadcast(_table_of_bits(firsts.select(F.col("low").alias("anchor"))))

    def met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_are_set(table.value, batch.column("low").to_numpy().view(np.uint64))))

    names = "doc long, text_key long, place int, high long, low long"
    some = once.select("doc", "text_key", "place", "high", "low").mapInArrow(met, names)
    later = some.join(firsts, ["high", "low"]).where("doc > first")
    return later.select("doc", "text_key", "place").unionByName(rows.where("again").select("doc", "text_key", "place"))


def _are_set(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    bit = values & np.uint64(8 * len(table) - 1)
    return (table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _word_hashes(text: str) -> np.ndarray:
    """A row of two 64-bit values per word."""
    return np.frombuffer(b"".join([xxh3_128_digest(w.lower().encode("utf-8", "replace")) for w in _WORD.findall(text)]), np.uint64).reshape(-1, 2)


def _windows(values: np.ndarray, n: int) -> np.ndarray:
    """A polynomial hash, modulo 2^64, of every ``n`` consecutive values."""

    def powers(base: int, k: int) -> np.ndarray:
        out = np.full(k, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    base = 0x9E3779B97F4A7C15
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return (sums[n:] - sums[:-n]) * powers(pow(base, -1, 1 << 64), len(values) - n + 1)


def _anchors(values: np.ndarray, span: int) -> np.ndarray:
    """For every window of ``span`` values the place of its anchor, the least hash of ``ANCHOR_WORDS`` in it; and all such hashes."""
    n = min(ANCHOR_WORDS, span)
    grams = _windows(values, n)
    least = np.lib.stride_tricks.sliding_window_view(grams, span - n + 1).argmin(1)
    return least + np.arange(len(least)), grams


def _table_of_bits(anchors: DataFrame) -> np.ndarray:
    """Bit (anchor modulo their number) is set for each of ``anchors``; eight to a byte."""
    bits = min(max((16 * anchors.count()).bit_length(), _CHUNK_BITS), ANCHOR_BITS)

    def pack(own: pa.Table) -> pa.Table:
        chunk = np.zeros(1 << _CHUNK_BITS, bool)
        chunk[own.column("bit").to_numpy() & ((1 << _CHUNK_BITS) - 1)] = True
        packed = np.packbits(chunk, bitorder="little").tobytes()
        return pa.table({"chunk": pa.array([own.column("chunk")[0].as_py()], pa.int64()), "packed": pa.array([packed], pa.binary())})

    bit = F.col("anchor").bitwiseAND(F.lit((1 << bits) - 1))
    chunks = anchors.select(bit.alias("bit"), F.shiftright(bit, _CHUNK_BITS).alias("chunk")).groupBy("chunk").applyInArrow(pack, "chunk long, packed binary")
    table = np.zeros((1 << (bits - _CHUNK_BITS), 1 << (_CHUNK_BITS - 3)), np.uint8)
    for chunk, packed in zip(*chunks.toArrow().to_pydict().values(), strict=True):
        table[chunk] = np.frombuffer(packed, np.uint8)
    return table.reshape(-1)


def repeated_spans(documents: DataFrame, span: int = SPAN_WORDS) -> DataFrame:
    """doc, text_key, place of each window of ``span`` words that stands earlier in the corpus; place counts words.

    Equal windows have equal anchors, so only windows whose anchor occurs twice are written and compared, by 128 bits.
    """
    docs = documents.select(_key().alias("doc"), text_key().alias("text_key"), text_or_empty().alias("text"))

    def anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for text in batch.column("text"):
                hashes = _word_hashes(text.as_py())
                if len(hashes) >= span:
                    places, grams = _anchors(hashes[:, 0], span)
                    found.append(grams[np.unique(places)])
            yield pa.RecordBatch.from_pydict({"anchor": pa.array(np.concatenate(found).view(np.int64))})

    twice = docs.select("text").mapInArrow(anchors, "anchor long").groupBy("anchor").count().where("count > 1")
    table = documents.sparkSession.sparkContext.broadcast(_table_of_bits(stored(twice.select("anchor"))))
    schema = pa.schema([("doc", pa.int64()), ("text_key", pa.int64()), ("place", pa.int32()), ("high", pa.int64()), ("low", pa.int64()), ("again", pa.bool_())])

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*found, strict=True)] or [[]] * len(schema)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc, key, text in zip(batch.column("doc").to_pylist(), batch.column("text_key").to_pylist(), batch.column("text"), strict=True):
                hashes = _word_hashes(text.as_py())
                if len(hashes) < span:
                    continue
                at, grams = _anchors(hashes[:, 0], span)
                places = np.flatnonzero(_are_set(table.value, grams)[at])
                if not len(places):
                    continue
                high, low = (_windows(hashes[:, k], span)[places].view(np.int64) for k in (0, 1))
                _, first, which = np.unique(np.stack([high, low], 1), axis=0, return_index=True, return_inverse=True)
                again = places >= places[first][which.reshape(-1)] + span
                found.append([np.full(len(places), doc), np.full(len(places), key), places, high, low, again])
                held += len(places)
                if held > _FLUSH:
                    yield flush()
                    held = 0
        yield flush()

    return _later(stored(docs.mapInArrow(windows, "doc long, text_key long, place int, high long, low long, again boolean")))


def repeated_units(documents: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, span_words: int | None = None) -> DataFrame:
    """doc, text_key, units, sentences, windows: the places of a text's units, sentences and windows that stand earlier in the corpus."""
    docs = documents.select(_key().alias("doc"), text_key().alias("text_key"), text_or_empty().alias("text"))
    rows = stored(
        docs.mapInArrow(_spread(SEPARATORS[unit], min_words), "doc long, text_key long, place int, high long, low long, again boolean")
    )
    found = _later(rows).withColumn("window", F.lit(None).cast("int"))
    if span_words:
        found = found.unionByName(repeated_spans(documents, span_words).withColumnRenamed("place", "window"), allowMissingColumns=True)
    own = lambda condition, place: F.array_sort(F.collect_set(F.when(condition, place)))
    place, window = F.col("place"), F.col("window")
    return found.groupBy("doc", "text_key").agg(
        own(place < 0, -1 - place).alias("units"), own(place >= 0, place).alias("sentences"), own(window >= 0, window).alias("windows")
    )


def _without_windows(text: str, rows: list[list], windows: list[int], span_words: int) -> list[list]:
    """``rows`` of ``cut``, divided where the words of ``windows`` begin and end."""
    words = [m.span() for m in _WORD.finditer(text)]
    ends = np.zeros(len(words) + 1, int)
    np.add.at(ends, windows, 1)
    np.add.at(ends, np.array(windows) + span_words, -1)
    gone = (np.cumsum(ends) > 0).tolist()
    out, w = [], 0
    for place, start, end, removed in rows:
        first = w
        while w < len(words) and words[w][0] < end:
            w += 1
        if removed or True not in gone[first:w]:
            out.append([place, start, end, removed or (first == w > 0 and gone[w - 1] and gone[w])])
            continue
        at = start
        while first < w:
            last = first
            while last < w and gone[last] == gone[first]:
                last += 1
            to = words[last][0] if last < w else end
            out.append([place, at, at + len(text[at:to].rstrip()) if last < w else end, gone[first]])
            first, at = last, to
    return out


def cut(
    text: str, separator: str, units: set[int], sentences: set[int], run_words: int = RUN_WORDS, windows: list[int] = (), span_words: int = SPAN_WORDS
) -> tuple[str, list[tuple[int, int, int]]]:
    """The text without repeated units, long runs of repeated sentences and ``windows``, and (place, start, end) of what went."""
    rows, at, nth, run = [], 0, 0, []  # a row per sentence: unit, start, end, removed

    def close() -> None:
        if sum(len(_WORD.findall(text[rows[k][1] : rows[k][2]])) for k in run) >= run_words:
            for k in run:
                rows[k][3] = True
        run.clear()

    for place, unit in enumerate(text.split(separator)):
        start = at
        for piece in re.split(f"({SENTENCE_END})", unit):
            if nth % 2 == 0:
                k = len(rows)
                rows.append([place, start, start + len(piece), place in units])
                if k in sentences:
                    run.append(k)
                elif _WORD.search(piece):  # a sentence without words neither ends nor lengthens a run
                    close()
            start += len(piece)
            nth += 1
        nth = 0
        at += len(unit) + len(separator)
    close()
    if windows:
        rows = _without_windows(text, rows, windows, span_words)
    kept, spans, k = [], [], 0
    while k < len(rows):
        place = rows[k][0]
        own = []
        while k < len(rows) and rows[k][0] == place:
            own.append(rows[k])
            k += 1
        gone = [r[3] for r in own]
        if not any(gone):
            kept.append(text[own[0][1] : own[-1][2]])
        elif not all(gone):
            kept.append(" ".join(text[r[1] : r[2]] for r in own if not r[3]))
        for i, r in enumerate(own):
            if r[3]:
                if i and gone[i - 1]:
                    spans[-1] = (place, spans[-1][1], r[2])
                else:
                    spans.append((place, r[1], r[2]))
    return separator.join(kept), spans


def _cut_out(separator: str, span_words: int | None, marks: list[str], schema: pa.Schema):
    """Arrow batches with units, sentences and windows, named by ``marks``, to batches of ``schema``: texts rewritten, spans of what went."""

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            for row in zip(*(batch.column(c) for c in ("text", *marks)), strict=True):
                text, units, sentences, windows = (v.as_py() for v in row)
                spans = []
                if units or sentences or windows:
                    now, spans = cut(text, separator, set(units or ()), set(sentences or ()), RUN_WORDS, windows or (), span_words or 0)
                    text = now if spans else text
                texts.append(text)
                removed.append([dict(zip(("place", "start", "end"), s, strict=True)) for s in spans])
            made = {"text": texts, "n_removed": [len(r) for r in removed], "removed": removed}
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name).cast(f.type) for f in schema], schema=schema
            )

    return rewrite


def dedup_lines(documents: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, span_words: int | None = None) -> DataFrame:
    """``documents`` with ``text`` freed of repeated units and, if asked for, spans; and n_units, n_removed and ``removed``.

    ``removed`` lists (place, start, end) of each removed unit, in code points of the original text.
    """
    if not isinstance(documents.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError("doc_id ranks the documents here and must be a whole number")
    small_batches(documents.sparkSession)
    separator = SEPARATORS[unit]
    at = free_prefix(documents)
    marks = [f"{at}{c}" for c in ("units", "sentences", "windows")]
    gone = repeated_units(documents, unit, min_words, span_words).select(
        F.col("doc").alias(f"{at}doc"), F.col("text_key").alias(f"{at}gone"), *(F.col(c.removeprefix(at)).alias(c) for c in marks)
    )
    kept = [c for c in documents.columns if c not in ("n_units", "n_removed", "removed")]
    docs = documents.select(
        *kept, F.when(text_or_empty() != "", F.size(F.split("text", separator))).otherwise(0).alias("n_units"), text_key().alias(f"{at}key")
    )
    joined = docs.join(gone, (_key() == F.col(f"{at}doc")) & (F.col(f"{at}key") == F.col(f"{at}gone")), "left")
    joined = joined.select(*kept, "n_units", *marks)
    span = T.StructType([T.StructField(c, T.IntegerType()) for c in ("place", "start", "end")])
    schema = T.StructType(
        [*joined.drop(*marks).schema.fields, T.StructField("n_removed", T.IntegerType()), T.StructField("removed", T.ArrayType(span))]
    )
    return joined.mapInArrow(_cut_out(separator, span_words, marks, to_arrow_schema(schema)), schema)
