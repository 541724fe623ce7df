"""Pileup rows from alignments: every base of every read at its place, in the pileup format's marks.

The operations of a read give blocks on the contig. A block meets the contig's text by bins, keeps the few bases it
covers, and is spread, in whole arrays, to its bases with each base's token: ``.`` or ``,`` where it equals the contig, the base
where not (lower case on the reverse strand), ``*`` in a deletion, ``>`` or ``<`` where the read skips. The first base
is marked with ``^`` and the mapping quality, the last with ``$``; an insertion or deletion that follows stands behind
its base as ``+2AC`` or ``-2AC``. Skipped stretches (introns) are only spread over places where some read has a base.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.lineage import cut
from cellweave.operators.intervals import bin_of, clip_to_bins, point_join

# The flags of reads that a pileup leaves out (unmapped, secondary, failed, duplicate), and of pairs.
LEFT_OUT, PAIRED, PROPER = 0x704, 0x1, 0x2
_PIECE = "struct<op:string,size:int,ref:bigint,read:int>"
_SKIP_BIN = 1 << 14
TASK_BASES = 1 << 21  # bases that a task spreads, about
BASES = 1 << 19  # bases that are spread at a time
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_OPERATION = re.compile(r"(\d+)([MIDNSHP=X])").findall
_BLOCK = (
    "chrom string, qname string, flag int, read_start bigint, mapq int, back boolean, start bigint, end bigint, block_start bigint, ref_end bigint, "
    "goes_on boolean, deleted boolean, seq string, qual string, gained string, gone_end bigint"
)
_BASE = "chrom string, bin bigint, pos bigint, ref string, token string, qual string, qname string, start bigint, flag int"
_SITE = "chrom string, pos bigint, ref string, depth int, match string, qual string, names string"


def read_pieces(pos: Column, cigar: Column) -> Column:
    """The operations with the place of each on the contig (``ref``) and in the read's bases (``read``), from 0."""
    sizes = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1))
    ops = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2))
    items = F.zip_with(sizes, ops, lambda n, o: F.struct(n.cast("int").alias("size"), o.alias("op")))
    start = F.struct(pos.cast("bigint").alias("ref"), F.lit(0).alias("read"), F.array().cast(f"array<{_PIECE}>").alias("pieces"))

    def step(s: Column, x: Column) -> Column:
        piece = F.struct(x["op"].alias("op"), x["size"].alias("size"), s["ref"].alias("ref"), s["read"].alias("read"))
        on_ref = F.when(x["op"].isin("M", "=", "X", "D", "N"), x["size"]).otherwise(0)
        on_read = F.when(x["op"].isin("M", "=", "X", "I", "S"), x["size"]).otherwise(0)
        return F.struct((s["ref"] + on_ref).alias("ref"), (s["read"] + on_read).alias("read"), F.concat(s["pieces"], F.array(piece)).alias("pieces"))

    return F.aggregate(items, start, step)["pieces"]


def _texts(blocks: DataFrame, genome: DataFrame, chunk: int, *tasks: int) -> DataFrame:
    """``blocks`` cut at the genome's pieces and dealt by (chrom, ``bin``), with the contig's bases of each part as ``text``."""
    parts = clip_to_bins(blocks, "start", "end", chunk).repartition(*tasks, "chrom", "bin")
    text = genome.select("chrom", bin_of(F.col("offset"), chunk).alias("bin"), "offset", F.upper("seq").alias("_seq"))
    low = F.greatest(F.col("start"), F.col("offset"))
    high = F.least(F.col("end"), F.col("offset") + F.length("_seq"))
    met = parts.join(text, ["chrom", "bin"]).where(low < high)
    bases = F.substr("_seq", (low - F.col("offset") + 1).cast("int"), (high - low).cast("int"))
    return met.select("bin", *[c for c in blocks.columns if c not in ("start", "end")], low.alias("start"), high.alias("end"), bases.alias("text"))


# ---- in arrays -------------------------------------------------------------------------------

def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts and where each begins and the last one ends; a null has none."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), at


def _strings(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat)))


def _spots(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place in the row, for each of the things of which a row has ``sizes``."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _slices(flat: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes from each ``begin`` to its ``end``, and how many they are."""
    sizes = np.maximum(end - begin, 0)
    row, at = _spots(sizes)
    return flat[begin[row] + at], sizes


def _pieces_of(cigars: pa.Array, ops: str) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """For each piece of ``ops`` of each read: the read's row, and what the operations say of the piece."""
    codes = cigars.dictionary_encode()
    found, counts = [], []
    for text in codes.dictionary.to_pylist():
        items = [(int(n), op) for n, op in _OPERATION(text)]
        last = max((i for i, (_, op) in enumerate(items) if op in "M=XDN"), default=-1)
        ref = read = kept = 0
        for i, (n, op) in enumerate(items):
            after, kind = items[i + 1] if i + 1 < len(items) else (0, "")
            if op in ops:
                found.append((ref, n, read, op == "D", last > i, after if kind == "I" else 0, after if kind == "D" else 0))
                kept += 1
            ref += n if op in "M=XDN" else 0
            read += n if op in "M=XIS" else 0
        counts.append(kept)
    number, counts = codes.indices.to_numpy(), np.array(counts, np.int64)
    row, at = _spots(counts[number])
    names = ["ref", "size", "read", "deleted", "goes_on", "gained", "gone"]
    table = np.array(found, np.int64).reshape(-1, len(names))[(np.cumsum(counts) - counts)[number][row] + at]
    return row, dict(zip(names, table.T, strict=True))


def _cut_deletions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, piece = _pieces_of(batch.column("cigar"), "D")
        start = batch.column("read_start").to_numpy()[row] + piece["ref"]
        yield pa.RecordBatch.from_arrays([batch.column("chrom").take(pa.array(row)), pa.array(start), pa.array(start + piece["size"])], ["chrom", "start", "end"])


def _cut_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads to blocks: a block takes its own bases, qualities and marks along, not the read's."""
    names = [field.split(" ")[0] for field in _BLOCK.split(", ")]
    for batch in batches:
        row, piece = _pieces_of(batch.column("cigar"), "M=XD")
        deleted, size, read = piece["deleted"] == 1, piece["size"], piece["read"]
        start = batch.column("read_start").to_numpy()[row] + piece["ref"]
        back = batch.column("back").to_numpy(zero_copy_only=False)[row]
        seq, at = _flat(batch.column("seq"))
        own = np.minimum(at[:-1][row] + read, at[1:][row])
        bases, n = _slices(seq, own, np.where(deleted, own, np.minimum(own + size, at[1:][row])))
        qual, at = _flat(batch.column("qual"))
        none = pc.equal(batch.column("qual"), "*").fill_null(False).to_numpy(zero_copy_only=False)[row]
        own = np.minimum(at[:-1][row] + np.where(deleted, np.maximum(read - 1, 0), read), at[1:][row])
        quals, m = _slices(np.r_[qual, np.uint8(126)], own, np.minimum(own + np.where(deleted, 1, size), at[1:][row]))
        if none.any():  # the best quality for each base
            wide = np.where(none, np.where(deleted, 1, size), m)
            of, k = _spots(wide)
            first = np.cumsum(m) - m
            quals, m = np.where(none[of], np.uint8(126), np.r_[quals, np.uint8(0)][np.where(none[of], 0, first[of] + k)]), wide
        text = batch.column("seq")
        gained: list[str | None] = [None] * len(row)
        for i in np.flatnonzero((piece["gained"] > 0) & ~deleted).tolist():
            a, n_in = int(read[i] + size[i]), int(piece["gained"][i])
            inserted = text[int(row[i])].as_py()[a : a + n_in]
            gained[i] = f"+{n_in}{inserted.lower() if back[i] else inserted}"
        # Reads without a name have always gone without the mark of a deletion.
        lost = (piece["gone"] > 0) & ~deleted & batch.column("qname").is_valid().to_numpy(zero_copy_only=False)[row]
        rows = pa.array(row)
        kept = {c: batch.column(c).take(rows) for c in ("chrom", "qname", "flag", "read_start", "mapq", "back")}
        kept |= {"start": pa.array(start), "end": pa.array(start + size), "block_start": pa.array(start), "ref_end": pa.array(start + size)}
        kept |= {"goes_on": pa.array(piece["goes_on"] == 1), "deleted": pa.array(deleted), "seq": _strings(bases, n), "qual": _strings(quals, m)}
        kept |= {"gained": pa.array(gained, pa.string()), "gone_end": pa.array(start + size + piece["gone"], mask=~lost)}
        yield pa.RecordBatch.from_arrays([kept[c] for c in names], names)


def _runs(*columns: pa.Array) -> np.ndarray:
    """A number for each run of rows that agree in ``columns``, from 0."""
    new = np.zeros(len(columns[0]), bool)
    for column in columns:
        codes = pc.dictionary_encode(column, null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(new)


class _Spread:
    """Blocks with their texts, sorted by (chrom, bin, kind, read), to bases, or to sites if ``grouped``.

    Deletions' texts (kind 0) come ahead of a bin's blocks. No later block of a bin begins before its read, so
    places before the last read's start are complete: their bases go out, and blocks that reach further are held.
    """

    def __init__(self, min_quality: int, grouped: bool):
        self.min_quality, self.grouped, self.room = min_quality, grouped, BASES

    def run(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, most, floor = 0, self.room, None
        for batch in batches:
            bases = np.cumsum(batch.column("end").to_numpy() - batch.column("start").to_numpy())
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(bases, (bases[a - 1] if a else 0) + self.room, "right")))
                held.append(batch.slice(a, b - a))
                size += int(bases[b - 1] - (bases[a - 1] if a else 0))
                a = b
                if size >= most:
                    out, rest, floor = self.spread(pa.Table.from_batches(held).combine_chunks().to_batches()[0], floor, False)
                    yield out
                    held, size = [rest], int((rest.column("end").to_numpy() - rest.column("start").to_numpy()).sum())
                    most = max(self.room, 2 * size)
        if held:
            yield self.spread(pa.Table.from_batches(held).combine_chunks().to_batches()[0], floor, True)[0]

    def spread(self, rows: pa.RecordBatch, floor: int | None, final: bool) -> tuple[pa.RecordBatch, pa.RecordBatch | None, int | None]:
        get = lambda c: rows.column(c).to_numpy(zero_copy_only=False)
        run, block = _runs(rows.column("chrom"), rows.column("bin")), get("kind") == 1
        start, end, read_start = get("start"), get("end"), pc.fill_null(rows.column("read_start"), 0).to_numpy()
        low, high = start if floor is None else np.where(run == 0, np.maximum(start, floor), start), end
        rest, after = None, None
        if not final:
            last = run == run[-1]
            if block[-1]:
                after = int(read_start[-1])
                after = after if floor is None or run[-1] else max(after, floor)
                keep = last & (~block | (end > after))
                high = np.where(last, np.minimum(end, after), end)
            else:
                keep = last
            rest = rows.filter(pa.array(keep))
        n = np.where(block, np.maximum(high - low, 0), 0)
        ends = np.cumsum(n)
        before, every = ends - n, np.arange(ends[-1])
        deleted, ref_end = get("deleted").astype(bool) & block, pc.fill_null(rows.column("ref_end"), 0).to_numpy()
        stays = np.repeat(deleted, n)

        def byte(column: str, at: np.ndarray, fixed: bool) -> np.ndarray:
            """The byte of each base, a row's first one standing ``at``; 0 behind the text's end. ``fixed``: a deletion has one for all."""
            flat, of = _flat(rows.column(column))
            begin = of[:-1] + at
            place = np.repeat(begin - before, n) + every
            if fixed:
                place[stays] = np.repeat(begin, n)[stays]
            short = (n > 0) & (begin + np.where(deleted & fixed, 1, n) > of[1:])
            if not short.any():
                return flat[place]
            return np.where(place < np.repeat(of[1:], n), np.r_[flat, np.uint8(0)][np.minimum(place, len(flat))], np.uint8(0))

        into = np.where(deleted, 0, low - pc.fill_null(rows.column("block_start"), 0).to_numpy())
        qual = byte("qual", into, True)
        good = np.flatnonzero(qual >= max(self.min_quality + 33, 0)) if self.min_quality <= 222 else every[:0]
        row = np.repeat(np.arange(len(n)), n)[good]
        pos, qual, ref, base = (np.repeat(low - before, n) + every)[good], qual[good], byte("text", low - start, False)[good], byte("seq", into, True)[good]
        back = get("back").astype(bool)[row]
        letter = np.where((base == ref) & (base != ord("N")), np.where(back, np.uint8(ord(",")), np.uint8(ord("."))), np.where(back, _LOWER[base], base))
        letter[stays[good]] = ord("*")

        # Marks: the first base of a read, and behind a block's last base what follows it.
        number = np.full(len(every), -1)
        number[good] = np.arange(len(good))

        def of_rows(at: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Rows that hold the base ``at`` a place, and which base it is."""
            own = np.flatnonzero(where & (low <= at) & (at < low + n))
            base = number[before[own] + at[own] - low[own]]
            return own[base >= 0], base[base >= 0]

        headed, head = of_rows(read_start, ~deleted)
        lasting, last_base = of_rows(ref_end - 1, block)
        change, of = _flat(self.changes(rows, run, block))
        tail, follows = ~get("goes_on").astype(bool) & block, of[1:] - of[:-1]
        size = (letter > 0).astype(np.int64)
        size[head] += 2
        size[last_base] += follows[lasting] + tail[lasting]
        token, at = np.zeros(size.sum(), np.uint8), np.cumsum(size) - size
        own = at.copy()
        token[own[head]] = ord("^")
        token[own[head] + 1] = pc.fill_null(rows.column("mapq"), 0).to_numpy()[headed]
        own[head] += 2
        some = np.flatnonzero(letter)
        token[own[some]] = letter[some]
        own[some] += 1
        which, j = _spots(follows[lasting])
        token[own[last_base][which] + j] = change[of[:-1][lasting][which] + j]
        token[(at + size)[last_base[tail[lasting]]] - 1] = ord("$")
        make = self.sites if self.grouped else self.bases
        return make(rows, run, row, pos, ref, qual, token, at, size), rest, after

    @staticmethod
    def changes(rows: pa.RecordBatch, run: np.ndarray, block: np.ndarray) -> pa.Array:
        """The insertion or deletion behind each block."""
        gone_end, start = rows.column("gone_end"), rows.column("start").to_numpy()
        has = gone_end.is_valid().to_numpy(zero_copy_only=False)
        known: dict[tuple[int, int, int], str] = {}
        texts = np.flatnonzero(~block)
        for i, g, e, text in zip(run[texts].tolist(), (start[texts] + 1).tolist(), gone_end.take(pa.array(texts)).to_pylist(), rows.column("gone").take(pa.array(texts)).to_pylist(), strict=True):
            known[i, g, e] = text
        out = rows.column("gained").to_pylist()
        asked = np.flatnonzero(has & block)
        at = pa.array(asked)
        for i, r, g, e, back in zip(asked.tolist(), run[asked].tolist(), rows.column("ref_end").take(at).to_pylist(), gone_end.take(at).to_pylist(), rows.column("back").take(at).to_pylist(), strict=True):
            text = known.get((r, g, e))
            if text is not None and out[i] is None:
                out[i] = f"-{len(text)}{text.lower() if back else text}"
        return pa.array(out, pa.string())

    @staticmethod
    def bases(rows, run, row, pos, ref, qual, token, at, size) -> pa.RecordBatch:
        one, of = np.ones(len(row), np.int64), pa.array(row)
        return pa.RecordBatch.from_arrays(
            [rows.column("chrom").take(of), rows.column("bin").take(of), pa.array(pos + 1), _strings(ref, one), _strings(token, size), _strings(qual, one)]
            + [rows.column(c).take(of) for c in ("qname", "read_start", "flag")],
            [field.split(" ")[0] for field in _BASE.split(", ")],
        )

    @staticmethod
    def sites(rows, run, row, pos, ref, qual, token, at, size) -> pa.RecordBatch:
        place = run[row] << 40 | pos if len(pos) and 0 <= pos.min() and pos.max() < 1 << 40 else np.unique(np.stack([run[row], pos]), axis=1, return_inverse=True)[1]
        order = np.argsort(place, kind="stable")  # the reads of a place stay in their order
        new, other = np.ones(len(order), bool), np.diff(ref[order]) != 0
        new[1:] = np.diff(place[order]) != 0
        if (other & ~new[1:]).any():  # a place with two texts
            order = np.lexsort((ref, place))
            new[1:] = (np.diff(place[order]) != 0) | (np.diff(ref[order]) != 0)
        # Reads of equal (start, name, flag) are ordered by token and quality.
        read = _runs(rows.column("chrom"), rows.column("bin"), rows.column("kind"), rows.column("read_start"), rows.column("qname"), rows.column("flag"))[row[order]]
        equal = np.zeros(len(order) + 1, bool)
        equal[1:-1] = ~new[1:] & (read[1:] == read[:-1])
        if equal.any():
            edge = np.diff(equal.astype(np.int8))
            for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
                tied = order[a : b + 1].tolist()
                order[a : b + 1] = sorted(tied, key=lambda i: (token[at[i] : at[i] + size[i]].tobytes(), qual[i]))
        first = np.flatnonzero(new)
        depth = np.diff(first, append=len(order))
        per_site = lambda sizes: np.add.reduceat(sizes, first) if len(first) else sizes
        match, _ = _slices(token, at[order], (at + size)[order])
        named = rows.column("qname").is_valid().to_numpy(zero_copy_only=False)[row[order]]
        names = rows.column("qname").cast(pa.string()).take(pa.array(row[order[named]]))
        names = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per_site(named.astype(np.int64)))].astype(np.int32)), names)
        site = order[first]
        one = np.ones(len(site), np.int64)
        return pa.RecordBatch.from_arrays(
            [rows.column("chrom").take(pa.array(row[site])), pa.array(pos[site] + 1), _strings(ref[site], one), pa.array(depth.astype(np.int32))]
            + [_strings(match, per_site(size[order])), _strings(qual[order], depth), pc.binary_join(names, ",")],
            [field.split(" ")[0] for field in _SITE.split(", ")],
        )


# ---- as tables -------------------------------------------------------------------------------

def _placed(reads: DataFrame, genome: DataFrame, sites: DataFrame | None, min_quality: int, orphans: bool, chunk: int, grouped: bool = False) -> tuple[DataFrame, bool]:
    """What ``pileup_reads`` gives, and the ``bin`` of each place; or if ``grouped``, and neither sites are given nor reads skip, ``pileup_rows``.

    Says which, too.
    """
    flag = F.col("flag")
    paired = (flag.bitwiseAND(PAIRED) != 0) & (flag.bitwiseAND(PROPER) == 0)
    mapped = reads.where((flag.bitwiseAND(LEFT_OUT) == 0) & (F.col("cigar") != "*"))
    mapped = mapped if orphans else mapped.where(~paired)
    good = mapped.where(F.col("seq") != "*")
    good = good.select(
        F.col("reference_name").alias("chrom"), "qname", F.col("flag").cast("int").alias("flag"), F.col("pos").cast("bigint").alias("read_start"), "cigar", F.upper("seq").alias("seq"), "qual",
        (F.least(F.col("mapq"), F.lit(93)) + 33).cast("int").alias("mapq"), (flag.bitwiseAND(16) != 0).alias("back"),
    ).where(F.col("chrom").isNotNull() & F.col("read_start").isNotNull())
    # Spread in tasks of bounded size. Most runs of reads skip nothing: then no row is stored or met twice.
    # Operations alone say how many bases there are, about; the reads' bases are not needed for that.
    cigars = mapped.groupBy("cigar").agg(F.count("*").alias("n"))
    length = F.aggregate(F.regexp_extract_all("cigar", F.lit(r"(\d+)[MD=X]"), F.lit(1)), F.lit(0).cast("bigint"), lambda s, x: s + x.cast("bigint"))
    sizes = cigars.agg(F.count_if(F.col("cigar").contains("N")).alias("skips"), F.sum(F.col("n") * length).alias("bases")).first()
    grouped = grouped and sites is None and not sizes["skips"]
    blocks = good.mapInArrow(_cut_blocks, _BLOCK).withColumn("kind", F.lit(1))

    # Deleted bases, for the mark behind the base before them: they are the contig's, so a text serves all reads that lose it.
    gone = mapped.where(F.col("cigar").contains("D") & F.col("reference_name").isNotNull() & F.col("pos").isNotNull())
    gone = gone.select(F.col("reference_name").alias("chrom"), F.col("pos").cast("bigint").alias("read_start"), "cigar").mapInArrow(_cut_deletions, "chrom string, start bigint, end bigint").distinct()
    gone = _texts(gone.withColumns({"gone_start": F.col("start"), "gone_end": F.col("end")}), genome, chunk)
    gone = gone.groupBy("chrom", "gone_start", "gone_end").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), "").alias("gone"))
    gone = gone.select("chrom", (F.col("gone_start") - 1).alias("start"), F.col("gone_start").alias("end"), "gone_end", "gone", F.lit(0).alias("kind"))
    based = _texts(blocks.unionByName(gone, allowMissingColumns=True), genome, chunk, 1 + (sizes["bases"] or 0) // TASK_BASES)
    based = based.sortWithinPartitions("chrom", "bin", "kind", "read_start", "qname", "flag")
    rows = based.mapInArrow(_Spread(min_quality, grouped).run, _SITE if grouped else _BASE)
    if grouped:
        return rows, True
    if sites is not None:
        rows = rows.join(sites.select("chrom", "pos").distinct(), ["chrom", "pos"], "left_semi")
    if not sizes["skips"]:
        return rows, False
    rows = cut(rows)
    covered = rows.groupBy("chrom", "bin", "pos").agg(F.first("ref").alias("ref"))
    skips = good.where(F.col("cigar").contains("N")).select("*", F.explode(read_pieces(F.col("read_start"), F.col("cigar"))).alias("piece")).where("piece.op = 'N'")
    read, past = F.col("piece.read"), F.col("piece.ref") + F.col("piece.size")
    skips = skips.select(
        "chrom", (F.col("piece.ref") + 1).alias("from"), (past + 1).alias("to"), "back", "qname", F.col("read_start").alias("start"), "flag",
        F.when(F.col("qual") == "*", F.lit("~")).otherwise(F.substr("qual", F.greatest(read, F.lit(1)), F.lit(1))).alias("qual"),
    ).where(F.ascii("qual") - 33 >= min_quality)
    over = point_join(covered, skips, ["chrom"], "pos", ("from", "to"), _SKIP_BIN)
    skipped = over.select("chrom", "bin", "pos", "ref", F.when(F.col("back"), "<").otherwise(">").alias("token"), "qual", "qname", "start", "flag")
    return rows.unionByName(skipped), False


def pileup_reads(
    reads: DataFrame, genome: DataFrame, sites: DataFrame | None = None, min_quality: int = 13, orphans: bool = False, chunk: int = 65_536
) -> DataFrame:
    """(chrom, pos, ref, token, qual, qname, start): a row per read and place; ``pos`` counts from 1.

    ``reads`` has the fields of alignment records, ``genome`` (chrom, offset, seq) as ``gc_content`` takes it. Left out
    are unmapped, secondary, failed and duplicate reads, mates without their proper pair unless ``orphans``, reads without
    bases, bases below ``min_quality`` (of a deletion or skip, that of the base before it counts), and places without text.
    With ``sites`` (chrom, pos) only these places are given.
    """
    return _placed(reads, genome, sites, min_quality, orphans, chunk)[0].drop("bin")


def pileup_rows(
    reads: DataFrame, genome: DataFrame, sites: DataFrame | None = None, min_quality: int = 13, orphans: bool = False, chunk: int = 65_536
) -> DataFrame:
    """(chrom, pos, ref, depth, match, qual, names): the pileup format's rows, reads in the order of (start, name, flag).

    A row holds all reads of its place, as the format has it; ``pileup_reads`` gives them as rows of their own. Blocks are
    shuffled to the bin of their place, and spread and grouped there: no row per read and place is shuffled.
    """
    rows, ready = _placed(reads, genome, sites, min_quality, orphans, chunk, grouped=True)
    if ready:
        return rows
    one = F.array_sort(F.collect_list(F.struct("start", "qname", "flag", "token", "qual")))
    sites = rows.groupBy("chrom", "bin", "pos", "ref").agg(one.alias("reads"))
    joined = lambda field, by: F.array_join(F.transform("reads", lambda r: r[field]), by)
    return sites.select(
        "chrom", "pos", "ref", F.size("reads").alias("depth"), joined("token", "").alias("match"), joined("qual", "").alias("qual"), joined("qname", ",").alias("names")
    )
