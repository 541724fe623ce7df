"""BAM records as Arrow batches and back: block compression, record borders, fields, tags."""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed values of the formats: block head, end-of-file block, operation letters, 4-bit base codes, tag types.
BLOCK_HEAD = bytes.fromhex("1f8b08040000000000ff060042430200")
END_BLOCK = BLOCK_HEAD + bytes.fromhex("1b0003000000000000000000")
OPERATIONS = "MIDNSHP=X"
SPANNING = "MDN=X"
BASES = "=ACMGRSVTWYHKDBN"
TAG_NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}

BLOCK_SIZE = 0xFF00
#: Whole records that must follow each other before a place counts as a record's start.
CHAIN = 4
#: No record is longer; a larger number marks a place that is no record.
LONGEST = 1 << 28
_OPERATION = re.compile(f"(\\d+)([{OPERATIONS}])").findall
_PAIRS = np.array([[ord(a), ord(b)] for a in BASES for b in BASES], np.uint8)

RECORDS = pa.schema(
    [
        ("qname", pa.string()), ("flag", pa.int32()), ("reference_name", pa.string()), ("pos", pa.int64()), ("mapq", pa.int32()),
        ("cigar", pa.string()), ("mate_reference_name", pa.string()), ("mate_pos", pa.int64()), ("tlen", pa.int64()),
        ("seq", pa.string()), ("qual", pa.string()), ("tags", pa.string()),
    ]
)
RECORD_SCHEMA = (
    "qname string, flag int, reference_name string, pos bigint, mapq int, cigar string, mate_reference_name string, "
    "mate_pos bigint, tlen bigint, seq string, qual string, tags string"
)


def pack(data: bytes) -> bytes:
    """One block of at most BLOCK_SIZE bytes."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    return BLOCK_HEAD + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def unpack(block: bytes) -> bytes:
    """The data of a block without its BLOCK_HEAD: size, deflated data, check sum, length."""
    data = zlib.decompress(block[2:-8], -15)
    crc, size = struct.unpack("<II", block[-8:])
    if len(block) + len(BLOCK_HEAD) != struct.unpack("<H", block[:2])[0] + 1 or len(data) != size or zlib.crc32(data) != crc:
        raise ValueError("a damaged block")
    return data


def header_end(data: bytes) -> int | None:
    """Where the first record begins, or None if the header goes on behind ``data``."""
    if data[:4] != b"BAM\x01":
        raise ValueError("not a BAM file")
    try:
        at = 8 + struct.unpack_from("<i", data, 4)[0]
        n_ref = struct.unpack_from("<i", data, at)[0]
        at += 4
        for _ in range(n_ref):
            at += 8 + struct.unpack_from("<i", data, at)[0]
    except struct.error:
        return None
    return at if at <= len(data) else None


def references(header: bytes) -> list[tuple[str, int]]:
    """(name, length) of the contigs of a BAM header."""
    at = 8 + struct.unpack_from("<i", header, 4)[0]
    (n_ref,) = struct.unpack_from("<i", header, at)
    at += 4
    out = []
    for _ in range(n_ref):
        (size,) = struct.unpack_from("<i", header, at)
        out.append((header[at + 4 : at + 3 + size].decode(), struct.unpack_from("<i", header, at + 4 + size)[0]))
        at += 8 + size
    return out


def _tag_end(data: bytes, at: int, end: int) -> int | None:
    """Where the tag at ``at`` ends, or None if there is no tag that ends by ``end``."""
    if at + 4 > end or not (data[at : at + 2].isalnum() and data[at] > 57):
        return None
    kind = chr(data[at + 2])
    if kind == "A":
        return at + 4
    if kind in TAG_NUMBERS:
        at += 3 + struct.calcsize(TAG_NUMBERS[kind])
    elif kind in "ZH":
        at = data.find(0, at + 3, end) + 1
        return at or None
    elif kind == "B" and at + 8 <= end and chr(data[at + 3]) in TAG_NUMBERS:
        at += 8 + struct.calcsize(TAG_NUMBERS[chr(data[at + 3])]) * struct.unpack_from("<I", data, at + 4)[0]
    else:
        return None
    return at if at <= end else None


def _record_end(data: bytes, at: int) -> int | None:
    """The end of the record that begins at ``at``; None if its bytes say that none does, -1 if they run out."""
    if at + 36 > len(data):
        return -1
    size, ref, pos, n_name, _, _, n_cigar, _, n_seq, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    end, tags = at + 4 + size, 36 + n_name + 4 * n_cigar + (n_seq + 1) // 2 + n_seq
    if not (0 < n_name and 0 <= n_seq and min(ref, pos, mate, mate_pos) >= -1 and tags - 4 <= size < LONGEST):
        return None
    if end > len(data):
        return -1
    name = data[at + 36 : at + 35 + n_name]
    if data[at + 35 + n_name] or not all(32 < c < 127 for c in name):
        return None
    at += tags
    while at is not None and at < end:
        at = _tag_end(data, at, end)
    return end if at == end else None


def first_record(data: bytes, whole: bool) -> int | None:
    """The first place from which CHAIN records follow each other; if ``data`` is ``whole``, fewer up to its end, but one."""
    for at in range(len(data) - 36):
        # the name's closing zero is quick to test and seldom met by chance
        n_name = data[at + 12]
        if not n_name or at + 35 + n_name >= len(data) or data[at + 35 + n_name]:
            continue
        end, n = at, 0
        while n < CHAIN and (after := _record_end(data, end)) is not None:
            if after < 0:
                break
            end, n = after, n + 1
        if after is not None and (n == CHAIN or whole and n):
            return at
    return None


def record_starts(data: bytes, at: int) -> tuple[list[int], int]:
    """Where the whole records from ``at`` on begin, and where the next one would."""
    starts = []
    while at + 4 <= len(data):
        (size,) = struct.unpack_from("<i", data, at)
        if not 32 <= size < LONGEST:
            raise ValueError("a damaged record")
        if at + 4 + size > len(data):
            break
        starts.append(at)
        at += 4 + size
    return starts, at


def spans(data: bytes, starts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the contig, first base, base after the last) of each record; at least one base."""
    flat, at = np.frombuffer(data, np.uint8), np.array(starts, np.int64)
    fixed = np.ascontiguousarray(flat[at[:, None] + np.arange(36)])
    n_ops = fixed.view("<u2")[:, 8].astype(np.int64)
    raw, ends = _gather(flat, at + 36 + fixed[:, 12], 4 * n_ops)
    ops = raw.view("<u4").astype(np.int64)
    size = np.where(np.isin(ops & 15, [OPERATIONS.index(c) for c in SPANNING]), ops >> 4, 0)
    total = np.r_[0, np.cumsum(size)]
    ref, pos = fixed.view("<i4")[:, 1], fixed.view("<i4")[:, 2].astype(np.int64)
    return ref, pos, pos + np.maximum(total[ends[1:] // 4] - total[ends[:-1] // 4], 1)


def cigar_spans(cigars: list[str]) -> np.ndarray:
    """Bases of the contig that each of the CIGAR texts covers."""
    known: dict[str, int] = {}
    for text in set(cigars):
        known[text] = sum(int(n) for n, op in _OPERATION(text) if op in SPANNING)
    return np.array([known[c] for c in cigars], np.int64)


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
    return flat[at], np.r_[0, ends].astype(np.int32)


def _strings(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat)))


def _tag_text(data: bytes, at: int, end: int) -> str:
    out = []
    while at < end:
        after, kind = _tag_end(data, at, end), chr(data[at + 2])
        if after is None:
            raise ValueError("a damaged tag")
        name = data[at : at + 2].decode()
        if kind == "A":
            text = f"A:{chr(data[at + 3])}"
        elif kind in "ZH":
            text = f"{kind}:{data[at + 3 : after - 1].decode()}"
        elif kind == "B":
            of = chr(data[at + 3])
            values = struct.unpack_from(f"<{struct.unpack_from('<I', data, at + 4)[0]}{TAG_NUMBERS[of]}", data, at + 8)
            text = ",".join([f"B:{of}", *(f"{v:g}" if of == "f" else str(v) for v in values)])
        else:
            (value,) = struct.unpack_from("<" + TAG_NUMBERS[kind], data, at + 3)
            text = f"f:{value:g}" if kind == "f" else f"i:{value}"
        out.append(f"{name}:{text}")
        at = after
    return "\t".join(out)


def decode(data: bytes, starts: list[int], contigs: list[str]) -> pa.RecordBatch:
    """The records that begin at ``starts``; fields as in SAM text, but with positions from 0."""
    flat, at = np.frombuffer(data, np.uint8), np.array(starts, np.int64)
    fixed = np.ascontiguousarray(flat[at[:, None] + np.arange(36)])
    i4, u2 = fixed.view("<i4"), fixed.view("<u2")
    n_name, n_cigar, n_seq = fixed[:, 12].astype(np.int64), u2[:, 8].astype(np.int64), i4[:, 5].astype(np.int64)
    names = np.array([*contigs, "*"], object)
    name_at, cigar_at = at + 36, at + 36 + n_name
    seq_at = cigar_at + 4 * n_cigar
    qual_at = seq_at + (n_seq + 1) // 2
    tag_at, end = (qual_at + n_seq).tolist(), (at + 4 + i4[:, 0]).tolist()
    packed, ends = _gather(flat, seq_at, (n_seq + 1) // 2)
    seq = _strings(*_gather(_PAIRS[packed].reshape(-1), 2 * ends[:-1].astype(np.int64), n_seq))
    codes, ends = _gather(flat, qual_at, n_seq)
    missing = np.zeros(len(at), bool)
    missing[n_seq > 0] = codes[ends[:-1][n_seq > 0]] == 255
    qual = _strings(np.minimum(codes, 93) + np.uint8(33), ends)
    known: dict[bytes, str] = {b"": "*"}
    cigars = []
    for a, b in zip(cigar_at.tolist(), seq_at.tolist(), strict=True):
        ops = data[a:b]
        if ops not in known:
            known[ops] = "".join(f"{c >> 4}{OPERATIONS[c & 15]}" for c in struct.unpack(f"<{len(ops) // 4}I", ops))
        cigars.append(known[ops])
    none, star = n_seq == 0, pa.scalar("*")
    return pa.RecordBatch.from_arrays(
        [
            _strings(*_gather(flat, name_at, n_name - 1)),
            pa.array(u2[:, 9].astype(np.int32)),
            pa.array(names[i4[:, 1]], pa.string()),
            pa.array(i4[:, 2].astype(np.int64)),
            pa.array(fixed[:, 13].astype(np.int32)),
            pa.array(cigars, pa.string()),
            pa.array(names[i4[:, 6]], pa.string()),
            pa.array(i4[:, 7].astype(np.int64)),
            pa.array(i4[:, 8].astype(np.int64)),
            pc.if_else(pa.array(none), star, seq),
            pc.if_else(pa.array(none | missing), star, qual),
            pa.array([_tag_text(data, a, b) for a, b in zip(tag_at, end, strict=True)], pa.string()),
        ],
        schema=RECORDS,
    )


# ---- writing ---------------------------------------------------------------------------------

_CODE = {c: i for i, c in enumerate(BASES)}


def _tag_bytes(tag: str) -> bytes:
    name, kind, value = tag.split(":", 2)
    head = name.encode()
    if kind == "A":
        return head + b"A" + value.encode()
    if kind in "ZH":
        return head + kind.encode() + value.encode() + b"\0"
    if kind == "f":
        return head + b"f" + struct.pack("<f", float(value))
    if kind == "i":
        number = int(value)
        return head + (b"i" + struct.pack("<i", number) if number < 1 << 31 else b"I" + struct.pack("<I", number))
    of, *values = value.split(",")
    numbers = map(float if of == "f" else int, values)
    return head + b"B" + of.encode() + struct.pack(f"<I{len(values)}{TAG_NUMBERS[of]}", len(values), *numbers)


def region_bin(start: int, end: int) -> int:
    """The number of the smallest bin of the format's five levels that holds [start, end)."""
    last = max(end, start + 1) - 1
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if start >> shift == last >> shift:
            return first + (start >> shift)
    return 0


def encode(row, contig_at: dict[str, int]) -> bytes:
    """A record's bytes; ``row`` has the fields of RECORDS, ``contig_at`` the number of each contig and -1 for "*"."""
    ops, number = [], ""
    for c in "" if row.cigar == "*" else row.cigar:
        if c.isdigit():
            number += c
        else:
            ops.append((int(number), c))
            number = ""
    seq = "" if row.seq == "*" else row.seq
    codes = [_CODE.get(c, 15) for c in seq.upper()] + [0] * (len(seq) % 2)
    qual = bytes([255] * len(seq)) if row.qual == "*" else bytes(ord(c) - 33 for c in row.qual)
    if len(qual) != len(seq):
        raise ValueError(f"bases and qualities of {row.qname} differ in length")
    span = sum(n for n, op in ops if op in SPANNING)
    name = row.qname.encode() + b"\0"
    mate = row.reference_name if row.mate_reference_name == "=" else row.mate_reference_name
    body = struct.pack(
        "<iiBBHHHiiii", contig_at[row.reference_name], row.pos, len(name), row.mapq, region_bin(max(row.pos, 0), max(row.pos, 0) + span) if row.pos >= 0 else 4680,
        len(ops), row.flag, len(seq), contig_at[mate], -1 if row.mate_pos is None else row.mate_pos, row.tlen,
    )
    body += name + b"".join(struct.pack("<I", n << 4 | OPERATIONS.index(op)) for n, op in ops)
    body += bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True)) + qual
    body += b"".join(map(_tag_bytes, row.tags.split("\t"))) if row.tags else b""
    return struct.pack("<i", len(body)) + body


def header(contigs: list[tuple[str, int]], text: str = "") -> bytes:
    lines = text.encode()
    out = b"BAM\x01" + struct.pack("<i", len(lines)) + lines + struct.pack("<i", len(contigs))
    return out + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in contigs)
