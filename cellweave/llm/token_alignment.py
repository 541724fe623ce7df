"""Which tokens of two tokenizers cover the same bytes, and how often two ids meet in the corpus.

Both tokenizers cut space + text. Their ends in bytes are two rising lists; where both hold an end, a group of
tokens closes.

**Diagonal run skipping** (``align``). At a group's start the lists are compared at the current shift between
their indices. While ends agree, tokens stand one to one: stretches of 8, 16, 32, ... ends are compared at once,
and in the first stretch that differs the lowest bit that differs tells the place. There, the irregular group is resolved locally
by stepping over the smaller end until both agree; the difference of the indices is the next shift.

Tokens of A and B are linked if their bytes overlap: one link in a one-to-one group, na + nb - 1 in others.

1. Each text is cut and aligned once; a row per document keeps its numbers, the digest of its groups and its
   distinct id pairs with their times, as a stored table (of about the size of the texts).
2. The pairs are summed over the corpus, and each B id's highest count found, by shuffles with map-side sums.
3. Each document's pairs meet those counts: the ``HEAD`` most frequent pairs (a bounded table) inside the task,
   the rest by a shuffle on the pair. Pairs of the rest are rare, so no pair is a hot key.

**Words.** Both tokenizers cut before a space that follows a letter, digit or other visible ASCII: A's patterns hold
a space only as their first character or in a run of white space, and no piece of B has a space mark behind
another character (``_Cutter`` reads that from the vocabulary). So ids are looked up per word in a bounded cache,
and only new words go to the libraries.

Defined cases: texts that are null or empty, or whose tokens do not give the bytes of space + text in either
tokenizer, have no tokens: zeros and an empty digest. Repeated rows give repeated rows and count as often; rows
without an id are rows like others; texts of any length are one document; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import small_batches, stored, tokenizer_path

#: Ends in the first stretch that is compared at once.
PROBE = 8
#: Most frequent pairs that are looked up inside the task (9 + 8 bytes each).
HEAD = 1 << 20
#: Words, their tokens and pairs' texts that a task keeps from one batch to the next.
CACHE_WORDS, CACHE_TOKENS, CACHE_PAIRS = 300_000, 4_000_000, 200_000
_WORD_START = re.compile(r"(?<=[!-~\w])(?= .)", re.DOTALL).split
#: A space that follows something else, so that a text's spaces are not all cuts.
_BEHIND_OTHER = re.compile(r"[^!-~\w] ").search
#: Every code point before U+0530 is assigned, or has been unassigned for long; of later ones libraries differ in classes.
_LATER = re.compile("[^\x00-\u052f]").search
#: The pre-token pattern of the byte-level vocabulary.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that are encoded at once; of words whose tokens don't give their bytes, halves are tried.
TOGETHER = 512
_CUTTERS: dict[tuple[str, str], "_Cutter"] = {}
_NUMBERS = "n_a long, n_b long, n_groups long, n_links long"
SPACE_MARK = "▁"


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]]]:
    """Groups of two rising lists of int32 with one last end: (i, j, length) of each one-to-one stretch, and (i, i end, j, j end)
    of each irregular group. A stretch and an irregular group take turns; a stretch may be of length 0."""
    stretches: list[tuple[int, int, int]] = []
    groups: list[tuple[int, int, int, int]] = []
    raw_a, raw_b, list_a, list_b = ends_a.tobytes(), ends_b.tobytes(), ends_a.tolist(), ends_b.tolist()
    i = j = 0
    n_a, n_b = len(list_a), len(list_b)
    while True:
        at, by = i, j
        step = PROBE
        while True:  # longer and longer stretches, until one differs
            size = min(step, n_a - i, n_b - j)
            one, other = raw_a[4 * i : 4 * (i + size)], raw_b[4 * j : 4 * (j + size)]
            if one != other:
                if size > PROBE:
                    apart = int.from_bytes(one, "little") ^ int.from_bytes(other, "little")
                    same = ((apart & -apart).bit_length() - 1) // 32  # ends before the lowest bit that differs
                    i, j = i + same, j + same
                else:
                    while list_a[i] == list_b[j]:
                        i += 1
                        j += 1
                break
            i, j = i + size, j + size
            if size < step:
                break
            step += step
        stretches.append((at, by, i - at))
        if i == n_a:
            return stretches, groups
        at, by = i, j
        a, b = list_a[i], list_b[j]
        while a != b:
            if a < b:
                i += 1
                a = list_a[i]
            else:
                j += 1
                b = list_b[j]
        i += 1
        j += 1
        groups.append((at, i, by, j))


def links(ends_a: np.ndarray, ends_b: np.ndarray, stretches: list, groups: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A and B indices of the one-to-one links, and of those inside irregular groups."""
    i, j, n = np.array(stretches, np.int64).reshape(-1, 3).T
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    more_a: list[int] = []
    more_b: list[int] = []
    for at, end, by, last in groups:
        if end - at == 1:
            more_a += [at] * (last - by)
            more_b += range(by, last)
        elif last - by == 1:
            more_a += range(at, end)
            more_b += [by] * (end - at)
        else:
            a, b = ends_a[at:end].tolist(), ends_b[by:last].tolist()
            x = y = 0
            while x < len(a):
                more_a.append(at + x)
                more_b.append(by + y)
                over = a[x] - b[y]
                x += over <= 0
                y += over >= 0
    return np.repeat(i, n) + within, np.repeat(j, n) + within, np.array(more_a, np.int64), np.array(more_b, np.int64)


class _PairText(dict):
    """``a|b`` of a pair of ids, made once."""

    def __missing__(self, pair: int) -> str:
        self[pair] = text = f"{pair >> 32}|{pair & 0xFFFFFFFF}"
        return text


def groups_text(ids_a: np.ndarray, ids_b: np.ndarray, single: list[str], stretches: list, groups: list) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of every group; ``single`` has the texts of the one-to-one groups."""
    out: list[str] = []
    a, b = ids_a.tolist(), ids_b.tolist()
    at = 0
    for (_, _, n), (i, k, j, m) in zip(stretches, groups, strict=False):
        out += single[at : at + n]
        at += n
        left = f"{a[i]}" if k - i == 1 else f"{a[i]},{a[i + 1]}" if k - i == 2 else ",".join(map(str, a[i:k]))
        right = f"{b[j]}" if m - j == 1 else f"{b[j]},{b[j + 1]}" if m - j == 2 else ",".join(map(str, b[j:m]))
        out.append(f"{left}|{right}")
    return ";".join(out + single[at:])


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: visible Latin-1 stands for itself, others follow from 256 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Known(dict):
    """A number per word, in order of appearance; ``new`` has the words that got one since it was last emptied."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at


class _Cutter:
    """Ids and byte lengths of space + text in both tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, at in vocabulary.items():
            bytes_a[at] = bytes(letters[c] for c in token)
        # The ids of the vocabulary are the ranks of its merges, for which this library is quicker.
        self.quick = Encoding("own", pat_str=PRE_TOKEN, mergeable_ranks={t: i for i, t in enumerate(bytes_a)}, special_tokens={}).encode_ordinary
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.tables = [(table, np.array(list(map(len, table)), np.int32)) for table in (bytes_a, bytes_b)]
        #: Whether no piece joins a space to what stands before it.
        self.by_word = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        self._forget()

    def _forget(self) -> None:
        self.words = _Known()
        self.whole = np.empty(0, bool)
        #: For A and B: where each word's tokens begin and how many they are, all ids and their byte lengths.
        self.starts = [np.empty(0, np.int64)] * 2
        self.counts = [np.empty(0, np.int64)] * 2
        self.ids = [np.empty(0, np.int32)] * 2
        self.sizes = [np.empty(0, np.int32)] * 2

    def words_of(self, text: str) -> list[str]:
        """What stands between the spaces at which both tokenizers cut."""
        spaced = " " + text
        if not self.by_word:
            return [text]
        if text.endswith(" ") or _BEHIND_OTHER(spaced):
            return [w[1:] for w in _WORD_START(spaced)]
        return text.split(" ")

    def _tokens(self, words: list[str]) -> tuple[np.ndarray, list[tuple]]:
        """Whether each word's tokens give its bytes, and per tokenizer the numbers of tokens, ids and byte lengths."""
        text = " ".join(words)
        spelled = (" " + text).encode()
        sizes = np.array(list(map(len, map(str.encode, words)))) + 1
        ids_a = self.a.encode(" " + text, add_special_tokens=False).ids if _LATER(text) else self.quick(" " + text)
        found = (ids_a, self.b.encode(text))
        sides = []
        for ids, (table, size_of) in zip(found, self.tables, strict=True):
            token = np.array(ids, np.int32)
            ends = np.cumsum(size_of[token])
            at = np.searchsorted(ends, np.cumsum(sizes))
            if b"".join(map(table.__getitem__, ids)) != spelled or (ends[at] != np.cumsum(sizes)).any():
                break
            sides.append((np.diff(np.r_[0, at + 1]), token, size_of[token]))
        if len(sides) == 2:
            return np.ones(len(words), bool), sides
        if len(words) == 1:
            return np.zeros(1, bool), [(np.zeros(1, np.int64), np.empty(0, np.int32), np.empty(0, np.int32))] * 2
        half = len(words) // 2
        (one, left), (other, right) = self._tokens(words[:half]), self._tokens(words[half:])
        return np.concatenate([one, other]), [tuple(map(np.concatenate, zip(x, y, strict=True))) for x, y in zip(left, right, strict=True)]

    def _learn(self) -> None:
        """New words with a clear end are encoded together, as the cut at the next space divides them; others one by one."""
        words = self.words.new
        self.words.new = []
        kinds: list[list[int]] = [[], []]
        parts = []
        for i, w in enumerate(words):
            if "!" <= w[-1:] <= "~" or w[-1:].isalnum():
                kinds[bool(_LATER(w))].append(i)
            else:
                parts.append([i])
        parts += [kind[i : i + TOGETHER] for kind in kinds for i in range(0, len(kind), TOGETHER)]
        order = np.array([i for part in parts for i in part])
        found = [self._tokens([words[i] for i in part]) for part in parts]
        whole = np.empty(len(words), bool)
        whole[order] = np.concatenate([x for x, _ in found])
        self.whole = np.concatenate([self.whole, whole])
        for side in range(2):
            n, ids, sizes = (np.concatenate(x) for x in zip(*(sides[side] for _, sides in found), strict=True))
            starts, counts = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
            counts[order] = n
            starts[order] = len(self.ids[side]) + np.cumsum(n) - n
            for own, more in ((self.starts, starts), (self.counts, counts), (self.ids, ids), (self.sizes, sizes)):
                own[side] = np.concatenate([own[side], more])

    def __call__(self, texts: list[str]) -> Iterator[tuple | None]:
        """(ids of A, their ends, ids of B, their ends) of space + each text; None if there are no tokens."""
        if len(self.words) > CACHE_WORDS or len(self.ids[0]) + len(self.ids[1]) > CACHE_TOKENS:
            self._forget()
        number = self.words.__getitem__
        found = [np.array(list(map(number, self.words_of(t))) if t else [], np.int64) for t in texts]
        if self.words.new:
            self._learn()
        for at in found:
            if not len(at) or not self.whole[at].all():
                yield None
                continue
            out = []
            for starts, counts, ids, sizes in zip(self.starts, self.counts, self.ids, self.sizes, strict=True):
                n = counts[at]
                token = np.arange(n.sum()) + np.repeat(starts[at] - (np.cumsum(n) - n), n)
                out += [ids[token].astype(np.int64), np.cumsum(sizes[token], dtype=np.int32)]
            yield tuple(out)


def _cutter(path_a: str, path_b: str) -> _Cutter:
    """One for all tasks of a Python worker, one after another."""
    if (path_a, path_b) not in _CUTTERS:
        _CUTTERS[path_a, path_b] = _Cutter(path_a, path_b)
    return _CUTTERS[path_a, path_b]


def aligned_documents(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per document: doc_id, the numbers of tokens, groups and links, groups_sha256, and its distinct pairs with their times."""
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, text_of = _cutter(path_a, path_b), _PairText()
        for batch in batches:
            numbers, digests, pairs, times, ends = [], [], [], [], [0]
            if len(text_of) > CACHE_PAIRS:
                text_of.clear()
            for found in cutter(batch.column("text").to_pylist()):
                if found is None:
                    numbers.append((0, 0, 0, 0))
                    digests.append("")
                    ends.append(ends[-1])
                    continue
                ids_a, ends_a, ids_b, ends_b = found
                stretches, groups = align(ends_a, ends_b)
                one_a, one_b, more_a, more_b = links(ends_a, ends_b, stretches, groups)
                single = ids_a[one_a] << 32 | ids_b[one_b]
                text = groups_text(ids_a, ids_b, list(map(text_of.__getitem__, single.tolist())), stretches, groups)
                digests.append(hashlib.sha256(text.encode()).hexdigest())
                linked = np.concatenate([single, ids_a[more_a] << 32 | ids_b[more_b]])
                numbers.append((len(ids_a), len(ids_b), len(single) + len(groups), len(linked)))
                pair, n = np.unique(linked, return_counts=True)
                pairs.append(pair)
                times.append(n)
                ends.append(ends[-1] + len(pair))
            entries = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (pairs, times)], ["pair", "times"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")]
                + [pa.array([x[k] for x in numbers], pa.int64()) for k in range(4)]
                + [pa.array(digests, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"],
            )

    return documents.select("doc_id", "text").mapInArrow(
        work, f"doc_id {id_type}, {_NUMBERS}, groups_sha256 string, pairs array<struct<pair:long,times:long>>"
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (its links in the corpus), best (no pair of the same B id has more)."""
    entries = aligned.select(F.explode("pairs").alias("entry")).select("entry.pair", "entry.times")
    counted = stored(entries.groupBy("pair").agg(F.sum("times").alias("n")))
    of_b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    highest = counted.groupBy(of_b).agg(F.max("n").alias("highest"))  # a row per id of B
    return counted.select("pair", "n", of_b).join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _least_of_head(counts: DataFrame, most: int) -> float:
    """The least count so that at most ``most`` pairs have it or more; counts are taken by their logarithm."""
    sizes = counts.groupBy("step").count().orderBy(F.desc("step")).collect()  # some hundred rows
    total, least = 0, float("inf")
    for row in sizes:
        total += row["count"]
        if total > most:
            break
        least = row.step
    return least


def align_tokens(
    documents: DataFrame, tokenizer_a: str = "byte_bpe_50k.json", tokenizer_b: str = "piece_bpe_32k.model", head: int = HEAD
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: a row per document."""
    spark = documents.sparkSession
    small_batches(spark)
    aligned = stored(aligned_documents(documents, tokenizer_path(tokenizer_a), tokenizer_path(tokenizer_b)))
    step = F.floor(F.log2(F.col("n").cast("double")) * 16)
    counts = stored(pair_counts(aligned).withColumn("step", step))
    least = _least_of_head(counts, head)
    frequent = F.col("step") >= F.lit(float(least))
    rows = counts.where(frequent).select("pair", "n", "best").toArrow()  # ``head`` rows at most
    order = np.argsort(rows["pair"].to_numpy(), kind="stable")
    known = spark.sparkContext.broadcast(tuple(rows[c].to_numpy()[order] for c in ("pair", "n", "best")))
    rare = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))
    kept = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def join_head(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counted, best = known.value
        for batch in batches:
            lists = batch.column("pairs")
            bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            entries = lists.flatten()
            pair, times = (entries.field(k).to_numpy() for k in (0, 1))
            of = np.repeat(np.arange(len(lists)), np.diff(bounds))
            at = np.minimum(np.searchsorted(keys, pair), max(0, len(keys) - 1))
            met = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            sums, bests = np.zeros(len(lists), np.int64), np.zeros(len(lists), np.int64)
            np.add.at(sums, of[met], times[met] * counted[at[met]])
            np.add.at(bests, of[met], times[met] * best[at[met]])
            left = np.r_[0, np.cumsum(np.bincount(of[~met], minlength=len(lists)))].astype(np.int32)
            rest = pa.StructArray.from_arrays([pa.array(pair[~met]), pa.array(times[~met])], ["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "row", *kept)]
                + [pa.array(bests), pa.array(sums), pa.ListArray.from_arrays(pa.array(left), rest).cast(rare)],
                ["doc_id", "row", *kept, "n_best", "count_sum", "rest"],
            )

    numbered = aligned.withColumn("row", F.monotonically_increasing_id())
    id_type = documents.schema["doc_id"].dataType.simpleString()
    own = f"doc_id {id_type}, row long, {_NUMBERS}, groups_sha256 string, n_best long, count_sum long"
    joined = stored(numbered.mapInArrow(join_head, f"{own}, rest array<struct<pair:long,times:long>>"))
    entries = joined.select("row", F.explode("rest").alias("entry")).select("row", "entry.pair", "entry.times")
    more = (
        entries.join(counts.where(~frequent), "pair")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    )
    out = joined.drop("rest").join(more, "row", "left")
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
