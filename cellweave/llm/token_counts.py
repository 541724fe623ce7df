"""Token counts without token ids.

1. Every text is cut into pre-tokens, counted per document. Summed over the corpus they give the distinct
   pre-tokens with their frequency.
2. Each distinct pre-token is encoded once; only its number of pieces is kept.
3. The per-document frequencies are joined to those numbers and summed. The ``HEAD`` most frequent
   pre-tokens of at most ``HEAD_BYTES`` bytes (a bounded table, read by every task) are joined inside the
   task, so a document's frequent pre-tokens never move; the rare rest is joined by a shuffle on the
   pre-token. Both give the same numbers, and every pre-token is in one of the two.

Step 1 reads the texts again in step 3 rather than writing frequencies out: they are as large as the texts.

Defined cases: null is the empty text with no tokens; repeated rows give repeated rows; a text of any length
is one document; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from unicodedata import category

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import repeat_rows, small_batches, stored, text_key, text_or_empty, tokenizer_path

#: The pre-token pattern of the byte-level vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Every code point before U+0530 is assigned, or has been unassigned for long.
_LATER = re.compile("[^\x00-\u052f]").search
HEAD, HEAD_BYTES = 150_000, 64
_FLUSH = 150_000
_LOADED: dict[str, object] = {}


def _tokenizer(path: str):
    if path not in _LOADED:
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def special_strings(path: str) -> list[str]:
    """The strings that the tokenizer takes out of a text before it looks at anything else."""
    with open(path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f)["added_tokens"]]


class PreTokens:
    """Pre-tokens of a text, each special string being one of them.

    Character classes of code points that are younger than this Python's Unicode tables are left to the tokenizer's own
    pre-tokenizer, as libraries differ there.
    """

    def __init__(self, special: Iterable[str], path: str):
        self.pattern, self.path = regex.compile(PRE_TOKEN).findall, path
        self.special = sorted(special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None

    def find(self, text: str) -> list[str]:
        if _LATER(text) and any(category(c) == "Cn" for c in set(text)):
            return [text[a:b] for _, (a, b) in _tokenizer(self.path).pre_tokenizer.pre_tokenize_str(text)]
        return self.pattern(text)

    def __call__(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return self.find(text)
        out: list[str] = []
        for k, part in enumerate(self.split(text)):
            out += [part] if k % 2 else self.find(part)
        return out


def _texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    for value in batch.column(name):
        yield value.as_py()


def pre_token_counts(documents: DataFrame, special: list[str], path: str) -> DataFrame:
    """piece, n: every distinct pre-token of the corpus with its number of occurrences."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen = PreTokens(special, path), Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"piece": list(seen), "n": pa.array(seen.values(), pa.int64())})
            seen.clear()
            return out

        for batch in batches:
            for text in _texts(batch):
                seen.update(cut(text))
                if len(seen) > _FLUSH:
                    yield flush()
        if seen:
            yield flush()

    found = documents.select(text_or_empty().alias("text")).mapInArrow(count, "piece string, n long")
    return found.groupBy("piece").agg(F.sum("n").alias("n"))


def piece_tokens(pieces: DataFrame, path: str) -> DataFrame:
    """``pieces`` (piece, n) with ``tokens``: each distinct pre-token encoded once."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = _tokenizer(path).encode_batch_fast
        for batch in batches:
            found = encode_all(batch.column("piece").to_pylist(), add_special_tokens=False)
            tokens = pa.array([len(e) for e in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("piece"), batch.column("n"), tokens], ["piece", "n", "tokens"])

    return pieces.mapInArrow(encode, "piece string, n long, tokens long")


def _head_threshold(vocabulary: DataFrame, most: int) -> float:
    """Least frequency so that at most ``most`` pre-tokens have it or more."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16)
    sizes = vocabulary.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # some hundred rows
    total, least = 0, float("inf")
    for row in sizes:
        total += row["count"]
        if total > most:
            break
        least = row.step
    return least


def count_tokens(documents: DataFrame, tokenizer: str = "byte_bpe_50k.json", head: int = HEAD) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_tokens."""
    spark = documents.sparkSession
    small_batches(spark)
    path = tokenizer_path(tokenizer)
    special = special_strings(path)
    vocabulary = stored(piece_tokens(pre_token_counts(documents, special, path), path))
    least = _head_threshold(vocabulary, head)
    frequent = (F.floor(F.log2(F.col("n").cast("double")) * 16) >= F.lit(float(least))) & (F.octet_length("piece") <= HEAD_BYTES)
    rows = vocabulary.where(frequent).select("piece", "tokens").toArrow()  # ``head`` rows at most
    known = spark.sparkContext.broadcast(dict(zip(rows["piece"].to_pylist(), rows["tokens"].to_pylist(), strict=True)))
    rest = pa.list_(pa.struct([("piece", pa.string()), ("times", pa.int64())]))

    def join_head(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, tokens_of = PreTokens(special, path), known.value.get
        for batch in batches:
            sums, rare, times, ends = [], [], [], [0]
            for text in _texts(batch):
                total = 0
                for piece, n in Counter(cut(text)).items():
                    tokens = tokens_of(piece)
                    if tokens is None:
                        rare.append(piece)
                        times.append(n)
                    else:
                        total += n * tokens
                sums.append(total)
                ends.append(len(rare))
            entries = pa.StructArray.from_arrays([pa.array(rare, pa.string()), pa.array(times, pa.int64())], ["piece", "times"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), batch.column("n_bytes"), pa.array(sums, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)],
                schema=pa.schema([("doc_id", batch.schema.field("doc_id").type), ("text_key", pa.int64()), ("n_bytes", pa.int64()), ("tokens", pa.int64()), ("rest", rest)]),
            )

    docs = documents.select(
        "doc_id", text_key().alias("text_key"), F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), text_or_empty().alias("text")
    )
    id_type = documents.schema["doc_id"].dataType.simpleString()
    joined = docs.mapInArrow(
        join_head, f"doc_id {id_type}, text_key long, n_bytes long, tokens long, rest array<struct<piece:string,times:long>>"
    )
    # The document's own row travels with its rare pre-tokens, under a key that no pre-token has.
    own = F.struct(F.concat(F.lit("\0#"), F.col("text_key").cast("string")).alias("piece"), F.lit(None).cast("long").alias("times"))
    entries = joined.select(
        "doc_id", "text_key", "n_bytes", F.col("tokens").alias("known"), F.explode(F.concat(F.array(own), "rest")).alias("entry")
    ).select("doc_id", "text_key", "n_bytes", F.when(F.col("entry.times").isNull(), F.col("known")).alias("known"), "entry.piece", "entry.times")
    priced = entries.join(vocabulary.where(~frequent).select("piece", "tokens"), "piece", "left")
    sums = priced.groupBy("doc_id", "text_key", "n_bytes").agg(
        F.sum(F.coalesce("known", F.col("times") * F.col("tokens"))).alias("total"), F.count("known").alias("rows")
    )
    return repeat_rows(sums, "rows", ["doc_id", "n_bytes", F.expr("total div rows").alias("n_tokens")])
