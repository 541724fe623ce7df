"""MinHash fingerprints of documents.

A text's shingles are its runs of five words (all words, if fewer). ``PERMUTATIONS`` universal hash functions
(a * x + b modulo 2^64, upper half) are applied to all shingles at once in numpy, and the minimum of each is kept; its
16 low bits form the fingerprint, in hexadecimal. The likeness of two fingerprints is the share of equal minima.

``similar_classes`` joins bands of the signatures in Spark, verifies candidates by the Jaccard similarity of their whole
shingle sets, and gives every document its class (see ``classes``: no bucket is ever paired up as a whole).

``edited_fingerprints`` also fingerprints each text with its second half replaced by the start of the next document's
(ascending doc_id; the first follows the last). Documents are dealt into buckets by doc_id quantiles. The first of each bucket
also goes to the bucket before it, so every document meets its successor in one sorted pass and each text
is shuffled once. Only quantiles and the buckets' smallest ids (a number per bucket) reach the driver.

Defined cases: null is the empty text; texts without words share one fingerprint; a null doc_id sorts first; rows of one
doc_id follow each other in the order of their text hash; a single document is its own successor; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.classes import linked_classes, shared_weights
from cellweave.llm.common import small_batches, stored, text_key, text_or_empty
from cellweave.llm.near_dedup import BROADCAST_IDS, digest
from cellweave.llm.shingles import mixed, shingle_hashes

PERMUTATIONS, SEED = 128, 20
BANDS, ROWS, THRESHOLD = 16, 8, 0.8
#: Buckets of documents for each shuffle partition.
BUCKETS = 2
_CHUNK = 512
_LONG_MIN = -(1 << 63)


class MinHasher:
    def __init__(self, permutations: int = PERMUTATIONS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, permutations, dtype=np.uint64)

    def __call__(self, text: str) -> np.ndarray:
        """16 bits of the minimum under each function."""
        shingles = np.unique(shingle_hashes(text) >> np.uint64(32))
        if not len(shingles):
            shingles = np.zeros(1, np.uint64)
        least = np.full(len(self.a), np.iinfo(np.uint64).max)
        for at in range(0, len(shingles), _CHUNK):
            values = shingles[at : at + _CHUNK, None] * self.a
            values += self.b
            np.minimum(least, values.min(0), out=least)
        return (mixed(least >> np.uint64(32)) & np.uint64(0xFFFF)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def _root_steps(values: list[int], key: Column, strictly: bool = False) -> Column:
    """How many of the sorted values are at most ``key``: coarse steps first, then those between two of them."""
    if not values:
        return F.lit(0)
    step = max(1, int(len(values) ** 0.5))
    whole, coarse = F.array(*map(F.lit, values)), F.array(*map(F.lit, values[::step]))
    block = F.greatest(F.size(F.filter(coarse, lambda v: v <= key)) - 1, F.lit(0))
    return block * step + F.size(F.filter(F.slice(whole, block * step + 1, F.lit(step)), lambda v: v <= key))


def _dealt(documents: DataFrame) -> DataFrame:
    """key, doc_id, text, bucket, guest: sorted by key inside a bucket, its successor last, as a guest."""
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LONG_MIN))
    keys = documents.select(key.alias("key"))
    n = parts * BUCKETS
    splits = keys.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10_000)).first()[0] or []
    splits = sorted(set(splits))
    bucketed = keys.withColumn("bucket", _root_steps(splits, F.col("key")))
    heads = sorted((r.bucket, r.head) for r in bucketed.groupBy("bucket").agg(F.min("key").alias("head")).collect())
    docs = documents.select(key.alias("key"), "doc_id", text_key().alias("text_key"), text_or_empty().alias("text"))
    docs = docs.withColumn("bucket", _root_steps(splits, F.col("key")))
    if not heads:
        return docs.withColumn("guest", F.lit(False))
    before = {b: heads[i - 1][0] for i, (b, _) in enumerate(heads)}
    most = heads[-1][0] + 1
    first = dict(heads)
    head_of = F.array(*[F.lit(first.get(b)).cast("long") for b in range(most)])
    before_of = F.array(*[F.lit(before.get(b)).cast("int") for b in range(most)])
    place = lambda b, guest: F.struct(b.cast("int").alias("bucket"), F.lit(guest).alias("guest"))
    own = place(F.col("bucket"), False)
    places = F.when(F.col("key") == F.get(head_of, F.col("bucket")), F.array(own, place(F.get(before_of, F.col("bucket")), True)))
    docs = docs.withColumn("place", F.explode(F.coalesce(places, F.array(own))))
    docs = docs.select("key", "doc_id", "text_key", "text", "place.bucket", "place.guest")
    return docs.repartition(parts, "bucket").sortWithinPartitions("bucket", "guest", "key", "text_key")


def edited_fingerprints(documents: DataFrame, permutations: int = PERMUTATIONS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per document."""

    small_batches(documents.sparkSession)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, last = MinHasher(permutations), None
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c) for c in ("doc_id", "text", "bucket", "guest")]
            for row in zip(*columns, strict=True):
                doc_id, text, bucket, guest = (v.as_py() for v in row)
                if last is not None and last[2] == bucket and not last[3]:
                    own, own_mark = last[1], last[4]
                    mark = own_mark if text == own else hasher(text)
                    cut = len(own) // 2
                    edited = own[: len(own) - cut] + text[:cut]
                    edited_mark = own_mark if edited == own else hasher(edited)
                    sha = hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest()
                    out.append((last[0], len(own), sha, own_mark.tobytes().hex(), edited_mark.tobytes().hex(), likeness(own_mark, edited_mark), likeness(own_mark, mark)))
                elif guest:
                    mark = None  # a further row of the successor's id
                else:
                    mark = hasher(text)
                last = (doc_id, text, bucket, guest, mark)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 7, types, strict=True)], names)

    id_type = documents.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [to_arrow_type(id_type), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    dealt = _dealt(documents).select("doc_id", "text", "bucket", "guest")
    schema = f"doc_id {id_type.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(compare, schema)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted lists of distinct hashes."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def similar_classes(documents: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """A row per document: doc_id and class_id, the smallest doc_id linked to it by texts of that similarity."""
    small_batches(documents.sparkSession)
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHasher(bands * rows)
        for batch in batches:
            keys = []
            for text in batch.column("text"):
                marks = hasher(text.as_py()).astype(np.uint64).reshape(bands, rows)
                key = np.arange(bands, dtype=np.uint64) + np.uint64(1)
                for k in range(rows):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + marks[:, k])
                keys.append(key.view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "node", "keys"])

    docs = documents.select("doc_id", digest().alias("node"), text_or_empty().alias("text"))
    signed = stored(docs.mapInArrow(sign, f"doc_id {id_type}, node binary, keys array<bigint>"))
    keys = signed.select("node", F.explode("keys").alias("key")).distinct()
    several = keys.groupBy("key").count().where("count > 1").select("key")
    keys = stored(keys.join(several, "key").select("key", "node"))
    sets = stored(_shingle_sets(documents, keys.select("node").distinct()))

    def verify(pairs: DataFrame) -> DataFrame:
        def test(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = [[np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(c)] for c in ("set_a", "set_b")]
                like = [jaccard(x, y) >= threshold for x, y in zip(*lists, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(like, pa.bool_()))

        joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
        joined = joined.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
        return joined.select("a", "b", "set_a", "set_b").mapInArrow(test, "a binary, b binary")

    def shares(chosen: DataFrame) -> DataFrame:
        def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for node, blob in zip(batch.column("node"), batch.column("shingles"), strict=True):
                    found = np.frombuffer(blob.as_buffer(), np.int64)
                    columns = {"node": pa.array([node.as_py()] * len(found), pa.binary()), "shingle": pa.array(found), "w": pa.array(np.ones(len(found)))}
                    yield pa.RecordBatch.from_pydict(columns)

        return shared_weights(stored(sets.join(chosen, "node").mapInArrow(spread, "node binary, shingle long, w double")))

    roots = linked_classes(keys, verify, shares, threshold)
    rooted = signed.select("doc_id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return rooted.join(rooted.groupBy("root").agg(F.min("doc_id").alias("class_id")), "root").select("doc_id", "class_id")


def _shingle_sets(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [np.unique(shingle_hashes(t.as_py())).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(blobs, pa.binary())], ["node", "shingles"])

    if nodes.count() <= BROADCAST_IDS:
        nodes = F.broadcast(nodes)
    docs = documents.select(digest().alias("node"), text_or_empty().alias("text")).join(nodes, "node", "left_semi")
    return docs.mapInArrow(pack, "node binary, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))
