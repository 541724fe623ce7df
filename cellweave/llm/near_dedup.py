"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A text's shingles are its runs of five words. A shingle weighs tf * idf with
idf = 1 + ``IDF_SHARE`` * ln((1 + N) / (1 + df)) / ln(1 + N). df is the number of documents that hold a shingle of the same
of ``2 ** HASH_BITS`` hash buckets, counted over all documents: a table of fixed size. The share is small on purpose:
with the full logarithm, a text copied into a third of all documents would weigh less than the edits of its copies.

Each text gets ``BANDS * ROWS`` consistent weighted samples (element and quantised weight), drawn from tables of
gamma and uniform variates that are looked up by multiplicative hashes of the shingle. ``ROWS`` samples make a band key.
Texts that share a band key are candidates; a pair is a link when its weighted Jaccard similarity, computed on the
whole shingle multisets, is at least ``THRESHOLD``. Classes are the components of the links (see ``classes``).

Equal texts are one node from the start. Texts never move: sampling and shingle lists are made where a text is
read. Only the shingle lists of candidates are shuffled.

Defined cases: null is the empty text; texts without words are linked to equal texts only; texts of fewer than five words
are one shingle; repeated rows are in one class; rows of one doc_id with different texts are judged by their texts;
class_id is the smallest doc_id of the class (null if all are); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.classes import linked_classes, shared_weights
from cellweave.llm.common import small_batches, stored, text_or_empty
from cellweave.llm.shingles import mixed, shingle_hashes

BANDS, ROWS, THRESHOLD = 12, 4, 0.8
HASH_BITS, IDF_SHARE = 18, 0.25
#: Candidate ids of 16 bytes, counted before they are broadcast.
BROADCAST_IDS = 1_000_000
_CHUNK = 1024
_FLUSH = 1 << 20


def digest(column: str = "text") -> Column:
    return F.unhex(F.md5(text_or_empty(column).cast("binary")))


def short_hashes(text: str) -> np.ndarray:
    """32-bit shingle hashes, sorted, repeats kept."""
    return np.sort((shingle_hashes(text) >> np.uint64(32)).astype(np.uint32))


def shingle_frequencies(documents: DataFrame) -> DataFrame:
    """bucket, df over all documents: 2 ** HASH_BITS rows at most."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(1 << HASH_BITS, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                hashes = shingle_hashes(text.as_py()) >> np.uint64(64 - HASH_BITS)
                totals[np.unique(hashes.astype(np.int64))] += 1
        found = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(found, pa.int64()), "df": pa.array(totals[found], pa.int64())})

    docs = documents.select(text_or_empty().alias("text"))
    return docs.mapInArrow(count, "bucket long, df long").groupBy("bucket").agg(F.sum("df").alias("df"))


def idf_table(documents: DataFrame) -> np.ndarray:
    found = shingle_frequencies(documents).toArrow()  # a table of fixed size
    n = documents.count()
    df = np.zeros(1 << HASH_BITS)
    df[found["bucket"].to_numpy()] = found["df"].to_numpy()
    return (1 + IDF_SHARE * np.log((1 + n) / (1 + df)) / np.log(2 + n)).astype(np.float32)


def weighted(hashes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and their weights, of a sorted list with repeats."""
    keys, tf = np.unique(hashes, return_counts=True)
    return keys, tf * idf[keys >> np.uint32(32 - HASH_BITS)]


class WeightedSampler:
    """Improved consistent weighted sampling; the same shingle and weight give the same variates everywhere."""

    def __init__(self, samples: int, seed: int = 17):
        rng = np.random.default_rng(seed)
        size = 1 << 16
        self.r = rng.gamma(2.0, 1.0, size).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, size)).astype(np.float32)
        self.beta = rng.random(size, dtype=np.float32)
        self.factors = (rng.integers(0, 1 << 31, samples, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]

    def __call__(self, keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each sample the chosen key and its quantised log weight."""
        n = len(self.factors)
        best = np.full(n, np.inf, np.float32)
        chosen, level = np.zeros(n, np.uint32), np.zeros(n, np.int32)
        logs, rows = np.log(weights).astype(np.float32), np.arange(n)
        for at in range(0, len(keys), _CHUNK):
            part, log_w = keys[at : at + _CHUNK], logs[at : at + _CHUNK]
            place = (part[None] * self.factors) >> np.uint32(16)
            r, beta = self.r[place], self.beta[place]
            t = np.floor(log_w / r + beta)
            a = self.log_c[place] - r * (t - beta + 1)
            k = a.argmin(1)
            value = a[rows, k]
            new = value < best
            best[new], chosen[new], level[new] = value[new], part[k][new], t[rows, k][new].astype(np.int32)
        return chosen, level


def band_keys(keys: np.ndarray, weights: np.ndarray, sampler: WeightedSampler, bands: int, rows: int) -> list[int]:
    if not len(keys):
        return []
    chosen, level = sampler(keys, weights)
    one = mixed(chosen.astype(np.uint64) << np.uint64(32) | level.astype(np.uint32).astype(np.uint64)).reshape(bands, rows)
    out = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for k in range(rows):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + one[:, k])
    return out.view(np.int64).tolist()


def weighted_jaccard(a: np.ndarray, b: np.ndarray, idf: np.ndarray) -> float:
    """Of two sorted hash lists with repeats."""
    ka, wa = weighted(a, idf)
    kb, wb = weighted(b, idf)
    if not len(ka) and not len(kb):
        return 1.0
    place = np.searchsorted(kb, ka)
    place[place == len(kb)] = 0
    shared = (kb[place] == ka) if len(kb) else np.zeros(len(ka), bool)
    both = np.minimum(wa[shared], wb[place[shared]]).sum()
    return float(both / (wa.sum() + wb.sum() - both))


def near_classes(
    documents: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """A row per document: doc_id, node (digest of its text), class_id, keep.

    ``keep``: it is the first of its class by (doc_id, node); rows equal in both share the answer.
    """
    spark = documents.sparkSession
    small_batches(spark)
    idf = spark.sparkContext.broadcast(idf_table(documents))
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = WeightedSampler(bands * rows)
        for batch in batches:
            keys = [band_keys(*weighted(short_hashes(t.as_py()), idf.value), sampler, bands, rows) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("node"), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "node", "keys"]
            )

    docs = documents.select("doc_id", digest().alias("node"), text_or_empty().alias("text"))
    signed = stored(docs.mapInArrow(sample, f"doc_id {id_type}, node binary, keys array<bigint>"))
    keys = signed.select("node", F.explode("keys").alias("key")).distinct()
    several = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    keys = stored(keys.join(several, "key").select("key", "node"))
    lists = stored(_shingle_lists(documents, keys.select("node").distinct()))

    def verify(pairs: DataFrame) -> DataFrame:
        def test(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = [[np.frombuffer(v.as_buffer(), np.uint32) for v in batch.column(c)] for c in ("list_a", "list_b")]
                like = [weighted_jaccard(x, y, idf.value) >= threshold for x, y in zip(*lists, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(like, pa.bool_()))

        joined = pairs.join(lists.select(F.col("node").alias("a"), F.col("shingles").alias("list_a")), "a")
        joined = joined.join(lists.select(F.col("node").alias("b"), F.col("shingles").alias("list_b")), "b")
        return joined.select("a", "b", "list_a", "list_b").mapInArrow(test, "a binary, b binary")

    def shares(chosen: DataFrame) -> DataFrame:
        def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for node, blob in zip(batch.column("node"), batch.column("shingles"), strict=True):
                    found, weights = weighted(np.frombuffer(blob.as_buffer(), np.uint32), idf.value)
                    for at in range(0, len(found), _FLUSH):
                        part = found[at : at + _FLUSH]
                        yield pa.RecordBatch.from_pydict(
                            {"node": pa.array([node.as_py()] * len(part), pa.binary()), "shingle": pa.array(part.astype(np.int64)), "w": pa.array(weights[at : at + _FLUSH].astype(float))}
                        )

        return shared_weights(stored(lists.join(chosen, "node").mapInArrow(spread, "node binary, shingle long, w double")))

    roots = linked_classes(keys, verify, shares, threshold)
    rooted = signed.select("doc_id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("first"))
    out = rooted.join(firsts, "root")
    keep = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("node") == F.col("first.node"))
    return out.select("doc_id", "node", "class_id", keep.alias("keep"))


def _shingle_lists(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, shingles (packed 32-bit hashes) of the given nodes, one row each."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [short_hashes(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(blobs, pa.binary())], ["node", "shingles"])

    if nodes.count() <= BROADCAST_IDS:
        nodes = F.broadcast(nodes)
    docs = documents.select(digest().alias("node"), text_or_empty().alias("text")).join(nodes, "node", "left_semi")
    return docs.mapInArrow(pack, "node binary, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))
