"""The pipeline's stages: (spark, docs, sf_dir) to what is kept, with the columns of ``docs`` until the last.

Nulls, empty texts, repeated rows and further columns: as each operator's docstring says. A stage keeps every
row that its operator has nothing against.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from cellweave.llm.common import free_prefix, stored, table, text_key

#: Decisions (16 bytes each) are broadcast up to this counted number, else joined by a shuffle.
BROADCAST_KEYS = 1_000_000


def _without(docs: DataFrame, gone: DataFrame, key: Column) -> DataFrame:
    """``docs`` whose (doc_id, ``key``) is not in ``gone`` (doc_id, key)."""
    gone, same = _keys(docs, gone, key)
    gone = gone.distinct()
    if gone.count() <= BROADCAST_KEYS:
        gone = F.broadcast(gone)
    return docs.join(gone, same, "left_anti")


def _keys(docs: DataFrame, keys: DataFrame, key: Column) -> tuple[DataFrame, Column]:
    """``keys`` (doc_id, key) under names that ``docs`` has not, and the condition that a row of ``docs`` is among them."""
    at = free_prefix(docs)
    return keys.select(F.col("doc_id").alias(f"{at}id"), F.col("key").alias(f"{at}key")), F.col("doc_id").eqNullSafe(F.col(f"{at}id")) & (key == F.col(f"{at}key"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    judged = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"))
    gone = judged.where("predicted = 1").select("doc_id", F.col("text_key").alias("key"))
    return _without(docs, stored(gone), text_key())


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by doc_id, of each class of near copies. Rows of equal doc_id and text count once."""
    judged = near_dedup.near_classes(docs)
    judged = stored(judged.groupBy("doc_id", "node").agg(F.first("keep").alias("keep"), F.count(F.lit(1)).alias("rows")))
    gone = judged.where("not keep").select("doc_id", F.col("node").alias("key"))
    kept = _without(docs, gone, near_dedup.digest())
    again = judged.where("keep and rows > 1").select("doc_id", F.col("node").alias("key"))
    if again.isEmpty():
        return kept
    once = _without(kept, again, near_dedup.digest())
    keys, same = _keys(kept, again, near_dedup.digest())
    several = kept.join(keys, same, "left_semi")
    return once.unionByName(several.dropDuplicates(["doc_id", "text"]))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines of any length and spans of words that stand earlier in the corpus; a text of nothing else goes."""
    out = line_dedup.dedup_lines(docs, min_words=1, span_words=line_dedup.SPAN_WORDS).where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return out.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    met = decontaminate.benchmark_spans(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, stored(met.select("doc_id", F.col("text_key").alias("key")).distinct()), text_key())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    return packing.pack_documents(docs)
