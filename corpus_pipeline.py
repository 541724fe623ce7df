"""The corpus pipeline: each stage reads what its predecessor kept, as a Parquet table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellweave.llm import stages
from cellweave.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.drop_toxic),
    ("near_dedup", stages.drop_near_copies),
    ("substring_dedup", stages.cut_repeated_lines),
    ("decontamination", stages.drop_contaminated),
    ("packing", stages.pack),
]

#: SQL can't express the toxicity model, the sampled signatures or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
