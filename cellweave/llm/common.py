"""Helpers shared by the corpus operators: stored tables, row keys, repeated rows."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_RECORDS = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder, which becomes its setting.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and read back.

    Cuts the lineage, and survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, records: int = BATCH_RECORDS) -> None:
    """Bound the texts that stand in one Arrow batch, on either side of the pipe to Python.

    Documents run from some words to megabytes; the session's usual 10,000 rows a batch would hold hundreds of MB.
    A session that has already set fewer keeps its number.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > records:
        spark.conf.set(name, str(records))


def free_prefix(df: DataFrame) -> str:
    """Underscores that begin no column's name, for columns that an operator adds on the way."""
    prefix = "_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text") -> Column:
    """Tells rows of one id but different texts apart. Null counts as the empty text."""
    return F.xxhash64(text_or_empty(column))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def repeat_rows(df: DataFrame, times: str, columns: Iterable[str | Column]) -> DataFrame:
    """Each row ``times`` times, for inputs that hold the very same row more than once."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*columns)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
