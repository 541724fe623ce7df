"""Libraries that finish at different times: assign their reads to samples as files arrive.

Stands for the wait loop between the library and sample steps. The work per read is stateless, so
no watermark or state store is needed; the file source remembers which files it has taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cellweave.config import AssayConfig
from cellweave.operators.barcode import split_modalities, with_sample


def watch_tagged_reads(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def write_by_sample(
    tagged: DataFrame, sample_bc: DataFrame, cfg: AssayConfig, out: str, checkpoint: str
) -> StreamingQuery:
    """Take all files there are, write their reads by sample and tag, then stop."""
    split = split_modalities(with_sample(tagged, sample_bc), cfg)
    return (
        split.writeStream.format("parquet")
        .partitionBy("sample", "tag")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
