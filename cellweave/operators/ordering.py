"""Numbering of sorted values without one task seeing them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.lineage import cut

_LOW = (1 << 33) - 1  # row part of monotonically_increasing_id


def global_index(df: DataFrame, column: str) -> DataFrame:
    """(column, index): 1-based position of each distinct value in sort order.

    A range-partitioned sort is checkpointed so that its partitions hold still; an offset per
    partition then completes the numbering without one task seeing all values.
    """
    ordered = cut(df.select(column).distinct().orderBy(column)).withColumn(
        "_id", F.monotonically_increasing_id()
    )
    part = F.shiftright("_id", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return ordered.withColumn("_part", part).join(offsets, "_part").select(
        column, (F.col("_id").bitwiseAND(_LOW) + F.col("_offset") + 1).alias("index")
    )
