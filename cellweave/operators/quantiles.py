"""Exact quantiles by rank selection: no task holds a group's values, and no sort sees them all.

A double is an ordered whole number of 64 bits. Per group the values are counted by their upper 16 bits, which tells the
bin that holds the wanted rank and how many values lie below it; the values of that bin are counted by the next 16 bits,
and so on. After four counts the value itself is known. Counts combine before they are shuffled, and a group has at most
65,536 bins a pass, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.lineage import cut

BITS = 16


def ordered_bits(value: Column) -> Column:
    """A long in the order of the doubles; both zeros are one value, NaN is the greatest, null stays null."""
    number = F.coalesce(value.cast("double"), F.lit(0.0)) + F.lit(0.0)
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), number).cast("bigint")
    return F.when(value.isNotNull(), F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits))


def from_ordered_bits(key: Column) -> Column:
    bits = F.when(key < 0, key.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(key)
    return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double")


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]], by: list[str]) -> DataFrame:
    """``by`` and a column per entry of ``wanted`` (name: (value column, share)), as Spark's ``percentile`` gives them.

    Nulls are left out; a group whose values of a column are all null has null there. With no ``by`` there is one row,
    also for an empty ``df``. ``df`` is written once and read five times; groups with a null in ``by`` are kept.
    """
    shares = list(wanted.values())
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    key = F.xxhash64(F.to_json(group)) if by else F.lit(0).cast("bigint")
    items = F.array(*[F.struct(F.lit(i).alias("at"), ordered_bits(F.col(c)).alias("bits")) for i, (c, _) in enumerate(shares)])
    values = cut(df.select(*by, key.alias("_g"), items.alias("_items")))
    groups = values.groupBy(*by, "_g").agg(F.lit(1).alias("_one")) if by else values.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("_g"))
    long = values.select("_g", F.inline("_items")).where("bits is not null")
    position = F.element_at(F.array(*[F.lit(float(q)) for _, q in shares]), F.col("at") + 1) * (F.col("n") - 1)
    size = long.groupBy("_g", "at").agg(F.count(F.lit(1)).alias("n")).withColumn("position", position)
    state = size.select(
        "_g", "at", "position", F.explode(F.array(F.floor("position"), F.ceil("position"))).alias("nth")
    ).distinct().select("_g", "at", "position", "nth", F.col("nth").alias("rank"), F.lit(None).cast("bigint").alias("prefix"))
    for shift in range(64 - BITS, -1, -BITS):
        upper = F.shiftright("bits", shift)
        if shift + BITS < 64:
            prefixes = state.select("_g", "at", "prefix").distinct()
            here = long.withColumn("prefix", F.shiftright("bits", shift + BITS)).join(prefixes, ["_g", "at", "prefix"])
        else:
            here = long.withColumn("prefix", F.lit(0).cast("bigint"))
            state = state.withColumn("prefix", F.lit(0).cast("bigint"))
        bins = here.groupBy("_g", "at", "prefix", upper.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        order = Window.partitionBy("_g", "at", "prefix").orderBy("bin")
        bins = bins.withColumn("below", F.sum("n").over(order) - F.col("n"))
        met = state.join(bins, ["_g", "at", "prefix"]).where((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("n")))
        state = met.select("_g", "at", "position", "nth", (F.col("rank") - F.col("below")).alias("rank"), F.col("bin").alias("prefix"))
    found = state.select("_g", "at", "position", "nth", from_ordered_bits(F.col("prefix")).alias("value"))
    part = F.col("position") - F.floor("position")
    pair = found.groupBy("_g", "at", "position").agg(F.min_by("value", "nth").alias("low"), F.max_by("value", "nth").alias("high"))
    value = F.when(part == 0, F.col("low")).otherwise((1 - part) * F.col("low") + part * F.col("high"))
    wide = pair.groupBy("_g").agg(*[F.max(F.when(F.col("at") == i, value)).alias(name) for i, name in enumerate(wanted)])
    return groups.join(wide, "_g", "left").select(*by, *wanted)
