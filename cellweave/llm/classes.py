"""Classes of linked nodes from bucket keys, without ever pairing up a whole bucket.

Nodes that share a key are candidates. A verifier says which candidate pairs are links. Classes are the
connected components of the links over the candidate pairs; a pair needs no test once its nodes are in one class.

1. Two nodes alone under a key are tested. In keys of three or more, the share of each member's weight that any other such
   member also holds bounds its likeness to all of them. Members under the threshold are settled. The others are tested
   against the key's member of the largest share, which is the likeliest centre: a star, not all pairs.
2. Members of one key that are still in different classes, one of them outside the key's largest class, are tested if an
   upper bound of their likeness reaches the threshold. The bound compares, for ``PARTS`` hash parts of the shingles, the
   weights that each of the two has in common with anyone: two texts share no more in a part than the lighter has.

So no link between candidates is lost. A key with a third of all rows thus costs a few rows per member. Components are found by alternating large and small
stars on written tables; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import stored

Verify = Callable[[DataFrame], DataFrame]
Shares = Callable[[DataFrame], DataFrame]
PARTS = 128


def _unsettled(edges: DataFrame) -> int:
    """Nodes that still have an edge too many: those with two parents, or with a parent and children."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    found = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return found.where("up > 1 or (up > 0 and down > 0)").count()


def components(edges: DataFrame) -> DataFrame:
    """node, root: every node of ``edges`` (a, b) with the smallest node of its component."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while _unsettled(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = stored(small.select("e.a", "e.b").where("a <> b").distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _pairs(a: str, b: str) -> tuple[Column, Column]:
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def shared_weights(rows: DataFrame) -> DataFrame:
    """node, weight, shared, parts of ``rows`` (node, shingle, w): what at least one other node also holds, in all and by part."""
    held = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = F.when(F.col("n").isNotNull(), F.col("w")).otherwise(0.0)
    parts = rows.join(held, "shingle", "left").groupBy("node", F.pmod("shingle", F.lit(PARTS)).alias("part"))
    parts = parts.agg(F.sum("w").alias("w"), F.sum(own).alias("own"))
    entries = F.map_from_entries(F.collect_list(F.struct(F.col("part").cast("int"), F.col("own").cast("float"))))
    out = parts.groupBy("node").agg(F.sum("w").alias("weight"), F.sum("own").alias("shared"), entries.alias("by_part"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.coalesce(F.try_element_at("by_part", p), F.lit(0.0).cast("float")))
    return out.withColumn("parts", dense).drop("by_part")


def linked_classes(keys: DataFrame, verify: Verify, shares: Shares, threshold: float) -> DataFrame:
    """node, root of every node that has a link.

    ``keys``: distinct (key, node), a stored table. ``verify``: pairs (a, b) to those that are links. ``shares``: nodes to
    their ``shared_weights``.
    """
    ends = keys.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count(F.lit(1)).alias("n"))
    many = keys.join(ends.where("n > 2").select("key"), "key")
    share = shares(many.select("node").distinct()).where(F.col("shared") >= threshold * F.col("weight"))
    share = stored(share)
    many = stored(many.join(share.drop("parts"), "node"))
    best = many.groupBy("key").agg(F.max_by("node", F.struct(F.col("shared") / F.col("weight"), "node")).alias("centre"))
    star = many.join(best, "key").where("centre <> node").select(*_pairs("centre", "node"))
    tested = stored(ends.where("n = 2").select("a", "b").unionByName(star).distinct())
    links = stored(verify(tested))
    roots = components(links)
    rooted = many.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rooted.groupBy("key", "root").count().groupBy("key").agg(
        F.max_by("root", F.struct("count", "root")).alias("major"), F.count(F.lit(1)).alias("classes")
    )
    rest = stored(rooted.join(sizes.where("classes > 1").drop("classes"), "key").join(share.select("node", "parts"), "node"))
    if rest.isEmpty():
        return roots
    x, y = rest.where("root <> major").alias("x"), rest.alias("y")
    both = F.least("x.shared", "y.shared")
    shared = F.aggregate(F.zip_with("x.parts", "y.parts", lambda p, q: F.least(p, q)), F.lit(0.0), lambda total, part: total + part)
    weights = F.col("x.weight") + F.col("y.weight")
    # A hundred-thousandth allows for the rounding of sums.
    least = (threshold - 1e-5) / (1 + threshold) * weights
    pairs = x.join(
        y,
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.root") != F.col("y.root"))
        & (both >= least)
        & (F.when(both >= least, shared) >= least),
    ).select(*_pairs("x.node", "y.node"))
    pairs = stored(pairs.distinct().join(tested, ["a", "b"], "left_anti"))
    return components(links.unionByName(verify(pairs)))
