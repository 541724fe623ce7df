"""Exact quantiles and FDR against plain ones, with ties, skew and odd numbers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.operators import links
from cellweave.operators.quantiles import exact_quantiles, from_ordered_bits, ordered_bits

ODD = [0.0, -0.0, 1.5, -1.5, float("inf"), float("-inf"), 5e-324, -5e-324, 1e308, 3.0, 3.0, -7.25]


def test_bits_keep_the_order(spark):
    df = spark.createDataFrame([(x,) for x in ODD], "x double").select("x", ordered_bits(F.col("x")).alias("b"))
    rows = df.select("x", "b", from_ordered_bits(F.col("b")).alias("back")).collect()
    assert all(r.x == r.back for r in rows)
    assert [r.x for r in sorted(rows, key=lambda r: r.b)] == sorted(ODD)


def test_quantiles_are_sparks(spark):
    rng = random.Random(4)
    rows = [("a", rng.choice([1.0, 2.0, rng.gauss(0, 1e6)]), i % 3) for i in range(500)] + [("b", x, None) for x in ODD] + [("c", 4.0, 7), (None, 2.0, 1), (None, 3.0, 4)]
    df = spark.createDataFrame(rows, "g string, x double, n long")
    got = exact_quantiles(df, {"mid": ("x", 0.5), "low": ("x", 0.1), "n": ("n", 0.5)}, ["g"])
    want = df.groupBy("g").agg(F.expr("percentile(x, 0.5)").alias("mid"), F.expr("percentile(x, 0.1)").alias("low"), F.median("n").alias("n"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert exact_quantiles(df, {"mid": ("x", 0.5)}, []).first().mid == df.agg(F.median("x")).first()[0]
    assert exact_quantiles(df.where("false"), {"mid": ("x", 0.5)}, []).collect() == [(None,)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "collect" not in plan


def test_fdr_of_crowded_pvalues(spark):
    rng = random.Random(6)
    p = [rng.uniform(0.4, 0.41) for _ in range(900)] + [rng.random() for _ in range(60)] + [0.001] * 20 + [0.0] * 3
    out = links.correct_fdr(spark.createDataFrame([(float(x), 1.0) for x in p] + [(0.2, -1.0)], "pval double, zscore double"))
    order = np.argsort(p)
    raw = np.array(p)[order] * len(p) / np.arange(1, len(p) + 1)
    want = dict(zip(np.array(p)[order], np.minimum(np.minimum.accumulate(raw[::-1])[::-1], 1), strict=True))
    last = {x: w for x, w in want.items()}  # of equal p the last rank counts
    rows = out.collect()
    assert len(rows) == len(p)
    assert all(r.pval_adj == pytest.approx(last[r.pval]) for r in rows)
