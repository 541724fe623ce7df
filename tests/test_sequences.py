import random

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellweave.functions import seq as S
from cellweave.functions.distance import free_divergence_series
from cellweave.functions.stats import normal_sf
from cellweave.operators.barcode import neighbour_map, prefix_map

dna = st.text("ACGT", min_size=1, max_size=9)


def fd(a, b):
    return int(free_divergence_series(pd.Series([a]), pd.Series([b]))[0])


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def prefix_distance(a, b):
    """Least edit distance between one whole string and any prefix of the other."""
    return min(
        min(lev(a[:i], b) for i in range(len(a) + 1)), min(lev(a, b[:i]) for i in range(len(b) + 1))
    )


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 9).flatmap(lambda n: st.tuples(*[st.text("ACGT", min_size=n, max_size=n)] * 2)))
def test_free_divergence_properties(pair):
    a, b = pair
    d = fd(a, b)
    assert d == fd(b, a) == prefix_distance(a, b)
    assert (d == 0) == (a == b)
    assert d <= lev(a, b)


def test_free_divergence_examples():
    assert fd("AC", "CA") == 1
    assert free_divergence_series(pd.Series(["AC"]), pd.Series(["ACG"])).isna()[0]


def test_neighbour_map_keeps_all_ties_at_the_lowest_level(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ACGT") for _ in range(5)) for _ in range(25)})
    wl = spark.createDataFrame([(w,) for w in words], "barcode string")
    for k in (1, 2):
        got = {(r.obs, r.barcode, r.d) for r in neighbour_map(wl, k).collect()}
        want = set()
        for code in range(4**5):
            obs = "".join("ACGT"[(code >> (2 * i)) & 3] for i in range(5))
            near = [(prefix_distance(obs, w), w) for w in words]
            best = min(d for d, _ in near)
            if best <= k:
                want |= {(obs, w, d) for d, w in near if d == best}
        assert got == want


def test_prefix_map_counts_candidates(spark):
    wl = spark.createDataFrame([("AAAAC",), ("CCCCGG",)], "barcode string")
    rows = {r.bc1_part: (r.n_prefix, r.shift) for r in prefix_map(wl, 4, 0).collect()}
    assert rows == {"AAAA": (1, 1), "CCCC": (1, 2)}


def test_expressions(spark):
    row = spark.createDataFrame([("AANCG", "ACGTN", "!>?@I")], "a string, b string, q string").select(
        S.reverse_complement("a").alias("rc"),
        S.hamming("a", "b").alias("h"),
        S.q30_fraction("q").alias("q"),
        S.expand_degenerate("a").alias("x"),
        S.py_slice("a", 3, 10).alias("tail"),
        S.reference_kmers("a", 3).alias("k"),
        S.reference_kmers("a", 9).alias("none"),
    ).first()
    assert row.rc == "CGNTT"
    assert row.h == 4
    assert row.q == 0.6
    assert row.x == ["AAACG", "AAGCG", "AACCG", "AATCG"]
    assert row.tail == "CG"
    assert row.k == ["AAN", "ANC"]
    assert row.none == []


def test_normal_tail(spark):
    pairs = [(3.3244360045644004, 0.00044298782232477435), (1.704937003531821, 0.04410308706567093), (0.0, 0.5)]
    got = spark.createDataFrame(pairs, "z double, p double").select(normal_sf(F.col("z")).alias("s"), "p").collect()
    assert all(np.isclose(r.s, r.p, rtol=1e-12) for r in got)
