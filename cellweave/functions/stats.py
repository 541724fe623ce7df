"""Small statistical helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SERIES_TERMS, FRACTION_TERMS, SERIES_BELOW = 60, 60, 2.5


def _erfc(x: Column) -> Column:
    """Complementary error function of a value of at least 0."""
    # Near 0 the power series of erf, by Horner's rule; beyond, Laplace's continued fraction from its end.
    square = x * x
    series = F.lit(0.0)
    for n in reversed(range(SERIES_TERMS)):
        series = series * square + F.lit((-1) ** n / (math.factorial(n) * (2 * n + 1)))
    near = 1 - F.lit(2 / math.sqrt(math.pi)) * x * series
    fraction = x
    for n in reversed(range(1, FRACTION_TERMS + 1)):
        fraction = x + F.lit(n / 2) / fraction
    far = F.exp(-square) / (F.lit(math.sqrt(math.pi)) * fraction)
    return F.when(x < SERIES_BELOW, near).otherwise(far)


def normal_sf(z: Column) -> Column:
    """Upper tail of the standard normal distribution; null and NaN give null."""
    tail = _erfc(F.abs(z) / math.sqrt(2.0)) / 2
    return F.when(~F.isnan(z), F.when(z >= 0, tail).otherwise(1 - tail))


def stable_uniform(*cols, seed: int = 0) -> Column:
    """Repeatable uniform number in (0, 1) from the key columns: same row, same draw."""
    key = F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed)))
    word = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double")
    return (word + 0.5) / F.lit(float(16**13))
