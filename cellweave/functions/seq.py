"""Sequence expressions built from Spark's own functions, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = ("A", "C", "G", "T")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reverse_complement(seq) -> Column:
    return F.translate(F.reverse(_col(seq)), "NACGT", "NTGCA")


def py_slice(seq, start, length) -> Column:
    """0-based slice with the same truncation at the end as a Python slice."""
    start = F.lit(start) if isinstance(start, int) else start
    length = F.lit(length) if isinstance(length, int) else length
    return F.substr(_col(seq), start + 1, length)


def gc_percent(seq) -> Column:
    seq = _col(seq)
    gc = F.length(F.regexp_replace(F.upper(seq), "[^GC]", ""))
    return F.try_divide(F.lit(100.0) * gc, F.length(seq))


def q30_fraction(qual) -> Column:
    """Share of bases whose quality character is above '>' (phred 30 at offset 33); null if empty."""
    qual = _col(qual)
    high = F.length(F.regexp_replace(qual, r"[\x00-\x3e]", ""))
    return F.try_divide(high.cast("double"), F.length(qual))


def hamming(a, b, cap: int | None = None) -> Column:
    """Mismatches over the common prefix length; ``cap`` saturates the result."""
    a, b = _col(a), _col(b)
    n = F.least(F.length(a), F.length(b))
    mismatches = F.when(n == 0, F.lit(0)).otherwise(
        F.aggregate(
            F.sequence(F.lit(1), n),
            F.lit(0),
            lambda acc, i: acc + (F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1))).cast("int"),
        )
    )
    return mismatches if cap is None else F.least(mismatches, F.lit(cap))


def deletion_variants(seq, k: int) -> Column:
    """All strings left after deleting exactly ``k`` characters.

    Two equal-length strings within ``k`` edits (Hamming, Levenshtein or free divergence)
    share at least one of these variants.
    """
    out = F.array(_col(seq))
    for _ in range(k):
        out = F.array_distinct(
            F.flatten(
                F.transform(
                    out,
                    lambda s: F.transform(
                        F.sequence(F.lit(1), F.length(s)),
                        lambda i: F.concat(
                            F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1, F.length(s))
                        ),
                    ),
                )
            )
        )
    return out


def insertion_variants(seq, k: int) -> Column:
    """All strings made by inserting ``k`` bases anywhere."""
    bases = F.array(*[F.lit(b) for b in BASES])
    out = F.array(_col(seq))
    for _ in range(k):
        out = F.array_distinct(
            F.flatten(
                F.transform(
                    out,
                    lambda s: F.flatten(
                        F.transform(
                            F.sequence(F.lit(0), F.length(s)),
                            lambda i: F.transform(
                                bases,
                                lambda b: F.concat(
                                    F.substr(s, F.lit(1), i), b, F.substr(s, i + 1, F.length(s))
                                ),
                            ),
                        )
                    ),
                )
            )
        )
    return out


def single_substitutions(seq) -> Column:
    """Every ACGT string that differs from ``seq`` at exactly one position."""
    seq = _col(seq)
    bases = F.array(*[F.lit(b) for b in BASES])
    return F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.length(seq)),
            lambda i: F.transform(
                F.filter(bases, lambda b: b != F.substr(seq, i, F.lit(1))),
                lambda b: F.concat(
                    F.substr(seq, F.lit(1), i - 1), b, F.substr(seq, i + 1, F.length(seq))
                ),
            ),
        )
    )


def expand_degenerate(seq) -> Column:
    """Replace each N by all four bases: AGN -> [AGA, AGG, AGC, AGT] in base order A, G, C, T."""
    order = F.array(*[F.lit(b) for b in ("A", "G", "C", "T")])
    return F.aggregate(
        F.split(_col(seq), ""),
        F.array(F.lit("")),
        lambda acc, ch: F.flatten(
            F.transform(
                acc,
                lambda s: F.transform(
                    F.when(ch == "N", order).otherwise(F.array(ch)), lambda b: F.concat(s, b)
                ),
            )
        ),
    )


def reference_kmers(seq, k: int = 30) -> Column:
    """k-mers starting at 0 .. len-k-1; the last possible start is left out."""
    seq = _col(seq)
    n = F.length(seq) - k
    return F.when(n <= 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(seq, i, F.lit(k)))
    )


def probe_kmers(seq, k: int = 30, offsets=None, step: int = 10) -> Column:
    """The k-mers of a read that are looked up in a k-mer set: every ``step`` bases, or at ``offsets``."""
    if offsets is not None:
        return F.array(*[py_slice(seq, o, k) for o in offsets])
    seq = _col(seq)
    starts = F.sequence(F.lit(1), F.length(seq) - k + 1, F.lit(step))
    return F.when(F.length(seq) < k, F.array().cast("array<string>")).otherwise(
        F.transform(starts, lambda i: F.substr(seq, i, F.lit(k)))
    )


def cell_from_qname(qname) -> Column:
    """Cell barcode: before the first ':', after the last '_'."""
    return F.element_at(F.split(F.split_part(_col(qname), F.lit(":"), F.lit(1)), "_"), -1)


def umi_from_qname(qname) -> Column:
    return F.split_part(_col(qname), F.lit(":"), F.lit(2))


def genome_from_contig(contig) -> Column:
    return F.split_part(_col(contig), F.lit("_"), F.lit(1))


def phred_at_least(char, q: int = 30) -> Column:
    return F.ascii(_col(char)) - 33 >= q
