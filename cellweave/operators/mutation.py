"""Allele counting from pileup rows, site selection and mutated alleles."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.functions.seq import cell_from_qname

# The characters that stand for one read in the pileup format.
BASES = "ACGTNacgtn.,*#><"
_MARKED = r"[^ACGTNacgtn.,*#><]"
_LONGEST = 2**31 - 1
# One step through a text: a read start with its quality, plain reads and read ends, or an indel's sign and length.
_STEP = re.compile(r"\^(?:.(.)?)?|([ACGTNacgtn.,*#><$]+)|([+-])([0-9]*)", re.DOTALL)


def _marked_text(text: str) -> tuple[str, int]:
    """Tokens of a text with read marks or indels, each behind a line feed, and their number.

    Of a read start the quality is left out, of an indel the length; what cannot be read ends the tokens.
    """
    out, n, at = [], 0, 0
    while step := _STEP.match(text, at):
        first, plain, sign, digits = step.groups()
        at = step.end()
        if plain:
            if n == 0 and plain[0] == "$":
                break
            n += len(plain) - plain.count("$")
            out.append(("\n" + "\n".join(plain)).replace("\n$", "$"))
        elif first is not None:
            n += 1
            out.append("\n^" + first)
        elif sign:
            size = digits.lstrip("0")
            size = int(size or 0) if len(size) <= 10 else _LONGEST + 1
            # A length with nothing behind it still marks its read.
            if not n or not digits or size > _LONGEST and at < len(text):
                break
            out.append(sign + text[at : at + size])
            at += size
    return "".join(out), n


@F.pandas_udf(T.StringType())
def _marked_tokens(text: pd.Series, n: pd.Series) -> pd.Series:
    """The tokens, parted by line feeds, where there are ``n``; else null."""

    def one(t, size):
        if not isinstance(t, str):
            return None
        out, found = _marked_text(t)
        return out[1:] if found == size else None

    return pd.Series([one(t, size) for t, size in zip(text, n, strict=True)], dtype=object)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, also where the optimizer writes it out in place."""
    return F.get(F.transform(F.array(value), use), 0)


def pileup_tokens(text: Column, n: Column) -> Column:
    """One token per read, marks and indels attached; null when the row cannot be parsed to ``n`` reads.

    Rows of plain characters are split as they are.
    """
    marked = text.rlike(_MARKED)
    plain = F.when(F.length(text) == n, F.when(n == 0, F.array().cast("array<string>")).otherwise(F.split(text, "")))
    # Not so in truth: it keeps the optimizer from copying the parsing into every filter behind it.
    parsed = _marked_tokens.asNondeterministic()(F.when(marked, text), n)
    return F.when(marked, F.split(parsed, "\n")).otherwise(plain)


def _supported(alleles: Column, min_reads: int, min_alleles: int) -> Column:
    """Alleles of one site with more than ``min_reads`` reads; null when the site shows too few.

    Skips do not count towards the alleles with at least ``min_reads`` reads.
    """

    def tally(every: Column) -> Column:
        return F.transform(
            F.array_distinct(every),
            lambda a: F.struct(a.alias("allele"), F.size(F.filter(every, lambda x: x.eqNullSafe(a))).alias("reads")),
        )

    def kept(tallied: Column) -> Column:
        strong = F.size(F.filter(tallied, lambda t: (t["allele"] != "S") & (t["reads"] >= min_reads)))
        enough = F.transform(F.filter(tallied, lambda t: t["reads"] > min_reads), lambda t: t["allele"])
        return F.when((strong >= min_alleles) & (F.size(enough) >= min_alleles), enough)

    return _once(alleles, lambda every: _once(tally(every), kept))


def normalise_allele(token: Column, ref: Column, strip_marks: bool = False) -> Column:
    """Reference matches become the reference base, skips S, deletions D; others stay as they are.

    With ``strip_marks`` read-start and read-end marks are removed first.
    """
    t = F.regexp_replace(token, r"\^|\$", "") if strip_marks else token
    return (
        F.when(t.isin(".", ",", "^.", "^,", ",$", ".$"), ref)
        .when(t.isin(">", "<"), "S")
        .when(t.isin("*", "#"), "D")
        .otherwise(t)
    )


def pileup_sites(pileup: DataFrame, min_depth: int, strip_marks: bool = False) -> DataFrame:
    """(chrom, pos, alleles, names): per site deep enough two arrays with one entry per read.

    Strands are merged first. Rows that do not parse are dropped alone. A site holds at most as
    many reads as the pileup depth limit, so the arrays are bounded.
    """
    text = F.replace(F.upper("match"), F.lit(","), F.lit("."))
    parsed = pileup.where(F.col("depth") >= min_depth).withColumn(
        "tokens", pileup_tokens(text, F.length("qual"))
    ).where("tokens is not null")
    return parsed.select(
        "chrom", "pos",
        F.transform("tokens", lambda t: normalise_allele(t, F.col("ref"), strip_marks)).alias("alleles"),
        F.split("names", ",").alias("names"),
    )


def _per_read(sites: DataFrame, *keep: str) -> DataFrame:
    each = sites.select("chrom", "pos", *keep, F.inline(F.arrays_zip("alleles", "names")))
    return each.where("alleles is not null and names is not null").select(
        "chrom", "pos", *keep,
        F.split_part("names", F.lit(":"), F.lit(1)).alias("cell"),
        F.col("alleles").alias("allele"),
    )


def pileup_alleles(pileup: DataFrame, min_depth: int, strip_marks: bool = False) -> DataFrame:
    """(chrom, pos, cell, allele): one row per read."""
    return _per_read(pileup_sites(pileup, min_depth, strip_marks))


def unparsed_rows(pileup: DataFrame) -> DataFrame:
    text = F.replace(F.upper("match"), F.lit(","), F.lit("."))
    return pileup.where(pileup_tokens(text, F.length("qual")).isNull()).agg(F.count("*").alias("n"))


def allele_counts(sites: DataFrame, min_reads: int, min_alleles: int = 2) -> DataFrame:
    """(chrom, pos, cell, allele, n) at the sites that show enough well-supported alleles.

    A site needs ``min_alleles`` alleles, skips aside, with at least ``min_reads`` reads; of it
    the alleles with more than ``min_reads`` reads stay, and again ``min_alleles`` of them.
    ``sites`` has one row per site, so all this is settled within the row; only the reads of kept
    alleles at kept sites are shuffled.
    """
    chosen = sites.withColumn("kept", _supported(F.col("alleles"), min_reads, min_alleles))
    each = _per_read(chosen.where("kept is not null"), "kept")
    return (
        each.where(F.array_contains("kept", F.col("allele")))
        .groupBy("chrom", "pos", "cell", "allele")
        .agg(F.count("*").alias("n"))
    )


def site_bed(counts: DataFrame) -> DataFrame:
    return counts.select(
        "chrom", (F.col("pos") - 1).alias("start"), F.col("pos").alias("end")
    ).distinct()


def major_alleles(counts: DataFrame) -> DataFrame:
    """The allele with most reads per site; the smaller name wins a tie."""
    totals = counts.groupBy("chrom", "pos", "allele").agg(F.sum("n").alias("reads"))
    w = Window.partitionBy("chrom", "pos").orderBy(F.desc("reads"), "allele")
    return totals.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(
        "chrom", "pos", F.col("allele").alias("wild_type")
    )


def mutated_alleles(tumor: DataFrame, normal: DataFrame) -> DataFrame:
    """Tumor counts whose allele differs from the major allele of the normal cells."""
    return tumor.join(major_alleles(normal), ["chrom", "pos"]).where("allele <> wild_type")


def split_by_cluster(
    reads: DataFrame, clusters: DataFrame, batch_suffix: bool = False
) -> DataFrame:
    """Mapped reads of labelled cells with their label; with a suffix, '-{batch}' joins the barcode."""
    bc = cell_from_qname("qname")
    if batch_suffix:
        bc = F.concat(bc, F.lit("-"), F.col("batch").cast("string"))
    mapped = reads.where(~F.col("is_unmapped")).withColumn("barcode", bc)
    return mapped.join(clusters.select("barcode", "label"), "barcode")
