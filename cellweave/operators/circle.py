"""Extrachromosomal circles: selection of split-read rows and counts per cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FIELDS = {"chrom": 0, "start": 1, "end": 2, "name": 3, "strand": 6, "cigar": 7, "order": 8}


def circle_columns(lines: DataFrame, column: str = "value") -> DataFrame:
    """Wide split-read rows to named columns {field}{1,2,3}: three alignments of ten fields each."""
    names = [f"f{k}" for k in range(30)]
    kinds = {rec * 10 + at: "bigint" for rec in range(3) for f, at in _FIELDS.items() if f in ("start", "end")}
    schema = ", ".join(f"{n} {kinds.get(k, 'string')}" for k, n in enumerate(names))
    # One parser call per line; quotes are ordinary characters of these fields.
    parsed = lines.select(F.from_csv(F.col(column), schema, {"sep": "\t", "quote": ""}).alias("r"))
    return parsed.select(
        *[F.col(f"r.f{rec * 10 + at}").alias(f"{field}{rec + 1}") for rec in range(3) for field, at in _FIELDS.items()]
    )


def select_circles(rows: DataFrame) -> DataFrame:
    """(chrom, start, end, cell_barcode, umi, name) of rows that close a circle.

    All three alignments share a contig and have short CIGARs, the two halves of the split read
    share a strand and the mate lies opposite. The half that comes second in the read must start
    first on the genome, and the mate must fall within the circle.
    """
    c = F.col
    shape = (
        (c("chrom1") == c("chrom2")) & (c("chrom1") == c("chrom3"))
        & (c("strand1") == c("strand2"))
        & (F.length("cigar1") <= 12) & (F.length("cigar2") <= 12) & (F.length("cigar3") <= 12)
        & (F.concat("strand1", "strand3")).isin("+-", "-+")
    )
    second_leads = (
        (c("order2") == "second") & (c("start2") < c("start1"))
        & (c("start3") >= c("start2")) & (c("end3") <= c("end1"))
    )
    first_leads = (
        (c("order1") == "second") & (c("start1") < c("start2"))
        & (c("start3") >= c("start1")) & (c("end3") <= c("end2"))
    )
    return rows.where(shape & (second_leads | first_leads)).select(
        c("chrom1").alias("chrom"),
        F.when(second_leads, c("start2")).otherwise(c("start1")).alias("start"),
        F.when(second_leads, c("end1")).otherwise(c("end2")).alias("end"),
        F.split_part("name1", F.lit(":"), F.lit(1)).alias("cell_barcode"),
        F.split_part("name1", F.lit(":"), F.lit(2)).alias("umi"),
        c("name1").alias("name"),
    )


def count_circles(circles: DataFrame) -> DataFrame:
    """Distinct UMIs per circle and cell. The distinct is a plain group, so hot circles combine early."""
    distinct = circles.select("chrom", "start", "end", "cell_barcode", "umi").distinct()
    return distinct.groupBy("chrom", "start", "end", "cell_barcode").agg(F.count("*").alias("n"))
