"""Writers. Every one writes a directory of part files; sorted ones read in order when joined."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.lineage import cut
from cellweave.operators.ordering import global_index
from cellweave.sources import bgzf


def write_matrix_market(
    matrix: DataFrame, path: str, feature: str, cell: str = "cell_barcode",
    kind: str = "real", feature_file: str = "genes", features: DataFrame | None = None,
) -> DataFrame:
    """count.mtx (feature by cell), the feature list and barcodes, each a directory of parts.

    Joining the parts of count.mtx in name order gives a valid Matrix Market file. ``features`` are the rows to
    number, those of the matrix itself if not given. Returns them with their row number (``feature``, index).
    """
    rows = cut(global_index(matrix if features is None else features, feature))
    cols = cut(global_index(matrix, cell))
    body = matrix.join(rows.withColumnRenamed("index", "_r"), feature).join(
        cols.withColumnRenamed("index", "_c"), cell
    )
    value = F.col("value").cast("bigint" if kind == "integer" else "double").cast("string")
    lines = body.select("_r", "_c", F.concat_ws(" ", F.col("_r").cast("string"), F.col("_c").cast("string"), value).alias("value"))
    size = matrix.agg(F.count("*").alias("n")).select(
        F.concat_ws(
            " ",
            rows.agg(F.count("*").alias("n")).scalar().cast("string"),
            cols.agg(F.count("*").alias("n")).scalar().cast("string"),
            F.col("n").cast("string"),
        ).alias("size")
    )
    banner = f"%%MatrixMarket matrix coordinate {kind} general"
    head = size.select(
        F.posexplode(F.array(F.lit(banner), F.lit("%"), "size")).alias("_c", "value")
    ).select(F.lit(0).cast("bigint").alias("_r"), F.col("_c").cast("bigint").alias("_c"), "value")
    _ordered_text(head.unionByName(lines), ["_r", "_c"], f"{path}/count.mtx")
    _ordered_text(rows.withColumnRenamed(feature, "value"), ["index"], f"{path}/{feature_file}.txt")
    _ordered_text(cols.withColumnRenamed(cell, "value"), ["index"], f"{path}/barcodes.txt")
    return rows


def _ordered_text(df: DataFrame, order: list[str], path: str) -> None:
    df.orderBy(*order).select("value").write.mode("overwrite").text(path)


def fastq_lines(name: Column, seq: Column, qual: Column) -> Column:
    return F.concat_ws("\n", name, seq, F.lit("+"), qual)


def write_fastq(tagged: DataFrame, path: str, by: tuple[str, ...] = ("sample", "tag")) -> None:
    """R1 and R2 under {path}/R1 and /R2, partitioned by sample and tag; mates stay in step.

    Both mates are sorted by (partition columns, library, ordinal), which is unique, so line numbers agree per
    directory. A single library needs no ``lib_id``.
    """
    from cellweave.operators.barcode import packed_name

    order = [*by, *[c for c in ("lib_id", "ordinal") if c in tagged.columns]]
    ranged = tagged.repartitionByRange(*order).sortWithinPartitions(*order)
    for k in (1, 2):
        record = fastq_lines(packed_name(f"name{k}"), F.col(f"seq{k}"), F.col(f"qual{k}"))
        ranged.select(*by, record.alias("value")).write.mode("overwrite").partitionBy(*by).text(f"{path}/R{k}")


def write_stats(stats: DataFrame, path: str) -> None:
    """key<TAB>value lines."""
    stats.select(F.concat_ws("\t", "key", F.col("value").cast("string")).alias("value")).write.mode(
        "overwrite"
    ).text(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").options(header=True, sep=sep).csv(path)


def write_bed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").csv(path)


def write_links(links: DataFrame, path: str, pval: float = 0.05) -> None:
    """{path}.all with p below the cutoff and {path}.accepted at the FDR level."""
    write_csv(links.where(F.col("pval") < pval), f"{path}.all", "\t")
    write_csv(links.where("accept"), f"{path}.accepted", "\t")


def _tags(reads: DataFrame) -> Column:
    """The tags of a record, with its barcodes as CB and UB where it has none."""
    own = F.col("tags") if "tags" in reads.columns else F.lit(None).cast("string")
    bare = F.concat(F.lit("\t"), F.coalesce(own, F.lit("")))
    added = [
        F.when(~bare.contains(f"\t{tag}:"), F.concat(F.lit(f"{tag}:Z:"), c)) for tag, c in (("CB", "cell_barcode"), ("UB", "umi")) if c in reads.columns
    ]
    return F.concat_ws("\t", F.nullif(own, F.lit("")), *added)


def alignment_fields(reads: DataFrame) -> DataFrame:
    """The fields of an alignment record; mate fields that ``reads`` lacks say that there is none."""
    have = lambda c, default: F.col(c) if c in reads.columns else F.lit(default)
    return reads.withColumns(
        {
            "mate_reference_name": F.coalesce(have("mate_reference_name", "*"), F.lit("*")),
            "mate_pos": F.coalesce(have("mate_pos", -1).cast("bigint"), F.lit(-1)),
            "tags": _tags(reads),
        }
    )


def write_sam(reads: DataFrame, contigs: DataFrame, path: str, by: str | None = None) -> None:
    """SAM lines with mate fields and tags (CB and UB among them), in position order, under an @SQ header.

    With ``by`` (such as a cluster label) the rows go to one directory per value, without header.
    """
    reads = alignment_fields(reads)
    mate = F.when((F.col("mate_reference_name") == F.col("reference_name")) & (F.col("mate_reference_name") != "*"), "=").otherwise(F.col("mate_reference_name"))
    fields = [
        "qname", F.col("flag").cast("string"), "reference_name", (F.col("pos") + 1).cast("string"),
        F.col("mapq").cast("string"), "cigar", mate, (F.col("mate_pos") + 1).cast("string"), F.col("tlen").cast("string"),
        "seq", "qual", F.nullif("tags", F.lit("")),
    ]
    line = F.concat_ws("\t", *fields).alias("value")
    if by is not None:
        reads.select(by, line).write.mode("overwrite").partitionBy(by).text(path)
        return
    head = contigs.select(
        F.lit("").alias("_chrom"), F.lit(0).cast("bigint").alias("_pos"),
        F.concat_ws("\t", F.lit("@SQ"), F.concat(F.lit("SN:"), "chrom"), F.concat(F.lit("LN:"), F.col("size").cast("string"))).alias("value"),
    )
    body = reads.select(F.col("reference_name").alias("_chrom"), F.col("pos").alias("_pos"), line)
    _ordered_text(head.unionByName(body), ["_chrom", "_pos"], path)


def write_bam(reads: DataFrame, contigs: DataFrame, path: str, by: str | None = None) -> None:
    """BAM files with mate fields and tags (CB and UB among them), sorted by position; contigs keep the order given.

    The rows are dealt by range of (``by``, contig, position), so a large label or contig is shared by several tasks; every
    part file is a BAM file of its own, and in name order they are one sorted whole. With ``by`` each value has a
    directory ``by=value``. Files appear when all tasks have ended; a failed write leaves none.
    """
    from cellweave.sources.bam_sink import BamSink

    sizes = [(r.chrom, r["size"]) for r in contigs.select("chrom", "size").collect()]  # a header's contigs
    place = F.create_map(*[F.lit(x) for i, (n, _) in enumerate(sizes) for x in (n, i)]) if sizes else F.lit(None).cast("map<string,int>")
    rows = alignment_fields(reads).withColumn("_contig", F.coalesce(F.try_element_at(place, F.col("reference_name")), F.lit(len(sizes))))
    order = [*([by] if by else []), "_contig", "pos", "qname", "flag"]
    label = F.col(by).cast("string") if by else F.lit(None).cast("string")
    ready = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(label.alias("label"), *bgzf.RECORDS.names)
    spark = reads.sparkSession
    spark.dataSource.register(BamSink)
    text = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{size}\n" for n, size in sizes)
    ready.write.format("bam_files").mode("overwrite").options(path=path, by=by or "", contigs=json.dumps(sizes), header=text).save()


def write_combined_genome(lines: DataFrame, path: str) -> None:
    _ordered_text(lines, ["file", "line_no"], path)


def write_combined_gtf(gtf: DataFrame, feature: str, path: str) -> None:
    """Rows of one feature with the species-prefixed contig names, tab separated with a header."""
    write_csv(gtf.where(F.col("Feature") == feature).drop("ordinal"), path, "\t")
