"""Registered queries that write whole views as files of each format and work on what is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.lineage import cut, scratch
from cellweave.operators import atac, correlation, links, pileup
from cellweave.plans import views as V
from cellweave.plans.catalog import _HISTO, ORACLES, _register
from cellweave.sources import alignments, bam_regions, bgzf, fasta, sinks, tables
from cellweave.streaming import molecules as streaming

# Records with flags, operations, bases, qualities and a mate.
RECORD = f"""
select qname, cell_barcode, umi,
       cast((case when is_proper_pair then 2 else 0 end) + (case when is_unmapped then 4 else 0 end) + (case when mate_is_unmapped then 8 else 0 end)
            + (case when is_reverse then 16 else 0 end) + (case when is_read1 then 64 else 128 end) + (case when is_secondary then 256 else 0 end) as int) as flag,
       reference_name, pos, cast(mapq as int) as mapq,
       case pos%4 when 0 then '30M' when 1 then '10M200N20M' when 2 then '5S20M2I3M' else '12M4D18M' end as cigar,
       case when pos%5 = 0 then '*' else reference_name end as mate_reference_name,
       case when pos%5 = 0 then cast(-1 as bigint) else pos + 25 end as mate_pos, tlen,
       substring({V.dna("qname")}, 1, 30) as seq,
       substring(translate(md5('q' || qname), '0123456789abcdef', '#,:;<=>?@ABCDEFG'), 1, 30) as qual,
       'NH:i:' || cast(mapq as string) as tags
from ({V.ALIGNMENT}) a
"""
REC = V.oracle_text(RECORD)
_FIELDS = [c for c in bgzf.RECORDS.names if c != "tags"]


def _contigs(reads):
    return reads.groupBy(F.col("reference_name").alias("chrom")).agg((F.max("pos") + 100_000).alias("size")).orderBy("chrom")


def _round_trip_sql() -> str:
    return f"""select {", ".join(_FIELDS)}, tags || chr(9) || 'CB:Z:' || cell_barcode || chr(9) || 'UB:Z:' || umi as tags,
        cell_barcode, umi, split_part(reference_name, '_', 1) as genome, case when (flag & 16) > 0 then '-' else '+' end as strand,
        pos + case pos%4 when 0 then 30 when 1 then 230 when 2 then 23 else 34 end as read_end from ({REC}) r"""


def _decoded(reads):
    return reads.select(*bgzf.RECORDS.names, "cell_barcode", "umi", "genome", "strand", "read_end")


@_register("bam_round_trip", _round_trip_sql())
def bam_round_trip(spark, sf):
    reads = cut(V.view(spark, sf, RECORD))
    path = scratch(spark, "bam")
    sinks.write_bam(reads, _contigs(reads), path)
    return _decoded(alignments.read_bam(spark, f"{path}/*.bam"))


@_register("sam_round_trip", _round_trip_sql())
def sam_round_trip(spark, sf):
    reads = cut(V.view(spark, sf, RECORD))
    path = scratch(spark, "sam")
    sinks.write_sam(reads, _contigs(reads), path)
    return _decoded(alignments.read_sam(spark, path))


@_register(
    "bam_by_label",
    f"select case when is_reverse then 'minus' else 'plus' end as label, cast(count(*) as bigint) as reads, cast(sum(pos) as bigint) as places from ({V.oracle_text(V.ALIGNMENT)}) a group by 1",
)
def bam_by_label(spark, sf):
    reads = cut(V.view(spark, sf, RECORD).withColumn("label", F.when(F.col("flag").bitwiseAND(16) > 0, "minus").otherwise("plus")))
    path = scratch(spark, "labels")
    sinks.write_bam(reads, _contigs(reads), path, by="label")
    out = None
    for label in ("minus", "plus"):
        part = alignments.read_bam(spark, f"{path}/label={label}/*.bam").agg(
            F.lit(label).alias("label"), F.count("*").alias("reads"), F.sum("pos").alias("places")
        )
        out = part if out is None else out.unionByName(part)
    return out


@_register("tss_histogram_indexed", _HISTO)
def tss_histogram_indexed(spark, sf):
    reads = cut(V.view(spark, sf, RECORD))
    path = scratch(spark, "indexed")
    sinks.write_bam(reads, _contigs(reads), f"{path}/bam")
    bam_regions.index_bam(spark, f"{path}/bam/*.bam", f"{path}/index")
    tss = V.view(spark, sf, V.TSS)
    # The view's reads are known by their first base, so their ends stay out of the join.
    near = bam_regions.fetch_reads(spark, f"{path}/index", atac.tss_regions(tss)).drop("read_end")
    return atac.tss_insertions(near, tss)


_RDP = V.oracle_text(V.READ_PAIR)


@_register(
    "fastq_round_trip",
    f"""select 1 as mate, name1 as name, seq1 as seq, qual1 as qual from ({_RDP}) a
        union all select 2, name2, seq2, qual2 from ({_RDP}) b""",
)
def fastq_round_trip(spark, sf):
    pairs = cut(V.view(spark, sf, V.READ_PAIR))
    path, out = scratch(spark, "fastq"), None
    for k in (1, 2):
        lines = sinks.fastq_lines(*[F.col(f"{c}{k}") for c in ("name", "seq", "qual")])
        pairs.orderBy("ordinal").select(lines.alias("value")).write.text(f"{path}/R{k}")
        side = tables.read_fastq(spark, f"{path}/R{k}").select(F.lit(k).alias("mate"), "name", "seq", "qual")
        out = side if out is None else out.unionByName(side)
    return out


# Contigs of 64,000 bases in lines of 64, a line per order; a peak runs over the end of a line.
_LINE = f"{V.dna('concat(\'s\', cast(o_orderkey as string))')} || {V.dna('concat(\'t\', cast(o_orderkey as string))')}"


@_register(
    "gc_content_of_fasta",
    f"""with l as (select o_orderkey as k, {_LINE} as seq from orders)
    select 'p' || a.k as peak, round(100.0 * length(regexp_replace(substring(a.seq || b.seq, 21, 60), '[^GC]', '', 'g')) / 60, 6) as gc_content
    from l a join l b on b.k = a.k + 1 where a.k % 10 = 5""",
)
def gc_content_of_fasta(spark, sf):
    k = F.col("o_orderkey")
    head = F.when(k % 1000 == 0, F.concat(F.lit(">c"), F.floor(k / 1000).cast("string"), F.lit(" text\n"))).otherwise("")
    lines = V.table(spark, sf, "orders").select(F.floor(k / 1000).alias("contig"), k.alias("k"), F.concat(head, F.expr(_LINE)).alias("value"))
    path = scratch(spark, "fasta")
    lines.repartitionByRange("contig").sortWithinPartitions("k").select("value").write.text(path)
    start = (k % 1000) * 64 + 20
    peaks = V.table(spark, sf, "orders").where(k % 10 == 5).select(
        F.concat(F.lit("p"), k.cast("string")).alias("peak"), F.concat(F.lit("c"), F.floor(k / 1000).cast("string")).alias("chrom"),
        start.alias("start"), (start + 60).alias("end"),
    )
    return links.gc_content(peaks, fasta.read_genome(spark, path)).withColumn("gc_content", F.round("gc_content", 6))


_EXP = V.oracle_text(V.EXPRESSION)


@_register(
    "similar_genes_of_expression",
    f"""with e as ({_EXP}), cells as (select distinct cell from e), genes as (select distinct gene_id from e),
    dense as (select gene_id, cell, coalesce(value, 0.0) as v from genes cross join cells left join e using (gene_id, cell)),
    c as (select a.gene_id as gene, b.gene_id as other, round(corr(a.v, b.v), 9) as corr from dense a join dense b on a.cell = b.cell group by 1, 2)
    select gene, other, corr, cast(row_number() over (w) as integer) as rank from c window w as (partition by gene order by corr desc, other) qualify row_number() over (w) <= 10""",
)
def similar_genes_of_expression(spark, sf):
    return correlation.similar_genes(V.view(spark, sf, V.EXPRESSION), 10, digits=9)


# Reads of 20 bases on contigs of 64,000, three forms of operations, two bases unlike the contig's.
_READS = f"""
select 'c' || cast(l_suppkey%9 as string) || ':U:' || cast(l_orderkey as string) || '.' || cast(l_linenumber as string) as qname, l_orderkey as k,
       cast(case when l_partkey%2=0 then 16 else 0 end as int) as flag, cast(20 + l_partkey%40 as int) as mapq, cast(l_linenumber%3 as int) as form,
       substring({V.dna("'m' || cast(l_partkey%50 as string)")}, 1, 2) as odd,
       substring(translate(md5('q' || cast(l_partkey as string)), '0123456789abcdef', '&*:;<=>?@ABCDEFG'), 1, 20) as qual
from {{lineitem}}
"""
# Form 0: 20M. Form 1: 8M2I10M, the inserted bases being ``odd``. Form 2: 8M3D12M. Base 5 (from 0) is the first of ``odd``.
_SEQ = """case form when 0 then substring(t, 1, 5) || substring(odd, 1, 1) || substring(t, 7, 14)
    when 1 then substring(t, 1, 5) || substring(odd, 1, 1) || substring(t, 7, 2) || odd || substring(t, 9, 10)
    else substring(t, 1, 5) || substring(odd, 1, 1) || substring(t, 7, 2) || substring(t, 12, 12) end"""


def _pileup_sql(first: str) -> str:
    """A row per read and place, written base by base."""
    text = f"substring({_LINE.replace('as string', 'as varchar')}, 7, 30)"
    return f"""with r as (
        select l_suppkey % 9 as cell, 'c' || (l_suppkey % 9) || ':U:' || l_orderkey || '.' || l_linenumber as qname, k.o_orderkey as k, l_partkey % 2 = 0 as back,
            chr(cast(20 + l_partkey % 40 + 33 as integer)) as mq, l_linenumber % 3 as form, substring({V.dna("'m' || cast(l_partkey%50 as varchar)")}, 1, 2) as odd,
            substring(translate(md5('q' || cast(l_partkey as varchar)), '0123456789abcdef', '&*:;<=>?@ABCDEFG'), 1, 20) as qual, {text} as t
        from lineitem join orders k on l_orderkey = k.o_orderkey),
    p as (select *, unnest(range(0, case form when 1 then 18 when 2 then 23 else 20 end)) as o from r),
    q as (select *, (k % 1000) * 64 + 7 + o as pos, substring(t, o + 1, 1) as ref, form = 2 and o between 8 and 10 as del,
            case when form = 1 and o >= 8 then o + 2 when form = 2 and o >= 11 then o - 3 when form = 2 and o >= 8 then 7 else o end as bp,
            o = case form when 1 then 17 when 2 then 22 else 19 end as tail from p),
    b as (select *, case when o = 5 then substring(odd, 1, 1) else ref end as base from q),
    s as (select *, case when del then '*' when base = ref then case when back then ',' else '.' end when back then lower(base) else base end as letter,
            case when o = 7 and form = 1 then '+2' || odd when o = 7 and form = 2 then '-3' || substring(t, 9, 3) else '' end as change from b),
    {first} as (select 'c' || (k // 1000) as chrom, cast(pos as bigint) as pos, ref, qname, k, back, substring(qual, cast(bp + 1 as integer), 1) as qual,
            (case when o = 0 then '^' || mq else '' end) || letter || (case when back then lower(change) else change end) || (case when tail then '$' else '' end) as token
        from s where ascii(substring(qual, cast(bp + 1 as integer), 1)) - 33 >= 13)"""


@_register(
    "pileup_of_alignments",
    f"""{_pileup_sql("z")}
    select chrom, pos, ref, cast(count(*) as integer) as depth, string_agg(token, '' order by k, qname, back, token, qual) as match,
        string_agg(qual, '' order by k, qname, back, token, qual) as qual, string_agg(qname, ',' order by k, qname, back, token, qual) as names from z group by chrom, pos, ref""",
)
def pileup_of_alignments(spark, sf):
    lines = V.table(spark, sf, "orders").select("o_orderkey", F.expr(_LINE).alias("line"))
    k = F.col("o_orderkey")
    reads = V.view(spark, sf, _READS).join(lines, F.col("k") == k).withColumn("t", F.substring("line", 7, 30))
    reads = reads.select(
        "qname", "flag", "mapq", "qual", F.expr(_SEQ).alias("seq"), F.expr("case form when 0 then '20M' when 1 then '8M2I10M' else '8M3D12M' end").alias("cigar"),
        F.concat(F.lit("c"), F.floor(k / 1000).cast("string")).alias("reference_name"), ((k % 1000) * 64 + 6).alias("pos"),
    )
    genome = lines.select(F.concat(F.lit("c"), F.floor(k / 1000).cast("string")).alias("chrom"), ((k % 1000) * 64).alias("offset"), F.col("line").alias("seq"))
    return pileup.pileup_rows(reads, genome, chunk=64)


@_register("molecules_from_stream", ORACLES["umi_collapse"])
def molecules_from_stream(spark, sf):
    """Reads arrive in three parts, a minute apart, and a closing row an hour later."""
    streaming.use_state_store(spark)
    path = scratch(spark, "stream")
    minute = F.pmod(F.xxhash64("umi", "gene"), F.lit(3))
    hits = V.view(spark, sf, V.READ_HIT).withColumn("arrived", F.timestamp_seconds(minute * 60 + 1_700_000_000))
    closing = spark.createDataFrame([("", "", "", "A", False)], "cell_barcode string, genome string, gene string, umi string, exonic boolean")
    for part in (hits, closing.withColumn("arrived", F.timestamp_seconds(F.lit(1_700_003_600)))):
        part.select("cell_barcode", "genome", "gene", "umi", "exonic", "arrived").write.mode("append").parquet(f"{path}/in")
        stream = streaming.stream_molecules(streaming.watch_hits(spark, f"{path}/in"))
        streaming.write_molecules(stream, f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.schema(streaming.OUT_SCHEMA).parquet(f"{path}/out").where("cell_barcode <> ''")
