"""Sequencing-shaped views over the driver tables, as SQL text both engines run.

Each view is a template: ``{lineitem}`` and so on stand for tables. Spark binds them to
DataFrames; the oracle substitutes the table names. Only the text of a view is shared; the
operator under test and its oracle are written apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DNA = "translate(md5({0}), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def dna(expr: str) -> str:
    return DNA.format(expr)


READ_HIT = f"""
select cast(cell as string) as cell_barcode,
       case when cell%3=0 and gene%20<>0 then 'hg' when cell%3=1 and gene%20<>0 then 'mm'
            when gene%2=0 then 'hg' else 'mm' end as genome,
       cast(gene as string) as gene, umi, exonic
from (select least(l_orderkey%400, l_partkey%400, (l_orderkey+l_linenumber*37)%400) as cell,
             l_partkey%40 as gene,
             substring({dna("cast(l_orderkey%24 as string)")},1,4) as umi,
             l_returnflag='A' as exonic
      from {{lineitem}}) r
"""

MOLECULE = f"""
select cell_barcode, genome, gene, 'g' || gene as gene_name, umi,
       cast(count(*) as bigint) as counts,
       avg(case when exonic then 1.0 else 0.0 end) > 0.5 as exonic
from ({READ_HIT}) h group by cell_barcode, genome, gene, umi
"""

_CHROM = "case event_type when 'signup' then 'hg_chr1' when 'click' then 'hg_chr2' when 'error' then 'hg_chrM' when 'view' then 'mm_chr1' else 'mm_chr2' end"
_PART_CHROM = "case p_partkey%4 when 0 then 'hg_chr1' when 1 then 'hg_chr2' when 2 then 'mm_chr1' else 'mm_chr2' end"
_START = "(p_partkey*1301)%2592000"

# One alignment per event. Digits of a hash of the id drive the flags.
ALIGNMENT = f"""
select cast(user_id as string) || ':' || umi || ':' || cast(event_id as string) as qname,
       cast(user_id as string) as cell_barcode, umi,
       {_CHROM} as reference_name, {_CHROM} as chrom,
       case when event_type in ('signup','click','error') then 'hg' else 'mm' end as genome,
       secs as pos, tlen,
       case when d1 < '3' then 3 when d1 < '8' then 60 else 255 end as mapq,
       d2 = '0' as is_secondary, d3 = '0' as is_unmapped, d4 = '0' as mate_is_unmapped,
       d5 > '1' as is_proper_pair, event_id%2=1 as is_reverse, event_id%4<2 as is_read1,
       case when event_id%2=1 then '-' else '+' end as strand
from (select event_id, user_id, event_type, {{secs}} as secs,
             (1 + cast(floor(value*3) as bigint)) * (case when event_id%2=1 then -1 else 1 end) as tlen,
             substring({dna("cast(event_id%96 as string)")},1,6) as umi,
             substring(h,1,1) as d1, substring(h,2,1) as d2, substring(h,3,1) as d3,
             substring(h,4,1) as d4, substring(h,5,1) as d5
      from (select event_id, user_id, event_type, value, ts, md5(cast(event_id as string)) as h from {{events}}) e) x
"""

GENE = f"""
select cast(p_partkey as string) as gene_id, p_name || '_' || cast(p_partkey as string) as gene_name,
       {_PART_CHROM} as chrom, substring({_PART_CHROM},1,2) as genome,
       case when p_partkey%3=0 then '-' else '+' end as strand, p_type as biotype,
       cast({_START} as bigint) as start, cast({_START} + p_size*50 as bigint) as "end"
from {{part}}
"""

# Three exons per gene; the third overlaps the first.
EXON = f"""
select cast(p_partkey as string) as gene_id,
       cast({_START} + o*p_size as bigint) as start, cast({_START} + o*p_size + p_size*12 as bigint) as "end"
from (select p_partkey, p_size, 0 as o from {{part}} union all select p_partkey, p_size, 30 as o from {{part}}
      union all select p_partkey, p_size, 6 as o from {{part}}) k
"""

TSS = f"""
select {_PART_CHROM} as chrom, cast({_START} as bigint) as start, cast({_START} + 1 + p_size%3 as bigint) as "end",
       cast(p_partkey as string) as name
from {{part}}
"""

PEAK = f"""
select {_PART_CHROM} as chrom, cast({_START} + 700 as bigint) as start, cast({_START} + 1200 as bigint) as "end"
from {{part}}
"""

CONTIG = """
select event_type as chrom, cast(max({secs}) as bigint) + 1 as size from {events} group by event_type
"""

# Barcoded read pairs, one per order. A hash digit decides how each barcode is damaged.
def _damage(bc: str, how: str, where: str, base: str) -> str:
    p = f"(1 + ({where}) % 6)"
    return (
        f"case when {how} in ('0','1') then substring({bc},1,{p}-1) || {base} || substring({bc},{p}+1) "
        f"when {how} = '2' then substring({bc},1,{p}-1) || {base} || substring({bc},{p}) "
        f"when {how} = '3' then substring({bc},1,{p}-1) || substring({bc},{p}+1) else {bc} end"
    )


WHITELIST1 = f"""
select cast(p_size as string) as id, substring({dna("'a' || cast(p_size as string)")}, 1, 8 + p_size%4) as barcode
from (select distinct p_size from {{part}}) d
"""
WHITELIST2 = f"""
select cast(n_nationkey as string) as id, substring({dna("'b' || cast(n_nationkey as string)")}, 1, 6) as barcode
from {{nation}}
"""
WHITELIST3 = f"""
select o_orderpriority as id, substring({dna("'c' || o_orderpriority")}, 1, 16) as barcode
from (select distinct o_orderpriority from {{orders}}) d
"""
SAMPLE_BC = f"""
select 'S' || cast(n_regionkey as string) as sample, substring({dna("'b' || cast(n_nationkey as string)")}, 1, 6) as bc
from {{nation}}
"""

TAG = "AGATGTGTATAAGAGACAG"

READ_PAIR = f"""
select o_orderkey as ordinal,
       '@r' || cast(o_orderkey as string) || ' 1:N:0:GGTTAACC+' || translate(reverse(i5), 'ACGT', 'TGCA') as name1,
       substring(dna1,1,10) || bc1 || substring(dna1,11,17) || bc2 || tag || substring(dna2,1,20) as seq1,
       substring(q || q || q, 1, length(bc1) + length(bc2) + 66) as qual1,
       '@r' || cast(o_orderkey as string) || ' 2:N:0:GGTTAACC+' || translate(reverse(i5), 'ACGT', 'TGCA') as name2,
       dna2 || substring(dna1,1,8) as seq2, q || substring(q,1,8) as qual2
from (select o_orderkey, dna1, dna2, q,
             {_damage("w1", "substring(h,1,1)", "ascii(substring(h,2,1))", "substring(dna2,21,1)")} as bc1,
             {_damage("w2", "substring(h,3,1)", "ascii(substring(h,4,1))", "substring(dna2,22,1)")} as bc2,
             {_damage("w3", "substring(h,5,1)", "ascii(substring(h,6,1))", "substring(dna2,23,1)")} as i5,
             case when o_orderstatus = 'F' then '{TAG}'
                  when o_orderstatus = 'O' then substring(dna2,3,19)
                  else substring('{TAG}',1,6) || substring(dna2,5,1) || substring('{TAG}',8,6) || substring(dna2,1,6) end as tag
      from (select o_orderkey, o_orderstatus, md5('h' || cast(o_orderkey as string)) as h,
                   {dna("'x' || cast(o_orderkey as string)")} as dna1,
                   {dna("'y' || cast(o_orderkey as string)")} as dna2,
                   translate(md5('q' || cast(o_orderkey as string)), '0123456789abcdef', '#,:;<=>?@ABCDEFG') as q,
                   substring({dna("'a' || cast(1 + o_custkey%50 as string)")}, 1, cast(8 + (1 + o_custkey%50)%4 as int)) as w1,
                   substring({dna("'b' || cast(o_custkey%25 as string)")}, 1, 6) as w2,
                   substring({dna("'c' || o_orderpriority")}, 1, 16) as w3
            from {{orders}}) a) b
"""

_SECS = {
    "spark": "cast(floor(unix_micros(cast(ts as timestamp))/1000000) as bigint)-1704067200",
    "duckdb": "cast(epoch_us(ts)//1000000-1704067200 as bigint)",
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_text(template: str) -> str:
    """A view as a DuckDB subquery."""
    return template.format(secs=_SECS["duckdb"], **{t: t for t in TABLES})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    """A view as a Spark DataFrame; only the tables it names are read."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in template}
    text = template.replace('"end"', "`end`").replace('"offset"', "`offset`").replace("{secs}", _SECS["spark"])
    return spark.sql(text, **used)


# ---- regulation: expression, accessibility, peaks -------------------------------------------

_CELL = "cast(least(l_orderkey%400, l_partkey%400, (l_orderkey+l_linenumber*37)%400) as string)"

EXPRESSION = f"""
select {_CELL} as cell, cast(l_partkey%40 as string) as gene_id, cast(count(*) as double) as value
from {{lineitem}} group by 1, 2
"""
_PEAK_AT = "cast((l_suppkey*8 + l_linenumber)*2500 as bigint)"
ACCESSIBILITY = f"""
select {_CELL} as cell,
       'hg_chr1:' || cast({_PEAK_AT} as string) || '-' || cast({_PEAK_AT} + 500 as string) as peak,
       cast(count(*) as bigint) as value
from {{lineitem}} group by 1, 2
"""
LINK_GENE = """
select cast(g as string) as gene_id, 'name' || cast(g as string) as gene_name, 'hg_chr1' as chrom,
       case when g%2=0 then '+' else '-' end as strand, cast(g*50000 as bigint) as start,
       cast(g*50000 + 3000 as bigint) as "end"
from (select distinct l_partkey%40 as g from {lineitem}) d
"""
# Contig text in chunks of 64 bases, one per order.
CONTIG_TEXT = f"""
select 'chr1' as chrom, o_orderkey*64 as "offset",
       {dna("'s' || cast(o_orderkey as string)")} || {dna("'t' || cast(o_orderkey as string)")} as seq
from {{orders}}
"""
GC_PEAK = """
select 'p' || cast(c_custkey as string) as peak, 'chr1' as chrom, c_custkey*97 as start, c_custkey*97 + 150 as "end"
from {customer}
"""

# ---- k-mer reference and reads --------------------------------------------------------------

FASTA = f"""
select 'rna' || cast(c_custkey as string) as name,
       {dna("'f' || cast(c_custkey as string)")} || {dna("'g' || cast(c_custkey as string)")} as seq
from {{customer}}
"""
RNA_READ = f"""
select ordinal, case when o_orderstatus = 'F' then s when o_orderstatus = 'O' then reverse(translate(s, 'ACGT', 'TGCA'))
                     else substring(r, 1, 25 + cast(ordinal%8 as int)) || s end as seq
from (select o_orderkey as ordinal, o_orderstatus,
             substring({dna("'f' || cast(o_custkey as string)")} || {dna("'g' || cast(o_custkey as string)")}, cast(1 + o_orderkey%9 as int), 50) as s,
             {dna("'z' || cast(o_orderkey as string)")} as r
      from {{orders}}) x
"""

# ---- pileup ---------------------------------------------------------------------------------

_PILE_READS = 12
_ALPHABET = ".,.,.,..ACGTac*>"


def _pile_base(i: int) -> str:
    return f"translate(substring(h,{i},1),'0123456789abcdef','{_ALPHABET}')"


def _pile_cell(i: int) -> str:
    return f"('c' || substring(h,{i + 16},1))"


def _pile_token(i: int) -> str:
    """Raw pileup text of read i; some reads carry start, end or indel marks."""
    base = _pile_base(i)
    return {1: f"('^I' || {base})", 3: f"({base} || '+2ac')", 6: f"({base} || '$')", 8: f"({base} || '-11gattacagatt')"}.get(i, base)


def pileup(salt: str) -> str:
    """Twelve reads per site, eight at pending orders; urgent orders start with an unknown mark."""
    def joined(parts):
        head = " || ".join(parts[:8])
        tail = " || ".join(parts[8:])
        return head, tail

    m1, m2 = joined([_pile_token(i) for i in range(1, _PILE_READS + 1)])
    cells = [f"{_pile_cell(i)} || ':u{i}'" for i in range(1, _PILE_READS + 1)]
    n1 = " || ',' || ".join(cells[:8])
    n2 = " || ',' || ".join(cells[8:])
    return f"""
select chrom, pos, ref, depth, case when o_orderpriority = '1-URGENT' then '!' else '' end || {m1} || case when depth = 12 then {m2} else '' end as match,
       substring('IIIIIIIIIIII', 1, cast(depth as int)) as qual,
       {n1} || case when depth = 12 then ',' || {n2} else '' end as names
from (select 'chr' || o_orderstatus as chrom, o_orderkey + 1 as pos, o_orderpriority,
             substring({dna("'r' || cast(o_orderkey as string)")}, 1, 1) as ref,
             case when o_orderstatus = 'P' then 8 else 12 end as depth,
             md5('{salt}' || cast(o_orderkey as string)) as h
      from {{orders}}) p
"""


def pileup_rows_oracle(salt: str) -> str:
    """The same reads as DuckDB rows, written from the read list and not by parsing the text."""
    def token(i):
        up = f"replace(upper({_pile_base(i)}), ',', '.')"
        return {1: f"('^' || {up})", 3: f"({up} || '+AC')", 6: f"({up} || '$')", 8: f"({up} || '-GATTACAGATT')"}.get(i, up)

    items = ", ".join(f"{{'t': {token(i)}, 'c': {_pile_cell(i)}}}" for i in range(1, _PILE_READS + 1))
    return f"""select chrom, pos, r.c as cell,
      case when r.t in ('.', '^.', '.$') then ref when r.t = '>' then 'S' when r.t = '*' then 'D' else r.t end as allele
    from (select chrom, pos, ref, unnest(list_slice([{items}], 1, depth)) as r
          from (select 'chr' || o_orderstatus as chrom, o_orderkey + 1 as pos,
                       substring({dna("'r' || cast(o_orderkey as string)")}, 1, 1) as ref,
                       case when o_orderstatus = 'P' then 8 else 12 end as depth,
                       md5('{salt}' || cast(o_orderkey as string)) as h
                from orders where o_orderpriority <> '1-URGENT') p) q"""


# ---- split reads that close circles ---------------------------------------------------------

_SPAN = "(l_orderkey*13 + l_linenumber*7)%5000"
CIRCLE = f"""
select *, chrom1 || '\t' || cast(start1 as string) || '\t' || cast(end1 as string) || '\t' || name || '\t.\t.\t' || strand1 || '\t' || cigar1 || '\t' || order1 || '\t.\t'
       || chrom2 || '\t' || cast(start2 as string) || '\t' || cast(end2 as string) || '\t' || name || '\t.\t.\t' || strand2 || '\t' || '20M30S' || '\t' || order2 || '\t.\t'
       || chrom1 || '\t' || cast(start3 as string) || '\t' || cast(end3 as string) || '\t' || name || '\t.\t.\t' || strand3 || '\t' || '50M' || '\tx\t.' as value
from (select 'chr' || l_returnflag as chrom1, 'chr' || case when l_linenumber = 7 then 'X' else l_returnflag end as chrom2,
             a as start1, a + 60 as end1, b as start2, b + 60 as end2,
             least(a, b) + l_partkey%40 - 5 as start3, greatest(a, b) + 20 + l_suppkey%45 as end3,
             cast(l_suppkey as string) || ':' || umi || ':' || cast(l_orderkey as string) as name, umi,
             cast(l_suppkey as string) as cell,
             case when l_partkey%2=0 then '+' else '-' end as strand1,
             case when (l_partkey + case when l_quantity > 45 then 1 else 0 end)%2=0 then '+' else '-' end as strand2,
             case when (l_partkey + case when l_quantity > 5 then 1 else 0 end)%2=0 then '+' else '-' end as strand3,
             case when l_discount > 0.09 then '10M5I10M2D25M' else '30S20M' end as cigar1,
             case when a > b then 'first' else 'second' end as order1, case when a > b then 'second' else 'first' end as order2
      from (select *, cast({_SPAN} as bigint) as a, cast((l_suppkey*17 + l_partkey)%5000 as bigint) as b,
                   substring({dna("cast(l_orderkey%24 as string)")},1,4) as umi from {{lineitem}}) i) w
"""
