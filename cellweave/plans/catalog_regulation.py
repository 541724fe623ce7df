"""Registered queries for peak-gene links, mutations and circles."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions.stats import normal_sf
from cellweave.operators import annotation, circle, links, mutation
from cellweave.plans import regulatory
from cellweave.plans import views as V
from cellweave.plans.catalog import ALN, _r, _register
from cellweave.plans.views import dna

EXP = V.oracle_text(V.EXPRESSION)
ACC = V.oracle_text(V.ACCESSIBILITY)
LGE = V.oracle_text(V.LINK_GENE)
CTX = V.oracle_text(V.CONTIG_TEXT)
GCP = V.oracle_text(V.GC_PEAK)
CIR = V.oracle_text(V.CIRCLE)
MIN_CELLS, MIN_GENES, MIN_PEAKS = 5, 5, 5
WINDOW_KB, RUN = 100, 20


def _filtered_sql(matrix: str, feature: str, least: int) -> str:
    kept = f"select * from ({matrix}) m where {feature} in (select {feature} from ({matrix}) k where value > 0 group by 1 having count(*) >= {MIN_CELLS})"
    return f"select * from ({kept}) m where cell in (select cell from ({kept}) k where value > 0 group by 1 having count(*) >= {least})"


def _expr(spark, sf):
    return links.filter_matrix(V.view(spark, sf, V.EXPRESSION), "gene_id", MIN_CELLS, MIN_GENES)


def _acc(spark, sf):
    binary = links.binarise(V.view(spark, sf, V.ACCESSIBILITY))
    return links.filter_matrix(binary, "peak", MIN_CELLS, MIN_PEAKS)


@_register("filtered_expression", _filtered_sql(EXP, "gene_id", MIN_GENES))
def filtered_expression(spark, sf):
    return _expr(spark, sf)


_ACCF = _filtered_sql(f"select cell, peak, least(value, 1) as value from ({ACC}) b", "peak", MIN_PEAKS)


@_register("filtered_accessibility", f"select cell, peak, cast(value as bigint) as value from ({_ACCF}) x")
def filtered_accessibility(spark, sf):
    return _acc(spark, sf).withColumn("value", F.col("value").cast("bigint"))


@_register(
    "common_cells",
    f"select distinct cell from ({_filtered_sql(EXP, 'gene_id', MIN_GENES)}) e where cell in (select cell from ({_ACCF}) a)",
)
def common_cells(spark, sf):
    return links.common_cells(_expr(spark, sf), _acc(spark, sf))


@_register("cells_per_peak", f"select peak, cast(count(*) as bigint) as n_cells from ({_ACCF}) a where value > 0 group by 1")
def cells_per_peak(spark, sf):
    return links.feature_cells(_acc(spark, sf), "peak")


@_register(
    "cpm_scaled", f"select cell, gene_id, round(value * 1e6 / sum(value) over (partition by cell), 4) as value from ({EXP}) e"
)
def cpm_scaled(spark, sf):
    return links.cpm(V.view(spark, sf, V.EXPRESSION)).withColumn("value", _r("value", 4))


@_register(
    "batch_scaled",
    f"""select batch, cell, gene_id, round(value / max(abs(value)) over (partition by batch, gene_id), 9) as value
        from (select *, cast(cell as bigint) % 3 as batch from ({EXP}) e) b""",
)
def batch_scaled(spark, sf):
    e = V.view(spark, sf, V.EXPRESSION).withColumn("batch", F.col("cell").cast("bigint") % 3)
    return links.scale_by_batch(e, "gene_id").select("batch", "cell", "gene_id", _r("value", 9).alias("value"))


_PKT = f"select distinct peak, 'chr1' as chrom, split_part(split_part(peak, ':', 2), '-', 1)::bigint as start, split_part(split_part(peak, ':', 2), '-', 2)::bigint as \"end\" from ({_ACCF}) a"


@_register("peak_coordinates", _PKT)
def peak_coordinates(spark, sf):
    return links.peak_table(_acc(spark, sf).select("peak").distinct())


_NEAR = f"""select g.gene_id, p.peak from (select gene_id, case when strand = '-' then "end" else start end as tss from ({LGE}) l) g
    join ({_PKT}) p on (greatest(0, tss - {WINDOW_KB}000) < p."end" and p."end" < tss + {WINDOW_KB}000)
      or (greatest(0, tss - {WINDOW_KB}000) < p.start and p.start < tss + {WINDOW_KB}000)"""


def _near(spark, sf):
    tss = links.gene_tss(V.view(spark, sf, V.LINK_GENE))
    peaks = links.peak_table(_acc(spark, sf).select("peak").distinct())
    return links.peaks_near_genes(tss, peaks, WINDOW_KB)


@_register("peaks_near_genes", _NEAR)
def peaks_near_genes(spark, sf):
    return _near(spark, sf)


@_register(
    "gc_content",
    f"""with t as (select string_agg(seq, '' order by "offset") as s from ({CTX}) c)
        select peak, round(100.0 * len(replace(replace(x, 'A', ''), 'T', '')) / len(x), 6) as gc_content
        from (select peak, substring(s, (start + 1)::int, 150) as x from ({GCP}) p, t) y""",
)
def gc_content(spark, sf):
    out = links.gc_content(V.view(spark, sf, V.GC_PEAK), V.view(spark, sf, V.CONTIG_TEXT), 64)
    return out.withColumn("gc_content", _r("gc_content"))


# GC share of a hash of the name: 33 levels, so classes and ties abound.
_GC = f"100.0 * length(replace(replace({dna('peak')}, 'A', ''), 'T', '')) / 32"
_INFO = f"select peak, count(*) as n_cells, cast({_GC} as double) as gc_content from ({_ACCF}) a where value > 0 group by 1"


def _info(spark, sf):
    cells = links.feature_cells(_acc(spark, sf), "peak")
    return cells.withColumn("gc_content", F.expr(_GC).cast("double"))


def _bg_sql(k: int) -> str:
    return f"""select p.peak, q.peak as bg_peak, cast(row_number() over (partition by p.peak
        order by abs(q.n_cells - p.n_cells) * abs(q.gc_content - p.gc_content), q.peak) as int) as rank
        from ({_INFO}) p, ({_INFO}) q qualify rank <= {k}"""


@_register("background_peaks", _bg_sql(100))
def background_peaks(spark, sf):
    return links.background_peaks(_info(spark, sf), 100)


@_register("background_peaks_short", _bg_sql(RUN))
def background_peaks_short(spark, sf):
    return links.background_peaks(_info(spark, sf), RUN)


_CELLS = f"select distinct cell from ({_filtered_sql(EXP, 'gene_id', MIN_GENES)}) e where cell in (select cell from ({_ACCF}) a)"
# Dense vectors over the common cells, histogrammed pair by pair.
_MI = f"""cc as ({_CELLS}), ge as (select * from ({_filtered_sql(EXP, 'gene_id', MIN_GENES)}) e where cell in (select cell from cc)),
    pa as (select * from ({_ACCF}) a where cell in (select cell from cc)),
    near as ({_NEAR}), bg as ({_bg_sql(RUN)}),
    nr as (select near.* from near where gene_id in (select gene_id from ge) and peak in (select peak from pa)),
    pr as (select distinct gene_id, peak from (select gene_id, peak from nr union all select nr.gene_id, bg.bg_peak from nr join bg using (peak))),
    dense as (select g.gene_id, cc.cell, coalesce(ge.value, 0.0) as v from (select distinct gene_id from ge) g cross join cc
              left join ge on ge.gene_id = g.gene_id and ge.cell = cc.cell),
    rng as (select gene_id, min(v) as lo, max(v) as hi from dense group by 1),
    yb as (select gene_id, cell, case when hi > lo then least(floor((v - lo) * 8 / (hi - lo)), 7) else 4 end as y from dense join rng using (gene_id)),
    jt as (select pr.gene_id, pr.peak, y, pa.cell is not null as x, count(*) as n from pr join yb using (gene_id)
           left join pa on pa.peak = pr.peak and pa.cell = yb.cell group by all),
    mi as (select gene_id, peak, sum(n / t * ln(n * t / (nx * ny))) as mi from (
             select *, sum(n) over (partition by gene_id, peak) as t, sum(n) over (partition by gene_id, peak, x) as nx,
                    sum(n) over (partition by gene_id, peak, y) as ny from jt) w group by 1, 2)"""


def _found(spark, sf):
    gc = V.view(spark, sf, V.ACCESSIBILITY).select("peak").distinct().withColumn("gc_content", F.expr(_GC).cast("double"))
    return regulatory.associate(
        V.view(spark, sf, V.EXPRESSION), V.view(spark, sf, V.ACCESSIBILITY), V.view(spark, sf, V.LINK_GENE), gc,
        WINDOW_KB, RUN, MIN_CELLS, MIN_GENES, MIN_PEAKS,
    )


def _links(spark, sf):
    return _found(spark, sf)["links"]


@_register("mutual_information", f"with {_MI} select gene_id, peak, round(mi, 8) as mi from mi")
def mutual_information(spark, sf):
    return _found(spark, sf)["mi"].withColumn("mi", _r("mi", 8))


_LINKS = f"""{_MI}, st as (select nr.gene_id, nr.peak, avg(b.mi) as m, stddev_pop(b.mi) as s from nr join bg using (peak)
      join mi b on b.gene_id = nr.gene_id and b.peak = bg.bg_peak group by 1, 2),
    lk as (select nr.gene_id, nr.peak, mi.mi, case when s > 0 then (mi.mi - m) / s when mi.mi <> m then sign(mi.mi - m) * 'inf'::double end as zscore
           from nr join mi using (gene_id, peak) join st using (gene_id, peak))"""


@_register(
    "link_zscores", f"with {_LINKS} select gene_id, peak, round(mi, 8) as mi, round(zscore, 5) as zscore from lk"
)
def link_zscores(spark, sf):
    return _links(spark, sf).select("gene_id", "peak", _r("mi", 8).alias("mi"), _r("zscore", 5).alias("zscore"))


def _tail_sql(z: str) -> str:
    """Upper normal tail from the all-positive series of the error function."""
    x2 = f"({z}) * ({z})"  # twice the square of z / sqrt(2)
    series = (
        f"list_reduce(list_transform(range(1, 400), lambda n: [n::double]), "
        f"lambda acc, n: [acc[1] * {x2} / (2 * n[1] + 1), acc[2] + acc[1] * {x2} / (2 * n[1] + 1)], [({z}) / sqrt(2.0), ({z}) / sqrt(2.0)])[2]"
    )
    return f"(0.5 - exp(-{x2} / 2) / sqrt(pi()) * {series})"


@_register(
    "link_pvalues",
    f"""with {_LINKS}, pv as (select *, {_tail_sql("abs(zscore)")} as pval from lk where zscore > 0),
    k as (select *, rank() over (order by pval) + count(*) over (partition by pval) - 1 as r, count(*) over () as n from pv),
    a as (select *, least(1.0, min(pval * n / r) over (order by pval desc)) as adj from k)
    select gene_id, peak, round(mi, 8) as mi, round(zscore, 5) as zscore, round(pval, 8) as pval, round(adj, 7) as pval_adj, adj <= 0.05 as accept,
           g.gene_name, case when g.strand = '-' then g."end" else g.start end as tss from a join ({LGE}) g using (gene_id)""",
)
def link_pvalues(spark, sf):
    """The whole association: z, upper tail, FDR, gene name and TSS."""
    out = regulatory.finish(_links(spark, sf), V.view(spark, sf, V.LINK_GENE))
    digits = {"mi": 8, "zscore": 5, "pval": 8, "pval_adj": 7}
    return out.withColumns({c: _r(c, d) for c, d in digits.items()})


# The one-sided 5% point of z replaces the tail test.
@_register(
    "links_per_gene",
    f"with {_LINKS} select gene_id, cast(count_if(zscore > 1.6448536269514722) as bigint) as n_links from lk group by 1",
)
def links_per_gene(spark, sf):
    return links.links_per_gene(_links(spark, sf))


_PV = """select l_orderkey as id, l_linenumber as line, l_quantity - 25 as zscore, (l_partkey % 997 + 1) * (l_suppkey % 89 + 1) / 180000e0 as pval from {lineitem}"""


@_register(
    "fdr",
    f"""with t as (select id, line, zscore, cast(pval as double) as pval from ({V.oracle_text(_PV)}) p where zscore > 0),
    k as (select *, rank() over (order by pval) + count(*) over (partition by pval) - 1 as r, count(*) over () as n from t),
    a as (select *, least(1.0, min(pval * n / r) over (order by pval desc)) as adj from k)
    select id, line, round(pval, 9) as pval, round(adj, 9) as pval_adj, adj <= 0.05 as accept from a""",
)
def fdr(spark, sf):
    tested = V.view(spark, sf, _PV).withColumn("pval", F.col("pval").cast("double"))
    out = links.correct_fdr(tested)
    return out.select("id", "line", _r("pval", 9).alias("pval"), _r("pval_adj", 9).alias("pval_adj"), "accept")


@_register(
    "normal_tail",
    f"""select l_orderkey, l_linenumber, z, p as pval from (select l_orderkey, l_linenumber, l_quantity / 10 as z from lineitem) t
        join (select z, round({_tail_sql("z")}, 9) as p from (select distinct l_quantity / 10 as z from lineitem) d) using (z)""",
)
def normal_tail(spark, sf):
    """Upper normal tail of every quantity in tens."""
    t = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 10).alias("z"))
    return t.withColumn("pval", _r(normal_sf(F.col("z")), 9))


_RG = """select 'ENS' || cast(p_partkey as string) || '.1' as gene_id, p_name as gene_name, p_partkey as ordinal from {part}"""
_RQ = """select p_name as gene from {part} union all select 'ENS' || cast(p_partkey as string) from {part}
    union all select 'ENS' || cast(p_partkey as string) || '.1' from {part} union all select 'none' || cast(p_size as string) from {part}"""


@_register(
    "resolved_genes",
    f"""with g as ({V.oracle_text(_RG)}), al as (select gene, arg_min(gene_id, ordinal) as a from
      (select gene_name as gene, gene_id, ordinal from g union all select split_part(gene_id, '.', 1), gene_id, ordinal from g) x group by 1)
    select q.gene, coalesce(g.gene_id, al.a) as gene_id from (select distinct gene from ({V.oracle_text(_RQ)}) z) q
    left join g on g.gene_id = q.gene left join al on al.gene = q.gene where coalesce(g.gene_id, al.a) is not null""",
)
def resolved_genes(spark, sf):
    return links.resolve_genes(V.view(spark, sf, _RQ), V.view(spark, sf, _RG))


_CORR = """select l_partkey%40 as g, l_suppkey as other, cast(count(*) as double) as corr from {lineitem} group by 1, 2"""


@_register(
    "similar_genes",
    f"""select cast(g as string) as gene, cast(other as string) as other, corr, cast(row_number() over (partition by g order by corr desc, cast(other as string)) as int) as rank
        from ({V.oracle_text(_CORR)}) c qualify rank <= 10""",
)
def similar_genes(spark, sf):
    corr = V.view(spark, sf, _CORR).select(F.col("g").cast("string").alias("gene"), F.col("other").cast("string").alias("other"), "corr")
    return links.similar_genes(corr, 10)


# ---- mutations ------------------------------------------------------------------------------

MIN_READS = 2
_TUM = V.pileup_rows_oracle("tumor")
_NOR = V.pileup_rows_oracle("normal")


def _alleles(spark, sf, salt):
    return mutation.pileup_alleles(V.view(spark, sf, V.pileup(salt)), 8)


def _sites(spark, sf, salt):
    return mutation.pileup_sites(V.view(spark, sf, V.pileup(salt)), 8)


def _sites_sql(rows: str, k: int) -> str:
    return f"""select chrom, pos, cell, allele, cast(count(*) as bigint) as n from ({rows}) r
      where (chrom, pos, allele) in (select (chrom, pos, allele) from (
        select chrom, pos, allele, c, count_if(allele <> 'S' and c >= {MIN_READS}) over (partition by chrom, pos) as strong,
               count_if(c > {MIN_READS}) over (partition by chrom, pos) as kept
        from (select chrom, pos, allele, count(*) as c from ({rows}) t group by 1, 2, 3) u) v
        where strong >= {k} and kept >= {k} and c > {MIN_READS}) group by 1, 2, 3, 4"""


@_register("pileup_alleles", _TUM)
def pileup_alleles(spark, sf):
    return _alleles(spark, sf, "tumor")


@_register(
    "unparsed_pileup_rows", "select cast(count(*) as bigint) as n from orders where o_orderpriority = '1-URGENT'"
)
def unparsed_pileup_rows(spark, sf):
    return mutation.unparsed_rows(V.view(spark, sf, V.pileup("tumor")))


@_register("allele_counts", _sites_sql(_TUM, 2))
def allele_counts(spark, sf):
    return mutation.allele_counts(_sites(spark, sf, "tumor"), MIN_READS, 2)


@_register("allele_counts_all", _sites_sql(_NOR, 1))
def allele_counts_all(spark, sf):
    return mutation.allele_counts(_sites(spark, sf, "normal"), MIN_READS, 1)


@_register(
    "mutation_sites",
    f'select distinct chrom, pos - 1 as start, pos as "end" from ({_sites_sql(_TUM, 2)}) s',
)
def mutation_sites(spark, sf):
    return mutation.site_bed(mutation.allele_counts(_sites(spark, sf, "tumor"), MIN_READS, 2))


@_register(
    "mutated_alleles",
    f"""with w as (select chrom, pos, allele as wild_type from (select chrom, pos, allele, sum(n) as s from ({_sites_sql(_NOR, 1)}) n group by 1, 2, 3) x
        qualify row_number() over (partition by chrom, pos order by s desc, allele) = 1)
    select t.*, w.wild_type from ({_sites_sql(_TUM, 2)}) t join w using (chrom, pos) where t.allele <> w.wild_type""",
)
def mutated_alleles(spark, sf):
    tumor = mutation.allele_counts(_sites(spark, sf, "tumor"), MIN_READS, 2)
    normal = mutation.allele_counts(_sites(spark, sf, "normal"), MIN_READS, 1)
    return mutation.mutated_alleles(tumor, normal)


@_register(
    "reads_by_cluster",
    f"""select c.c_mktsegment as label, cast(count(*) as bigint) as reads, cast(count(distinct a.cell_barcode) as bigint) as cells
        from ({ALN}) a join customer c on cast(c.c_custkey as string) = a.cell_barcode where not a.is_unmapped group by 1""",
)
def reads_by_cluster(spark, sf):
    clusters = V.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("barcode"), F.col("c_mktsegment").alias("label")
    )
    split = mutation.split_by_cluster(V.view(spark, sf, V.ALIGNMENT), clusters)
    return split.groupBy("label").agg(
        F.count("*").alias("reads"), F.count_distinct("barcode").alias("cells")
    )


# ---- circles --------------------------------------------------------------------------------

_SEL = f"""select * from (select chrom1 as chrom, case when order2 = 'second' and start2 < start1 then start2 else start1 end as start,
    case when order2 = 'second' and start2 < start1 then end1 else end2 end as "end", cell as cell_barcode, umi, name,
    chrom1 = chrom2 and strand1 = strand2 and strand1 <> strand3 and length(cigar1) <= 12 as shape,
    order2 = 'second' and start2 < start1 and start3 >= start2 and end3 <= end1 as a,
    order1 = 'second' and start1 < start2 and start3 >= start1 and end3 <= end2 as b from ({CIR}) c) d where shape and (a or b)"""


@_register("circles", f'select chrom, start, "end", cell_barcode, umi, name from ({_SEL}) s')
def circles(spark, sf):
    lines = V.view(spark, sf, V.CIRCLE).select("value")
    return circle.select_circles(circle.circle_columns(lines))


@_register(
    "circle_counts",
    f'select chrom, start, "end", cell_barcode, cast(count(distinct umi) as bigint) as n from ({_SEL}) s group by 1, 2, 3, 4',
)
def circle_counts(spark, sf):
    lines = V.view(spark, sf, V.CIRCLE).select("value")
    return circle.count_circles(circle.select_circles(circle.circle_columns(lines)))


# ---- gene annotation from GTF rows ----------------------------------------------------------

_GTF = """select case when p_size%2=0 then 'chr1' else 'chr2' end as "Chromosome", f as "Feature",
    cast((p_partkey%500)*1000 + p_size as bigint) as "Start", cast((p_partkey%500)*1000 + p_size*30 + o as bigint) as "End",
    case when p_partkey%2=0 then '+' else '-' end as "Strand", p_partkey as row,
    'gene_id "G' || cast(p_partkey%500 as string) || '"; gene_name "' || p_name || '"; gene_biotype "' || p_type || '";' as "Attributes"
    from (select *, 'gene' as f, 900 as o from {part} union all select *, 'exon' as f, 100 as o from {part}) u"""


def _gtf(spark, sf):
    text = _GTF
    for c in ("Chromosome", "Feature", "Start", "End", "Strand", "Attributes"):
        text = text.replace(f'"{c}"', f"`{c}`")
    return V.view(spark, sf, text).withColumn("Chromosome", F.concat(F.lit("hg_"), "Chromosome"))


@_register(
    "gtf_genes",
    f"""select 'G' || cast(g as string) as gene_id, arg_max(p_name, row) as gene_name, 'hg' as genome, 'hg_' || arg_min(c, row) as chrom,
        arg_min(s, row) as strand, arg_max(p_type, row) as biotype, min(st) as start, max(en) as "end"
        from (select p_partkey as row, p_partkey%500 as g, p_name, p_type, case when p_size%2=0 then 'chr1' else 'chr2' end as c,
              case when p_partkey%2=0 then '+' else '-' end as s, cast((p_partkey%500)*1000 + p_size as bigint) as st,
              cast((p_partkey%500)*1000 + p_size*30 + 900 as bigint) as en from part) x group by g""",
)
def gtf_genes(spark, sf):
    return annotation.gene_table(_gtf(spark, sf).withColumn("ordinal", F.col("row")))


@_register(
    "gtf_exons",
    """select 'G' || cast(p_partkey%500 as string) as gene_id, cast((p_partkey%500)*1000 + p_size as bigint) as start,
       cast(max((p_partkey%500)*1000 + p_size*30 + 100) as bigint) as "end" from part group by 1, 2""",
)
def gtf_exons(spark, sf):
    return annotation.exon_table(_gtf(spark, sf))


@_register(
    "gtf_attributes",
    """select 'G' || cast(p_partkey%500 as string) as gene_id, p_name as gene_name, p_type as gene_biotype, '' as transcript_id, f as "Feature"
       from part, (select 'gene' as f union all select 'exon') u""",
)
def gtf_attributes(spark, sf):
    return annotation.select_attributes(
        _gtf(spark, sf), ["gene_id", "gene_name", "gene_biotype", "transcript_id", "Feature"]
    )
