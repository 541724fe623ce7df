"""The registered queries: each operator run over whole driver tables, with its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.config import AssayConfig
from cellweave.lineage import cut
from cellweave.operators import annotation, atac, dge, intervals, molecules, report
from cellweave.plans import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
CFG = AssayConfig()


def _register(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _stored(spark: SparkSession, sf: str, template: str) -> DataFrame:
    """A view written once, for queries that read it in several branches."""
    return cut(V.view(spark, sf, template))


def _r(col, digits: int = 6):
    return F.round(col, digits)


HIT = V.oracle_text(V.READ_HIT)
MOL = V.oracle_text(V.MOLECULE)
ALN = V.oracle_text(V.ALIGNMENT)
GEN = V.oracle_text(V.GENE)
EXO = V.oracle_text(V.EXON)
TSS = V.oracle_text(V.TSS)
PEA = V.oracle_text(V.PEAK)
CON = V.oracle_text(V.CONTIG)
WL1 = V.oracle_text(V.WHITELIST1)
WL2 = V.oracle_text(V.WHITELIST2)
WL3 = V.oracle_text(V.WHITELIST3)
RDP = V.oracle_text(V.READ_PAIR)
SBC = V.oracle_text(V.SAMPLE_BC)


# ---- molecules and expression ---------------------------------------------------------------

@_register(
    "umi_counts",
    f"""select cell_barcode, genome, gene, umi, cast(count(*) as bigint) as counts,
        avg(case when exonic then 1.0 else 0.0 end) > 0.5 as exonic
        from ({HIT}) h group by all""",
)
def umi_counts(spark, sf):
    return molecules.count_umis(V.view(spark, sf, V.READ_HIT))


@_register(
    "umi_collapse",
    f"""with recursive m as ({MOL}),
    g as (select cell_barcode, genome, gene, list(umi order by umi) as u,
                 list(counts order by umi) as c, list(exonic order by umi) as x
          from m group by all),
    r as (select *, 1 as k from g
          union all
          select cell_barcode, genome, gene, u,
                 case when h is null then c
                      else list_transform(c, lambda v, i: case when i = h then v + c[k] when i = k then 0 else v end) end,
                 x, k + 1
          from (select *, list_filter(range(1, len(u) + 1), lambda i: hamming(u[i], u[k]) = 1 and c[i] > c[k])[1] as h
                from r where k <= len(u)) s),
    f as (select * from r where k = len(u) + 1)
    select * from (select cell_barcode, genome, gene, unnest(u) as umi, unnest(c) as counts, unnest(x) as exonic from f)
    where counts > 0""",
)
def umi_collapse(spark, sf):
    counts = molecules.count_umis(V.view(spark, sf, V.READ_HIT))
    return molecules.collapse_umis(counts)


@_register(
    "umi_neighbours",
    f"""select distinct a.cell_barcode, a.gene, a.umi, b.umi as neighbour
        from ({MOL}) a join ({MOL}) b using (cell_barcode, gene) where hamming(a.umi, b.umi) = 1""",
)
def umi_neighbours(spark, sf):
    return molecules.umi_neighbours(V.view(spark, sf, V.MOLECULE), ["cell_barcode", "gene"])


@_register(
    "molecule_totals",
    f"""select cast(sum(counts) as bigint) as total_read_count,
        cast(sum(case when gene_name not in ('Intergenic','Ambiguous') then counts else 0 end) as bigint) as mapped_to_gene,
        cast(count(*) as bigint) as total_umis from ({MOL}) m""",
)
def molecule_totals(spark, sf):
    return molecules.molecule_totals(V.view(spark, sf, V.MOLECULE))


@_register(
    "cell_totals",
    f"select cell_barcode, cast(count(*) as bigint) as umi_count from ({MOL}) m group by 1",
)
def cell_totals(spark, sf):
    return dge.cell_totals(V.view(spark, sf, V.MOLECULE))


def _matrix_sql(cutoff: str = "10") -> str:
    return f"""select cell_barcode, genome, gene, cast(count(*) as bigint) as value from ({MOL}) m
        where cell_barcode in (select cell_barcode from ({MOL}) k group by 1 having count(*) > 3 and count(*) > {cutoff})
        group by 1, 2, 3"""


@_register("count_matrix", _matrix_sql())
def count_matrix(spark, sf):
    return dge.count_matrix(V.view(spark, sf, V.MOLECULE), 10)


def _cells_sql(matrix: str) -> str:
    return f"""select cell_barcode,
        case when max(u) / sum(u) > 0.9 then arg_max(genome, u) else 'multiplet' end as species,
        cast(sum(u) as bigint) as umi_count, cast(sum(g) as bigint) as gene_count
        from (select cell_barcode, genome, sum(value) as u, count(*) as g from ({matrix}) x group by 1, 2) s group by 1"""


@_register("cell_metadata", _cells_sql(_matrix_sql()))
def cell_metadata(spark, sf):
    return dge.cell_metadata(dge.count_matrix(V.view(spark, sf, V.MOLECULE), 10))


@_register(
    "species_counts",
    f"""select cell_barcode, genome, cast(sum(value) as bigint) as umi_count, cast(count(*) as bigint) as gene_count
        from ({_matrix_sql()}) x group by 1, 2""",
)
def species_counts(spark, sf):
    return dge.species_counts(dge.count_matrix(V.view(spark, sf, V.MOLECULE), 10))


@_register(
    "gene_metadata",
    f"""select distinct x.gene as gene_id, g.gene_name, x.genome from ({_matrix_sql()}) x left join ({GEN}) g on x.gene = g.gene_id""",
)
def gene_metadata(spark, sf):
    return dge.gene_metadata(dge.count_matrix(V.view(spark, sf, V.MOLECULE), 10), V.view(spark, sf, V.GENE))


_BARN = f"""select cell_barcode, cast(sum(case when genome='hg' then value else 0 end) as bigint) as count1,
    cast(sum(case when genome='mm' then value else 0 end) as bigint) as count2 from ({_matrix_sql()}) x group by 1"""


@_register(
    "barnyard",
    f"""select *, case when count2 > 9*count1 then 'mm' when count1 > 9*count2 then 'hg' else 'mixed' end as class
        from ({_BARN}) b""",
)
def barnyard(spark, sf):
    return dge.barnyard(dge.count_matrix(V.view(spark, sf, V.MOLECULE), 10), "hg", "mm")


@_register(
    "barnyard_summary",
    f"""select class, cast(count(*) as bigint) as cells, round(100.0 * count(*) / sum(count(*)) over (), 6) as percent
        from (select case when count2 > 9*count1 then 'mm' when count1 > 9*count2 then 'hg' else 'mixed' end as class
              from ({_BARN}) b) c group by 1""",
)
def barnyard_summary(spark, sf):
    classes = dge.barnyard(dge.count_matrix(V.view(spark, sf, V.MOLECULE), 10), "hg", "mm")
    return dge.barnyard_summary(classes).withColumn("percent", _r("percent"))


def _knee_sql(cutoff: int, iters: int, window: int) -> str:
    """The threshold by ranking every cell and interpolating rank by rank."""
    return f"""
    tot as (select cell_barcode, count(*) as n from ({MOL}) m group by 1),
    rk as (select row_number() over (order by n desc, cell_barcode) as r, n from tot where n > {cutoff}),
    kk as (select max(r) as k from rk),
    grid as (select i, i * log10(k) / 499 as x, k from kk, (select unnest(range(0, 500)) as i) g),
    g2 as (select i, x, least(cast(floor(pow(10.0, x) + 1e-9) as bigint), k - 1) as r from grid),
    cv as (select g2.i, log10(a.n) + (log10(b.n) - log10(a.n)) * (x - log10(g2.r)) / (log10(g2.r + 1) - log10(g2.r)) as y
           from g2 join rk a on a.r = g2.r join rk b on b.r = g2.r + 1),
    dr as (select a.i, a.y, a.y - b.y as d from cv a join cv b on b.i = a.i + {window}),
    tries as (select row_number() over (order by d desc, i) - 1 as attempt, y from dr),
    th as (select attempt, case when attempt = 0 then 0.5 * pow(10.0, y) else pow(10.0, y) end as t from tries where attempt <= {iters}),
    fr as (select attempt, t, (select sum(n) from tot where n > t) / (select sum(n) from tot) as f from th),
    knee as (select coalesce((select t from fr where f between 0.3 and 0.925 order by attempt limit 1), {cutoff}) as threshold)"""


@_register(
    "knee_threshold",
    f"with {_knee_sql(10, 20, 100)} select round(threshold, 4) as threshold from knee",
)
def knee_threshold(spark, sf):
    totals = dge.cell_totals(V.view(spark, sf, V.MOLECULE))
    out = dge.read_threshold(totals, cutoff=10, try_iter=20, window=100)
    return out.withColumn("threshold", _r("threshold", 4))


@_register(
    "knee_default_window",
    f"with {_knee_sql(10, 10, 20)} select round(threshold, 4) as threshold from knee",
)
def knee_default_window(spark, sf):
    totals = dge.cell_totals(V.view(spark, sf, V.MOLECULE))
    return dge.read_threshold(totals, cutoff=10).withColumn("threshold", _r("threshold", 4))


@_register(
    "knee_curve",
    f"with {_knee_sql(10, 20, 100)} select cast(i as int) as i, round(y, 6) as y from cv",
)
def knee_curve(spark, sf):
    totals = dge.cell_totals(V.view(spark, sf, V.MOLECULE))
    return dge.knee_curve(dge.depth_histogram(totals), 10).select("i", _r("y").alias("y"))


@_register(
    "knee_summary",
    f"""with {_knee_sql(10, 20, 100)} select cast(count(*) as bigint) as n_cells, median(n) as median_umis,
        round(max(threshold), 4) as read_threshold from tot, knee where n > threshold""",
)
def knee_summary(spark, sf):
    totals = dge.cell_totals(_stored(spark, sf, V.MOLECULE))
    out = dge.knee_summary(totals, dge.read_threshold(totals, cutoff=10, try_iter=20, window=100))
    return out.withColumn("read_threshold", _r("read_threshold", 4))


@_register(
    "called_cell_table",
    f"with {_knee_sql(10, 20, 100)}, cells as ({_cells_sql(_matrix_sql())}) "
    "select cells.* from cells, knee where umi_count > threshold",
)
def called_cell_table(spark, sf):
    """The flagship: molecules to cell calls with species, depth and gene count."""
    mols = _stored(spark, sf, V.MOLECULE)
    knee = dge.read_threshold(dge.cell_totals(mols), cutoff=10, try_iter=20, window=100)
    return dge.called_cells(dge.cell_metadata(dge.count_matrix(mols, 10)), knee)


@_register(
    "saturation",
    f"select round(1 - count(*) / sum(counts), 9) as saturation from ({MOL}) m",
)
def saturation(spark, sf):
    return report.saturation(V.view(spark, sf, V.MOLECULE)).withColumn("saturation", _r("saturation", 9))


@_register(
    "genome_shares",
    f"""select genome, cast(count(*) as bigint) as molecules, round(count(*) / sum(count(*)) over (), 9) as share
        from ({MOL}) m group by 1""",
)
def genome_shares(spark, sf):
    return report.genome_shares(V.view(spark, sf, V.MOLECULE)).withColumn("share", _r("share", 9))


@_register(
    "species_summary",
    f"""with m as ({MOL}), x as ({_matrix_sql()}), c as ({_cells_sql(_matrix_sql())}),
    per as (select cell_barcode, genome, sum(value) as u, count(*) as g from x group by 1, 2)
    select a.genome, cast(count(*) as bigint) as n_cells, median(per.u) as median_umis, median(per.g) as median_genes,
      round((select sum(u) from per p where p.genome = a.genome) / (select count(*) from m where m.genome = a.genome), 9) as fraction_in_cells,
      round((select avg(case when exonic then 1.0 else 0.0 end) from m where m.genome = a.genome and cell_barcode in (select cell_barcode from x)), 9) as exonic_fraction
    from (select cell_barcode, species as genome from c where species <> 'multiplet') a
    join per on per.cell_barcode = a.cell_barcode and per.genome = a.genome group by a.genome""",
)
def species_summary(spark, sf):
    mols = _stored(spark, sf, V.MOLECULE)
    matrix = dge.count_matrix(mols, 10)
    out = report.species_summary(mols, matrix, dge.cell_metadata(matrix))
    return out.withColumns(
        {c: _r(c, 9) for c in ("fraction_in_cells", "exonic_fraction")}
    )


@_register(
    "run_summary",
    f"""with m as ({MOL}), x as ({_matrix_sql()}), h as ({HIT})
    select cast((select count(distinct cell_barcode) from x) as bigint) as estimated_cells,
      cast((select count(*) from h) as bigint) as number_of_reads,
      round((select count(*) from h) / (select count(distinct cell_barcode) from x), 6) as mean_reads_per_cell,
      round(1 - count(*) / sum(counts), 9) as sequencing_saturation,
      round(sum(counts) / (select count(*) from h), 9) as reads_mapped_to_genome,
      round(sum(counts) / sum(counts), 9) as reads_mapped_to_gene,
      round((select sum(value) from x) / count(*), 9) as fraction_reads_in_cells from m""",
)
def run_summary(spark, sf):
    mols = _stored(spark, sf, V.MOLECULE)
    totals = molecules.molecule_totals(mols)
    n_reads = V.view(spark, sf, V.READ_HIT).agg(F.count("*").alias("n"))
    out = report.run_summary(
        mols, dge.count_matrix(mols, 10), n_reads.scalar(),
        totals.select("total_read_count").scalar(), totals.select("mapped_to_gene").scalar(),
    )
    return out.select(*[_r(c, 6 if c == "mean_reads_per_cell" else 9).alias(c) if t == "double" else c for c, t in out.dtypes])


_UNIFORM = "((('0x' || substring(md5(concat_ws('|', cell_barcode, gene, umi, '0')), 1, 13))::bigint)::double + 0.5) / pow(16.0, 13)"


@_register(
    "subsample_curves",
    f"""with m as ({MOL}), c as ({_cells_sql(_matrix_sql())}),
    called as (select cell_barcode, species as genome from c where species <> 'multiplet'),
    reads as (select count(*) as n from ({HIT}) h),
    d as (select s.genome, s.share * reads.n / k.n as full_d from
            (select genome, count(*) / sum(count(*)) over () as share from m group by 1) s
            join (select genome, count(*) as n from called group by 1) k using (genome), reads),
    di as (select genome, full_d, unnest(range(1, cast(ceil(floor(full_d) / 50) as bigint) + 1)) as i from d),
    dl as (select *, max(i) over (partition by genome) as last_i from di),
    own as (select m.*, 1 - pow(1 - {_UNIFORM}, 1.0 / counts) as p0 from m join called using (cell_barcode, genome)),
    vis as (select own.genome, i, last_i, full_d, cell_barcode, gene from own join dl using (genome)
            where i = last_i or (p0 * full_d / 50) <= i),
    pc as (select genome, i, last_i, full_d, cell_barcode, count(*) as umis, count(distinct gene) as genes from vis group by all)
    select genome, cast(case when i = last_i then floor(full_d) else i * 50 end as bigint) as depth,
           median(genes) as median_genes, median(umis) as median_umis from pc group by genome, i, last_i, full_d
    union all select genome, 0, 0.0, 0.0 from d""",
)
def subsample_curves(spark, sf):
    mols = _stored(spark, sf, V.MOLECULE)
    n_reads = V.view(spark, sf, V.READ_HIT).agg(F.count("*").alias("n"))
    cells = dge.cell_metadata(dge.count_matrix(mols, 10))
    return report.subsample_curves(mols, cells, n_reads.scalar(), step=50)


# ---- intervals and annotation ---------------------------------------------------------------

@_register(
    "genome_windows",
    f"""select chrom, cast(s as bigint) as start, cast(least(s + 2000, size) as bigint) as "end"
        from (select chrom, size, unnest(range(0, size, 2000)) as s from ({CON}) c) w""",
)
def genome_windows(spark, sf):
    return intervals.make_windows(V.view(spark, sf, V.CONTIG), 2000)


_FRAG = f"""select chrom, pos + 4 as frag_start, pos + abs(tlen) - 5 as frag_end, cell_barcode
    from ({ALN}) a where not is_unmapped and mapq >= 30 and not is_reverse"""
_PEAKCOUNT = f"""select p.chrom || ':' || p.start || '-' || p."end" as peak, f.cell_barcode, cast(count(*) as bigint) as value
    from ({PEA}) p join ({_FRAG}) f on p.chrom = f.chrom and p.start < f.frag_end and f.frag_start < p."end"
    where f.frag_start < f.frag_end group by 1, 2"""


@_register("peak_counts", _PEAKCOUNT)
def peak_counts(spark, sf):
    frags = atac.shifted_fragments(V.view(spark, sf, V.ALIGNMENT))
    return atac.count_regions(V.view(spark, sf, V.PEAK), frags)


@_register(
    "peak_counts_binary", f"select peak, cell_barcode, cast(1 as bigint) as value from ({_PEAKCOUNT}) c"
)
def peak_counts_binary(spark, sf):
    frags = atac.shifted_fragments(V.view(spark, sf, V.ALIGNMENT))
    return atac.count_regions(V.view(spark, sf, V.PEAK), frags, binary=True)


@_register(
    "window_counts",
    f"""with w as (select chrom, cast(s as bigint) as start, cast(least(s + 2000, size) as bigint) as "end"
              from (select chrom, size, unnest(range(0, size, 2000)) as s
                    from (select chrom, max(pos) + 1 as size from ({ALN}) a group by 1) c) x),
    f as ({_FRAG})
    select w.chrom || ':' || w.start || '-' || w."end" as peak, f.cell_barcode, cast(count(*) as bigint) as value
    from w join f on w.chrom = f.chrom and w.start < f.frag_end and f.frag_start < w."end" and f.frag_start < f.frag_end
    group by 1, 2""",
)
def window_counts(spark, sf):
    reads = V.view(spark, sf, V.ALIGNMENT)
    sizes = reads.groupBy("chrom").agg((F.max("pos") + 1).alias("size"))
    return atac.count_regions(intervals.make_windows(sizes, 2000), atac.shifted_fragments(reads))


@_register(
    "gene_bins",
    f"""select chrom, strand, gene_id, cast(unnest(range(cast(floor(start/10000)*10000 as bigint), cast(ceil("end"/10000)*10000 as bigint) + 1, 10000)) as bigint) as bin
        from ({GEN}) g""",
)
def gene_bins(spark, sf):
    return annotation.gene_bins(V.view(spark, sf, V.GENE))


def _assign_sql(reads: str, first: str, last: str) -> str:
    return f"""select r.qname, r.cell_barcode, r.umi, r.genome,
      case when count(g.gene_id) = 0 then 'Intergenic_' || r.genome when count(g.gene_id) = 1 then max(g.gene_id)
           else 'Ambiguous_' || r.genome end as gene, count(g.gene_id) = 1 as in_gene
      from ({reads}) r left join ({GEN}) g on g.chrom = r.chrom and g.strand = r.strand
        and g.start <= {first} and {last} <= g."end"
      group by r.qname, r.cell_barcode, r.umi, r.genome"""


# RNA alignments get two blocks when the fragment is long.
_BLOCKS = "case when abs(tlen) > 150 then [{{'start': pos, 'end': pos + 20}}, {{'start': pos + 120, 'end': pos + 130}}] else [{{'start': pos, 'end': pos + 30}}] end"
_RNA = f"""select *, pos as first_pos, case when abs(tlen) > 150 then pos + 129 else pos + 29 end as last_pos
    from ({ALN}) a where not is_secondary and mapq = 255"""
_ATAC = f"""select *, pos as first_pos, pos + abs(tlen) as last_pos from ({ALN}) a
    where not is_secondary and reference_name not like '%chrM%' and reference_name not like '%mito%'
      and not is_unmapped and not mate_is_unmapped and is_proper_pair and not is_reverse and abs(tlen) <= 1000 and mapq >= 30"""


def _rna_blocks(alignments):
    pos = F.col("pos")

    def block(start, end):
        return F.struct((pos + start).alias("start"), (pos + end).alias("end"))

    reads = molecules.rna_alignments(alignments)
    blocks = F.when(F.abs("tlen") > 150, F.array(block(0, 20), block(120, 130))).otherwise(F.array(block(0, 30)))
    return molecules.block_span(reads.withColumn("blocks", blocks))


def _rna_reads(spark, sf):
    return _rna_blocks(V.view(spark, sf, V.ALIGNMENT))


@_register("rna_gene_assignment", _assign_sql(_RNA, "r.first_pos", "r.last_pos"))
def rna_gene_assignment(spark, sf):
    out = annotation.assign_genes(_rna_reads(spark, sf), V.view(spark, sf, V.GENE))
    return out.select("qname", "cell_barcode", "umi", "genome", "gene", "in_gene")


@_register("atac_gene_assignment", _assign_sql(_ATAC, "r.first_pos", "r.last_pos"))
def atac_gene_assignment(spark, sf):
    reads = molecules.fragment_span(molecules.atac_alignments(V.view(spark, sf, V.ALIGNMENT)))
    out = annotation.assign_genes(reads, V.view(spark, sf, V.GENE))
    return out.select("qname", "cell_barcode", "umi", "genome", "gene", "in_gene")


# Exonic bases counted base by base.
def _exonic_sql(reads: str, bases: str) -> str:
    return f"""with r as ({reads}), a as ({_assign_sql(reads, "r.first_pos", "r.last_pos")}),
    b as (select r.qname, a.gene, unnest({bases}) as p from r join a using (qname) where a.in_gene),
    e as (select b.qname, b.p, bool_or(x.gene_id is not null) as hit from b
          left join ({EXO}) x on x.gene_id = b.gene and b.p between x.start and x."end" group by 1, 2),
    f as (select qname, avg(case when hit then 1.0 else 0.0 end) > 0.5 as exonic from e group by 1)
    select a.qname, a.cell_barcode, a.umi, a.genome, a.gene, coalesce(f.exonic, false) as exonic from a left join f using (qname)"""


_RNA_BASES = "case when abs(tlen) > 150 then list_concat(range(pos, pos + 20), range(pos + 120, pos + 130)) else range(pos, pos + 30) end"
_ATAC_BASES = "range(pos, pos + abs(tlen))"


def _exonic(reads, spark, sf):
    assigned = annotation.assign_genes(reads, V.view(spark, sf, V.GENE))
    return annotation.mark_exonic(
        assigned, V.view(spark, sf, V.EXON), "qname", ["cell_barcode", "umi", "genome"]
    )


@_register("rna_exonic", _exonic_sql(_RNA, _RNA_BASES))
def rna_exonic(spark, sf):
    return _exonic(_rna_reads(spark, sf), spark, sf)


@_register("atac_exonic", _exonic_sql(_ATAC, _ATAC_BASES))
def atac_exonic(spark, sf):
    reads = molecules.fragment_span(molecules.atac_alignments(V.view(spark, sf, V.ALIGNMENT)))
    return _exonic(reads, spark, sf)


@_register(
    "rna_molecules",
    f"""with e as ({_exonic_sql(_RNA, _RNA_BASES)}),
    n as (select cell_barcode, genome, gene, umi, cast(count(*) as bigint) as counts,
                 avg(case when exonic then 1.0 else 0.0 end) > 0.5 as exonic from e group by 1, 2, 3, 4)
    select n.*, coalesce(g.gene_name, split_part(n.gene, '_', 1)) as gene_name
    from n left join ({GEN}) g on g.gene_id = n.gene""",
)
def rna_molecules(spark, sf):
    counts = molecules.count_umis(_exonic(_rna_reads(spark, sf), spark, sf))
    return molecules.with_gene_names(counts, V.view(spark, sf, V.GENE))


@_register(
    "atac_funnel",
    f"""select cast(count(*) as bigint) as total_reads,
      cast(count_if(not is_secondary) as bigint) as uniquely_mapped,
      cast(count_if(not is_secondary and m) as bigint) as chrm_reads,
      cast(count_if(p) as bigint) as proper_pairs,
      cast(count_if(p and abs(tlen) <= 1000 and mapq >= 30) as bigint) as usable_pairs
      from (select *, not is_secondary and not m and not is_unmapped and not mate_is_unmapped and is_proper_pair and not is_reverse as p
            from (select *, reference_name like '%chrM%' or reference_name like '%mito%' as m from ({ALN}) a) b) c""",
)
def atac_funnel(spark, sf):
    return molecules.atac_funnel(V.view(spark, sf, V.ALIGNMENT))


_BAMOK = """not is_unmapped and not mate_is_unmapped and not is_secondary and reference_name not like '%chrM%'
    and is_proper_pair and abs(tlen) <= 1000 and mapq >= 30"""
_ATACMOL = f"""select cell_barcode, genome, gene, umi, count(*) as counts from ({_assign_sql(_ATAC, "r.first_pos", "r.last_pos")}) q group by 1, 2, 3, 4"""


@_register(
    "atac_filtered_reads",
    f"""with a as (select * from ({ALN}) z where {_BAMOK}), m as ({_ATACMOL}),
    cells as (select cell_barcode from m group by 1 having count(*) > 8),
    ok as (select distinct cell_barcode, umi from m where cell_barcode in (select cell_barcode from cells)),
    f as (select min(qname) as qname from a join ok using (cell_barcode, umi) where is_read1 group by cell_barcode, umi)
    select qname, cell_barcode, umi, pos, tlen, is_read1 from a where qname in (select qname from f)""",
)
def atac_filtered_reads(spark, sf):
    reads = V.view(spark, sf, V.ALIGNMENT)
    spans = molecules.fragment_span(molecules.atac_alignments(reads))
    hits = annotation.assign_genes(spans, V.view(spark, sf, V.GENE))
    mols = hits.groupBy("cell_barcode", "genome", "gene", "umi").agg(F.count("*").alias("counts"))
    cells = dge.cell_totals(mols).where("umi_count > 8")
    out = molecules.filter_atac_bam(reads, mols, cells)
    return out.select("qname", "cell_barcode", "umi", "pos", "tlen", "is_read1")


# ---- chromatin quality ----------------------------------------------------------------------

_QC = f"select * from ({ALN}) a where not is_unmapped and mapq >= 30 and not is_reverse"


@_register("reads_per_cell", f"select cell_barcode, cast(count(*) as bigint) as umi from ({_QC}) q group by 1")
def reads_per_cell(spark, sf):
    return atac.reads_per_cell(V.view(spark, sf, V.ALIGNMENT))


_MET = f"""select q.cell_barcode, q.pos + 4 - (t.tss - 2000) as l, q.pos + abs(tlen) - 5 - (t.tss - 2000) as r, abs(tlen) - 9 < 1000 as small
    from ({_QC}) q join (select chrom, (start + "end") // 2 as tss from ({TSS}) s) t
      on q.chrom = t.chrom and q.pos >= greatest(0, t.tss - 4000) and q.pos < t.tss + 4000"""
_HISTO = f"""select cell_barcode, cast(o as bigint) as "offset", cast(count(*) as bigint) as n
    from (select cell_barcode, unnest([l, r]) as o, small from ({_MET}) m) e where small and o >= 0 and o < 3999 group by 1, 2"""
_SCORES = f"""select m.cell_barcode, u.umi, case when f > 0 then c / f when c > 0 then 'inf'::double end as tss_score
    from (select cell_barcode,
           sum((small and l between 1975 and 2024)::int + (small and r between 1975 and 2024)::int) / 50.0 as c,
           sum((small and ((l >= 0 and l < 100) or (l >= 3900 and l < 3999)))::int + (small and ((r >= 0 and r < 100) or (r >= 3900 and r < 3999)))::int) / 200.0 as f
          from ({_MET}) x group by 1) m
    join (select cell_barcode, cast(count(*) as bigint) as umi from ({_QC}) q group by 1) u using (cell_barcode)"""


@_register("tss_histogram", _HISTO)
def tss_histogram(spark, sf):
    return atac.tss_insertions(V.view(spark, sf, V.ALIGNMENT), V.view(spark, sf, V.TSS))


@_register("tss_scores", f"select cell_barcode, umi, round(tss_score, 6) as tss_score from ({_SCORES}) s")
def tss_scores(spark, sf):
    out = atac.tss_scores(V.view(spark, sf, V.ALIGNMENT), V.view(spark, sf, V.TSS))
    return out.withColumn("tss_score", _r("tss_score"))


@_register(
    "tss_profile",
    f"""with h as (select "offset", sum(n) as n from ({_HISTO}) x group by 1),
    g as (select o as "offset", coalesce(h.n, 0) as n from (select unnest(range(0, 4000)) as o) z left join h on h."offset" = z.o),
    f as (select sum(n) / 200.0 as f from g where "offset" < 100 or "offset" >= 3900)
    select "offset", cast(n as bigint) as n, round(n / f, 6) as enrichment,
           round(sum(n) over (order by "offset" rows between 25 preceding and 24 following) / 50.0 / f, 6) as smoothed from g, f""",
)
def tss_profile(spark, sf):
    out = atac.tss_profile(spark, atac.tss_insertions(V.view(spark, sf, V.ALIGNMENT), V.view(spark, sf, V.TSS), by=()))
    return out.withColumns({c: _r(c) for c in ("enrichment", "smoothed")})


@_register(
    "cells_passing_qc",
    f"select cell_barcode, umi, round(tss_score, 6) as tss_score from ({_SCORES}) s where umi >= 10 and tss_score >= 0.9",
)
def cells_passing_qc(spark, sf):
    scores = atac.tss_scores(V.view(spark, sf, V.ALIGNMENT), V.view(spark, sf, V.TSS))
    return atac.filter_cells(scores, 10, 0.9).withColumn("tss_score", _r("tss_score"))


@_register(
    "reads_of_qc_cells",
    f"""select qname, cell_barcode, pos from ({ALN}) a
        where cell_barcode in (select cell_barcode from ({_SCORES}) s where umi >= 10 and tss_score >= 0.9)""",
)
def reads_of_qc_cells(spark, sf):
    reads = V.view(spark, sf, V.ALIGNMENT)
    cells = atac.filter_cells(atac.tss_scores(reads, V.view(spark, sf, V.TSS)), 10, 0.9)
    return atac.filter_reads_by_cells(reads, cells).select("qname", "cell_barcode", "pos")


@_register(
    "qc_medians",
    f"""with s as ({_SCORES})
    select 'total' as stage, cast(count(*) as bigint) as cells, median(umi) as median_umi, round(median(tss_score), 6) as median_tss from s
    union all select 'filtered', count(*), median(umi), round(median(tss_score), 6) from s where umi >= 10 and tss_score >= 0.9""",
)
def qc_medians(spark, sf):
    scores = atac.tss_scores(V.view(spark, sf, V.ALIGNMENT), V.view(spark, sf, V.TSS))
    return atac.qc_medians(scores, 10, 0.9).withColumn("median_tss", _r("median_tss"))


@_register(
    "fragment_lengths",
    f"""select tlen, cast(count(*) as bigint) as n, round(count(*) / sum(count(*)) over (), 9) as share
        from ({_QC}) q where tlen < 1000 group by 1""",
)
def fragment_lengths(spark, sf):
    return atac.fragment_lengths(V.view(spark, sf, V.ALIGNMENT)).withColumn("share", _r("share", 9))


_SUMMIT = 'select chrom, start, start + 1 as "end", \'run/\' || gene_name as name, biotype as val from ({}) g'


@_register(
    "extended_summits",
    f"""select chrom, greatest(0, start - 250) as start, "end" + 249 as "end",
        split_part(name, '/', -1) as name, val, '.' as strand from ({_SUMMIT.format(GEN)}) s""",
)
def extended_summits(spark, sf):
    genes = V.view(spark, sf, V.GENE)
    summits = genes.select(
        "chrom", "start", (F.col("start") + 1).alias("end"),
        F.concat(F.lit("run/"), "gene_name").alias("name"), F.col("biotype").alias("val"),
    )
    return atac.extend_summits(summits, 500)
