"""Registered queries for whole workflows and for operators that other catalogues only pass through."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import annotation, dge, links, mutation
from cellweave.plans import demultiplex, mutations, postprocess
from cellweave.plans import views as V
from cellweave.plans.catalog import _RNA, _RNA_BASES, ALN, GEN, MOL, RDP, SBC, _exonic_sql, _register, _rna_blocks, CFG
from cellweave.plans.catalog_barcodes import _TAGGED, _whitelists
from cellweave.plans.catalog_regulation import _GTF, _NOR, _TUM, MIN_READS, _gtf, _sites_sql


@_register("genic_molecules", f"select * from ({MOL}) m where gene_name not in ('Intergenic', 'Ambiguous')")
def genic_molecules(spark, sf):
    return dge.genic(V.view(spark, sf, V.MOLECULE))


@_register(
    "reads_by_batch_cluster",
    f"""select c.c_mktsegment as label, a.batch, cast(count(*) as bigint) as reads, cast(count(distinct a.barcode) as bigint) as cells
        from (select *, pos % 2 as batch, cell_barcode || '-' || cast(pos % 2 as varchar) as barcode from ({ALN}) x where not is_unmapped) a
        join customer c on cast(c.c_custkey as varchar) || '-' || cast(c.c_custkey % 2 as varchar) = a.barcode group by 1, 2""",
)
def reads_by_batch_cluster(spark, sf):
    key = F.col("c_custkey")
    clusters = V.table(spark, sf, "customer").select(
        F.concat_ws("-", key.cast("string"), (key % 2).cast("string")).alias("barcode"), F.col("c_mktsegment").alias("label")
    )
    reads = V.view(spark, sf, V.ALIGNMENT).withColumn("batch", F.col("pos") % 2)
    split = mutation.split_by_cluster(reads, clusters, batch_suffix=True)
    return split.groupBy("label", "batch").agg(F.count("*").alias("reads"), F.count_distinct("barcode").alias("cells"))


_ROWS = V.oracle_text(_GTF)


@_register(
    "combined_gtfs",
    f"""select s || '_hg_' || "Chromosome" as "Chromosome", "Feature", cast(count(*) as bigint) as n, cast(sum("End" - "Start") as bigint) as bases
        from ({_ROWS}) g, (values ('hg', 0), ('mm', 1)) v(s, least) where v.least = 0 or "Feature" = 'gene' group by 1, 2""",
)
def combined_gtfs(spark, sf):
    gtf = _gtf(spark, sf)
    both = annotation.combine_gtfs({"hg": gtf, "mm": gtf.where("Feature = 'gene'")})
    return both.groupBy("Chromosome", "Feature").agg(
        F.count("*").alias("n"), F.sum(F.col("End") - F.col("Start")).cast("bigint").alias("bases")
    )


def _library_sql(lib: str, remainder: int) -> str:
    own = f"(select * from ({RDP}) z where ordinal % 2 = {remainder}) "
    tagged = _TAGGED.replace(f"({RDP})", own)
    return f"""select '{lib}' as lib_id, sample, tag, reads from (with {tagged}
        select s.sample, fin.tag, cast(count(*) as bigint) as reads from fin join ({SBC}) s on s.bc = fin.bc2
        where not (fin.tag = 'A' and length(fin.seq2) + 1 < 20) group by 1, 2) t"""


@_register("library_fan_in", f"{_library_sql('LIB1.', 0)} union all {_library_sql('LIB2.', 1)}")
def library_fan_in(spark, sf):
    reads = V.view(spark, sf, V.READ_PAIR)
    libraries = {f"LIB{k + 1}.": reads.where(F.col("ordinal") % 2 == k) for k in (0, 1)}
    out = demultiplex.preprocess(libraries, _whitelists(spark, sf), V.view(spark, sf, V.SAMPLE_BC), CFG, trimmed=True)
    return out.groupBy("lib_id", "sample", "tag").agg(F.count("*").alias("reads"))


@_register(
    "called_mutations",
    f"""with t as ({_sites_sql(_TUM, 2)}), n as (select x.* from ({_sites_sql(_NOR, 1)}) x where (chrom, pos) in (select (chrom, pos) from t)),
    w as (select chrom, pos, allele as wild_type from (select chrom, pos, allele, sum(n) as s from n group by 1, 2, 3) x
          qualify row_number() over (partition by chrom, pos order by s desc, allele) = 1)
    select t.*, w.wild_type from t join w using (chrom, pos) where t.allele <> w.wild_type""",
)
def called_mutations(spark, sf):
    tumor, normal = (V.view(spark, sf, V.pileup(salt)) for salt in ("tumor", "normal"))
    return mutations.call_mutations(tumor, normal, 8, MIN_READS, 8, MIN_READS)["mutated"]


@_register(
    "underscore_peaks",
    """select 'chr' || l_linenumber || '_' || l_partkey || '_' || (l_partkey + 500) as peak, 'chr' || l_linenumber as chrom,
        cast(l_partkey as bigint) as start, cast(l_partkey + 500 as bigint) as "end" from lineitem group by all""",
)
def underscore_peaks(spark, sf):
    lines = V.table(spark, sf, "lineitem")
    end = (F.col("l_partkey") + 500).cast("string")
    names = lines.select(
        F.concat(F.lit("chr"), F.concat_ws("_", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), end)).alias("peak")
    )
    return links.peak_table(names.distinct())


# The second mate of each pair lies 25 bases on. In the SQL it gets a name of its own, so that it counts by itself.
_MATES = f"(select * from ({ALN}) m1 union all select * replace (qname || '/2' as qname, pos + 25 as pos) from ({ALN}) m2)"
_PAIRED = _exonic_sql(_RNA, _RNA_BASES).replace(f"({ALN})", _MATES)


@_register(
    "rna_molecules_paired",
    f"""with e as ({_PAIRED}),
    n as (select cell_barcode, genome, gene, umi, cast(count(*) as bigint) as counts,
                 avg(case when exonic then 1.0 else 0.0 end) > 0.5 as exonic from e group by 1, 2, 3, 4)
    select n.*, coalesce(g.gene_name, split_part(n.gene, '_', 1)) as gene_name
    from n left join ({GEN}) g on g.gene_id = n.gene""",
)
def rna_molecules_paired(spark, sf):
    first = V.view(spark, sf, V.ALIGNMENT)
    spans = _rna_blocks(first.unionByName(first.withColumn("pos", F.col("pos") + 25)))
    genes = V.view(spark, sf, V.GENE)
    return postprocess.molecules.with_gene_names(
        postprocess.umi_reads(spans, genes, V.view(spark, sf, V.EXON), stranded=True), genes
    )
