"""Registered queries over barcoded reads and sequence functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions import seq as S
from cellweave.functions.distance import free_divergence
from cellweave.lineage import cut
from cellweave.operators import barcode, report, trim
from cellweave.plans import demultiplex
from cellweave.plans import views as V
from cellweave.plans.catalog import ALN, CFG, RDP, SBC, WL1, WL2, WL3, _r, _register, _stored
from cellweave.plans.views import dna

FAS = V.oracle_text(V.FASTA)
RRD = V.oracle_text(V.RNA_READ)


def _dp_sql(a: str, b: str, n: str) -> str:
    """The free-divergence recurrence row by row with DuckDB list folds."""
    inner = (
        f"list_reduce(list_transform(range(1, {n} + 1), lambda j: [j]), lambda acc, j: list_append(acc, least("
        f"prev[j[1]] + case when substring({a}, i[1]::int, 1) = substring({b}, j[1]::int, 1) then 0 else 1 end, "
        f"prev[j[1] + 1] + case when j[1] = {n} then 0 else 1 end, "
        f"acc[j[1]] + case when i[1] = {n} then 0 else 1 end)), [i[1]])"
    )
    return (
        f"list_reduce(list_transform(range(1, {n} + 1), lambda i: [i]), lambda prev, i: {inner}, "
        f"range(0, {n} + 1))[{n} + 1]"
    )


def _near1(s: str, w: str) -> str:
    """Distance at most 1, stated by the edits it allows and not by the recurrence."""
    def drops(x, y):
        return (
            f"list_contains(list_transform(range(1, length({x}) + 1), "
            f"lambda i: substring({x}, 1, (i - 1)::int) || substring({x}, (i + 1)::int)), left({y}, length({y}) - 1))"
        )
    return f"(hamming({s}, {w}) <= 1 or {drops(s, w)} or {drops(w, s)})"


def _nearest_sql(obs: str, wl: str) -> str:
    """(obs, barcode, d): nearest whitelist entries of the same length at distance 0 or 1."""
    return f"""select obs, barcode, d from (
        select obs, barcode, d, min(d) over (partition by obs) as dm from (
          select o.obs, w.barcode, case when o.obs = w.barcode then 0 else 1 end as d
          from ({obs}) o join ({wl}) w on length(o.obs) = length(w.barcode) where {_near1("o.obs", "w.barcode")}) x) y where d = dm"""


_PFX = f"select substring(barcode, 1, 8) as barcode, max(length(barcode) - 8) as shift from ({WL1}) w group by 1"
_READS = f"""rd as (select * from ({RDP}) r),
    pf as ({_PFX}),
    pm as (select n.obs, count(*) as n_prefix, max(shift) as shift from ({_nearest_sql("select distinct substring(seq1, 11, 8) as obs from rd", "select barcode from pf")}) n
           join pf using (barcode) group by 1),
    sl as (select rd.*, case when n_prefix = 1 then null when n_prefix > 1 then 'multi_match' else 'no_match' end as slice_status,
             case when n_prefix = 1 then shift else 0 end as sh from rd left join pm on pm.obs = substring(seq1, 11, 8)),
    s2 as (select *, case when slice_status is null then substring(seq1, 11, (8 + sh)::int) end as obs1,
             case when slice_status is null then substring(seq1, (36 + sh)::int, 6) end as obs2,
             case when slice_status is null then translate(reverse(substring(split_part(split_part(name1, ':', -1), '+', 2), 1, 16)), 'ACGT', 'TGCA') end as obs3,
             case when slice_status is null then substring(seq1, 1, 10) end as umi from sl)"""
# The whitelist pass reads the prefix at distance 0.
_EXACT = f"""xs as (select rd.*, pf.shift from ({RDP}) rd left join ({_PFX}) pf on pf.barcode = substring(seq1, 11, 8)),
    x2 as (select ordinal, shift is not null as known, substring(seq1, 11, (8 + shift)::int) in (select barcode from ({WL1}) a) as h1,
             substring(seq1, (36 + shift)::int, 6) in (select barcode from ({WL2}) a) as h2,
             translate(reverse(substring(split_part(split_part(name1, ':', -1), '+', 2), 1, 16)), 'ACGT', 'TGCA') in (select barcode from ({WL3}) a) and shift is not null as h3,
             substring(seq1, 11, (8 + shift)::int) as bc1, substring(seq1, (36 + shift)::int, 6) as bc2,
             translate(reverse(substring(split_part(split_part(name1, ':', -1), '+', 2), 1, 16)), 'ACGT', 'TGCA') as bc3 from xs)"""
_TRIPLES = "tp as (select bc1, bc2, bc3, count(*) as n from x2 where h1 and h2 and h3 group by 1, 2, 3)"
_STATUS = f"""{_READS}, {_EXACT}, {_TRIPLES},
    m1 as ({_nearest_sql("select distinct obs1 as obs from s2 where obs1 is not null", WL1)}),
    m2 as ({_nearest_sql("select distinct obs2 as obs from s2 where obs2 is not null", WL2)}),
    m3 as ({_nearest_sql("select distinct obs3 as obs from s2 where obs3 is not null", WL3)}),
    cand as (select s2.ordinal, m1.barcode as b1, m2.barcode as b2, m3.barcode as b3, m1.d + m2.d + m3.d as d,
               tp.n is not null as seen
             from s2 join m1 on m1.obs = obs1 join m2 on m2.obs = obs2 join m3 on m3.obs = obs3
             left join tp on tp.bc1 = m1.barcode and tp.bc2 = m2.barcode and tp.bc3 = m3.barcode),
    agg as (select ordinal, bool_or(d = 0) as perfect, count_if(seen) as n,
              coalesce(min(b1) filter (d = 0), min(b1) filter (seen)) as b1, coalesce(min(b2) filter (d = 0), min(b2) filter (seen)) as b2,
              coalesce(min(b3) filter (d = 0), min(b3) filter (seen)) as b3 from cand group by 1),
    st as (select s2.*, case when slice_status is not null then slice_status when perfect then 'perfect' when agg.n = 1 then 'correct'
               when agg.n > 1 then 'multi_match' else 'no_match' end as status, b1, b2, b3 from s2 left join agg using (ordinal)),
    co as (select *, case when status in ('perfect', 'correct') then b1 end as bc1, case when status in ('perfect', 'correct') then b2 end as bc2,
             case when status in ('perfect', 'correct') then b3 end as bc3 from st)"""
_TAGGED = f"""{_STATUS},
    pd as (select *, greatest((41 + sh + 20)::int, length(seq1)) - length(seq1) as more from co where bc1 is not null),
    p2 as (select *, seq1 || repeat('N', more) as s, qual1 || repeat(right(qual1, 1), more) as q, substring(seq1 || repeat('N', more), (42 + sh)::int, 19) as cut from pd),
    dd as (select cut, {_dp_sql("cut", f"'{V.TAG}'", "19")} as d from (select distinct cut from p2) c),
    tg as (select p2.*, case when d <= 2 then 'A' when d >= 9 then 'R' else 'W' end as tag from p2 join dd using (cut)),
    fin as (select ordinal, tag, 'LIB1.' || bc1 || bc2 || bc3 as cell_barcode, umi, bc2, name1, seq2,
              substring(s, (42 + sh + case when tag = 'R' then 0 else 19 end)::int) as seq1,
              substring(q, (42 + sh + case when tag = 'R' then 0 else 19 end)::int) as qual1 from tg)"""


def _whitelists(spark, sf):
    # Made from whole tables, they would be made again for each join.
    return [_stored(spark, sf, w) for w in (V.WHITELIST1, V.WHITELIST2, V.WHITELIST3)]


def _sliced(spark, sf, max_d=1):
    reads = V.view(spark, sf, V.READ_PAIR)
    wl1 = V.view(spark, sf, V.WHITELIST1)
    return barcode.slice_shifted(reads, barcode.prefix_map(wl1, 8, max_d), CFG)


def _triples(spark, sf):
    reads = V.view(spark, sf, V.READ_PAIR)
    exact = barcode.prefix_map(V.view(spark, sf, V.WHITELIST1), 8, 0)
    return barcode.perfect_triples(barcode.slice_shifted(reads, exact, CFG), _whitelists(spark, sf))


def _sample_size(spark, sf):
    # A third of the reads: the rounding rule then gives a step of 3 at every scale.
    return spark.read.parquet(f"{sf}/orders.parquet").count() // 3


def _parsed(spark, sf, *unused):
    """(sliced, corrected, tagged) of the reads, stored once as a trimmed library would be.

    Spark prunes no column of what is stored: columns that a query has no use for are named, not made, and null.
    """
    index = demultiplex.build_index(_whitelists(spark, sf), CFG)
    reads = cut(V.view(spark, sf, V.READ_PAIR).drop(*unused)).withColumns({c: F.lit(None).cast("string") for c in unused})
    return demultiplex.parse_library(reads, index, CFG, "LIB1.")


def _corrected(spark, sf):
    return _parsed(spark, sf, "name2", "seq2", "qual1", "qual2")[1]


def _tagged(spark, sf, *unused):
    return _parsed(spark, sf, "name2", "qual2", *unused)[2]


_WLS = f"select substring({dna('cast(s_suppkey as string)')}, 1, 6) as barcode from supplier group by 1"


@_register(
    "whitelist_neighbours",
    f"""with b as (select unnest(['A','C','G','T']) as x),
    mers as (select a.x || c.x || d.x || e.x || f.x || g.x as obs from b a, b c, b d, b e, b f, b g)
    {_nearest_sql("select obs from mers", _WLS)}""",
)
def whitelist_neighbours(spark, sf):
    wl = V.view(spark, sf, f"select substring({dna('cast(s_suppkey as string)')}, 1, 6) as barcode from {{supplier}}")
    return barcode.neighbour_map(wl, 1)


@_register(
    "free_divergence",
    f"""select ordinal, cast({_dp_sql("a", "b", "8")} as int) as d from (
        select o_orderkey as ordinal, substring({dna("'x' || cast(o_orderkey as string)")}, 1, 8) as a,
               substring({dna("'x' || cast(o_orderkey as string)")}, cast(1 + o_orderkey % 5 as int), 8) as b from orders) p""",
)
def free_divergence_pairs(spark, sf):
    text = f"""select o_orderkey as ordinal, substring({dna("'x' || cast(o_orderkey as string)")}, 1, 8) as a,
        substring({dna("'x' || cast(o_orderkey as string)")}, cast(1 + o_orderkey % 5 as int), 8) as b from {{orders}}"""
    pairs = V.view(spark, sf, text)
    return pairs.select("ordinal", free_divergence(F.col("a"), F.col("b")).alias("d"))


@_register(
    "levenshtein_distance",
    f"""select o_orderkey as ordinal, cast(levenshtein(substring({dna("'x' || cast(o_orderkey as string)")}, 1, 8),
        substring({dna("'y' || cast(o_orderkey as string)")}, 1, 8)) as int) as d from orders""",
)
def levenshtein_pairs(spark, sf):
    text = f"""select o_orderkey as ordinal, substring({dna("'x' || cast(o_orderkey as string)")}, 1, 8) as a,
        substring({dna("'y' || cast(o_orderkey as string)")}, 1, 8) as b from {{orders}}"""
    return V.view(spark, sf, text).select("ordinal", F.levenshtein("a", "b").alias("d"))


@_register(
    "shifted_slices",
    f"with {_READS} select ordinal, slice_status, obs1, obs2, obs3, umi from s2",
)
def shifted_slices(spark, sf):
    return _sliced(spark, sf).select("ordinal", "slice_status", "obs1", "obs2", "obs3", "umi")


_FIXED = [(0, 10), (10, 8), (18, 8), (26, 6)]


@_register(
    "fixed_slices",
    f"""select ordinal, substring(seq2, 1, 10) as umi, substring(seq2, 11, 8) as obs1, substring(seq2, 19, 8) as obs2,
        substring(seq2, 27, 6) as obs3 from ({RDP}) r""",
)
def fixed_slices(spark, sf):
    from dataclasses import replace

    cfg = replace(CFG, umi_bc_len=(10, 8, 8, 6), umi_bc_starts=(0, 10, 18, 26), tag_start=32)
    out = barcode.slice_fixed(V.view(spark, sf, V.READ_PAIR), cfg)
    return out.select("ordinal", "umi", "obs1", "obs2", "obs3")


@_register("systematic_sample", f"select ordinal from ({RDP}) r where ordinal % 3 = 0")
def systematic_sample(spark, sf):
    return barcode.systematic_sample(V.view(spark, sf, V.READ_PAIR), _sample_size(spark, sf)).select("ordinal")


@_register(
    "perfect_triples",
    f"with {_EXACT}, {_TRIPLES} select bc1, bc2, bc3, cast(n as bigint) as n from tp",
)
def perfect_triples(spark, sf):
    return _triples(spark, sf)


@_register(
    "perfect_rates",
    f"""with {_EXACT} select round(avg((coalesce(h1 and h2 and h3, false))::int), 9) as perfect_barcodes_all, round(avg(coalesce(h1, false)::int), 9) as perfect_barcode1,
        round(avg(coalesce(h2, false)::int), 9) as perfect_barcode2, round(avg(h3::int), 9) as perfect_barcode3,
        round(avg(known::int), 9) as perfect_barcode1_part from x2""",
)
def perfect_rates(spark, sf):
    rates = barcode.perfect_rates(_sliced(spark, sf, 0), _whitelists(spark, sf))
    return rates.select(*[_r(c, 9).alias(c) for c in rates.columns])


@_register("corrected_barcodes", f"with {_STATUS} select ordinal, status, bc1, bc2, bc3, umi from co")
def corrected_barcodes(spark, sf):
    return _corrected(spark, sf).select("ordinal", "status", "bc1", "bc2", "bc3", "umi")


@_register("status_counts", f"with {_STATUS} select status, cast(count(*) as bigint) as reads from co group by 1")
def status_counts(spark, sf):
    return barcode.status_counts(_corrected(spark, sf))


@_register("tagged_reads", f"with {_TAGGED} select ordinal, tag, cell_barcode, umi, seq1, qual1 from fin")
def tagged_reads(spark, sf):
    return _tagged(spark, sf, "seq2").select("ordinal", "tag", "cell_barcode", "umi", "seq1", "qual1")


@_register("tag_counts", f"with {_TAGGED} select tag, cast(count(*) as bigint) as reads from fin group by 1")
def tag_counts(spark, sf):
    return barcode.tag_counts(_tagged(spark, sf, "seq2", "qual1"))


@_register(
    "packed_names",
    f"with {_TAGGED} select ordinal, '@' || tag || '_' || cell_barcode || ':' || umi || ':' || substring(split_part(name1, ' ', 1), 2) as name from fin",
)
def packed_names(spark, sf):
    return _tagged(spark, sf, "seq2", "qual1").select("ordinal", barcode.packed_name("name1").alias("name"))


@_register(
    "barcode_run_stats",
    f"""with {_TAGGED}, n as (select count(*) as n, count_if(status = 'perfect') as p, count_if(status = 'correct') as c,
         count_if(status = 'multi_match') as mm, count_if(status = 'no_match') as nm from co),
    t as (select count(*) as v, count_if(tag = 'A') as a, count_if(tag = 'R') as r, count_if(tag = 'W') as w from fin)
    select key, round(value, 9) as value from (select unnest([
      {{'key': 'fastq_reads', 'value': n::double}}, {{'key': '--perfect_match', 'value': p / n}}, {{'key': '--correct_match', 'value': c / n}},
      {{'key': 'multi_match', 'value': mm / n}}, {{'key': 'no_match', 'value': nm / n}}, {{'key': 'fastq_valid_barcode_reads', 'value': v::double}},
      {{'key': '--ATAC_valid_barcode_reads', 'value': a::double}}, {{'key': '--RNA_valid_barcode_reads', 'value': r::double}},
      {{'key': '--Undetermined_valid_barcode_reads', 'value': w::double}}, {{'key': 'fastq_valid_rate', 'value': v / n}},
      {{'key': '--ATAC_valid', 'value': a / n}}, {{'key': '--RNA_valid', 'value': r / n}}, {{'key': '--Undetermined_valid', 'value': w / n}}], recursive := true) from n, t)""",
)
def barcode_run_stats(spark, sf):
    _, corrected, tagged = _parsed(spark, sf, "name2", "seq2", "qual1", "qual2")
    stats = barcode.run_stats(corrected, tagged)
    return stats.withColumn("value", _r("value", 9))


def _q30_sql(q: str) -> str:
    return f"avg(len(list_filter(string_split({q}, ''), lambda c: ord(c) > 62))::double / length({q}))"


@_register(
    "quality_summary",
    f"""with {_READS} select round({_q30_sql("substring(qual1, 1, 10)")}, 9) as umi_q30,
      round({_q30_sql("substring(qual1, 11, (8 + sh)::int)")}, 9) as bc1_q30, round({_q30_sql("substring(qual1, (36 + sh)::int, 6)")}, 9) as bc2_q30,
      null::double as bc3_q30, round({_q30_sql("substring(qual1, (42 + sh)::int)")}, 9) as r1_cdna_q30, round({_q30_sql("qual2")}, 9) as r2_cdna_q30 from s2""",
)
def quality_summary(spark, sf):
    out = barcode.quality_summary(_sliced(spark, sf), CFG)
    return out.select(*[_r(c, 9).alias(c) for c in out.columns])


@_register(
    "sample_shares",
    f"""with {_TAGGED} select s.sample, cast(count(*) as bigint) as reads, round(count(*) / (select count(*) from fin), 9) as share
        from fin left join ({SBC}) s on s.bc = fin.bc2 group by 1""",
)
def sample_shares(spark, sf):
    sampled = barcode.with_sample(_tagged(spark, sf, "seq2", "qual1"), V.view(spark, sf, V.SAMPLE_BC))
    return barcode.sample_shares(sampled).withColumn("share", _r("share", 9))


@_register(
    "barcode_shares",
    f"""with {_TAGGED} select bc2, cast(count(*) as bigint) as reads, round(count(*) / (select count(*) from fin), 9) as share from fin group by 1""",
)
def barcode_shares(spark, sf):
    return barcode.sample_shares(_tagged(spark, sf, "seq2", "qual1"), "bc2").withColumn("share", _r("share", 9))


@_register(
    "split_modalities",
    f"""with {_TAGGED} select s.sample, fin.tag, cast(count(*) as bigint) as reads from fin join ({SBC}) s on s.bc = fin.bc2
        where not (fin.tag = 'A' and length(fin.seq2) + 1 < 20) group by 1, 2""",
)
def split_modalities(spark, sf):
    sampled = barcode.with_sample(_tagged(spark, sf, "qual1"), V.view(spark, sf, V.SAMPLE_BC))
    return barcode.split_modalities(sampled, CFG).groupBy("sample", "tag").agg(F.count("*").alias("reads"))


@_register(
    "zipped_index_reads",
    f"""select ordinal, name1 || '+' || substring(seq1, 11, 16) as name1, seq1, qual1, name2 || '+' || substring(seq1, 11, 16) as name2, seq2, qual2
        from ({RDP}) r""",
)
def zipped_index_reads(spark, sf):
    reads = V.view(spark, sf, V.READ_PAIR)
    one = reads.select("ordinal", F.col("name1").alias("name"), F.col("seq1").alias("seq"), F.col("qual1").alias("qual"))
    two = reads.select("ordinal", F.substring("seq1", 11, 16).alias("seq"))
    three = reads.select("ordinal", F.col("name2").alias("name"), F.col("seq2").alias("seq"), F.col("qual2").alias("qual"))
    return barcode.zip_index_reads(one, two, three)


# ---- sequence functions ---------------------------------------------------------------------

_EV = f"""select event_id, {dna("cast(event_id as string)")} as s, {dna("'k' || cast(event_id as string)")} as t,
    translate(md5(cast(event_id as string)), '0123456789abcdef', '#,:;<=>?@ABCDEFG') as q from {{events}}"""


@_register(
    "sequence_functions",
    f"""select event_id, translate(reverse(s), 'ACGTN', 'TGCAN') as rc, round(100.0 * len(replace(replace(s, 'A', ''), 'T', '')) / 32, 6) as gc,
      round(len(list_filter(string_split(q, ''), lambda c: ord(c) > 62)) / 32.0, 6)::double as q30,
      cast(hamming(s, t) as int) as ham, cast(least(hamming(s, t), 2) as int) as ham2,
      cast(len(list_distinct(list_transform(range(1, 25), lambda i: substring(s, i::int, 8)))) as int) as kmers
      from ({V.oracle_text(_EV)}) e""",
)
def sequence_functions(spark, sf):
    e = V.view(spark, sf, _EV)
    return e.select(
        "event_id",
        S.reverse_complement("s").alias("rc"),
        _r(S.gc_percent("s")).alias("gc"),
        _r(S.q30_fraction("q")).alias("q30"),
        S.hamming("s", "t").alias("ham"),
        S.hamming("s", "t", cap=2).alias("ham2"),
        F.size(F.array_distinct(S.reference_kmers("s", 8))).alias("kmers"),
    )


@_register(
    "degenerate_expansion",
    f"""select event_id, replace(replace(left(s, 2) || '1' || substring(s, 4, 2) || '2', '1', a.b), '2', c.b) as seq
        from ({V.oracle_text(_EV)}) e, (select unnest(['A','G','C','T']) as b) a, (select unnest(['A','G','C','T']) as b) c""",
)
def degenerate_expansion(spark, sf):
    e = V.view(spark, sf, _EV)
    pattern = F.concat(F.substring("s", 1, 2), F.lit("N"), F.substring("s", 4, 2), F.lit("N"))
    return e.select("event_id", F.explode(S.expand_degenerate(pattern)).alias("seq"))


@_register(
    "single_substitutions",
    f"""select event_id, left(s, i - 1) || b || substring(s, i + 1, 6 - i) as seq
        from ({V.oracle_text(_EV)}) e, (select unnest(range(1, 7))::int as i) p, (select unnest(['A','C','G','T']) as b) a
        where substring(s, i, 1) <> b""",
)
def single_substitutions(spark, sf):
    e = V.view(spark, sf, _EV)
    return e.select("event_id", F.explode(S.single_substitutions(F.substring("s", 1, 6))).alias("seq"))


@_register(
    "read_name_fields",
    f"""select 'A_' || qname as name, split_part(qname, ':', 1) as cell, split_part(qname, ':', 2) as umi, split_part(chrom, '_', 1) as genome from ({ALN}) a""",
)
def read_name_fields(spark, sf):
    a = V.view(spark, sf, V.ALIGNMENT).select(F.concat(F.lit("A_"), "qname").alias("name"), "chrom")
    return a.select(
        "name", S.cell_from_qname("name").alias("cell"), S.umi_from_qname("name").alias("umi"),
        S.genome_from_contig("chrom").alias("genome"),
    )


_KREF = f"""km as (select distinct strand, substring(s, i::int, 30) as kmer from (
      select strand, s, unnest(range(1, length(s) - 30 + 1)) as i from (
        select 'sense' as strand, seq as s from ({FAS}) f union all
        select 'antisense', translate(reverse(seq), 'ACGT', 'TGCA') from ({FAS}) f) b) k)"""
_KHIT = f"""{_KREF}, pr as (select ordinal, unnest(list_transform(range(1, length(seq) - 28, 10), lambda i: substring(seq, i::int, 30))) as kmer
      from ({RRD}) r),
    ht as (select ordinal, max(strand) as strand from pr join km using (kmer) group by 1)"""


@_register("kmer_hits", f"with {_KHIT} select ordinal, strand from ht")
def kmer_hits(spark, sf):
    return report.kmer_hits(V.view(spark, sf, V.RNA_READ), report.kmer_reference(V.view(spark, sf, V.FASTA)))


@_register(
    "kmer_summary",
    f"""with {_KHIT} select cast(count_if(strand = 'sense') as bigint) as sense, cast(count_if(strand = 'antisense') as bigint) as antisense,
        cast((select count(*) from ({RRD}) r) as bigint) as total_counts, round(count(*) / (select count(*) from ({RRD}) r), 9) as fraction from ht""",
)
def kmer_summary(spark, sf):
    out = report.kmer_summary(V.view(spark, sf, V.RNA_READ), report.kmer_reference(V.view(spark, sf, V.FASTA)))
    return out.withColumn("fraction", _r("fraction", 9))


@_register("read_lengths", f"select cast(length(seq) as int) as length, cast(count(*) as bigint) as n from ({RRD}) r group by 1")
def read_lengths(spark, sf):
    return report.read_lengths(V.view(spark, sf, V.RNA_READ))


# ---- trimming -------------------------------------------------------------------------------

def _run_sql(scores: str, n: str) -> str:
    """Length of the run to cut: where the running sum peaks before it first turns negative."""
    sums = f"list_transform(range(1, {n} + 1), lambda i: list_sum(list_slice({scores}, 1, i)))"
    before = f"list_slice({sums}, 1, coalesce(list_position(list_transform({sums}, lambda v: v < 0), true), {n} + 1) - 1)"
    return f"(select case when m > 0 then list_position(b, m) else 0 end from (select b, list_max(b) as m from (select {before} as b)))"


_PHRED = "list_transform(string_split(qual2, ''), lambda c: ord(c) - 33)"


@_register(
    "quality_trimmed",
    f"""with p as (select ordinal, seq2, length(qual2) as n, {_PHRED} as f from ({RDP}) r),
    b as (select ordinal, seq2, n, {_run_sql("list_transform(f, lambda v: 15 - v)", "n")} as lo,
            n - {_run_sql("list_transform(list_reverse(f), lambda v: 10 - v)", "n")} as hi from p)
    select ordinal, case when lo >= hi then '' else substring(seq2, (lo + 1)::int, (hi - lo)::int) end as seq from b""",
)
def quality_trimmed(spark, sf):
    reads = V.view(spark, sf, V.READ_PAIR)
    b = reads.withColumn("b", trim.trim_bounds(F.col("seq2"), F.col("qual2"), CFG.q5, CFG.q3, None))
    return b.select("ordinal", F.substr("seq2", F.col("b.lo") + 1, F.col("b.hi") - F.col("b.lo")).alias("seq"))


@_register("trimmed_pairs")
def trimmed_pairs(spark, sf):
    """Quality and adapter trimming of every pair; the alignment is checked by a plain loop in tests."""
    reads = V.view(spark, sf, V.READ_PAIR)
    with_adapter = reads.withColumns(
        {
            "seq1": F.concat("seq1", F.substring(F.lit(CFG.a1), 1, 25)),
            "qual1": F.concat("qual1", F.lit("I" * 25)),
        }
    )
    return trim.trim_pairs(with_adapter, CFG.q5, CFG.q3, (CFG.a1, CFG.a2), (10, 5)).select(
        "ordinal", "seq1", "qual1", "seq2", "qual2"
    )
