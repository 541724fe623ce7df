"""The registered queries of the corpus operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import (
    decontaminate,
    exact_topk,
    fingerprints,
    hard_negatives,
    html_extract,
    line_dedup,
    near_dedup,
    packing,
    quality,
    token_alignment,
    token_counts,
    toxicity,
    url_filter,
)
from cellweave.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _register(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@_register("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.count_tokens(table(spark, sf_dir, "documents"))
    return out.withColumn("over_limit", F.col("n_tokens") > 1024)


@_register(
    "op3_line_dedup",
    r"""
    with units as (
        select doc_id, generate_subscripts(u, 1) - 1 as unit, unnest(u) as body
        from (select doc_id, string_split(text, chr(10)) as u from documents)),
    placed as (
        select *, cast(sum(length(body) + 1) over (partition by doc_id order by unit) - 1 - length(body) as bigint) as unit_at,
            trim(regexp_replace(lower(body), '[^\p{L}\p{M}\p{N}]+', ' ', 'g')) as plain from units),
    long as (
        select *, row_number() over (partition by plain order by doc_id, unit) > 1 as again
        from placed where plain <> '' and len(string_split(plain, ' ')) >= 5),
    cut as (
        select doc_id, unit, unit_at, generate_subscripts(p, 1) as nth, unnest(p) as piece
        from (select *, string_split(regexp_replace(body, '([.!?])([ \t]+)', '\1' || chr(1) || '\2', 'g'), chr(1)) as p from placed)),
    pieces as (
        select *, ltrim(piece, ' ' || chr(9)) as kept_piece,
            cast(unit_at + sum(length(piece)) over (partition by doc_id, unit order by nth) as bigint) as ends from cut),
    sentences as (
        select doc_id, unit, nth, ends, case when nth = 1 then piece else kept_piece end as sentence from pieces),
    normal as (
        select *, trim(regexp_replace(lower(sentence), '[^\p{L}\p{M}\p{N}]+', ' ', 'g')) as plain from sentences),
    ranked as (
        select *, row_number() over (partition by plain order by doc_id, unit, nth) > 1 as again,
            len(regexp_extract_all(sentence, '[\p{L}\p{N}]+')) as words from normal where plain <> ''),
    islands as (select *, count_if(not again) over (partition by doc_id order by unit, nth) as island from ranked),
    runs as (select *, sum(words) filter (again) over (partition by doc_id, island) as run from islands),
    judged as (
        select s.doc_id, s.unit, s.nth, s.ends, s.sentence,
            coalesce(l.again, false) or coalesce(r.again and r.run >= 30, false) as gone
        from sentences s left join long l on s.doc_id = l.doc_id and s.unit = l.unit
            left join runs r on s.doc_id = r.doc_id and s.unit = r.unit and s.nth = r.nth),
    by_unit as (
        select doc_id, unit, bool_or(gone) as partly, bool_and(gone) as wholly,
            coalesce(string_agg(sentence, ' ' order by nth) filter (not gone), '') as rest from judged group by 1, 2),
    kept as (
        select b.doc_id, coalesce(string_agg(case when partly then rest else body end, chr(10) order by b.unit) filter (not wholly), '') as text
        from by_unit b join placed p on b.doc_id = p.doc_id and b.unit = p.unit group by 1),
    edges as (
        select *, count_if(not gone) over (partition by doc_id, unit order by nth) as block from judged),
    spans as (
        select doc_id, unit, min(ends - length(sentence)) as span_start, max(ends) as span_end
        from edges where gone group by doc_id, unit, block),
    listed as (
        select doc_id, cast(count(*) as integer) as n_removed,
            string_agg(span_start || '-' || span_end, ',' order by span_start, span_end) as removed_spans
        from spans group by 1)
    select d.doc_id, case when l.doc_id is null then d.text else k.text end as text,
        cast(case when coalesce(d.text, '') = '' then 0 else len(string_split(d.text, chr(10))) end as integer) as n_units,
        coalesce(l.n_removed, 0) as n_removed, coalesce(l.removed_spans, '') as removed_spans
    from documents d left join kept k on d.doc_id = k.doc_id left join listed l on d.doc_id = l.doc_id
    """,
)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    spans = F.transform("removed", lambda r: F.concat_ws("-", r["start"].cast("string"), r["end"].cast("string")))
    return out.select("doc_id", "text", "n_units", "n_removed", F.concat_ws(",", spans).alias("removed_spans"))


@_register(
    "op4_url_filter",
    r"""
    with split as (
        select page_id, regexp_extract(url, '(?s)^.*?://(.*)$', 1) as rest from pages),
    parts as (
        select page_id,
            coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
            coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
        from split),
    rules(rule_host, rule_path, rule_verdict) as (
        values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
            ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    fits as (
        select page_id, rule_host || rule_path as rule, rule_verdict as verdict,
            row_number() over (partition by page_id order by length(rule_host || rule_path) desc, length(rule_host) desc) as nth
        from parts join rules
            on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
    select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') as verdict
    from parts p left join fits f on p.page_id = f.page_id and f.nth = 1
    """,
)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


@_register("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@_register(
    "op10_decontamination",
    rf"""
    with d as (select doc_id, regexp_extract_all({_LOWER}, '{_WORD}') as w from documents),
    b as (select item_id, regexp_extract_all({_LOWER}, '{_WORD}') as w from benchmark),
    windows as (
        select distinct item_id, least(10, len(w)) as n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as g
        from b, lateral (select unnest(generate_series(1, greatest(len(w) - 9, 1))) as i) where len(w) > 0),
    sizes as (select distinct n from windows),
    grams as (
        select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as g
        from d, sizes, lateral (select unnest(generate_series(1, len(w) - n + 1)) as i) where len(w) >= n),
    met as (select doc_id, item_id, i, n from grams join windows using (n, g)),
    hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(i, i + n - 1)) as p from met) group by 1),
    listed as (
        select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
        from (select distinct doc_id, cast(item_id as varchar) as item from met) group by 1)
    select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
        sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join hit on d.doc_id = hit.doc_id left join listed on d.doc_id = listed.doc_id
    """,
)
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


@_register("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_register("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


@_register("op8_near_dedup")
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_classes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "keep")


@_register("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@_register("op5_html_extraction")
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def _floors(factor: int) -> str:
    """SQL of the integer vectors, as doubles: their products and sums are whole numbers."""
    return f"""
        select *, list_transform(embedding, lambda x: floor({factor} * cast(x as double))) as v from embeddings
        where vec_id is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"""


@_register(
    "op11_hard_negatives",
    f"""
    with rows as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, v
        from ({_floors(256)}) where label is not null),
    pairs as (
        select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.v, b.v) as bigint) as score
        from rows a join rows b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
    positives as (
        select anchor_id, vec_id as positive_id, score as positive_score from pairs where same
        qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
    select p.anchor_id, p.positive_id, cast(row_number() over (w) as integer) as rank, n.vec_id as negative_id, p.positive_score, n.score as negative_score
    from positives p join pairs n
        on p.anchor_id = n.anchor_id and not n.same and 80 * p.positive_score <= 100 * n.score and n.score <= p.positive_score
    window w as (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id)
    qualify row_number() over (w) <= 5
    """,
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_embeddings(table(spark, sf_dir, "embeddings"))


@_register(
    "op12_exact_topk",
    f"""
    with rows as (select vec_id, v from ({_floors(1024)})),
    pairs as (
        select a.vec_id as query_id, b.vec_id, cast(list_dot_product(a.v, b.v) as bigint) as score
        from rows a join rows b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id)
    select query_id, cast(row_number() over (w) as integer) as rank, vec_id, score from pairs
    window w as (partition by query_id order by score desc, vec_id)
    qualify row_number() over (w) <= 10
    """,
)
def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.search_embeddings(table(spark, sf_dir, "embeddings"))


@_register("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(table(spark, sf_dir, "documents"))
