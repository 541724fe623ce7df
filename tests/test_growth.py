"""Joins that must not grow with the square of a table, nor go whole through the driver."""

import random
import re

from pyspark.sql import functions as F

from cellweave.functions.distance import free_divergence
from cellweave.llm import decontaminate
from cellweave.operators import atac, barcode, pileup, report, trim
from cellweave.plans import catalog_barcodes


def test_kmer_reference_is_not_broadcast(spark, tmp_path):
    lines = spark.createDataFrame([("a", "ACGTACGGTTAC"), ("b", "TTTTCCCCGGGA")], "name string, seq string")
    reads = spark.createDataFrame([(1, "ACGTACGGTT"), (2, "GTAACCGTAC"), (3, "AAAAAAAAAA")], "ordinal int, seq string")
    lines.write.parquet(f"{tmp_path}/lines")
    hits = report.kmer_hits(reads, report.kmer_reference(spark.read.parquet(f"{tmp_path}/lines"), 8), 8)
    assert "Broadcast" not in hits._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in hits.collect()} == {(1, "sense"), (2, "antisense")}


def test_tss_insertions_count_equal_ends_and_centres_once(spark):
    schema = "chrom string, cell_barcode string, pos bigint, tlen bigint, is_unmapped boolean, mapq int, is_reverse boolean"
    at = [0, 3, 1990, 1999, 2100, 3995, 3996, 5000, 6999, -2, None]
    rows = [("c", "xy"[i % 2], p, n, False, 60, False) for i, p in enumerate(at) for n in (0, 50, -300, 1008, 1009, None)] * 3
    reads = spark.createDataFrame(rows, schema)
    tss = spark.createDataFrame([("c", s, s + 1) for s in (0, 100, 2000, 2000, 5001)] + [("d", 7, 8)], "chrom string, start bigint, end bigint")
    for kind in (reads, reads.withColumn("read_end", F.col("pos") + 20)):
        plain = {tuple(r) for r in atac.insertion_histogram(atac.tss_pairs(kind, tss)).collect()}
        assert plain == {tuple(r) for r in atac.tss_insertions(kind, tss).collect()}
    met = spark.createDataFrame(rows * 20, schema)
    pairs = atac.tss_insertions(met, tss.unionByName(tss), by=())
    assert {r.offset: r.n for r in pairs.collect()} == {
        r.offset: r.n * 40 for r in atac.insertion_histogram(atac.tss_pairs(reads, tss)).groupBy("offset").agg(F.sum("n").alias("n")).collect()
    }


def test_tss_insertions_of_cells_are_counted_in_one_task(spark, monkeypatch):
    rng = random.Random(8)
    schema = "chrom string, cell_barcode string, pos bigint, tlen bigint, is_unmapped boolean, mapq int, is_reverse boolean"
    cell = lambda: rng.choice(["x", None, *(f"c{i}" for i in range(9))])
    rows = [(rng.choice(["c", "d", "e", None]), cell(), rng.randrange(-3000, 40_000), rng.randrange(-1200, 1200), False, 60, False) for _ in range(600)]
    reads = spark.createDataFrame(rows + rows[:200] * 3, schema)
    close = [("c", s, s + 1) for s in range(15_000, 19_000, 5)]  # more than MANY in a window
    apart = [(c, s, s + 2) for c in ("c", "d", "f", None) for s in [-4100, -3990, -60, *range(0, 40_000, 997)]]
    tss = spark.createDataFrame(close + apart * 2, "chrom string, start bigint, end bigint")
    plain = {tuple(r) for r in atac.insertion_histogram(atac.tss_pairs(reads, tss)).collect()}
    assert len(plain) > 10_000
    plan = atac.tss_insertions(reads, tss)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan.split("MapInArrow")[0]  # nothing is shuffled behind the counts
    monkeypatch.setattr(atac, "CELLS", 2)
    monkeypatch.setattr(atac, "ROWS", 7)
    for rows_a_batch in ("10000", "5"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_batch)
        try:
            got = [tuple(r) for r in atac.tss_insertions(reads, tss).collect()]
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert len(got) == len(plain) and set(got) == plain
    assert atac.tss_insertions(reads, tss.where("false")).collect() == []


def test_region_counts_are_dealt_to_tasks_by_their_pairs(spark, monkeypatch):
    frags = [("c", s, s + n, f"x{i % 3}") for i, s in enumerate(range(-40, 9000, 37)) for n in (0, 1, 60, 700)] * 2
    frags += [("c", None, 5, "x0"), ("d", 3, 9, None), (None, 1, 9, "x0")]
    regions = [("c", s, s + n) for s in range(-100, 9000, 211) for n in (0, 1, 500)] + [("c", 0, 500)] * 2
    regions += [("c", -5, 20_000), ("c", 100, 100 + atac.LONG), ("d", 0, 4), (None, 0, 4), ("c", 7, None)]
    fragments = spark.createDataFrame(frags, "chrom string, frag_start bigint, frag_end bigint, cell_barcode string")
    spots = spark.createDataFrame(regions, "chrom string, start bigint, end bigint")
    want = {}
    for c, s, e in regions:
        for fc, fs, fe, cell in frags:
            if None not in (c, s, e, fs, fe) and c == fc and s < e and fs < fe and s < fe and fs < e:
                want[f"{c}:{s}-{e}", cell] = want.get((f"{c}:{s}-{e}", cell), 0) + 1
    monkeypatch.setattr(atac, "TASK_PAIRS", 2000)
    for width in (64, 2048):
        assert {(r.peak, r.cell_barcode): r.value for r in atac.count_regions(spots, fragments, width=width).collect()} == want
    assert {r.value for r in atac.count_regions(spots, fragments, binary=True).collect()} == {1}
    short = atac.count_regions(spots.where(F.col("end") - F.col("start") <= 500), fragments)
    assert short.rdd.getNumPartitions() > 4  # more than the session's shuffle partitions
    # Pairs are counted in the task that makes them: no shuffle between the join and the counts.
    assert "Exchange" not in short._jdf.queryExecution().executedPlan().toString().split("Join")[0]


def test_pileup_shuffles_blocks_not_bases(spark, tmp_path, monkeypatch):
    genome = spark.createDataFrame([("c", 64 * i, "ACGT" * 16) for i in range(8)], "chrom string, offset bigint, seq string")
    rows = [(f"r{i}", 0, "c", 3 * i, 60, "8M2D4M2I6M", "ACGT" * 5, "I" * 20) for i in range(150)] * 2
    reads = spark.createDataFrame(rows, "qname string, flag int, reference_name string, pos bigint, mapq int, cigar string, seq string, qual string")
    stored = []
    monkeypatch.setattr(pileup, "cut", lambda df: stored.append(df) or df)
    monkeypatch.setattr(pileup, "TASK_BASES", 500)
    out = pileup.pileup_rows(reads, genome, chunk=64)
    assert not stored  # nothing is stored when no read skips
    # Grouped where the bases are spread: nothing is shuffled behind the last join.
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString().split("Join")[0]
    assert out.rdd.getNumPartitions() > 4
    whole = {(r.chrom, r.pos): tuple(r) for r in out.collect()}
    assert sum(r[3] for r in whole.values()) == sum(20 for i in range(150) if 3 * i + 20 <= 512) * 2
    monkeypatch.setattr(pileup, "TASK_BASES", 1 << 21)
    skipping = spark.createDataFrame([("s", 0, "c", 500, 60, "2M600N2M", "ACGT", "IIII")], reads.schema)
    mixed = pileup.pileup_rows(reads.unionByName(skipping), genome, chunk=64)
    assert len(stored) == 1  # with skips the rows are met twice
    assert {k: v for k, v in ((((r.chrom, r.pos)), tuple(r)) for r in mixed.collect()) if k[1] <= 400} == {k: v for k, v in whole.items() if k[1] <= 400}


def _pileup_by_hand(reads, text):
    """{place: (depth, tokens, qualities, names)}, base by base."""
    sites = {}
    for name, flag, _, pos, mapq, cigar, seq, qual in reads:
        back, at, base = bool(flag & 16), pos, 0
        items = [(int(n), op) for n, op in re.findall(r"(\d+)([MIDS])", cigar)]
        ends = [i for i, (_, op) in enumerate(items) if op in "MD"]
        cased = lambda x: x.lower() if back else x  # noqa: B023, E731
        for i, (n, op) in enumerate(items):
            after, kind = items[i + 1] if i + 1 < len(items) else (0, "")
            for k in range(n if op in "MD" else 0):
                p, here = at + k, max(base - 1, 0) if op == "D" else base + k
                own = "~" if qual == "*" else qual[here]
                same = op == "M" and seq[here] == text[p] != "N"
                token = "*" if op == "D" else ("," if back else ".") if same else cased(seq[here])
                token = f"^{chr(min(mapq, 93) + 33)}{token}" if p == pos and op == "M" else token
                if k == n - 1 and op == "M" and kind == "I":
                    token += f"+{after}{cased(seq[base + n : base + n + after])}"
                if k == n - 1 and op == "M" and kind == "D" and name is not None:
                    token += f"-{after}{cased(text[p + 1 : p + 1 + after])}"
                token += "$" if k == n - 1 and i == ends[-1] else ""
                if ord(own) - 33 >= 13:
                    sites.setdefault((p + 1, text[p]), []).append((pos, name is not None, name or "", flag, token, own))
            at, base = at + n * (op in "MD"), base + n * (op in "MIS")
    return {k: (len(v), "".join(r[4] for r in sorted(v)), "".join(r[5] for r in sorted(v)), ",".join(r[2] for r in sorted(v) if r[1])) for k, v in sites.items()}


def test_pileup_spreads_blocks_in_arrays(spark, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("ACGTN") for _ in range(600))
    rows = []
    for i in range(500):
        pos, cigar = rng.choice([rng.randrange(560), rng.randrange(100, 110)]), rng.choice(["20M", "8M2I10M", "8M3D12M", "3S17M", "4M6D2M1I13M", "2D18M2S", "1M1D1M1D18M"])
        seq = "".join(rng.choice(["A", "C", "G", "T", text[min(pos + k, 599)], text[min(pos + k, 599)]]) for k in range(20))
        qual = rng.choice(["*", "".join(rng.choice("&*5I") for _ in range(20))])
        rows.append((rng.choice([None, "r1", f"q{i}"]), rng.choice([0, 16]), "c", pos, rng.choice([0, 60, 255]), cigar, seq, qual))
    rows += rows[:50] + [(*r[:6], r[6][::-1], r[7]) for r in rows[:50]]  # equal names and starts
    reads = spark.createDataFrame(rows, "qname string, flag int, reference_name string, pos bigint, mapq int, cigar string, seq string, qual string")
    genome = spark.createDataFrame([("c", k, text[k : k + 32]) for k in range(0, 600, 32)], "chrom string, offset bigint, seq string")
    want = _pileup_by_hand(rows, text)
    for room, chunk in ((1 << 19, 32), (40, 32), (40, 128), (700, 128)):
        monkeypatch.setattr(pileup, "BASES", room)
        out = pileup.pileup_rows(reads, genome, chunk=chunk)
        got = [tuple(r) for r in out.collect()]
        assert len(got) == len(want) and {(r[1], r[2]): r[3:] for r in got} == want
    # No row per base behind the join with the contig: neither spread nor grouped as rows.
    above = out._jdf.queryExecution().executedPlan().toString().split("Join")[0]
    assert "Generate" not in above and "Aggregate" not in above
    single = {}
    for r in pileup.pileup_reads(reads, genome, chunk=128).collect():
        single.setdefault((r.pos, r.ref), []).append((r.token, r.qual))
    assert {k: len(v) for k, v in single.items()} == {k: v[0] for k, v in want.items()}
    assert all(sorted("".join(t for t, _ in v)) == sorted(want[k][1]) for k, v in single.items())


def test_adapter_search_aligns_only_reads_that_may_match(monkeypatch):
    rng, aligned, align = random.Random(3), [], trim._align_adapter3
    monkeypatch.setattr(trim, "_align_adapter3", lambda seqs, adapter: aligned.append(len(seqs)) or align(seqs, adapter))
    for adapter in ("CTGTCTCTTATACACATCTCCGAGCCCACGAGAC", "CTGTCTCTTATACACATCT", "AAAAAAAAAAAAAAA", "TACTGCAGC", "ACAC", "AC"):
        reads = ["", "A", adapter[:2], adapter[:3]]
        for _ in range(4000):
            part = list(adapter[: rng.randrange(len(adapter) + 1)] if rng.random() < 0.7 else adapter)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 4))):
                k = rng.randrange(len(part) + 1)
                part[k : k + rng.randrange(2)] = rng.choices("ACGTN", k=rng.randrange(2))
            before = adapter[: rng.randrange(len(adapter))] if rng.random() < 0.3 else ""
            tail = "".join(rng.choices("ACGT", k=rng.choice((0, 0, 3, 9))))
            reads.append("".join(rng.choices("ACGT", k=rng.randrange(30))) + before + "".join(part) + tail)
        at, found = trim.find_adapter3(reads, adapter)
        rest = [r for r in reads if adapter not in r]
        want_at, want_found = align(rest, adapter)
        mine = [i for i, r in enumerate(reads) if adapter not in r]
        assert at[mine].tolist() == want_at.tolist() and found[mine].tolist() == want_found.tolist()
        assert all(found[i] and at[i] == r.find(adapter) for i, r in enumerate(reads) if adapter in r)
    aligned.clear()
    inserts = ["".join(rng.choices("ACGT", k=40)) for _ in range(2000)]
    trim.find_adapter3([s + "CTGTCTCTTATACACATCTCCGAGC" for s in inserts], "CTGTCTCTTATACACATCTCCGAGCCCACGAGAC")
    trim.find_adapter3(inserts, "CTGTCTCTTATACACATCT")
    assert sum(aligned) < 1500


def test_trimming_and_distance_are_worked_out_once(spark):
    reads = spark.createDataFrame([(1, "ACGT" * 9, "I" * 36, "ACGT" * 9, "I" * 36)], "ordinal int, seq1 string, qual1 string, seq2 string, qual2 string")
    trimmed = trim.trim_pairs(reads, 15, 10, ("CTGTCTCTTATACACATCT", None), (10, 5), require1=False)
    near = reads.select(free_divergence(F.col("seq1"), F.col("seq2")).alias("d")).where("d < 3")
    for df in (trimmed, near):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
        assert df.count() == 1


def test_documents_are_read_once_against_few_items(spark, tmp_path, monkeypatch):
    words = "a b c d e f g h i j k l m n o p q r s t u v w x y z".split()
    texts = ["", None, "A b C", " ".join(words), "q " + " ".join(words[3:15]) + " q", " ".join(words[:9]), "x y z x y z", " ".join(words[3:12]) + " c"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/docs")
    items = [("long", " ".join(words[2:20])), ("short", "x, Y z"), (None, "b C"), ("none", None), ("five", "a b c d e")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    documents = spark.read.parquet(f"{tmp_path}/docs")
    few = decontaminate.decontaminate(documents, benchmark)
    assert few._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    spans = decontaminate.benchmark_spans(documents, benchmark)
    columns = ["doc_id", "n_words", "spans", "n_hit", "items", "contaminated"]
    ways = []
    for most in (decontaminate.BROADCAST_ROWS, 0):  # looked up in place, and shuffled
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", most)
        out = decontaminate.decontaminate(documents, benchmark)
        met = decontaminate.benchmark_spans(documents, benchmark)
        ways.append([sorted(map(repr, df.collect())) for df in (out.select(columns), met)])
    assert ways[0] == ways[1]
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in few.collect()}
    assert got == {0: (0, 0, []), 1: (0, 0, []), 2: (3, 2, []), 3: (26, 23, ["five", "long", "short"]), 4: (14, 12, ["long"]), 5: (9, 5, ["five"]), 6: (6, 6, ["short"]), 7: (10, 0, [])}
    assert few.count() == 9
    assert {r.doc_id for r in spans.where("item_id = 'long'").collect()} == {3, 4}


def test_read_parsing_stores_whitelists_and_the_columns_it_uses(spark, tmp_path, monkeypatch):
    tables = {
        "orders": ([(i, 7 * i, "FOP"[i % 3], f"{i % 5}-X") for i in range(300)],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"),
        "part": ([(i, 1 + i % 50) for i in range(100)], "p_partkey bigint, p_size int"),
        "nation": ([(i, i % 5) for i in range(25)], "n_nationkey int, n_regionkey int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    stored, store = [], catalog_barcodes.cut
    monkeypatch.setattr(catalog_barcodes, "cut", lambda df: stored.append(df.columns) or store(df))
    counts = catalog_barcodes.split_modalities(spark, str(tmp_path))
    assert stored == [["ordinal", "name1", "seq1", "seq2"]]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" not in plan and "p_size" not in plan and "n_regionkey" in plan  # the samples, read once
    tagged = catalog_barcodes.tagged_reads(spark, str(tmp_path))  # the clipped qualities are made where they are returned
    assert stored[1:] == [["ordinal", "name1", "seq1", "qual1"]]
    kept = tagged.collect()
    assert kept and all(len(r.seq1) == len(r.qual1) > 0 for r in kept)
    assert sum(r.reads for r in counts.collect()) == len(kept)  # no second mate is short, and every barcode has a sample


def test_index_of_a_name_needs_no_pattern(spark):
    words = ["@r1 1:N:0:AA+CC", "@r1:2:AA+CC", "a+b", "x:a+b y", "x:a+b y+z+w", "a\tb:c+d", "a:b+c\td+e", "a:b+c\t", " a:b+c  ", "a b:", "+", ":+", "",
             "   ", "a:b\x0bc+d", "a:b\nc+d:e+f\r", "a:b\fc+d", "a:é+ü", "a\u00a0b:c+d\u00a0e"]
    names = spark.createDataFrame([(w,) for w in [*words, None]], "name string")
    got = {r.name: r.i5 for r in names.select("name", barcode.i5_of(F.col("name")).alias("i5")).collect()}

    def plain(name):
        field = re.split(r"[ \t\n\x0b\f\r]+", name.strip(" "))[-1].split(":")[-1].split("+")
        return field[1] if len(field) > 1 else ""

    assert got == {**{w: plain(w) for w in words}, None: None}
    plan = names.select(barcode.i5_of(F.col("name")))._jdf.queryExecution().optimizedPlan().toString()
    assert r"\s" not in plan
