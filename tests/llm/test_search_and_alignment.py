"""Vector searches and token alignment against brute force; odd inputs."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from cellweave.llm import exact_topk, hard_negatives, token_alignment, vectors
from cellweave.llm.common import tokenizer_path

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, label int, part int, block int, v string, score string"


def embedded(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, 2, "x", "y") for i, v, y in rows], VECTORS)


@pytest.fixture(scope="module")
def table_rows():
    """Vectors of a table with many equal ones, zeros, unusable rows and repeated ids."""
    rng = random.Random(5)
    same = [rng.uniform(-1, 1) for _ in range(8)]
    rows = []
    for i in range(700):
        kind = i % 10
        v = same if kind < 3 else [0.0] * 8 if kind == 3 else [rng.uniform(-1, 1) for _ in range(8)]
        rows.append((i, v, None if i % 41 == 5 else i % 4 if kind else 9))
    rows += [(900, None, 1), (1000, [1.0, None], 1), (1100, [NAN] * 8, 2), (1200, [INF] * 8, 2), (None, same, 1), (1300, [], 3), (1400, [0.5, 0.25], 2)]
    return rows + [(200, same, 1), (201, same, 1), (201, same, 1), (210, [0.9] * 8, 2)]


def usable(rows, factor):
    out = []
    for i, v, y in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole = [int(np.floor(factor * float(np.float32(x)))) for x in v]
            out.append((i, tuple(whole), y))
    return out


def product(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def first_queries(rows, key):
    """The least row of each id that is divisible by 100."""
    out = {}
    for row in rows:
        if row[0] % 100 == 0:
            out[row[0]] = min(out.get(row[0], row), row, key=key)
    return out


@pytest.mark.parametrize("factor", [1024, 1 << 26])
def test_top_k_is_brute_force(spark, table_rows, factor):
    rows = usable(table_rows, factor)
    want = []
    for q, (_, v, _) in first_queries(rows, lambda r: r[1]).items():
        best = sorted((-product(v, w), i) for i, w, _ in rows if i != q)[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    got = exact_topk.search_embeddings(embedded(spark, table_rows).repartition(6), factor)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_top_k_of_few_rows(spark):
    few = embedded(spark, [(100, [1.0, 0.0], 1), (3, [0.5, 0.5], 1)])
    assert [tuple(r) for r in exact_topk.search_embeddings(few).collect()] == [(100, 1, 3, 512 * 1024)]
    for none in (few.where("vec_id = 3"), few.where("vec_id = 100"), few.where("false")):
        assert exact_topk.search_embeddings(none).collect() == []
        assert hard_negatives.mine_embeddings(none).collect() == []
    with pytest.raises(ValueError):
        exact_topk.search_embeddings(embedded(spark, [(100, [1e30], 1), (1, [1e30], 1)]))


def test_small_cells_change_nothing(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = sorted(map(tuple, exact_topk.search_embeddings(df).collect())), sorted(map(tuple, hard_negatives.mine_embeddings(df).collect()))
    monkeypatch.setattr(vectors, "CELL_ROWS", 70)
    monkeypatch.setattr(vectors, "CELL_QUERIES", 2)
    monkeypatch.setattr(exact_topk, "TILE", 100)
    monkeypatch.setattr(exact_topk, "BINS", 64)
    monkeypatch.setattr(hard_negatives, "TILE", 100)
    assert want == (sorted(map(tuple, exact_topk.search_embeddings(df).collect())), sorted(map(tuple, hard_negatives.mine_embeddings(df).collect())))


def mined(rows):
    rows = [(i, v, (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in rows if y is not None]
    out = []
    for a, (_, v, y) in first_queries(rows, lambda r: (r[2], r[1])).items():
        same = sorted((-product(v, w), i) for i, w, z in rows if z == y and i != a)[:5]
        for s, p in same:
            inside = sorted((-n, i) for i, w, z in rows if z != y and -80 * s <= 100 * (n := product(v, w)) <= -100 * s)
            out += [(a, p, n + 1, i, -s, -m) for n, (m, i) in enumerate(inside[:5])]
    return sorted(out)


def test_hard_negatives_are_brute_force(spark, table_rows):
    got = hard_negatives.mine_embeddings(embedded(spark, table_rows).repartition(6))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == mined(usable(table_rows, 256))


def test_bounds_hold_every_score():
    """Also where angles are 0 or pi, where an arccos is least exact; and they leave out what is far."""
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.integers(-300, 300, (300, 6)), np.zeros((2, 6), int), np.eye(6, dtype=int) * 256, np.eye(6, dtype=int) * -3]).astype(float)
    near = np.concatenate([points[:40] * 2, points[:40] + rng.integers(-1, 2, (40, 6)), -points[:40], points])
    refs = np.concatenate([np.eye(6), points[:10] / np.linalg.norm(points[:10], axis=1, keepdims=True)])
    def measured(x):
        norm = np.linalg.norm(x, axis=1)
        return norm, np.arccos(np.clip(x @ refs.T / np.where(norm > 0, norm, 1)[:, None], -1, 1))

    lower, upper = hard_negatives.score_bounds(*measured(points), *measured(near))
    exact = points @ near.T
    assert (lower <= exact).all() and (exact <= upper).all()
    assert (upper < 0.5 * np.linalg.norm(points, axis=1)[:, None] * np.linalg.norm(near, axis=1)).mean() > 0.1


# ---- alignment of two tokenizers -------------------------------------------------------------

TEXTS = [
    "", None, " ", "  two  spaces ", "plain words in a row", "It's we'll  ", "tab\tand\nline\n\n end", "a<|endoftext|> b</s> <s>", "▁mark", "é é ﬁ ½ 日本語 テキスト",
    "🙂🙃 x🙂", "\x00\x1f odd \x85\xa0　here", "x" * 5_000, "0123456789 " * 60, "plain words in a row", " lead", "-- --- ...!!", "naïve café " * 40,
]


def token_bytes():
    a, b = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json")), token_alignment._Cutter(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")).b
    a.encode_special_tokens = True
    letter = token_alignment.byte_letters()
    of_a = lambda i: bytes(letter[c] for c in a.id_to_token(i))
    of_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return a, b, of_a, of_b


def aligned_by_hand(texts):
    a, b, of_a, of_b = token_bytes()
    per_doc, counts = [], Counter()
    for text in texts:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        parts_a, parts_b = [of_a(i) for i in ids_a], [of_b(i) for i in ids_b]
        if not text or not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
            per_doc.append(None)
            continue
        span_a, span_b = ([(int(e - len(p)), int(e)) for e, p in zip(np.cumsum([len(p) for p in ps]), ps, strict=True)] for ps in (parts_a, parts_b))
        links = [(i, j) for i, (s, e) in enumerate(span_a) for j, (t, f) in enumerate(span_b) if s < f and t < e] if len(span_a) < 700 else near_links(span_a, span_b)
        cuts = sorted({e for _, e in span_a} & {e for _, e in span_b})
        groups, i, j = [], 0, 0
        for cut in cuts:
            k, m = i, j
            while k < len(span_a) and span_a[k][1] <= cut:
                k += 1
            while m < len(span_b) and span_b[m][1] <= cut:
                m += 1
            groups.append(",".join(map(str, ids_a[i:k])) + "|" + ",".join(map(str, ids_b[j:m])))
            i, j = k, m
        pairs = [(ids_a[i], ids_b[j]) for i, j in links]
        counts.update(pairs)
        per_doc.append((len(ids_a), len(ids_b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (x[0], x[1], x[2], len(x[3]), sum(counts[p] == best[p[1]] for p in x[3]), sum(counts[p] for p in x[3]), x[4]) if x else (0, 0, 0, 0, 0, 0, "")
        for x in per_doc
    ]


def near_links(span_a, span_b):
    out, low = [], 0
    for i, (s, e) in enumerate(span_a):
        while span_b[low][1] <= s:
            low += 1
        j = low
        while j < len(span_b) and span_b[j][0] < e:
            out.append((i, j))
            j += 1
    return out


def test_alignment_is_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(150).collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(50_000 + i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (50_004, TEXTS[4])]
    want = sorted(((i, *x) for (i, _), x in zip(rows, aligned_by_hand([t for _, t in rows]), strict=True)), key=repr)
    df = spark.createDataFrame([(i, t, 1, "p", "r") for i, t in rows], "doc_id long, text string, row int, pair string, rest string").repartition(5)
    for head in (token_alignment.HEAD, 40, 0):
        got = token_alignment.align_tokens(df, head=head)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert token_alignment.align_tokens(df.where("false")).collect() == []
    text_ids = token_alignment.align_tokens(df.withColumn("doc_id", df.doc_id.cast("string")))
    assert text_ids.count() == len(rows)


def test_run_skipping_on_any_lists():
    rng = random.Random(1)
    for n in [1, 2, 7, 8, 9, 40, 300]:
        for share in (0.0, 0.02, 0.3, 0.9):
            cuts = [(rng.random() >= share, rng.random() >= share) for _ in range(n)]
            a = np.array([i + 1 for i, (x, _) in enumerate(cuts) if x] + [n + 1], np.int32)
            b = np.array([i + 1 for i, (_, y) in enumerate(cuts) if y] + [n + 1], np.int32)
            stretches, groups = token_alignment.align(a, b)
            one_a, one_b, more_a, more_b = token_alignment.links(a, b, stretches, groups)
            assert len(one_a) + len(groups) == len(set(a) & set(b))
            spans = [list(zip([0, *x[:-1].tolist()], x.tolist(), strict=True)) for x in (a, b)]
            want = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
            assert sorted([*zip(one_a, one_b, strict=True), *zip(more_a, more_b, strict=True)]) == want
