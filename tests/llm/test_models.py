"""Models by held-out accuracy; classes of near copies against brute force; the pipeline."""

import copy
import random

import numpy as np
import pytest

import corpus_pipeline
from cellweave.llm import fingerprints, html_extract, near_dedup, quality, queries, stages, toxicity
from cellweave.llm.classes import components
from cellweave.llm.shingles import shingle_hashes

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, root string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, "n", "r") for i, t in rows], DOCS)


def accuracy(scored, labels, name):
    own = scored.where("held_out").join(labels, "doc_id").select("predicted", name).collect()
    return sum(r.predicted == r[name] for r in own) / len(own), len(own)


def test_quality_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = queries.op2_quality(spark, "/root/testdata/sf0.1").cache()
    share, n = accuracy(out, labels, "quality")
    assert n > 500 and share > 0.97
    assert out.where("score < 0 or score > 1 or score is null").count() == 0


def test_toxicity_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = queries.op7_toxicity(spark, "/root/testdata/sf0.1").cache()
    share, n = accuracy(out, labels, "toxic")
    assert n > 500 and share > 0.96


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_scores_of_odd_rows(spark, score):
    docs = [(1, None), (2, ""), (3, "a b c"), (None, "x"), (3, "a b c"), (4, "w " * 20_000), (5, "\x00\u3000")]
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (3, None, None), (None, 1, 1), (7, 1, 1)], "doc_id long, quality int, toxic int")
    for own in (labels, labels.limit(0)):
        rows = score(frame(spark, docs), own).collect()
        assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    assert score(frame(spark, []), labels).count() == 0


@pytest.fixture(scope="module")
def restorer(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return toxicity.Restorer(toxicity.fit_char_model(toxicity.word_counts(docs)))


@pytest.mark.parametrize(
    ("text", "word"),
    [("l0ser", "loser"), ("m0r0n!", "moron"), ("tr@sh,", "trash"), ("i d i o t", "idiot"), ("an i.d.i.o.t", "idiot"), ("idiooot", "idiot"), ("$tupid", "stupid"), ("c l 0 w n", "clown"), ("Plain", "plain")],
)
def test_disguises_are_undone(restorer, text, word):
    assert word in restorer(text)


@pytest.mark.parametrize(
    ("text", "word"),
    [("iddiot", "idiot"), ("mmoron", "moron"), ("idioot", "idiot"), ("iidiiot", "idiot"), ("Stuupid!", "stupid"), ("i  d  i  o  t", "idiot"), ("an i - d - i - o - t.", "idiot"), ("m/o/r/o/n", "moron"),
     ("m / o / r / o / n", "moron"), ("i\td\ti\to\tt", "idiot"), ("i\nd\ni\no\nt", "idiot"), ("m\xa00\xa0r\xa00\xa0n", "moron"), ("4$$", "ass"), ("iddiot", "iddiot")],
)
def test_doubled_letters_and_any_spacing_are_undone(restorer, text, word):
    assert any(w.startswith(word) for w in restorer(text))


def test_training_rows_are_not_lowered():
    assert toxicity.TRAIN_ROWS >= 20_000


def test_words_in_two_pieces(restorer):
    known = copy.copy(restorer)
    known.known = frozenset(["idiot", "moron"])
    assert {"idiot", "moron"} <= known("an id iot, and a mo-ron")
    assert not {"idiot", "moron"} & known("id riot, mo iron")


def test_numbers_are_no_words(restorer):
    assert all(not restorer(t) for t in ("1999", "$455", "10:30,", "2024-01-02", "(12)", "..."))


def test_letters_only_is_the_lattice(restorer):
    for token in ("iddiot", "aabbccdd", "mmmoron", "letter", "bookkeeper", "xxxxyyyyzzzz"):
        assert restorer.decode.letters_only(token) == restorer.decode(token)


def test_extraction_from_pages(spark):
    import html
    import re

    def article(page):
        inside = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inside))
        return "\n".join(b for b in blocks if b)

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op5_html_extraction(spark, SF).collect()
    assert len(rows) == len(pages)
    assert sum(r.text == article(pages[r.page_id]) for r in rows) >= 0.98 * len(rows)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_extraction_of_odd_pages(spark):
    pages = [None, "", "<", "<<p>>a<b", "<p>" * 3000, "<div " + 'class="a' * 50, "<!-- never closed", "<script>x", "&amp;&#x41;&bogus; text", "</p></div></body>", "<ul>" + "<li>x" * 2000]
    df = spark.createDataFrame([(i, None, p, "t") for i, p in enumerate(pages)] + [(1, None, "", "t")], "page_id long, url string, html string, text string")
    rows = html_extract.extract_text(df).collect()
    assert len(rows) == len(pages) + 1 and all(r.text is not None for r in rows)
    assert html_extract.extract_text(df.limit(0)).count() == 0


def test_extraction_of_other_layouts():
    words = [f"some words number {i} stand here, and here is what they say about it." for i in range(60)]
    extract = html_extract.fit_extractor(words, layouts=500)
    fresh = html_extract.Layouts(words, seed=77)
    pages = [fresh.page() for _ in range(150)]
    right = wrong = missed = 0
    for page, text in zip(pages, extract(pages), strict=True):
        tree = html_extract.parse(page)
        want = [t for t, y, tag in zip(tree.texts, html_extract.node_labels(tree), tree.tags, strict=True) if y and tag == "#text"]
        got = text.split("\n") if text else []
        right += sum(len(t) for t in got if t in want)
        wrong += sum(len(t) for t in got if t not in want)
        missed += sum(len(t) for t in want if t not in got)
    assert right / (right + wrong) > 0.93 and right / (right + missed) > 0.93


def test_decoding_never_contradicts():
    tree = html_extract.parse("<div><p>a</p><div><p>b</p></div></div><div>c</div>")
    rng = np.random.default_rng(1)
    for _ in range(200):
        out = html_extract.decode(tree, rng.normal(0, 3, len(tree.tags)))
        for i, own in enumerate(out):
            if own and i:
                assert out[tree.parents[i]]
            if own and tree.tags[i] != "#text":
                assert any(out[k] for k in range(len(out)) if tree.parents[k] == i)


def corpus(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts, n = [], 0
    for size, edits in ((60, 3), (40, 9), (25, 30), (2, 1), (2, 60), (3, 0)):
        base = [word() for _ in range(200)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(200)] = word()
            texts.append(" ".join(own))
    texts += [" ".join(word() for _ in range(rng.randint(1, 120))) for _ in range(80)]
    texts += ["", None, " ", "one", "one", "two words"]
    rng.shuffle(texts)
    return [(n + i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, texts[3])]


def roots_of(docs, linked):
    keys = list(dict.fromkeys(t or "" for _, t in docs))
    parent = list(range(len(keys)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(keys)):
        for b in range(a):
            if find(a) != find(b) and linked(keys[a], keys[b]):
                parent[find(a)] = find(b)
    place = {k: find(i) for i, k in enumerate(keys)}
    least = {}
    for i, t in docs:
        if i is not None:
            least[place[t or ""]] = min(i, least.get(place[t or ""], i))
    return sorted(((i, least.get(place[t or ""])) for i, t in docs), key=repr)


def test_near_classes_against_brute_force(spark):
    docs = corpus()
    df = frame(spark, docs).repartition(3)
    idf = near_dedup.idf_table(df)
    lists = {t or "": near_dedup.short_hashes(t or "") for _, t in docs}
    like = lambda a, b: len(lists[a]) and len(lists[b]) and near_dedup.weighted_jaccard(lists[a], lists[b], idf) >= 0.8
    rows = near_dedup.near_classes(df).collect()
    got = sorted(((r.doc_id, r.class_id) for r in rows), key=repr)
    want = roots_of(docs, like)
    assert sum(a != b for a, b in zip(got, want, strict=True)) <= 2  # sampling may miss a pair at the threshold
    assert len({r.class_id for r in rows}) == len({(r.doc_id, r.node) for r in rows if r.keep} - {(None, None)})
    assert near_dedup.near_classes(frame(spark, [])).count() == 0


def test_similar_classes_against_brute_force(spark):
    docs = corpus(9)
    sets = {t or "": np.unique(shingle_hashes(t or "")) for _, t in docs}
    like = lambda a, b: fingerprints.jaccard(sets[a], sets[b]) >= 0.8
    got = sorted(((r.doc_id, r.class_id) for r in fingerprints.similar_classes(frame(spark, docs)).collect()), key=repr)
    assert sum(a != b for a, b in zip(got, roots_of(docs, like), strict=True)) <= 2


def test_sampling_estimates_weighted_jaccard():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 32, 400, dtype=np.uint32))
    idf = np.ones(1 << near_dedup.HASH_BITS, np.float32)
    a, b = np.sort(keys[:300]), np.sort(keys[60:])
    sampler = near_dedup.WeightedSampler(2000)
    x, y = sampler(*near_dedup.weighted(a, idf)), sampler(*near_dedup.weighted(b, idf))
    same = ((x[0] == y[0]) & (x[1] == y[1])).mean()
    assert abs(same - near_dedup.weighted_jaccard(a, b, idf)) < 0.05


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 50 + i) for i in range(20)] + [(7, 7), (60, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 50 for i in [100, *range(50, 70)]}}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    clean = "Clean words that nobody else has written stand in this document, one after the other, until it ends."
    rows = [(90_001, clean), (90_002, clean + " More."), (90_003, clean), (90_004, "Something else altogether " + bench), (90_005, None), (90_006, ""), (90_007, "you idiot scum moron trash clown")]
    extra = spark.createDataFrame([(i, t, "en", "src0", 1) for i, t in rows], docs.schema)
    now = docs.unionByName(extra).unionByName(extra.where("doc_id = 90001"))
    ids = lambda df: {r.doc_id for r in df.where("doc_id > 90000").select("doc_id").collect()}
    kept = stages.drop_toxic(spark, now, SF)
    assert kept.columns == docs.columns and ids(kept) == {r[0] for r in rows} - {90_007}
    near = stages.drop_near_copies(spark, kept, SF)
    assert 90_003 not in ids(near) and {90_001, 90_004} <= ids(near)
    assert near.where("doc_id = 90001").count() == 1
    cut = stages.cut_repeated_lines(spark, near, SF)
    assert cut.columns == docs.columns and {90_001, 90_004} <= ids(cut)
    left = stages.drop_contaminated(spark, cut, SF)
    assert 90_004 not in ids(left) and 90_001 in ids(left)
    packed = stages.pack(spark, left, SF)
    assert packed.select("doc_id").distinct().count() == left.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "packing"]


def test_pipeline_of_nothing(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
    assert none.count() == 0


def test_words_in_two_pieces_and_letter_runs():
    rng = random.Random(5)
    signs = "".join(map(chr, range(256)))
    for extra in ("", "абв", "ǅ²"):
        for _ in range(300):
            text = "".join(rng.choices(signs + "abcdefgh " * 20 + extra * 30, k=80))
            assert toxicity.letter_runs(text) == toxicity._WORDS(text)
    chars = toxicity.CharModel("diot", np.log(np.full((5, 5, 5), 5.0)))
    restorer = toxicity.Restorer(chars, known=["idiot", "toto"])
    assert toxicity.beginnings(restorer.known) == {"i", "id", "idi", "idio", "t", "to", "tot"}
    text = "an id iot, to to id iot id. iot toto"
    words = toxicity._WORDS(text)
    read = {a + b for a, b in zip(words, words[1:], strict=False) if a + b in restorer.known and a + b in restorer.decode(f"{a} {b}")}
    assert read and sorted(restorer.pieces(text)) == sorted(read)
