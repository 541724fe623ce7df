"""Operators with an exact answer, against brute force and the tokenizers' own output; odd inputs."""

import hashlib
import re
import zlib
from array import array
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

from cellweave.llm import decontaminate, fingerprints, line_dedup, packing, stages, token_counts, url_filter
from cellweave.llm.common import tokenizer_path
from cellweave.llm.queries import URL_RULES

DOCS = "doc_id long, text string, lang string, rows int, item string, key string, node string"
ODD = [
    "", None, " ", "\n\n", "one", "It's we'll they'd  two  spaces\n\n\nand\tlines \n x ", "ÀÉÎ ß ﬁ 𝔘𝔫𝔦 e\u0301 ½ ² ٣ ǅ İI", "a<|endoftext|> b<|endoftext|>", "<|startoftext|>x",
    "\x1c\x1d odd \x85\xa0spaces\u3000here", "日本語 テキスト 한국어", "x" * 30_000, "0123456789 " * 50, "!?!?... ---", "Thnd*** the!! _under_score",
]


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame([(i, t, None, 1, "a", "b", "c") for i, t in rows], schema)


@pytest.fixture(scope="module")
def sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def odd(spark, sample):
    rows = [(i + 10_000, t) for i, t in enumerate(ODD)] + [(None, "no id"), (10_005, ODD[5])]
    return rows + sample


@pytest.fixture(scope="module")
def odd_docs(spark, odd):
    return frame(spark, odd).repartition(5).cache()


def test_token_counts_are_the_librarys(spark, odd, odd_docs):
    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    for head in (token_counts.HEAD, 50):
        got = sorted(map(tuple, token_counts.count_tokens(odd_docs, head=head).collect()), key=repr)
        want = [(i, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in odd]
        assert got == sorted(want, key=repr)


def test_pre_tokens_of_every_character():
    """Every character is cut as the library cuts it."""
    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    cut = token_counts.PreTokens(["<|endoftext|>"], tokenizer_path("byte_bpe_50k.json"))
    for start in [*range(0, 0x34000, 397), *range(0x3FA00, 0x3FE00, 397)]:
        text = "".join(f"a{chr(c)}1{chr(c)}" for c in range(start, start + 397) if not 0xD800 <= c < 0xE000)
        want = [text[a:b] for _, (a, b) in t.pre_tokenizer.pre_tokenize_str(text)]
        assert cut(text) == want, hex(start)


def test_packing(spark, odd, odd_docs):
    t = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = defaultdict(list)
    for i, x in odd:
        want[i].append(array("I", [*t.encode(x or "", add_special_tokens=False).ids, packing.END_ID]))
    rows = packing.pack_documents(odd_docs, fan_in=2).collect()
    seqs = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(want)
    for i, ids in want.items():
        expected = sum(len(x) for x in ids)
        assert sum(p.length for p in pieces[i]) == expected
        if len(ids) == 1:
            own = sorted(pieces[i], key=lambda p: p.start)
            at = 0
            for p in own:
                assert p.start == at and p.doc_tokens == expected
                assert p.ids_crc32 == zlib.crc32(ids[0][at : at + p.length].tobytes())
                at += p.length
    for own in seqs.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    tokens = sum(length for own in seqs.values() for _, length in own)
    assert len(seqs) <= tokens / packing.WINDOW + 3 * packing.OPEN


def test_open_windows_hold_bounded_space():
    w = packing.OpenWindows(16, 3)
    out = [list(w.place(n)) for n in (5, 9, 12, 40, 7, 7, 7, 16, 1)]
    assert len(w.rooms) <= 3
    filled = defaultdict(int)
    for own, n in zip(out, (5, 9, 12, 40, 7, 7, 7, 16, 1), strict=True):
        at = 0
        for start, length, window, offset in own:
            assert start == at and offset == filled[window]
            at += length
            filled[window] += length
        assert at == n
    still = {s for _, s in w.rooms}
    assert all(v == 16 for k, v in filled.items() if k not in still)


def brute_spans(text, items, span=10):
    low = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s or "")
    words = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(s))
    own, hit, found = words(text), set(), set()
    for item, x in items:
        w = words(x)
        n = min(span, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if n and tuple(own[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(own), len(hit), sorted(found)


def test_decontamination(spark, monkeypatch):
    vocabulary = "alpha BETA gamma delta épée zeta".split()
    import random

    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([10, 11, 14, 25]))) for i in range(12)]
    items += [(50, "alpha gamma"), (51, "x y z w v"), (52, ""), (53, None), (50, "gamma, DELTA!"), (54, "same " * 30)]
    docs = [(i, text(rng.choice([0, 3, 9, 40, 200]))) for i in range(60)]
    docs += [(100 + i, "before it. " + (x or "") + " after it, " + text(5)) for i, (_, x) in enumerate(items)]
    docs += [(200, None), (201, ""), (202, "..."), (None, items[0][1]), (100, docs[60][1]), (203, "same " * 50), (204, "q x y z w v q " * 3)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((i, *brute_spans(t, items)) for i, t in docs), key=repr)
    for rows in (decontaminate.BROADCAST_ROWS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)
        got = decontaminate.decontaminate(frame(spark, docs), bench).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got), key=repr) == want
        assert all(r.contaminated == (r.n_hit > 0) for r in got)
    none = decontaminate.decontaminate(frame(spark, docs), bench.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)
    assert decontaminate.decontaminate(frame(spark, []), bench).count() == 0


def test_decontamination_plan_is_native(spark):
    docs, bench = frame(spark, [(1, "a b c")]), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    plan = decontaminate.decontaminate(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_line_dedup_against_brute_force(spark):
    a, b = "One line of more than five words.", "another line of these very words here"
    docs = [
        (3, f"{a}\nshort one\n{b}"), (1, f"new words stand in this line\n{a.upper()} \n{a}"), (2, None), (5, ""), (6, f"{b}"), (7, "\n\n"),
        (8, f"x\n\n{b}\n\ny"), (None, f"only null has this line now\n{b}"), (9, "short one\nshort one"),
    ]
    plain = lambda u: " ".join(re.findall(r"[^\W_]+", u.lower()))
    seen, want = set(), []
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        kept, spans, at = [], [], 0
        for u in (t or "").split("\n"):
            if len(plain(u).split()) >= 5 and plain(u) in seen:
                spans.append((at, at + len(u)))
            else:
                kept.append(u)
                seen.add(plain(u))
            at += len(u) + 1
        want.append((i, "\n".join(kept) if spans else t, spans))
    got = line_dedup.dedup_lines(frame(spark, docs))
    assert got.columns == [*frame(spark, docs).columns, "n_units", "n_removed", "removed"]
    rows = [(r.doc_id, r.text, [(s.start, s.end) for s in r.removed]) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0
    again = line_dedup.dedup_lines(frame(spark, [(1, a), (1, a), (2, a)])).collect()  # rows of one document
    assert sorted((r.doc_id, r.text) for r in again) == [(1, a), (1, a), (2, "")]
    paragraphs = line_dedup.dedup_lines(frame(spark, [(1, f"{a}\n{b}\n\nend"), (2, f"z\n\n{a}\n{b}")]), "paragraph").collect()
    assert {r.text for r in paragraphs} == {f"{a}\n{b}\n\nend", "z"}


def test_url_verdicts(spark):
    urls = [
        "http://www.example.com/en/1", "https://EXAMPLE.com/en/x?q=/fr/", "http://a.example.com/en", "http://com/", "http://example.com", "ftp://x.net/es/a#b",
        "http://x.net/fr", "http://x.net/fr/", "no scheme", None, "", "http://", "http://net/es/?x", "http://b.www.example.com/en/y", "a://b://c.com/z", "http://notexample.com/en/z", "http://x.net?/es/",
    ]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)] + [(0, urls[0], "h", "r")], "page_id long, url string, host string, rule string")

    def brute(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, *(max(fits)[2:] if fits else (None, "allow"))

    got = url_filter.judge_urls(pages, URL_RULES).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.url)
    partial = url_filter.UrlTrie([("x.org", "/ab", "block"), ("org", "/abc/d/", "allow"), ("org", "/abc/", "block")])
    assert partial.match("x.org", "/abc/d/e") == ("org/abc/d/", "allow")
    assert partial.match("x.org", "/abz") == ("x.org/ab", "block")
    assert partial.match("y.org", "/ab") is None
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).count() == 0
    with pytest.raises(ValueError):
        url_filter.UrlTrie([("a", "/", "allow")] * (url_filter.MAX_RULES + 1))


def test_edited_fingerprints(spark, odd):
    docs = [d for d in odd if d[0] is not None][:120]
    docs = list({i: (i, t) for i, t in docs}.values())
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(frame(spark, docs).repartition(7)).collect()}
    h = fingerprints.MinHasher()
    order = sorted((i, t or "") for i, t in docs)
    assert len(got) == len(order)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        m = len(t) // 2
        edited = t[: len(t) - m] + nxt[:m]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == h(t).tobytes().hex() and r.edited_fingerprint == h(edited).tobytes().hex()
        assert r.near_next == fingerprints.likeness(h(t), h(nxt)) and r.near_edited == fingerprints.likeness(h(t), h(edited))


@pytest.mark.parametrize("docs", [[], [(1, "a b")], [(None, "x y"), (None, "z"), (4, "w"), (4, "v")]])
def test_edited_fingerprints_of_few(spark, docs):
    rows = fingerprints.edited_fingerprints(frame(spark, docs)).collect()
    assert len(rows) == len(docs)
    if len(docs) == 1:
        assert rows[0].near_next == 1.0


def test_passages_inside_lines_go(spark):
    passage = "A passage of many words. It was pasted by several writers into lines of theirs! " * 2 + "Why. They do not say, but it is fifty words long or so, and that is long enough to be found."
    docs = [
        (1, f"First line here.\nOwn words of the first writer. {passage}"),
        (2, f"Own words of the second writer stand here. {passage} And then some more of them.\nLast line."),
        (3, f"{passage}"),
        (4, "Why. It was not pasted. Why. A passage of many words. Own."),
    ]
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(frame(spark, docs)).collect()}
    assert rows[1].text == docs[0][1] or rows[1].n_removed == 1  # its own repeats inside the passage are short
    assert rows[2].text == "Own words of the second writer stand here. And then some more of them.\nLast line."
    (span,) = rows[2].removed
    assert docs[1][1][span.start : span.end] == passage
    assert rows[3].text == "" and rows[4].text == docs[3][1]
    assert line_dedup.cut("a b. c d! e", "\n", set(), {1}, 2) == ("a b. e", [(0, 5, 9)])
    assert line_dedup.cut("a b. c d! e", "\n", set(), {1}, 3) == ("a b. c d! e", [])
    assert line_dedup.cut("x\ny z. q\nw", "\n", {0}, {1, 2}, 3) == ("w", [(0, 0, 1), (1, 2, 8)])


def test_short_lines_go_in_the_pipeline(spark):
    docs = [(1, "Short one\nown words of the first"), (2, "own words of the second\nshort  ONE.\n---"), (3, "Short one"), (4, "end\n\nend")]
    out = stages.cut_repeated_lines(spark, frame(spark, docs), "").collect()
    assert {r.doc_id: r.text for r in out} == {1: docs[0][1], 2: "own words of the second\n---", 4: "end\n"}


def brute_windows(docs, span):
    """Places of windows of ``span`` words met in a document of lower id, or before in the same without overlap."""
    seen, want = {}, {}
    for i, t in sorted(docs):
        w, own = [x.lower() for x in re.findall(r"[^\W_]+", t)], {}
        for at in range(len(w) - span + 1):
            g = tuple(w[at : at + span])
            if g in seen or at >= own.setdefault(g, at) + span:
                want.setdefault(i, []).append(at)
        seen |= own
    return want


@pytest.mark.parametrize("bits", [line_dedup.ANCHOR_BITS, line_dedup._CHUNK_BITS])
def test_repeated_spans_against_brute_force(spark, sample, monkeypatch, bits):
    import random

    monkeypatch.setattr(line_dedup, "ANCHOR_BITS", bits)
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["alpha", "Beta.", "gamma,", "DELTA\n", "épée!", "z"]) for _ in range(n))
    passages = [text(n) for n in (49, 50, 51, 120)]
    docs = [(i, f"{text(rng.randrange(20))} {rng.choice(passages)} {text(rng.randrange(20))}") for i in range(30)]
    docs += [(40, "same " * 49), (41, "same " * 180), (42, ""), (43, "a b " * 60), *((i + 1000, t or "") for i, t in sample)]
    got = defaultdict(set)
    for r in line_dedup.repeated_spans(frame(spark, docs)).collect():
        got[r.doc].add(r.place)
    assert got == {i: set(w) for i, w in brute_windows(docs, 50).items()}
    assert line_dedup.repeated_spans(frame(spark, [])).count() == 0


def test_spans_with_other_sentence_ends_go_in_the_pipeline(spark):
    words = [f"word{i}" for i in range(51)]
    one, other = " ".join(words), ", ".join(words[:20]) + "! " + " ".join(words[20:40]).upper() + ".\n\n" + "; ".join(words[40:])
    docs = [(1, f"Own beginning here {one} and then an end."), (2, f"Another start. Glued{other} third words!\nLast line."), (3, f"Begin: {other}. Stop"), (4, one + "."), (5, " ".join(words[:49]))]
    rows = {r.doc_id: r.text for r in stages.cut_repeated_lines(spark, frame(spark, docs), "").collect()}
    assert rows == {1: docs[0][1], 2: "Another start. Gluedword0,\nthird words!\nLast line.", 3: "Begin:\nStop", 5: docs[4][1]}
    assert line_dedup.cut("a b, c d e. f", "\n", set(), set(), 30, [1, 2], 2) == ("a e. f", [(0, 2, 8)])
    assert line_dedup.cut("a b\n\nc d. e", "\n", set(), set(), 30, [1], 2) == ("a\nd. e", [(0, 2, 3), (1, 4, 4), (2, 5, 6)])


def test_clashing_names_and_ids(spark):
    """Columns named like those an operator adds on its way."""
    names = ["_units", "_key", "_id", "_text_key", "_sentences", "_windows", "__units", "_decided", "node"]
    rows = [(1, "One two three four five six.\nand more words here now"), (2, "One two three four five six.\nother words stand here"), (3, None)]
    docs = spark.createDataFrame([(i, t, *[f"c{i}"] * len(names)) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert out[2].text == "other words stand here" and all(out[i][n] == f"c{i}" for i in out for n in names)
    gone = spark.createDataFrame([(2, 5), (None, 5)], "doc_id long, key long")
    left = stages._without(docs, gone.withColumn("key", stages.F.lit(None).cast("long")), stages.text_key())
    assert left.count() == 3 and left.columns == docs.columns
    keys = docs.where("doc_id = 2").select("doc_id", stages.text_key().alias("key"))
    assert [r.doc_id for r in stages._without(docs, keys, stages.text_key()).orderBy("doc_id").collect()] == [1, 3]
    with pytest.raises(TypeError):
        line_dedup.dedup_lines(docs.withColumn("doc_id", docs.doc_id.cast("string")))
    pages = spark.createDataFrame([(1, "http://a.com/x", "kept")], "page_id long, url string, _decided string")
    assert url_filter.judge_urls(pages, URL_RULES).first()._decided == "kept"
