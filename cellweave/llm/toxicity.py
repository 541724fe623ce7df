"""Toxicity by a noisy channel: undo disguises, then score the restored text.

Language model. Every word of the corpus is counted (per task, then over all), and the distinct words, each weighted
by log2(1 + count), give character trigram counts over the ``ALPHABET`` most frequent letters: a dense table
of bounded size. What is counted grows with the corpus; what is broadcast does not.

Channel. A token of letters without two equal ones in a row has one reading. Any other becomes a lattice: look-alike
signs may stand for letters, repeated letters may be dropped, marks or blanks between letters may be dropped
or end a word, each at a cost. Viterbi decoding takes the reading of least channel plus language-model cost. A token of
letters with doubled ones only counts as written, too; a number is no word.
Letters set apart one by one, by any blanks or marks, are decoded together. Two neighbouring words that make a term of the
model are read as one if the channel prefers it. Tokens are decoded once each (bounded cache).

Score. Terms are the restored words and their first 4 to 6 letters. A term's weight is the lower bound of its log
odds between toxic and other training documents. A logistic model over a document's strongest evidence
gives the score; training documents see weights without their own count.

Bounds, all parameters: ``TRAIN_ROWS`` labelled documents (smallest hash of doc_id first), ``TERMS`` terms. Labels are
read only where crc32(doc_id as text) mod 5 is not 0. Corpus counts and scoring cover all rows and whole texts.

Defined cases: null is the empty text; an empty text scores by the intercept; null doc_id is held out; several
labels of one doc_id count as their maximum; no usable labels give score 0; repeated rows give repeated rows; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import small_batches, stored, text_key, text_or_empty

TRAIN_ROWS, TERMS, ALPHABET = 20_000, 50_000, 60
MIN_SUPPORT, MIN_WEIGHT = 3, 1.0
FOLDS, HELD = 5, 0
_FLUSH = 200_000
#: Signs read as letters.
LOOK_ALIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c"}
MARKS = frozenset(" .,-_*~'`^:;/\\\"#%&=<>[]{})?")
SIGN_COST, REPEAT_COST, LOST_COST = 1.0, 0.5, 8.0
#: Of a mark or blank: left out of a word, ending one. Between single letters a word rather goes on.
DROP_COST, END_COST = (0.5, 0.1), (0.0, 1.5)
_WORDS = re.compile(r"[^\W\d_]+").findall
#: Latin-1 bytes that are no letters become blanks.
_LATIN = bytes(c if _WORDS(chr(c)) else 32 for c in range(256))
_PLAIN = re.compile(r"[^\W\d_]*").fullmatch
_RUN = re.compile(r"([^\W\d_])\1\1").search
_TWICE = re.compile(r"([^\W\d_])\1").search
_RUNS = re.compile(r"(.)\1*", re.S).finditer
_NUMBER = re.compile(r"[^\w@!|]*\d+(?:[.,:/-]+\d+)*[^\w@$|+€£(]*").fullmatch
_INNER = re.compile(r"[^\W_].*[^\W_]|[^\W_]", re.S)
_APART = rf"[\s{re.escape(''.join(sorted(MARKS)))}]"
_SINGLE = r"(?:[^\W_]|[@$!|+€£(])"
_SPACED = re.compile(rf"(?<![^\W_])(?:{_SINGLE}{_APART}+){{2,}}{_SINGLE}(?![^\W_])")
#: Two single characters with blanks or marks around: needed for the above, and quickly looked for.
_MAYBE_SPACED = re.compile(rf"{_APART}{_SINGLE}{_APART}+{_SINGLE}(?![^\W_])").search
_BLANKS = re.compile(rf"{_APART}+").sub


def letter_runs(text: str) -> list[str]:
    """What ``_WORDS`` finds; texts of Latin-1 letters are cut without a pattern."""
    try:
        return text.encode("latin-1").translate(_LATIN).decode("latin-1").split()
    except UnicodeEncodeError:
        return _WORDS(text)


@lru_cache(maxsize=4)
def beginnings(words: frozenset[str]) -> frozenset[str]:
    return frozenset(w[:i] for w in words for i in range(1, len(w)))


@dataclass
class CharModel:
    """Costs (negative natural logarithms) of a character after two others; index 0 is a word end."""

    letters: str
    cost: np.ndarray
    index: dict[str, int] = field(init=False)

    def __post_init__(self):
        self.index = {c: i + 1 for i, c in enumerate(self.letters)}


def fit_char_model(words: DataFrame, alphabet: int = ALPHABET) -> CharModel:
    """From ``words`` (word, n): the distinct words of the corpus."""

    def grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                padded, weight = f"##{word}#", math.log2(1 + n)
                for i in range(len(word) + 1):
                    seen[padded[i : i + 3]] += weight
        yield pa.RecordBatch.from_pydict({"gram": pa.array(seen, pa.string()), "weight": pa.array(seen.values(), pa.float64())})

    # Stored, as it is read twice and small, and all texts stand behind it.
    counts = stored(words.mapInArrow(grams, "gram string, weight double").groupBy("gram").agg(F.round(F.sum("weight"), 3).alias("weight")))
    ends = counts.groupBy(F.substring("gram", 3, 1).alias("c")).agg(F.sum("weight").alias("w"))
    letters = [r.c for r in ends.where("c <> '#'").orderBy(F.desc(F.round("w", 2)), "c").limit(alphabet).collect()]
    known = "".join(sorted(letters))
    # At most (alphabet + 1) ** 3 rows are left.
    inside = counts.where(F.translate("gram", known + "#", "") == "") if known else counts.limit(0)
    table = np.zeros((len(known) + 1,) * 3)
    at = {c: i + 1 for i, c in enumerate(known)} | {"#": 0}
    for row in inside.collect():
        a, b, c = row.gram
        table[at[a], at[b], at[c]] = row.weight
    pair = table.sum(0) + 0.5
    pair = pair / pair.sum(1, keepdims=True)
    table = table + 4.0 * pair[None]
    return CharModel(known, -np.log(table / table.sum(2, keepdims=True)))


class Decoder:
    """Viterbi reading of a disguised string: the words of least cost."""

    def __init__(self, model: CharModel):
        self.letters, self.index = "#" + model.letters, model.index
        self.cost = model.cost.tolist()

    def letters_only(self, token: str) -> list[str]:
        """As ``__call__``, for a token of letters: it only leaves open how many of equal letters in a row to keep."""
        runs = [(self.index.get(m[1]), m.end() - m.start()) for m in _RUNS(token)]
        if math.prod(n for _, n in runs) > 16 or any(c is None for c, _ in runs):
            return self(token)
        best = [(0.0, 0, 0, "")]
        for c, n in runs:
            nexts = []
            for total, a, b, read in best:
                for kept in range(1, n + 1):
                    total, a, b, read = total + self.cost[a][b][c], b, c, read + self.letters[c]
                    nexts.append((total + REPEAT_COST * (n - kept), a, b, read))
            best = nexts
        return [min(best, key=lambda x: x[0] + self.cost[x[1]][x[2]][0])[3]]

    def __call__(self, text: str, spaced: bool = False) -> list[str]:
        drop, end = DROP_COST[1] if spaced else DROP_COST[0], END_COST[1] if spaced else END_COST[0]
        # A state is the two characters read last; each keeps its cost and a link back.
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for i, c in enumerate(text):
            nexts: dict[tuple[int, int], tuple[float, tuple | None]] = {}

            def reach(state, total, link, nexts=nexts):
                if state not in nexts or total < nexts[state][0]:
                    nexts[state] = (total, link)

            own = self.index.get(c)
            signs = [self.index[x] for x in LOOK_ALIKE.get(c, "") if x in self.index]
            letter = c.isalpha()
            for (a, b), (total, link) in states.items():
                row = self.cost[a][b]
                if own is not None:
                    reach((b, own), total + row[own], (own, link))
                for x in signs:
                    reach((b, x), total + SIGN_COST + row[x], (x, link))
                if i and c == text[i - 1] and letter:
                    reach((a, b), total + REPEAT_COST, link)
                if own is None and (not letter or not signs):
                    mark = c in MARKS
                    if mark or not letter:
                        reach((a, b), total + (drop if mark else LOST_COST), link)
                    if b == 0:
                        reach((0, 0), total + (end if mark else LOST_COST), link)
                    else:
                        reach((0, 0), total + row[0] + (end if mark else LOST_COST), (0, link))
            states = nexts
        _, link = min(((t + (self.cost[a][b][0] if b else 0.0), link) for (a, b), (t, link) in states.items()), key=lambda x: x[0])
        read = []
        while link is not None:
            read.append(self.letters[link[0]])
            link = link[1]
        return [w for w in "".join(reversed(read)).split("#") if w]


class Restorer:
    """What ``of`` makes of the restored words of a text's tokens, as a set; kept by token in a bounded cache.

    ``known``: words that are also looked for in two pieces.
    """

    def __init__(self, model: CharModel, of: Callable[[Iterable[str]], Iterable[str]] = tuple, most: int = 700_000, known: Iterable[str] = ()):
        self.decode, self.of, self.most, self.seen, self.known = Decoder(model), of, most, {}, frozenset(known)

    def word(self, word: str) -> list[str]:
        """Readings of letters."""
        if not _TWICE(word):
            return [word]
        read = self.decode.letters_only(word)
        return read if _RUN(word) else [word, *read]

    def token(self, token: str) -> list[str]:
        if token.isalpha():
            return self.word(token)
        inner = _INNER.search(token)
        core = inner[0] if inner else ""
        own = self.word(core) if core and _PLAIN(core) else []
        # Signs around a plain word: the word, unless they too can be letters.
        if own and not set(token) & set("@$!|+€£("):
            return own
        if _NUMBER(token):
            return []
        return [*own, *self.decode(token.strip("".join(MARKS)))]

    def pieces(self, text: str) -> Iterator[str]:
        """Known words that stand in two pieces."""
        words, firsts = letter_runs(text), beginnings(self.known)
        # Only a word that begins a known one is joined to the next.
        at = [i for i, word in enumerate(words[:-1], 1) if word in firsts]
        pairs = {(words[i - 1], words[i]): None for i in at if words[i - 1] + words[i] in self.known}
        hits = {a + b for a, b in pairs}
        for a, b in pairs:
            if a + b in hits and a + b in self.decode(f"{a} {b}"):
                hits -= {a + b}
                yield a + b

    def __call__(self, text: str) -> set[str]:
        text = text.lower()
        out: set[str] = set()
        if _MAYBE_SPACED(text):
            for match in _SPACED.finditer(text):
                out.update(self.of(self.decode(_BLANKS(" ", match[0]), spaced=True)))
        if self.known:
            out.update(self.of(self.pieces(text)))
        if len(self.seen) >= self.most:
            self.seen.clear()
        seen, tokens = self.seen, set(text.split())
        for token in tokens.difference(seen):
            seen[token] = tuple(self.of(self.token(token)))
        out.update(*filter(None, map(seen.__getitem__, tokens)))
        return out


def terms_of(words: Iterable[str]) -> set[str]:
    out = set()
    for w in words:
        n = len(w)
        if n >= 3:
            out.add(w)
            if n > 4:
                out.add("^" + w[:4])
                if n > 5:
                    out.add("^" + w[:5])
                    if n > 6:
                        out.add("^" + w[:6])
    return out


def _weight(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    """Lower bound of the log odds; 0 for terms too rare or too weak to count."""
    if toxic < MIN_SUPPORT:
        return 0.0
    odds = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
    bound = odds - math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    return bound if bound > MIN_WEIGHT else 0.0


@dataclass
class ToxicityModel:
    chars: CharModel
    n_toxic: int
    n_clean: int
    counts: dict[str, tuple[int, int]]
    coefficients: np.ndarray

    def restorer(self) -> Restorer:
        """From texts to those of their terms that the model knows."""
        return Restorer(self.chars, lambda words: self.counts.keys() & terms_of(words), known=(t for t in self.counts if t[0] != "^"))

    def evidence(self, terms: Iterable[str], label: int | None = None) -> list[float]:
        """The three strongest weights and how much the others add; ``label`` leaves the document's own count out."""
        found = []
        for t in terms:
            toxic, clean = self.counts[t]
            # A word in two pieces was not counted where it stands.
            found.append(_weight(toxic - (label == 1), max(clean - (label == 0), 0), self.n_toxic, self.n_clean))
        found = sorted((w for w in found if w), reverse=True)
        top = [*found[:3], 0.0, 0.0, 0.0][:3]
        return [*top, math.log1p(sum(found[3:]))]

    def score(self, rows: list[list[float]]) -> np.ndarray:
        z = np.c_[np.ones(len(rows)), np.array(rows).reshape(len(rows), 4)] @ self.coefficients
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    """Newton steps, each halved until the penalised likelihood does not fall."""
    x = np.c_[np.ones(len(x)), x]
    b = np.zeros(x.shape[1])
    loss = lambda b: np.logaddexp(0, x @ b).sum() - y @ (x @ b) + ridge / 2 * b @ b
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), x.T @ (p - y) + ridge * b)
        size = 1.0
        while size > 1e-6 and loss(b - size * step) > loss(b):
            size /= 2
        b = b - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return b


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(True))


def word_counts(documents: DataFrame) -> DataFrame:
    """word, n: every run of letters of the corpus, lower-cased, with the number of documents' tokens that hold it."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words: Counter = Counter()
            for token, n in tokens.items():
                token = token.lower()
                for w in (token,) if token.isalpha() else _WORDS(token):
                    words[w] += n
            tokens.clear()
            return pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "n": pa.array(words.values(), pa.int64())})

        for batch in batches:
            for text in batch.column("text"):
                tokens.update(text.as_py().split())
                if len(tokens) > _FLUSH:
                    yield flush()
        yield flush()

    found = documents.select(text_or_empty().alias("text")).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def training_rows(documents: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, most: int) -> DataFrame:
    """text and label of the first ``most`` labelled documents by hash of doc_id, held-out ones left out."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
    own = own.groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # so at most ``most`` ids are broadcast
    return documents.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(own), "doc_id").select("text", "_label")


def fit_toxicity(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, terms: int = TERMS) -> ToxicityModel:
    small_batches(documents.sparkSession)
    chars = fit_char_model(word_counts(documents))
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(chars)
    rows = stored(training_rows(documents, labels, "toxic", FOLDS, HELD, train_rows))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore, seen = Restorer(shared.value, terms_of), ({}, {})

        def flush() -> pa.RecordBatch:
            keys = list(dict.fromkeys([*seen[1], *seen[0]]))
            out = pa.RecordBatch.from_pydict(
                {"term": pa.array(keys, pa.string()), "toxic": pa.array([seen[1].get(k, 0) for k in keys], pa.int64()), "clean": pa.array([seen[0].get(k, 0) for k in keys], pa.int64())}
            )
            seen[0].clear(), seen[1].clear()
            return out

        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("_label").to_pylist(), strict=True):
                into = seen[1 if label else 0]
                for t in restore(text.as_py()):
                    into[t] = into.get(t, 0) + 1
                if len(seen[0]) + len(seen[1]) > _FLUSH:
                    yield flush()
        yield flush()

    sizes = dict(rows.groupBy((F.col("_label") > 0).cast("int").alias("y")).count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return ToxicityModel(chars, n_toxic, n_clean, {}, np.array([500.0 if n_toxic else -500.0, 0, 0, 0, 0]))
    counts = rows.mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    bound = odds - F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = counts.where((F.col("toxic") >= MIN_SUPPORT) & (bound > MIN_WEIGHT)).orderBy(F.desc(F.round(bound, 6)), "term").limit(terms)
    model = ToxicityModel(chars, n_toxic, n_clean, {r.term: (r.toxic, r.clean) for r in best.collect()}, np.zeros(5))
    unfitted = spark.sparkContext.broadcast(model)

    def evidence(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unfitted.value
        restore = model.restorer()
        for batch in batches:
            ys = [int(y > 0) for y in batch.column("_label").to_pylist()]
            xs = [model.evidence(restore(t.as_py()), y) for t, y in zip(batch.column("text"), ys, strict=True)]
            yield pa.RecordBatch.from_pydict({"x": pa.array(xs, pa.list_(pa.float64())), "y": pa.array(ys, pa.int32())})

    seen = rows.mapInArrow(evidence, "x array<double>, y int").toArrow()  # train_rows rows of five numbers
    x, y = np.array(seen["x"].to_pylist(), float).reshape(-1, 4), np.array(seen["y"].to_pylist(), float)
    order = np.lexsort([*x.T, y])
    model.coefficients = fit_logistic(x[order], y[order])
    return model


def score_toxicity(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """A row per document: doc_id, text_key, held_out, score, predicted."""
    model = documents.sparkSession.sparkContext.broadcast(fit_toxicity(documents, labels))
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = model.value.restorer()
        for batch in batches:
            rows = [model.value.evidence(restore(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(model.value.score(rows), pa.float64())], ["doc_id", "text_key", "score"]
            )

    id_type = documents.schema["doc_id"].dataType.simpleString()
    docs = documents.select("doc_id", text_key().alias("text_key"), text_or_empty().alias("text"))
    out = docs.mapInArrow(score, f"doc_id {id_type}, text_key long, score double")
    return out.select(
        "doc_id", "text_key", held_out(F.col("doc_id"), FOLDS, HELD).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
