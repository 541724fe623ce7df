"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. Every ``GRAM`` words are
hashed; in each run of ``SPAN - GRAM + 1`` consecutive hashes the smallest (leftmost on ties) is kept. Two
texts that share ``SPAN`` words therefore share a kept hash at the same place of the shared words, so the
join of kept hashes meets every shared span. Each meeting is extended word by word to both sides, on the
words themselves, and counts when ``SPAN`` or more words agree. Items of fewer words have no full window:
the whole item is one hash, looked up among the documents' hashes of that length.

The item side is broadcast only when its counted rows are at most ``BROADCAST_ROWS``, and then every hash of a
document is looked up, not the kept ones only; otherwise both sides are shuffled on the kept hashes. Nothing is grouped by a hash, so a passage held by many documents costs each
document its own rows only.

Defined cases: null or wordless texts have no words and are clean; null items have no windows; a null
item_id still marks words but is not listed; repeated documents give repeated rows; several rows of one
item_id are one item; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import ascii_lower, repeat_rows, text_key, text_or_empty

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before A-Z are lower-cased: enough to count them.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPAN, GRAM = 10, 5
#: A row holds at most 2 * SPAN words of context: some hundred bytes.
BROADCAST_ROWS = 400_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _gram_at(size: int, place: Column) -> Column:
    """The hash of ``size`` consecutive words."""
    return F.xxhash64(F.lit(size), *[F.get(F.col("words"), place + j) for j in range(size)])


def _grams(size: int) -> Column:
    """A hash for every ``size`` consecutive words."""
    every = F.transform(F.sequence(F.lit(0), F.col("n_words") - size), lambda i: _gram_at(size, i))
    return F.when(F.col("n_words") >= size, every).otherwise(F.array().cast("array<bigint>"))


def _winnowed(df: DataFrame, span: int, gram: int) -> DataFrame:
    """Adds ``kept``: places of the kept hashes among ``grams``."""
    run = span - gram + 1

    def place(i: Column) -> Column:
        window = F.slice(F.col("grams"), i + 1, run)
        return i + F.array_position(window, F.array_min(window)) - 1

    kept = F.when(
        F.col("n_words") >= span,
        F.array_distinct(F.transform(F.sequence(F.lit(0), F.col("n_words") - span), lambda i: place(i.cast("bigint")))),
    ).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn("kept", kept)


def _worded(df: DataFrame) -> DataFrame:
    return df.withColumn("words", words_of(text_or_empty())).withColumn("n_words", F.size("words"))


def _around(place: Column, before: int, length: int) -> Column:
    """Words from ``before`` places left of ``place``, as far as there are any."""
    start = F.greatest(place - before, F.lit(0)).cast("int")
    return F.slice(F.col("words"), start + 1, (place + length).cast("int") - start)


def _prints(df: DataFrame, keep: list[str], span: int, gram: int, short: list[int], whole: bool) -> DataFrame:
    """One row per kept hash: size of its gram, place, hash and the words around it.

    ``whole``: for items, where only an item as long as a short window is hashed as such.
    """
    df = _winnowed(_worded(df).withColumn("grams", _grams(gram)), span, gram)
    entry = lambda size, place, value: F.struct(
        F.lit(size).alias("size"), place.cast("int").alias("place"), value.alias("hash")
    )
    lists = [F.transform("kept", lambda p: entry(gram, p, F.get(F.col("grams"), p.cast("int"))))]
    df = df.withColumns({f"grams_{n}": _grams(n) for n in short})

    def whole_grams(n: int) -> Column:
        # Negative sizes keep short windows of GRAM words apart from the kept hashes of long items.
        every = F.transform(f"grams_{n}", lambda h, i: entry(-n, i, h))
        return F.when(F.col("n_words") == n, every).otherwise(F.slice(every, 1, 0)) if whole else every

    tagged = lists + [whole_grams(n) for n in short]
    rows = df.select(*keep, "words", F.explode(F.concat(*tagged)).alias("print"))
    rows = rows.select(*keep, "words", F.col("print.size").alias("size"), F.col("print.hash").alias("hash"), F.col("print.place").alias("place"))
    return rows.select(*keep, "size", "hash", "place", *_context(span, gram))


def _context(span: int, gram: int) -> list[Column]:
    """What the comparison of a print needs of its ``words``: the gram, the words around it and how many are on the left."""
    place, size, reach = F.col("place"), F.col("size"), span - gram
    return [
        F.least(place, F.lit(reach)).alias("left"),
        F.when(size < 0, _around(place, 0, 0)).otherwise(_around(place, reach, gram + reach)).alias("near"),
        F.when(size < 0, F.slice(F.col("words"), place + 1, -size)).otherwise(_around(place, 0, gram)).alias("gram"),
    ]


def _probed(docs: DataFrame, items: DataFrame, span: int, gram: int, short: list[int]) -> DataFrame:
    """Documents beside broadcast prints of items: a row per meeting, and one of place -1 per document.

    Every gram of a document is looked up where it stands, which costs less than choosing some of them, as nothing is
    shuffled; only grams that meet take their words along.
    """
    rows = _worded(docs).select("doc_id", "text_key", "words", "n_words", F.explode(F.sequence(F.lit(-1), F.col("n_words") - 1)).alias("place"))
    own = F.col("place") < 0
    at = lambda n: F.when(~own & (F.col("place") <= F.col("n_words") - n), _gram_at(n, F.col("place")))
    sizes = [(0, F.when(own, F.lit(0).cast("bigint"))), (gram, at(gram)), *((-n, at(n)) for n in short)]
    if short:
        rows = rows.select("*", F.inline(F.array(*[F.struct(F.lit(n).alias("size"), h.alias("hash")) for n, h in sizes])))
    else:
        rows = rows.select("*", F.when(own, 0).otherwise(gram).alias("size"), F.coalesce(*[h for _, h in sizes]).alias("hash"))
    # An inner join, met in its turn by the documents' own rows: rows without a meeting end inside it.
    items = items.unionByName(items.sparkSession.sql("select 0 as size, 0L as hash"), allowMissingColumns=True)
    met = rows.join(F.broadcast(items), ["size", "hash"])
    return met.select("doc_id", "text_key", "n_words", "item_id", "size", "place", "item_left", "item_near", "item_gram", *_context(span, gram))


def _agreeing(a: Column, b: Column, a_from: Column, b_from: Column, step: int, most: int) -> Column:
    """How many words agree in a row from a place of each on, going by ``step``, ``most`` at most."""

    def more(n: Column, i: Column) -> Column:
        x, y = (F.when(at >= 0, F.get(words, at)) for words, at in ((a, a_from + i * step), (b, b_from + i * step)))
        return F.when((n == i) & (x == y), n + 1).otherwise(n)

    return F.aggregate(F.sequence(F.lit(0), F.lit(most - 1)), F.lit(0), more) if most else F.lit(0)


def _meetings(documents: DataFrame, benchmark: DataFrame, span: int, gram: int) -> DataFrame:
    """Rows of ``benchmark_spans``, and a row with ``n_words`` and nothing else for every document."""
    items = benchmark.select("item_id", "text")
    lengths = items.select(F.size(words_of(text_or_empty())).alias("n")).where(f"n > 0 and n < {span}").distinct()
    short = sorted(r.n for r in lengths.collect())  # fewer than ``span`` numbers
    item_prints = _prints(items, ["item_id"], span, gram, short, True)
    item_prints = item_prints.select(
        "size", "hash", "item_id", F.col("left").alias("item_left"), F.col("near").alias("item_near"), F.col("gram").alias("item_gram")
    )
    docs = documents.select("doc_id", "text", text_key().alias("text_key"))
    if item_prints.count() <= BROADCAST_ROWS:
        met = _probed(docs, item_prints, span, gram, short)
    else:
        met = _prints(docs, ["doc_id", "text_key"], span, gram, short, False).join(item_prints, ["size", "hash"]).withColumn("n_words", F.lit(None).cast("int"))
        n_words = F.size(F.regexp_extract_all(text_or_empty(), F.lit(RAW_WORD), F.lit(0)))
        own = docs.select("doc_id", "text_key", n_words.alias("n_words"), F.lit(-1).alias("place"))
        met = met.unionByName(own, allowMissingColumns=True)
    reach = span - gram
    own = F.col("place") < 0
    met = met.where(own | (F.col("gram") == F.col("item_gram"))).withColumns(
        {
            "before": _agreeing(F.col("near"), F.col("item_near"), F.col("left") - 1, F.col("item_left") - 1, -1, reach),
            "after": _agreeing(F.col("near"), F.col("item_near"), F.col("left") + gram, F.col("item_left") + gram, 1, reach),
        }
    )
    # Rows that do not count lose their span and are not filtered: a filter would be worked out inside the join.
    long = F.col("size") > 0
    counts = ~own & (~long | (F.col("before") + F.col("after") + gram >= span))
    first = F.when(long, F.col("place") - F.col("before")).otherwise(F.col("place")).cast("int")
    end = F.when(long, F.col("place") + gram + F.col("after")).otherwise(F.col("place") - F.col("size")).cast("int")
    return met.select(
        "doc_id",
        "text_key",
        F.when(own, F.col("n_words")).alias("n_words"),
        F.when(counts, F.col("item_id")).alias("item_id"),
        F.when(counts, F.struct(first.alias("start"), end.alias("end"))).alias("span"),
    )


def benchmark_spans(documents: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The distinct meetings of documents and items: doc_id, text_key, item_id, first and end word place."""
    key = ["doc_id", "text_key", "item_id"]
    met = _meetings(documents, benchmark, span, gram).groupBy(*key).agg(F.collect_set("span").alias("spans"))
    return met.select(*key, F.inline("spans"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """A row per document: n_words, the hit word spans (merged), n_hit, sorted item_ids, contaminated."""
    met = _meetings(documents, benchmark, span, gram)
    out = met.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"),
        F.count("n_words").alias("rows"),
        F.array_sort(F.collect_set("span")).alias("found"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    start = F.array().cast("array<struct<start:int,end:int>>")

    def merge(done: Column, new: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], new["end"]).alias("end"))
        return F.when(last["end"] >= new["start"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(new))
        )

    out = out.withColumn("spans", F.when(F.size("found") == 0, start).otherwise(F.aggregate("found", start, merge)))
    out = out.withColumn("n_hit", F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]))
    return repeat_rows(
        out, "rows", ["doc_id", "text_key", "n_words", "spans", "n_hit", "items", (F.col("n_hit") > 0).alias("contaminated")]
    )
