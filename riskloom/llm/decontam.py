"""Operator 10: benchmark passages in documents, in DataFrame functions only.

Words are runs of letters and digits, lower-cased; a passage is its set of five-word
shingles, each weighted by its characters. A window of a document has the size of a
benchmark item and may start at any word. Only windows that can reach the similarity are
fingerprinted: the characters at the places whose shingle some item of that size holds,
wherever the item holds it, bound what window and item share, and a running sum over those
places gives the bound of every start. 64-bit SimHash fingerprints of windows meet those of
items of the same size through a
multi-index: 64 bits in ``radius + 1`` blocks, so fingerprints within ``radius`` bits of
each other agree on a block and none is missed. The exact weighted Jaccard similarity of
window and item then decides.

Two passages at similarity 0.8 differ in about 10 of 64 bits, whatever their words;
``radius`` 18 lies three standard deviations above. Items of fewer than five words are too short to tell from
ordinary text and never match. Each row is judged by its own text: what travels is doc_id
and a hash of the text. Rows that share a doc_id report an item once, by the best of their
windows; rows without one report it once for each text. Null texts have no words; an empty
benchmark finds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import NO_ID, id_text, real_id, stored
from riskloom.llm.rules import let

WEIGHT = 2**31 - 1  # low bits of a shingle's hash that hold its weight: no string is longer
KEY = ["doc_id", "body"]
HASHES = 1 << 20  # numbers that keys are told apart by before they are joined


def words_of(text: Column) -> Column:
    clean = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.filter(F.split(clean, " "), lambda x: x != "")


def _gram(w: Column, i: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(w, i + t) for t in range(k)])


def _grams(w: Column, k: int) -> Column:
    """Hashes of all k-word shingles, in order."""
    return F.when(F.size(w) < k, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: _gram(w, i, k)))


def _weighed(w: Column, k: int) -> Column:
    """All k-word shingles, in order; the low bits of each are its weight."""
    def one(i: Column) -> Column:
        chars = sum((F.length(F.get(w, i + t)) for t in range(k)), F.lit(0)).cast("long")
        return _gram(w, i, k).bitwiseAND(F.lit(~WEIGHT)).bitwiseOR(chars)
    return F.when(F.size(w) < k, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - k), one))


def _features(w: Column, k: int) -> Column:
    return F.array_distinct(_weighed(w, k))


def _weight(features: Column) -> Column:
    return F.aggregate(features, F.lit(0).cast("long"), lambda a, x: a + x.bitwiseAND(F.lit(WEIGHT)))


def simhash(features: Column) -> Column:
    """Bit b is set if the shingles whose hash has bit b weigh more than the others. What a
    shingle adds is the root of its weight: the share of bits that differ follows the squares
    of what is added, so a few very long words count as they do in the similarity."""
    pairs = F.transform(features, lambda x: F.struct(F.xxhash64(x).alias("h"), F.sqrt(x.bitwiseAND(F.lit(WEIGHT)).cast("double")).alias("w")))

    def bits(p: Column) -> Column:
        def lean(b: Column) -> Column:
            return F.aggregate(p, F.lit(0.0), lambda a, x: a + F.when(
                F.call_function("shiftrightunsigned", x["h"], b).bitwiseAND(F.lit(1)) == 1, x["w"]).otherwise(-x["w"]))
        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(
            F.when(lean(b) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))))
    return let(pairs, bits)


def _blocks(fingerprint: str, radius: int) -> Column:
    """The values of ``radius + 1`` blocks that share the 64 bits evenly."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.shiftrightunsigned(fingerprint, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
                     for lo, hi in zip(edges, edges[1:])])


def _indexed(rows: DataFrame, keep: list[str], radius: int) -> DataFrame:
    return rows.select(*keep, "n", "fp", F.posexplode(_blocks("fp", radius)).alias("block", "bits"))


def _starts(hits: DataFrame, words: int, similarity: int) -> DataFrame:
    """Runs of window starts lo .. hi - 1 whose places of shared shingles weigh ``held``,
    enough for some item of ``n`` words. A place counts for the starts from n - words words
    before it up to itself."""
    hits = hits.repartition(*KEY, "n").select(*KEY, "n", "least", "place", "weight").distinct()
    edges = hits.select(*KEY, "n", "least", F.inline(F.array(
        F.struct((F.col("place") - F.col("n") + words).alias("lo"), F.col("weight").alias("step")),
        F.struct((F.col("place") + 1).alias("lo"), (-F.col("weight")).alias("step")))))
    run = Window.partitionBy(*KEY, "n").orderBy("lo")
    sums = edges.withColumn("held", F.sum("step").over(run)).withColumn("hi", F.lead("lo").over(run))
    return sums.where((F.col("lo") < F.col("hi")) & (100 * F.col("held") >= similarity * F.col("least"))).select(
        *KEY, "n", "least", "held", "lo", "hi")


def _met(texts: DataFrame, windows: DataFrame) -> DataFrame:
    """The texts that may have a window, so that the join ships few others: their hash falls on
    one of ``HASHES`` numbers that a window's does. That list is bounded, whatever the tables hold."""
    number = F.pmod(F.xxhash64(*KEY), F.lit(HASHES)).cast("int").alias("number")
    return texts.withColumn("number", number).join(
        F.broadcast(windows.select(number).distinct()), "number", "left_semi").drop("number")


def _runs(grams: Column, words: int) -> Column:
    """The runs of window starts of a text, each with the shingles of its own windows only: what
    is dealt out start by start does not hold the text."""
    def one(x: Column) -> Column:
        lo = F.greatest(F.lit(0), x["lo"])
        hi = F.least(x["hi"] - 1, F.greatest(F.lit(0), F.size(grams) + words - 1 - x["n"]))
        return F.struct(x["n"].alias("n"), x["least"].alias("least"), x["held"].alias("held"), lo.alias("lo"), hi.alias("hi"),
                        F.slice(grams, lo + 1, F.greatest(F.lit(0), hi - lo + x["n"] - words + 1)).alias("grams"))
    return F.transform("windows", one)


def _held(docs: DataFrame, benchmark: DataFrame, words: int = 5, similarity: int = 80,
          radius: int = 18) -> DataFrame:
    """One row per text, item and window that reaches the similarity."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") >= words)
    items = stored(items.select("item_id", F.size("w").alias("n"), _grams(F.col("w"), words).alias("grams"),
                                _weighed(F.col("w"), words).alias("weighed"))
                   .withColumn("features", F.array_distinct("weighed")).withColumn("fp", simhash(F.col("features"))),
                   "items")
    least = items.groupBy("n").agg(F.min(_weight(F.col("features"))).alias("least"))
    item_grams = items.select("n", F.inline(F.arrays_zip("grams", "weighed"))).select(
        "n", F.col("grams").alias("gram"), F.col("weighed").bitwiseAND(F.lit(WEIGHT)).alias("weight"))
    item_grams = stored(item_grams.distinct().join(least, "n"), "item-grams")

    texts = id_text(docs).withColumn("body", F.xxhash64("text"))
    grams = texts.select(*KEY, F.posexplode(let(words_of(F.col("text")), lambda w: _grams(w, words)))
                         .alias("place", "gram"))
    windows = _starts(grams.join(item_grams, "gram"), words, similarity)
    windows = stored(windows.groupBy(*KEY).agg(F.collect_list(F.struct("n", "least", "held", "lo", "hi")).alias("windows")),
                     "runs")
    found = _met(texts, windows).join(windows, KEY)
    cut = found.select(*KEY, F.inline(let(
        let(words_of(F.col("text")), lambda w: _weighed(w, words)), lambda grams: _runs(grams, words))))
    cut = cut.where("lo <= hi").withColumn("s", F.explode(F.sequence("lo", "hi"))).select(
        *KEY, "s", "n", "least", "held",
        F.array_distinct(F.slice("grams", F.col("s") - F.col("lo") + 1, F.col("n") - words + 1)).alias("features"))
    cut = cut.where(100 * F.col("held") >= similarity * (_weight(F.col("features")) + F.col("least") - F.col("held")))
    cut = cut.drop("least", "held")
    cut = stored(cut.distinct().withColumn("fp", simhash(F.col("features"))), "windows")

    near = _indexed(cut, [*KEY, "s"], radius).alias("a").join(
        _indexed(items, ["item_id"], radius).alias("b"), ["n", "block", "bits"])
    near = near.where(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius).select(
        *KEY, "s", "n", "item_id").distinct()
    both = near.join(cut.select(*KEY, "s", "n", F.col("features").alias("fa")), [*KEY, "s", "n"]).join(
        items.select("item_id", F.col("features").alias("fb")), "item_id")
    shared = _weight(F.array_intersect("fa", "fb"))
    judged = both.select(*KEY, "item_id", "s", "n", shared.alias("shared"),
                         (_weight(F.col("fa")) + _weight(F.col("fb")) - shared).alias("either"))
    return judged.where(100 * F.col("shared") >= similarity * F.col("either")).select(
        *KEY, "item_id", F.struct((F.col("shared") / F.col("either")).alias("similarity"), (-F.col("s")).alias("s"),
                                  F.col("n").alias("n")).alias("m"))


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, the first word and number
    of words of the most similar window, and that similarity."""
    text = F.when(F.col("doc_id") == NO_ID, F.col("body")).alias("body")
    best = _held(docs, benchmark, **options).groupBy("doc_id", text, "item_id").agg(F.max("m").alias("m"))
    return best.select(real_id(), "item_id", (-F.col("m.s")).cast("long").alias("first_word"),
                       F.col("m.n").cast("long").alias("n_words"), F.col("m.similarity").alias("similarity"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    found = _held(docs, benchmark, **options).select(F.col("doc_id").alias("leaky"), "body").distinct()
    return docs.join(found, (F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)) == found["leaky"])
                     & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == found["body"]), "left_anti")
