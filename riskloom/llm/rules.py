"""Operator 7: quality rules with risk-controlled cutoffs, in DataFrame functions only.

Word statistics of each whole text feed five one-sided rules (reject above a cutoff).
The distinct texts of a stratum's labelled good documents are the holdout (copies are no
independent draws; near copies still count one by one): a cutoff is safe if the exact
binomial test refutes, at level ``delta`` / (strata * rules), that it rejects more than
``alpha`` / rules of the good documents there. Cutoffs of a rule are tested from the
loosest on and the testing stops at the first that is not safe (fixed-sequence testing),
so with probability 1 - ``delta`` every stratum loses at most ``alpha`` of its good
documents to the rules. A stratum without enough labels keeps all that the base keeps.

Null texts have no words and fail the base; a null stratum is a stratum of its own. Null
or repeated labels: rows without a quality are skipped, a document with several counts
once, with the highest. Without labels no rule applies.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import stored

BLANK = r"[\x20\x09-\x0D]+"
#: rule -> (numerator, denominator, cutoffs from loose to strict)
RULES = {
    "symbols": ("n_symbols", "word_chars", [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05]),
    "repeats": ("n_repeat_words", "n_words", [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1]),
    "dup_lines": ("n_dup_lines", "n_lines", [0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1]),
    "capitals": ("n_capitals", "word_chars", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2]),
    "long_words": ("word_chars", "n_words", [40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 15.0, 14.0, 13.0, 12.0]),
}
#: strata up to which the cutoff table is broadcast; beyond, it is joined by shuffle
BROADCAST_STRATA = 10_000


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                          lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        at = let(ordered, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
                     | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"])))
        return F.aggregate(at, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                           lambda acc, p: F.struct(p.alias("last"),
                                                   (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
                           lambda acc: acc["n"])

    return F.when(F.size(words) < 3, 0).otherwise(
        let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))


def statistics(text: Column) -> Column:
    """Struct of the long statistics of one whole text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> list[Column]:
        return [F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                _repeat_words(w).cast("long").alias("n_repeat_words")]

    def of_lines(x: Column) -> list[Column]:
        return [F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")]

    words = F.filter(F.split(text, BLANK), lambda x: x != "")
    return let(words, lambda w: let(lines, lambda x: F.struct(
        *of_words(w), *of_lines(x),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long").alias("n_capitals"))))


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def _level(stats: Column, rule: str) -> Column:
    """How many of the rule's cutoffs, from the loosest on, the document does not exceed;
    it is rejected by the cutoffs at and after that place."""
    top, bottom, cutoffs = RULES[rule]
    value = stats[top] / F.greatest(stats[bottom], F.lit(1))
    return sum((F.when(value <= c, 1).otherwise(0) for c in cutoffs), F.lit(0))


def _log_factorial(n: Column) -> Column:
    n = n.cast("double")
    series = ((n + 0.5) * F.log(n) - n + 0.5 * math.log(2 * math.pi) + 1 / (12 * n) - 1 / (360 * n ** 3)
              + 1 / (1260 * n ** 5) - 1 / (1680 * n ** 7))
    return F.when(n <= 20, F.log(F.factorial(n.cast("int")).cast("double"))).otherwise(series)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for k below the mean n * p. The terms fall from k downwards, so 12
    standard deviations of them hold all that double precision can hold."""
    first = (_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
             + k * math.log(p) + (n - k) * math.log1p(-p))
    terms = F.least(k, F.ceil(12 * F.sqrt(n.cast("double"))) + 50).cast("int")
    odds = (1 - p) / p
    total = F.aggregate(
        F.sequence(F.lit(0), terms), F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s")),
        lambda acc, i: F.struct((acc["t"] * (k - i) / (n - k + i + 1) * odds).alias("t"),
                                (acc["s"] + acc["t"]).alias("s")),
        lambda acc: acc["s"])
    return F.exp(first) * total


def safe_cutoffs(labelled: DataFrame, alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """One row per stratum with a map rule -> number of leading cutoffs that are safe.

    ``labelled``: ``stratum`` and ``stats`` of documents labelled good that pass the base.
    """
    levels = labelled.select("stratum", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), _level(F.col("stats"), r).alias("level"), F.lit(len(RULES[r][2])).alias("cutoffs"))
        for r in RULES])).alias("x")).select("stratum", "x.*")
    counts = levels.groupBy("stratum", "rule", "cutoffs", "level").count()
    tests = counts.groupBy("stratum", "rule", "cutoffs").agg(
        F.sum("count").alias("n"), F.collect_list(F.struct("level", "count")).alias("found")).select(
        "stratum", "rule", "n", "found", F.explode(F.sequence(F.lit(1), "cutoffs")).alias("place")).select(
        "stratum", "rule", "n", "place",
        F.aggregate("found", F.lit(0).cast("long"),
                    lambda a, x: a + F.when(x["level"] < F.col("place"), x["count"]).otherwise(0)).alias("k"))
    limit = alpha / len(RULES)
    strata = max(1, labelled.select("stratum").distinct().count())
    judged = tests.withColumn(
        "safe", F.when(F.col("k") < F.col("n") * limit,
                       binomial_cdf(F.col("k"), F.col("n"), limit) <= delta / (strata * len(RULES)))
        .otherwise(False))
    run = Window.partitionBy("stratum", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return (judged.withColumn("ok", F.min(F.col("safe").cast("int")).over(run))
            .groupBy("stratum", "rule").agg(F.sum("ok").alias("places"))
            .groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "places"))).alias("places")))


def _with_cutoffs(rows: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``rows(stratum, ...)`` plus ``places``. ``cutoffs`` must be a stored table."""
    if cutoffs.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA:
        cutoffs = F.broadcast(cutoffs)
    return rows.join(cutoffs, "stratum", "left")


def _passes(stats: Column) -> Column:
    """Whether a document with these statistics passes the base and the rules of its stratum."""
    failed = base_failed(stats)
    for r in RULES:
        failed = failed | (_level(stats, r) < F.coalesce(F.col("places")[r], F.lit(0)))
    return ~failed


def _good(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per stratum and distinct text of the good documents that pass the base."""
    good = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.max("quality").alias("quality")).where("quality = 1").select("doc_id")
    return stats.join(good, "doc_id").where(~base_failed(F.col("stats"))).select(
        "stratum", "body", "stats").distinct().drop("body")


def _measured(docs: DataFrame, stratum: str) -> DataFrame:
    """doc_id, stratum, hash of the text and its statistics, stored."""
    return stored(docs.select("doc_id", F.coalesce(F.col(stratum), F.lit("")).alias("stratum"),
                              F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("body"),
                              statistics(F.col("text")).alias("stats")), "rule-stats")


def quality_verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.05,
                     delta: float = 0.05) -> DataFrame:
    """doc_id, stratum, stats, base_failed and kept of every row of ``docs``."""
    stats = _measured(docs, stratum)
    cutoffs = stored(safe_cutoffs(_good(stats, labels), alpha, delta), "rule-cutoffs")
    return _with_cutoffs(stats.drop("body"), cutoffs).withColumns(
        {"base_failed": base_failed(F.col("stats")), "kept": _passes(F.col("stats"))}).drop("places")


def quality_filter(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.05,
                   delta: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns only. The statistics are
    stored for the holdout and taken once more, by one expression, where the rows are judged:
    no text is copied or shuffled."""
    cutoffs = stored(safe_cutoffs(_good(_measured(docs, stratum), labels), alpha, delta), "rule-cutoffs")
    rows = docs.select(F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), F.col("text").alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return _with_cutoffs(rows, cutoffs).where(let(statistics(F.col("text")), _passes)).select("row.*")
