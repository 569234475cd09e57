"""Leaks held against every window start of every document, and rows judged by their own text."""

import random

from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.llm.decontam import _features, _held, _met, _runs, _weighed, _weight, leaks, simhash, without_leaks, words_of
from riskloom.llm.minhash import drop_near_duplicates
from tests.conftest import SF
from tests.llm import brute
from tests.llm.brute import documents

ITEMS = "item_id long, text string"


def _every_start(rows, items, k=5, percent=80):
    """{(doc_id, item_id): best similarity} over all item-sized windows."""
    grams = lambda w: {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    weight = lambda s: sum(sum(map(len, g)) for g in s)
    out = {}
    for doc, text in rows:
        w = brute._plain_words(text)
        for item, body in items:
            t = brute._plain_words(body)
            b = grams(t)
            for s in range(max(0, len(w) - len(t)) + 1):
                a = grams(w[s:s + len(t)])
                x, u = weight(a & b), weight(a | b)
                if 100 * x >= percent * u:
                    out[doc, item] = max(out.get((doc, item), 0), x / u)
    return out


def _text(rng, n):
    return ["".join(rng.choice("aeiou") + rng.choice("bcdfgklmnprst") for _ in range(rng.randint(1, 3))) for _ in range(n)]


def test_reordered_items_are_found(spark):
    rng = random.Random(5)
    a, b, c, d, x, y = (_text(rng, n) for n in (30, 30, 25, 25, 50, 50))
    bench = [(1, " ".join(a + b)), (2, " ".join(c + d)), (3, " ".join(a[:28] + c[:28]))]
    rows = [(1, " ".join(x + b + a + y)), (2, " ".join(x + d + c)), (3, " ".join(d + c + y)),
            (4, " ".join(x + a + y + b)), (5, " ".join(x[:9] + a[:25] + a[:3] + b + y)), (6, " ".join(c + d[:12])),
            (7, " ".join(b + x[:2] + a)), (8, " ".join(x + y)), (9, " ".join((x + b + a) * 3))]
    got = {(r["doc_id"], r["item_id"]): r["similarity"]
           for r in leaks(documents(spark, rows), spark.createDataFrame(bench, ITEMS)).collect()}
    want = _every_start(rows, bench)
    assert got.keys() == want.keys() and {(1, 1), (2, 2), (3, 2), (9, 1)} <= got.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_rows_are_dropped_by_their_own_text(spark):
    rng = random.Random(6)
    item, other, clean = (" ".join(_text(rng, 40)) for _ in range(3))
    bench = spark.createDataFrame([(1, item)], ITEMS)
    rows = [(None, "lead " + item), (None, clean), (None, None), (7, item), (7, clean), (8, other), (8, other)]
    kept = without_leaks(documents(spark, rows), bench).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept) == sorted(
        (str(i), t or "") for i, t in rows if not t or item not in t)
    found = leaks(documents(spark, [*rows, (None, item), (None, item)]), bench).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["7", "None", "None"]


def test_other_texts_under_a_repeated_id_stay(spark):
    rng = random.Random(7)
    a, b, c = (" ".join(_text(rng, 60)) for _ in range(3))
    rows = [(1, a), (1, b), (1, b), (2, a + " end"), (3, c), (None, c), (None, "short")]
    kept = drop_near_duplicates(documents(spark, rows), words=5, similarity=80).collect()
    texts = sorted(r["text"] for r in kept)
    assert len(texts) == 4 and "short" in texts
    assert sum(t in (a, a + " end") for t in texts) == 1 and texts.count(b) == 1 and texts.count(c) == 1
    assert {r["doc_id"] for r in kept if r["text"] == c} == {3}


def test_a_changed_very_long_word_stays_within_the_radius(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(20):
        a = _text(rng, 300)
        at = rng.randrange(20, 280)
        long = lambda: "".join(rng.choice("abcdefghij") for _ in range(110))
        rows.append((" ".join([*a[:at], long(), *a[at + 1:]]), " ".join([*a[:at], long(), *a[at + 1:]])))
    features = lambda c: _features(words_of(F.col(c)), 5)
    d = spark.createDataFrame(rows, "a string, b string").select(features("a").alias("a"), features("b").alias("b"))
    shared = _weight(F.array_intersect("a", "b"))
    either = _weight(F.col("a")) + _weight(F.col("b")) - shared
    got = d.select((100 * shared >= 80 * either).alias("leak"),
                   F.bit_count(simhash(F.col("a")).bitwiseXOR(simhash(F.col("b")))).alias("bits")).collect()
    assert all(r["leak"] for r in got) and max(r["bits"] for r in got) <= 18


def test_a_shingle_weighs_all_its_characters(spark):
    rng = random.Random(11)
    item, other = _text(rng, 30), _text(rng, 30)
    long = ["".join(rng.choice("abcdefghij") for _ in range(1500)) for _ in range(12)]
    bench = [(1, " ".join(item[:15] + long[:6] + item[15:])), (2, " ".join(other[:15] + long[6:] + other[15:]))]
    rows = [(1, " ".join(item[:15] + long[:5] + item[15:])), (2, " ".join(long[:6] + other)), (3, " ".join(other + long[6:])),
            (4, bench[1][1])]
    got = {(r["doc_id"], r["item_id"]): r["similarity"]
           for r in leaks(documents(spark, rows), spark.createDataFrame(bench, ITEMS), radius=63).collect()}
    want = _every_start(rows, bench)
    assert got.keys() == want.keys() and (4, 2) in got
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_the_radius_loses_no_pair_of_the_test_tables(spark):
    """Radius 63 has blocks of one bit: only a window whose every bit differs is passed over."""
    pairs = [{(r["doc_id"], r["body"], r["item_id"]) for r in _held(
        table(spark, SF, "documents"), table(spark, SF, "benchmark"), radius=radius).collect()} for radius in (18, 63)]
    assert pairs[0] == pairs[1] and pairs[0]


def test_only_texts_with_windows_travel_and_only_their_runs(spark):
    """What is joined and dealt out follows the windows found, not the length or number of texts."""
    rng = random.Random(8)
    item = _text(rng, 20)
    leaky = " ".join(_text(rng, 3000) + item + _text(rng, 3000))
    texts = documents(spark, [(1, leaky)] + [(i, " ".join(_text(rng, 10))) for i in range(2, 300)]).select(
        "doc_id", "text", F.xxhash64("text").alias("body"))
    runs = "array<struct<n: int, least: long, held: long, lo: int, hi: int>>"
    windows = texts.where("doc_id = 1").select("doc_id", "body", F.expr(f"from_json('[{{\"n\":20,\"lo\":2995,\"hi\":3005}}]', '{runs}')").alias("windows"))
    met = _met(texts, windows)
    assert met.where("doc_id = 1").count() == 1 and met.count() < 30
    run = met.join(windows, ["doc_id", "body"]).withColumn("w", words_of(F.col("text"))).select(
        F.inline(_runs(_weighed(F.col("w"), 5), 5))).collect()
    assert [(r["lo"], r["hi"], len(r["grams"])) for r in run] == [(2995, 3004, 3004 - 2995 + 20 - 4)]
    got = leaks(documents(spark, [(1, leaky)]), spark.createDataFrame([(1, " ".join(item))], ITEMS)).collect()
    assert [(r["doc_id"], r["first_word"], r["n_words"], r["similarity"]) for r in got] == [(1, 3000, 20, 1.0)]
