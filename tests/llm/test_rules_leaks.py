import math

import pytest
from pyspark.sql import functions as F

from riskloom.llm import rules
from riskloom.llm.common import table
from riskloom.llm.decontam import WEIGHT, _blocks, leaks, simhash, without_leaks
from tests.conftest import SF
from tests.llm import brute
from tests.llm.brute import documents, edge_rows, edges

LABELS = "doc_id long, quality int, toxic int, lang string"


def test_statistics_equal_plain_counts(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    rows += [(100 + i, t) for i, t in enumerate(["a b c a b c a b c d", "x x x", "x x", "a b a b a b\na b a b a b", "q\n q\nq"])]
    labels = spark.createDataFrame([], LABELS)
    got = rules.quality_verdicts(documents(spark, rows), labels).collect()
    have = sorted((str(r["doc_id"]), *(r["stats"][k] for k in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), r["base_failed"], r["kept"]) for r in got)
    want = []
    for i, t in rows:
        s = brute.rule_statistics(t)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        want.append((str(i), *s, failed, not failed))
    assert have == sorted(want)


@pytest.mark.parametrize("p", [0.01, 0.05])
def test_binomial_cdf_is_exact(spark, p):
    cases = [(k, n) for n in (1, 7, 20, 21, 300, 5000, 200_000) for k in (0, 1, 3, 40, 1900) if k < n * p]
    df = spark.createDataFrame(cases, "k long, n long").select(
        "k", "n", rules.binomial_cdf(F.col("k"), F.col("n"), p).alias("x"))
    for r in df.collect():
        terms = [math.lgamma(r["n"] + 1) - math.lgamma(i + 1) - math.lgamma(r["n"] - i + 1)
                 + i * math.log(p) + (r["n"] - i) * math.log1p(-p) for i in range(r["k"] + 1)]
        assert r["x"] == pytest.approx(math.fsum(map(math.exp, terms)), rel=1e-8, abs=1e-300)


def _labelled(spark, good, bad, symbol_share_of_good):
    word = "plain"
    rows, labels = [], []
    for i in range(good + bad):
        w = [f"{word}{(i * 31 + j * 17) % 9973}" for j in range(60)]
        if i >= good or i < symbol_share_of_good:
            w = [x + "###$$$" for x in w]
        rows.append((i, " ".join(w), "en"))
        labels.append((i, int(i < good), 0, "clash"))
    return documents(spark, rows), spark.createDataFrame(labels, LABELS)


def test_cutoffs_need_enough_holdout(spark):
    few, labels = _labelled(spark, 40, 10, 0)
    assert rules.quality_verdicts(few, labels).where("not kept").count() == 0
    many, labels = _labelled(spark, 700, 20, 0)
    assert {r["doc_id"] for r in rules.quality_verdicts(many, labels).where("not kept").collect()} == set(range(700, 720))


def test_cutoffs_that_would_reject_good_documents_are_refused(spark):
    docs, labels = _labelled(spark, 700, 20, 60)
    assert rules.quality_verdicts(docs, labels).where("not kept").count() == 0


def test_copies_are_one_draw_of_the_holdout(spark):
    few, labels = _labelled(spark, 40, 10, 0)
    rows = [(r["doc_id"] + 1000 * k, r["text"], "en") for r in few.collect() for k in range(20)]
    marks = [(r["doc_id"] + 1000 * k, r["quality"], 0, "clash") for r in labels.collect() for k in range(20)]
    docs, labels = documents(spark, rows), spark.createDataFrame(marks, LABELS)
    assert rules.quality_verdicts(docs, labels).where("not kept").count() == 0
    assert rules.quality_filter(docs, labels).count() == len(rows)


def test_labels_may_be_null_or_repeated(spark):
    docs, labels = _labelled(spark, 700, 20, 0)
    more = labels.union(labels).union(spark.createDataFrame([(3, None, None, None), (None, 1, 0, None), (701, None, 0, None)], LABELS))
    assert rules.quality_verdicts(docs, more).where("not kept").count() == 20
    kept = rules.quality_filter(docs, more)
    assert kept.schema == docs.schema and kept.count() == 700
    assert rules.quality_filter(documents(spark, []), more).count() == 0


def test_rule_query_equals_duckdb(spark):
    """The registered query with its statement, on whole tables."""
    import duckdb
    from riskloom.llm.queries import oracle_sql, registry
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in oracle_sql().items():
        have, want = registry()[name](spark, SF), con.sql(sql)
        assert sorted(have.columns) == sorted(want.columns), name
        rows = want.select(*[f'"{c}"' for c in have.columns]).fetchall()
        assert sorted(map(str, map(tuple, have.collect()))) == sorted(map(str, rows)), name


ITEMS = "item_id long, text string, n int, fp string, doc_id string"


def _leak_case(spark):
    bench = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()[:12]]
    bench += [(90, None), (91, ""), (92, "just four words here"), (93, "one two three four five"), (94, bench[0][1])]
    w = bench[3][1].split()
    rows = [(r[0], r[1]) for r in edge_rows()] + [
        (100, "before it\n" + bench[0][1].upper() + "\nafter it"), (101, bench[1][1]),
        (102, "x y z " + " ".join(w[: len(w) // 2])), (103, " ".join([*w[1:], "end"])),
        (104, ("one, two (three) four -- five! " * 3)), (None, "lead " + bench[5][1]), (101, bench[2][1] + " tail")]
    return rows, bench


def test_leaks_equal_all_windows(spark):
    rows, bench = _leak_case(spark)
    items = spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in bench], ITEMS)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in leaks(documents(spark, rows), items).collect()}
    want = brute.leaks(rows, [x for x in bench if len(brute._plain_words(x[1])) >= 5])
    assert got.keys() == want.keys() and len(got) >= 7
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    clean = without_leaks(documents(spark, rows), items)
    leaky = {d for d, _ in brute.leaks([(n, t) for n, (_, t) in enumerate(rows)], bench)}
    left = [r for n, r in enumerate(rows) if n not in leaky]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in clean.collect()))) == sorted(map(str, left))
    assert clean.schema == documents(spark, []).schema


def test_leaks_of_empty_tables(spark):
    rows, bench = _leak_case(spark)
    items = spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in bench], ITEMS)
    assert leaks(documents(spark, []), items).count() == 0
    assert leaks(edges(spark), items.limit(0)).count() == 0
    assert without_leaks(edges(spark), items.limit(0)).count() == len(edge_rows())


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    import random
    random.seed(4)
    rows = []
    for i in range(200):
        x = random.getrandbits(64)
        y = x
        for bit in random.sample(range(64), i % 19):
            y ^= 1 << bit
        rows.append((x - 2**63, y - 2**63))
    df = spark.createDataFrame(rows, "x long, y long")
    hit = F.exists(F.zip_with(_blocks("x", 18), _blocks("y", 18), lambda a, b: a == b), lambda z: z)
    assert df.where(hit).count() == 200


def test_simhash_is_near_for_similar_shingles(spark):
    weighed = lambda x: x * (WEIGHT + 1) + 20
    base = [weighed(i * 7919 + 13) for i in range(60)]
    near = base[:54] + [weighed(10**9 + i) for i in range(6)]
    far = [weighed(2 * 10**9 + i * 104729) for i in range(60)]
    a, b, c = (r["h"] for r in spark.createDataFrame([(0, base), (1, near), (2, far)], "i int, f array<long>").orderBy(
        "i").select(simhash(F.col("f")).alias("h")).collect())
    apart = lambda x, y: bin((x ^ y) & (2**64 - 1)).count("1")
    assert apart(a, b) <= 18 < apart(a, c)
