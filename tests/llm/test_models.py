import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import langid, licenses, quality, urls
from riskloom.llm.common import WordHasher, table
from tests.conftest import SF, SF01
from tests.llm.brute import documents, edge_rows, edges

LABELS = "doc_id long, quality int, toxic int, lang string"


def _fold(n):
    return F.crc32(F.col("doc_id").cast("string")) % n


# ---------------------------------------------------------------- quality classifier
def test_quality_holds_up_on_held_out_documents(spark):
    labels = table(spark, SF01, "labels")
    out = quality.quality_scores(table(spark, SF01, "documents"), labels, _fold(5) == 0, _fold(5) == 4)
    p = out.join(labels, "doc_id").where("held_out").toPandas()
    rank, one = p.score.rank(), p.quality == 1
    auc = (rank[one].sum() - one.sum() * (one.sum() + 1) / 2) / one.sum() / (~one).sum()
    assert auc > 0.95 and out.count() == 1000
    assert out.where("score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0


def test_quality_never_reads_held_out_labels(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    turned = labels.withColumn("quality", F.when(_fold(5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in quality.quality_scores(docs, x, _fold(5) == 0, _fold(5) == 4).collect()}
            for x in (labels, turned))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-6 for k in a)


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(7, 1, 0, "x"), (7, 0, 0, "x"), (14, 0, 0, "x"), (None, 1, 1, "x"), (8, None, 0, "x")], LABELS)
    out = quality.quality_scores(edges(spark), labels, _fold(5) == 0, _fold(5) == 4).collect()
    assert len(out) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in out)
    none = quality.quality_scores(edges(spark), labels.limit(0), _fold(5) == 0, _fold(5) == 4).collect()
    assert {round(r["score"], 3) for r in none} == {0.5}
    assert quality.quality_scores(documents(spark, []), labels, _fold(5) == 0, _fold(5) == 4).count() == 0


def test_document_statistics_by_hand():
    texts = [b"AB cd cd!\n#x 12", b"", b"\xc3\xa9\xc3\xa9 z"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    x = quality.document_statistics(data, np.cumsum([0] + [len(t) for t in texts]), WordHasher())
    row = dict(zip(quality.FEATURES, x[0]))
    assert row["upper"] == pytest.approx(2 / 15) and row["digits"] == pytest.approx(2 / 15)
    assert row["symbols"] == pytest.approx(1 / 15) and row["symbol_words"] == pytest.approx(1 / 5)
    assert row["distinct_words"] == 1 and row["repeated_neighbours"] == 0
    assert not x[1].any() and x[2][quality.FEATURES.index("beyond_ascii")] == pytest.approx(4 / 6)


def test_isotonic_is_monotone_and_keeps_sums():
    rng = np.random.default_rng(1)
    n = rng.integers(1, 9, 40).astype(float)
    ones = np.floor(n * rng.random(40))
    at, rate = quality.isotonic(n, ones, np.arange(40.0))
    assert (np.diff(rate) > 0).all() and (np.diff(at) > 0).all()


def test_normal_equations_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(len(quality.FEATURES)).tolist(), float(i % 2)) for i in range(50)]
    model = quality.KernelRidge(np.zeros(len(quality.FEATURES)), np.ones(len(quality.FEATURES)), 16, 1.0, 3)
    df = spark.createDataFrame(rows, "doc_id long, x array<double>, y double")
    z = model.lift(np.array([r[1] for r in rows]))
    want = np.hstack([z.T @ z, (z.T @ np.array([r[2] for r in rows]))[:, None]])
    for parts in (1, 7):
        assert np.allclose(quality.normal_equations(df.repartition(parts), model), want)


# ---------------------------------------------------------------- language
def test_language_of_held_out_documents(spark):
    docs = table(spark, SF01, "documents")
    p = langid.languages(docs, _fold(3) == 1).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (p.lang == p.lang_pred).mean() > 0.97 and p.score.between(0, 1).all()


def test_language_does_not_read_held_out_rows(spark):
    docs = table(spark, SF01, "documents")
    other = docs.withColumn("lang", F.when(_fold(3) == 1, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("z"))
    a, b = ({r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.languages(d, _fold(3) == 1).collect()}
            for d in (docs, other))
    assert a == b


def test_language_of_odd_rows(spark):
    out = {r["doc_id"]: r for r in langid.languages(edges(spark), _fold(3) == 1).collect()}
    assert len(out) == len({r[0] for r in edge_rows()})
    for i in (1, 2, 3, 19, 20, 23):
        assert out[i]["lang_pred"] == "und" and out[i]["score"] == 0 and out[i]["spans"] == []
    nothing = langid.languages(edges(spark).withColumn("lang", F.lit(None).cast("string")), F.lit(False)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and len(nothing) == len(edge_rows())
    assert langid.languages(documents(spark, []), F.lit(False)).count() == 0


def test_spans_of_mixed_text(spark):
    docs = table(spark, SF01, "documents")
    model = langid.learn(docs.where("lang is not null"))
    en = docs.where("lang = 'en' and length(text) > 400").orderBy("doc_id").first()["text"][:300]
    de = docs.where("lang = 'de' and length(text) > 400").orderBy("doc_id").first()["text"][:200]
    spans = langid.label_spans(documents(spark, [(1, en + "\n" + de)]), model).first()["spans"]
    assert [s["lang"] for s in spans] == ["en", "de"] and abs(spans[1]["start"] - 301) < 40


def test_scripts_narrow_the_languages(spark):
    rows = [(i, "the cat and the dog run " * 3, "en") for i in range(4)] + [(9, "кот и собака бегут " * 3, "ru")]
    out = {r["doc_id"]: r["lang_pred"] for r in langid.label_spans(
        documents(spark, [(1, "собака"), (2, "zzz"), (3, "the кот и собака")]), langid.learn(documents(spark, rows))).collect()}
    assert out == {1: "ru", 2: "en", 3: "ru"}


def test_viterbi_equals_all_labellings():
    rng = np.random.default_rng(6)
    counts = np.array([4, 0, 6, 1])
    scores = rng.standard_normal((11, 3))
    got = langid.viterbi(scores, counts, 0.7)
    at = 0
    for n in counts:
        s = scores[at:at + n]
        best = max(itertools.product(range(3), repeat=int(n)), key=lambda p: sum(s[i, x] for i, x in enumerate(p))
                   - 0.7 * sum(a != b for a, b in zip(p, p[1:])))
        assert got[at:at + n].tolist() == list(best)
        at += n


# ---------------------------------------------------------------- urls
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow")]
PAGES = "page_id long, url string, html string, host string, rule string, trust string"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], PAGES)


def test_rules_and_parts(spark):
    rows = [(1, "http://A.Example.COM/en/x?q#f", None), (2, "https://www.example.com/en/a", ""), (3, "ftp://other.com", ""),
            (4, "//example.com/en/", ""), (5, None, None), (6, "x://notexample.com/en/", ""), (7, "http://com/", ""),
            (8, "http://h.org?a://b.com/en/", ""), (8, "http://h.org?a://b.com/en/", "")]
    out = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in
           urls.url_verdicts(_pages(spark, rows), RULES).orderBy("page_id").collect()]
    assert out == [(1, "a.example.com", "/en/x", "example.com/en/", "block"),
                   (2, "www.example.com", "/en/a", "www.example.com/en/", "allow"), (3, "other.com", "", None, "allow"),
                   (4, "", "", None, "allow"), (5, "", "", None, "allow"), (6, "notexample.com", "/en/", "com/", "allow"),
                   (7, "com", "/", "com/", "allow"), (8, "h.org", "", None, "allow"), (8, "h.org", "", None, "allow")]
    assert urls.url_verdicts(_pages(spark, []), RULES).count() == 0


def test_distrust_runs_against_links_and_trust_along(spark):
    link = lambda *h: " ".join(f'<a href="http://{x}/">' for x in h)
    rows = [(1, "http://bad.com/en/", ""), (2, "http://farm.org/", link("bad.com") * 3), (3, "http://good.net/", link("friend.org")),
            (4, "http://friend.org/", link("friend2.org")), (5, "http://friend2.org/", "")]
    rows += [(10 + i, f"http://plain{i}.org/", "") for i in range(9)]  # raise nobody's share
    rows += [(30 + i, f"http://plain{i}.org/a", link(f"plain{(i + 1) % 9}.org")) for i in range(9)]
    rules = [("bad.com", "/", "block"), ("good.net", "/", "allow")]
    out = {r["page_id"]: r for r in urls.url_verdicts(_pages(spark, rows), rules).collect()}
    assert out[2]["verdict"] == "block" and out[4]["verdict"] == "allow" and out[5]["trust"] > 0


def test_rank_equals_dense_power_iteration(spark):
    pages = table(spark, SF, "pages").select("page_id", urls.host_of(F.col("url")).alias("host"),
                                             urls.path_of(F.col("url")).alias("path"), "html")
    pages = pages.withColumn("fit", urls.best_rule(RULES))
    got = {r["host"]: (r["trust"], r["distrust"]) for r in urls.host_trust(pages).collect()}
    edges_ = urls.host_edges(pages).collect()
    names = sorted({x for r in edges_ for x in (r["a"], r["b"])})
    m = np.zeros((len(names), len(names)))
    for r in edges_:
        m[names.index(r["a"]), names.index(r["b"])] = r["n"]
    for j, (kind, step) in enumerate((("allow", m), ("block", m.T))):
        step = step / np.maximum(step.sum(axis=1, keepdims=True), 1e-300)
        seed = np.zeros(len(names))
        for r in pages.where(F.col("fit.verdict") == kind).collect():
            seed[names.index(r["host"])] += 1
        seed /= max(seed.sum(), 1)
        x = seed
        for _ in range(12):
            x = 0.15 * seed + 0.85 * step.T @ x
        assert all(abs(got.get(n, (0, 0))[j] - v) < 1e-12 for n, v in zip(names, x))


# ---------------------------------------------------------------- licences
def test_license_rules_take_the_longest_sequence(spark):
    s = licenses.SENTENCES
    bsd2 = "\n".join([s["bsd_use"], "1. " + s["bsd_source"], "2. " + s["bsd_binary"]])
    wrapped = s["mit_grant"].replace(" and associated", "\n * and associated").replace(" publish,", "\n * publish,")
    rows = [(1, bsd2), (2, bsd2 + "\n3. " + s["bsd_names"] + "\nmore text"), (3, wrapped + "\n\n" + s["mit_notice"]),
            (4, "text. " + s["gnu_hope"] + " and more"), (5, "prose\n" + s["gnu_hope"]),
            (6, "a. Licensed under CC BY-NC 4.0.\nb\nReleased under the MIT License. Released under the MIT License."),
            (7, "// SPDX-License-Identifier: Apache-2.0\ncode"), (8, s["bsd_source"] + " " + s["bsd_use"])]
    out = {r["doc_id"]: (r["licenses"], r["unmatched"], r["verdict"]) for r in
           licenses.license_scan(documents(spark, rows)).collect()}
    assert out == {1: ("BSD-2-Clause", "", "licensed"), 2: ("BSD-3-Clause", "", "licensed"), 3: ("MIT", "", "licensed"),
                   4: ("", "gnu_hope", "unknown"), 5: ("", "gnu_hope", "unknown"), 6: ("MIT,CC-BY-NC-4.0", "", "licensed"),
                   7: ("Apache-2.0", "", "licensed"), 8: ("", "bsd_source,bsd_use", "unknown")}


def test_license_scan_of_odd_rows(spark):
    out = licenses.license_scan(edges(spark)).collect()
    assert len(out) == len(edge_rows()) and {r["verdict"] for r in out} == {"none"}
    assert licenses.license_scan(documents(spark, [])).count() == 0


def test_license_rules_do_not_reach_across_what_was_used(spark):
    s = licenses.SENTENCES
    named = s["bsd_names"].replace("the copyright holder", "Acme Corp")
    rows = [(1, "\n".join([s["bsd_use"], s["apache2_use"], s["bsd_source"], s["bsd_binary"]])),
            (2, "\n".join([s["bsd_use"], s["bsd_source"], s["bsd_binary"], named]))]
    out = {r["doc_id"]: (r["licenses"], r["unmatched"]) for r in licenses.license_scan(documents(spark, rows)).collect()}
    assert out == {1: ("Apache-2.0", "bsd_use,bsd_source,bsd_binary"), 2: ("BSD-3-Clause", "")}
