"""Neighbours from hash buckets, held against the exact join; ledgers of concurrent writers."""

import threading

import numpy as np

from riskloom.operators import lsh
from riskloom.operators.knn import knn
from riskloom.operators.resample import smote
from riskloom.sources import sink
from tests.conftest import SF

FEATURES = "ID long, features array<double>"


def _rows(spark, x, first=0):
    return spark.createDataFrame([(first + i, [float(v) for v in r]) for i, r in enumerate(x)], FEATURES)


def _lists(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["qid"], {})[r["rank"]] = (r["nid"], round(r["dist2"], 9))
    return out


def _exact(x, q, k, skip=True):
    d = ((q[:, None, :] - x[None, :, :]) ** 2).sum(2)
    return {i: [int(j) for j in np.lexsort((np.arange(len(x)), d[i])) if not (skip and i == j)][:k] for i in range(len(q))}


def test_recall_over_clusters_of_all_densities(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(900, 8)) * s + rng.normal(size=8) * 20 for s in (0.01, 0.3, 1, 8)])
    got = _lists(lsh.knn_lsh(_rows(spark, x), _rows(spark, x), 5, bucket_rows=64))
    want = _exact(x, x, 5)
    assert all(len(got[i]) == 5 for i in range(len(x)))
    hit = sum(len({n for n, _ in got[i].values()} & set(want[i])) for i in range(len(x)))
    assert hit >= 0.9 * 5 * len(x)
    for i in range(0, len(x), 97):
        for n, d in got[i].values():
            assert abs(d - ((x[i] - x[n]) ** 2).sum()) <= 1e-6


def test_buckets_stay_bounded_and_work_grows_with_the_rows(spark):
    rng = np.random.default_rng(4)
    met = []
    for n in (1000, 4000):
        x = _rows(spark, rng.normal(size=(n, 6)))
        cells = lsh._Cells(6, np.full(32, 2.0), 4, 0)
        units, split = lsh._buckets(lsh._target_cells(x, cells), 32, 50)
        sizes = {r["unit"]: r["count"] for r in units.groupBy("unit").count().collect()}
        assert max(sizes.values()) <= 50 and sum(sizes.values()) == 4 * n
        visits = lsh._visits(lsh._query_cells(x, cells, 4, 12), split)
        met.append(sum(sizes.get(r["unit"], 0) for r in visits.collect()) / n)
    assert met[1] <= 1.5 * met[0]


def test_copies_ties_and_what_no_function_splits(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([np.full((700, 3), 2.0), rng.integers(0, 3, size=(300, 3)).astype(float)])
    got = _lists(lsh.knn_lsh(_rows(spark, x), _rows(spark, x), 4, bucket_rows=8))
    want = _exact(x, x, 4)
    assert all([got[i][r][0] for r in (1, 2, 3, 4)] == want[i] for i in range(700))
    packed = lsh.knn_lsh(_rows(spark, x + 1e-12 * rng.random(x.shape)), _rows(spark, x), 4, False, functions=2, bucket_rows=8)
    assert all(len(v) == 4 for v in _lists(packed).values())


def test_small_empty_and_null_inputs(spark):
    few = _rows(spark, np.arange(6).reshape(3, 2))
    none = few.limit(0)
    assert {i: sorted(n for n, _ in v.values()) for i, v in _lists(lsh.knn_lsh(few, few, 5)).items()} == {
        0: [1, 2], 1: [0, 2], 2: [0, 1]}
    assert lsh.knn_lsh(none, few, 2).count() == 0 and lsh.knn_lsh(few, none, 2).count() == 0
    odd = few.union(spark.createDataFrame([(None, [1.0, 2.0]), (9, None)], FEATURES))
    assert _lists(lsh.knn_lsh(odd, odd, 1)) == _lists(lsh.knn_lsh(few, few, 1))


def test_partitioning_does_not_change_the_answer(spark):
    x = np.random.default_rng(6).normal(size=(600, 4))
    one = _lists(lsh.knn_lsh(_rows(spark, x).repartition(1), _rows(spark, x).repartition(3), 3, bucket_rows=32))
    two = _lists(lsh.knn_lsh(_rows(spark, x).repartition(7), _rows(spark, x).repartition(2), 3, bucket_rows=32))
    assert one == two


def test_samplers_take_either_search(spark):
    rng = np.random.default_rng(8)
    rows = [(i, int(i % 5 == 0), [float(v) for v in rng.normal(size=3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "ID long, label int, features array<double>")
    exact, near = (sorted((r["ID"], r["label"]) for r in smote(df, search=s).collect()) for s in (knn, lsh.knn_lsh))
    assert exact == near and len(exact) == 320


def test_recall_on_the_panel(spark):
    from riskloom.plans.queries import _resample_input
    x = _resample_input(spark, SF).select("ID", "features")
    exact = {(r["qid"], r["nid"]) for r in knn(x, x, 5).collect()}
    near = {(r["qid"], r["nid"]) for r in lsh.knn_lsh(x, x, 5, bucket_rows=32).collect()}
    assert len(exact & near) >= 0.9 * len(exact)


def test_two_writers_get_two_numbers_and_two_rows(spark, tmp_path):
    ids = spark.createDataFrame([(1,), (2,)], "ID long")
    sub = spark.createDataFrame([(1, 0), (2, 1)], "Id long, Predicted int")
    root, numbers, errors = str(tmp_path / "subs"), [], []

    def write():
        try:
            numbers.append(sink.emit_submission(spark, sub, ids, root, "at once"))
        except Exception as e:  # shown by the assertion below
            errors.append(e)
    writers = [threading.Thread(target=write) for _ in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert not errors and sorted(numbers) == [1, 2, 3, 4]
    assert sorted(r["n"] for r in spark.read.parquet(f"{root}/ledger").collect()) == [1, 2, 3, 4]
    assert sink.emit_submission(spark, sub, ids, root, "after") == 5


def test_meeting_stores_rows_not_pairs_of_queries_and_buckets(spark, monkeypatch):
    rng = np.random.default_rng(9)
    kept, real = [], lsh.cut_lineage

    def counted(df):
        out = real(df)
        kept.append(out.count())
        return out
    monkeypatch.setattr(lsh, "cut_lineage", counted)
    x = _rows(spark, rng.normal(size=(1500, 6)))
    assert lsh.knn_lsh(x, x, 5, bucket_rows=40).count() == 5 * 1500
    assert max(kept) <= (5 + 1) * 1500


def test_near_copies_far_from_the_origin_are_told_apart(spark):
    """Vectors whose squares dwarf their distances: the product only proposes."""
    rng = np.random.default_rng(10)
    x = np.repeat(rng.normal(size=(8, 4)) * 1e5, 60, axis=0) + rng.integers(0, 40, size=(480, 4))
    got, want = _lists(lsh.knn_lsh(_rows(spark, x), _rows(spark, x), 5)), _exact(x, x, 5)
    assert all([round(got[i][r][1], 6) for r in range(1, 6)] == [round(float(((x[i] - x[j]) ** 2).sum()), 6) for j in want[i]]
               for i in range(len(x)))


def test_a_repeated_id_keeps_its_vectors_apart(spark):
    q = spark.createDataFrame([(1, [0.0, 0.0]), (1, [10.0, 10.0])], FEATURES)
    t = spark.createDataFrame([(5, [0.0, 1.0]), (6, [10.0, 11.0])], FEATURES)
    assert sorted((r["nid"], r["dist2"]) for r in lsh.knn_lsh(q, t, 1, False, bucket_rows=1).collect()) == [(5, 1.0)]
    assert sorted((r["nid"], r["dist2"]) for r in lsh.knn_lsh(q, t, 2, False).collect()) == [(5, 1.0), (6, 1.0)]
