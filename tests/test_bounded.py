"""What is stored, held and sent follows rows, not pairs or trees."""
import os
import pickle

import numpy as np
import pytest

from riskloom.operators import knn as K
from riskloom.operators import trees as T
from riskloom.operators.knn import knn
from riskloom.session import ship
from tests.conftest import SF


def _shuffled_bytes(spark):
    """Bytes of the shuffle files in the local folders of a session in one process."""
    roots = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(os.path.join(d, f)) for root in roots for d, _, names in os.walk(root)
               for f in names if f.startswith("shuffle_"))


def test_knn_shuffles_rows_not_pairs_of_queries_and_blocks(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 30))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "ID long, features array<double>")
    df = df.repartition(4).cache()
    df.count()
    before = _shuffled_bytes(spark)
    got = {(r["qid"], r["rank"]): r["nid"] for r in knn(df, df, 3, rows_per_block=20).collect()}
    assert _shuffled_bytes(spark) - before < 8 * x.nbytes  # 45 blocks, hardly any out of reach
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1)[:, :3]
    assert got == {(i, r + 1): int(want[i, r]) for i in range(900) for r in range(3)}


def test_large_forests_stay_in_files_and_a_task_grows_few_trees_at_a_time(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 4))
    y = (x[:, 0] + rng.normal(size=2000) > 0).astype(np.int64)
    ids = np.arange(2000)
    rows = spark.createDataFrame([(int(i), int(k), r.tolist()) for i, k, r in zip(ids, y, x)], "ID long, label int, features array<double>")
    spec = T.Spec("forest", trees=60, node_features="sqrt", bins=64)
    want = T.fit_arrays(x, y, ids, spec, 5)
    model, = T.fit_many([(rows, spec, 5)])
    assert len(pickle.dumps(model)) < 10_000 < len(pickle.dumps(want))  # what the driver holds and every task is sent
    got = {r["ID"]: r["proba"] for r in T.add_proba(rows, model).select("ID", "proba").collect()}
    assert all(got[i] == p for i, p in zip(ids.tolist(), want.proba(x)))

    asked = []
    grow = T.forest_trees
    monkeypatch.setattr(T, "ENTRIES", 6000)
    monkeypatch.setattr(T, "forest_trees", lambda *a: asked.append(len(a[6])) or grow(*a))
    again = T.fit_arrays(x, y, ids, spec, 5)
    assert asked == [3] * 20
    assert all(np.array_equal(u, v) for s, t in zip(again.trees, want.trees) for u, v in zip(s, t))


def test_blocks_out_of_reach_are_not_read(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = rng.random((40, 2))
    near = tmp_path / "near"
    near.write_bytes(np.arange(40).tobytes() + x.tobytes())
    queries = spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(x)], "ID long, features array<double>, block int")
    units = [[(str(near), 40)], [(str(tmp_path / "absent"), 40)]]
    ship(spark)
    got = K._reachable(queries, np.array([[0.5, 0.5], [100.0, 100.0]]), np.array([1.0, 1.0]), units, 3, True).collect()
    assert len(got) == 120 and all(r["qid"] != r["nid"] for r in got)


@pytest.mark.parametrize("query", ["j9_segment_hist", "j9_segment_cuts", "j10_honest_transfer", "j11_segment_predictions"])
def test_segment_queries_derive_the_panel_once(spark, monkeypatch, query):
    from riskloom.plans import queries as Q
    from riskloom.sources import panel
    made, real = [], panel.credit_panel

    def counted(*args):
        made.append(args)
        return real(*args)
    monkeypatch.setattr(panel, "credit_panel", counted)
    getattr(Q, query)(spark, SF)
    assert len(made) == 1


@pytest.mark.parametrize("offset,spread", [(0, 1), (1e6, 1), (0, 1e5), (-3e8, 2e5), (0, 1e-9), (0, 1e20)])
def test_rough_distances_keep_to_their_slack(offset, spread):
    """What proposes neighbours is single precision; no true distance lies beyond its slack."""
    from riskloom.operators import knn as K
    rng = np.random.default_rng(4)
    t = offset + spread * rng.normal(size=(300, 12))
    q = np.r_[t[:40] * (1 + 1e-12), offset + spread * rng.normal(size=(60, 12))]
    exact = ((q[:, None] - t[None]) ** 2).sum(2)
    seen = 0
    for run, near, slack in K._rough(q, t):
        assert (np.abs(near - exact[run]) <= slack[:, None] / 2).all()
        seen += len(near)
    assert seen == len(q)


@pytest.mark.parametrize("tile", [1 << 18, 64])
def test_nearest_by_rough_tiles_are_the_exact_ones(tile, monkeypatch):
    """Near-equal distances, ties and own rows, met unit by unit in tiles of a few queries."""
    from riskloom.operators import knn as K
    monkeypatch.setattr(K, "TILE", tile)
    rng = np.random.default_rng(5)
    t = np.repeat(1e5 * rng.integers(0, 3, (60, 6)), 4, axis=0) + np.tile([0, 0, 1e-3, 2e-3], 60)[:, None]
    ids = np.arange(len(t)) * 3 + 1
    best = K._Best(t[:50], ids[:50], 5, True)
    for s in range(0, len(t), 70):
        best.meet(np.arange(50), ids[s:s + 70], t[s:s + 70])
    diff = (t[None] - t[:50, None]).reshape(-1, 6)
    exact = np.einsum("jk,jk->j", diff, diff).reshape(50, -1)
    exact[np.arange(50), np.arange(50)] = np.inf
    for r in range(50):
        own = best.row == r
        assert best.nid[own].tolist() == ids[np.lexsort((ids, exact[r]))[:5]].tolist()
