"""Tree learners: splits against brute force, one task against a distributed table, draws."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom import config
from riskloom.operators import trees as T
from riskloom.plans.models import tree_spec


def _data(n=400, f=5, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, f)) * 3)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) > 2).astype(np.int64)
    return x, y, rng.permutation(10 * n)[:n].astype(np.int64)


def _best_cut(x, value, least):
    """Best (score, feature, cut) by trying every cut of every feature."""
    best = (-np.inf, None, None)
    for j in range(x.shape[1]):
        v = np.unique(x[:, j])
        for cut in (v[1:] + v[:-1]) / 2:
            left = x[:, j] <= cut
            if min(left.sum(), (~left).sum()) >= least:
                score = value(left) + value(~left)
                if score > best[0] + 1e-9 * abs(score):
                    best = (score, j, cut)
    return best


def test_forest_root_equals_the_best_gini_cut():
    x, y, ids = _data()
    model = T.fit_arrays(x, y, ids, T.Spec("forest", trees=1, depth=1, leaf_rows=7, bootstrap=False), 3)
    feature, cut, *_, value = model.trees[0]

    def purity(rows):
        p = y[rows].mean()
        return rows.sum() * (p * p + (1 - p) * (1 - p))
    _, j, at = _best_cut(x, purity, 7)
    assert (feature[0], cut[0]) == (j, at)
    assert abs(value[1] - y[x[:, j] <= at].mean()) < 1e-12 and abs(value[2] - y[x[:, j] > at].mean()) < 1e-12


@pytest.mark.parametrize("l2", [0.0, 5.0])
def test_boosting_grows_the_leaf_of_largest_gain(l2):
    x, y, ids = _data(300, 4, 1)
    spec = T.Spec("boost", trees=1, leaves=4, leaf_rows=5, l2=l2, impurity="newton", step=1.0, leaf_hessian=0.0)
    feature, cut, left, right, value = T.fit_arrays(x, y, ids, spec, 3).trees[0]
    p = y.mean()
    g, h = p - y, np.full(len(y), p * (1 - p))

    def score(rows):
        return g[rows].sum() ** 2 / (h[rows].sum() + l2)
    leaves = {0: np.ones(len(y), bool)}
    for _ in range(3):
        options = []
        for node, rows in leaves.items():
            at = np.flatnonzero(rows)
            s, j, c = _best_cut(x[rows], lambda m, at=at: score(at[m]), 5)
            if j is not None:
                options.append((s - score(rows), node, j, c))
        gain, node, j, c = max(options)
        assert (feature[node], cut[node]) == (j, c) and gain > 0
        rows = leaves.pop(node)
        leaves[left[node]], leaves[right[node]] = rows & (x[:, j] <= c), rows & (x[:, j] > c)
    for node, rows in leaves.items():
        assert feature[node] == -1 and abs(value[node] + g[rows].sum() / (h[rows].sum() + l2)) < 1e-4


def _same(a, b):
    assert len(a.trees) == len(b.trees) and abs(a.start - b.start) < 1e-12
    for s, t in zip(a.trees, b.trees):
        for u, v in zip(s, t):
            assert np.allclose(u, v, equal_nan=True)


SPECS = {
    "forest": T.Spec("forest", trees=3, depth=4, leaf_rows=4, node_features="sqrt", weights="balanced_subsample", bins=64),
    "extra": T.Spec("extra", trees=2, depth=3, leaf_rows=4, node_features=0.6, bootstrap=False, weights=(1.0, 2.0)),
    "boost": T.Spec("boost", trees=3, leaves=5, leaf_rows=5, l2=1.0, impurity="newton", rows=0.8, node_features=0.7, weights="balanced"),
    "oblivious": T.Spec("oblivious", trees=2, depth=2, l2=3.0, impurity="newton", leaf_hessian=0.0),
}


@pytest.mark.parametrize("kind", list(SPECS))
def test_a_distributed_table_gives_the_same_trees(spark, kind, monkeypatch):
    monkeypatch.setattr(T, "REFRESH", 2)
    x, y, ids = _data(240, 4, 2)
    rows = spark.createDataFrame([(int(i), int(k), r.tolist()) for i, k, r in zip(ids, y, x)], "ID long, label int, features array<double>")
    rows = rows.repartition(3)
    here, = T.fit_many([(rows, SPECS[kind], 5)])
    there, = T.fit_many([(rows, SPECS[kind], 5)], local_cells=1)
    _same(here, T.fit_arrays(x, y, ids, SPECS[kind], 5))
    _same(here, there)


def test_fits_of_many_specs_and_frames(spark):
    x, y, ids = _data(200, 3, 3)
    make = lambda k: spark.createDataFrame([(int(i), int(v), r.tolist()) for i, v, r in zip(ids[:k], y[:k], x[:k])],
                                           "ID long, label int, features array<double>")
    a, b = make(200), make(120)
    many = T.Spec("forest", trees=T.TREES_PER_TASK + 5, depth=3, node_features=2)
    got = T.fit_many([(a, many, 1), (b, SPECS["boost"], 2), (a, SPECS["extra"], 3), (b, many, 4)])
    for model, (n, spec, seed) in zip(got, [(200, many, 1), (120, SPECS["boost"], 2), (200, SPECS["extra"], 3), (120, many, 4)]):
        _same(model, T.fit_arrays(x[:n], y[:n], ids[:n], spec, seed))
    scored = T.add_proba(a, got[0]).select("ID", "proba").collect()
    want = dict(zip(ids.tolist(), got[0].proba(x)))
    assert all(abs(want[r["ID"]] - r["proba"]) < 1e-12 for r in scored) and len(scored) == 200
    with pytest.raises(ValueError):
        T.fit_many([(a.limit(0), many, 1)])


@pytest.mark.parametrize("kind", list(SPECS))
def test_draws_do_not_depend_on_the_order_of_rows(kind):
    x, y, ids = _data(300, 4, 4)
    shuffled = np.random.default_rng(9).permutation(300)
    _same(T.fit_arrays(x, y, ids, SPECS[kind], 5), T.fit_arrays(x[shuffled], y[shuffled], ids[shuffled], SPECS[kind], 5))


def test_bootstrap_weights_balance_every_tree():
    x, y, ids = _data(500, 4, 5)
    sub, whole = (T.Spec("forest", trees=4, depth=6, weights=w) for w in ("balanced_subsample", "balanced"))
    totals = {}
    for spec in (sub, whole):
        edges = T.bin_edges(x, spec.bins)
        bins = T.binned(x, edges)
        grown = T.forest_trees(bins, y, ids, T._values(edges, max(map(len, edges)) + 1), spec, 1, range(4), (500.0 - y.sum(), float(y.sum())))
        totals[spec.weights] = [t.stats[0] for t in grown]
    assert all(abs(a - b) / a < 1e-3 for _, a, b in totals["balanced_subsample"])
    assert any(abs(a - b) / a > 1e-3 for _, a, b in totals["balanced"])
    counts = T.bootstrap(sub, 1, 0, np.arange(200_000))
    assert abs(counts.mean() - 1) < 0.01 and abs(counts.var() - 1) < 0.02


def test_random_cuts_differ_from_best_cuts():
    x, y, ids = _data(400, 4, 6)
    best, drawn = (T.fit_arrays(x, y, ids, T.Spec(k, trees=5, depth=3, bootstrap=False), 1) for k in ("forest", "extra"))
    assert len({t[1][0] for t in best.trees}) == 1 < len({(t[0][0], t[1][0]) for t in drawn.trees})


def test_oblivious_levels_share_a_split_and_prefixes_leave_the_row_out():
    x, y, ids = _data(400, 4, 7)
    model = T.fit_arrays(x, y, ids, T.Spec("oblivious", trees=3, depth=3, l2=3.0, impurity="newton", leaf_hessian=0.0), 1)
    for feature, cut, *_ in model.trees:
        for lo, hi in ((1, 3), (3, 7)):
            assert len(set(feature[lo:hi])) == 1 == len(set(cut[lo:hi]))
    sums = np.zeros((1, T.BLOCKS, 2))
    sums[0, 3] = 7 * T.SCALE, 5 * T.SCALE
    value = T.prefix_values(sums, T.Spec("oblivious", l2=1.0, step=1.0))[0]
    assert np.allclose(value[:3], -7 / 6) and np.allclose(value[3:], 0)  # only rows of larger blocks see block 3
    share = np.bincount(T.ordered_block(1, np.arange(100_000)), minlength=T.BLOCKS) / 100_000
    assert abs(share[0] - 0.5) < 0.01 and abs(share[1] - 0.25) < 0.01


def test_parameters_reach_the_learner():
    x, y, ids = _data(800, 5, 8)
    fit = lambda kind, **p: T.fit_arrays(x, y, ids, tree_spec(kind, {"max_iter": 5, **p}), 1).proba(x)
    base = fit("hgb")
    for change in ({"max_leaf_nodes": 4}, {"l2_regularization": 10.0}, {"max_features": 0.5}, {"class_weight": {0: 1.0, 1: 3.0}}):
        assert not np.allclose(base, fit("hgb", **change)), change
    lgbm = tree_spec("lgbm", config.BOOSTING_CONFIGS["lgbm_deep_balanced"]["params"])
    assert (lgbm.trees, lgbm.leaves, lgbm.leaf_rows, lgbm.rows, lgbm.tree_features, lgbm.l2) == (600, 63, 80, 0.8, 0.7, 2.0)
    cat = {n: tree_spec("catboost", config.BOOSTING_CONFIGS[n]["params"]) for n in ("cb_default", "cb_reg", "cb_deep")}
    assert {n: (s.kind, s.trees, s.depth, s.step, s.l2, s.weights) for n, s in cat.items()} == {
        "cb_default": ("oblivious", 500, 6, 0.1, 3.0, "balanced"), "cb_reg": ("oblivious", 800, 4, 0.03, 6.0, "balanced"),
        "cb_deep": ("oblivious", 600, 8, 0.1, 3.0, "balanced")}
    stop = T.fit_arrays(x, y, ids, tree_spec("hgb", {"max_iter": 200, "early_stopping": True, "learning_rate": 0.5}), 1)
    assert len(stop.trees) < 200


def test_missing_values_go_right():
    x, y, ids = _data(300, 3, 9)
    x[::3, 0] = np.nan
    model = T.fit_arrays(x, y, ids, T.Spec("forest", trees=3, depth=4), 1)
    assert np.isfinite(model.proba(x)).all()


@pytest.mark.parametrize("weight", [1, 1000])
def test_sums_by_chunk_are_those_of_whole_columns(weight):
    rng = np.random.default_rng(3)
    n = 3 * T.CHUNK + 77
    bins = np.asfortranarray(rng.integers(0, 60, (n, 4)).astype(np.uint8))
    bins[:, 1] %= 2
    bins[:, 2] = 0
    g, h = np.round(rng.normal(size=n) * T.SCALE) * weight, np.round(rng.random(n) * T.SCALE / 4) * weight
    for rows in (np.arange(n), np.arange(9, T.CHUNK + 9), np.flatnonzero(rng.random(n) < 0.3)):
        want = [[np.bincount(bins[rows, j], s, 64) for j in range(4)] for s in (None, g[rows], h[rows])]
        assert np.array_equal(T._sums_by_chunk(bins, rows, g, h, 64)[0], want)


def _table(n=700, seed=3):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.normal(size=(n, 4)).round(2), rng.integers(0, 2, (n, 2)), rng.integers(0, 9, (n, 2))].astype(float)
    y = (x[:, 0] + x[:, 6] / 4 + rng.normal(size=n) > 1).astype(np.int64)
    return x, y, np.arange(n) * 7 + 1


def _plain(model):
    return [[a.tolist() for a in t] for t in model.trees]


@pytest.mark.parametrize("spec", [
    T.Spec(trees=4, bins=64, node_features="sqrt", weights="balanced"), T.Spec(trees=3, bins=32, leaf_rows=5, node_features=0.5, impurity="entropy"),
    T.Spec("extra", trees=4, node_features="sqrt", bootstrap=False, weights="balanced_subsample")])
def test_forests_do_not_depend_on_how_entries_are_cut(spec, monkeypatch):
    """Pieces of one run, of a few entries, and (``LEVEL_BYTES``) of few nodes grow the same trees."""
    x, y, ids = _table()
    whole = _plain(T.fit_arrays(x, y, ids, spec, 5))
    monkeypatch.setattr(T, "PIECE", 40)
    assert _plain(T.fit_arrays(x, y, ids, spec, 5)) == whole
    monkeypatch.setattr(T, "LEVEL_BYTES", 1)
    assert _plain(T.fit_arrays(x, y, ids, spec, 5)) == whole


def test_sparse_splits_are_those_of_histograms():
    """One piece looks at filled bins only; ``best_splits`` at all bins."""
    rng = np.random.default_rng(1)
    m, k, width = 6, 3, 16
    spec = T.Spec(leaf_rows=2, split_rows=4)
    feats = np.sort(rng.permuted(np.tile(np.arange(8), (m, 1)), axis=1)[:, :k], axis=1)
    weights = np.round(np.array([[1.3, 0.7]] * m) * T.SCALE)
    pos = np.sort(rng.integers(0, m, 90))
    bins = rng.integers(0, width, (90, k))
    c, y = rng.integers(1, 4, 90), rng.integers(0, 2, 90)
    at = (pos[:, None] * k + np.arange(k)) * width + bins
    sums = np.bincount(at.ravel(), np.repeat(T._packed(c, y), k), m * k * width)
    hist = np.stack(T._unpacked(sums.reshape(m, k, width)), axis=1)
    hist[:, 1:] *= weights[:, :, None, None]
    got = T._sparse_splits(sums, feats, width, weights, spec)
    want = T.level_splits(np.arange(m), feats, hist, np.zeros((8, width)), spec, 0, 0)
    assert (got[0] > 0).any()
    for a, b in zip(got, want):
        assert np.array_equal(a[got[0] > 0], b[got[0] > 0])
    assert np.array_equal(got[0], want[0]) and np.array_equal(got[4], want[4])


@pytest.mark.parametrize("spec", [T.Spec("boost", trees=6, leaf_rows=5, impurity="newton", rows=0.7), T.Spec("boost", trees=6, leaves=4, depth=2, impurity="newton"),
                                  T.Spec("boost", trees=25, leaf_rows=5, held_out=0.2, step=0.5, impurity="newton")])
def test_leaves_known_from_growth_are_those_of_routing(spec, monkeypatch):
    x, y, ids = _table()
    known = _plain(T.fit_arrays(x, y, ids, spec, 5))
    grow = T.leafwise_tree

    def routed(bins, rows, g, h, width, spec, seed, number, leaf):
        tree = grow(bins, rows, g, h, width, spec, seed, number)
        leaf[:] = tree.route(bins)
        return tree
    monkeypatch.setattr(T, "leafwise_tree", routed)
    assert _plain(T.fit_arrays(x, y, ids, spec, 5)) == known


def test_oblivious_levels_from_siblings_are_those_of_all_rows(monkeypatch):
    """The smaller sibling is summed, the other is what its parent leaves; chunks add up."""
    x, y, ids = _table()
    edges = T.bin_edges(x, 16)
    bins = np.asfortranarray(T.binned(x, edges))
    rows = np.flatnonzero(ids % 5 > 0)
    raw, w = np.full(len(y), -0.3), np.ones(len(y))
    spec = T.Spec("oblivious", depth=5, leaf_hessian=0.0, l2=3.0, impurity="newton")
    path, leaf = T._grow_oblivious(bins, rows, raw, y, w, 16, spec)
    g, h = T._gradients(raw, y, w)
    want = []
    for _ in range(spec.depth):
        at = T._leaf_of(bins, want)
        hist = np.stack([T._whole_histogram(bins, rows[at[rows] == i], g, h, 16)[0] for i in range(1 << len(want))])
        gain, j, b = T.best_level(hist, spec)
        if gain <= 0:
            break
        want.append((j, b))
    assert path == want and len(path) > 2 and np.array_equal(leaf, T._leaf_of(bins, path))
    monkeypatch.setattr(T, "CHUNK", 50)
    assert T._grow_oblivious(bins, rows, raw, y, w, 2, T.Spec("oblivious", depth=0))[0] == []
    small = T._leaf_histograms(bins, rows, leaf, 1 << len(path), g, h, 16)
    monkeypatch.setattr(T, "CHUNK", 1 << 14)
    assert np.array_equal(small, T._leaf_histograms(bins, rows, leaf, 1 << len(path), g, h, 16))
