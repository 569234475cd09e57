"""Mended operators: ledgers, schema errors, AUC, seeds, cuts, blocks, ensembles, stages."""
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom import config
from riskloom.operators import metrics as M
from riskloom.operators import resample as R
from riskloom.operators import threshold as J
from riskloom.operators.cuts import GRID
from riskloom.plans import chosen, models, oof, search
from riskloom.sources import schema, sink

DEV, EVAL = "ID % 5 <> 4", "ID % 5 = 4"


@pytest.fixture(scope="module")
def split(panel):
    from riskloom.session import cut_lineage
    return cut_lineage(panel.where(DEV)), cut_lineage(panel.where(EVAL))


# ------------------------------------------------------------------ sinks and sources
def _sub(spark, ids, value=1):
    return spark.createDataFrame([(i, value) for i in ids], "Id long, Predicted int")


def test_unreadable_ledger_raises_and_overwrites_nothing(spark, tmp_path):
    ids = spark.createDataFrame([(1,), (2,)], "ID long")
    root = str(tmp_path / "subs")
    assert [sink.emit_submission(spark, _sub(spark, [1, 2]), ids, root, "a") for _ in range(2)] == [1, 2]
    before = sorted(r["Predicted"] for r in sink.read_submission(spark, f"{root}/submission_001").collect())
    ledger = [f for f in os.listdir(f"{root}/ledger") if f.endswith(".parquet")]
    for f in os.listdir(f"{root}/ledger"):
        if f.endswith(".crc"):
            os.remove(f"{root}/ledger/{f}")
    with open(f"{root}/ledger/{ledger[0]}", "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        sink.emit_submission(spark, _sub(spark, [1, 2], 0), ids, root, "b")
    after = sorted(r["Predicted"] for r in sink.read_submission(spark, f"{root}/submission_001").collect())
    assert before == after and not os.path.exists(f"{root}/submission_003")


def test_submission_with_a_missing_prediction_raises(spark, tmp_path):
    with pytest.raises(ValueError):
        sink.write_submission(_sub(spark, [1]).union(_sub(spark, [2], None)), str(tmp_path / "s"))


def test_csv_cells_are_checked(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("ID,PAY_0,sex,LIMIT_BAL,note\n1,2.0,2,100.5,x\n2,,nan,,y\n")
    bad.write_text("ID,PAY_0\n1,2.5\n")
    rows = schema.load_table(spark, str(good)).orderBy("ID").collect()
    assert (rows[0]["PAY_0"], rows[0]["sex"], rows[1]["PAY_0"], rows[1]["sex"]) == (2, 2, None, None)
    with pytest.raises(Exception, match="PAY_0: 2.5"):
        schema.load_table(spark, str(bad)).collect()
    with pytest.raises(FileNotFoundError):
        schema.load_table(spark, str(tmp_path / "none.csv"))


# ------------------------------------------------------------------ metrics
def test_auc_of_groups_with_one_class_and_of_many_rows(spark):
    rows = [("a", 0.1, 1), ("a", 0.2, 1), ("b", 0.3, 0), ("c", 0.1, 0), ("c", 0.9, 1), ("c", 0.9, 0)]
    got = {r["g"]: r["roc_auc"] for r in M.roc_auc(spark.createDataFrame(rows, "g string, proba double, label int"),
                                                   ["g"]).collect()}
    assert got["a"] is None and got["b"] is None and got["c"] == 0.75
    rng = np.random.default_rng(0)
    s, y = np.round(rng.random(400), 2), rng.integers(0, 2, 400)
    brute = np.mean([(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]])
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "proba double, label int")
    for per in (7, 10_000):
        assert M.roc_auc(df, per_bucket=per).first()["roc_auc"] == pytest.approx(brute, abs=1e-12)


def test_missing_values_are_not_counted(spark):
    df = spark.createDataFrame([(1,), (None,), (1,)], "PAY_0 int")
    assert [(r["PAY_0"], r["n"]) for r in M.count_plot(df).collect()] == [(1, 2)]
    assert [r["n"] for r in M.value_counts(df, ["PAY_0"]).collect()] == [2]


# ------------------------------------------------------------------ learners
def test_fold_seed_leaves_the_learner_seed(monkeypatch, split):
    seen = []

    def spy(name, groups=(), seed=config.SEED, overrides=None, **stages):
        seen.append(seed)
        return models.make_pipeline("dummy", seed=seed)

    monkeypatch.setattr(oof, "pipeline_for", spy)
    for seed in (1, 2):
        oof.oof_proba("hgb", split[0], seed)
    assert set(seen) == {config.SEED}


def test_early_stopping_is_the_callers_choice():
    assert models.effective_params("hgb", {})["held_out"] == 0
    assert models.effective_params("hgb", {"early_stopping": True, "validation_fraction": 0.2})["held_out"] == 0.2
    assert models.effective_params("rf", {"max_depth": 32})["depth"] == 32
    assert models.effective_params("rf", {})["depth"] == models.MAX_DEPTH


def test_specs_with_equal_effect_are_drawn_once():
    specs = search.draw_specs("rf", 60, seed=1)
    effects = [str(models.effective_params("rf", s)) for s in specs]
    assert len(specs) == 60 == len(set(effects))
    assert all("max_depth" not in s or s["max_depth"] in (10, 16, 24, 32) for s in specs)


def test_score_range_cut_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i % 3), float(np.round(rng.random(), 3)), int(rng.random() < 0.4)) for i in range(300)]
    cut, f1 = chosen.score_range_cut(spark.createDataFrame(rows, "fold int, proba double, label int"), 40)
    x = np.array(rows)
    cuts = np.linspace(x[:, 1].min(), x[:, 1].max(), 40)

    def macro(r, c):
        h, y = r[:, 1] >= c, r[:, 2] == 1
        one = lambda a, b, d: 0.0 if 2 * a + b + d == 0 else 2 * a / (2 * a + b + d)
        tp, fp, fn, tn = (h & y).sum(), (h & ~y).sum(), (~h & y).sum(), (~h & ~y).sum()
        return (one(tp, fp, fn) + one(tn, fn, fp)) / 2

    means = [np.mean([macro(x[x[:, 0] == f], c) for f in range(3)]) for c in cuts]
    assert f1 == pytest.approx(max(means)) and cut == pytest.approx(cuts[int(np.argmax(means))])


def test_soft_vote_scores_one_scan_without_joins(split):
    dev, ev = split
    vote = chosen.SoftVote(["dummy", "logreg_clean"]).fit(dev)
    out = vote.score(ev)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    a, b = (models.pipeline_for(n).fit(dev).score(ev).withColumnRenamed("proba", n) for n in vote.members)
    want = {r["ID"]: (r["dummy"] + r["logreg_clean"]) / 2 for r in a.join(b, "ID").collect()}
    got = {r["ID"]: r["proba"] for r in out.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got)


def test_stacking_scores_each_id_once(split):
    from riskloom.plans.stacking import Stacking
    dev, ev = split
    for passthrough in (False, True):
        s = Stacking(["dummy", "logreg_clean"], passthrough=passthrough).fit(dev).score(ev)
        assert "Join" not in s._jdf.queryExecution().executedPlan().toString()
        rows = s.collect()
        assert len(rows) == len({r["ID"] for r in rows}) == ev.count()
        assert all(0 <= r["proba"] <= 1 for r in rows)


def test_stacks_share_their_members(split, monkeypatch):
    """A member that two stacks name is fitted once for each fold and once for the refit, and
    each stack scores as if it were alone."""
    from riskloom.plans import stacking
    dev, ev = split
    alone = [stacking.Stacking(m, meta).fit(dev).score(ev).collect() for m, meta in ((["dummy"], "logreg_balanced"),)]
    jobs = []
    monkeypatch.setattr(stacking, "fit_together", lambda todo, fit=stacking.fit_together: jobs.extend(todo) or fit(todo))
    both = stacking.fit_stacks([stacking.Stacking(["dummy"], "logreg_balanced"), stacking.Stacking(["dummy"])], dev)
    assert len(jobs) == stacking.config.N_SPLITS + 1
    for stack, want in zip(both[:1], alone):
        got = {r["ID"]: r["proba"] for r in stack.score(ev).collect()}
        assert got.keys() == {r["ID"] for r in want} and all(abs(got[r["ID"]] - r["proba"]) < 1e-9 for r in want)


@pytest.mark.parametrize("method", ["sigmoid", "isotonic"])
def test_calibration_is_monotone(spark, method):
    from riskloom.plans.calibrate import CALIBRATORS
    rng = np.random.default_rng(2)
    p = rng.random(300)
    df = spark.createDataFrame([(float(a), int(rng.random() < a)) for a in p], "proba double, label int")
    out = CALIBRATORS[method]().fit(df).transform(df).orderBy("proba").collect()
    cal = [r["proba_cal"] for r in out]
    assert all(a <= b + 1e-12 for a, b in zip(cal, cal[1:])) and all(0 <= c <= 1 for c in cal)


def test_quantile_windows_are_narrowed(spark, monkeypatch):
    from riskloom.operators import stats
    rng = np.random.default_rng(8)
    x = rng.standard_normal(3000)
    df = spark.createDataFrame([(float(v), float(np.round(v))) for v in x], "a double, b double")
    monkeypatch.setattr(stats, "IN_WINDOW", 20)
    monkeypatch.setattr(stats, "ACCURACY", 50)
    got = stats.exact_quantiles(df, ["a", "b"], [0.0, 1 / 3, 0.5, 1.0], accuracy=50)
    assert got["a"] == pytest.approx(np.quantile(x, [0, 1 / 3, 0.5, 1]).tolist(), abs=1e-12)
    assert got["b"] == pytest.approx(np.quantile(np.round(x), [0, 1 / 3, 0.5, 1]).tolist(), abs=1e-12)


# ------------------------------------------------------------------ segments
def test_segment_cuts_by_definition():
    """Against a scan of every cut of every segment, one by one."""
    rng = np.random.default_rng(5)
    for _ in range(20):
        cells = {s: [(int(rng.integers(0, 182)), int(rng.integers(0, 40)), int(rng.integers(0, 40))) for _ in range(12)]
                 for s in "abc"}
        at = int(rng.integers(0, 181))
        start = {s: np.sum([(p, q) for b, p, q in cells[s] if b > at] or [(0, 0)], axis=0) for s in cells}
        total = np.sum([x[1:] for v in cells.values() for x in v], axis=0)

        def score(hits):
            tp, fp = sum(h[0] for h in hits.values()), sum(h[1] for h in hits.values())
            return float(J._f1(tp, fp, total[0] - tp, total[1] - fp))

        hits, cut = dict(start), {s: GRID[at] for s in cells}
        best = score(hits)
        for _ in range(config.SEGMENT_MAX_PASSES):
            moved = False
            for s in sorted(cells):
                keep = (hits[s], cut[s])
                for i, t in enumerate(GRID):
                    own = np.sum([(p, q) for b, p, q in cells[s] if b > i] or [(0, 0)], axis=0)
                    f = score({**hits, s: own})
                    if f > best + config.IMPROVE_EPS:
                        best, keep = f, (own, t)
                moved |= keep[1] != cut[s]
                hits[s], cut[s] = keep
            if not moved:
                break
        assert J.segment_cuts(cells, start, GRID[at], min_support=0) == cut


# ------------------------------------------------------------------ neighbours and stages
def test_knn_skips_far_blocks_and_splits_crowded_ones(spark):
    from riskloom.operators import knn as K
    rng = np.random.default_rng(7)
    x = np.concatenate([c + rng.random((60, 2)) for c in ((0, 0), (100, 0), (0, 100))] + [np.full((60, 2), 50.0)])
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "ID long, features array<double>")
    sent = []
    plain = K._reachable
    K._reachable = lambda *a: sent.append(plain(*a).count()) or plain(*a)
    try:
        got = {(r["qid"], r["rank"]): r["nid"] for r in K.knn(df, df, 3, rows_per_block=20).collect()}
    finally:
        K._reachable = plain
    assert sent[0] < 0.6 * len(x) * 12
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(1)
        want = sorted((d[j], j) for j in range(len(x)) if j != i)[:3]
        assert [got[i, r] for r in (1, 2, 3)] == [j for _, j in want]


def test_synthetic_ids_are_unique(spark):
    rows = [(i, int(i < 2), [float(i), float(i % 3)]) for i in range(40)]
    out = R.smote(spark.createDataFrame(rows, "ID long, label int, features array<double>"), 3)
    ids = [r["ID"] for r in out.collect()]
    assert len(ids) == len(set(ids)) == 76


def test_sampler_stage_never_sees_scored_rows(spark, split, monkeypatch):
    dev, ev = split
    seen = []
    monkeypatch.setitem(R.SAMPLERS, "undersample", lambda d, seed: seen.append(
        {r["ID"] for r in d.select("ID").collect()}) or R.undersample(d, seed))
    pipe = models.pipeline_for("logreg_clean", sampler="undersample").fit(dev)
    scored = {r["ID"] for r in pipe.score(ev).collect()}
    assert seen and not scored & seen[0] and len(scored) == ev.count()


def test_anomaly_and_target_stages(split):
    dev, ev = split
    for stage in ({"anomaly": {"n_trees": 10, "max_samples": 32}}, {"target": True}):
        out = models.pipeline_for("logreg_clean", **stage).fit(dev).score(ev).collect()
        assert len(out) == ev.count() and all(0 <= r["proba"] <= 1 for r in out)


def test_target_encoder_codes_new_rows_like_the_operator(split):
    from riskloom.operators.target import TargetEncoder, target_encode
    dev, ev = split
    enc = TargetEncoder()
    enc.fit_transform(dev)
    _, want = target_encode(dev, ev)
    cols = list(config.CATEGORICAL)
    have = {r["ID"]: [r[c] for c in cols] for r in enc.transform(ev).select("ID", *cols).collect()}
    for r in want.collect():
        assert have[r["ID"]] == pytest.approx([r[c] for c in cols], abs=1e-9)


def test_search_validates_and_emits(spark, split, tmp_path):
    dev, ev = split
    specs = [{"n_estimators": 3, "max_depth": d, "class_weight": "balanced"} for d in (2, 4)]
    out = search.search_and_emit("rf", dev, ev, str(tmp_path / "s"), anchor="dummy", specs=specs, n_top=2, n_emit=1,
                                 seeds=(1, 2)).collect()
    assert sorted(r["spec_id"] for r in out) == [0, 1] and [r["submission"] for r in out].count(1) == 1
    assert out[0]["macro_f1"] >= out[1]["macro_f1"] and all(0 <= r["wins"] <= 2 for r in out)
    assert os.path.exists(tmp_path / "s" / "submission_001")


def test_off_local_sessions_need_a_shared_folder(spark, monkeypatch):
    from riskloom import session

    class Off:
        sparkContext = type("C", (), {"master": "yarn", "_jsc": type("J", (), {"sc": lambda self: type(
            "S", (), {"getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})()})()})()
        conf = type("F", (), {"get": lambda self, *a: None})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Off())
