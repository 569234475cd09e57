"""Registered queries run over the whole of their registries."""
import json

import pytest
from pyspark.sql import functions as F

from riskloom import config
from riskloom.plans import queries as Q
from tests.conftest import SF


def test_every_feature_set_is_registered():
    have = [sorted(v) for k, v in Q.FAMILY_KEYS.items() if k.startswith("c11_")]
    assert sorted(have) == sorted(sorted(v) for v in config.FEATURE_CONFIGS.values())
    assert {k for k in Q.FAMILY_KEYS if k.startswith("c11_")} <= Q.registry().keys()


def _small(name, *args, **kw):
    """A linear learner in place of any named one."""
    from riskloom.plans.models import ModelPipeline
    spec = config.MODEL_CONFIGS["logreg_clean"]
    seen.append(name)
    return ModelPipeline("logreg", {"max_iter": 5}, [], dict(config.ENCODING_CONFIGS[spec["encoding"]]), 1)


seen: list = []


@pytest.fixture
def fast(monkeypatch):
    from riskloom.plans import models, oof, stacking
    seen.clear()
    for module in (models, oof, stacking):
        monkeypatch.setattr(module, "pipeline_for", _small)


def test_calibration_covers_scores_and_methods(spark, fast):
    r = Q.k8_k9_calibration(spark, SF).collect()
    assert {(x["model"], x["method"]) for x in r} == {
        (m, k) for m in ("A", "B", "C", "rf_balanced") for k in ("raw", "platt", "isotonic")}


def test_calibrated_cv_runs_both_methods(spark, fast):
    r = Q.k10_calibrated_cv(spark, SF)
    n = r.groupBy("model", "method").agg(F.count_distinct("ID").alias("ids"), F.count("proba").alias("n")).collect()
    assert {(x["model"], x["method"]) for x in n} == {
        (m, k) for m in ("logreg_clean", "rf_balanced") for k in ("sigmoid", "isotonic")}
    assert all(x["ids"] == x["n"] for x in n)


def test_family_ensemble_has_four_learners(spark, fast):
    Q.k5_family_ensemble(spark, SF)
    assert set(seen) == {"rf_balanced", "hgb", "logreg_clean", "et_balanced"}


def test_seed_average_has_both_halves(spark, panel):
    from riskloom.plans.stacking import seed_ensemble
    dev, ev = panel.where("ID % 5 != 4"), panel.where("ID % 5 = 4")
    a = seed_ensemble("rf", dev, ev, [42, 11], overrides={"n_estimators": 3, "max_depth": 3}).cache()
    n = {(r["half"], r["n_seeds"]): r["count"] for r in a.groupBy("half", "n_seeds").count().collect()}
    assert n == {(h, k): d.count() for h, d in (("oof", dev), ("eval", ev)) for k in (1, 2)}
    assert a.select("n_seeds", "threshold", "macro_f1").distinct().count() == 2
    assert len(config.AVERAGE_SEEDS) == 8


def _cheap_table(factories, dev_folds, seed=0, parallel=8):
    seen.extend(factories)
    return oof_union([dev_folds.select("ID", "label", "fold", F.lit(n).alias("model"), F.lit(seed).alias("seed"),
                                       (F.col("ID") % 97 / 97).alias("proba")) for n in factories])


def oof_union(parts):
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b), parts)


def test_screens_fit_every_preset(spark, monkeypatch):
    from riskloom.plans import oof
    monkeypatch.setattr(oof, "oof_table", _cheap_table)
    for key, registry in (("g4_g6_imbalance_screen", config.IMBALANCE_CONFIGS),
                          ("g8_boosting_screen", config.BOOSTING_CONFIGS)):
        seen.clear()
        r = Q.registry()[key](spark, SF).collect()
        assert {x["model"] for x in r} == set(registry) == set(seen)


def _cheap_cuts(kind, specs, folds, seed, groups):
    seen.extend((kind, repr(sorted(s.items(), key=str)), seed) for s in specs.values() if isinstance(s, dict))
    return {i: (0.4, (hash(repr(s)) % 1000) / 1000) for i, s in specs.items()}


def test_search_draws_validates_and_emits(spark, monkeypatch):
    from riskloom.plans import oof, search
    seen.clear()
    monkeypatch.setattr(search, "_cuts", _cheap_cuts)
    monkeypatch.setattr(oof, "with_folds", lambda dev, seed, **kw: dev)
    monkeypatch.setattr(oof, "fit_eval_proba", lambda name, dev, evl, *a, **kw: evl.select(
        "ID", (F.col("ID") % 97 / 97).alias("proba")))
    r = Q.h6_search(spark, SF).collect()
    for kind in ("rf", "hgb"):
        mine = [x for x in r if x["kind"] == kind]
        assert len(mine) == 6 and sum(x["submission"] is not None for x in mine) == 3
        drawn = {s for n, s, _ in seen if n == kind and s != "[]"}
        checks = [s for n, s, seed in seen if n == kind and s != "[]"]
        assert len(drawn) == 40 and len(checks) == 40 + 6 * len(config.VALIDATION_SEEDS)
    seen.clear()
    taken = []
    monkeypatch.setattr(search, "candidate_list", lambda candidates, *a, **kw: taken.extend(candidates) or [])
    Q.h9_candidates(spark, SF)
    best = {x["kind"]: json.loads(x["params"]) for x in reversed(r)}
    assert {c[0]: c[1] for c in taken[:2]} == best


def test_store_is_fitted_once_and_resumed(spark, panel, tmp_path, monkeypatch):
    from riskloom.plans import oof
    dev = panel.where("ID % 5 != 4")
    root = str(tmp_path / "store")
    fitted = []
    real = oof.fold_oof_many

    def spy(factories, folds, *args):
        fitted.append(len(factories))
        return real(factories, folds, *args)
    monkeypatch.setattr(oof, "fold_oof_many", spy)
    first = oof.build_oof_cache(["dummy"], dev, [42], root=root)
    both = oof.build_oof_cache(["dummy"], dev, [42, 7], root=root)
    again = oof.build_oof_cache(["dummy"], dev, [42, 7], root=root)
    assert fitted == [1, 1]
    assert first.count() == dev.count() and both.count() == 2 * dev.count()
    assert sorted(map(str, both.collect())) == sorted(map(str, again.collect()))
    assert oof.build_oof_cache(["dummy"], dev, [7], root=root).select("seed").distinct().collect()[0][0] == 7
