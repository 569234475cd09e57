"""Learners and OOF on the sf0.001 panel. Small forests (<= 20 trees, depth <= 8)
keep local-mode fits quick; the deployed 300-tree settings run in bench.py."""
from pyspark.sql import functions as F

from riskloom.plans import oof
from riskloom.plans.models import pipeline_for


def test_oof_each_id_once_and_deterministic(spark, panel):
    dev = panel.where("ID % 5 != 4")
    folds = oof.with_folds(dev, 42)
    ov = {"n_estimators": 10, "max_depth": 6}
    a = oof.oof_proba("rf_balanced", dev, 42, ["paysem"], overrides=ov, dev_folds=folds)
    b = oof.oof_proba("rf_balanced", dev, 42, ["paysem"], overrides=ov, dev_folds=folds)
    ra = {r["ID"]: r["proba"] for r in a.collect()}
    rb = {r["ID"]: r["proba"] for r in b.collect()}
    assert len(ra) == dev.count() == a.count()
    assert ra == rb
    assert all(0.0 <= v <= 1.0 for v in ra.values())


def test_logreg_and_gbt_fit_score(spark, panel):
    dev, ev = panel.where("ID % 5 != 4"), panel.where("ID % 5 = 4")
    for name, ov in (("logreg_clean", {"max_iter": 50}), ("hgb", {"max_iter": 5})):
        p = pipeline_for(name, ["util"], overrides=ov).fit(dev)
        s = p.score(ev)
        assert s.count() == ev.count()
        assert s.where(F.col("proba").isNull()).count() == 0
