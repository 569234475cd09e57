"""Spec-level checks that need no fit: registries, parameter maps, search draws."""
from riskloom import config
from riskloom.plans.models import effective_params, make_estimator, tree_spec
from riskloom.plans.search import draw_specs


def test_registries_resolve(spark):
    for name in list(config.MODEL_CONFIGS) + list(config.IMBALANCE_CONFIGS) + \
            list(config.BOOSTING_CONFIGS):
        spec = config.resolve_model_spec(name)
        if spec["kind"] == "logreg":
            assert make_estimator("logreg", spec["params"], weighted=True).getWeightCol() == "weight"
        else:
            assert tree_spec(spec["kind"], spec["params"]).trees >= 100
        assert effective_params(spec["kind"], spec["params"])
    assert len(config.threshold_grid()) == 181
    assert config.ENCODING_CONFIGS["clean_linear"]["scale"] is True


def test_rf_mapping():
    spec = config.resolve_model_spec("rf_balanced_leaf30")
    est = tree_spec(spec["kind"], spec["params"])
    assert (est.kind, est.trees, est.leaf_rows, est.bootstrap, est.weights) == ("forest", 300, 30, True, "balanced")
    et = tree_spec("et", config.MODEL_CONFIGS["et"]["params"])
    assert (et.kind, et.bootstrap) == ("extra", False)


def test_search_draws_are_seeded_and_distinct():
    a = draw_specs("hgb", 12, seed=2024)
    b = draw_specs("hgb", 12, seed=2024)
    assert a == b and len(a) == 12
    assert len({repr(sorted(x.items())) for x in a}) == 12
    r = draw_specs("rf", 40, seed=2024)
    assert len(r) == 40 and all(x["class_weight"] == "balanced" for x in r)
    few = draw_specs("rf", 40, seed=2024, exact_n=False)
    assert len(few) <= 40
