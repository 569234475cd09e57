"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query derives the credit panel from the given tables (so its work grows with
them) and runs the operator through the library's own code. Floating outputs are
rounded to 6 decimals so engines can be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import config
from riskloom.functions import encode as E
from riskloom.functions import features as FE
from riskloom.functions.scorecard import score_table
from riskloom.operators import folds as FO
from riskloom.operators import metrics as M
from riskloom.operators import threshold as J
from riskloom.sources import panel as P
from riskloom.sources import schema as S


def r6(c):
    return F.round(F.col(c).cast("double"), 6).alias(c)


def _panel(spark, sf_dir) -> DataFrame:
    return P.credit_panel(spark, sf_dir)


def _dev(spark, sf_dir) -> DataFrame:
    return P.development(_panel(spark, sf_dir))


def _eval(spark, sf_dir) -> DataFrame:
    return P.evaluation(_panel(spark, sf_dir))


def _dev_table(spark, sf_dir) -> DataFrame:
    """Development rows materialised once (reliable checkpoint) for queries that
    read them many times (one branch per fold seed)."""
    from riskloom.session import cut_lineage
    return cut_lineage(_dev(spark, sf_dir))


def _split_tables(spark, sf_dir):
    """(dev, eval) from ONE materialised panel: fit-on-dev / apply-to-eval queries
    read the panel in several jobs, so it is derived from the tables once."""
    from riskloom.session import cut_lineage
    panel = cut_lineage(_panel(spark, sf_dir))
    return P.development(panel), P.evaluation(panel)


def _scores(spark, sf_dir, names=("A", "B", "C")) -> DataFrame:
    return score_table(_dev(spark, sf_dir), names)


def _folded_scores(spark, sf_dir, seeds=(config.SEED,), names=("A", "B", "C")) -> DataFrame:
    return _scores_of(_dev_table(spark, sf_dir) if len(seeds) > 1 else _dev(spark, sf_dir), seeds, names)


def _scores_of(dev, seeds, names) -> DataFrame:
    f = FO.assign_folds_multi(dev.select("ID", "label", *config.PAY_COLS,
                                         *config.PAY_AMT_COLS), seeds)
    return score_table(f, names, keep=("seed", "fold", "ID", "label"))


# ------------------------------------------------------------------ A
def a4_features(spark, sf_dir):
    return S.get_features(_dev(spark, sf_dir))


def a5_split_xy(spark, sf_dir):
    return S.split_xy(_dev(spark, sf_dir))


def a6_eval_ids(spark, sf_dir):
    return S.get_eval_ids(_eval(spark, sf_dir))


# ------------------------------------------------------------------ B
def b1_fold_codes(spark, sf_dir):
    df = FE.fold_undocumented_codes(_panel(spark, sf_dir))
    return df.select("ID", "EDUCATION", "MARRIAGE")


def b2_safe_ratio(spark, sf_dir):
    from riskloom.functions.nulls import safe_ratio
    df = _panel(spark, sf_dir)
    return df.select("ID", F.round(safe_ratio(F.col("PAY_AMT1"), F.col("BILL_AMT1"),
                                              F.col("BILL_AMT1") > 0, 1.0), 6).alias("ratio"))


def b3_nonfinite(spark, sf_dir):
    """Non-finite -> NULL: an unguarded ratio (NULL on /0) and an overflowing exp."""
    from riskloom.functions.nulls import finite_or_null
    df = _panel(spark, sf_dir)
    raw = F.try_divide(F.col("PAY_AMT1").cast("double"), F.col("BILL_AMT1").cast("double"))
    big = F.exp(F.col("BILL_AMT1") / F.lit(1000.0))
    return df.select("ID", F.round(finite_or_null(raw), 6).alias("ratio"),
                     finite_or_null(big).isNull().cast("int").alias("exp_dropped"))


def b6_pipeline(spark, sf_dir):
    """fold -> engineer(chosen groups) -> encode(clean_linear) on raw amounts."""
    groups = config.CHOSEN_FEATURE_GROUPS
    df = _panel(spark, sf_dir).transform(FE.fold_undocumented_codes) \
        .transform(FE.make_feature_engineer(groups)) \
        .transform(E.make_encoder(config.ENCODING_CONFIGS["clean_linear"]))
    cols = config.FEATURE_COLS + FE.engineered_feature_names(groups)
    return df.select("ID", *[r6(c) for c in cols])


# ------------------------------------------------------------------ C
def _family_query(groups):
    def q(spark, sf_dir):
        df = FE.add_engineered_features(
            FE.fold_undocumented_codes(_panel(spark, sf_dir)), groups)
        return df.select("ID", *[r6(c) for c in FE.engineered_feature_names(groups)])
    return q


FAMILY_KEYS = {"c1_pay": ["pay"], "c2_util": ["util"], "c3_payratio": ["payratio"],
               "c4_bill": ["bill"], "c5_paysem": ["paysem"], "c6_coverx": ["coverx"],
               "c7_utilmonths": ["utilmonths"], "c8_payamtratio": ["payamtratio"],
               "c9_stress": ["stress"], "c10_paysem2": ["paysem2"],
               "c11_chosen_combo": config.FEATURE_CONFIGS["paysem_util_payratio"],
               "c11_all_new": config.FEATURE_CONFIGS["all_new"],
               "c11_paysem_paysem2_util_payratio":
                   config.FEATURE_CONFIGS["paysem_paysem2_util_payratio"]}
FAMILY_KEYS |= {f"c11_{name}": groups for name, groups in config.FEATURE_CONFIGS.items()
                if groups not in [v for k, v in FAMILY_KEYS.items() if k.startswith("c11_")]}


# ------------------------------------------------------------------ D
def _encoding_query(name):
    enc = config.ENCODING_CONFIGS[name]

    def q(spark, sf_dir):
        df = E.apply_encoding(_panel(spark, sf_dir), enc)
        cols = config.NUMERIC + E.encoding_extra_columns(enc)
        return df.select("ID", *[r6(c) for c in cols])
    return q


ENCODING_KEYS = {"d1_pay_remap": "pay_remap", "d2_pay_flags": "pay_remap_flags",
                 "d3_bill_clip": "bill_clip", "d4_bill_flag": "bill_flag",
                 "d5_log1p": "log1p"}


# ------------------------------------------------------------------ H
def h1_folds(spark, sf_dir):
    return FO.assign_folds(_dev(spark, sf_dir).select("ID", "label"), config.SEED) \
        .select("ID", "label", "fold")


def h1_folds_seeds(spark, sf_dir):
    return FO.assign_folds_multi(_dev(spark, sf_dir).select("ID", "label"),
                                 config.VALIDATION_SEEDS).select("seed", "ID", "fold")


# ------------------------------------------------------------------ I
def i1_confusion(spark, sf_dir):
    return M.confusion(_scores(spark, sf_dir), ["model"], 0.5)


def i2_report(spark, sf_dir):
    rep = M.classification_report(_scores(spark, sf_dir), ["model"], 0.5)
    return rep.select("model", "class", r6("precision"), r6("recall"), r6("f1"), "support")


def i3_macro_f1(spark, sf_dir):
    return M.macro_f1_at_cut(_scores(spark, sf_dir), ["model"], 0.5).select("model",
                                                                           r6("macro_f1"))


def i4_roc_auc(spark, sf_dir):
    return M.roc_auc(_scores(spark, sf_dir), ["model"]).select("model", r6("roc_auc"))


def i5_fold_f1(spark, sf_dir):
    f = M.fold_macro_f1(_folded_scores(spark, sf_dir), ["model"], "fold", 0.5)
    return f.select("model", r6("macro_f1_mean"), r6("macro_f1_std"), "n_folds")


def i6_compare(spark, sf_dir):
    from riskloom.session import cut_lineage
    # three metric families read the score table: materialise it once
    r = M.compare_models(cut_lineage(_folded_scores(spark, sf_dir)))
    return r.select("model", r6("macro_f1_mean"), r6("macro_f1_std"), r6("roc_auc"),
                    "tn", "fp", "fn", "tp", "rank")


def i7_class_balance(spark, sf_dir):
    return M.class_balance(_dev(spark, sf_dir)).select("label", "n", r6("share"))


def i8_value_counts(spark, sf_dir):
    return M.value_counts(_dev(spark, sf_dir))


def i9_distinct_codes(spark, sf_dir):
    return M.distinct_codes(_dev(spark, sf_dir))


def i10_histograms(spark, sf_dir):
    h = M.histograms(_dev(spark, sf_dir), ("LIMIT_BAL", "AGE"), 40)
    return h.select("column", "bin", r6("lo"), r6("hi"), "n")


def i10_count_plot(spark, sf_dir):
    return M.count_plot(_dev(spark, sf_dir), "PAY_0")


def i11_missingness(spark, sf_dir):
    return M.missingness(_dev(spark, sf_dir))


def i12_correlation(spark, sf_dir):
    return M.correlation_matrix(_dev(spark, sf_dir)).select("a", "b", r6("corr"))


def i13_positive_rate(spark, sf_dir):
    s = _scores(spark, sf_dir)
    pred = s.select("model", (F.col("proba") >= 0.5).cast("int").alias("Predicted"))
    return M.positive_rate(pred, ["model"]).select("model", "n", "n_pos", r6("pos_rate"))


# ------------------------------------------------------------------ J
def j1_best_cut(spark, sf_dir):
    b = J.best_threshold(_scores(spark, sf_dir), ["model"])
    return b.select("model", r6("threshold"), r6("macro_f1"))


def j2_curve(spark, sf_dir):
    c = J.threshold_curve(_scores(spark, sf_dir), ["model"])
    return c.select("model", "i", r6("threshold"), r6("macro_f1"), r6("pos_rate"),
                    "tp", "fp", "fn", "tn")


def j2_sweep_predictions(spark, sf_dir):
    s = score_table(_eval(spark, sf_dir).withColumn("label", F.lit(0)), ["A"])
    return J.sweep_predictions(s, [0.3, 0.4, 0.5, 0.6]).select("ID", r6("threshold"),
                                                               "Predicted")


def j3_transfer(spark, sf_dir):
    t = J.transfer_f1(_folded_scores(spark, sf_dir, config.VALIDATION_SEEDS),
                      ["model", "seed"])
    return t.select("model", "seed", r6("transfer_f1"), r6("fold_thr_mean"),
                    r6("fold_thr_std"), r6("fold_thr_min"), r6("fold_thr_max"))


def j3_transfer_cuts(spark, sf_dir):
    t = J.transfer_cuts(_folded_scores(spark, sf_dir), ["model"])
    return t.select("model", F.col("k").alias("fold"), r6("threshold"), "tp", "fp", "fn", "tn")


def j4_fold_avg(spark, sf_dir):
    f = J.fold_avg_f1(_folded_scores(spark, sf_dir, config.VALIDATION_SEEDS),
                      ["model", "seed"])
    return f.select("model", "seed", r6("threshold"), r6("macro_f1"))


def j5_best_fixed(spark, sf_dir):
    f = J.best_fixed(_folded_scores(spark, sf_dir, config.VALIDATION_SEEDS),
                     ["model", "seed"])
    return f.select("model", "seed", r6("threshold"), r6("macro_f1"))


def j6_summary(spark, sf_dir):
    from riskloom.session import cut_lineage
    # histogram pass + FOLD-AVG re-scoring pass: materialise the score table once
    sc = cut_lineage(_folded_scores(spark, sf_dir, config.VALIDATION_SEEDS))
    st = J.evaluate_strategies(sc, ["model", "seed"])
    s = J.strategy_summary(st, ["model", "seed"], over="seed")
    cols = [c for c in s.columns if c not in ("model", "n_seeds")]
    return s.select("model", "n_seeds", *[r6(c) for c in cols])


def j7_segments(spark, sf_dir):
    dev = _dev(spark, sf_dir)
    parts = [J.make_segments(dev, k).select("ID", F.lit(k).alias("scheme"), "segment")
             for k in ("pay0", "sex", "limit3")]
    return M.union_all(parts)


def j8_apply_segments(spark, sf_dir):
    """Per-segment cuts (a fixed table) applied with the global fallback."""
    s = J.make_segments(score_table(_dev(spark, sf_dir), ["A"],
                                    keep=("ID", "label", "PAY_0")), "pay0")
    cuts = J.thresholds_frame(spark, {"ontime": 0.3, "late1": 0.55})
    return J.apply_segment_thresholds(s, cuts, 0.4).select("ID", "segment", "Predicted")


# ------------------------------------------------------------------ A (sources / sinks)
def _scratch(spark, name: str) -> str:
    import os
    import uuid
    from riskloom.session import checkpoint_dir
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:8]}")


def a1_load_csv(spark, sf_dir):
    """Panel written as CSV to the shared folder, read back with the explicit schema."""
    path = _scratch(spark, "panel_csv")
    _dev(spark, sf_dir).write.option("header", True).csv(path)
    return S.load_table(spark, path, with_label=True, fmt="csv")


def _submission(spark, sf_dir):
    from riskloom.plans.flagship import scorecard_submission
    return scorecard_submission(spark, sf_dir)


def a7_submission(spark, sf_dir):
    from riskloom.sources import sink
    path = _scratch(spark, "submission")
    sink.write_submission(_submission(spark, sf_dir), path)
    return sink.read_submission(spark, path)


def a8_validate(spark, sf_dir):
    """Violations of a written submission vs the eval ids, plus a deliberately
    broken copy (one id dropped, one duplicated, one bad value, one extra id)."""
    from riskloom.sources import sink
    path = _scratch(spark, "submission")
    sub = _submission(spark, sf_dir)
    sink.write_submission(sub, path)
    ids = _eval(spark, sf_dir).select("ID")
    good = sink.violations(sink.read_submission(spark, path), ids) \
        .withColumn("case", F.lit("written"))
    lo = sub.agg(F.min("Id")).collect()[0][0]
    hi = sub.agg(F.max("Id")).collect()[0][0]
    bad_sub = sub.where(F.col("Id") != lo) \
        .unionByName(sub.where(F.col("Id") == hi)) \
        .withColumn("Predicted", F.when(F.col("Id") == hi, F.lit(7)).otherwise(F.col("Predicted"))) \
        .unionByName(sub.where(F.col("Id") == hi).select((F.col("Id") + 1).alias("Id"), "Predicted"))
    bad = sink.violations(bad_sub, ids).withColumn("case", F.lit("broken"))
    return good.unionByName(bad)


def a10_emit(spark, sf_dir):
    from riskloom.sources import sink
    root = _scratch(spark, "ledger_root")
    sub = _submission(spark, sf_dir)
    ids = _eval(spark, sf_dir).select("ID")
    sink.emit_submission(spark, sub, ids, root, "scorecard A at the best global cut")
    sink.emit_submission(spark, sub.withColumn("Predicted", F.lit(0)), ids, root, "all zeros")
    led = spark.read.parquet(f"{root}/ledger")
    return led.select("n", "n_rows", r6("pos_rate"), "description")


# ------------------------------------------------------------------ E
def _dev_prepared(spark, sf_dir, groups=None):
    """Development rows (materialised once: a fit reads them in several jobs) with
    folded codes and the requested feature families."""
    groups = config.CHOSEN_FEATURE_GROUPS if groups is None else groups
    return FE.add_engineered_features(FE.fold_undocumented_codes(_dev_table(spark, sf_dir)),
                                      groups)


def e1_medians(spark, sf_dir):
    from riskloom.operators.prep import fit_medians
    cols = config.NUMERIC + FE.engineered_feature_names(config.CHOSEN_FEATURE_GROUPS)
    med = fit_medians(_dev_prepared(spark, sf_dir), cols)
    return spark.createDataFrame([(c, float(med[c])) for c in cols],
                                 "column string, median double").select("column", r6("median"))


def e2_modes(spark, sf_dir):
    from riskloom.operators.prep import fit_modes
    m = fit_modes(_dev_prepared(spark, sf_dir, []), config.CATEGORICAL + ["PAY_0"])
    return spark.createDataFrame([(c, float(v)) for c, v in m.items()], "column string, mode double")


def e3_scaler(spark, sf_dir):
    from riskloom.operators.prep import fit_medians, fit_scaler
    d = _dev_prepared(spark, sf_dir)
    cols = config.NUMERIC + FE.engineered_feature_names(config.CHOSEN_FEATURE_GROUPS)
    sc = fit_scaler(d, cols, fit_medians(d, cols))
    return spark.createDataFrame([(c, float(m), float(sd)) for c, (m, sd) in sc.items()],
                                 "column string, mean double, std double") \
        .select("column", r6("mean"), r6("std"))


def _fitted(spark, sf_dir, scale=True):
    from riskloom.operators.prep import fit_preprocessor
    groups = config.CHOSEN_FEATURE_GROUPS
    dev, evl = _split_tables(spark, sf_dir)
    pre = fit_preprocessor(FE.add_engineered_features(FE.fold_undocumented_codes(dev), groups),
                           FE.engineered_feature_names(groups), scale=scale)
    ev = FE.add_engineered_features(FE.fold_undocumented_codes(evl), groups)
    return pre, pre.transform(ev)


def e4_onehot(spark, sf_dir):
    pre, x = _fitted(spark, sf_dir, scale=False)
    from riskloom.operators.prep import onehot_name
    items = [F.struct(F.lit(c).alias("column"), F.lit(float(v)).alias("category"),
                      F.col(onehot_name(c, v)).alias("value"))
             for c in pre.categorical for v in pre.categories[c]]
    return x.select("ID", F.inline(F.array(*items)))


def e5_router(spark, sf_dir):
    pre, x = _fitted(spark, sf_dir, scale=True)
    items = [F.struct(F.lit(c).alias("feature"), F.round(F.col(c), 6).alias("value"))
             for c in pre.output_columns()]
    return x.select("ID", F.inline(F.array(*items)))


def e6_target_encoding(spark, sf_dir):
    from riskloom.operators.target import target_encode
    d0, e0 = _split_tables(spark, sf_dir)
    dev, ev = FE.fold_undocumented_codes(d0), FE.fold_undocumented_codes(e0)
    tr, new = target_encode(dev, ev)
    cols = config.CATEGORICAL
    return tr.select("ID", F.lit("train").alias("part"), *[r6(c) for c in cols]) \
        .unionByName(new.select("ID", F.lit("new").alias("part"), *[r6(c) for c in cols]))


# ------------------------------------------------------------------ K
K_ENSEMBLES = {"AB": ["A", "B"], "ABC": ["A", "B", "C"], "A_dummy": ["A", "dummy"],
               "A_missing": ["A", "Z"]}


def _k_scores(spark, sf_dir, seeds=tuple(config.VALIDATION_SEEDS)) -> DataFrame:
    """Score table (seed, fold, ID, label, model, proba): scorecards A/B/C plus the
    prior-sampling floor (G1) scored out-of-fold, for every fold seed."""
    from riskloom.plans.models import dummy_oof
    dev = _dev_table(spark, sf_dir).select("ID", "label", *config.PAY_COLS,
                                           *config.PAY_AMT_COLS)
    parts = []
    for sd in seeds:
        f = FO.assign_folds(dev, sd)
        cards = score_table(f, ("A", "B", "C"), keep=("fold", "ID", "label"))
        d = dummy_oof(f, sd).select("fold", "ID", "label", F.lit("dummy").alias("model"),
                                    "proba")
        parts.append(cards.unionByName(d).withColumn("seed", F.lit(int(sd))))
    return M.union_all(parts)


def k1_softvote(spark, sf_dir):
    from riskloom.operators.ensemble import soft_vote
    v = soft_vote(_k_scores(spark, sf_dir), ["A", "B"], "AB")
    return v.select("seed", "fold", "ID", "label", "model", r6("proba"))


def k2_named_ensembles(spark, sf_dir):
    from riskloom.operators.ensemble import named_ensembles
    e = named_ensembles(_k_scores(spark, sf_dir), K_ENSEMBLES)
    b = J.best_threshold(e, ["model", "seed"])
    return b.select("model", "seed", r6("threshold"), r6("macro_f1"))


def k2_learner_ensembles(spark, sf_dir):
    """K2 over learners: the seven named lists, from one out-of-fold table of their members."""
    from riskloom.operators.ensemble import named_ensembles
    from riskloom.plans import oof
    from riskloom.plans.models import pipeline_for
    from riskloom.session import cut_lineage
    folds = oof.with_folds(_dev_table(spark, sf_dir), config.SEED)
    members = sorted({m for ms in config.ENSEMBLE_CONFIGS.values() for m in ms})
    scores = cut_lineage(oof.oof_table({m: lambda m=m: pipeline_for(m) for m in members}, folds))
    both = scores.select("seed", "fold", "ID", "label", "model", "proba").unionByName(
        named_ensembles(scores, config.ENSEMBLE_CONFIGS))
    return J.best_threshold(both, ["model"]).select("model", r6("threshold"), r6("macro_f1"))


def k3_seed_average(spark, sf_dir):
    from riskloom.operators.ensemble import seed_average
    a = seed_average(_k_scores(spark, sf_dir), config.VALIDATION_SEEDS)
    return a.select("model", "ID", "label", "n_seeds", r6("proba"))


def k3_seed_average_learner(spark, sf_dir):
    """K3 in full: the chosen learner under eight seeds, out of fold and on the evaluation
    rows, with the best cut of the out-of-fold average as seeds accumulate."""
    from riskloom.plans.stacking import seed_ensemble
    dev, ev = _split_tables(spark, sf_dir)
    a = seed_ensemble(config.CHOSEN_ENSEMBLE[0], dev, ev, config.AVERAGE_SEEDS, config.CHOSEN_FEATURE_GROUPS)
    return a.select("half", "model", "ID", "label", "n_seeds", r6("proba"), r6("threshold"), r6("macro_f1"))


def k7_diversity(spark, sf_dir):
    from riskloom.operators.ensemble import diversity_vs_anchor
    from riskloom.session import cut_lineage
    # read twice (best cuts, then the pairing): materialise once
    d = diversity_vs_anchor(cut_lineage(_k_scores(spark, sf_dir)), "A", ["seed"])
    return d.select("model", "seed", r6("corr"), r6("disagreement"))


def _k_results(spark, sf_dir, seeds=tuple(config.VALIDATION_SEEDS)):
    from riskloom.operators.ensemble import named_ensembles
    from riskloom.session import cut_lineage
    # the score table feeds both the members and the ensemble: materialise it once
    s = cut_lineage(_k_scores(spark, sf_dir, seeds))
    e = named_ensembles(s, {"AB": ["A", "B"]})
    allm = s.select("seed", "fold", "ID", "label", "model", "proba").unionByName(e)
    return J.best_threshold(allm, ["model", "seed"])


def k12_screen(spark, sf_dir):
    from riskloom.operators.compare import screen_vs_anchor
    r = _k_results(spark, sf_dir, (config.SEED,)).drop("seed")
    return screen_vs_anchor(r, "A").select("model", r6("macro_f1"), r6("anchor_f1"),
                                           r6("delta"), "promising")


def k13_paired(spark, sf_dir):
    from riskloom.operators.compare import paired_report
    p = paired_report(_k_results(spark, sf_dir), "A", config.VALIDATION_SEEDS)
    return p.select("model", r6("f1_mean"), r6("f1_std"), r6("dmean"), "wins", "n_seeds",
                    "verdict", "rank", "recommended")


# ------------------------------------------------------------------ F
def _resample_input(spark, sf_dir) -> DataFrame:
    """(ID, label, features): folded codes, median-imputed numerics + one-hot
    categoricals fitted on the development rows (the sampler's input space)."""
    from riskloom.operators.prep import fit_preprocessor
    from riskloom.session import cut_lineage
    dev = FE.fold_undocumented_codes(_dev_table(spark, sf_dir))
    pre = fit_preprocessor(dev, (), scale=False)
    x = pre.transform(dev, keep=("ID", "label"))
    # samplers read it several times
    return cut_lineage(x.select("ID", "label", F.array(*pre.output_columns()).alias("features")))


def f1_undersample(spark, sf_dir):
    from riskloom.operators.resample import undersample
    return undersample(_resample_input(spark, sf_dir), config.SEED).select("ID", "label")


def f7_knn(spark, sf_dir):
    from riskloom.operators.knn import knn
    x = _resample_input(spark, sf_dir)
    nn = knn(x, x, 5, exclude_self=True)
    return nn.select(F.col("qid").alias("ID"), F.col("nid").alias("neighbor"),
                     F.col("rank").cast("int").alias("rank"),
                     F.round(F.sqrt("dist2"), 3).alias("dist"))


def f7_knn_lsh(spark, sf_dir):
    from riskloom.operators.lsh import knn_lsh
    x = _resample_input(spark, sf_dir)
    return knn_lsh(x, x, 5, exclude_self=True).select(
        F.col("qid").alias("ID"), F.col("nid").alias("neighbor"), F.col("rank").cast("int").alias("rank"),
        F.round(F.sqrt("dist2"), 3).alias("dist"))


def f2_smote_lsh(spark, sf_dir):
    from riskloom.operators.lsh import knn_lsh
    from riskloom.operators.resample import smote
    return _resampled(lambda x: smote(x, search=knn_lsh))(spark, sf_dir)


def f4_tomek_links(spark, sf_dir):
    from riskloom.operators.resample import tomek_links
    return tomek_links(_resample_input(spark, sf_dir)).select("a", "b", "la", "lb")


def f4_tomek(spark, sf_dir):
    from riskloom.operators.resample import tomek
    return tomek(_resample_input(spark, sf_dir), "majority").select("ID", "label")


def _resampled(fn):
    def q(spark, sf_dir):
        out = fn(_resample_input(spark, sf_dir))
        if "synthetic" not in out.columns:
            out = out.withColumn("synthetic", F.lit(False))
        return out.select("ID", "label", "synthetic",
                          F.transform("features", lambda v: F.round(v, 6)).alias("features"))
    return q


def _sampler(name):
    from riskloom.operators import resample as R
    return {"smote": lambda d: R.smote(d, config.SEED),
            "borderline": lambda d: R.borderline_smote(d, config.SEED),
            "smotetomek": lambda d: R.smote_tomek(d, config.SEED),
            "smoteenn": lambda d: R.smote_enn(d, config.SEED)}[name]


# ------------------------------------------------------------------ J9 / J10 / J11
SCHEMES = ("pay0", "sex", "limit3")


def _segment_names(dev, rows, scheme):
    """Segments of ``rows`` under a scheme; quantile schemes take their edges from dev."""
    from riskloom.operators.threshold import make_segments, tercile_edges
    edges = tercile_edges(dev) if scheme == "limit3" else None
    return make_segments(rows, scheme, edges).withColumn("scheme", F.lit(scheme))


def _seg_input(dev, seeds=(config.SEED,)):
    """Scores by fold beside the columns that the schemes read. Every scheme and job reads
    these rows, so they are derived once, from development rows that are stored."""
    from riskloom.session import cut_lineage
    s = _scores_of(dev, seeds, ("A",))
    return cut_lineage(s.join(dev.select("ID", "PAY_0", "SEX", "LIMIT_BAL"), "ID"))


def j9_segment_hist(spark, sf_dir):
    """The single histogram job J9 needs: (segment, bin, ge_global, n_pos, n_neg)."""
    dev = _dev_table(spark, sf_dir)
    s = _segment_names(dev, _seg_input(dev), "pay0")
    g = J.best_threshold(s).first()["threshold"]
    return J.segment_hist(s, [], global_thr=g).select("segment", "bin", "ge_global",
                                                       "n_pos", "n_neg")


def j9_segment_cuts(spark, sf_dir):
    """Cuts of every scheme, with the macro-F1 they reach and the global one."""
    out = []
    dev = _dev_table(spark, sf_dir)
    rows = _seg_input(dev)
    for scheme in SCHEMES:
        s = _segment_names(dev, rows, scheme)
        b = J.best_threshold(s).first()
        cuts = J.tune_segment_thresholds(s, float(b["threshold"]))
        pred = J.apply_segment_thresholds(s, J.thresholds_frame(spark, cuts), float(b["threshold"]))
        f1 = M.macro_f1_at_cut(pred.withColumn("p", F.col("Predicted").cast("double")),
                               [], 0.5, score="p").first()["macro_f1"]
        out += [(scheme, seg, float(c), float(f1), float(b["macro_f1"])) for seg, c in sorted(cuts.items())]
    return spark.createDataFrame(out, "scheme string, segment string, threshold double, segmented_f1 double, "
                                      "global_f1 double").select(
        "scheme", "segment", r6("threshold"), r6("segmented_f1"), r6("global_f1"))


def j10_honest_transfer(spark, sf_dir):
    """Every scheme and seed, and per scheme (seed NULL) the means and the wins."""
    out = []
    dev = _dev_table(spark, sf_dir)
    rows = _seg_input(dev, tuple(config.VALIDATION_SEEDS))
    for scheme in SCHEMES:
        found = J.honest_transfer(_segment_names(dev, rows, scheme), ["seed"])
        out += [(scheme, int(r["seed"]), r["global_f1"], r["segmented_f1"], r["delta"], int(r["delta"] > 0))
                for r in found]
        m = J.scheme_summary(found)
        out.append((scheme, None, m["global_f1"], m["segmented_f1"], m["delta"], m["wins"]))
    return spark.createDataFrame(out, "scheme string, seed int, global_f1 double, segmented_f1 double, "
                                      "delta double, wins int").select(
        "scheme", "seed", r6("global_f1"), r6("segmented_f1"), r6("delta"), "wins")


def j11_segment_predictions(spark, sf_dir):
    """Evaluation rows under the cuts of every scheme."""
    out = None
    dev, ev = _split_tables(spark, sf_dir)
    rows = _seg_input(dev)
    new = score_table(ev.withColumn("label", F.lit(0)), ["A"], keep=("ID", "PAY_0", "SEX", "LIMIT_BAL"))
    for scheme in SCHEMES:
        s = _segment_names(dev, rows, scheme)
        b = J.best_threshold(s).first()
        cuts = J.thresholds_frame(spark, J.tune_segment_thresholds(s, float(b["threshold"])))
        p = J.apply_segment_thresholds(_segment_names(dev, new, scheme), cuts, float(b["threshold"])).select(
            "scheme", F.col("ID").alias("Id"), "segment", "Predicted")
        out = p if out is None else out.unionByName(p)
    return out


# ------------------------------------------------------------------ E7 / G / H / K6 / K8-K10
def e7_anomaly(spark, sf_dir):
    from riskloom.operators.anomaly import add_anomaly_score, fit_isolation_forest
    from riskloom.operators.prep import fit_preprocessor
    d0, e0 = _split_tables(spark, sf_dir)
    dev, ev = FE.fold_undocumented_codes(d0), FE.fold_undocumented_codes(e0)
    pre = fit_preprocessor(dev, (), scale=False)

    def mat(df):
        return pre.transform(df, keep=("ID",)).select(
            "ID", F.array(*pre.output_columns()).alias("features"))
    model = fit_isolation_forest(mat(dev), 200, 256, config.SEED)
    out = add_anomaly_score(mat(dev).withColumn("part", F.lit("train")), model) \
        .unionByName(add_anomaly_score(mat(ev).withColumn("part", F.lit("new")), model))
    return out.select("ID", "part", r6("anomaly_score"))


def _oof_query(name, groups=()):
    def q(spark, sf_dir):
        from riskloom.plans import oof
        s = oof.oof_proba(name, _dev_table(spark, sf_dir), config.SEED, groups)
        return s.select("ID", "label", "fold", "model", r6("proba"))
    return q


def _screen(names):
    """Out-of-fold best cut and macro-F1 of every named model on the same folds."""
    def q(spark, sf_dir):
        from riskloom.plans import oof
        from riskloom.plans.models import pipeline_for
        folds = oof.with_folds(_dev_table(spark, sf_dir), config.SEED)
        s = oof.oof_table({n: lambda n=n: pipeline_for(n) for n in names}, folds)
        return J.best_threshold(s, ["model"]).select("model", r6("threshold"), r6("macro_f1"))
    return q


def g1_dummy_oof(spark, sf_dir):
    from riskloom.plans.models import dummy_oof
    f = FO.assign_folds(_dev(spark, sf_dir).select("ID", "label"), config.SEED)
    return dummy_oof(f, config.SEED).select("ID", "label", "fold", "proba")


def g9_class_weights(spark, sf_dir):
    from riskloom.plans.models import class_weights
    w = class_weights(_dev(spark, sf_dir), "balanced")
    return spark.createDataFrame([(int(k), float(v)) for k, v in sorted(w.items())],
                                 "label int, weight double").select("label", r6("weight"))


def g12_train_predict(spark, sf_dir):
    from riskloom.plans.chosen import train_and_predict
    from riskloom.session import cut_lineage
    panel = cut_lineage(_panel(spark, sf_dir))
    pred, _ = train_and_predict(P.development(panel), P.evaluation(panel))
    return pred


def h5_fit_eval(spark, sf_dir):
    from riskloom.plans import oof
    from riskloom.session import cut_lineage
    panel = cut_lineage(_panel(spark, sf_dir))
    s = oof.fit_eval_proba("logreg_clean", P.development(panel), P.evaluation(panel))
    return s.select("ID", r6("proba"))


def _over(names, one):
    """``one(name)`` of every name, as one table with the name as ``model``."""
    return M.union_all([one(n).withColumn("model", F.lit(n)) for n in names])


def k6_stacking(spark, sf_dir):
    """K6: every stack of the registry."""
    from riskloom.plans.stacking import Stacking, fit_stacks
    dev, ev = _split_tables(spark, sf_dir)
    stacks = dict(zip(config.STACKING_CONFIGS, fit_stacks(
        [Stacking(spec["members"], spec["meta"]) for spec in config.STACKING_CONFIGS.values()], dev)))
    return _over(stacks, lambda name: stacks[name].score(ev)).select("model", "ID", r6("proba"))


def k8_k9_calibration(spark, sf_dir):
    """K8, K9: raw, Platt and isotonic for each scorecard, and for the chosen learner out
    of fold."""
    from riskloom.plans import oof
    from riskloom.plans.calibrate import calibration_report
    from riskloom.session import cut_lineage
    dev = _dev_table(spark, sf_dir)
    chosen = config.CHOSEN_ENSEMBLE[0]

    def one(name):
        if name == chosen:
            return calibration_report(cut_lineage(oof.oof_proba(name, dev, config.SEED, config.CHOSEN_FEATURE_GROUPS)))
        return calibration_report(score_table(dev, (name,)))
    return _over(("A", "B", "C", chosen), one).select("model", "method", r6("threshold"), r6("macro_f1"))


def k10_calibrated_cv(spark, sf_dir):
    """Both calibrators, under a linear learner and the chosen one."""
    from riskloom.plans.calibrate import CALIBRATORS, CalibratedCV
    from riskloom.plans.models import pipeline_for
    dev, ev = _split_tables(spark, sf_dir)

    def one(method):
        return _over(("logreg_clean", *config.CHOSEN_ENSEMBLE), lambda name: CalibratedCV(
            lambda: pipeline_for(name), method).fit(dev).score(ev)).withColumn("method", F.lit(method))
    return M.union_all([one(m) for m in CALIBRATORS]).select("model", "method", "ID", r6("proba"))


def _fitted_on_dev(spark, sf_dir, pipelines):
    """Each named pipeline fitted on the development rows and scored on the evaluation rows."""
    from riskloom.plans.models import fit_together
    dev, ev = _split_tables(spark, sf_dir)
    out = None
    fitted = fit_together([(pipe, dev, 0) for _, pipe in pipelines])
    for (name, _), pipe in zip(pipelines, fitted):
        s = pipe.score(ev).select(F.lit(name).alias("model"), "ID", r6("proba"))
        out = s if out is None else out.unionByName(s)
    return out


def f_resampled_models(spark, sf_dir):
    """F1-F6 as the sampler stage: the seven resampling models."""
    from riskloom.plans.models import pipeline_for
    return _fitted_on_dev(spark, sf_dir, [(n, pipeline_for(n)) for n in config.RESAMPLING_CONFIGS])


def e7_anomaly_models(spark, sf_dir):
    """E7 as a fitted stage, under a linear and a forest learner."""
    from riskloom.plans.models import pipeline_for
    return _fitted_on_dev(spark, sf_dir, [(n, pipeline_for(n, anomaly={"n_trees": 200, "max_samples": 256}))
                                          for n in ("logreg_clean", "rf_balanced")])


def e6_target_models(spark, sf_dir):
    """E6 as a fitted stage, under a linear and a forest learner."""
    from riskloom.plans.models import pipeline_for
    return _fitted_on_dev(spark, sf_dir, [(n, pipeline_for(n, target=True)) for n in ("logreg_clean", "rf_balanced")])


def g12_soft_vote(spark, sf_dir):
    """K1 deployed: hgb + logreg + rf by soft vote, cut tuning, refit, predictions."""
    from riskloom.plans.chosen import train_and_predict
    dev, ev = _split_tables(spark, sf_dir)
    pred, _ = train_and_predict(dev, ev, members=["hgb", "logreg_clean", "rf"])
    return pred


def h6_search(spark, sf_dir):
    """H6: forty drawn specs of each space ranked, the best six validated over every seed
    against the anchor, the best three refitted and emitted."""
    from riskloom.plans.search import SPACES, search_and_emit
    dev, ev = _split_tables(spark, sf_dir)
    out = M.union_all([search_and_emit(kind, dev, ev, _scratch(spark, f"search-{kind}")).withColumn("kind", F.lit(kind))
                       for kind in SPACES])
    return out.select("kind", "spec_id", "params", r6("macro_f1"), r6("threshold"), r6("delta"), "wins", "submission")


def h9_candidates(spark, sf_dir):
    """H9: the best spec of each search, a feature-set combination and an ensemble as
    candidates."""
    from riskloom.plans.chosen import SoftVote
    from riskloom.plans.search import SPACES, candidate_list, ranking
    dev, ev = _split_tables(spark, sf_dir)
    tuned = [(kind, ranking(kind, dev)[0]["spec"], ()) for kind in SPACES]
    found = candidate_list([*tuned, ("logreg_clean", {}, config.CHOSEN_FEATURE_GROUPS),
                            ("vote", lambda: SoftVote(["logreg_clean", "dummy"]))], dev, ev,
                           root=_scratch(spark, "candidates"))
    out = None
    for c in found:
        p = c["predictions"].select(F.lit(c["name"]).alias("name"), F.lit(round(c["oof_f1"], 6)).alias("oof_f1"),
                                    F.lit(c["submission"]).alias("submission"), "Id", "Predicted")
        out = p if out is None else out.unionByName(p)
    return out


# ------------------------------------------------------------------ D-6 / D-7
def _router_long(spark, sf_dir, encoding_name: str, groups=()):
    """Encode -> fit the router on the development rows -> long (ID, feature, value)
    for the evaluation rows; ``scale`` comes from the encoding spec."""
    from riskloom.operators.prep import fit_preprocessor
    enc = config.ENCODING_CONFIGS[encoding_name]

    def prep(df):
        out = FE.add_engineered_features(FE.fold_undocumented_codes(df), groups)
        return E.apply_encoding(out, enc)
    dev, evl = _split_tables(spark, sf_dir)
    pre = fit_preprocessor(prep(dev),
                           E.encoding_extra_columns(enc) + FE.engineered_feature_names(groups),
                           scale=enc.get("scale", True))
    x = pre.transform(prep(evl))
    items = [F.struct(F.lit(c).alias("feature"), F.round(F.col(c), 6).alias("value"))
             for c in pre.output_columns()]
    return x.select("ID", F.inline(F.array(*items)))


def d6_scale(spark, sf_dir):
    return _router_long(spark, sf_dir, "baseline")


def d7_noscale(spark, sf_dir):
    """D-7: a tree learner scores the same with and without scaling; rows that differ by more
    than 1e-9 are counted per fold."""
    from riskloom.plans import oof
    from riskloom.plans.models import ModelPipeline
    folds = oof.with_folds(_dev_table(spark, sf_dir), config.SEED)
    s = oof.oof_table({e: lambda e=e: ModelPipeline("hgb", {}, [], dict(config.ENCODING_CONFIGS[e]))
                       for e in ("noscale", "baseline")}, folds)
    apart = F.max("proba") - F.min("proba") > 1e-9
    rows = s.groupBy("fold", "ID").agg(apart.alias("apart"), F.count("*").alias("n"))
    return rows.groupBy("fold").agg(F.count("*").alias("n_rows"), F.count_if("apart").alias("n_apart"), F.sum("n").alias("n_scores"))


def g12_score_range(spark, sf_dir):
    """G12 with cuts over the range of the inner scores."""
    from riskloom.plans.chosen import train_and_predict
    dev, ev = _split_tables(spark, sf_dir)
    return train_and_predict(dev, ev, grid="score_range")[0]


def d7_clean_linear(spark, sf_dir):
    return _router_long(spark, sf_dir, "clean_linear")


def h4_oof_cache(spark, sf_dir):
    """H4: the long OOF score table for every (model, seed), built once through the
    fold-fit path and stored; here for the prior-sampling floor over the five validation
    seeds, its draws moving with the fold seed as K3 needs them."""
    from riskloom.plans.oof import build_oof_cache
    c = build_oof_cache(["dummy"], _dev_table(spark, sf_dir), config.VALIDATION_SEEDS, move_learner_seed=True)
    return c.select("seed", "fold", "ID", "label", "model", "proba")


def h4_oof_cache_learners(spark, sf_dir):
    """H4 in full: every model of the registry under every validation seed."""
    from riskloom.plans.oof import build_oof_cache
    c = build_oof_cache(["dummy", *config.MODEL_CONFIGS], _dev_table(spark, sf_dir), config.VALIDATION_SEEDS)
    return c.select("seed", "fold", "ID", "label", "model", r6("proba"))


def k4_view_ensemble(spark, sf_dir):
    """K4: one learner (logreg_clean) on two named feature views, OOF averaged."""
    from riskloom.plans.stacking import view_ensemble
    views = {v: config.FEATURE_CONFIGS[v] for v in ("paysem_util_payratio", "all_new")}
    e = view_ensemble(views, "logreg_clean", _dev_table(spark, sf_dir))
    return e.select("ID", "label", "fold", "model", r6("proba"))


def k5_family_ensemble(spark, sf_dir):
    """K5: several learners on ONE feature set (the chosen families), OOF averaged."""
    from riskloom.plans.stacking import family_ensemble
    e = family_ensemble(["rf_balanced", "hgb", "logreg_clean", "et_balanced"], config.CHOSEN_FEATURE_GROUPS,
                        _dev_table(spark, sf_dir))
    return e.select("ID", "label", "fold", "model", r6("proba"))


# ------------------------------------------------------------------ registry
def registry() -> dict:
    q = {
        "a1_load_csv": a1_load_csv, "a7_submission": a7_submission, "a8_validate": a8_validate,
        "a10_emit": a10_emit,
        "e1_medians": e1_medians, "e2_modes": e2_modes, "e3_scaler": e3_scaler,
        "e4_onehot": e4_onehot, "e5_router": e5_router, "e6_target_encoding": e6_target_encoding,
        "a4_features": a4_features, "a5_split_xy": a5_split_xy, "a6_eval_ids": a6_eval_ids,
        "b1_fold_codes": b1_fold_codes, "b2_safe_ratio": b2_safe_ratio,
        "b3_nonfinite": b3_nonfinite, "b6_pipeline": b6_pipeline,
    }
    q.update({k: _family_query(v) for k, v in FAMILY_KEYS.items()})
    q.update({k: _encoding_query(v) for k, v in ENCODING_KEYS.items()})
    q.update({
        "h1_folds": h1_folds, "h1_folds_seeds": h1_folds_seeds,
        "i1_confusion": i1_confusion, "i2_report": i2_report, "i3_macro_f1": i3_macro_f1,
        "i4_roc_auc": i4_roc_auc, "i5_fold_f1": i5_fold_f1, "i6_compare": i6_compare,
        "i7_class_balance": i7_class_balance, "i8_value_counts": i8_value_counts,
        "i9_distinct_codes": i9_distinct_codes, "i10_histograms": i10_histograms,
        "i10_count_plot": i10_count_plot, "i11_missingness": i11_missingness,
        "i12_correlation": i12_correlation, "i13_positive_rate": i13_positive_rate,
        "j1_best_cut": j1_best_cut, "j2_curve": j2_curve,
        "j2_sweep_predictions": j2_sweep_predictions,
        "j3_transfer": j3_transfer, "j3_transfer_cuts": j3_transfer_cuts,
        "j4_fold_avg": j4_fold_avg, "j5_best_fixed": j5_best_fixed, "j6_summary": j6_summary,
        "j7_segments": j7_segments,
        "k1_softvote": k1_softvote, "k2_named_ensembles": k2_named_ensembles,
        "k3_seed_average": k3_seed_average, "k3_seed_average_learner": k3_seed_average_learner,
        "h4_oof_cache_learners": h4_oof_cache_learners, "k7_diversity": k7_diversity,
        "k12_screen": k12_screen, "k13_paired": k13_paired,
        "f1_undersample": f1_undersample, "f7_knn": f7_knn, "f7_knn_lsh": f7_knn_lsh, "f4_tomek_links": f4_tomek_links,
        "f4_tomek": f4_tomek,
        "d6_scale": d6_scale, "d7_clean_linear": d7_clean_linear,
        "j9_segment_hist": j9_segment_hist, "j9_segment_cuts": j9_segment_cuts,
        "j10_honest_transfer": j10_honest_transfer,
        "j11_segment_predictions": j11_segment_predictions,
        "e7_anomaly": e7_anomaly, "g1_dummy_oof": g1_dummy_oof,
        "g9_class_weights": g9_class_weights, "h4_oof_cache": h4_oof_cache,
        "h2_oof_hgb": _oof_query("hgb"), "h2_oof_logreg_clean": _oof_query("logreg_clean"),
        "h2_oof_rf_balanced": _oof_query("rf_balanced", config.CHOSEN_FEATURE_GROUPS),
        "h2_oof_et": _oof_query("et"), "h2_oof_gb": _oof_query("gb"),
        "g4_g6_imbalance_screen": _screen(list(config.IMBALANCE_CONFIGS)),
        "g8_boosting_screen": _screen(list(config.BOOSTING_CONFIGS)),
        "g12_train_predict": g12_train_predict, "h5_fit_eval": h5_fit_eval,
        "k4_view_ensemble": k4_view_ensemble, "k5_family_ensemble": k5_family_ensemble,
        "k6_stacking": k6_stacking, "k8_k9_calibration": k8_k9_calibration,
        "k10_calibrated_cv": k10_calibrated_cv,
        "f_resampled_models": f_resampled_models, "e7_anomaly_models": e7_anomaly_models,
        "e6_target_models": e6_target_models, "g12_soft_vote": g12_soft_vote,
        "g12_score_range": g12_score_range, "k2_learner_ensembles": k2_learner_ensembles, "d7_noscale": d7_noscale,
        "h6_search": h6_search, "h9_candidates": h9_candidates,
        "f2_smote": _resampled(_sampler("smote")), "f2_smote_lsh": f2_smote_lsh,
        "f3_borderline_smote": _resampled(_sampler("borderline")),
        "f5_smote_tomek": _resampled(_sampler("smotetomek")),
        "f6_smote_enn": _resampled(_sampler("smoteenn")), "j8_apply_segments": j8_apply_segments,
    })
    return q
