"""Oracle SQL per registered query key (DuckDB dialect, naive formulations)."""

from __future__ import annotations

from duck_oracle.base import (AMT, BILL, CAT, FEATURES, NUMERIC, PAY, d, grid_values, r6,
                              with_panel)
from duck_oracle.features import encoding_exprs, engineered, folded_cols

CHOSEN = ["paysem", "util", "payratio"]
ENCODINGS = {
    "pay_remap": {"pay_remap": True},
    "pay_remap_flags": {"pay_remap": True, "pay_flags": True},
    "bill_clip": {"bill_neg": "clip"},
    "bill_flag": {"bill_neg": "flag"},
    "log1p": {"log1p": True},
    "clean_linear": {"pay_remap": True, "log1p": True, "scale": True, "bill_neg": "clip"},
}
SEEDS = [42, 1, 7, 2024, 99]


def _sa() -> str:
    n_late = " + ".join(f"CASE WHEN {p} >= 1 THEN 1 ELSE 0 END" for p in PAY)
    return (f"(2*({n_late}) + 6*(CASE WHEN PAY_0 >= 1 THEN 1 ELSE 0 END) "
            f"+ 3*(CASE WHEN PAY_0 >= 2 THEN 1 ELSE 0 END)) / 21.0E0")


def _sb() -> str:
    n_duly = " + ".join(f"CASE WHEN {p} <= 0 THEN 1 ELSE 0 END" for p in PAY)
    n_zero = " + ".join(f"CASE WHEN {a} = 0 THEN 1 ELSE 0 END" for a in AMT)
    return (f"(6 - ({n_duly}) + 4*(CASE WHEN PAY_0 >= 1 THEN 1 ELSE 0 END) + ({n_zero}))"
            f" / 16.0E0")


def _sc() -> str:
    return "(ID*7919 % 1000) / 1000.0E0"


SCORES = f"""scores AS (
  SELECT ID, label, 'A' AS model, {_sa()} AS proba FROM dev
  UNION ALL SELECT ID, label, 'B', {_sb()} FROM dev
  UNION ALL SELECT ID, label, 'C', {_sc()} FROM dev)"""

GRID = f"grid AS (SELECT * FROM (VALUES {grid_values()}) g(i, t))"


def folds_cte(seeds, name="folds") -> str:
    parts = [f"""SELECT {s} AS seed, ID, label,
      CAST((ROW_NUMBER() OVER (PARTITION BY label ORDER BY md5(concat('{s}', ':', CAST(ID AS VARCHAR))), ID) - 1) % 5 AS INT) AS fold
      FROM dev""" for s in seeds]
    return f"{name} AS (" + "\nUNION ALL ".join(parts) + ")"


def fscores_cte(seeds) -> str:
    return folds_cte(seeds) + f""",
fscores AS (
  SELECT f.seed, f.fold, s.ID, s.label, s.model, s.proba
  FROM folds f JOIN scores s ON s.ID = f.ID)"""


def f1(tp, fp, fn, tn) -> str:
    def one(a, b, c):
        return (f"(CASE WHEN (2*{a}+{b}+{c}) = 0 THEN 0.0 ELSE CAST(2*{a} AS DOUBLE) / "
                f"CAST(2*{a}+{b}+{c} AS DOUBLE) END)")
    return f"(({one(tn, fn, fp)} + {one(tp, fp, fn)}) / 2.0)"


def _cm(pred: str, y: str = "label") -> str:
    return (f"CAST(SUM(CASE WHEN {pred} AND {y}=1 THEN 1 ELSE 0 END) AS BIGINT) AS tp, "
            f"CAST(SUM(CASE WHEN {pred} AND {y}=0 THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
            f"CAST(SUM(CASE WHEN NOT ({pred}) AND {y}=1 THEN 1 ELSE 0 END) AS BIGINT) AS fn, "
            f"CAST(SUM(CASE WHEN NOT ({pred}) AND {y}=0 THEN 1 ELSE 0 END) AS BIGINT) AS tn")


def _family(groups) -> str:
    cols = ", ".join(f"{r6(e)} AS {n}" for n, e in engineered(groups))
    return with_panel(f"fp AS (SELECT {folded_cols()} FROM panel)",
                      final=f"SELECT ID, {cols} FROM fp")


def _encoding(enc) -> str:
    ex, extra = encoding_exprs(enc)
    cols = [f"{r6(ex[c])} AS {c}" for c in NUMERIC] + [f"{r6(e)} AS {n}" for n, e in extra]
    return with_panel(final=f"SELECT ID, {', '.join(cols)} FROM panel")


def _curve_cte(src="scores", keys=("model",)) -> str:
    k = ", ".join(keys)
    kk = ", ".join(f"s.{x}" for x in keys)
    return f"""curve AS (
  SELECT {kk}, g.i, g.t, {_cm('s.proba >= g.t', 's.label')}
  FROM {src} s, grid g GROUP BY {kk}, g.i, g.t),
curvef AS (SELECT {k}, i, t, tp, fp, fn, tn, {f1('tp', 'fp', 'fn', 'tn')} AS f1 FROM curve)"""


def _transfer_ctes() -> str:
    """Per (model, seed, fold k): best cut on the other folds, naive."""
    return f"""kf AS (SELECT DISTINCT model, seed, fold AS k FROM fscores),
oc AS (
  SELECT kf.model, kf.seed, kf.k, g.i, g.t,
    {_cm('s.proba >= g.t', 's.label')}
  FROM kf JOIN fscores s ON s.model = kf.model AND s.seed = kf.seed AND s.fold <> kf.k, grid g
  GROUP BY kf.model, kf.seed, kf.k, g.i, g.t),
ocf AS (SELECT *, {f1('tp', 'fp', 'fn', 'tn')} AS f1 FROM oc),
kcut AS (SELECT model, seed, k, t FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY model, seed, k ORDER BY f1 DESC, i ASC) AS rn FROM ocf)
  WHERE rn = 1)"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    feats = ", ".join(FEATURES)
    q["a4_features"] = with_panel(final=f"SELECT ID, {feats} FROM dev")
    q["a5_split_xy"] = with_panel(final=f"SELECT ID, {feats}, label FROM dev")
    q["a6_eval_ids"] = with_panel(final="SELECT ID FROM evl")
    q["b1_fold_codes"] = with_panel(
        final="SELECT ID, CASE WHEN EDUCATION IN (0,5,6) THEN 4 ELSE EDUCATION END AS EDUCATION, "
              "CASE WHEN MARRIAGE = 0 THEN 3 ELSE MARRIAGE END AS MARRIAGE FROM panel")
    q["b2_safe_ratio"] = with_panel(
        final=f"SELECT ID, {r6('CASE WHEN BILL_AMT1 > 0 THEN PAY_AMT1 / BILL_AMT1 ELSE 1.0 END')}"
              " AS ratio FROM panel")
    q["b3_nonfinite"] = with_panel(
        final=f"SELECT ID, {r6('CASE WHEN BILL_AMT1 = 0 THEN NULL ELSE PAY_AMT1 / BILL_AMT1 END')}"
              " AS ratio, CAST(CASE WHEN BILL_AMT1 IS NULL OR isinf(exp(BILL_AMT1 / 1000.0)) "
              "THEN 1 ELSE 0 END AS INT) AS exp_dropped FROM panel")
    # Fold -> engineer (raw amounts) -> encode
    ex, _ = encoding_exprs(ENCODINGS["clean_linear"])
    eng = ", ".join(f"{r6(e)} AS {n}" for n, e in engineered(CHOSEN))
    base = ", ".join(f"{r6(ex[c])} AS {c}" for c in FEATURES)
    q["b6_pipeline"] = with_panel(f"fp AS (SELECT {folded_cols()} FROM panel)",
                                  final=f"SELECT ID, {base}, {eng} FROM fp")
    fam = {"c1_pay": ["pay"], "c2_util": ["util"], "c3_payratio": ["payratio"],
           "c4_bill": ["bill"], "c5_paysem": ["paysem"], "c6_coverx": ["coverx"],
           "c7_utilmonths": ["utilmonths"], "c8_payamtratio": ["payamtratio"],
           "c9_stress": ["stress"], "c10_paysem2": ["paysem2"],
           "c11_chosen_combo": ["paysem", "util", "payratio"],
           "c11_all_new": ["paysem", "coverx", "util", "payratio"],
           "c11_paysem_paysem2_util_payratio": ["paysem", "paysem2", "util", "payratio"]}
    # fixed values: feature sets that are named by their families
    named = ["pay", "util", "payratio", "bill", "util_payratio", "pay_util_payratio", "paysem", "coverx", "paysem_payratio",
             "coverx_payratio", "paysem_coverx_payratio", "paysem_util", "paysem_util_coverx_payratio",
             "paysem_util_payratio_bill", "paysem_coverx", "paysem_utilmonths_payratio", "paysem_util_payamtratio",
             "paysem_stress_payratio", "paysem_util_payratio_stress", "paysem2_util_payratio", "paysem_paysem2_payratio",
             "paysem2_stress_payratio"]
    fam |= {f"c11_{n}": n.split("_") for n in named}
    fam |= {"c11_baseline": [], "c11_all": ["pay", "util", "payratio", "bill"]}
    for k, g in fam.items():
        q[k] = _family(g)
    enc = {"d1_pay_remap": "pay_remap", "d2_pay_flags": "pay_remap_flags",
           "d3_bill_clip": "bill_clip", "d4_bill_flag": "bill_flag", "d5_log1p": "log1p"}
    for k, name in enc.items():
        q[k] = _encoding(ENCODINGS[name])

    q["h1_folds"] = with_panel(folds_cte([2024]), final="SELECT ID, label, fold FROM folds")
    q["h1_folds_seeds"] = with_panel(folds_cte(SEEDS), final="SELECT seed, ID, fold FROM folds")

    q["i1_confusion"] = with_panel(SCORES, final=f"""SELECT model,
      CAST(SUM(CASE WHEN proba < 0.5 AND label=0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
      CAST(SUM(CASE WHEN proba >= 0.5 AND label=0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
      CAST(SUM(CASE WHEN proba < 0.5 AND label=1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
      CAST(SUM(CASE WHEN proba >= 0.5 AND label=1 THEN 1 ELSE 0 END) AS BIGINT) AS tp
      FROM scores GROUP BY model""")
    cm = f"cm AS (SELECT model, {_cm('proba >= 0.5')} FROM scores GROUP BY model)"

    def dv(a, b):
        return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"
    rep = f"""rep AS (
      SELECT model, '0' AS class, {dv('tn', 'tn+fn')} AS precision, {dv('tn', 'tn+fp')} AS recall,
        {dv('2*tn', '2*tn+fn+fp')} AS f1, CAST(tn+fp AS DOUBLE) AS support FROM cm
      UNION ALL
      SELECT model, '1', {dv('tp', 'tp+fp')}, {dv('tp', 'tp+fn')}, {dv('2*tp', '2*tp+fp+fn')},
        CAST(tp+fn AS DOUBLE) FROM cm)"""
    q["i2_report"] = with_panel(SCORES, cm, rep, final=f"""
      SELECT model, class, {r6('precision')} AS precision, {r6('recall')} AS recall,
        {r6('f1')} AS f1, support FROM rep
      UNION ALL
      SELECT model, 'macro avg', {r6('AVG(precision)')}, {r6('AVG(recall)')}, {r6('AVG(f1)')},
        SUM(support) FROM rep GROUP BY model
      UNION ALL
      SELECT model, 'weighted avg', {r6('SUM(precision*support)/SUM(support)')},
        {r6('SUM(recall*support)/SUM(support)')}, {r6('SUM(f1*support)/SUM(support)')},
        SUM(support) FROM rep GROUP BY model""")
    q["i3_macro_f1"] = with_panel(SCORES, cm, final=f"SELECT model, "
                                  f"{r6(f1('tp', 'fp', 'fn', 'tn'))} AS macro_f1 FROM cm")
    auc = """auc AS (
      SELECT p.model, SUM(CASE WHEN p.proba > n.proba THEN 2 WHEN p.proba = n.proba THEN 1 ELSE 0 END) AS num2
      FROM scores p JOIN scores n ON p.model = n.model AND p.label = 1 AND n.label = 0
      GROUP BY p.model),
    pn AS (SELECT model, SUM(label) AS P, SUM(1-label) AS N FROM scores GROUP BY model)"""
    q["i4_roc_auc"] = with_panel(SCORES, auc, final=f"""SELECT auc.model,
      {r6('CAST(num2 AS DOUBLE) / (2.0 * P * N)')} AS roc_auc FROM auc JOIN pn USING (model)""")
    ff = f"""ff AS (SELECT model, fold, {f1('tp', 'fp', 'fn', 'tn')} AS m FROM (
      SELECT model, fold, {_cm('proba >= 0.5')} FROM fscores GROUP BY model, fold))"""
    q["i5_fold_f1"] = with_panel(SCORES, fscores_cte([2024]), ff, final=f"""
      SELECT model, {r6('AVG(m)')} AS macro_f1_mean, {r6('STDDEV_POP(m)')} AS macro_f1_std,
        COUNT(*) AS n_folds FROM ff GROUP BY model""")
    q["i6_compare"] = with_panel(SCORES, fscores_cte([2024]), ff, cm, auc, f"""
      fm AS (SELECT model, AVG(m) AS mm, STDDEV_POP(m) AS ms FROM ff GROUP BY model)""",
                                 final=f"""
      SELECT fm.model, {r6('mm')} AS macro_f1_mean, {r6('ms')} AS macro_f1_std,
        {r6('CAST(num2 AS DOUBLE) / (2.0 * P * N)')} AS roc_auc, tn, fp, fn, tp,
        CAST(ROW_NUMBER() OVER (ORDER BY mm DESC, fm.model) AS INT) AS rank
      FROM fm JOIN auc USING (model) JOIN pn USING (model) JOIN cm USING (model)""")
    q["i7_class_balance"] = with_panel(final=f"""SELECT label, COUNT(*) AS n,
      {r6('COUNT(*) / SUM(COUNT(*)) OVER ()')} AS share FROM dev GROUP BY label""")
    q["i8_value_counts"] = with_panel(final=" UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST({c} AS DOUBLE) AS value, COUNT(*) AS n FROM dev WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in CAT))
    q["i9_distinct_codes"] = with_panel(final=" UNION ".join(
        f"SELECT DISTINCT '{c}' AS column, CAST({c} AS DOUBLE) AS value FROM dev WHERE {c} IS NOT NULL"
        for c in PAY))
    hist_parts = []
    for c in ("LIMIT_BAL", "AGE"):
        hist_parts.append(f"""mm_{c} AS (SELECT MIN({d(c)}) AS lo, MAX({d(c)}) AS hi FROM dev),
      b0_{c} AS (SELECT {d(c)} AS x, lo, hi, (hi - lo) / 40.0 AS step,
        LEAST(CAST(FLOOR(({d(c)} - lo) * (40.0 / (hi - lo))) AS INT), 39) AS i0
        FROM dev, mm_{c} WHERE {c} IS NOT NULL),
      b1_{c} AS (SELECT x, lo, hi, step, CASE WHEN x < (CASE WHEN i0 >= 40 THEN hi ELSE lo + i0 * step END)
        THEN i0 - 1 ELSE i0 END AS i1 FROM b0_{c}),
      b2_{c} AS (SELECT lo, hi, CASE WHEN x >= (CASE WHEN i1 + 1 >= 40 THEN hi ELSE lo + (i1 + 1) * step END)
        AND i1 <> 39 THEN i1 + 1 ELSE i1 END AS bin FROM b1_{c})""")
    q["i10_histograms"] = with_panel(*hist_parts, final=" UNION ALL ".join(
        f"SELECT '{c}' AS column, bin, {r6('lo')} AS lo, {r6('hi')} AS hi, COUNT(*) AS n "
        f"FROM b2_{c} GROUP BY bin, lo, hi" for c in ("LIMIT_BAL", "AGE")))
    q["i10_count_plot"] = with_panel(final="SELECT PAY_0, COUNT(*) AS n FROM dev WHERE PAY_0 IS NOT NULL GROUP BY PAY_0")
    allc = ["ID"] + FEATURES + ["label"]
    q["i11_missingness"] = with_panel(final=" UNION ALL ".join(
        f"SELECT COUNT(*) AS n_rows, '{c}' AS column, COUNT(*) - COUNT({c}) AS n_null FROM dev"
        for c in allc) .join(["SELECT * FROM (", ") WHERE n_null > 0"]))
    corr_cols = NUMERIC + ["label"]
    pairs = [(a, b) for i, a in enumerate(corr_cols) for b in corr_cols[i:]]
    q["i12_correlation"] = with_panel(final=" UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'CORR({d(a)}, {d(b)})')} AS corr FROM dev"
        for a, b in pairs))
    q["i13_positive_rate"] = with_panel(SCORES, final=f"""SELECT model, COUNT(*) AS n,
      CAST(SUM(CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
      {r6('AVG(CASE WHEN proba >= 0.5 THEN 1.0 ELSE 0.0 END)')} AS pos_rate
      FROM scores GROUP BY model""")

    # ---- J
    best = """best AS (SELECT * FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY f1 DESC, i ASC) AS rn FROM curvef)
      WHERE rn = 1)"""
    q["j1_best_cut"] = with_panel(SCORES, GRID, _curve_cte(), best, final=f"""
      SELECT model, {r6('t')} AS threshold, {r6('f1')} AS macro_f1 FROM best""")
    q["j2_curve"] = with_panel(SCORES, GRID, _curve_cte(), final=f"""
      SELECT model, CAST(i AS INT) AS i, {r6('t')} AS threshold, {r6('f1')} AS macro_f1,
        {r6('CAST(tp+fp AS DOUBLE) / (tp+fp+fn+tn)')} AS pos_rate, tp, fp, fn, tn FROM curvef""")
    q["j2_sweep_predictions"] = with_panel(final=f"""
      SELECT ID, {r6('c.t')} AS threshold, CAST(CASE WHEN {_sa()} >= c.t THEN 1 ELSE 0 END AS INT)
        AS Predicted FROM evl, (VALUES (0.3), (0.4), (0.5), (0.6)) c(t)""")
    held = f"""held AS (
      SELECT s.model, s.seed, {_cm('s.proba >= kc.t', 's.label')}
      FROM fscores s JOIN kcut kc ON kc.model = s.model AND kc.seed = s.seed AND kc.k = s.fold
      GROUP BY s.model, s.seed)"""
    q["j3_transfer"] = with_panel(SCORES, GRID, fscores_cte(SEEDS), _transfer_ctes(), held,
                                  final=f"""
      SELECT h.model, h.seed, {r6(f1('tp', 'fp', 'fn', 'tn'))} AS transfer_f1,
        {r6('m.a')} AS fold_thr_mean, {r6('m.s')} AS fold_thr_std,
        {r6('m.mn')} AS fold_thr_min, {r6('m.mx')} AS fold_thr_max
      FROM held h JOIN (SELECT model, seed, ((((MAX(CASE WHEN k=0 THEN t END) + MAX(CASE WHEN k=1 THEN t END)) + MAX(CASE WHEN k=2 THEN t END)) + MAX(CASE WHEN k=3 THEN t END)) + MAX(CASE WHEN k=4 THEN t END)) / 5.0 AS a, STDDEV_POP(t) AS s, MIN(t) AS mn,
        MAX(t) AS mx FROM kcut GROUP BY model, seed) m ON m.model = h.model AND m.seed = h.seed""")
    q["j3_transfer_cuts"] = with_panel(SCORES, GRID, fscores_cte([2024]), _transfer_ctes(),
                                       final=f"""
      SELECT kc.model, CAST(kc.k AS INT) AS fold, {r6('kc.t')} AS threshold,
        {_cm('s.proba >= kc.t', 's.label')}
      FROM kcut kc JOIN fscores s ON s.model = kc.model AND s.fold = kc.k
      GROUP BY kc.model, kc.k, kc.t""")
    q["j4_fold_avg"] = with_panel(SCORES, GRID, fscores_cte(SEEDS), _transfer_ctes(), f"""
      avgc AS (SELECT model, seed, ((((MAX(CASE WHEN k=0 THEN t END) + MAX(CASE WHEN k=1 THEN t END)) + MAX(CASE WHEN k=2 THEN t END)) + MAX(CASE WHEN k=3 THEN t END)) + MAX(CASE WHEN k=4 THEN t END)) / 5.0 AS t FROM kcut GROUP BY model, seed),
      fa AS (SELECT s.model, s.seed, a.t, {_cm('s.proba >= a.t', 's.label')}
        FROM fscores s JOIN avgc a ON a.model = s.model AND a.seed = s.seed
        GROUP BY s.model, s.seed, a.t)""", final=f"""
      SELECT model, seed, {r6('t')} AS threshold, {r6(f1('tp', 'fp', 'fn', 'tn'))} AS macro_f1
      FROM fa""")
    perfold = f"""pf AS (
      SELECT s.model, s.seed, s.fold, g.i, g.t, {_cm('s.proba >= g.t', 's.label')}
      FROM fscores s, grid g GROUP BY s.model, s.seed, s.fold, g.i, g.t),
    pf1 AS (SELECT *, {f1('tp', 'fp', 'fn', 'tn')} AS m FROM pf),
    pm AS (SELECT model, seed, i, t, ((((MAX(CASE WHEN fold=0 THEN m END) + MAX(CASE WHEN fold=1 THEN m END))
        + MAX(CASE WHEN fold=2 THEN m END)) + MAX(CASE WHEN fold=3 THEN m END))
        + MAX(CASE WHEN fold=4 THEN m END)) / 5.0 AS f1
      FROM pf1 GROUP BY model, seed, i, t),
    bf AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model, seed
      ORDER BY f1 DESC, i ASC) AS rn FROM pm) WHERE rn = 1)"""
    q["j5_best_fixed"] = with_panel(SCORES, GRID, fscores_cte(SEEDS), perfold, final=f"""
      SELECT model, seed, {r6('t')} AS threshold, {r6('f1')} AS macro_f1 FROM bf""")
    q["j6_summary"] = with_panel(
        SCORES, GRID, fscores_cte(SEEDS), _transfer_ctes(), held, perfold,
        """fsc AS (SELECT s.*, 'x' AS dummy FROM fscores s)""",
        f"""gc AS (SELECT s.model, s.seed, g.i, g.t, {_cm('s.proba >= g.t', 's.label')}
          FROM fscores s, grid g GROUP BY s.model, s.seed, g.i, g.t),
        gb AS (SELECT * FROM (SELECT model, seed, t, {f1('tp', 'fp', 'fn', 'tn')} AS f1,
          ROW_NUMBER() OVER (PARTITION BY model, seed ORDER BY {f1('tp', 'fp', 'fn', 'tn')} DESC, i)
          AS rn FROM gc) WHERE rn = 1),
        avgc AS (SELECT model, seed, ((((MAX(CASE WHEN k=0 THEN t END) + MAX(CASE WHEN k=1 THEN t END)) + MAX(CASE WHEN k=2 THEN t END)) + MAX(CASE WHEN k=3 THEN t END)) + MAX(CASE WHEN k=4 THEN t END)) / 5.0 AS t, MIN(t) AS mn, MAX(t) AS mx FROM kcut
          GROUP BY model, seed),
        fa AS (SELECT s.model, s.seed, {_cm('s.proba >= a.t', 's.label')}
          FROM fscores s JOIN avgc a ON a.model = s.model AND a.seed = s.seed
          GROUP BY s.model, s.seed),
        per AS (SELECT gb.model, gb.seed, gb.f1 AS g, {f1('h.tp', 'h.fp', 'h.fn', 'h.tn')} AS tr,
          {f1('fa.tp', 'fa.fp', 'fa.fn', 'fa.tn')} AS fav, bf.f1 AS bfv, bf.t AS bft,
          avgc.t AS ftm, avgc.mn AS fmn, avgc.mx AS fmx
          FROM gb JOIN held h USING (model, seed) JOIN fa USING (model, seed)
          JOIN bf USING (model, seed) JOIN avgc USING (model, seed))""",
        final=f"""SELECT model, COUNT(*) AS n_seeds,
          {r6('AVG(g)')} AS global_f1_mean, {r6('STDDEV_POP(g)')} AS global_f1_std,
          {r6('AVG(tr)')} AS transfer_f1_mean, {r6('STDDEV_POP(tr)')} AS transfer_f1_std,
          {r6('AVG(fav)')} AS foldavg_f1_mean, {r6('STDDEV_POP(fav)')} AS foldavg_f1_std,
          {r6('AVG(bfv)')} AS bestfixed_f1_mean, {r6('STDDEV_POP(bfv)')} AS bestfixed_f1_std,
          {r6('AVG(g - tr)')} AS penalty, {r6('AVG(bft)')} AS bestfixed_thr_mean,
          {r6('AVG(ftm)')} AS fold_thr_mean, {r6('MIN(fmn)')} AS fold_thr_min,
          {r6('MAX(fmx)')} AS fold_thr_max
          FROM per GROUP BY model""")
    q["j7_segments"] = with_panel(
        "q AS (SELECT quantile_cont(LIMIT_BAL, 1/3) AS q1, quantile_cont(LIMIT_BAL, 2/3) AS q2 FROM dev)",
        final="""
      SELECT ID, 'pay0' AS scheme, CASE WHEN PAY_0 <= 0 THEN 'ontime' WHEN PAY_0 = 1 THEN 'late1'
        ELSE 'late2plus' END AS segment FROM dev
      UNION ALL SELECT ID, 'sex', CASE WHEN SEX = 1 THEN 'male' WHEN SEX = 2 THEN 'female'
        ELSE 'other' END FROM dev
      UNION ALL SELECT ID, 'limit3', CASE WHEN LIMIT_BAL IS NULL THEN 'nan'
        WHEN LIMIT_BAL <= q1 THEN 'low' WHEN LIMIT_BAL <= q2 THEN 'mid' ELSE 'high' END
        FROM dev, q""")
    q["j8_apply_segments"] = with_panel(final=f"""
      SELECT ID, seg AS segment, CAST(CASE WHEN {_sa()} >= COALESCE(c.t, 0.4) THEN 1 ELSE 0 END AS INT)
        AS Predicted
      FROM (SELECT *, CASE WHEN PAY_0 <= 0 THEN 'ontime' WHEN PAY_0 = 1 THEN 'late1'
        ELSE 'late2plus' END AS seg FROM dev) x
      LEFT JOIN (VALUES ('ontime', 0.3), ('late1', 0.55)) c(s, t) ON c.s = x.seg""")
    build_more(q)
    build_k(q)
    build_f(q)
    build_misc(q)
    build_router(q)
    return q


def _devf(groups=CHOSEN, src="dev", name="devf") -> str:
    eng = ", ".join(f"{e} AS {n}" for n, e in engineered(groups))
    return f"{name} AS (SELECT *{', ' + eng if eng else ''} FROM (SELECT {folded_cols()} FROM {src}) z)"


def _best_a_cut() -> str:
    return f"""sa AS (SELECT ID, label, {_sa()} AS proba FROM dev),
    cva AS (SELECT g.i, g.t, {_cm('s.proba >= g.t', 's.label')} FROM sa s, grid g GROUP BY g.i, g.t),
    bca AS (SELECT t FROM cva ORDER BY {f1('tp', 'fp', 'fn', 'tn')} DESC, i ASC LIMIT 1),
    sub AS (SELECT ID AS Id, CAST(CASE WHEN {_sa()} >= (SELECT t FROM bca) THEN 1 ELSE 0 END AS INT)
      AS Predicted FROM evl)"""


def _violations(src: str) -> str:
    return f"""(SELECT
      CAST(SUM(CASE WHEN c.Id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing,
      CAST(SUM(CASE WHEN e.Id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS extra,
      CAST(COALESCE(SUM(CASE WHEN c.c > 1 THEN c.c - 1 END), 0) AS BIGINT) AS dup,
      CAST(COALESCE(SUM(c.bad), 0) AS BIGINT) AS bad_value,
      CAST(COALESCE(SUM(c.c), 0) AS BIGINT) AS n_rows,
      CAST(SUM(CASE WHEN e.Id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_expected
    FROM (SELECT Id, COUNT(*) AS c, SUM(CASE WHEN Predicted NOT IN (0, 1) OR Predicted IS NULL
            THEN 1 ELSE 0 END) AS bad FROM {src} GROUP BY Id) c
    FULL OUTER JOIN (SELECT DISTINCT ID AS Id FROM evl) e ON c.Id = e.Id)"""


def _quote_column(sql: str) -> str:
    """``column`` is reserved in DuckDB: quote every bare use."""
    import re
    return re.sub(r'(?<![\w"])column(?![\w"])', '"column"', sql)


def build_more(q: dict) -> None:
    feats = ", ".join(FEATURES)
    q["a1_load_csv"] = with_panel(final=f"SELECT ID, {feats}, label FROM dev")
    q["a7_submission"] = with_panel(GRID, _best_a_cut(), final="SELECT Id, Predicted FROM sub")
    q["a8_validate"] = with_panel(GRID, _best_a_cut(), """bad_sub AS (
        SELECT Id, CASE WHEN Id = (SELECT MAX(Id) FROM sub) THEN 7 ELSE Predicted END AS Predicted
        FROM (SELECT * FROM sub WHERE Id <> (SELECT MIN(Id) FROM sub)
              UNION ALL SELECT * FROM sub WHERE Id = (SELECT MAX(Id) FROM sub)) x
        UNION ALL SELECT Id + 1, Predicted FROM sub WHERE Id = (SELECT MAX(Id) FROM sub))""",
        final=f"SELECT *, 'written' AS \"case\" FROM {_violations('sub')} "
              f"UNION ALL SELECT *, 'broken' FROM {_violations('bad_sub')}")
    q["a10_emit"] = with_panel(GRID, _best_a_cut(), final=f"""
        SELECT 1 AS n, COUNT(*) AS n_rows, {r6('AVG(CAST(Predicted AS DOUBLE))')} AS pos_rate,
          'scorecard A at the best global cut' AS description FROM sub
        UNION ALL SELECT 2, COUNT(*), 0.0, 'all zeros' FROM sub""")
    eng_names = [n for n, _ in engineered(CHOSEN)]
    cols = NUMERIC + eng_names
    q["e1_medians"] = with_panel(_devf(), final=" UNION ALL ".join(
        f"SELECT '{c}' AS column, {r6(f'quantile_cont({d(c)}, 0.5)')} AS median FROM devf"
        for c in cols))
    mcols = CAT + ["PAY_0"]
    q["e2_modes"] = with_panel(_devf([]), final=" UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS column, CAST({c} AS DOUBLE) AS mode FROM devf "
        f"WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} ASC LIMIT 1)"
        for c in mcols))
    med = "med AS (SELECT " + ", ".join(
        f"quantile_cont({d(c)}, 0.5) AS m_{c}" for c in cols) + " FROM devf)"
    scl = "scl AS (SELECT " + ", ".join(
        f"AVG(COALESCE({d(c)}, med.m_{c})) AS a_{c}, STDDEV_POP(COALESCE({d(c)}, med.m_{c})) AS s_{c}"
        for c in cols) + " FROM devf, med)"
    q["e3_scaler"] = with_panel(_devf(), med, scl, final=" UNION ALL ".join(
        f"SELECT '{c}' AS column, {r6(f'a_{c}')} AS mean, "
        f"{r6(f'CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1.0 ELSE s_{c} END')} AS std FROM scl"
        for c in cols))
    cats = "cats AS (" + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS column, CAST({c} AS DOUBLE) AS category FROM devf "
        f"WHERE {c} IS NOT NULL" for c in CAT) + ")"
    modes = "modes AS (" + " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS column, CAST({c} AS DOUBLE) AS mode FROM devf "
        f"WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} ASC LIMIT 1)"
        for c in CAT) + ")"
    evlong = "evlong AS (" + " UNION ALL ".join(
        f"SELECT ID, '{c}' AS column, CAST({c} AS DOUBLE) AS v FROM evf" for c in CAT) + ")"
    onehot = """oh AS (SELECT e.ID, e.column, c.category,
        CASE WHEN COALESCE(e.v, m.mode) = c.category THEN 1.0E0 ELSE 0.0E0 END AS value
        FROM evlong e JOIN cats c ON c.column = e.column JOIN modes m ON m.column = e.column)"""
    qcol = _quote_column
    q["e4_onehot"] = qcol(with_panel(_devf(), _devf(src="evl", name="evf"), cats, modes, evlong,
                                     onehot, final="SELECT ID, column, category, value FROM oh"))
    num = " UNION ALL ".join(
        f"SELECT ID, '{c}' AS feature, "
        f"{r6(f'(COALESCE({d(c)}, med.m_{c}) - scl.a_{c}) / (CASE WHEN scl.s_{c} IS NULL OR scl.s_{c} = 0 THEN 1.0 ELSE scl.s_{c} END)')}"
        f" AS value FROM evf, med, scl" for c in cols)
    oh_named = ("SELECT ID, column || '_' || CAST(CAST(category AS BIGINT) AS VARCHAR) AS feature, "
                f"{r6('value')} FROM oh")
    q["e5_router"] = qcol(with_panel(_devf(), _devf(src="evl", name="evf"), med, scl, cats,
                                     modes, evlong, onehot, final=f"{num} UNION ALL {oh_named}"))
    # Cross-fitted target encoding
    te = [folds_cte([2024], "tf"),
          "tr AS (SELECT d.ID, d.label, d.SEX, d.EDUCATION, d.MARRIAGE, tf.fold AS te_fold "
          "FROM devf d JOIN tf ON tf.ID = d.ID)",
          "tl AS (" + " UNION ALL ".join(
              f"SELECT ID, te_fold, CAST(label AS DOUBLE) AS y, '{c}' AS column, "
              f"CAST({c} AS DOUBLE) AS value FROM tr" for c in CAT) + ")",
          "g AS (SELECT te_fold, CAST(COUNT(*) AS DOUBLE) AS n, SUM(CAST(label AS DOUBLE)) AS s, "
          "SUM(CAST(label AS DOUBLE) * label) AS ss FROM tr GROUP BY te_fold)",
          "ga AS (SELECT SUM(n) AS n, SUM(s) AS s, SUM(ss) AS ss FROM g)",
          "og AS (SELECT g.te_fold, ga.n - g.n AS gn, ga.s - g.s AS gs, ga.ss - g.ss AS gss FROM g, ga)",
          "cs AS (SELECT column, value, te_fold, CAST(COUNT(*) AS DOUBLE) AS n, SUM(y) AS s, "
          "SUM(y * y) AS ss FROM tl GROUP BY column, value, te_fold)",
          "ct AS (SELECT column, value, SUM(n) AS n, SUM(s) AS s, SUM(ss) AS ss FROM cs "
          "GROUP BY column, value)"]

    def enc(n, s_, ss, gn, gs, gss):
        mc = f"(({s_}) / ({n}))"
        vc = f"(({ss}) / ({n}) - {mc} * {mc})"
        gm = f"(({gs}) / ({gn}))"
        gv = f"(({gss}) / ({gn}) - {gm} * {gm})"
        den = f"({gv} * ({n}) + {vc})"
        return (f"(CASE WHEN ({n}) IS NULL OR ({n}) = 0 OR {den} = 0 THEN {gm} ELSE "
                f"({gv} * ({n}) / {den}) * {mc} + (1.0 - ({gv} * ({n}) / {den})) * {gm} END)")
    te.append(f"""tre AS (SELECT l.ID, l.column, {enc('ct.n - COALESCE(cs.n, 0)', 'ct.s - COALESCE(cs.s, 0)', 'ct.ss - COALESCE(cs.ss, 0)', 'og.gn', 'og.gs', 'og.gss')} AS enc
        FROM tl l JOIN ct ON ct.column = l.column AND ct.value = l.value
        LEFT JOIN cs ON cs.column = l.column AND cs.value = l.value AND cs.te_fold = l.te_fold
        JOIN og ON og.te_fold = l.te_fold)""")
    te.append("el AS (" + " UNION ALL ".join(
        f"SELECT ID, '{c}' AS column, CAST({c} AS DOUBLE) AS value FROM evf" for c in CAT) + ")")
    te.append(f"""nee AS (SELECT e.ID, e.column, CASE WHEN ct.n IS NULL THEN ga.s / ga.n ELSE
        {enc('ct.n', 'ct.s', 'ct.ss', 'ga.n', 'ga.s', 'ga.ss')} END AS enc
        FROM el e LEFT JOIN ct ON ct.column = e.column AND ct.value = e.value, ga)""")
    piv = ", ".join(f"{r6(f'MAX(CASE WHEN column = {chr(39)}{c}{chr(39)} THEN enc END)')} AS {c}"
                    for c in CAT)
    q["e6_target_encoding"] = qcol(with_panel(
        _devf([]), _devf([], src="evl", name="evf"), *te,
        final=f"SELECT ID, 'train' AS part, {piv} FROM tre GROUP BY ID "
              f"UNION ALL SELECT ID, 'new', {piv} FROM nee GROUP BY ID"))


def _kscores() -> list[str]:
    hu = ("CAST(('0x' || substr(md5('dummy:' || CAST(f.seed AS VARCHAR) || ':' || "
          "CAST(f.ID AS VARCHAR)), 1, 13)) AS BIGINT) / 4503599627370496.0")
    return [folds_cte(SEEDS), """fs AS (SELECT seed, fold, COUNT(*) AS n, SUM(label) AS p
        FROM folds GROUP BY seed, fold)""",
            """ft AS (SELECT seed, SUM(n) AS tn, SUM(p) AS tp FROM fs GROUP BY seed)""",
            """pr AS (SELECT fs.seed, fs.fold, CAST(ft.tp - fs.p AS DOUBLE) / CAST(ft.tn - fs.n AS DOUBLE)
        AS prior FROM fs JOIN ft USING (seed))""",
            f"""ks AS (
        SELECT f.seed, f.fold, s.ID, s.label, s.model, s.proba FROM folds f JOIN scores s ON s.ID = f.ID
        UNION ALL
        SELECT f.seed, f.fold, f.ID, f.label, 'dummy', CASE WHEN {hu} < pr.prior THEN 1.0E0 ELSE 0.0E0 END
        FROM folds f JOIN pr ON pr.seed = f.seed AND pr.fold = f.fold)"""]


def _ens(ens: dict, src="ks", name="ens") -> str:
    spec = " UNION ALL ".join(f"SELECT '{e}' AS ensemble, '{m}' AS member, {i} AS idx, {len(ms)} AS sz"
                              for e, ms in ens.items() for i, m in enumerate(ms))
    n = max(len(ms) for ms in ens.values())
    terms = " + ".join(f"MAX(CASE WHEN idx = {i} THEN proba END)" for i in range(n))
    # sum in member order: ((p0 + p1) + p2)...
    nested = "MAX(CASE WHEN idx = 0 THEN proba END)"
    for i in range(1, n):
        nested = f"({nested} + COALESCE(MAX(CASE WHEN idx = {i} THEN proba END), 0))"
    del terms
    return f"""spec AS ({spec}),
    {name} AS (SELECT x.seed, x.fold, x.ID, x.label, sp.ensemble AS model, {nested} / MAX(sp.sz) AS proba
      FROM {src} x JOIN spec sp ON sp.member = x.model
      GROUP BY sp.ensemble, x.seed, x.fold, x.ID, x.label HAVING COUNT(*) = MAX(sp.sz))"""


def _best_by(src: str, keys: str, name: str) -> str:
    return f"""{name}_c AS (SELECT {", ".join("s." + k.strip() for k in keys.split(","))}, g.i, g.t,
        {_cm('s.proba >= g.t', 's.label')} FROM {src} s, grid g GROUP BY {", ".join("s." + k.strip() for k in keys.split(","))}, g.i, g.t),
    {name} AS (SELECT * FROM (SELECT *, {f1('tp', 'fp', 'fn', 'tn')} AS f1, ROW_NUMBER() OVER (
        PARTITION BY {keys} ORDER BY {f1('tp', 'fp', 'fn', 'tn')} DESC, i ASC) AS rn FROM {name}_c) WHERE rn = 1)"""


def build_k(q: dict) -> None:
    ks = _kscores()
    q["k1_softvote"] = with_panel(SCORES, *ks, _ens({"AB": ["A", "B"]}),
                                  final=f"SELECT seed, fold, ID, label, model, {r6('proba')} AS proba FROM ens")
    kens = {"AB": ["A", "B"], "ABC": ["A", "B", "C"], "A_dummy": ["A", "dummy"],
            "A_missing": ["A", "Z"]}
    q["k2_named_ensembles"] = with_panel(SCORES, GRID, *ks, _ens(kens), _best_by("ens", "model, seed", "kb"),
                                         final=f"SELECT model, seed, {r6('t')} AS threshold, {r6('f1')} AS macro_f1 FROM kb")
    order = " UNION ALL ".join(f"SELECT {sd} AS seed, {i} AS seed_idx" for i, sd in enumerate(SEEDS))
    q["k3_seed_average"] = with_panel(SCORES, *ks, f"so AS ({order})", final=f"""
      SELECT model, ID, label, CAST(ROW_NUMBER() OVER w AS BIGINT) AS n_seeds,
        {r6('SUM(proba) OVER w / ROW_NUMBER() OVER w')} AS proba
      FROM ks JOIN so USING (seed)
      WINDOW w AS (PARTITION BY model, ID, label ORDER BY seed_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
    q["k7_diversity"] = with_panel(SCORES, GRID, *ks, _best_by("ks", "model, seed", "kb"), """
      hard AS (SELECT ks.*, CASE WHEN ks.proba >= kb.t THEN 1 ELSE 0 END AS h FROM ks
        JOIN kb ON kb.model = ks.model AND kb.seed = ks.seed)""", final=f"""
      SELECT b.model, b.seed, {r6('CORR(a.proba, b.proba)')} AS corr,
        {r6('AVG(CASE WHEN a.h <> b.h THEN 1.0 ELSE 0.0 END)')} AS disagreement
      FROM hard b JOIN hard a ON a.model = 'A' AND a.seed = b.seed AND a.ID = b.ID
      WHERE b.model <> 'A' GROUP BY b.model, b.seed""")
    allm = "allm AS (SELECT seed, fold, ID, label, model, proba FROM ks UNION ALL SELECT * FROM ens)"
    q["k12_screen"] = with_panel(SCORES, GRID, *ks, _ens({"AB": ["A", "B"]}), allm,
                                 _best_by("allm", "model, seed", "kb"), final=f"""
      SELECT b.model, {r6('b.f1')} AS macro_f1, {r6('a.f1')} AS anchor_f1, {r6('b.f1 - a.f1')} AS delta,
        b.f1 - a.f1 > 0 AS promising
      FROM kb b JOIN kb a ON a.model = 'A' AND a.seed = b.seed WHERE b.model <> 'A' AND b.seed = 2024""")
    n = len(SEEDS)

    def om(col):
        nested = f"MAX(CASE WHEN seed_idx = 0 THEN {col} END)"
        for i in range(1, n):
            nested = f"({nested} + MAX(CASE WHEN seed_idx = {i} THEN {col} END))"
        return f"({nested} / {float(n)})"
    q["k13_paired"] = with_panel(SCORES, GRID, *ks, _ens({"AB": ["A", "B"]}), allm,
                                 _best_by("allm", "model, seed", "kb"), f"so AS ({order})", f"""
      c AS (SELECT b.model, so.seed_idx, b.f1, b.f1 - a.f1 AS d FROM kb b
        JOIN kb a ON a.model = 'A' AND a.seed = b.seed JOIN so ON so.seed = b.seed WHERE b.model <> 'A'),
      g AS (SELECT model, {om('f1')} AS f1_mean, STDDEV_POP(f1) AS f1_std, {om('d')} AS dmean,
        COUNT(CASE WHEN d > 0 THEN 1 END) AS wins, COUNT(*) AS n_seeds FROM c GROUP BY model),
      rk AS (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY dmean DESC, wins DESC, model DESC) AS INT) AS rank FROM g),
      rc AS (SELECT *, ROW_NUMBER() OVER (ORDER BY CASE WHEN wins = {n} THEN dmean END DESC NULLS LAST, rank) AS r FROM rk)""",
                                 final=f"""
      SELECT model, {r6('f1_mean')} AS f1_mean, {r6('f1_std')} AS f1_std, {r6('dmean')} AS dmean, wins, n_seeds,
        CASE WHEN wins = {n} AND dmean >= 0.005 THEN 'KEEP (robust)'
             WHEN wins = {n} AND dmean > 0 THEN 'keep? (robust but small)'
             WHEN dmean > 0 THEN 'watch (not all seeds)' ELSE 'revert' END AS verdict,
        rank, (r = 1 AND wins = {n}) AS recommended FROM rc""")


def _rs_ctes() -> list[str]:
    """Dev rows in the sampler space: median-imputed numerics, folded categoricals."""
    med = "rmed AS (SELECT " + ", ".join(
        f"quantile_cont({d(c)}, 0.5) AS m_{c}" for c in NUMERIC) + " FROM devf)"
    cols = ", ".join(f"COALESCE({d(c)}, rmed.m_{c}) AS {c}" for c in NUMERIC)
    return [_devf([]), med, f"rx AS (SELECT ID, label, SEX, EDUCATION, MARRIAGE, {cols} FROM devf, rmed)"]


def _dist2(a="a", b="b") -> str:
    num = " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in NUMERIC)
    cat = " + ".join(f"CASE WHEN {a}.{c} <> {b}.{c} THEN 2.0 ELSE 0.0 END" for c in CAT)
    return f"({num} + {cat})"


def build_f(q: dict) -> None:
    rs = _rs_ctes()
    q["f1_undersample"] = with_panel(*rs, """cnt AS (SELECT label, COUNT(*) AS n FROM rx GROUP BY label),
      mino AS (SELECT label, n FROM cnt ORDER BY n ASC, label ASC LIMIT 1),
      rk AS (SELECT ID, label, ROW_NUMBER() OVER (PARTITION BY label ORDER BY md5(concat('2024', ':', CAST(ID AS VARCHAR))), ID) - 1 AS r FROM rx)""",
                                     final="SELECT ID, label FROM rk WHERE label = (SELECT label FROM mino) OR r < (SELECT n FROM mino)")
    q["f7_knn"] = with_panel(*rs, f"""pairs AS (SELECT a.ID AS ID, b.ID AS neighbor, {_dist2()} AS d2
        FROM rx a JOIN rx b ON a.ID <> b.ID),
      rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY ID ORDER BY d2, neighbor) AS rank FROM pairs)""",
                             final="SELECT ID, neighbor, CAST(rank AS INT) AS rank, ROUND(SQRT(d2), 3) AS dist FROM rk WHERE rank <= 5")
    nn1 = f"""p1 AS (SELECT a.ID AS qid, b.ID AS nid, {_dist2()} AS d2 FROM rx a JOIN rx b ON a.ID <> b.ID),
      n1 AS (SELECT qid, nid FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY qid ORDER BY d2, nid) AS r FROM p1) WHERE r = 1),
      links AS (SELECT x.qid AS a, x.nid AS b, la.label AS la, lb.label AS lb FROM n1 x
        JOIN n1 y ON y.qid = x.nid AND y.nid = x.qid
        JOIN rx la ON la.ID = x.qid JOIN rx lb ON lb.ID = x.nid
        WHERE x.qid < x.nid AND la.label <> lb.label)"""
    q["f4_tomek_links"] = with_panel(*rs, nn1, final="SELECT a, b, la, lb FROM links")
    q["f4_tomek"] = with_panel(*rs, nn1, """cnt AS (SELECT label, COUNT(*) AS n FROM rx GROUP BY label),
      majo AS (SELECT label FROM cnt ORDER BY n DESC, label DESC LIMIT 1),
      gone AS (SELECT CASE WHEN la = (SELECT label FROM majo) THEN a ELSE b END AS ID FROM links)""",
                               final="SELECT ID, label FROM rx WHERE ID NOT IN (SELECT ID FROM gone)")


def build_misc(q: dict) -> None:
    q["h4_oof_cache"] = with_panel(SCORES, *_kscores(), final="""SELECT CAST(seed AS INT) AS seed,
      fold, ID, label, model, proba FROM ks WHERE model = 'dummy'""")
    q["j9_segment_hist"] = with_panel(GRID, _best_a_cut(), f"""seg AS (SELECT ID, label, {_sa()} AS proba,
        CASE WHEN PAY_0 <= 0 THEN 'ontime' WHEN PAY_0 = 1 THEN 'late1' ELSE 'late2plus' END AS segment FROM dev),
      b AS (SELECT segment, label, CAST((SELECT COUNT(*) FROM grid WHERE grid.t <= seg.proba) AS INT) AS bin,
        CAST(CASE WHEN proba >= (SELECT t FROM bca) THEN 1 ELSE 0 END AS INT) AS ge_global FROM seg)""",
                                      final="""SELECT segment, bin, ge_global, CAST(SUM(label) AS BIGINT) AS n_pos,
        CAST(SUM(1 - label) AS BIGINT) AS n_neg FROM b GROUP BY segment, bin, ge_global""")
    hu = ("CAST(('0x' || substr(md5('dummy:2024:' || CAST(f.ID AS VARCHAR)), 1, 13)) AS BIGINT)"
          " / 4503599627370496.0")
    q["g1_dummy_oof"] = with_panel(folds_cte([2024]), """fs AS (SELECT fold, COUNT(*) AS n, SUM(label) AS p FROM folds GROUP BY fold),
      pr AS (SELECT fold, CAST((SELECT SUM(p) FROM fs) - p AS DOUBLE) / CAST((SELECT SUM(n) FROM fs) - n AS DOUBLE) AS prior FROM fs)""",
                                   final=f"""SELECT f.ID, f.label, f.fold, CASE WHEN {hu} < pr.prior THEN 1.0E0 ELSE 0.0E0 END AS proba
      FROM folds f JOIN pr ON pr.fold = f.fold""")
    q["g9_class_weights"] = with_panel(final=f"""SELECT label, {r6('(SELECT COUNT(*) FROM dev) / (2.0 * COUNT(*))')} AS weight
      FROM dev GROUP BY label""")


def _router_sql(enc: dict, groups=()) -> str:
    """Oracle for encode -> impute [+ scale] -> one-hot, long output on eval rows."""
    ex, extra = encoding_exprs(enc)
    eng = engineered(groups)
    numeric = NUMERIC + [n for n, _ in extra] + [n for n, _ in eng]

    def src(name, frm):
        cols = ["ID"] + [f"{ex[c]} AS {c}" if c in NUMERIC else c for c in FEATURES]
        cols += [f"{e} AS {n}" for n, e in extra]
        return f"{name} AS (SELECT {', '.join(cols)} FROM {frm})"
    ctes = [_devf(list(groups), name="d0"), _devf(list(groups), src="evl", name="e0"),
            src("devx", "d0"), src("evx", "e0")]
    med = "med AS (SELECT " + ", ".join(f"quantile_cont({d(c)}, 0.5) AS m_{c}" for c in numeric) + " FROM devx)"
    ctes.append(med)
    scale = enc.get("scale", True)
    if scale:
        ctes.append("scl AS (SELECT " + ", ".join(
            f"AVG(COALESCE({d(c)}, med.m_{c})) AS a_{c}, STDDEV_POP(COALESCE({d(c)}, med.m_{c})) AS s_{c}"
            for c in numeric) + " FROM devx, med)")
    ctes.append("cats AS (" + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS column, CAST({c} AS DOUBLE) AS category FROM devx WHERE {c} IS NOT NULL"
        for c in CAT) + ")")
    ctes.append("modes AS (" + " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS column, CAST({c} AS DOUBLE) AS mode FROM devx "
        f"WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} ASC LIMIT 1)" for c in CAT) + ")")
    ctes.append("evlong AS (" + " UNION ALL ".join(
        f"SELECT ID, '{c}' AS column, CAST({c} AS DOUBLE) AS v FROM evx" for c in CAT) + ")")
    ctes.append("""oh AS (SELECT e.ID, e.column, c.category,
        CASE WHEN COALESCE(e.v, m.mode) = c.category THEN 1.0E0 ELSE 0.0E0 END AS value
        FROM evlong e JOIN cats c ON c.column = e.column JOIN modes m ON m.column = e.column)""")
    parts = []
    for c in numeric:
        v = f"COALESCE({d(c)}, med.m_{c})"
        if scale:
            v = f"({v} - scl.a_{c}) / (CASE WHEN scl.s_{c} IS NULL OR scl.s_{c} = 0 THEN 1.0 ELSE scl.s_{c} END)"
        parts.append(f"SELECT ID, '{c}' AS feature, {r6(v)} AS value FROM evx, med{', scl' if scale else ''}")
    parts.append("SELECT ID, column || '_' || CAST(CAST(category AS BIGINT) AS VARCHAR) AS feature, "
                 f"{r6('value')} FROM oh")
    return _quote_column(with_panel(*ctes, final=" UNION ALL ".join(parts)))


def build_router(q: dict) -> None:
    q["d6_scale"] = _router_sql(ENCODINGS.get("baseline", {}))
    q["d7_clean_linear"] = _router_sql(ENCODINGS["clean_linear"])
