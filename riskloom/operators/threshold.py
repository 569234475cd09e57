"""Decision-threshold operators (J1–J11) over a long score table.

Input: any DataFrame with a score column (``proba``), the 0/1 ``label`` and group
keys (e.g. ``model``, ``seed``; ``fold`` / ``segment`` where needed). Every
operator does ONE aggregation over the rows (the histogram) and then works on
<= 182 cells per group. FOLD-AVG and segmented prediction re-score rows at
off-grid cuts with a join against a per-group table whose size is bounded by the
number of groups, not rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom import config
from riskloom.operators.cuts import (GRID, N_CUTS, class_counts, grid_at, macro_f1,
                                     pick_best, suffix_counts)

# ------------------------------------------------------------------- J1 / J2


def ordered_mean(order: str, value: str):
    """Mean summed in ``order`` (numpy's sequential order for short vectors), so the
    result is bit-stable regardless of how Spark merged partial aggregates."""
    lst = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(value).alias("v"))))
    return F.aggregate(lst, F.lit(0.0), lambda acc, x: acc + x["v"]) / F.size(lst)


def threshold_curve(scored: DataFrame, keys=(), score: str = "proba",
                    label: str = "label") -> DataFrame:
    """Macro-F1, positive rate and confusion counts at each of the 181 cuts."""
    keys = list(keys)
    c = suffix_counts(class_counts(scored, keys, score, label), keys)
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("pos") - tp, F.col("neg") - fp
    return c.select(*keys, "i", grid_at(F.col("i")).alias("threshold"),
                    macro_f1(tp, fp, fn, tn).alias("macro_f1"),
                    ((tp + fp) / (F.col("pos") + F.col("neg"))).alias("pos_rate"),
                    "tp", "fp", fn.alias("fn"), tn.alias("tn"))


def best_threshold(scored: DataFrame, keys=(), score: str = "proba",
                   label: str = "label") -> DataFrame:
    """J1 (GLOBAL): the cut with the highest macro-F1, lowest cut on ties."""
    keys = list(keys)
    curve = threshold_curve(scored, keys, score, label)
    return pick_best(curve, keys, carry=("threshold",)).select(
        *keys, "threshold", "macro_f1")


def sweep_predictions(scored: DataFrame, cuts, score: str = "proba",
                      id_col: str = "ID") -> DataFrame:
    """J2 predictions: one prediction set per listed cut from one scored table."""
    arr = F.array(*[F.lit(float(c)) for c in cuts])
    return scored.select(id_col, F.explode(arr).alias("threshold"), score) \
        .select(id_col, "threshold",
                (F.col(score) >= F.col("threshold")).cast("int").alias("Predicted"))


# ---------------------------------------------------------- J3 / J4 / J5 / J6


def _fold_cells(scored: DataFrame, keys, score, label, fold, hist: DataFrame | None = None):
    """Rows (keys, k, i) with other-fold F1 and own-fold counts at cut i.

    Own-fold counts are window suffix sums per (keys, fold); all-fold counts are a
    sum over folds per (keys, cut); "other" = all - own. No row is re-read.
    """
    if hist is None:
        hist = class_counts(scored, keys, score, label, extra=[fold])
    own = suffix_counts(hist, [*keys, fold])
    pk = keys if keys else [F.lit(0)]
    wk = Window.partitionBy(*pk, "i")
    c = own.select(*keys, F.col(fold).alias("k"), "i", "tp", "fp", "pos", "neg",
                   F.sum("tp").over(wk).alias("atp"), F.sum("fp").over(wk).alias("afp"),
                   F.sum("pos").over(wk).alias("apos"), F.sum("neg").over(wk).alias("aneg"))
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("pos") - tp, F.col("neg") - fp
    otp, ofp = F.col("atp") - tp, F.col("afp") - fp
    ofn = (F.col("apos") - F.col("pos")) - otp
    otn = (F.col("aneg") - F.col("neg")) - ofp
    return c.select(*keys, "k", "i", grid_at(F.col("i")).alias("threshold"),
                    macro_f1(otp, ofp, ofn, otn).alias("other_f1"),
                    tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))


def transfer_cuts(scored: DataFrame, keys=(), score="proba", label="label",
                  fold="fold") -> DataFrame:
    """Per (group, fold k): the cut tuned on the other folds and fold k's counts at it."""
    keys = list(keys)
    cells = _fold_cells(scored, keys, score, label, fold)
    return pick_best(cells, [*keys, "k"], f1="other_f1",
                     carry=("threshold", "tp", "fp", "fn", "tn"))


def transfer_f1(scored: DataFrame, keys=(), score="proba", label="label",
                fold="fold") -> DataFrame:
    """J3 (TRANSFER): pooled macro-F1 of held-out folds at their transferred cuts."""
    keys = list(keys)
    t = transfer_cuts(scored, keys, score, label, fold)
    s = t.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")],
                             ordered_mean("k", "threshold").alias("fold_thr_mean"),
                             F.stddev_pop("threshold").alias("fold_thr_std"),
                             F.min("threshold").alias("fold_thr_min"),
                             F.max("threshold").alias("fold_thr_max"))
    return s.select(*keys, macro_f1(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
                    .alias("transfer_f1"),
                    "fold_thr_mean", "fold_thr_std", "fold_thr_min", "fold_thr_max")


def macro_f1_at(scored: DataFrame, cuts: DataFrame, keys=(), score="proba",
                label="label", cut_col="threshold") -> DataFrame:
    """Macro-F1 of each group at its own (possibly off-grid) cut.

    ``cuts`` has one row per group, so the join side is bounded by the number of
    groups; AQE broadcasts it when small and falls back to a shuffle join otherwise.
    """
    keys = list(keys)
    if not keys:  # a single group: the cut is one scalar
        cut = cuts.select(cut_col).first()[0]
        j = scored.withColumn(cut_col, F.lit(float(cut)))
    else:
        j = scored.join(cuts.select(*keys, cut_col), on=keys, how="inner")
    pred = F.col(score) >= F.col(cut_col)
    y = F.col(label) == 1
    agg = j.groupBy(*keys, cut_col).agg(
        F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))
    return agg.select(*keys, cut_col, macro_f1(F.col("tp"), F.col("fp"), F.col("fn"),
                                               F.col("tn")).alias("macro_f1"))


def fold_avg_f1(scored: DataFrame, keys=(), score="proba", label="label",
                fold="fold") -> DataFrame:
    """J4 (FOLD-AVG): mean of the per-fold transferred cuts, scored on every row."""
    keys = list(keys)
    t = transfer_cuts(scored, keys, score, label, fold)
    avg = t.groupBy(*keys).agg(ordered_mean("k", "threshold").alias("threshold"))
    return macro_f1_at(scored, avg, keys, score, label)


def best_fixed(scored: DataFrame, keys=(), score="proba", label="label",
               fold="fold") -> DataFrame:
    """J5 (BEST-FIXED): the grid cut with the best mean per-fold macro-F1."""
    keys = list(keys)
    cells = _fold_cells(scored, keys, score, label, fold)
    per = cells.select(*keys, "k", "i", "threshold",
                       macro_f1(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")).alias("f1"))
    # mean over folds summed in fold order (numpy's order), so near-ties are stable
    ordered = F.array_sort(F.collect_list(F.struct(F.col("k"), F.col("f1"))))
    mean = per.groupBy(*keys, "i", "threshold").agg(ordered.alias("fs")).select(
        *keys, "i", "threshold",
        (F.aggregate("fs", F.lit(0.0), lambda acc, x: acc + x["f1"]) / F.size("fs"))
        .alias("macro_f1"))
    return pick_best(mean, keys, carry=("threshold",)).select(*keys, "threshold", "macro_f1")


def evaluate_strategies(scored: DataFrame, keys=(), score="proba", label="label",
                        fold="fold") -> DataFrame:
    """GLOBAL / TRANSFER / FOLD-AVG / BEST-FIXED per group (one row each).

    The (keys, fold, bin) histogram is built ONCE and cached (it is tiny); GLOBAL,
    TRANSFER and BEST-FIXED all derive from it, and only FOLD-AVG's off-grid cut
    needs a second pass over the rows.
    """
    keys = list(keys)
    if not keys:  # one group: give it a key so the per-group tables join on it
        out = evaluate_strategies(scored.withColumn("_g", F.lit(0)), ["_g"], score, label, fold)
        return out.drop("_g")
    hist = class_counts(scored, keys, score, label, extra=[fold]).cache()
    glob = hist.groupBy(*keys, "bin").agg(F.sum("n_pos").alias("n_pos"),
                                          F.sum("n_neg").alias("n_neg"))
    c = suffix_counts(glob, keys)
    tp, fp = F.col("tp"), F.col("fp")
    curve = c.select(*keys, "i", grid_at(F.col("i")).alias("threshold"),
                     macro_f1(tp, fp, F.col("pos") - tp, F.col("neg") - fp).alias("macro_f1"))
    g = pick_best(curve, keys, carry=("threshold",)).select(
        *keys, F.col("threshold").alias("global_thr"), F.col("macro_f1").alias("global_f1"))
    cells = _fold_cells(scored, keys, score, label, fold, hist).cache()
    tc = pick_best(cells, [*keys, "k"], f1="other_f1",
                   carry=("threshold", "tp", "fp", "fn", "tn"))
    t = tc.groupBy(*keys).agg(*[F.sum(x).alias(x) for x in ("tp", "fp", "fn", "tn")],
                              ordered_mean("k", "threshold").alias("fold_thr_mean"),
                              F.stddev_pop("threshold").alias("fold_thr_std"),
                              F.min("threshold").alias("fold_thr_min"),
                              F.max("threshold").alias("fold_thr_max")) \
        .select(*keys, macro_f1(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
                .alias("transfer_f1"), "fold_thr_mean", "fold_thr_std", "fold_thr_min",
                "fold_thr_max")
    avg = tc.groupBy(*keys).agg(ordered_mean("k", "threshold").alias("threshold"))
    fa = macro_f1_at(scored, avg, keys, score, label) \
        .withColumnRenamed("threshold", "foldavg_thr").withColumnRenamed("macro_f1", "foldavg_f1")
    per = cells.select(*keys, "k", "i", "threshold",
                       macro_f1(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")).alias("f1"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("k"), F.col("f1"))))
    mean = per.groupBy(*keys, "i", "threshold").agg(ordered.alias("fs")).select(
        *keys, "i", "threshold",
        (F.aggregate("fs", F.lit(0.0), lambda acc, x: acc + x["f1"]) / F.size("fs"))
        .alias("macro_f1"))
    bf = pick_best(mean, keys, carry=("threshold",)).select(
        *keys, F.col("threshold").alias("bestfixed_thr"), F.col("macro_f1").alias("bestfixed_f1"))
    return g.join(t, keys).join(fa, keys).join(bf, keys)


def strategy_summary(strategies: DataFrame, keys=(), over: str = "seed") -> DataFrame:
    """Means +- std_pop over seeds, GLOBAL-TRANSFER penalty, cut spread."""
    keys = [k for k in keys if k != over]
    s = strategies
    out = [F.count(F.lit(1)).alias("n_seeds")]
    for c in ("global_f1", "transfer_f1", "foldavg_f1", "bestfixed_f1"):
        out += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    out += [F.avg(F.col("global_f1") - F.col("transfer_f1")).alias("penalty"),
            F.avg("bestfixed_thr").alias("bestfixed_thr_mean"),
            F.avg("fold_thr_mean").alias("fold_thr_mean"),
            F.min("fold_thr_min").alias("fold_thr_min"),
            F.max("fold_thr_max").alias("fold_thr_max")]
    return s.groupBy(*keys).agg(*out)


# ------------------------------------------------------------------ J7 / J8


def make_segments(df: DataFrame, kind: str, edges: tuple[float, float] | None = None,
                  out: str = "segment") -> DataFrame:
    """Segment label per row — ``pay0`` / ``sex`` / ``limit3``.

    ``limit3`` uses exact interpolated terciles with right-closed bins; pass the
    ``edges`` fitted on the development rows to apply them to other rows
    (``refit_edges`` behaviour = call without ``edges`` on the new frame).
    """
    if kind == "pay0":
        p = F.col("PAY_0")
        seg = F.when(p <= 0, "ontime").when(p == 1, "late1").otherwise("late2plus")
    elif kind == "sex":
        s = F.col("SEX")
        seg = F.when(s == 1, "male").when(s == 2, "female").otherwise("other")
    elif kind == "limit3":
        if edges is None:
            edges = tercile_edges(df)
        x = F.col("LIMIT_BAL")
        seg = (F.when(x.isNull(), "nan").when(x <= F.lit(edges[0]), "low")
               .when(x <= F.lit(edges[1]), "mid").otherwise("high"))
    else:
        raise ValueError(f"unknown segmentation {kind!r}; known: ['pay0', 'sex', 'limit3']")
    return df.withColumn(out, seg)


def tercile_edges(df: DataFrame, col: str = "LIMIT_BAL") -> tuple[float, float]:
    from riskloom.operators.stats import exact_quantiles
    q = exact_quantiles(df, [col], [1.0 / 3.0, 2.0 / 3.0])[col]
    return float(q[0]), float(q[1])


def apply_segment_thresholds(scored: DataFrame, cuts: DataFrame, global_thr: float,
                             score: str = "proba", segment: str = "segment",
                             out: str = "Predicted") -> DataFrame:
    """Per-segment cut with the global fallback (left join to a per-segment table)."""
    j = scored.join(cuts.select(segment, F.col("threshold").alias("_cut")), segment, "left")
    cut = F.coalesce(F.col("_cut"), F.lit(float(global_thr)))
    return j.withColumn(out, (F.col(score) >= cut).cast("int")).drop("_cut")


# ------------------------------------------------------------- J9 / J10 / J11


def segment_hist(scored: DataFrame, keys=(), score="proba", label="label",
                 segment="segment", global_thr: float | None = None) -> DataFrame:
    """hist(keys, segment, bin, ge_global) — the only job over rows for J9/J10."""
    extra = [segment]
    s = scored
    if global_thr is not None:
        s = s.withColumn("ge_global", (F.col(score) >= F.lit(float(global_thr))).cast("int"))
        extra.append("ge_global")
    return class_counts(s, list(keys), score, label, extra=extra)


def _f1(tp, fp, fn, tn):
    """Macro-F1 of counts or arrays of counts; an empty class scores 0."""
    def one(a, b, c):
        d = np.asarray(2.0 * a + b + c)
        return np.divide(2.0 * a, d, out=np.zeros_like(d), where=d > 0)
    return (one(tn, fn, fp) + one(tp, fp, fn)) / 2.0


def _reach(cells, bins=N_CUTS + 1):
    """(2, N_CUTS): positives and negatives that reach each cut, from (bin, p, q) cells."""
    table = np.zeros((2, bins))
    for b, p, q in cells:
        table[:, b] += p, q
    return table[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:]


def segment_cuts(cells: dict, start: dict, global_thr: float,
                 min_support: int = config.SEGMENT_MIN_SUPPORT,
                 max_passes: int = config.SEGMENT_MAX_PASSES) -> dict:
    """Cuts of the segments with enough rows that raise the macro-F1 of all rows.

    ``cells``: segment -> list of (bin, positives, negatives); ``start``: segment ->
    (positives, negatives) at or above the global cut, where every segment begins. For one
    segment the score of every cut is one vector: what the others predict now plus what
    the segment reaches. Going up the grid, a cut replaces the one held if it is better by
    more than IMPROVE_EPS. Segments take turns until a whole turn changes nothing.
    """
    names = sorted(cells)
    totals = {s: np.sum([(p, q) for _, p, q in cells[s]], axis=0) for s in names}
    everyone = sum(totals.values())
    options = {s: _reach(cells[s]) for s in names if totals[s].sum() >= min_support}
    held = {s: np.asarray(start[s], float) for s in names}
    cut = dict.fromkeys(options, float(global_thr))
    score = lambda hit: _f1(hit[0], hit[1], everyone[0] - hit[0], everyone[1] - hit[1])
    best = float(score(sum(held.values())))
    for _ in range(max_passes):
        before = dict(cut)
        for s, own in options.items():
            others = sum(held.values()) - held[s]
            scores = score(others[:, None] + own)
            while (better := np.flatnonzero(scores > best + config.IMPROVE_EPS)).size:
                i = int(better[0])
                best, held[s], cut[s] = float(scores[i]), own[:, i], GRID[i]
                scores[:i + 1] = -np.inf
        if cut == before:
            break
    return cut


def tune_segment_thresholds(scored: DataFrame, global_thr: float, score="proba",
                            label="label", segment="segment",
                            min_support: int = config.SEGMENT_MIN_SUPPORT,
                            max_passes: int = config.SEGMENT_MAX_PASSES) -> dict:
    """Per-segment cuts maximising GLOBAL macro-F1 (hist on Spark, ascent on
    the bounded histogram)."""
    cells: dict = {}
    start: dict = {}
    for r in segment_hist(scored, [], score, label, segment, global_thr).collect():
        cells.setdefault(r[segment], []).append((r["bin"], r["n_pos"], r["n_neg"]))
        above = start.setdefault(r[segment], np.zeros(2))
        above += r["ge_global"] * np.array([r["n_pos"], r["n_neg"]], float)
    return segment_cuts(cells, start, global_thr, min_support, max_passes) if cells else {}


def thresholds_frame(spark, cuts: dict, segment: str = "segment") -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in sorted(cuts.items())],
                                 f"{segment} string, threshold double")


def honest_transfer(scored: DataFrame, keys=(), score="proba", label="label",
                    fold="fold", segment="segment",
                    min_support: int = config.SEGMENT_MIN_SUPPORT,
                    max_passes: int = config.SEGMENT_MAX_PASSES) -> list[dict]:
    """Per fold k, J1 and J9 tuned without fold k and applied to k; pooled
    global vs segmented macro-F1 per group. One histogram job over the rows."""
    keys = list(keys)
    groups: dict = {}
    for r in class_counts(scored, keys, score, label, extra=[fold, segment]).collect():
        groups.setdefault(tuple(r[k] for k in keys), []).append(
            (r[fold], r[segment], r["bin"], r["n_pos"], r["n_neg"]))
    out = []
    for group, rows in sorted(groups.items()):
        pooled = {"global_f1": np.zeros(4), "segmented_f1": np.zeros(4)}
        for k in sorted({r[0] for r in rows}):
            own = _reach([r[2:] for r in rows if r[0] != k])
            p, q = np.sum([r[3:] for r in rows if r[0] != k], axis=0)
            at = int(np.argmax(_f1(own[0], own[1], p - own[0], q - own[1])))
            cells, start = {}, {}
            for f, s, b, n_pos, n_neg in rows:
                if f != k:
                    cells.setdefault(s, []).append((b, n_pos, n_neg))
                    above = start.setdefault(s, np.zeros(2))
                    above += (b > at) * np.array([n_pos, n_neg], float)
            cuts = segment_cuts(cells, start, GRID[at], min_support, max_passes)
            place = {s: GRID.index(c) for s, c in cuts.items()}
            for f, s, b, n_pos, n_neg in rows:
                if f == k:
                    for name, cut in (("global_f1", at), ("segmented_f1", place.get(s, at))):
                        pooled[name] += [n_pos, n_neg, 0, 0] if b > cut else [0, 0, n_pos, n_neg]
        f1 = {name: float(_f1(*x)) for name, x in pooled.items()}
        out.append({**dict(zip(keys, group)), **f1, "delta": f1["segmented_f1"] - f1["global_f1"]})
    return out


def scheme_summary(results: list[dict]) -> dict:
    """Mean global and segmented macro-F1 over the groups, mean difference and wins."""
    mean = lambda k: float(np.mean([r[k] for r in results]))
    return {"groups": len(results), "global_f1": mean("global_f1"), "segmented_f1": mean("segmented_f1"),
            "delta": mean("delta"), "wins": sum(r["delta"] > 0 for r in results)}
