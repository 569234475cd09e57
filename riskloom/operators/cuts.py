"""Threshold-histogram core (strategy P1).

A score ``p`` is assigned the number of grid cuts ``<= p`` (``bin`` in 0..181), so
"predicted positive at grid cut i" is exactly ``bin > i`` (``p >= grid[i]``,
inclusive as in the analysed code). One partial+final aggregation turns any number of
rows into at most 182 bins per group; every curve, best cut, transfer and ascent is
then arithmetic over that tiny table instead of 181 passes over the rows.

Bounded per-group lists (``<= 182 x folds x segments`` entries) are handled with
SQL higher-order functions, so everything stays on the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom import config

GRID: list[float] = config.threshold_grid()
N_CUTS = len(GRID)
_STEP = (config.GRID_STOP - config.GRID_START) / (N_CUTS - 1)


def grid_array() -> Column:
    return F.array(*[F.lit(t) for t in GRID])


def grid_at(i: Column) -> Column:
    """Grid value of 0-based cut index ``i``."""
    return F.element_at(grid_array(), (i + 1).cast("int"))


def cut_bin(score: Column) -> Column:
    """Number of grid cuts ``<= score`` — exact against the literal grid.

    An arithmetic guess is corrected by comparing with the neighbouring literal
    cuts, so floating rounding in the guess never moves a row to the wrong bin.
    """
    p = score.cast("double")
    guess = F.floor((p - F.lit(config.GRID_START)) / F.lit(_STEP)).cast("int") + 1
    c = F.least(F.greatest(guess, F.lit(0)), F.lit(N_CUTS))
    arr = grid_array()
    c = c + F.when((c < N_CUTS) & (F.element_at(arr, F.least(c + 1, F.lit(N_CUTS))) <= p), 1) \
        .otherwise(0)
    c = c - F.when((c > 0) & (F.element_at(arr, F.greatest(c, F.lit(1))) > p), 1).otherwise(0)
    return c


def macro_f1(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """Mean of the two class F1s; a class with 2tp+fp+fn = 0 scores 0."""
    def f1(a, b, c):
        den = (2 * a + b + c).cast("double")
        return F.when(den == 0, F.lit(0.0)).otherwise((2 * a).cast("double") / den)
    return (f1(tn, fn, fp) + f1(tp, fp, fn)) / F.lit(2.0)


def class_counts(scored: DataFrame, keys, score: str = "proba", label: str = "label",
                 extra=()) -> DataFrame:
    """``hist``: (keys, extra, bin, n_pos, n_neg) — map-side combined, <=182 bins."""
    y = F.col(label).cast("long")
    return (scored.groupBy(*keys, *extra, cut_bin(F.col(score)).alias("bin"))
            .agg(F.sum(y).alias("n_pos"), F.sum(1 - y).alias("n_neg")))


def hist_lists(hist: DataFrame, keys, extra=()) -> DataFrame:
    """One row per group with its bounded bin list ``h`` (array of structs)."""
    fields = [*extra, "bin", "n_pos", "n_neg"]
    return hist.groupBy(*keys).agg(F.collect_list(F.struct(*fields)).alias("h"))


def sum_where(h: Column, field: str, pred) -> Column:
    zero = F.lit(0).cast("long")
    return F.aggregate(h, zero, lambda acc, x: acc + F.when(pred(x), x[field]).otherwise(zero))


def counts_at(h: Column, i: Column, where=None):
    """(tp, fp, fn, tn) at grid cut index ``i`` over list entries passing ``where``."""
    def w(x):
        return F.lit(True) if where is None else where(x)
    tp = sum_where(h, "n_pos", lambda x: w(x) & (x["bin"] > i))
    fp = sum_where(h, "n_neg", lambda x: w(x) & (x["bin"] > i))
    pos = sum_where(h, "n_pos", w)
    neg = sum_where(h, "n_neg", w)
    return tp, fp, pos - tp, neg - fp


def cut_index_seq() -> Column:
    return F.sequence(F.lit(0), F.lit(N_CUTS - 1))


def pick_best(df: DataFrame, keys, f1: str = "macro_f1", idx: str = "i",
              carry=()) -> DataFrame:
    """Best cut per group: highest F1, lowest cut on ties (``max_by`` on (f1, -i))."""
    order = F.struct(F.col(f1), -F.col(idx))
    payload = F.struct(F.col(idx).alias(idx), F.col(f1).alias(f1), *[F.col(c) for c in carry])
    best = df.groupBy(*keys).agg(F.max_by(payload, order).alias("_b"))
    return best.select(*keys, *[F.col("_b")[c].alias(c) for c in [idx, f1, *carry]])


def suffix_counts(hist: DataFrame, part_keys) -> DataFrame:
    """Dense per-cut counts from a sparse histogram, with window suffix sums.

    Returns (part_keys, i, tp, fp, pos, neg) for every grid cut i: ``tp``/``fp`` are
    the rows with ``bin > i`` (predicted positive at cut i), ``pos``/``neg`` the
    group totals. Each window partition holds <= 182 rows.
    """
    part_keys = list(part_keys)
    base = hist.select(*part_keys).distinct() \
        .select(*part_keys, F.explode(F.sequence(F.lit(0), F.lit(N_CUTS))).alias("bin"))
    d = base.join(hist, [*part_keys, "bin"], "left") \
        .select(*part_keys, "bin", F.coalesce("n_pos", F.lit(0)).alias("n_pos"),
                F.coalesce("n_neg", F.lit(0)).alias("n_neg"))
    pk = part_keys if part_keys else [F.lit(0)]
    w = Window.partitionBy(*pk).orderBy(F.col("bin").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wall = Window.partitionBy(*pk)
    d = d.select(*part_keys, "bin", F.sum("n_pos").over(w).alias("tp"),
                 F.sum("n_neg").over(w).alias("fp"),
                 F.sum("n_pos").over(wall).alias("pos"), F.sum("n_neg").over(wall).alias("neg"))
    return d.where(F.col("bin") >= 1).select(*part_keys, (F.col("bin") - 1).alias("i"),
                                             "tp", "fp", "pos", "neg")
