"""Metrics and profiling aggregations.

Each metric is one grouped aggregate over the score / panel table (map-side
combined), returning a small table; nothing row-level reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom import config
from riskloom.operators.cuts import macro_f1


def _pred(score: str, cut) -> Column:
    c = cut if isinstance(cut, Column) else F.lit(float(cut))
    return F.col(score) >= c


def confusion(scored: DataFrame, keys=(), cut=0.5, score="proba", label="label") -> DataFrame:
    """Tn, fp, fn, tp at a cut (``proba >= cut`` predicts 1)."""
    p = _pred(score, cut)
    y = F.col(label) == 1
    return scored.groupBy(*keys).agg(
        F.count_if(~p & ~y).alias("tn"), F.count_if(p & ~y).alias("fp"),
        F.count_if(~p & y).alias("fn"), F.count_if(p & y).alias("tp"))


def _div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def classification_report(scored: DataFrame, keys=(), cut=0.5, score="proba",
                          label="label") -> DataFrame:
    """Per-class precision / recall / F1 / support, plus macro and weighted rows
    (0 on zero division)."""
    keys = list(keys)
    cm = confusion(scored, keys, cut, score, label)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")

    def cls(name, a, b, c, support):
        prec = _div(a, a + b)
        rec = _div(a, a + c)
        f1 = _div(2 * a, 2 * a + b + c)
        return F.struct(F.lit(name).alias("class"), prec.alias("precision"),
                        rec.alias("recall"), f1.alias("f1"), support.cast("double").alias("support"))

    c0 = cls("0", tn, fn, fp, tn + fp)
    c1 = cls("1", tp, fp, fn, tp + fn)
    n = (tp + fp + fn + tn).cast("double")
    macro = F.struct(F.lit("macro avg").alias("class"),
                     ((c0["precision"] + c1["precision"]) / 2).alias("precision"),
                     ((c0["recall"] + c1["recall"]) / 2).alias("recall"),
                     ((c0["f1"] + c1["f1"]) / 2).alias("f1"), n.alias("support"))

    def wavg(field):
        return (c0[field] * c0["support"] + c1[field] * c1["support"]) / n
    weighted = F.struct(F.lit("weighted avg").alias("class"), wavg("precision").alias("precision"),
                        wavg("recall").alias("recall"), wavg("f1").alias("f1"),
                        n.alias("support"))
    return cm.select(*keys, F.inline(F.array(c0, c1, macro, weighted)))


def macro_f1_at_cut(scored: DataFrame, keys=(), cut=0.5, score="proba",
                    label="label") -> DataFrame:
    """Macro-F1 at a single cut."""
    cm = confusion(scored, keys, cut, score, label)
    return cm.select(*keys, macro_f1(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
                     .alias("macro_f1"))


#: distinct scores that one task orders at a time in ``roc_auc``
SCORES_PER_BUCKET = 20_000


def roc_auc(scored: DataFrame, keys=(), score="proba", label="label",
            per_bucket: int = SCORES_PER_BUCKET) -> DataFrame:
    """I4: ROC-AUC with half credit for ties; NULL for a group with one class.

    Distinct scores are aggregated first (a score shared by many rows is one row).
    "Negatives strictly below" = a running sum inside a bucket + the running totals
    of the buckets before it. Bucket edges are approximate quantiles of the DISTINCT
    (group, score) rows, one for every ``per_bucket`` of them, applied with ``Bucketizer``
    (JVM binary search). Counts are summed as 38-digit decimals, so they stay exact for
    any number of rows.
    """
    from pyspark.ml.feature import Bucketizer
    keys = list(keys)
    y = F.col(label).cast("long")
    d = scored.groupBy(*keys, F.col(score).cast("double").alias("s")) \
        .agg(F.sum(y).alias("n_pos"), F.sum(1 - y).alias("n_neg"))
    n_buckets = max(1, -(-d.count() // per_bucket))
    edges = []
    if n_buckets > 1:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        edges = d.agg(F.percentile_approx("s", probs, max(10_000, 10 * n_buckets)).alias("e")).first()["e"] or []
    splits = [float("-inf")] + sorted({float(v) for v in edges}) + [float("inf")]
    d = Bucketizer(splits=splits, inputCol="s", outputCol="bkt").transform(d) if len(splits) > 2 \
        else d.withColumn("bkt", F.lit(0.0))
    w_in = Window.partitionBy(*keys, "bkt").orderBy("s") \
        .rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("neg_in", F.coalesce(F.sum("n_neg").over(w_in), F.lit(0)))
    b = d.groupBy(*keys, "bkt").agg(F.sum("n_neg").alias("bneg"))
    w_b = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))) \
        .orderBy("bkt").rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("neg_before", F.coalesce(F.sum("bneg").over(w_b), F.lit(0))).drop("bneg")
    j = d.join(b, [*keys, "bkt"])
    below = (2 * (F.col("neg_before") + F.col("neg_in")) + F.col("n_neg")).cast("decimal(20,0)")
    agg = j.groupBy(*keys).agg(
        F.sum(F.col("n_pos").cast("decimal(18,0)") * below).cast("decimal(38,0)").alias("num2"),
        F.sum("n_pos").alias("P"), F.sum("n_neg").alias("N"))
    area = F.col("num2").cast("double") / F.col("P").cast("double") / F.col("N").cast("double") / 2
    return agg.select(*keys, F.when((F.col("P") > 0) & (F.col("N") > 0), area).alias("roc_auc"))


def fold_macro_f1(scored: DataFrame, keys=(), fold="fold", cut=0.5, score="proba",
                  label="label") -> DataFrame:
    """Macro-F1 per fold at the cut, then mean and population std."""
    keys = list(keys)
    per = macro_f1_at_cut(scored, [*keys, fold], cut, score, label)
    return per.groupBy(*keys).agg(F.avg("macro_f1").alias("macro_f1_mean"),
                                  F.stddev_pop("macro_f1").alias("macro_f1_std"),
                                  F.count(F.lit(1)).alias("n_folds"))


def compare_models(scored: DataFrame, model="model", fold="fold", cut=0.5,
                   score="proba", label="label") -> DataFrame:
    """I1–I5 for every model in one table, ranked by mean fold macro-F1."""
    f = fold_macro_f1(scored, [model], fold, cut, score, label)
    a = roc_auc(scored, [model], score, label)
    cm = confusion(scored, [model], cut, score, label)
    r = f.join(a, model).join(cm, model)
    w = Window.orderBy(F.col("macro_f1_mean").desc(), F.col(model))
    # the ranking window runs over one row per model (bounded by the spec list)
    return r.withColumn("rank", F.row_number().over(w))


def class_balance(df: DataFrame, label="label") -> DataFrame:
    """Normalised value counts of the label, sorted by value."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return c.select(label, "n", (F.col("n") / tot).alias("share")).orderBy(label)


def _long(df: DataFrame, cols, name="column", value="value") -> DataFrame:
    items = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value))
                      for c in cols])
    return df.select(F.inline(items))


def value_counts(df: DataFrame, cols=None) -> DataFrame:
    """I8: per-column value counts of the categoricals (one job for all columns); missing
    values are not counted."""
    cols = list(cols or config.CATEGORICAL)
    return _long(df, cols).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_codes(df: DataFrame, cols=None) -> DataFrame:
    """Sorted distinct codes per PAY column (long form, one job)."""
    cols = list(cols or config.PAY_COLS)
    return _long(df, cols).where(F.col("value").isNotNull()).distinct()


def histograms(df: DataFrame, cols=("LIMIT_BAL", "AGE"), bins: int = 40) -> DataFrame:
    """Equal-width histograms (edges = linspace(min, max, bins+1); last bin
    right-closed). One min/max aggregate, then one grouped count."""
    cols = list(cols)
    mm = df.agg(*[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in cols],
                *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in cols]).collect()[0]
    items = []
    for c in cols:
        lo, hi = mm[f"lo_{c}"], mm[f"hi_{c}"]
        if lo is None:
            continue
        x = F.col(c).cast("double")
        idx = bin_index(x, lo, hi, bins)
        items.append(F.when(x.isNotNull(), F.struct(F.lit(c).alias("column"),
                                                    idx.alias("bin"),
                                                    F.lit(lo).alias("lo"),
                                                    F.lit(hi).alias("hi"))))
    long = df.select(F.explode(F.array(*items)).alias("it")).where(F.col("it").isNotNull())
    return long.groupBy("it.column", "it.bin", "it.lo", "it.hi").agg(
        F.count(F.lit(1)).alias("n"))


def edge(lo: float, hi: float, bins: int, i: Column) -> Column:
    step = (hi - lo) / bins
    return F.when(i >= bins, F.lit(hi)).otherwise(F.lit(lo) + i.cast("double") * F.lit(step))


def bin_index(x: Column, lo: float, hi: float, bins: int) -> Column:
    if hi == lo:
        return F.lit(0)
    norm = bins / (hi - lo)
    i = F.floor((x - F.lit(lo)) * F.lit(norm)).cast("int")
    i = F.when(i >= bins, F.lit(bins - 1)).otherwise(i)
    i = F.when(x < edge(lo, hi, bins, i), i - 1).otherwise(i)
    i = F.when((x >= edge(lo, hi, bins, i + 1)) & (i != bins - 1), i + 1).otherwise(i)
    return i


def count_plot(df: DataFrame, col: str = "PAY_0") -> DataFrame:
    """I10 count plot: counts per value that is not missing."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def missingness(df: DataFrame, cols=None) -> DataFrame:
    """NULL counts of the columns that have any, plus the row count."""
    cols = list(cols or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_null"))
                      for c in cols])
    return row.select(F.col("_n").alias("n_rows"), F.inline(items)).where(F.col("n_null") > 0)


def correlation_matrix(df: DataFrame, cols=None, label="label") -> DataFrame:
    """Pairwise-complete Pearson correlations, upper triangle incl. diagonal.

    Each row is expanded to one (pair, x, y) item per pair inside the scan and
    aggregated per pair (partial aggregation: the shuffle is pairs x partitions
    buffers). One very wide aggregate would do the same per-row work but generates
    a method too large for the JIT.
    """
    cols = list(cols or (config.NUMERIC + [label]))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    items = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                               F.col(a).cast("double").alias("x"),
                               F.col(b).cast("double").alias("y")) for a, b in pairs])
    return df.select(F.inline(items)).groupBy("a", "b").agg(F.corr("x", "y").alias("corr"))


def positive_rate(pred: DataFrame, keys=(), col="Predicted") -> DataFrame:
    """Count and share of predicted positives."""
    return pred.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                   F.sum(F.col(col)).cast("long").alias("n_pos"),
                                   F.avg(F.col(col).cast("double")).alias("pos_rate"))


def union_all(dfs):
    return reduce(lambda a, b: a.unionByName(b), dfs)
