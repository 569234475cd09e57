"""Cross-fitted target encoding of the categorical columns.

Encoding of category c (empirical-Bayes shrinkage, Micci-Barreca 2001):
``lam * mean_c + (1 - lam) * mean`` with ``lam = var * n_c / (var * n_c + var_c)``,
``var`` the label variance and ``var_c`` the within-category (population) variance;
an unseen category (or a degenerate 0/0) gets the global mean.

Training rows are encoded from the *other* inner folds (so a row never sees its own
label); new rows from all training rows. All statistics come from ONE grouped
aggregate of (column, value, inner fold) -> (n, sum, sum of squares); the result
is bounded by the categories' cardinality and joined back per column with a
size-checked broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import config
from riskloom.operators.folds import assign_folds
from riskloom.operators.prep import fit_modes


def _enc(n, s, ss, gn, gs, gss):
    mean_c = s / n
    var_c = ss / n - mean_c * mean_c
    gmean = gs / gn
    gvar = gss / gn - gmean * gmean
    den = gvar * n + var_c
    lam = F.when(den == 0, F.lit(None)).otherwise(gvar * n / den)
    return F.when((n.isNull()) | (n == 0) | lam.isNull(), gmean) \
        .otherwise(lam * mean_c + (F.lit(1.0) - lam) * gmean)


def _stats(df: DataFrame, cols, fold_col):
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                      for c in cols])
    y = F.col("label").cast("double")
    long = df.select(fold_col, y.alias("y"), F.inline(items))
    return long.groupBy("column", "value", fold_col).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("s"),
        F.sum(F.col("y") * F.col("y")).alias("ss"))


def target_encode(train: DataFrame, new: DataFrame | None = None, cols=None,
                  seed: int = config.SEED, k: int = config.N_SPLITS):
    """Returns (train_encoded, new_encoded): ID + one encoded column per categorical."""
    cols = list(cols or config.CATEGORICAL)
    modes = fit_modes(train, cols)

    def impute(df):
        return df.select("ID", *[c for c in ("label",) if c in df.columns],
                         *[F.coalesce(F.col(c).cast("double"),
                                      F.lit(modes[c]).cast("double")).alias(c) for c in cols])

    tr = assign_folds(impute(train), seed, k, out="te_fold")
    st = _stats(tr, cols, "te_fold").cache()
    tot = st.groupBy("column", "value").agg(*[F.sum(x).alias(x) for x in ("n", "s", "ss")])
    g_fold = st.where(F.col("column") == cols[0]).groupBy("te_fold") \
        .agg(*[F.sum(x).alias("g" + x) for x in ("n", "s", "ss")])
    g_all = g_fold.agg(*[F.sum("g" + x).alias("g" + x) for x in ("n", "s", "ss")]).collect()[0]

    # cross-fitted table: (column, value, te_fold) -> encoding from the other folds
    folds = g_fold.select("te_fold", *[(F.lit(float(g_all["g" + x])) - F.col("g" + x))
                                       .alias("g" + x) for x in ("n", "s", "ss")])
    own = st.select("column", "value", "te_fold", *[F.col(x).alias("o" + x)
                                                    for x in ("n", "s", "ss")])
    per = tot.join(own, ["column", "value"], "inner")
    # categories absent from fold k still need an entry for fold k -> take every
    # (category, fold) pair from the fold list (bounded: categories x k)
    fold_list = [r["te_fold"] for r in folds.select("te_fold").collect()]
    full = tot.select("column", "value", "n", "s", "ss",
                      F.explode(F.array(*[F.lit(int(f)) for f in fold_list])).alias("te_fold"))
    full = full.join(per.select("column", "value", "te_fold", "on", "os", "oss"),
                     ["column", "value", "te_fold"], "left").fillna(0.0, ["on", "os", "oss"])
    full = full.join(folds, "te_fold")
    xf = full.select("column", "value", "te_fold",
                     _enc(F.col("n") - F.col("on"), F.col("s") - F.col("os"),
                          F.col("ss") - F.col("oss"), F.col("gn"), F.col("gs"), F.col("gss"))
                     .alias("enc"))
    gmean_other = folds.select("te_fold", (F.col("gs") / F.col("gn")).alias("gm"))

    def apply(rows: DataFrame, table: DataFrame, keys, fallback: DataFrame | None,
              fallback_value: float | None) -> DataFrame:
        out = rows
        for c in cols:
            t = table.where(F.col("column") == c).select(
                F.col("value").alias(c), *[k for k in keys], F.col("enc").alias(f"_e_{c}"))
            out = out.join(t, [c, *keys], "left")
        if fallback is not None:
            out = out.join(F.broadcast(fallback), keys, "left")
            fb = F.col("gm")
        else:
            fb = F.lit(fallback_value)
        return out.select("ID", *[F.coalesce(F.col(f"_e_{c}"), fb).alias(c) for c in cols])

    train_enc = apply(tr, xf, ["te_fold"], gmean_other, None)
    new_enc = None
    if new is not None:
        full_tab = tot.select("column", "value",
                              _enc(F.col("n"), F.col("s"), F.col("ss"),
                                   F.lit(float(g_all["gn"])), F.lit(float(g_all["gs"])),
                                   F.lit(float(g_all["gss"]))).alias("enc"))
        new_enc = apply(impute(new), full_tab, [], None, float(g_all["gs"]) / float(g_all["gn"]))
    return train_enc, new_enc


class TargetEncoder:
    """E6 as a fitted stage: training rows get cross-fitted codes, any other row the codes
    of all training rows. The codes are bounded by the categories and bound as literals."""

    def __init__(self, cols=None, seed: int = config.SEED, k: int = config.N_SPLITS):
        self.cols, self.seed, self.k = list(cols or config.CATEGORICAL), seed, k

    def fit_transform(self, train: DataFrame) -> DataFrame:
        self.modes = fit_modes(train, self.cols)
        imputed = train.select(F.lit(0).alias("all"), "label", *[
            F.coalesce(F.col(c).cast("double"), F.lit(self.modes[c]).cast("double")).alias(c) for c in self.cols])
        rows = _stats(imputed, self.cols, "all").collect()
        first = [r for r in rows if r["column"] == self.cols[0]]
        n, s, ss = (sum(r[k] for r in first) for k in ("n", "s", "ss"))
        self.mean, var = s / n, ss / n - (s / n) ** 2
        self.codes: dict[str, dict[float, float]] = {c: {} for c in self.cols}
        for r in rows:
            own = r["s"] / r["n"]
            den = var * r["n"] + r["ss"] / r["n"] - own * own
            lam = var * r["n"] / den if den else 0.0
            self.codes[r["column"]][r["value"]] = lam * own + (1 - lam) * self.mean
        coded, _ = target_encode(train, cols=self.cols, seed=self.seed, k=self.k)
        rest = [c for c in train.columns if c not in self.cols]
        return train.select(*rest).join(coded, "ID")

    def transform(self, df: DataFrame) -> DataFrame:
        def code(c: str):
            pairs = [F.lit(float(x)) for kv in sorted(self.codes[c].items()) for x in kv]
            value = F.coalesce(F.col(c).cast("double"), F.lit(self.modes[c]).cast("double"))
            return F.coalesce(F.element_at(F.create_map(*pairs), value), F.lit(float(self.mean))).alias(c)
        return df.select(*[code(c) if c in self.cols else F.col(f"`{c}`") for c in df.columns])
