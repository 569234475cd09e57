"""Fitted table transforms (E1–E5): median impute, most-frequent impute, standard
scaling and ignore-unknown one-hot, routed numeric-then-categorical.

Fit = a handful of aggregate jobs whose results are a few literals per column
(strategy P2); transform = one projection with those literals bound, so applying a
fitted preprocessor to any number of rows is a narrow, codegen'd map.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import config
from riskloom.operators.stats import median_values, sql_double


def fit_medians(df: DataFrame, cols) -> dict:
    """Exact (interpolated) train medians of every column."""
    return median_values(df, cols)


def _category_counts(df: DataFrame, cols) -> dict:
    """{column: {value: count}} of non-null values — one grouped job; the result is
    bounded by the columns' category cardinality (codes), not by rows."""
    items = ", ".join(f"struct('{c}' AS column, CAST(`{c}` AS DOUBLE) AS value)" for c in cols)
    long = df.selectExpr(f"inline(array({items}))").where("value IS NOT NULL")
    out: dict = {c: {} for c in cols}
    for r in long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).collect():
        out[r["column"]][r["value"]] = r["n"]
    return out


def modes_from_counts(counts: dict) -> dict:
    """Most frequent value, the smallest on ties; None for an all-NULL column."""
    return {c: (min(v, key=lambda x: (-v[x], x)) if v else None) for c, v in counts.items()}


def fit_modes(df: DataFrame, cols) -> dict:
    """Most frequent value per column, the smallest value on ties (one job)."""
    return modes_from_counts(_category_counts(df, cols))


def fit_scaler(df: DataFrame, cols, fill: dict | None = None) -> dict:
    """Mean and population std of each (imputed) column in one aggregate;
    a constant column gets scale 1."""
    fill = fill or {}

    def x(c):
        v = f"CAST(`{c}` AS DOUBLE)"
        return f"coalesce({v}, {sql_double(fill[c])})" if fill.get(c) is not None else v
    items = ", ".join(f"avg({x(c)}) AS m{i}, stddev_pop({x(c)}) AS s{i}" for i, c in enumerate(cols))
    row = df.agg(F.expr(f"struct({items}) AS r")).first()["r"] if cols else {}
    out = {}
    for i, c in enumerate(cols):
        s = row[f"s{i}"]
        out[c] = (row[f"m{i}"], 1.0 if (s is None or s == 0.0) else s)
    return out


def fit_categories(df: DataFrame, cols, fill: dict | None = None) -> dict:
    """Sorted distinct categories per column after most-frequent imputation
    (the imputed value is itself a seen category, so = sorted non-null values)."""
    return {c: sorted(v) for c, v in _category_counts(df, cols).items()}


def onehot_name(c: str, v: float) -> str:
    return f"{c}_{int(v) if float(v).is_integer() else v}"


@dataclass
class Preprocessor:
    """E5: fitted column router — numeric (impute [+ scale]) then categorical
    (impute + one-hot, unknown -> all zeros); everything else dropped."""

    numeric: list
    categorical: list
    medians: dict = field(default_factory=dict)
    scaler: dict | None = None
    modes: dict = field(default_factory=dict)
    categories: dict = field(default_factory=dict)

    def output_columns(self) -> list[str]:
        cols = list(self.numeric)
        for c in self.categorical:
            cols += [onehot_name(c, v) for v in self.categories[c]]
        return cols

    def numeric_exprs(self) -> list[str]:
        out = []
        for c in self.numeric:
            med = self.medians.get(c)
            x = f"CAST(`{c}` AS DOUBLE)"
            if med is not None and med == med:
                x = f"coalesce({x}, {sql_double(med)})"
            if self.scaler is not None:
                m, s = self.scaler[c]
                x = "CAST(NULL AS DOUBLE)" if m is None else f"({x} - {sql_double(m)}) / {sql_double(s)}"
            out.append(f"{x} AS `{c}`")
        return out

    def categorical_exprs(self) -> list[str]:
        out = []
        for c in self.categorical:
            x = f"CAST(`{c}` AS DOUBLE)"
            if self.modes.get(c) is not None:
                x = f"coalesce({x}, {sql_double(self.modes[c])})"
            out += [f"coalesce(CAST({x} = {sql_double(v)} AS DOUBLE), CAST(0 AS DOUBLE)) AS `{onehot_name(c, v)}`" for v in self.categories[c]]
        return out

    def transform(self, df: DataFrame, keep=("ID",)) -> DataFrame:
        keep = [k for k in keep if k in df.columns]
        return df.selectExpr(*[f"`{k}`" for k in keep], *self.numeric_exprs(), *self.categorical_exprs())


def fit_preprocessor(train: DataFrame, extra_numeric=(), scale: bool = True,
                     categorical=None) -> Preprocessor:
    numeric = list(config.NUMERIC) + list(extra_numeric)
    categorical = list(config.CATEGORICAL if categorical is None else categorical)
    meds = fit_medians(train, numeric)
    scaler = fit_scaler(train, numeric, meds) if scale else None
    counts = _category_counts(train, categorical) if categorical else {}
    modes = modes_from_counts(counts)
    cats = {c: sorted(v) for c, v in counts.items()}
    return Preprocessor(numeric, categorical, meds, scaler, modes, cats)
