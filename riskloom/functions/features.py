"""Row-wise cleaning and engineered feature families.

Every family is a set of Column expressions over one row's own columns, so a whole
feature configuration is ONE projection (no shuffle, whole-stage codegen). Month
index 0 is the newest. NULL rules follow numpy's NaN rules (see ``nulls``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import config
from riskloom.functions.nulls import (count_true, finite_or_null, flag, mean_of,
                                      safe_ratio, strict_greatest)
from riskloom.session import built_once

# FIXED VALUES: family name -> the exact output column names, in order.
ENGINEERED_COLUMNS: dict[str, list[str]] = {
    "pay": ["PAY_MAX", "PAY_MEAN", "PAY_N_LATE", "PAY_N_DULY", "PAY_CURR_DELINQ",
            "PAY_TREND", "PAY_WORST_STREAK"],
    "util": ["UTIL_MEAN", "UTIL_MAX", "UTIL_LAST"],
    "payratio": ["FRAC_BILL_PAID_MEAN", "COVER_PREV_MEAN", "N_ZERO_PAY", "N_PAID_FULL"],
    "bill": ["BILL_MEAN", "BILL_MAX", "BILL_STD", "BILL_TREND", "REM_CREDIT_LAST",
             "REM_CREDIT_MEAN"],
    "paysem": ["PAY_N_REVOLVING", "PAY_N_PAIDFULL", "PAY_N_NOCONS", "PAY0_GE2",
               "PAY0_REVOLVING", "PAY0_PAIDFULL"],
    "coverx": ["COVER_RECENT", "COVER_TREND", "UTIL_TREND"],
    "utilmonths": ["UTIL_1", "UTIL_2", "UTIL_3", "UTIL_4", "UTIL_5", "UTIL_6"],
    "payamtratio": ["PAYR_1", "PAYR_2", "PAYR_3", "PAYR_4", "PAYR_5", "PAYR_6"],
    "stress": ["STRESS_DELINQ_UTIL", "STRESS_MAXPAY_UTIL", "STRESS_CURR"],
    "paysem2": ["PAY_RECOVERED", "PAY_NEWLY_LATE", "PAY_DELINQ_RECENT3", "PAY_DELINQ_OLD3",
                "PAY_ESCALATION"],
}


def engineered_feature_names(groups) -> list[str]:
    names: list[str] = []
    for g in groups:
        if g not in ENGINEERED_COLUMNS:
            raise KeyError(f"unknown feature group {g!r}; known: {list(ENGINEERED_COLUMNS)}")
        names.extend(ENGINEERED_COLUMNS[g])
    return names


# --------------------------------------------------------------------------- B1
def fold_undocumented_codes(df: DataFrame) -> DataFrame:
    """EDUCATION {0,5,6} -> 4, MARRIAGE {0} -> 3; each only if the column is present."""
    out = df
    if "EDUCATION" in df.columns:
        out = out.withColumn("EDUCATION", F.when(F.col("EDUCATION").isin(
            *config.EDUCATION_FOLD), F.lit(4)).otherwise(F.col("EDUCATION")))
    if "MARRIAGE" in df.columns:
        out = out.withColumn("MARRIAGE", F.when(F.col("MARRIAGE").isin(
            *config.MARRIAGE_FOLD), F.lit(3)).otherwise(F.col("MARRIAGE")))
    return out


def make_code_folder():
    return fold_undocumented_codes


# ------------------------------------------------------------------- C1..C10
def _d(name: str) -> Column:
    return F.col(name).cast("double")


def longest_run(flags: list[Column]) -> Column:
    """Longest run of consecutive true flags (NULL = false), via ``aggregate``."""
    arr = F.array(*[F.coalesce(f, F.lit(False)) for f in flags])
    init = F.struct(F.lit(0.0).alias("run"), F.lit(0.0).alias("best"))

    def step(acc, x):
        run = F.when(x, acc["run"] + 1.0).otherwise(F.lit(0.0))
        return F.struct(run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(arr, init, step, lambda acc: acc["best"])


def family_columns(group: str) -> dict[str, Column]:
    """Column expressions of one family, keyed by output name (raw inputs only)."""
    pay = [_d(c) for c in config.PAY_COLS]
    bill = [_d(c) for c in config.BILL_COLS]
    amt = [_d(c) for c in config.PAY_AMT_COLS]
    limit = _d("LIMIT_BAL")
    null = F.lit(None).cast("double")
    util = [safe_ratio(b, limit, limit > 0, null) for b in bill]
    frac = [safe_ratio(a, b, b > 0, 1.0) for a, b in zip(amt, bill)]

    if group == "pay":
        return {
            "PAY_MAX": strict_greatest(*pay),
            "PAY_MEAN": mean_of(pay),
            "PAY_N_LATE": count_true([p >= 1 for p in pay]),
            "PAY_N_DULY": count_true([p <= 0 for p in pay]),
            "PAY_CURR_DELINQ": flag(pay[0] >= 1),
            "PAY_TREND": pay[0] - pay[-1],
            "PAY_WORST_STREAK": longest_run([p >= 1 for p in pay]),
        }
    if group == "util":
        return {"UTIL_MEAN": mean_of(util), "UTIL_MAX": strict_greatest(*util),
                "UTIL_LAST": util[0]}
    if group == "payratio":
        cover = [safe_ratio(amt[t], bill[t + 1], bill[t + 1] > 0, 1.0) for t in range(5)]
        return {
            "FRAC_BILL_PAID_MEAN": mean_of(frac),
            "COVER_PREV_MEAN": mean_of(cover),
            "N_ZERO_PAY": count_true([a == 0 for a in amt]),
            "N_PAID_FULL": count_true([(a >= b) & (b > 0) for a, b in zip(amt, bill)]),
        }
    if group == "bill":
        mean = mean_of(bill)
        std = F.sqrt(mean_of([(b - mean) * (b - mean) for b in bill]))
        return {
            "BILL_MEAN": mean, "BILL_MAX": strict_greatest(*bill), "BILL_STD": std,
            "BILL_TREND": bill[0] - bill[-1], "REM_CREDIT_LAST": limit - bill[0],
            "REM_CREDIT_MEAN": limit - mean,
        }
    if group == "paysem":
        return {
            "PAY_N_REVOLVING": count_true([p == 0 for p in pay]),
            "PAY_N_PAIDFULL": count_true([p == -1 for p in pay]),
            "PAY_N_NOCONS": count_true([p == -2 for p in pay]),
            "PAY0_GE2": flag(pay[0] >= 2),
            "PAY0_REVOLVING": flag(pay[0] == 0),
            "PAY0_PAIDFULL": flag(pay[0] == -1),
        }
    if group == "coverx":
        recent = safe_ratio(amt[0], bill[1], bill[1] > 0, 1.0)
        old = safe_ratio(amt[4], bill[5], bill[5] > 0, 1.0)
        return {"COVER_RECENT": recent, "COVER_TREND": recent - old,
                "UTIL_TREND": util[0] - util[5]}
    if group == "utilmonths":
        return {f"UTIL_{k + 1}": util[k] for k in range(6)}
    if group == "payamtratio":
        return {f"PAYR_{k + 1}": frac[k] for k in range(6)}
    if group == "stress":
        return {
            "STRESS_DELINQ_UTIL": flag(pay[0] >= 2) * util[0],
            "STRESS_MAXPAY_UTIL": strict_greatest(*pay) * mean_of(util),
            "STRESS_CURR": F.when(pay[0] < 0, F.lit(0.0)).otherwise(pay[0]) * util[0],
        }
    if group == "paysem2":
        return {
            "PAY_RECOVERED": flag((strict_greatest(*pay) >= 1) & (pay[0] <= 0)),
            "PAY_NEWLY_LATE": flag((pay[0] >= 1) & (pay[1] <= 0)),
            "PAY_DELINQ_RECENT3": count_true([p >= 1 for p in pay[:3]]),
            "PAY_DELINQ_OLD3": count_true([p >= 1 for p in pay[3:]]),
            "PAY_ESCALATION": pay[0] - strict_greatest(*pay[1:]),
        }
    raise KeyError(f"unknown feature group {group!r}; known: {list(ENGINEERED_COLUMNS)}")


def engineered_columns(groups) -> list[Column]:
    """All engineered Columns of ``groups``, in registry order, non-finite -> NULL."""
    out = []
    for g in groups:
        exprs = family_columns(g)
        for name in ENGINEERED_COLUMNS[g]:
            out.append(finite_or_null(exprs[name]).alias(name))
    return out


def add_engineered_features(df: DataFrame, groups=()) -> DataFrame:
    """Append the requested families in one projection; no groups -> identity."""
    groups = list(groups)
    if not groups:
        return df
    return df.select("*", *built_once(("features", tuple(groups)), lambda: engineered_columns(groups)))


def make_feature_engineer(groups):
    """``df.transform(make_feature_engineer([...]))``."""
    groups = list(groups)
    return lambda df: add_engineered_features(df, groups)
