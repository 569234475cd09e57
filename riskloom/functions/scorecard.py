"""Deterministic scorecards: fixed-formula stand-ins for a model's probability.

They let every score-consuming operator (thresholds, ensembles, comparisons) be
checked exactly without fitting a learner. Integer numerators over a double
literal are bit-identical across engines.

FIXED VALUES (formulas):
  A = (2*n(PAY_*>=1) + 6*[PAY_0>=1] + 3*[PAY_0>=2]) / 21
  B = (6 - n(PAY_*<=0) + 4*[PAY_0>=1] + n(PAY_AMT*=0)) / 16
  C = (ID*7919 % 1000) / 1000        (noise)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import config


def _n(cols, cond) -> Column:
    return reduce(lambda a, b: a + b,
                  [F.when(cond(F.col(c)), 1).otherwise(0) for c in cols])


def scorecard(name: str) -> Column:
    if name == "A":
        num = 2 * _n(config.PAY_COLS, lambda c: c >= 1) + 6 * _n(["PAY_0"], lambda c: c >= 1) \
            + 3 * _n(["PAY_0"], lambda c: c >= 2)
        return num / F.lit(21.0)
    if name == "B":
        num = 6 - _n(config.PAY_COLS, lambda c: c <= 0) + 4 * _n(["PAY_0"], lambda c: c >= 1) \
            + _n(config.PAY_AMT_COLS, lambda c: c == 0)
        return num / F.lit(16.0)
    if name == "C":
        return (F.col("ID") * 7919 % 1000) / F.lit(1000.0)
    raise ValueError(f"unknown scorecard {name!r}")


def score_table(df: DataFrame, names=("A", "B", "C"), keep=("ID", "label")) -> DataFrame:
    """Long score table (keep..., model, proba): one pass, no union."""
    items = F.array(*[F.struct(F.lit(n).alias("model"), scorecard(n).alias("proba"))
                      for n in names])
    return df.select(*keep, F.inline(items))
