"""NULL-aware Column helpers reproducing numpy's NaN rules with Spark NULLs.

* comparisons with NULL are "false" inside ``when`` (numpy: ``NaN > 0`` is False);
* ``strict_greatest`` / ``strict_least`` propagate NULL (numpy ``max`` propagates NaN,
  Spark ``greatest`` skips NULLs);
* ``count_true`` counts NULL conditions as 0 (numpy ``(x >= 1).sum()``);
* ``safe_ratio`` never divides by a non-positive / NULL denominator.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def strict_greatest(*cols: Column) -> Column:
    return F.when(any_null(cols), F.lit(None).cast("double")).otherwise(
        F.greatest(*cols).cast("double"))


def strict_least(*cols: Column) -> Column:
    return F.when(any_null(cols), F.lit(None).cast("double")).otherwise(
        F.least(*cols).cast("double"))


def flag(cond: Column) -> Column:
    """Boolean -> 0.0/1.0 with NULL -> 0.0."""
    return F.coalesce(cond.cast("double"), F.lit(0.0))


def count_true(conds) -> Column:
    return reduce(lambda a, b: a + b, [flag(c) for c in conds])


def add_all(cols) -> Column:
    return reduce(lambda a, b: a + b, [c.cast("double") for c in cols])


def mean_of(cols) -> Column:
    """Row mean that propagates NULL (numpy mean over a NaN row is NaN)."""
    return add_all(cols) / F.lit(float(len(cols)))


def safe_ratio(num: Column, den: Column, valid: Column, fallback) -> Column:
    """B2: ``num/den`` where ``valid`` else ``fallback``; NULL ``valid`` -> fallback."""
    fb = fallback if isinstance(fallback, Column) else F.lit(fallback).cast("double")
    return F.when(valid, num.cast("double") / den.cast("double")).otherwise(fb)


def finite_or_null(c: Column) -> Column:
    """NaN / +-inf -> NULL."""
    d = c.cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(None).cast("double")) \
        .otherwise(d)
