"""Encoding knobs (D-1 … D-7): stateless rewrites of the raw model columns.

Fixed order: 1. ``pay_remap`` 2. ``pay_flags`` 3. ``bill_neg`` (clip / flag / keep)
4. ``log1p`` on the 13 monetary columns (after any clip). ``scale`` is not a rewrite;
it gates standardisation in the fitted preprocessor (``operators.prep``).
All knobs together are one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import config
from riskloom.functions.nulls import finite_or_null
from riskloom.session import built_once


def encoding_extra_columns(encoding: dict | None) -> list[str]:
    """Names of the columns an encoding appends (flags), in order."""
    if not encoding:
        return []
    names: list[str] = []
    if encoding.get("pay_flags"):
        names += [f"IS_DELINQ_{c}" for c in config.PAY_COLS]
    if encoding.get("bill_neg") == "flag":
        names += [f"OVERPAY_{c}" for c in config.BILL_COLS]
    return names


def signed_log1p(c: Column) -> Column:
    d = c.cast("double")
    return F.signum(d) * F.log1p(F.abs(d))


def apply_encoding(df: DataFrame, encoding: dict | None = None) -> DataFrame:
    if not encoding:
        return df
    key = ("encoding", tuple(df.columns), tuple(sorted(encoding.items())))
    return df.select(*built_once(key, lambda: _encoded_columns(df.columns, encoding)))


def _encoded_columns(columns: list[str], encoding: dict) -> list[Column]:
    bill_neg = encoding.get("bill_neg", "keep")
    exprs: dict[str, Column] = {c: F.col(c) for c in columns}
    if encoding.get("pay_remap"):
        for c in config.PAY_COLS:
            exprs[c] = F.when(F.col(c) < 0, F.lit(0)).otherwise(F.col(c))
    extra: dict[str, Column] = {}
    if encoding.get("pay_flags"):
        for c in config.PAY_COLS:
            extra[f"IS_DELINQ_{c}"] = F.coalesce((exprs[c] >= 1).cast("double"), F.lit(0.0))
    if bill_neg == "clip":
        for c in config.BILL_COLS:
            exprs[c] = F.when(F.col(c) < 0, F.lit(0.0)).otherwise(F.col(c)).cast("double")
    elif bill_neg == "flag":
        for c in config.BILL_COLS:
            extra[f"OVERPAY_{c}"] = F.coalesce((F.col(c) < 0).cast("double"), F.lit(0.0))
    if encoding.get("log1p"):
        for c in config.MONETARY_COLS:
            exprs[c] = signed_log1p(exprs[c])
    # any residual non-finite value -> NULL, on the numeric columns the knobs touch
    touched = set()
    if bill_neg == "clip":
        touched |= set(config.BILL_COLS)
    if encoding.get("log1p"):
        touched |= set(config.MONETARY_COLS)
    cols = [(finite_or_null(e) if n in touched else e).alias(n) for n, e in exprs.items()]
    return cols + [e.alias(n) for n, e in extra.items()]


def make_encoder(encoding: dict | None):
    enc = dict(encoding or {})
    return lambda df: apply_encoding(df, enc)
