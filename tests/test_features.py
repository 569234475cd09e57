"""Row-wise families on a hand-made NULL/edge frame, against numpy semantics."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom import config
from riskloom.functions import encode as E
from riskloom.functions import features as FE

PAY = config.PAY_COLS
BILL = config.BILL_COLS
AMT = config.PAY_AMT_COLS

ROWS = [
    # id, limit, sex, edu, mar, age, pay x6, bill x6, amt x6
    (1, 1000.0, 1, 0, 0, 30, [1, 1, 1, 1, 1, 1], [100.0, 0.0, -5.0, 200.0, 50.0, 10.0],
     [10.0, 0.0, 5.0, 200.0, 0.0, 1.0]),
    (2, 0.0, 2, 5, 1, 40, [1, -1, 2, 0, 3, -2], [0.0, 100.0, 100.0, 0.0, 0.0, 0.0],
     [0.0, 50.0, None, 0.0, 0.0, 0.0]),
    (3, -50.0, 3, 6, 2, 50, [-2, -2, -1, 0, 0, 0], [None, 10.0, 20.0, 30.0, 40.0, 50.0],
     [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]),
    (4, None, 1, 9, 3, 22, [2, 3, None, 4, 5, 6], [10.0, 20.0, None, 40.0, 50.0, 60.0],
     [None, 1.0, 1.0, 1.0, 1.0, 1.0]),
    (5, 500.0, 2, 1, 0, 35, [None, 1, 1, 0, 1, 1], [500.0, 400.0, 300.0, 200.0, 100.0, 0.0],
     [500.0, 400.0, 300.0, 200.0, 100.0, 0.0]),
]


@pytest.fixture(scope="module")
def edge(spark):
    data = []
    for r in ROWS:
        data.append((r[0], r[1], r[2], r[3], r[4], r[5], *r[6], *r[7], *r[8]))
    schema = ("ID long, LIMIT_BAL double, SEX int, EDUCATION int, MARRIAGE int, AGE int, "
              + ", ".join(f"{c} int" for c in PAY) + ", "
              + ", ".join(f"{c} double" for c in BILL + AMT))
    return spark.createDataFrame(data, schema)


def _np(values):
    return np.array([np.nan if v is None else v for v in values], dtype=float)


def expected(row):
    """numpy statement of the family definitions (NaN rules of the spec)."""
    pay, bill, amt = _np(row[6]), _np(row[7]), _np(row[8])
    limit = np.nan if row[1] is None else row[1]
    with np.errstate(invalid="ignore", divide="ignore"):
        util = np.where(limit > 0, bill / (limit if limit > 0 else 1.0), np.nan)
        frac = np.where(bill > 0, amt / np.where(bill > 0, bill, 1.0), 1.0)
        cover = np.where(bill[1:] > 0, amt[:-1] / np.where(bill[1:] > 0, bill[1:], 1.0), 1.0)
    late = pay >= 1
    run = best = 0
    for x in late:
        run = run + 1 if x else 0
        best = max(best, run)
    return {
        "PAY_MAX": pay.max(), "PAY_MEAN": pay.mean(), "PAY_N_LATE": float(late.sum()),
        "PAY_N_DULY": float((pay <= 0).sum()), "PAY_TREND": pay[0] - pay[-1],
        "PAY_WORST_STREAK": float(best),
        "UTIL_MEAN": util.mean(), "UTIL_MAX": util.max(), "UTIL_LAST": util[0],
        "FRAC_BILL_PAID_MEAN": frac.mean(), "COVER_PREV_MEAN": cover.mean(),
        "N_ZERO_PAY": float((amt == 0).sum()),
        "N_PAID_FULL": float(((amt >= bill) & (bill > 0)).sum()),
        "BILL_STD": bill.std(), "PAY_ESCALATION": pay[0] - pay[1:].max(),
        "STRESS_CURR": np.clip(pay[0], 0, None) * util[0],
        "PAY_RECOVERED": float((pay.max() >= 1) & (pay[0] <= 0)),
    }


def _same(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and abs(a - b) <= 1e-9 * max(1.0, abs(b))


def test_families_match_numpy_semantics(edge):
    groups = ["pay", "util", "payratio", "bill", "stress", "paysem2"]
    got = {r["ID"]: r.asDict() for r in FE.add_engineered_features(edge, groups).collect()}
    for row in ROWS:
        exp = expected(row)
        for k, v in exp.items():
            assert _same(v, got[row[0]][k]), (row[0], k, v, got[row[0]][k])


def test_all_groups_column_contract(edge):
    groups = list(FE.ENGINEERED_COLUMNS)
    out = FE.add_engineered_features(edge, groups)
    assert out.columns[len(edge.columns):] == FE.engineered_feature_names(groups)
    assert len(FE.engineered_feature_names(groups)) == 49
    assert FE.add_engineered_features(edge, []) is edge


def test_code_folding(edge):
    r = {x["ID"]: (x["EDUCATION"], x["MARRIAGE"]) for x in
         FE.fold_undocumented_codes(edge).collect()}
    assert r[1] == (4, 3) and r[2] == (4, 1) and r[3] == (4, 2) and r[4] == (9, 3)


def test_encoding_order_and_flags(edge):
    enc = {"pay_remap": True, "pay_flags": True, "bill_neg": "flag", "log1p": True}
    out = E.apply_encoding(edge, enc)
    assert out.columns[-12:] == E.encoding_extra_columns(enc)
    r = {x["ID"]: x.asDict() for x in out.collect()}
    assert r[3]["PAY_0"] == 0 and r[2]["IS_DELINQ_PAY_0"] == 1.0
    assert r[1]["OVERPAY_BILL_AMT3"] == 1.0
    assert abs(r[1]["BILL_AMT3"] - (-math.log1p(5.0))) < 1e-12
    clip = {x["ID"]: x["BILL_AMT3"] for x in E.apply_encoding(edge, {"bill_neg": "clip"}).collect()}
    assert clip[1] == 0.0


def test_unknown_group_raises():
    with pytest.raises(KeyError):
        FE.engineered_feature_names(["nope"])
