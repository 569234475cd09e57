"""SQL building blocks: the credit panel CTEs and NULL-aware expression helpers.

The panel text is the fixture definition in DuckDB dialect. Helpers mirror the
numpy NaN rules: NULL-propagating max / mean, NULL-as-false counts, guarded ratios.
"""

from __future__ import annotations

import numpy as np

PAY = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
BILL = [f"BILL_AMT{i}" for i in range(1, 7)]
AMT = [f"PAY_AMT{i}" for i in range(1, 7)]
CAT = ["SEX", "EDUCATION", "MARRIAGE"]
NUMERIC = ["LIMIT_BAL", "AGE"] + PAY + BILL + AMT
FEATURES = CAT + NUMERIC
GRID = [float(t) for t in np.linspace(0.05, 0.95, 181)]

DAYS = "date_diff('day', DATE '1998-04-15', CAST(l.l_shipdate AS DATE))"

PANEL_CTES = f"""
li AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_totalprice, o.o_orderpriority, COUNT(l.l_orderkey) AS n_lines,
    COALESCE(SUM(CASE WHEN l.l_linestatus='F' THEN CAST(ROUND(l.l_extendedprice*100) AS BIGINT) END),0) AS pay_c,
    COALESCE(SUM(CASE WHEN l.l_returnflag='R' THEN CAST(ROUND(l.l_extendedprice*100) AS BIGINT) END),0) AS ret_c,
    COALESCE(SUM(CASE WHEN l.l_linestatus='F' THEN 1 ELSE 0 END),0) AS n_paid,
    COALESCE(SUM({DAYS}),0) AS lag_days
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey=o.o_orderkey
  GROUP BY o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_totalprice, o.o_orderpriority),
st AS (
  SELECT o_custkey, o_orderpriority, pay_c/100.0E0 AS pay_amt, (CAST(ROUND(o_totalprice*100) AS BIGINT)-ret_c)/100.0E0 AS bill_amt,
    ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k,
    CASE WHEN n_lines=0 THEN -2
         WHEN lag_days > 200*n_lines THEN LEAST(9, CAST(FLOOR(lag_days/(200*n_lines)) AS INT))
         WHEN n_paid=n_lines THEN -1 ELSE 0 END AS code
  FROM li),
w AS (SELECT o_custkey,
    MAX(CASE WHEN k=1 THEN code END) AS c1, MAX(CASE WHEN k=1 THEN o_orderpriority END) AS pr,
    MAX(CASE WHEN k=2 THEN code END) AS PAY_0, MAX(CASE WHEN k=3 THEN code END) AS PAY_2, MAX(CASE WHEN k=4 THEN code END) AS PAY_3,
    MAX(CASE WHEN k=5 THEN code END) AS PAY_4, MAX(CASE WHEN k=6 THEN code END) AS PAY_5, MAX(CASE WHEN k=7 THEN code END) AS PAY_6,
    MAX(CASE WHEN k=2 THEN bill_amt END) AS BILL_AMT1,
    MAX(CASE WHEN k=3 THEN bill_amt END) AS BILL_AMT2,
    MAX(CASE WHEN k=4 THEN bill_amt END) AS BILL_AMT3,
    MAX(CASE WHEN k=5 THEN bill_amt END) AS BILL_AMT4,
    MAX(CASE WHEN k=6 THEN bill_amt END) AS BILL_AMT5,
    MAX(CASE WHEN k=7 THEN bill_amt END) AS BILL_AMT6,
    MAX(CASE WHEN k=2 THEN pay_amt END) AS PAY_AMT1,
    MAX(CASE WHEN k=3 THEN pay_amt END) AS PAY_AMT2,
    MAX(CASE WHEN k=4 THEN pay_amt END) AS PAY_AMT3,
    MAX(CASE WHEN k=5 THEN pay_amt END) AS PAY_AMT4,
    MAX(CASE WHEN k=6 THEN pay_amt END) AS PAY_AMT5,
    MAX(CASE WHEN k=7 THEN pay_amt END) AS PAY_AMT6
  FROM st WHERE k<=7 GROUP BY o_custkey),
panel AS (
SELECT w.o_custkey AS ID, c.c_acctbal*50 AS LIMIT_BAL, CAST(1+w.o_custkey%2 AS INT) AS SEX, CAST(c.c_nationkey%7 AS INT) AS EDUCATION,
  CAST(w.o_custkey%4 AS INT) AS MARRIAGE, CAST(21+w.o_custkey%50 AS INT) AS AGE, PAY_0,PAY_2,PAY_3,PAY_4,PAY_5,PAY_6,
  BILL_AMT1,BILL_AMT2,BILL_AMT3,BILL_AMT4,BILL_AMT5,BILL_AMT6,PAY_AMT1,PAY_AMT2,PAY_AMT3,PAY_AMT4,PAY_AMT5,PAY_AMT6,
  CAST(CASE WHEN c1>=3 OR (PAY_0>=1 AND pr<'4') THEN 1 ELSE 0 END AS INT) AS label
FROM w JOIN customer c ON c.c_custkey=w.o_custkey),
dev AS (SELECT * FROM panel WHERE ID % 5 <> 4),
evl AS (SELECT * FROM panel WHERE ID % 5 = 4)"""


def with_panel(*ctes: str, final: str) -> str:
    """``WITH <panel>, <ctes...> <final>``."""
    parts = [PANEL_CTES.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + final


def r6(x: str) -> str:
    return f"ROUND(CAST({x} AS DOUBLE), 6)"


def d(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def sgreatest(cols) -> str:
    nul = " OR ".join(f"({c}) IS NULL" for c in cols)
    return f"(CASE WHEN {nul} THEN NULL ELSE CAST(GREATEST({', '.join(cols)}) AS DOUBLE) END)"


def mean(cols) -> str:
    return "((" + " + ".join(d(c) for c in cols) + f") / {float(len(cols))})"


def cnt(conds) -> str:
    return "(" + " + ".join(f"COALESCE(CAST(({c}) AS DOUBLE), 0.0)" for c in conds) + ")"


def flag(cond: str) -> str:
    return f"COALESCE(CAST(({cond}) AS DOUBLE), 0.0)"


def ratio(num: str, den: str, valid: str, fb: str) -> str:
    return f"(CASE WHEN {valid} THEN {d(num)} / {d(den)} ELSE {fb} END)"


def grid_values() -> str:
    """VALUES list of (i, t) for the 181 cuts, literals exactly as numpy prints them."""
    return ", ".join(f"({i}, {repr(t)}E0)" if "e" not in repr(t) else f"({i}, {repr(t)})"
                     for i, t in enumerate(GRID))
