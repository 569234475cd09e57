"""Exact, scalable order statistics.

``percentile`` (exact) keeps every distinct value of a group in one buffer, so a
whole-column median would land on one task. Instead:

1. one aggregate computes ``count`` and a narrow value window around each wanted
   rank with ``percentile_approx`` (rank error <= n / accuracy);
2. windows that still hold many distinct values are narrowed again around the rank; then
   one pass ranks the distinct values inside (a bounded number, ties collapsed);
3. only the two neighbouring order statistics per target reach the driver, and are
   interpolated exactly like numpy's ``linear`` method.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
#: distinct values that one task orders for a target
IN_WINDOW = 5_000


def _lerp(a: float, b: float, t: float) -> float:
    d = b - a
    return b - d * (1 - t) if t >= 0.5 else a + d * t


def sql_double(x: float) -> str:
    """A double as a SQL literal that parses back to the same value."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _long(df: DataFrame, cols) -> DataFrame:
    """(j, v): the non-null values of the columns by column number. One expression, so that
    wide tables cost no more driver time than narrow ones."""
    items = ", ".join(f"struct({j} AS j, CAST(`{c}` AS DOUBLE) AS v)" for j, c in enumerate(cols))
    return df.selectExpr(f"inline(array({items}))").where("v IS NOT NULL")


def exact_quantiles(df: DataFrame, cols, probs, accuracy: int = ACCURACY) -> dict:
    """{col: [q(p) for p in probs]} with numpy/pandas linear interpolation; NULLs
    ignored; an all-NULL column gives NaN."""
    cols, probs = list(cols), [float(p) for p in probs]
    out = {c: [float("nan")] * len(probs) for c in cols}
    if not cols or not probs:
        return out
    eps = 2.0 / accuracy
    rows = _long(df, cols)
    shares = [max(0.0, p - 2 * eps) for p in probs] + [min(1.0, p + 2 * eps) for p in probs]
    wanted = ", ".join(map(repr, shares))
    first = rows.groupBy("j").agg(F.expr("count(*) AS n"), F.expr(f"percentile_approx(v, array({wanted}), {accuracy}) AS w")).collect()
    targets = []  # (tid, column number, window lo, hi, r_lo, r_hi, fraction, probability number)
    for r in first:
        for pi, p in enumerate(probs):
            h = (r["n"] - 1) * p
            r_lo = math.floor(h)
            r_hi = min(r_lo + 1, r["n"] - 1) if h > r_lo else r_lo
            targets.append((len(targets), r["j"], float(r["w"][pi]), float(r["w"][len(probs) + pi]), r_lo, r_hi, h - r_lo, pi))
    found = _rank_values(rows, targets) if targets else {}
    missing = [t for t in targets if t[0] not in found]
    if missing:  # approximate window missed (not expected): start from the whole range
        wide = [(t[0], t[1], float("-inf"), float("inf"), *t[4:]) for t in missing]
        found.update(_rank_values(rows, wide))
    for tid, j, _, _, _, _, frac, pi in targets:
        a, b = found[tid]
        out[cols[j]][pi] = a if frac == 0 else _lerp(a, b, frac)
    return out


def _rank_values(rows: DataFrame, targets) -> dict:
    """Values at ranks r_lo / r_hi of each target. One aggregate counts the values below and
    in each window; windows with more than ``IN_WINDOW`` distinct values are narrowed again
    around the wanted rank, so the window that is finally ordered is small for any number
    of rows. Ties are collapsed by a grouped count, and a running sum from the count below
    locates the two ranks."""
    spark = rows.sparkSession
    span = {t[0]: (t[2], t[3]) for t in targets}
    eps = 4.0 / ACCURACY

    def windowed(ids):
        w = spark.createDataFrame([(t[0], t[1], *span[t[0]]) for t in targets if t[0] in ids], "tid int, j int, lo double, hi double")
        return rows.join(F.broadcast(w), "j")  # one row per target: bounded

    open_ids = set(span)
    counts: dict = {}
    while open_ids:
        inside = "v >= lo AND v <= hi"
        for r in windowed(open_ids).groupBy("tid").agg(
                F.expr("count_if(v < lo) AS b"), F.expr(f"count_if({inside}) AS n"),
                F.expr(f"approx_count_distinct(CASE WHEN {inside} THEN v END) AS d")).collect():
            counts[r["tid"]] = r
        wide = {t[0]: t for t in targets if t[0] in open_ids and counts[t[0]]["d"] > IN_WINDOW}
        if not wide:
            break
        shares = {k: [min(1.0, max(0.0, (r - counts[k]["b"]) / counts[k]["n"] + e)) for r, e in ((t[4], -eps), (t[5], eps))]
                  for k, t in wide.items()}
        every = sorted({x for v in shares.values() for x in v})
        got = windowed(set(wide)).where(inside).groupBy("tid").agg(F.expr(
            f"percentile_approx(v, array({', '.join(map(repr, every))}), {ACCURACY}) AS w")).collect()
        moved = {r["tid"]: tuple(float(r["w"][every.index(x)]) for x in shares[r["tid"]]) for r in got}
        open_ids = {k for k, v in moved.items() if span[k] != v}
        span.update(moved)
    ranks = spark.createDataFrame([(t[0], int(t[4]), int(t[5]), int(counts[t[0]]["b"])) for t in targets if t[0] in counts],
                                  "tid int, r_lo long, r_hi long, below long")
    cnt = windowed(set(counts)).where("v >= lo AND v <= hi").groupBy("tid", "v").agg(F.count(F.lit(1)).alias("cnt"))
    w = Window.partitionBy("tid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    j = cnt.join(F.broadcast(ranks), "tid")  # one row per target: bounded
    j = j.withColumn("end", F.col("below") + F.sum("cnt").over(w)).withColumn("start", F.col("end") - F.col("cnt"))
    hit_lo = (F.col("r_lo") >= F.col("start")) & (F.col("r_lo") < F.col("end"))
    hit_hi = (F.col("r_hi") >= F.col("start")) & (F.col("r_hi") < F.col("end"))
    res = j.where(hit_lo | hit_hi).groupBy("tid").agg(
        F.max(F.when(hit_lo, F.col("v"))).alias("a"),
        F.max(F.when(hit_hi, F.col("v"))).alias("b")).collect()
    return {r["tid"]: (r["a"], r["b"]) for r in res if r["a"] is not None and r["b"] is not None}


def median_values(df: DataFrame, cols) -> dict:
    q = exact_quantiles(df, cols, [0.5])
    return {c: v[0] for c, v in q.items()}
