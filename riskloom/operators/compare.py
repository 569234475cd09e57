"""Screen and paired repeated-CV comparison reports.

Input: a results table ``(model, seed, macro_f1)`` — typically one J1 histogram job
over the whole OOF score table (all models and seeds at once). Everything here is
arithmetic over that small table: a join on seed with the anchor's rows, ordered
means, population std, win counts, a verdict ``when`` chain and a ranking.

FIXED VALUES: verdict labels "KEEP (robust)", "keep? (robust but small)",
"watch (not all seeds)", "revert"; KEEP needs all seeds won and mean gain >= 0.005.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom import config
from riskloom.operators.threshold import ordered_mean


def screen_vs_anchor(results: DataFrame, anchor: str, f1: str = "macro_f1") -> DataFrame:
    """Delta of every candidate's best-cut F1 vs the anchor row; ``promising``
    marks candidates above the anchor (they go on to paired validation)."""
    a = results.where(F.col("model") == anchor).select(f1).first()
    if a is None:
        raise ValueError(f"anchor {anchor!r} has no result")
    base = F.lit(float(a[0]))
    c = results.where(F.col("model") != anchor)
    d = F.col(f1) - base
    return c.select("model", F.col(f1).alias("macro_f1"), base.alias("anchor_f1"),
                    d.alias("delta"), (d > 0).alias("promising"))


def paired_report(results: DataFrame, anchor: str, seeds, f1: str = "macro_f1",
                  keep_gain: float = config.KEEP_GAIN) -> DataFrame:
    """Per-seed deltas vs the anchor -> mean, std_pop, wins, verdict, rank and
    the recommendation (largest mean gain among candidates winning every seed)."""
    spark = results.sparkSession
    order = spark.createDataFrame([(int(s), i) for i, s in enumerate(seeds)],
                                  "seed int, seed_idx int")
    r = results.join(F.broadcast(order), "seed")
    a = r.where(F.col("model") == anchor).select("seed", F.col(f1).alias("a"))
    c = r.where(F.col("model") != anchor).join(a, "seed") \
        .withColumn("d", F.col(f1) - F.col("a"))
    n = len(list(seeds))
    g = c.groupBy("model").agg(
        ordered_mean("seed_idx", f1).alias("f1_mean"),
        F.stddev_pop(f1).alias("f1_std"),
        ordered_mean("seed_idx", "d").alias("dmean"),
        F.count_if(F.col("d") > 0).alias("wins"),
        F.count(F.lit(1)).alias("n_seeds"))
    verdict = (F.when((F.col("wins") == n) & (F.col("dmean") >= keep_gain), "KEEP (robust)")
               .when((F.col("wins") == n) & (F.col("dmean") > 0), "keep? (robust but small)")
               .when(F.col("dmean") > 0, "watch (not all seeds)").otherwise("revert"))
    # one row per candidate model: the ranking windows are bounded by the spec list
    w = Window.orderBy(F.col("dmean").desc(), F.col("wins").desc(), F.col("model").desc())
    ranked = g.withColumn("verdict", verdict).withColumn("rank", F.row_number().over(w))
    wr = Window.orderBy(F.when(F.col("wins") == n, F.col("dmean")).desc_nulls_last(),
                        F.col("rank"))
    rec = ranked.withColumn("_r", F.row_number().over(wr))
    return rec.select("model", "f1_mean", "f1_std", "dmean", "wins", "n_seeds", "verdict", "rank",
                      ((F.col("_r") == 1) & (F.col("wins") == n)).alias("recommended"))
