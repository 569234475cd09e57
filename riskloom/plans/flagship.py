"""Flagship plan: best global cut of a scorecard on the panel, applied to eval rows.

panel -> fold codes -> chosen feature families -> scorecard score ->
threshold histogram (one aggregation) -> best macro-F1 cut (a scalar) ->
``(Id, Predicted)`` for the evaluation rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import config
from riskloom.functions import features as FE
from riskloom.functions.scorecard import scorecard
from riskloom.operators import threshold as J
from riskloom.sources import panel as P


def scorecard_cut(spark: SparkSession, sf_dir: str, card: str = "A") -> tuple[float, float]:
    dev = P.development(P.credit_panel(spark, sf_dir))
    scored = dev.select("ID", "label", scorecard(card).alias("proba"))
    best = J.best_threshold(scored).collect()[0]
    return float(best["threshold"]), float(best["macro_f1"])


def scorecard_submission(spark: SparkSession, sf_dir: str, card: str = "A") -> DataFrame:
    cut, _ = scorecard_cut(spark, sf_dir, card)
    ev = P.evaluation(P.credit_panel(spark, sf_dir)) \
        .transform(FE.fold_undocumented_codes) \
        .transform(FE.make_feature_engineer(config.CHOSEN_FEATURE_GROUPS))
    return ev.select(F.col("ID").alias("Id"),
                     (scorecard(card) >= F.lit(cut)).cast("int").alias("Predicted"))
