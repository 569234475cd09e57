"""Score a stream of panel rows with a fitted pipeline and a tuned cut."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def score_stream(stream: DataFrame, fitted, cut: float) -> DataFrame:
    """``(Id, proba, Predicted)`` for every arriving row; ``fitted`` is a fitted
    :class:`riskloom.plans.models.ModelPipeline` (or soft vote) — stateless, so no
    watermark or state store is needed."""
    s = fitted.score(stream, keep=("ID",))
    return s.select(F.col("ID").alias("Id"), "proba",
                    (F.col("proba") >= F.lit(float(cut))).cast("int").alias("Predicted"))
