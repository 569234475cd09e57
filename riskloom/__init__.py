"""riskloom — Spark-native analytics for imbalanced binary-outcome panels.

Row-wise feature families and encodings are Column expressions
(:mod:`riskloom.functions`), fitted transforms / folds / metrics / decision-cut
operators are DataFrame jobs (:mod:`riskloom.operators`), learners and
out-of-fold scoring are Spark ML plans (:mod:`riskloom.plans`), and the credit
panel plus submission sinks live in :mod:`riskloom.sources`.
"""

from riskloom.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
