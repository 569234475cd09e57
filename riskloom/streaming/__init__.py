"""Streaming application of fitted row-wise plans.

The analysed project is batch-only, so there are no streaming operators. What
carries over is that every row-wise step (code folding, feature families,
encodings, a fitted preprocessor, a fitted Spark ML model and a decision cut) is a
stateless projection, so the same plan applies unchanged to a streaming DataFrame.
"""

from riskloom.streaming.score import score_stream

__all__ = ["score_stream"]
