"""Connected components of a link table, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import discard, stored


def _digest(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame, max_rounds: int = 40) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its
    smallest node.

    Alternating star contraction: every node hands its larger neighbours (then its
    smaller ones) to the smallest node it sees, until all links point at the smallest
    node of their component. Each step is a partial aggregate and a join on the node,
    so the links of a hot node are split across tasks. Neither step makes more than two
    rows of a link, so links are told apart once a round; a round's table goes when the
    next one is written.
    """
    edges = stored(_smaller(links.where("a <> b")), "links")
    seen = _digest(edges)
    if seen[0] == 0:
        return edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    for _ in range(max_rounds):
        both = _each(edges, ("a", "b"), ("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b")
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = _each(large.join(down, "b"), ("m", "a"), ("m", "b"))
        last, edges = edges, stored(_smaller(small.where("a <> b")), "links")
        discard(last)
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("links did not contract")
    return (edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
            .union(edges.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct())


def _each(rows: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """A link (a, b) for every row and pair of its columns, in one pass over ``rows``."""
    return rows.select(F.explode(F.array(*[F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in ends])).alias(
        "link")).select("link.*")


def _smaller(links: DataFrame) -> DataFrame:
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
