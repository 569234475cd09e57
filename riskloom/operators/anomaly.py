"""Isolation-forest anomaly score column (Liu, Ting & Zhou 2008).

Fit (training rows only):
1. Each tree's subsample are the rows with its ``psi`` (<= 256) smallest seeded hashes. A
   row's array of trees is filtered by a pre-set hash bound before it is exploded, so about
   2*psi rows per tree leave the scan, and only the chosen IDs fetch their features.
2. ``groupBy(tree).applyInPandas`` grows all trees in parallel (random feature,
   uniform split between the node's min and max, height limit ceil(log2 psi)).
3. The trees (<= T x (2*psi - 1) nodes, a fixed bound) are collected and broadcast.
Score: a vectorised pandas UDF walks every tree for a batch of rows and returns
``2 ** (-E[h(x)] / c(psi))`` — higher = more anomalous (the negated
``score_samples`` of the usual implementation), appended as a column.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import cut_lineage

EULER = 0.5772156649015329


def avg_path_length(n) -> np.ndarray:
    """c(n): average unsuccessful-search path length of a BST with n points."""
    n = np.asarray(n, dtype="float64")
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    return out


TREE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("split", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.IntegerType())])


def _grow(seed: int, max_height: int):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.stack(pdf["features"].to_numpy()).astype("float64")
        rng = np.random.default_rng([seed, tree])
        rows = []

        def grow(idx, depth):
            node = len(rows)
            rows.append([tree, node, -1, 0.0, -1, -1, len(idx)])
            if depth >= max_height or len(idx) <= 1:
                return node
            sub = x[idx]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            cand = np.flatnonzero(hi > lo)
            if cand.size == 0:
                return node
            f = int(rng.choice(cand))
            s = float(rng.uniform(lo[f], hi[f]))
            left = idx[sub[:, f] < s]
            right = idx[sub[:, f] >= s]
            rows[node][2], rows[node][3] = f, s
            rows[node][4] = grow(left, depth + 1)
            rows[node][5] = grow(right, depth + 1)
            return node

        grow(np.arange(len(x)), 0)
        return pd.DataFrame(rows, columns=[f.name for f in TREE_SCHEMA.fields])
    return build


class IsolationForestModel:
    def __init__(self, trees: pd.DataFrame, psi: int):
        self.psi = psi
        self.trees = []
        for _, t in trees.sort_values(["tree", "node"]).groupby("tree"):
            self.trees.append((t["feature"].to_numpy(), t["split"].to_numpy(),
                               t["left"].to_numpy(), t["right"].to_numpy(),
                               t["size"].to_numpy()))

    def path_lengths(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feat, split, left, right, size in self.trees:
            node = np.zeros(len(x), dtype=int)
            depth = np.zeros(len(x))
            active = feat[node] >= 0
            while active.any():
                f = feat[node[active]]
                go_left = x[active, f] < split[node[active]]
                node[active] = np.where(go_left, left[node[active]], right[node[active]])
                depth[active] += 1
                active = feat[node] >= 0
            total += depth + avg_path_length(size[node])
        return total / len(self.trees)

    def score_array(self, x: np.ndarray) -> np.ndarray:
        return np.power(2.0, -self.path_lengths(x) / avg_path_length([self.psi])[0])


def fit_isolation_forest(train: DataFrame, n_trees: int = 200, max_samples: int = 256,
                         seed: int = 2024, features: str = "features") -> IsolationForestModel:
    n = train.count()
    psi = int(min(max_samples, n))
    frac = min(1.0, 2.0 * psi / max(n, 1) + 1e-9)

    def u(tree):
        return F.pmod(F.xxhash64(F.lit(seed), tree, F.col("ID")), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))

    while True:  # widen the bound until every tree has psi candidates
        chosen = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: u(t) < F.lit(frac))
        cand = cut_lineage(train.select("ID", F.explode(chosen).alias("tree")).withColumn("u", u(F.col("tree"))))
        enough = cand.groupBy("tree").count().where(F.col("count") >= psi).count()
        if frac >= 1.0 or enough == n_trees:
            break
        frac = min(1.0, frac * 2.0)
    w = Window.partitionBy("tree").orderBy("u", "ID")
    ids = cand.withColumn("r", F.row_number().over(w)).where(F.col("r") <= psi).select("tree", "ID")
    sample = train.select("ID", F.col(features).alias("features")).join(ids, "ID").select("tree", "features")
    max_height = int(math.ceil(math.log2(max(psi, 2))))
    tdf = sample.groupBy("tree").applyInPandas(_grow(seed, max_height), TREE_SCHEMA).toPandas()
    return IsolationForestModel(tdf, psi)


def add_anomaly_score(df: DataFrame, model: IsolationForestModel, features: str = "features",
                      out: str = "anomaly_score") -> DataFrame:
    """Append the anomaly score with a vectorised (Arrow-batched) pandas UDF; the
    fitted trees travel once per executor in the UDF closure (broadcast)."""
    bc = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(feats: pd.Series) -> pd.Series:
        x = np.stack(feats.to_numpy()).astype("float64")
        return pd.Series(bc.value.score_array(x))

    return df.withColumn(out, score(F.col(features)))
