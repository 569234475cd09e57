"""Resampling of training rows (F1–F6) on a ``(ID, label, features)`` table.

* F1 random under-sampling: the majority class is cut to the minority count,
  keeping the rows with the smallest seeded hash rank (scalable exact rank, P3).
* F2 SMOTE: the minority class is grown to the majority count. The m synthetic
  rows are allocated evenly over the minority rows (each gets ``m // n_min`` and
  the first ``m % n_min`` by hash rank one more); each synthetic row takes one of
  its base row's k=5 same-class neighbours and a gap ``u`` from seeded hashes:
  ``x + u * (nn - x)``. Deterministic and engine-independent.
* F3 Borderline-SMOTE (borderline-1): only "danger" minority rows — at least half,
  but not all, of their m=10 nearest rows (any class) are majority — are bases.
* F4 Tomek links: mutual 1-NN pairs of opposite classes; drop the majority member
  (``drop="majority"``) or both (``drop="all"``, as inside SMOTE+Tomek).
* F5 SMOTE then Tomek (drop both); F6 SMOTE then ENN (drop rows whose 3 nearest
  neighbours are not all of their own class).
Neighbours come from ``search``: the exact blocked join of :mod:`riskloom.operators.knn`, or
:func:`riskloom.operators.lsh.knn_lsh` where the table is too large for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom import config
from riskloom.operators.knn import knn
from riskloom.session import cut_lineage


def _hash_u(*parts) -> F.Column:
    from riskloom.plans.models import hash_uniform
    return hash_uniform(*parts)


def hash_rank(df: DataFrame, seed: int, part: str = "label", out: str = "rk") -> DataFrame:
    """0-based rank within ``part`` by md5(seed:ID), ties by ID — via the
    prefix-cell offsets of the fold assignment (no class on one task)."""
    from riskloom.operators.folds import PREFIX_CHARS, fold_hash
    d = df.withColumn("_h", fold_hash(seed)).withColumn("_p", F.substring("_h", 1, PREFIX_CHARS))
    cells = d.groupBy(part, "_p").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(part).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offs = cells.withColumn("_off", F.coalesce(F.sum("_c").over(w), F.lit(0))).drop("_c")
    d = d.join(F.broadcast(offs), [part, "_p"])  # <= 2 x 4096 rows: bounded
    wr = Window.partitionBy(part, "_p").orderBy("_h", "ID")
    return d.withColumn(out, F.row_number().over(wr) + F.col("_off") - 1).drop("_h", "_p", "_off")


def class_counts(df: DataFrame) -> dict:
    return {int(r["label"]): int(r["n"]) for r in
            df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}


def _minority_majority(df: DataFrame):
    c = class_counts(df)
    mino = min(c, key=lambda k: (c[k], k))
    majo = max(c, key=lambda k: (c[k], -k))
    return mino, majo, c


def undersample(df: DataFrame, seed: int = config.SEED) -> DataFrame:
    """majority class down to the minority count (all minority rows kept)."""
    mino, majo, c = _minority_majority(df)
    r = hash_rank(df, seed)
    return r.where((F.col("label") == mino) | (F.col("rk") < c[mino])).drop("rk")


def smote(df: DataFrame, seed: int = config.SEED, k: int = 5, bases: DataFrame | None = None,
          search: Callable[..., DataFrame] = knn) -> DataFrame:
    """original rows + synthetic minority rows (``synthetic`` flag, new negative IDs)."""
    mino, majo, c = _minority_majority(df)
    m = c[majo] - c[mino]
    minority = df.where(F.col("label") == mino).select("ID", "features")
    out = df.select("ID", "label", "features", F.lit(False).alias("synthetic"))
    if m <= 0:
        return out
    base = minority if bases is None else bases.select("ID", "features")
    n_base = base.count()
    if n_base == 0:
        return out
    nn = search(base, minority, k, exclude_self=True)
    ranked = hash_rank(base.withColumn("label", F.lit(mino)), seed)
    q, r = divmod(m, n_base)
    per = ranked.select("ID", "features", "rk",
                        (F.lit(q) + F.when(F.col("rk") < r, 1).otherwise(0)).alias("cnt"))
    syn = per.where(F.col("cnt") > 0).select(
        "ID", "features", "rk", F.explode(F.sequence(F.lit(0), F.col("cnt") - 1)).alias("j"))
    syn = syn.withColumn("pick", (F.floor(_hash_u("nn", seed, F.col("ID"), F.col("j")) * k) + 1)
                         .cast("int")) \
        .withColumn("gap", _hash_u("gap", seed, F.col("ID"), F.col("j")))
    nbr = nn.select(F.col("qid").alias("ID"), F.col("rank").cast("int").alias("pick"), "nid")
    # neighbour lists can be shorter than k on tiny classes: wrap the pick
    nmax = nn.groupBy(F.col("qid").alias("ID")).agg(F.max("rank").cast("int").alias("nmax"))
    syn = syn.join(nmax, "ID").withColumn(
        "pick", ((F.col("pick") - 1) % F.col("nmax")) + 1).join(nbr, ["ID", "pick"])
    feats = minority.select(F.col("ID").alias("nid"), F.col("features").alias("nf"))
    syn = syn.join(feats, "nid")
    newf = F.zip_with("features", "nf", lambda a, b: a + F.col("gap") * (b - a))
    # ranks are distinct and a base has q or q + 1 rows, so no two rows share a number
    new_id = -(F.col("rk") * F.lit(q + 1) + F.col("j") + 1)
    s = syn.select(new_id.alias("ID"), F.lit(mino).alias("label"), newf.alias("features"),
                   F.lit(True).alias("synthetic"))
    return out.unionByName(s)


def danger_rows(df: DataFrame, m: int = 10, search: Callable[..., DataFrame] = knn) -> DataFrame:
    """F3 selection: minority rows with m/2 <= #majority neighbours < m."""
    mino, majo, _ = _minority_majority(df)
    minority = df.where(F.col("label") == mino).select("ID", "features")
    nn = search(minority, df.select("ID", "features"), m, exclude_self=True)
    lab = df.select(F.col("ID").alias("nid"), F.col("label").alias("nl"))
    cnt = nn.join(lab, "nid").groupBy("qid").agg(F.count_if(F.col("nl") == majo).alias("n_maj"))
    danger = cnt.where((F.col("n_maj") * 2 >= m) & (F.col("n_maj") < m)).select(
        F.col("qid").alias("ID"))
    return minority.join(danger, "ID")


def borderline_smote(df: DataFrame, seed: int = config.SEED, k: int = 5, m: int = 10,
                     search: Callable[..., DataFrame] = knn) -> DataFrame:
    """SMOTE from the danger rows only."""
    return smote(df, seed, k, bases=danger_rows(df, m, search), search=search)


def tomek_links(df: DataFrame, search: Callable[..., DataFrame] = knn) -> DataFrame:
    """(a, b) pairs, a < b, of opposite classes that are each other's 1-NN."""
    x = df.select("ID", "features")
    nn = search(x, x, 1, exclude_self=True).select("qid", "nid")
    lab = df.select("ID", "label")
    pairs = nn.alias("a").join(nn.alias("b"), (F.col("a.qid") == F.col("b.nid")) &
                               (F.col("a.nid") == F.col("b.qid")))
    pairs = pairs.select(F.col("a.qid").alias("a"), F.col("a.nid").alias("b")) \
        .where(F.col("a") < F.col("b"))
    pairs = pairs.join(lab.select(F.col("ID").alias("a"), F.col("label").alias("la")), "a") \
        .join(lab.select(F.col("ID").alias("b"), F.col("label").alias("lb")), "b")
    return pairs.where(F.col("la") != F.col("lb")).select("a", "b", "la", "lb")


def tomek(df: DataFrame, drop: str = "majority", search: Callable[..., DataFrame] = knn) -> DataFrame:
    """remove Tomek-link members (majority member, or both with ``drop='all'``)."""
    links = tomek_links(df, search)
    if drop == "all":
        gone = links.select(F.col("a").alias("ID")).unionByName(links.select(F.col("b").alias("ID")))
    else:
        _, majo, _ = _minority_majority(df)
        gone = links.select(F.when(F.col("la") == majo, F.col("a")).otherwise(F.col("b")).alias("ID"))
    return df.join(gone.distinct(), "ID", "left_anti")


def smote_tomek(df: DataFrame, seed: int = config.SEED, search: Callable[..., DataFrame] = knn) -> DataFrame:
    """SMOTE, then drop both members of every Tomek link."""
    s = cut_lineage(smote(df, seed, search=search))
    return tomek(s, drop="all", search=search)


def enn(df: DataFrame, k: int = 3, search: Callable[..., DataFrame] = knn) -> DataFrame:
    """Edited nearest neighbours: keep rows whose k nearest rows all share their class."""
    x = df.select("ID", "features")
    nn = search(x, x, k, exclude_self=True)
    lab = df.select(F.col("ID").alias("nid"), F.col("label").alias("nl"))
    own = df.select(F.col("ID").alias("qid"), F.col("label").alias("ql"))
    bad = nn.join(lab, "nid").join(own, "qid").groupBy("qid") \
        .agg(F.bool_and(F.col("nl") == F.col("ql")).alias("same")) \
        .where(~F.col("same")).select(F.col("qid").alias("ID"))
    return df.join(bad, "ID", "left_anti")


def smote_enn(df: DataFrame, seed: int = config.SEED, search: Callable[..., DataFrame] = knn) -> DataFrame:
    """SMOTE, then edited nearest neighbours (k=3) on all classes."""
    return enn(cut_lineage(smote(df, seed, search=search)), 3, search)


SAMPLERS = {"undersample": undersample, "smote": smote, "borderline": borderline_smote,
            "smotetomek": smote_tomek, "smoteenn": smote_enn}
