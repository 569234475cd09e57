"""Learners (G1–G10) and the standard composition.

``make_pipeline(kind, params, groups, encoding)`` returns an unfitted
:class:`ModelPipeline`; ``fit(train)`` fits the preprocessor on the training rows
only (leakage-safe) and the learner on its output; ``score(df)`` returns
``(ID, proba)`` — the positive-class probability. ``fit_together`` fits many pipelines:
those of one split, encoding and feature set share their prepared rows, and all tree
learners among them grow in one Spark job (``operators/trees.py``).

Parameter map:

* ``logreg``: L2 logistic, C=1 -> ``regParam = 1 / sum(weights)`` (Spark averages
  the loss), no internal standardisation, ``maxIter`` from ``max_iter``.
* ``rf``: bootstrap by Poisson counts, square-root feature subsets, cuts at 64 quantile
  bins, leaf and split minima, share of rows, class weights (global or per bootstrap).
* ``et``: one random cut per node and feature, no bootstrap.
* ``hgb``: best-first growth to ``max_leaf_nodes`` (31), 100 rounds, step 0.1, 255 bins,
  leaf >= 20, ``l2_regularization``, feature subsets per node.
* ``gb``: depth 3, splits by squared error of the residuals, Newton leaf values.
* ``lgbm`` presets: best-first with ``num_leaves``, row and column subsampling, L2. The
  library itself is not used.
* ``catboost`` presets: oblivious trees, ordered boosting, L2 (3 where not set); a step
  left to the library is 0.1.
* Early stopping is off unless a spec sets ``early_stopping`` (with ``validation_fraction``
  of the rows held out by hash); then every fit of a job stops the same way.
* ``effective_params`` tells what the learner is given; specs with equal ones fit alike.
* ``dummy`` (G1): draws 1 with the training prior from a seeded hash of (seed, ID).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import config
from riskloom.functions import encode as E
from riskloom.functions import features as FE
from riskloom.operators.prep import Preprocessor, fit_preprocessor
from riskloom.operators.trees import Spec, add_proba, fit_many
from riskloom.session import cut_lineage

MAX_DEPTH = 60  # paths from the root are 64-bit numbers
TREE_KINDS = ("rf", "et", "hgb", "gb", "lgbm", "catboost")
ROWS_PER_PARTITION = 50_000


def hash_uniform(*parts) -> F.Column:
    """Deterministic U[0,1) from md5 of the parts (engine-independent)."""
    s = F.concat_ws(":", *[p if isinstance(p, F.Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


# ------------------------------------------------------------------ G9
def class_weights(train: DataFrame, spec, label: str = "label") -> dict:
    """balanced -> n / (2 n_c) from one ``groupBy(label).count()``; or an explicit map."""
    if spec is None:
        return {}
    if isinstance(spec, dict):
        return {int(k): float(v) for k, v in spec.items()}
    if spec in ("balanced", "balanced_subsample"):
        counts = {int(r[label]): int(r["n"]) for r in
                  train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
        n = sum(counts.values())
        return {c: n / (len(counts) * k) for c, k in counts.items()}
    raise ValueError(f"unknown class_weight {spec!r}")


def weight_column(weights: dict, label: str = "label") -> F.Column:
    if not weights:
        return F.lit(1.0)
    expr = F.lit(1.0)
    for c, w in sorted(weights.items()):
        expr = F.when(F.col(label) == c, F.lit(float(w))).otherwise(expr)
    return expr


def _weights(spec):
    """Class weights as a tree learner takes them."""
    return (float(spec.get(0, 1.0)), float(spec.get(1, 1.0))) if isinstance(spec, dict) else spec


def tree_spec(kind: str, params: dict | None = None) -> Spec:
    """The tree learner that a model kind and its parameters stand for."""
    p = dict(params or {})
    depth = min(int(p.get("max_depth") or MAX_DEPTH), MAX_DEPTH)
    weights = _weights(p.get("class_weight"))
    if kind in ("rf", "et"):
        return Spec("forest" if kind == "rf" else "extra", trees=int(p.get("n_estimators", 100)), depth=depth,
                    leaf_rows=int(p.get("min_samples_leaf", 1)), split_rows=int(p.get("min_samples_split", 2)),
                    bins=int(p.get("max_bins", 64 if kind == "rf" else 255)), node_features=p.get("max_features", "sqrt"),
                    rows=float(p.get("max_samples") or 1.0), bootstrap=bool(p.get("bootstrap", kind == "rf")),
                    impurity=p["criterion"] if p.get("criterion") in ("gini", "entropy") else "gini", weights=weights)
    boost = {"weights": "balanced" if weights == "balanced_subsample" else weights, "step": float(p.get("learning_rate", 0.1)),
             "held_out": float(p.get("validation_fraction", 0.1)) if p.get("early_stopping") is True else 0.0}
    if kind == "hgb":
        share = p.get("max_features")
        return Spec("boost", trees=int(p.get("max_iter", 100)), depth=depth, leaves=int(p.get("max_leaf_nodes", 31)),
                    leaf_rows=int(p.get("min_samples_leaf", 20)), l2=float(p.get("l2_regularization", 0.0)),
                    bins=int(p.get("max_bins", 255)), node_features=None if share in (None, 1.0) else float(share),
                    impurity="newton", **boost)
    if kind == "gb":
        depth = int(p.get("max_depth", 3))
        return Spec("boost", trees=int(p.get("n_estimators", 100)), depth=depth, leaves=1 << depth,
                    leaf_rows=int(p.get("min_samples_leaf", 1)), leaf_hessian=0.0, rows=float(p.get("subsample", 1.0)),
                    impurity="mse", **boost)
    if kind == "lgbm":
        return Spec("boost", trees=int(p.get("n_estimators", 100)), depth=depth, leaves=int(p.get("num_leaves", 31)),
                    leaf_rows=int(p.get("min_child_samples", 20)), l2=float(p.get("reg_lambda", 0.0)),
                    tree_features=float(p.get("colsample_bytree", 1.0)),
                    rows=float(p.get("subsample", 1.0)) if p.get("subsample_freq") else 1.0, impurity="newton", **boost)
    if kind == "catboost":
        return Spec("oblivious", trees=int(p.get("iterations", 1000)), depth=int(p.get("depth", 6)), leaf_hessian=0.0,
                    l2=float(p.get("l2_leaf_reg", 3.0)), impurity="newton", **boost)
    raise ValueError(f"unknown estimator kind {kind!r}")


def effective_params(kind: str, params: dict | None = None) -> dict:
    """The settings that reach the learner for a spec; specs with equal settings fit alike."""
    p = dict(params or {})
    if kind == "dummy":
        return {}
    if kind == "logreg":
        return {"max_iter": int(p.get("max_iter", 100)), "weights": p.get("class_weight")}
    return asdict(tree_spec(kind, p))


def make_estimator(kind: str, params: dict | None = None, weighted: bool = False):
    """The linear learner (``dummy`` is scored by hash, trees are fitted by ``fit_many``)."""
    if kind != "logreg":
        raise ValueError(f"no estimator for kind {kind!r}")
    return LogisticRegression(maxIter=int((params or {}).get("max_iter", 100)), elasticNetParam=0.0, standardization=False,
                              tol=1e-6, featuresCol="features", labelCol="label",
                              **({"weightCol": "weight"} if weighted else {}))


# ------------------------------------------------------------------ G10
@dataclass
class ModelPipeline:
    """fold codes -> [engineer] -> [encode] -> [target encoder] -> fitted preprocessor ->
    [anomaly score] -> [sampler] -> learner.

    The bracketed fitted stages see training rows only, and the sampler only changes what
    the learner is fitted on: ``target`` replaces the one-hot columns by target codes,
    ``anomaly`` = {"n_trees": ..., "max_samples": ...} appends an isolation-forest score,
    ``sampler`` names one of ``resample.SAMPLERS``.
    """

    kind: str
    params: dict = field(default_factory=dict)
    groups: list = field(default_factory=list)
    encoding: dict = field(default_factory=dict)
    seed: int = config.SEED
    sampler: str | None = None
    anomaly: dict | None = None
    target: bool = False
    pre: Preprocessor | None = None
    model: object = None
    prior: float | None = None
    forest: object = None
    encoder: object = None
    ready: bool = False

    def prepare(self, df: DataFrame) -> DataFrame:
        if self.ready:  # its rows come prepared
            return df
        out = FE.fold_undocumented_codes(df)
        if self.groups:
            out = FE.add_engineered_features(out, self.groups)
        if self.encoding:
            out = E.apply_encoding(out, self.encoding)
        return out

    def extra_numeric(self) -> list[str]:
        return E.encoding_extra_columns(self.encoding) + FE.engineered_feature_names(self.groups)

    def _matrix(self, df: DataFrame, keep) -> DataFrame:
        x = self.pre.transform(self.prepare(df), keep=keep)
        va = VectorAssembler(inputCols=self.pre.output_columns(), outputCol="features",
                             handleInvalid="keep")
        return va.transform(x)

    def _arrays(self, prepared: DataFrame, keep) -> DataFrame:
        """``keep`` and the preprocessed row (with the anomaly score) as one array."""
        from riskloom.operators.anomaly import add_anomaly_score
        x = self.pre.transform(prepared, keep=keep)
        x = x.selectExpr(*[f"`{k}`" for k in keep], f"array({', '.join(f'`{c}`' for c in self.pre.output_columns())}) AS features")
        if self.forest is not None:
            x = add_anomaly_score(x, self.forest, out="_anomaly")
            x = x.withColumn("features", F.concat("features", F.array("_anomaly"))).drop("_anomaly")
        return x

    def _training_rows(self, train: DataFrame) -> DataFrame:
        """(ID, label, features) that the learner is fitted on, where a fitted stage is set."""
        from riskloom.operators.anomaly import fit_isolation_forest
        from riskloom.operators.resample import SAMPLERS
        from riskloom.operators.target import TargetEncoder
        prepared = self.prepare(train)
        numeric = self.extra_numeric()
        if self.target:
            self.encoder = TargetEncoder(seed=self.seed)
            prepared = cut_lineage(self.encoder.fit_transform(prepared))
            numeric = numeric + self.encoder.cols
        self.pre = fit_preprocessor(prepared, numeric, scale=self.encoding.get("scale", True) if self.encoding else True,
                                    categorical=[] if self.target else None)
        self.forest = None
        if self.anomaly is not None:
            rows = cut_lineage(self._arrays(prepared, ("ID", "label")))
            self.forest = fit_isolation_forest(rows, seed=self.seed, **self.anomaly)
        rows = cut_lineage(self._arrays(prepared, ("ID", "label")))
        if self.sampler:
            rows = cut_lineage(SAMPLERS[self.sampler](rows, self.seed).select("ID", "label", "features"))
        return rows

    @property
    def staged(self) -> bool:
        return bool(self.sampler or self.target or self.anomaly is not None)

    def shares(self) -> tuple:
        """What the prepared training rows depend on besides the split."""
        own = self.seed if self.staged else None
        return repr((self.groups, sorted(self.encoding.items()), self.sampler, self.anomaly, self.target, own))

    def fit(self, train: DataFrame) -> "ModelPipeline":
        if self.kind in TREE_KINDS:
            return fit_together([(self, train, 0)])[0]
        if self.kind == "dummy":
            self.prior = train.agg(F.avg(F.col("label").cast("double"))).collect()[0][0]
            return self
        spec = self.params.get("class_weight")
        if self.staged:
            train = self._training_rows(train)
            weights = class_weights(train, spec)
            m = train.withColumn("weight", weight_column(weights)).withColumn(
                "features", array_to_vector("features"))
        else:
            self.pre = fit_preprocessor(self.prepare(train), self.extra_numeric(),
                                        scale=self.encoding.get("scale", True) if self.encoding else True)
            weights = class_weights(train, spec)
            m = self._matrix(train.withColumn("weight", weight_column(weights)), keep=("ID", "label", "weight"))
        est = make_estimator(self.kind, self.params, weighted=bool(weights))
        # sized by rows alone: small fits stay on few tasks, large fits spread over the cluster
        parts = max(1, -(-train.count() // ROWS_PER_PARTITION))
        # the learner re-reads its input every round: keep the prepared matrix for the fit
        m = m.repartition(parts, "ID").sortWithinPartitions("ID") \
            .persist(StorageLevel.MEMORY_AND_DISK)
        m.count()
        total_w = m.agg(F.sum("weight")).collect()[0][0]
        est.setRegParam(1.0 / float(total_w))
        try:
            self.model = est.fit(m)
        finally:
            m.unpersist()
        return self

    def score(self, df: DataFrame, keep=("ID",)) -> DataFrame:
        """(keep..., proba) with proba = P(label = 1)."""
        keep = [k for k in keep if k in df.columns]
        if self.kind == "dummy":
            u = hash_uniform("dummy", self.seed, F.col("ID"))
            return df.select(*keep, (u < F.lit(float(self.prior))).cast("double").alias("proba"))
        if self.staged or self.kind in TREE_KINDS:
            prepared = self.prepare(df)
            if self.target:
                prepared = self.encoder.transform(prepared)
            m = self._arrays(prepared, keep)
            if self.kind in TREE_KINDS:
                return add_proba(m, self.model).select(*keep, "proba")
            m = m.withColumn("features", array_to_vector("features"))
        else:
            m = self._matrix(df, keep=keep)
        out = self.model.transform(m)
        return out.select(*keep, vector_to_array("probability")[1].alias("proba"))


def fit_together(jobs, parallel: int = 8) -> list:
    """Fit ``(model, training rows, split key)`` jobs; returns the models. Pipelines of one
    split key whose preparation is the same share it, and all tree learners grow in one job.
    Anything else with a ``fit`` is fitted beside them."""
    trees = [j for j in jobs if isinstance(j[0], ModelPipeline) and j[0].kind in TREE_KINDS]
    rest = [j for j in jobs if not (isinstance(j[0], ModelPipeline) and j[0].kind in TREE_KINDS)]
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        rows: dict = {}
        first: dict = {}
        for pipe, train, key in trees:
            at = (key, pipe.shares())
            if at not in rows:
                first[at] = pipe
                rows[at] = pool.submit(pipe._training_rows, train)
        others = [pool.submit(model.fit, train) for model, train, _ in rest]
        fits = []
        for pipe, _, key in trees:
            at = (key, pipe.shares())
            fits.append((rows[at].result(), tree_spec(pipe.kind, pipe.params), pipe.seed))
            lead = first[at]
            pipe.pre, pipe.forest, pipe.encoder = lead.pre, lead.forest, getattr(lead, "encoder", None)
        for (pipe, _, _), model in zip(trees, fit_many(fits)):
            pipe.model = model
        for x in others:
            x.result()
    return [model for model, _, _ in jobs]


def score_members(members, df: DataFrame, keep, names) -> DataFrame:
    """``keep`` and one probability column per fitted model, all added to the same rows:
    the frame travels along as one struct, so nothing is scanned twice or joined."""
    keep = [k for k in keep if k in df.columns]
    out = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    for i, (m, name) in enumerate(zip(members, names)):
        done = list(names[:i])
        out = m.score(out.select("_row", *done, "_row.*"), keep=["_row", *done]).withColumnRenamed("proba", name)
    return out.select(*[F.col(f"_row.`{k}`").alias(k) for k in keep], *names, "_row")


def make_pipeline(kind: str, params: dict | None = None, groups=(), encoding=None,
                  seed: int = config.SEED) -> ModelPipeline:
    return ModelPipeline(kind, dict(params or {}), list(groups), dict(encoding or {}), seed)


def pipeline_for(name: str, groups=(), seed: int = config.SEED, overrides: dict | None = None,
                 **stages) -> ModelPipeline:
    """Named model (model / imbalance / boosting / resampling registries) with its own
    encoding; ``stages`` are the pipeline's fitted stages."""
    if name in config.RESAMPLING_CONFIGS:
        spec = config.RESAMPLING_CONFIGS[name]
        return pipeline_for(spec["base_model"], groups, seed, overrides, sampler=spec["sampler"], **stages)
    if name == "dummy":
        return make_pipeline("dummy", {}, groups, config.ENCODING_CONFIGS["baseline"], seed)
    spec = config.resolve_model_spec(name)
    params = {**spec["params"], **(overrides or {})}
    enc = config.ENCODING_CONFIGS[spec.get("encoding", "baseline")]
    return ModelPipeline(spec["kind"], params, list(groups), dict(enc), seed, **stages)


def dummy_oof(folds: DataFrame, seed: int, fold: str = "fold") -> DataFrame:
    """G1 out-of-fold in one pass: each fold's prior comes from the OTHER folds
    (fold totals minus own, a table of k rows), then a seeded hash draw per row —
    the same scores as fitting the prior-sampling floor on each training split."""
    from pyspark.sql import Window
    y = F.col("label").cast("long")
    per = folds.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("p"))
    w = Window.partitionBy(F.lit(0))  # k rows (one per fold): a bounded window
    prior = per.select(fold, ((F.sum("p").over(w) - F.col("p")).cast("double") /
                              (F.sum("n").over(w) - F.col("n")).cast("double")).alias("prior"))
    j = folds.join(F.broadcast(prior), fold)  # k rows: bounded by the fold count
    u = hash_uniform("dummy", seed, F.col("ID"))
    return j.select("ID", "label", fold, (u < F.col("prior")).cast("double").alias("proba"))
