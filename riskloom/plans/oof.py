"""Out-of-fold scoring (H2, H4, H5) and the chosen train+predict plan.

The prepared training table is checkpointed once (reliable checkpoint in the
cluster's shared ``spark.checkpoint.dir``) so the 5 fold fits + refit never
recompute the panel's joins and survive executor loss. Fold fits run as
concurrent Spark jobs from a small driver thread pool (bounded at ``parallel``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import config
from riskloom.operators.folds import assign_folds
from riskloom.plans.models import ModelPipeline, fit_together, pipeline_for
from riskloom.session import cut_lineage, scratch_path


def _union(dfs):
    return reduce(lambda a, b: a.unionByName(b), dfs)


def with_folds(dev: DataFrame, seed: int, checkpoint: bool = True) -> DataFrame:
    f = assign_folds(dev, seed)
    return cut_lineage(f) if checkpoint else f


def fold_oof_many(factories, dev_folds: DataFrame, parallel: int = 8, fold: str = "fold") -> list[DataFrame]:
    """H2 for several models: every row scored by a model fitted without its fold. The folds
    of all models are fitted together, so that models share what they are prepared from."""
    ks = sorted(r[0] for r in dev_folds.select(fold).distinct().collect())
    # what is done row by row is done once for all folds, and once for models that share it
    prepared: dict = {}
    jobs, tables = [], []
    for factory in factories:
        first, table = factory(), dev_folds
        if isinstance(first, ModelPipeline) and first.kind != "dummy":
            how = repr((first.groups, sorted(first.encoding.items())))
            if how not in prepared:
                prepared[how] = cut_lineage(first.prepare(dev_folds))
            table = prepared[how]
        for k in ks:
            model = first if k == ks[0] else factory()
            if table is not dev_folds:
                model.ready = True
            jobs.append((model, table.where(F.col(fold) != k), k))
        tables.append(table)
    models = iter(fit_together(jobs, parallel))
    return [_union([next(models).score(table.where(F.col(fold) == k), keep=("ID", "label", fold)) for k in ks])
            for table in tables]


def fold_oof(factory, dev_folds: DataFrame, parallel: int = 8, fold: str = "fold") -> DataFrame:
    """H2 for one model; ``factory()`` returns a fresh unfitted one."""
    return fold_oof_many([factory], dev_folds, parallel, fold)[0]


def oof_proba(name: str, dev: DataFrame, seed: int = config.SEED, groups=(),
              parallel: int = 8, overrides: dict | None = None,
              dev_folds: DataFrame | None = None, learner_seed: int = config.SEED) -> DataFrame:
    """(ID, label, fold, model, seed, proba) for one named model at one fold seed. The
    learner keeps its own seed, so results over fold seeds differ by the split alone."""
    df = dev_folds if dev_folds is not None else with_folds(dev, seed)
    return oof_table({name: lambda: pipeline_for(name, groups, learner_seed, overrides)}, df, seed, parallel)


def oof_table(factories: dict, dev_folds: DataFrame, seed: int = config.SEED, parallel: int = 8) -> DataFrame:
    """The long out-of-fold table (ID, label, fold, model, seed, proba) of named factories of
    unfitted models, fitted together over the same folds."""
    parts = fold_oof_many(list(factories.values()), dev_folds, parallel)
    return _union([s.select("ID", "label", "fold", F.lit(name).alias("model"), F.lit(int(seed)).alias("seed"), "proba")
                   for name, s in zip(factories, parts)])


def _exists(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def build_oof_cache(names, dev: DataFrame, seeds, groups=(), parallel: int = 8,
                    move_learner_seed: bool = False, root: str | None = None) -> DataFrame:
    """H4: the long score table for every (model, seed), computed once and stored (so J/K
    operators re-read it instead of refitting). With ``move_learner_seed`` the learner takes
    the fold seed too, as the seed averages of K3 need it.

    The store under ``root`` (new scratch where none is given) is partitioned by seed and
    model. What a former call finished there is read, not fitted again, so a run that was
    stopped goes on where it stood, and readers of some seeds or models scan only those.
    A store belongs to one development table, feature set and registry."""
    spark = dev.sparkSession
    root = root or scratch_path(spark, "oof-store")
    for seed in seeds:
        absent = [n for n in names if not _exists(spark, f"{root}/seed={int(seed)}/model={n}/_SUCCESS")]
        if not absent:
            continue
        own = seed if move_learner_seed else config.SEED
        folds = with_folds(dev, seed)
        scores = fold_oof_many([lambda n=n: pipeline_for(n, groups, own) for n in absent], folds, parallel)
        for name, s in zip(absent, scores):
            s.select("ID", "label", "fold", "proba").write.mode("overwrite").parquet(f"{root}/seed={int(seed)}/model={name}")
    kinds = {f.name: f.dataType.simpleString() for f in dev.schema.fields}
    schema = f"ID {kinds['ID']}, label {kinds['label']}, fold int, proba double, seed int, model string"
    # partition folders of the store, pruned by those that were asked for
    return spark.read.schema(schema).option("basePath", root).parquet(
        *[f"{root}/seed={int(s)}/model={n}" for s in seeds for n in names]).select(
        "ID", "label", "fold", "model", "seed", "proba")


def fit_eval_proba(name: str, dev: DataFrame, evl: DataFrame, learner_seed: int = config.SEED,
                   groups=(), overrides: dict | None = None) -> DataFrame:
    """H5: fit on all development rows, score the evaluation rows -> (ID, proba)."""
    pipe = pipeline_for(name, groups, learner_seed, overrides).fit(dev)
    return pipe.score(evl, keep=("ID",))
