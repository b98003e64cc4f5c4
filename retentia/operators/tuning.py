"""Random search over a declared space with exact stratified folds."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.functions.hashing import uniform
from retentia.operators.models import family_pipeline, tree_params, without_training_stages
from retentia.operators.preprocess import FEATURES, WEIGHT
from retentia.operators.sampling import stratified_folds
from retentia.session import delete_path, scratch_path


@dataclass(frozen=True)
class IntRange:
    low: int
    high: int
    step: int = 1


@dataclass(frozen=True)
class FloatRange:
    low: float
    high: float
    log: bool = False


def search_range(settings: Mapping[str, object]) -> IntRange | FloatRange:
    """A range from its config form; an unknown type is an error."""
    if settings["type"] == "int":
        return IntRange(settings["low"], settings["high"], settings.get("step", 1))
    if settings["type"] == "float":
        return FloatRange(settings["low"], settings["high"], settings.get("log", False))
    raise ValueError(f"unknown parameter type: {settings['type']}")


@dataclass(frozen=True)
class SearchPlan:
    """The defaults are fixed values; the ranges with a counterpart in the tree learner."""

    trials: int = 50
    folds: int = 5
    seed: int = 42
    space: Mapping[str, IntRange | FloatRange] = field(
        default_factory=lambda: {
            "n_estimators": IntRange(100, 800, 50),
            "max_depth": IntRange(3, 12),
            "learning_rate": FloatRange(0.01, 0.3, log=True),
            "min_child_samples": IntRange(5, 100),
            "subsample": FloatRange(0.5, 1.0),
            "colsample_bytree": FloatRange(0.5, 1.0),
        }
    )


def _draw(name: str, spec: IntRange | FloatRange, seed: int) -> Column:
    u = uniform(seed, f"trial:{name}", "trial")
    if isinstance(spec, IntRange):
        steps = (spec.high - spec.low) // spec.step + 1
        place = F.least(F.floor(u * steps), F.lit(steps - 1))
        return (F.lit(spec.low) + place * spec.step).cast("double")
    if spec.log:
        return F.exp(F.log(F.lit(spec.low)) + u * (F.log(F.lit(spec.high)) - F.log(F.lit(spec.low))))
    return F.lit(spec.low) + u * (spec.high - spec.low)


def draw_trials(spark: SparkSession, plan: SearchPlan) -> DataFrame:
    """(trial, params map): the same seed gives the same trials."""
    draws = [x for name, spec in plan.space.items() for x in (F.lit(name), _draw(name, spec, plan.seed))]
    return spark.range(plan.trials).select(F.col("id").alias("trial")).select("trial", F.create_map(*draws).alias("params"))


def f1_evaluator(label: str) -> MulticlassClassificationEvaluator:
    """F1 of the positive class."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0)


def cv_search(
    train: DataFrame,
    label: str,
    key: str,
    plan: SearchPlan = SearchPlan(),
    *,
    family: str = "boosted_trees_deep",
    high_cardinality: Sequence[str] = ("City",),
    parallelism: int = 4,
) -> tuple[DataFrame, dict[str, object], PipelineModel]:
    """((trial, params, mean_f1), best params, best model refitted on all rows).

    Weights, medians and levels are learned once per fold, on its training side, and both sides are stored in encoded form; a
    trial fits and tests its learner on those tables alone. The tables of a fold are deleted after its last trial.
    """
    spark = train.sparkSession
    trials = [(r["trial"], dict(r["params"])) for r in draw_trials(spark, plan).orderBy("trial").collect()]
    path = scratch_path(spark, "folds")
    stratified_folds(train, label, key, plan.folds, plan.seed).write.parquet(path)
    folded = spark.read.parquet(path)
    pipeline = family_pipeline(family, train, label, {}, skip=[key, "fold"], high_cardinality=high_cardinality, seed=plan.seed)
    *preparation, learner = pipeline.getStages()
    grid = [{learner.getParam(n): v for n, v in tree_params(params).items()} for _, params in trials]
    evaluator = f1_evaluator(label)
    scores = []
    for fold in range(plan.folds):
        folder = scratch_path(spark, "fold")
        sides = encoded_fold(folded, fold, preparation, label, folder)

        def tested(params: dict) -> float:
            return evaluator.evaluate(learner.copy(params).fit(sides["train"]).transform(sides["test"]))

        with ThreadPoolExecutor(parallelism) as pool:
            scores += [(t, fold, float(f1)) for (t, _), f1 in zip(trials, pool.map(tested, grid))]
        delete_path(spark, folder)
    delete_path(spark, path)
    means = fold_means(spark.createDataFrame(scores, "trial bigint, fold int, f1 double"))
    found = {r["trial"]: r["mean_f1"] for r in means.collect()}  # a row per trial
    rows = [(t, json.dumps(p, sort_keys=True), found[t]) for t, p in trials]
    best = dict(trials)[max(found, key=lambda t: (found[t], -t))]
    settings = {learner.getParam(n): v for n, v in tree_params(best).items()}
    model = Pipeline(stages=[*preparation, learner.copy(settings)]).fit(train)
    return spark.createDataFrame(rows, "trial bigint, params string, mean_f1 double"), best, without_training_stages(model)


def encoded_fold(folded: DataFrame, fold: int, preparation: Sequence, label: str, folder: str) -> dict[str, DataFrame]:
    """The two sides of a fold as tables of label, weight and features below ``folder``; everything learned comes from the training side."""
    train, test = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
    fitted = Pipeline(stages=list(preparation)).fit(train)
    fitted.transform(train).select(label, WEIGHT, FEATURES).write.parquet(f"{folder}/train")
    without_training_stages(fitted).transform(test).select(label, FEATURES).write.parquet(f"{folder}/test")
    return {side: folded.sparkSession.read.parquet(f"{folder}/{side}") for side in ("train", "test")}


def fold_means(scores: DataFrame) -> DataFrame:
    """(trial, mean_f1) from one row per trial and fold."""
    return scores.groupBy("trial").agg(F.avg("f1").alias("mean_f1"))


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the highest score, the first one on ties."""
    rank = F.struct("mean_f1", (-F.col("trial")).alias("tie"))
    return trials.agg(F.max_by(F.struct("trial", "params", "mean_f1"), rank).alias("best")).select("best.*")
