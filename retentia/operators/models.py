"""The four model families as MLlib pipelines, their comparison, and batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.operators.encoding import for_scoring
from retentia.operators.features import column_types, onehot_columns
from retentia.operators.metrics import METRICS, classification_metrics
from retentia.operators.preprocess import FEATURES, WEIGHT, ClassWeigher, TableEncoder, helper_columns

UNKNOWN_VERSION = "unknown"

# The default settings of each family.
DEFAULT_PARAMS: dict[str, dict[str, object]] = {
    "logistic_regression": {"max_iter": 1000, "C": 1.0},
    "boosted_trees": {"n_estimators": 300, "max_depth": 5, "learning_rate": 0.1},
    "boosted_trees_deep": {"n_estimators": 300, "max_depth": 8, "learning_rate": 0.1},
    "native_categories": {"n_estimators": 300, "max_depth": 6, "learning_rate": 0.1},
}


def tree_params(params: Mapping[str, object]) -> dict[str, object]:
    """Search-space names to the learner's own; a negative depth is an error, as the learner needs one."""
    out: dict[str, object] = {}
    for name, value in params.items():
        if name == "n_estimators":
            out["maxIter"] = int(value)
        elif name == "max_depth":
            if int(value) < 0:
                raise ValueError(f"max_depth must not be negative: {value}")
            out["maxDepth"] = int(value)
        elif name == "learning_rate":
            out["stepSize"] = float(value)
        elif name == "min_child_samples":
            out["minInstancesPerNode"] = int(value)
        elif name == "subsample":
            out["subsamplingRate"] = float(value)
        elif name == "colsample_bytree":
            out["featureSubsetStrategy"] = str(float(value))
        else:
            raise ValueError(f"unknown tree parameter: {name}")
    return out


def _boosted(df: DataFrame, label: str, skip: Sequence[str], wide: Sequence[str], params, seed: int, mode: str) -> Pipeline:
    numeric, text = onehot_columns(df, wide, [label, *skip])
    learner = GBTClassifier(featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, seed=seed, **tree_params(params))
    return Pipeline(stages=[ClassWeigher(labelCol=label, mode=mode), TableEncoder(numericCols=numeric, textCols=text, labelCol=label), learner])


def _logistic(df: DataFrame, label: str, skip: Sequence[str], wide: Sequence[str], params, seed: int) -> Pipeline:
    numeric, text = onehot_columns(df, wide, [label, *skip])
    # The penalty is 1/C against the sum of losses; MLlib weighs it against their mean.
    n = df.count()
    learner = LogisticRegression(
        featuresCol=FEATURES,
        labelCol=label,
        weightCol=WEIGHT,
        maxIter=int(params.get("max_iter", 1000)),
        regParam=1.0 / (float(params.get("C", 1.0)) * max(n, 1)),
        standardization=False,
    )
    return Pipeline(stages=[ClassWeigher(labelCol=label), TableEncoder(numericCols=numeric, textCols=text, scale=True, labelCol=label), learner])


def _native(df: DataFrame, label: str, skip: Sequence[str], params, seed: int, max_levels: int = 254) -> Pipeline:
    """Text columns, wide ones included, without one-hot: nominal features, or target codes beyond ``max_levels`` levels.

    The bins hold every level of a nominal feature and one for unseen ones, and bound the learner's memory per column.
    """
    numeric, text = column_types(df, [label, *skip])
    learner = GBTClassifier(featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, seed=seed, maxBins=max_levels + 2, **tree_params(params))
    encoder = TableEncoder(numericCols=numeric, textCols=text, oneHot=False, maxLevels=max_levels, labelCol=label)
    return Pipeline(stages=[ClassWeigher(labelCol=label), encoder, learner])


def family_pipeline(
    family: str,
    df: DataFrame,
    label: str,
    params: Mapping[str, object] | None = None,
    *,
    skip: Sequence[str] = (),
    high_cardinality: Sequence[str] = ("City",),
    seed: int = 42,
) -> Pipeline:
    """The unfitted pipeline of a family; ``skip`` lists columns that are not features."""
    settings = {**DEFAULT_PARAMS.get(family, {}), **(params or {})}
    builders: dict[str, Callable[[], Pipeline]] = {
        "logistic_regression": lambda: _logistic(df, label, skip, high_cardinality, settings, seed),
        "boosted_trees": lambda: _boosted(df, label, skip, high_cardinality, settings, seed, "positive"),
        "boosted_trees_deep": lambda: _boosted(df, label, skip, high_cardinality, settings, seed, "balanced"),
        "native_categories": lambda: _native(df, label, skip, settings, seed),
    }
    if family not in builders:
        raise ValueError(f"unknown model family: {family}")
    return builders[family]()


def without_training_stages(model: PipelineModel) -> PipelineModel:
    """The part that scores: the weight stage reads the label, which scoring data lacks, and codes leave no fold out."""
    keep = [s for s in model.stages if not (isinstance(s, SQLTransformer) and f"AS `{WEIGHT}`" in s.getStatement())]
    return PipelineModel(stages=[PipelineModel(stages=[for_scoring(t) for t in s.stages]) if isinstance(s, PipelineModel) else for_scoring(s) for s in keep])


def fit_family(family: str, train: DataFrame, label: str, params=None, **options) -> PipelineModel:
    return without_training_stages(family_pipeline(family, train, label, params, **options).fit(train))


def score(model: PipelineModel, df: DataFrame, version: object = None, threshold: float = 0.5) -> DataFrame:
    """Add ``churn_probability``, ``churn_prediction`` and ``model_version`` from one model pass."""
    scored = model.transform(df)
    probability = vector_to_array("probability")[1]
    out = scored.withColumn("churn_probability", probability)
    return out.drop(*helper_columns(out.columns)).withColumns(
        {
            "churn_prediction": (F.col("churn_probability") >= threshold).cast("int"),
            "model_version": F.lit(str(version) if version is not None else UNKNOWN_VERSION),
        }
    )


def test_metrics(model: PipelineModel, test: DataFrame, label: str) -> DataFrame:
    return classification_metrics(score(model, test), label, "churn_prediction", "churn_probability").select(*METRICS)


test_metrics.__test__ = False  # not a pytest case


def compare_families(
    train: DataFrame,
    test: DataFrame,
    label: str,
    families: Mapping[str, Mapping[str, object] | None],
    *,
    skip: Sequence[str] = (),
    high_cardinality: Sequence[str] = ("City",),
    parallelism: int = 2,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """((family, metrics...) one row each, fitted models). Families train side by side on the cluster."""

    def run(item):
        family, params = item
        return family, fit_family(family, train, label, params, skip=skip, high_cardinality=high_cardinality)

    with ThreadPoolExecutor(parallelism) as pool:
        models = dict(pool.map(run, families.items()))
    rows = [test_metrics(m, test, label).select(F.lit(f).alias("family"), "*") for f, m in models.items()]
    return reduce(DataFrame.unionByName, rows), models
