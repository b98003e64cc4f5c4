"""Model preparation learned on training rows only: weights, imputing, scaling, encoding.

The fitted forms are plain MLlib stages, so a fitted pipeline saves, loads and scores on the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.functions.quantiles import selected_quantiles
from retentia.operators.encoding import MISSING, TargetTableEncoder
from retentia.operators.profile import multi_value_counts

WEIGHT = "_weight"
FEATURES = "features"


def quoted(name: str) -> str:
    """A column name as it stands in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): balanced weights n / (k * n_class), one row per class."""
    counts = class_counts(df, label)
    totals = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k"))).scalar()
    return counts.withColumn("weight", totals["n"] / (totals["k"] * F.col("n")))


def positive_weight(df: DataFrame, label: str) -> float:
    """Negatives per positive; no positives is an error."""
    row = df.agg(F.sum(1 - F.col(label)).alias("neg"), F.sum(label).alias("pos")).first()
    if not row["pos"]:
        raise ValueError("no positive rows: the class ratio is undefined")
    return row["neg"] / row["pos"]


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median per column; a column without values gets 0."""
    rows = selected_quantiles(df, columns, {"median": 0.5}).collect()
    return {**dict.fromkeys(columns, 0.0), **{r["column"]: r["median"] for r in rows}}


def impute(column: str, median: float):
    value = F.col(quoted(column)).cast("double")
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(float(median)))


def scaling(df: DataFrame, fill: dict[str, float]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per imputed column; a zero deviation counts as 1."""
    row = df.agg(
        *[F.avg(impute(c, m)).alias(f"m{i}") for i, (c, m) in enumerate(fill.items())],
        *[F.stddev_pop(impute(c, m)).alias(f"s{i}") for i, (c, m) in enumerate(fill.items())],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(fill)}


def imputed_and_scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame with its numeric columns imputed by median and scaled, statistics from itself."""
    fill = medians(df, columns)
    scale = scaling(df, fill)
    return df.withColumns({c: (impute(c, fill[c]) - F.lit(scale[c][0])) / F.lit(scale[c][1]) for c in columns})


def onehot_long(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, feature): the encoded features that are 1, named ``categorical__<column>_<level>``."""
    entries = [F.concat(F.lit(f"categorical__{c}_"), F.coalesce(F.col(c), F.lit(MISSING))) for c in columns]
    return df.select(key, F.explode(F.array(*entries)).alias("feature"))


class ClassWeigher(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns class weights; the fitted stage adds them as a column. Mode "balanced" or "positive"."""

    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    mode = Param(Params._dummy(), "mode", "balanced or positive", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, labelCol: str = "churn", mode: str = "balanced"):
        super().__init__()
        self._setDefault(labelCol="churn", mode="balanced")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        label = self.getOrDefault(self.labelCol)
        if self.getOrDefault(self.mode) == "positive":
            weights = {0: 1.0, 1: positive_weight(dataset, label)}
        else:
            weights = {int(r[label]): r["weight"] for r in class_weights(dataset, label).collect()}
        cases = " ".join(f"WHEN {k} THEN {w!r}D" for k, w in sorted(weights.items()))
        return SQLTransformer(statement=f"SELECT *, CASE CAST({quoted(label)} AS INT) {cases} ELSE 1.0D END AS `{WEIGHT}` FROM __THIS__")


def level_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Exact number of levels per text column, nulls excluded; levels are counted in the cluster, not listed."""
    counts = multi_value_counts(df, columns).groupBy("column").agg(F.count("*").alias("n")) if columns else None
    found = {r["column"]: r["n"] for r in counts.collect()} if columns else {}  # a row per column
    return {c: found.get(c, 0) for c in columns}


class TableEncoder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Numeric: median imputing, optional scaling. Text: "Missing" for null, one-hot or level indexes.

    Columns that are not listed don't reach the model; levels unseen in training encode to all zeros. A text column of more than
    ``maxLevels`` levels, counted exactly, is target-encoded by a joined table if ``labelCol`` is given, else hashed into
    ``hashWidth`` features, so no column is too wide.
    """

    numericCols = Param(Params._dummy(), "numericCols", "numeric columns", TypeConverters.toListString)
    textCols = Param(Params._dummy(), "textCols", "text columns", TypeConverters.toListString)
    scale = Param(Params._dummy(), "scale", "scale numeric columns", TypeConverters.toBoolean)
    oneHot = Param(Params._dummy(), "oneHot", "one-hot text columns instead of level indexes", TypeConverters.toBoolean)
    maxLevels = Param(Params._dummy(), "maxLevels", "most levels that are listed one by one", TypeConverters.toInt)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label for columns of more levels", TypeConverters.toString)
    hashWidth = Param(Params._dummy(), "hashWidth", "features of a hashed column", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        numericCols: list[str] = None,
        textCols: list[str] = None,
        scale: bool = False,
        oneHot: bool = True,
        maxLevels: int = 10_000,
        labelCol: str = None,
        hashWidth: int = 1024,
    ):
        super().__init__()
        self._setDefault(numericCols=[], textCols=[], scale=False, oneHot=True, maxLevels=10_000, hashWidth=1024)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        numeric, text = self.getOrDefault(self.numericCols), self.getOrDefault(self.textCols)
        fill = medians(dataset, numeric) if numeric else {}
        scales = scaling(dataset, fill) if self.getOrDefault(self.scale) and numeric else {}
        parts = []
        for c in numeric:
            value = f"coalesce(nanvl(CAST({quoted(c)} AS DOUBLE), CAST(NULL AS DOUBLE)), {fill[c]!r}D)"
            if c in scales:
                mean, std = scales[c]
                value = f"({value} - ({mean!r}D)) / {std!r}D"
            parts.append(f"{value} AS {quoted(f'numeric__{c}')}")
        parts += [f"coalesce({quoted(c)}, '{MISSING}') AS {quoted(f'categorical__{c}')}" for c in text]
        stages = [SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")]
        inputs = [f"numeric__{c}" for c in numeric]
        filled = stages[0].transform(dataset)
        levels = level_counts(filled.select(*[F.col(quoted(f"categorical__{c}")).alias(c) for c in text]), text) if text else {}
        narrow = [c for c in text if levels[c] <= self.getOrDefault(self.maxLevels)]
        wide = [c for c in text if c not in narrow]
        if narrow:
            indexer = StringIndexer(
                inputCols=[f"categorical__{c}" for c in narrow],
                outputCols=[f"_index__{c}" for c in narrow],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ).fit(filled)
            stages.append(indexer)
            if self.getOrDefault(self.oneHot):
                encoder = OneHotEncoder(
                    inputCols=[f"_index__{c}" for c in narrow], outputCols=[f"_onehot__{c}" for c in narrow], dropLast=True
                ).fit(indexer.transform(filled))
                stages.append(encoder)
            inputs += [f"{'_onehot__' if self.getOrDefault(self.oneHot) else '_index__'}{c}" for c in narrow]
        if wide and self.isDefined(self.labelCol):
            raw = filled.select(*dataset.columns, *[F.col(quoted(f"categorical__{c}")) for c in wide])
            outputs = [f"_target__{c}" for c in wide]
            stages.append(TargetTableEncoder(inputCols=[f"categorical__{c}" for c in wide], outputCols=outputs, labelCol=self.getOrDefault(self.labelCol)).fit(raw))
            inputs += outputs
        elif wide:
            width = self.getOrDefault(self.hashWidth)
            stages += [FeatureHasher(inputCols=[f"categorical__{c}"], outputCol=f"_hash__{c}", numFeatures=width) for c in wide]
            inputs += [f"_hash__{c}" for c in wide]
        stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
        return PipelineModel(stages=stages)


def helper_columns(columns: Sequence[str]) -> list[str]:
    """Intermediate columns the fitted stages add."""
    prefixes = ("numeric__", "categorical__", "_index__", "_onehot__", "_target__", "_hash__")
    return [c for c in columns if c.startswith(prefixes) or c in (WEIGHT, FEATURES, "rawPrediction", "probability", "prediction")]


def encoded_features(encoder: PipelineModel) -> list[tuple[str, str, str | None]]:
    """(feature name, column, level) in vector order, from the fitted encoder's stages."""
    names: list[tuple[str, str, str | None]] = []
    levels: dict[str, list[str]] = {}
    widths: dict[str, int] = {}
    for stage in encoder.stages:
        if isinstance(stage, StringIndexerModel):
            levels |= {c.removeprefix("categorical__"): list(ls) for c, ls in zip(stage.getInputCols(), stage.labelsArray)}
        elif isinstance(stage, FeatureHasher):
            widths[stage.getOutputCol().removeprefix("_hash__")] = stage.getNumFeatures()
    for c in encoder.stages[-1].getInputCols():
        if c.startswith("numeric__"):
            names.append((c, c.removeprefix("numeric__"), None))
        elif c.startswith("_onehot__"):
            column = c.removeprefix("_onehot__")
            names += [(f"categorical__{column}_{level}", column, level) for level in levels[column]]
        elif c.startswith("_hash__"):
            column = c.removeprefix("_hash__")
            names += [(f"categorical__{column}_hash {i}", column, None) for i in range(widths[column])]
        else:
            column = c.removeprefix("_index__").removeprefix("_target__")
            names.append((f"categorical__{column}", column, None))
    return names
