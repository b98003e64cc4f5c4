"""Target encoding of text columns of any width: the state is a table that is joined, not a list on the driver.

A level's value is the mean of the 0/1 label over the training rows that have it, drawn towards the mean of all rows
by a number of prior rows. For the training rows themselves the value leaves out the row's own fold, so a row's label never
reaches its own feature. Levels that training has not seen get the mean of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.functions.hashing import hash_key
from retentia.session import scratch_path

MISSING = "Missing"
STATE = "column string, level string, n bigint, positives bigint, folds map<int,struct<n:bigint,positives:bigint>>"


@dataclass(frozen=True)
class EncodingRule:
    folds: int = 5
    prior_rows: float = 20.0
    seed: int = 42

    def __post_init__(self) -> None:
        if self.folds < 2 or self.prior_rows <= 0:
            raise ValueError("two folds and a positive number of prior rows are needed")


def row_fold(columns: Sequence[str], rule: EncodingRule = EncodingRule()) -> Column:
    """The fold of a row, from the named columns alone."""
    digests = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]
    return F.pmod(hash_key(rule.seed, "encode", *digests), F.lit(rule.folds)).cast("int")


def _level(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(MISSING))


def target_state(df: DataFrame, columns: Sequence[str], label: str, fold: Column) -> DataFrame:
    """One row per column and level: rows and positive rows, in all and per fold. Rows without a label don't count.

    The row with a null level stands for all rows of the column. Counts combine per task before anything is shuffled, so a
    level that most rows share costs no more than any other.
    """
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _level(c).alias("level")) for c in columns])).alias("e")
    y = F.col(f"`{label}`").cast("bigint")
    rows = df.where(y.isNotNull()).select(y.alias("y"), fold.alias("fold"), entries).select("y", "fold", "e.*")
    counts = rows.groupBy("column", "level", "fold").agg(F.count("*").alias("n"), F.sum("y").alias("positives"))
    whole = counts.groupBy("column", "fold").agg(F.sum("n").alias("n"), F.sum("positives").alias("positives"))
    both = counts.unionByName(whole.withColumn("level", F.lit(None).cast("string")))
    folds = F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "positives"))))  # one entry per fold
    return both.groupBy("column", "level").agg(F.sum("n").alias("n"), F.sum("positives").alias("positives"), folds.alias("folds"))


def with_target_codes(
    df: DataFrame, state: DataFrame, columns: Sequence[str], outputs: Sequence[str], rule: EncodingRule = EncodingRule(), fold: Column | None = None
) -> DataFrame:
    """``df`` with one code per listed column. With ``fold``, each row's code leaves its own fold out.

    The state of a column is broadcast or shuffled as its measured size allows; skewed levels are left to the adaptive join. A
    column without any state gets null codes.
    """
    whole = {r["column"]: r for r in state.where(F.col("level").isNull() & F.col("column").isin(*columns)).collect()}  # a row per column
    out = df
    if fold is not None:
        out = out.withColumn("_fold", fold)
    for column, output in zip(columns, outputs, strict=True):
        if column not in whole:
            out = out.withColumn(output, F.lit(None).cast("double"))
            continue
        own = state.where((F.col("column") == column) & F.col("level").isNotNull())
        own = own.select(F.col("level").alias("_level"), F.struct("n", "positives", "folds").alias("_state"))
        out = out.join(own, _level(column) == F.col("_level"), "left")
        n, positives = F.coalesce(F.col("_state.n"), F.lit(0)), F.coalesce(F.col("_state.positives"), F.lit(0))
        total = whole[column]
        prior = F.lit(total["positives"] / total["n"])
        if fold is not None:
            out_of = F.col("_state.folds")[F.col("_fold")]
            n, positives = n - F.coalesce(out_of["n"], F.lit(0)), positives - F.coalesce(out_of["positives"], F.lit(0))
            means = {f: _share(total["positives"] - part["positives"], total["n"] - part["n"]) for f, part in total["folds"].items()}
            for f, mean in means.items():
                prior = F.when(F.col("_fold") == f, F.lit(mean)).otherwise(prior)
        code = (positives + F.lit(rule.prior_rows) * prior) / (n + F.lit(rule.prior_rows))
        out = out.withColumn(output, code).drop("_level", "_state")
    return out.drop("_fold") if fold is not None else out


def _share(part: int, whole: int) -> float:
    return part / whole if whole else 0.0


class _StateWriter(DefaultParamsWriter):
    """Saves the state table beside the settings, so that a saved model needs no other file."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.state(self.sparkSession).write.parquet(f"{path}/state")


class _StateReader(DefaultParamsReader):
    def load(self, path: str) -> TargetTableModel:
        model = super().load(path)
        return model._set(statePath=f"{path}/state")


class _TargetParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "text columns", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "their codes", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    folds = Param(Params._dummy(), "folds", "folds of the training rows", TypeConverters.toInt)
    priorRows = Param(Params._dummy(), "priorRows", "rows that the mean of all rows counts as", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the folds", TypeConverters.toInt)

    def rule(self) -> EncodingRule:
        return EncodingRule(self.getOrDefault(self.folds), self.getOrDefault(self.priorRows), self.getOrDefault(self.seed))


class TargetTableModel(Model, _TargetParams, DefaultParamsReadable, DefaultParamsWritable):
    """Joins the codes. While ``training`` is set, every row's own fold is left out of them."""

    statePath = Param(Params._dummy(), "statePath", "folder of the state table", TypeConverters.toString)
    foldCols = Param(Params._dummy(), "foldCols", "columns that tell a training row's fold", TypeConverters.toListString)
    training = Param(Params._dummy(), "training", "the rows are those of the fit", TypeConverters.toBoolean)

    def state(self, spark) -> DataFrame:
        return spark.read.schema(STATE).parquet(self.getOrDefault(self.statePath))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rule = self.rule()
        fold = row_fold(self.getOrDefault(self.foldCols), rule) if self.getOrDefault(self.training) else None
        columns, outputs = self.getOrDefault(self.inputCols), self.getOrDefault(self.outputCols)
        return with_target_codes(dataset, self.state(dataset.sparkSession), columns, outputs, rule, fold)

    def write(self) -> _StateWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> _StateReader:
        return _StateReader(cls)


class TargetTableEncoder(Estimator, _TargetParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the state table and stores it in the shared folder.

    A training row's fold comes from all of its columns but the label, a key among them; rows that are equal share a fold.
    """

    @keyword_only
    def __init__(self, *, inputCols: list[str] = None, outputCols: list[str] = None, labelCol: str = "churn", folds: int = 5, priorRows: float = 20.0, seed: int = 42):
        super().__init__()
        self._setDefault(inputCols=[], outputCols=[], labelCol="churn", folds=5, priorRows=20.0, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> TargetTableModel:
        label = self.getOrDefault(self.labelCol)
        fold_columns = [c for c in dataset.columns if c != label and not c.startswith("_")]
        path = scratch_path(dataset.sparkSession, "target-codes")
        state = target_state(dataset, self.getOrDefault(self.inputCols), label, row_fold(fold_columns, self.rule()))
        state.write.parquet(path)
        model = self._copyValues(TargetTableModel())
        return model._set(statePath=path, foldCols=fold_columns, training=True)


def for_scoring(stage):
    """The fitted stage as it scores rows that were not in its training."""
    if isinstance(stage, TargetTableModel):
        return stage.copy({stage.training: False})
    return stage
