"""Files the flows leave for one another: splits, reports, value lists, parameters, models."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class MissingArtifact(FileNotFoundError):
    """A file another step should have written."""


def _reader(read, path: str, producer: str) -> DataFrame:
    try:
        return read(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingArtifact(f"{path} does not exist: run {producer} first") from error
        raise


def save_split(df: DataFrame, folder: str, flag: str = "is_test") -> None:
    """Write both sides in one pass, as one dataset partitioned by the flag."""
    df.write.mode("overwrite").partitionBy(flag).parquet(folder)


def _side(spark: SparkSession, folder: str, value: int, flag: str) -> DataFrame:
    # The flag is a partition column, so the other side's files are never opened.
    return _reader(spark.read.parquet, folder, "the dataset build").where(F.col(flag) == value).drop(flag)


def load_split(spark: SparkSession, folder: str, flag: str = "is_test") -> tuple[DataFrame, DataFrame]:
    """(train, test) as written; the split is never redone."""
    return _side(spark, folder, 0, flag), _side(spark, folder, 1, flag)


def load_reference(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """The training side without its label."""
    return load_split(spark, folder)[0].drop(target)


def save_report(report: DataFrame, path: str, order: list | None = None) -> None:
    """A result table (one row per model, batch or role) as one CSV file with a header."""
    rows = report.orderBy(*order) if order else report
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def load_report(spark: SparkSession, path: str, schema: str, producer: str) -> DataFrame:
    """A required report; the error names the step that writes it."""
    read = spark.read.schema(schema).option("header", True).csv
    return _reader(read, path, producer)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """An optional report: None when it was never written."""
    try:
        return load_report(spark, path, schema, "")
    except MissingArtifact:
        return None


def read_text(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return _reader(spark.read.text, path, "")
    except MissingArtifact:
        return None


def save_values(values: DataFrame, path: str) -> None:
    """A one-column list as JSON lines in UTF-8."""
    values.write.mode("overwrite").json(path)


def load_values(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return _reader(spark.read.schema(schema).json, path, "the value export")


def save_drift_detail(detail: DataFrame, path: str) -> None:
    """Per-column drift, one JSON object per (batch, column), in one folder per batch."""
    detail.write.mode("overwrite").partitionBy("batch").json(path)


def save_params(spark: SparkSession, params: Mapping[str, object], path: str) -> None:
    spark.createDataFrame([(json.dumps(dict(params), sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_params(spark: SparkSession, path: str, fixed: Mapping[str, object] | None = None) -> dict[str, object]:
    """Fixed settings overlaid by the stored ones; a missing file is an error."""
    rows = _reader(spark.read.text, path, "the training search").collect()
    return {**(fixed or {}), **json.loads("".join(r["value"] for r in rows))}


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
