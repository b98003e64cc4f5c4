"""Feature table: exclusions, derived features, label, column roles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentia.functions.scalars import yes_flag
from retentia.operators.contract import CUSTOMER_CONTRACT, Contract


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns to leave out and what to derive. The defaults are fixed values."""

    id_columns: tuple[str, ...] = ("Customer ID",)
    leakage_columns: tuple[str, ...] = ("Churn Score", "Customer Status", "Churn Category", "Churn Reason")
    low_signal_columns: tuple[str, ...] = ("Latitude", "Longitude", "Zip Code", "CLTV")
    constant_columns: tuple[str, ...] = ("Country", "State", "Quarter")
    service_columns: tuple[str, ...] = (
        "Online Security",
        "Online Backup",
        "Device Protection Plan",
        "Premium Tech Support",
        "Streaming TV",
        "Streaming Movies",
        "Streaming Music",
        "Unlimited Data",
        "Multiple Lines",
    )
    tenure_column: str = "Tenure in Months"
    new_customer_tenure: int = 12
    target: str = "Churn Label"

    @property
    def excluded(self) -> tuple[str, ...]:
        return self.id_columns + self.leakage_columns + self.low_signal_columns + self.constant_columns


def drop_excluded(df: DataFrame, spec: FeatureSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the listed columns; a listed column the frame lacks is an error."""
    absent = [c for c in spec.excluded if c not in df.columns]
    if absent:
        raise ValueError(f"columns to exclude are missing: {absent}")
    return df.drop(*[c for c in spec.excluded if c not in keep])


def service_count(columns: Sequence[str]) -> Column:
    return sum((yes_flag(F.col(c)) for c in columns), F.lit(0))


def add_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    is_new = F.coalesce((F.col(spec.tenure_column) < spec.new_customer_tenure).cast("int"), F.lit(0))
    return df.withColumns({"is_new_customer": is_new, "num_extra_services": service_count(spec.service_columns)})


def encode_target(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn(target, yes_flag(F.col(target)))


def build_feature_table(df: DataFrame, spec: FeatureSpec = FeatureSpec(), keep: Sequence[str] = ()) -> DataFrame:
    """Features and the 0/1 label in one frame, so nothing has to be aligned later.

    ``keep`` holds excluded columns that must survive, such as the id the hash split needs.
    """
    return df.transform(drop_excluded, spec, keep).transform(add_features, spec).transform(encode_target, spec.target)


def scoring_contract(spec: FeatureSpec = FeatureSpec(), contract: Contract = CUSTOMER_CONTRACT) -> Contract:
    """The contract of a scoring request: the raw columns a model gets, without label and exclusions."""
    left_out = {*spec.excluded, spec.target}
    return contract.subset([n for n in contract.names if n not in left_out])


def column_types(df: DataFrame, skip: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, text) columns by declared type."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]
    return numeric, text


def onehot_columns(df: DataFrame, high_cardinality: Sequence[str] = ("City",), skip: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    numeric, text = column_types(df, skip)
    return numeric, [c for c in text if c not in high_cardinality]


def wide_text_columns(df: DataFrame, max_levels: int = 100) -> list[str]:
    """Text columns with more levels than one-hot encoding should take, nulls excluded; the counts are exact."""
    _, text = column_types(df)
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in text]
    if not entries:
        return []
    levels = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").dropna().distinct()
    return [r["column"] for r in levels.groupBy("column").agg(F.count("*").alias("n")).where(F.col("n") > max_levels).orderBy("column").collect()]


def fill_text(df: DataFrame, columns: Sequence[str], placeholder: str = "Missing") -> DataFrame:
    """Fill structural nulls of text columns; numeric columns keep theirs."""
    return df.fillna(placeholder, subset=list(columns)) if columns else df
