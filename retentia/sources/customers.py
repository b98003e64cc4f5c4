"""Raw customer CSV: text scan, null tokens, contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.functions.scalars import null_if_token
from retentia.operators.contract import CUSTOMER_CONTRACT, Contract, check_columns, enforce


def scan_csv(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """All columns as text with the usual null tokens turned into null.

    Types come from the contract, never from inference, so no extra pass reads the data. ``multi_line``
    allows line breaks inside quoted values at the price of unsplittable files.
    """
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)
    return raw.select(*[null_if_token(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def load_customers(spark: SparkSession, path: str, contract: Contract = CUSTOMER_CONTRACT) -> DataFrame:
    """The typed customer table, or an error that lists the broken rules."""
    raw = scan_csv(spark, path)
    check_columns(raw, contract)
    return enforce(raw, contract)
