"""Money value of a churn probability: expected loss per customer and retention priority."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.functions.scalars import lookup, remaining_months


@dataclass(frozen=True)
class ValueRule:
    """The defaults are fixed values."""

    campaign_cost: float = 50.0
    term_months: Mapping[str, int] = field(default_factory=lambda: {"Month-to-Month": 1, "One Year": 12, "Two Year": 24})


def with_retention_value(
    scored: DataFrame,
    rule: ValueRule = ValueRule(),
    contract: str = "contract",
    tenure: str = "tenure_in_months",
    charge: str = "monthly_charge",
    probability: str = "churn_probability",
) -> DataFrame:
    """Add the five value columns. They are null where the contract is unknown or an input is missing."""
    term = lookup(F.col(contract), rule.term_months)
    months = remaining_months(term, F.col(tenure).cast("int"))
    return (
        scored.withColumn("remaining_months", months)
        .withColumn("value_at_risk", F.col(charge) * F.col("remaining_months"))
        .withColumn("expected_loss", F.col(probability) * F.col("value_at_risk"))
        .withColumn("net_benefit", F.col("expected_loss") - F.lit(rule.campaign_cost))
        .withColumn("worth_retaining", F.col("net_benefit") > 0)
    )


def retention_portfolio(valued: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals per group: customers, customers worth a campaign, value at risk, loss, net benefit."""
    worth = F.col("worth_retaining")
    return valued.groupBy(*by).agg(
        F.count("*").alias("n_customers"),
        F.count(F.when(worth, 1)).alias("n_worth"),
        F.sum("value_at_risk").alias("value_at_risk"),
        F.sum("expected_loss").alias("expected_loss"),
        F.coalesce(F.sum(F.when(worth, F.col("net_benefit"))), F.lit(0.0)).alias("net_benefit"),
    )


def retention_targets(valued: DataFrame, key: str, n: int = 100) -> DataFrame:
    """The n customers with the highest positive net benefit."""
    return valued.where("worth_retaining").orderBy(F.desc("net_benefit"), key).limit(n)
