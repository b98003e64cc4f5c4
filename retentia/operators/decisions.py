"""Decisions taken from small result frames: promote a model, retrain, rank models.

All comparisons stay on doubles without rounding, because the margins are defined on them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.operators.metrics import OVERALL


@dataclass(frozen=True)
class PromotionRule:
    metric: str = "f1"
    margin: float = 0.01
    segment_tolerance: float = 0.03
    segment_columns: tuple[str, ...] = ("Contract", "Payment Method", "Internet Type")


@dataclass(frozen=True)
class RetrainRule:
    metric: str = "dataset_drift_share"
    threshold: float = 0.10


def segment_deltas(champion: DataFrame, challenger: DataFrame, metric: str = "f1") -> DataFrame:
    """Metric of both models and their difference, for segments that both of them have."""
    keys = ["segment_column", "segment_value"]
    left = champion.select(*keys, F.col(metric).alias("champion_value"))
    right = challenger.select(*keys, F.col(metric).alias("challenger_value"))
    return left.join(right, keys).withColumn("delta", F.col("challenger_value") - F.col("champion_value"))


def segment_regressions(champion: DataFrame, challenger: DataFrame, rule: PromotionRule = PromotionRule()) -> DataFrame:
    """Segments where the challenger loses more than the tolerance (strictly)."""
    deltas = segment_deltas(champion, challenger, rule.metric).where(F.col("segment_column") != OVERALL)
    return deltas.where(F.col("delta") < -rule.segment_tolerance)


def model_deltas(evaluated: DataFrame, champion: str, challenger: str, metric: str = "f1") -> DataFrame:
    """``segment_deltas`` from one ``evaluate_models`` frame, without a join."""

    def of(model: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(metric)))

    pairs = evaluated.groupBy("segment_column", "segment_value").agg(of(champion).alias("champion_value"), of(challenger).alias("challenger_value"))
    return pairs.dropna().withColumn("delta", F.col("challenger_value") - F.col("champion_value"))


def promotion_decision(champion: DataFrame, challenger: DataFrame, rule: PromotionRule = PromotionRule()) -> DataFrame:
    """One row (promote, reason, aggregate_margin, regressions, regression_deltas) from two ``evaluate`` frames.

    The margin on the whole table is tested first (inclusive); regressions are listed only if it holds. ``regression_deltas`` maps
    each regressed segment to its delta.
    """
    return decided(segment_deltas(champion, challenger, rule.metric), rule)


def decided(deltas: DataFrame, rule: PromotionRule = PromotionRule()) -> DataFrame:
    """The same from (segment_column, segment_value, delta), one row per segment."""
    is_overall = F.col("segment_column") == OVERALL
    regressed = ~is_overall & (F.col("delta") < -rule.segment_tolerance)
    entry = F.struct(F.concat_ws("=", "segment_column", "segment_value").alias("segment"), F.col("delta"))
    one = deltas.agg(
        F.max(F.when(is_overall, F.col("delta"))).alias("aggregate_margin"),
        # Holds at most one entry per segment of the evaluated, low-cardinality columns.
        F.array_sort(F.collect_list(F.when(regressed, entry))).alias("_regressed"),
    )
    wins = F.coalesce(F.col("aggregate_margin") >= rule.margin, F.lit(False))
    clean = F.size("_regressed") == 0
    listed = F.when(wins, F.col("_regressed")).otherwise(F.slice("_regressed", 1, 0))
    return one.select(
        (wins & clean).alias("promote"),
        F.when(~wins, "margin not reached").when(~clean, "segment regression").otherwise("wins").alias("reason"),
        "aggregate_margin",
        F.transform(listed, lambda e: e["segment"]).alias("regressions"),
        F.map_from_entries(listed).alias("regression_deltas"),
    )


def retrain_decision(summary: DataFrame, rule: RetrainRule = RetrainRule(), order: str = "intensity") -> DataFrame:
    """The worst batch against the threshold (strictly above). First batch wins ties; nulls are skipped."""
    observed = F.col(rule.metric).cast("double")
    rank = F.struct(observed.alias("value"), (-F.col(order)).alias("tie"))
    worst = summary.where(observed.isNotNull()).agg(
        F.max_by(F.col("batch_name"), rank).alias("triggering_batch"), F.max(observed).alias("observed_value")
    )
    return worst.select(
        (F.col("observed_value") > rule.threshold).alias("should_retrain"),
        F.lit(rule.metric).alias("trigger_metric"),
        "observed_value",
        F.lit(rule.threshold).alias("threshold"),
        "triggering_batch",
    )


def rank_models(results: DataFrame, metric: str = "f1") -> DataFrame:
    """Best first, by name on ties."""
    return results.orderBy(F.desc(metric), "family")


def best_model(results: DataFrame, metric: str = "f1") -> DataFrame:
    """The top row of the ranking as a one-row frame, without a sort."""
    columns = F.struct(*results.columns)
    best = results.agg(F.max(F.col(metric)).alias("_best")).select("_best")
    tied = results.join(F.broadcast(best), F.col(metric) == F.col("_best")).drop("_best")
    return tied.agg(F.min_by(columns, F.col("family")).alias("row")).select("row.*")
