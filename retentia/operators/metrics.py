"""Classification metrics, overall and by segment, from one grouped pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.functions.ordered import running_sums
from retentia.functions.scalars import segment_label

METRICS = ("f1", "accuracy", "precision", "recall", "roc_auc", "pr_auc")
OVERALL = "overall"


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def classification_metrics(
    scored: DataFrame,
    label: str = "churn",
    prediction: str = "prediction",
    score: str = "score",
    by: Sequence[str] = (),
    *,
    bounded_keys: bool = False,
) -> DataFrame:
    """F1, accuracy, precision, recall, ROC-AUC and average precision per group of ``by``.

    Rows are first collapsed to one per (group, distinct score), so ties get half credit in the
    ROC-AUC and one step in the average precision. A group with one class has null AUC and AP. A null score is an
    error; rows with a null key of ``by`` are left out.
    """
    y = F.col(label).cast("bigint")
    hit = y * F.col(prediction).cast("bigint")
    false_alarm = (F.lit(1) - y) * F.col(prediction).cast("bigint")
    known = scored.dropna(subset=list(by)) if by else scored
    checked = F.coalesce(F.col(score).cast("double"), F.raise_error(F.lit(f"a row has no {score}")).cast("double"))
    counts = known.groupBy(*by, checked.alias("_score")).agg(
        F.sum(y).alias("pos"),
        F.sum(F.lit(1) - y).alias("neg"),
        F.sum(hit).alias("tp"),
        F.sum(false_alarm).alias("fp"),
    )
    run = running_sums(counts, by, "_score", ["pos", "neg"], bounded_keys=bounded_keys)
    pos_total, neg_total = F.col("pos_total").cast("double"), F.col("neg_total").cast("double")
    taken_pos = F.col("pos_total") - F.col("pos_before")
    taken_neg = F.col("neg_total") - F.col("neg_before")
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2.0))
    steps = F.sum(F.try_divide(F.col("pos"), pos_total) * (taken_pos / (taken_pos + taken_neg)))
    sums = run.groupBy(*by).agg(
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.sum("tp").alias("tp"),
        F.sum("fp").alias("fp"),
        F.when((F.max(pos_total) > 0) & (F.max(neg_total) > 0), wins / (F.max(pos_total) * F.max(neg_total))).alias("roc_auc"),
        F.when((F.max(pos_total) > 0) & (F.max(neg_total) > 0), steps).alias("pr_auc"),
    )
    n, tp, fp = F.col("n_pos") + F.col("n_neg"), F.col("tp"), F.col("fp")
    fn = F.col("n_pos") - tp
    return sums.select(
        *by,
        n.alias("n"),
        F.col("n_pos"),
        _ratio(2.0 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio((tp + F.col("n_neg") - fp).cast("double"), n).alias("accuracy"),
        _ratio(tp.cast("double"), tp + fp).alias("precision"),
        _ratio(tp.cast("double"), F.col("n_pos")).alias("recall"),
        "roc_auc",
        "pr_auc",
    )


def _segment_rows(scored: DataFrame, segment_columns: Sequence[str], with_overall: bool, include_null: bool) -> DataFrame:
    """One row per (row, segment it belongs to); the input is read once."""
    entries = [F.struct(F.lit(c).alias("segment_column"), F.col(c).cast("string").alias("segment_value")) for c in segment_columns]
    if with_overall:
        entries.append(F.struct(F.lit(OVERALL).alias("segment_column"), F.lit(OVERALL).alias("segment_value")))
    rows = scored.withColumn("_segment", F.explode(F.array(*entries))).select("*", "_segment.*").drop("_segment")
    if include_null:
        return rows.withColumn("segment_value", F.coalesce("segment_value", F.lit("(null)")))
    return rows.where(F.col("segment_value").isNotNull())


def segment_metrics(
    scored: DataFrame,
    segment_columns: Sequence[str],
    label: str = "churn",
    prediction: str = "prediction",
    score: str = "score",
    *,
    include_null: bool = False,
) -> DataFrame:
    """Metrics per value of each segment column; null values and one-class segments are left out."""
    frame = evaluate(scored, segment_columns, label, prediction, score, include_null=include_null, with_overall=False)
    return frame


def evaluate_models(
    scored: DataFrame, segment_columns: Sequence[str], models: Mapping[str, tuple[str, str]], label: str = "churn", *, include_null: bool = False
) -> DataFrame:
    """``evaluate`` for several models that scored the same rows, in one pass; ``model`` names them.

    ``models`` has each model's prediction and score column.
    """
    entries = [
        F.struct(F.lit(m).alias("model"), F.col(p).cast("bigint").alias("_prediction"), F.col(s).cast("double").alias("_score_of"))
        for m, (p, s) in models.items()
    ]
    each = scored.select(label, *segment_columns, F.explode(F.array(*entries)).alias("_m")).select(label, *segment_columns, "_m.*")
    rows = _segment_rows(each, segment_columns, True, include_null)
    frame = classification_metrics(rows, label, "_prediction", "_score_of", ["model", "segment_column", "segment_value"])
    return _with_two_classes(frame)


def _with_two_classes(frame: DataFrame) -> DataFrame:
    """Without segments of one class; the overall row stays."""
    two_classes = (F.col("n_pos") > 0) & (F.col("n_pos") < F.col("n"))
    return frame.where(two_classes | (F.col("segment_column") == OVERALL)).withColumn(
        "segment", segment_label(F.col("segment_column"), F.col("segment_value"))
    )


def evaluate(
    scored: DataFrame,
    segment_columns: Sequence[str],
    label: str = "churn",
    prediction: str = "prediction",
    score: str = "score",
    *,
    include_null: bool = False,
    with_overall: bool = True,
) -> DataFrame:
    """The overall row (``overall=overall``) and all segments from one scoring pass."""
    needed = scored.select(label, prediction, score, *segment_columns)
    rows = _segment_rows(needed, segment_columns, with_overall, include_null)
    frame = classification_metrics(rows, label, prediction, score, ["segment_column", "segment_value"])
    return _with_two_classes(frame)
