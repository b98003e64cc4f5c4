import random

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from retentia.functions.ordered import exact_quantiles, running_sums
from retentia.operators.decisions import PromotionRule, RetrainRule, best_model, promotion_decision, rank_models, retrain_decision, segment_regressions
from retentia.operators.metrics import METRICS, classification_metrics, evaluate, segment_metrics


def frame(spark, y, pred, score, **extra):
    names = list(extra)
    data = [(int(a), int(b), float(c), *[extra[n][i] for n in names]) for i, (a, b, c) in enumerate(zip(y, pred, score))]
    return spark.createDataFrame(data, "churn int, prediction int, score double" + "".join(f", {n} string" for n in names))


def brute_force(y, score):
    """(AUC over all pairs, average precision over thresholds)."""
    pos, neg = [s for s, t in zip(score, y) if t], [s for s, t in zip(score, y) if not t]
    auc = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    ap, recall = 0.0, 0.0
    for t in sorted(set(score), reverse=True):
        taken = [b for s, b in zip(score, y) if s >= t]
        ap += (sum(taken) / len(pos) - recall) * sum(taken) / len(taken)
        recall = sum(taken) / len(pos)
    return auc, ap


def test_hand_computed(spark):
    row = classification_metrics(frame(spark, [0, 1, 0, 1, 1], [0, 1, 1, 0, 1], [0.2, 0.9, 0.55, 0.4, 0.7])).first()
    assert row["precision"] == pytest.approx(2 / 3) and row["recall"] == pytest.approx(2 / 3)
    assert row["f1"] == pytest.approx(2 / 3) and row["accuracy"] == 0.6
    assert row["roc_auc"] == pytest.approx(5 / 6) and row["pr_auc"] == pytest.approx(11 / 12)


def test_no_positives_and_no_rows(spark):
    row = classification_metrics(frame(spark, [0, 0, 0], [0, 1, 0], [0.3, 0.6, 0.6])).first()
    assert row["roc_auc"] is None and row["pr_auc"] is None and row["f1"] == 0.0 and row["accuracy"] == pytest.approx(2 / 3)
    df = frame(spark, [0, 0, 1, 0, 1, 1], [0, 1, 1, 0, 1, 1], [0.1, 0.9, 0.8, 0.3, 0.6, 0.7], plan=["neg", "neg", "both", "both", "pos", None])
    assert [r["segment"] for r in segment_metrics(df, ["plan"]).collect()] == ["plan=both"]
    assert segment_metrics(df.limit(0), ["plan"]).collect() == []


def test_a_null_score_is_an_error(spark):
    df = frame(spark, [0, 1], [0, 1], [0.1, 0.2]).withColumn("score", F.when(F.col("churn") == 1, F.col("score")))
    with pytest.raises(Exception, match="no score"):
        classification_metrics(df).collect()


@pytest.mark.parametrize("levels", [3, 40, 100000])
def test_auc_and_ap_against_brute_force(spark, levels):
    rng = random.Random(levels)
    score = [rng.randrange(levels) / levels for _ in range(400)]
    y = [int(rng.random() < 0.2 + 0.5 * s) for s in score]
    row = classification_metrics(frame(spark, y, [int(s > 0.5) for s in score], score)).first()
    auc, ap = brute_force(y, score)
    assert row["roc_auc"] == pytest.approx(auc) and row["pr_auc"] == pytest.approx(ap)


def test_no_predicted_positive_gives_zero_precision(spark):
    row = classification_metrics(frame(spark, [0, 1], [0, 0], [0.1, 0.2])).first()
    assert (row["precision"], row["f1"], row["recall"]) == (0.0, 0.0, 0.0)


def test_one_class_has_no_auc(spark):
    row = classification_metrics(frame(spark, [1, 1], [0, 1], [0.1, 0.2])).first()
    assert row["roc_auc"] is None and row["pr_auc"] is None and row["recall"] == 0.5


def test_segments_skip_nulls_and_single_classes(spark):
    df = frame(spark, [0, 1, 1, 1, 0, 1], [0, 1, 1, 0, 1, 1], [0.1, 0.9, 0.8, 0.3, 0.6, 0.7], plan=["a", "a", "b", "b", None, None])
    assert [r["segment"] for r in segment_metrics(df, ["plan"]).collect()] == ["plan=a"]
    assert {r["segment"] for r in segment_metrics(df, ["plan"], include_null=True).collect()} == {"plan=a", "plan=(null)"}
    assert {r["segment"] for r in evaluate(df, ["plan"]).collect()} == {"plan=a", "overall=overall"}


def test_metrics_do_not_depend_on_partitioning(spark):
    rng = random.Random(3)
    score = [rng.random() for _ in range(500)]
    df = frame(spark, [int(rng.random() < s) for s in score], [int(s > 0.5) for s in score], score, plan=[rng.choice("ab") for _ in score])
    results = []
    for partitions in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        frame_ = evaluate(df.repartition(int(partitions)), ["plan"])
        results.append([tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in rows(frame_, "segment", *METRICS)])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_running_sums_match_a_plain_cumulative_sum(spark, ranges):
    rng = random.Random(ranges)
    data = sorted({(rng.choice("xy"), rng.randrange(300)) for _ in range(300)})
    counts = spark.createDataFrame([(k, float(v), rng.randrange(1, 5), 1) for k, v in data], "k string, v double, n bigint, m bigint")
    local = counts.toPandas().sort_values(["k", "v"])
    local["before"] = local.groupby("k")["n"].cumsum() - local["n"]
    local["next"] = local.groupby("k")["v"].shift(-1)
    got = running_sums(counts, ["k"], "v", ["n", "m"], ranges=ranges, with_next=True).toPandas().sort_values(["k", "v"])
    assert got["n_before"].tolist() == local["before"].tolist()
    assert np.array_equal(got["next_value"].to_numpy(), local["next"].to_numpy(), equal_nan=True)
    assert got["n_total"].tolist() == local.groupby("k")["n"].transform("sum").tolist()


def test_quantiles_match_linear_interpolation(spark):
    rng = random.Random(5)
    values = [rng.choice([1.0, 2.0, 2.0, 5.5, rng.random() * 10]) for _ in range(237)]
    counts = spark.createDataFrame([("c", v) for v in values], "k string, v double").groupBy("k", "v").agg(F.count("*").alias("n"))
    row = exact_quantiles(counts, ["k"], "v", "n", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}).first()
    assert [row[c] for c in "abcde"] == pytest.approx(np.percentile(values, [0, 25, 50, 99, 100]).tolist())


def evaluated(spark, overall, **segments):
    data = [("overall", "overall", overall)] + [("Contract", k, v) for k, v in segments.items()]
    return spark.createDataFrame(data, "segment_column string, segment_value string, f1 double")


def decide(spark, old, new):
    return promotion_decision(old, new, PromotionRule()).first()


def test_margin_is_inclusive_on_doubles(spark):
    # 0.81 - 0.80 is just above 0.01 in binary.
    assert decide(spark, evaluated(spark, 0.80), evaluated(spark, 0.81))["promote"]
    lost = decide(spark, evaluated(spark, 0.80), evaluated(spark, 0.805))
    assert (lost["promote"], lost["reason"]) == (False, "margin not reached")


def test_regressed_segment_blocks_and_is_named(spark):
    got = decide(spark, evaluated(spark, 0.80, a=0.9, b=0.7), evaluated(spark, 0.85, a=0.75, b=0.8))
    assert (got["promote"], got["reason"], got["regressions"]) == (False, "segment regression", ["Contract=a"])


def test_regressions_stay_empty_without_the_margin(spark):
    assert decide(spark, evaluated(spark, 0.80, a=0.9), evaluated(spark, 0.80, a=0.1))["regressions"] == []


def test_tolerance_is_strict_and_one_sided_segments_are_ignored(spark):
    old, new = evaluated(spark, 0.8, a=0.90, b=0.50, gone=0.9), evaluated(spark, 0.9, a=0.88, b=0.47, new=0.1)
    # 0.47 - 0.50 is -0.030000000000000027 in binary, which is beyond the tolerance.
    assert [r["segment_value"] for r in segment_regressions(old, new).collect()] == ["b"]


def summary(spark, *shares):
    return spark.createDataFrame([(n, float(i), s) for i, (n, s) in enumerate(shares)], "batch_name string, intensity double, dataset_drift_share double")


@pytest.mark.parametrize(
    "shares, retrain, batch",
    [
        ((("a", 0.026), ("b", 0.051), ("c", 0.08)), False, "c"),
        ((("a", 0.128), ("b", 0.5), ("c", 0.03)), True, "b"),
        ((("a", 0.026), ("b", 0.1282), ("c", 0.1282), ("d", 0.1282)), True, "b"),
        ((("a", None), ("b", 0.10)), False, "b"),
    ],
)
def test_retrain_decision(spark, shares, retrain, batch):
    got = retrain_decision(summary(spark, *shares), RetrainRule()).first()
    assert (got["should_retrain"], got["triggering_batch"]) == (retrain, batch)


def test_ranking_and_winner(spark):
    table = spark.createDataFrame([("x", 0.7), ("b", 0.9), ("a", 0.9)], "family string, f1 double")
    assert [r["family"] for r in rank_models(table).collect()] == ["a", "b", "x"]
    assert best_model(table).first()["family"] == "a"
