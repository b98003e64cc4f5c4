import pytest
from pyspark.sql import functions as F

from retentia.operators.decisions import RetrainRule, retrain_decision
from retentia.operators.drift import column_drift
from retentia.operators.metrics import classification_metrics
from retentia.operators.sampling import bootstrap, stratified_split
from retentia.streaming.drift_stream import monitor_stream, stream_summary


def test_each_arriving_batch_is_measured(spark, tmp_path):
    reference = spark.range(1500).select((F.col("id") % 97).cast("double").alias("x"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("y"))
    for i, shift in enumerate((0.0, 60.0)):
        batch = reference.where(F.rand(i) < 0.4).withColumn("x", F.col("x") + shift)
        batch.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(reference.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        query = monitor_stream(stream, reference, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
    summary = stream_summary(spark, str(tmp_path / "out"))
    assert [r["n_drifted_columns"] for r in summary.orderBy("batch_id").collect()] == [0, 1]
    verdict = retrain_decision(summary, RetrainRule(), order="batch_id").first()
    assert verdict["should_retrain"] and verdict["triggering_batch"] == "batch_000001"


def test_hot_group_and_hot_value(spark):
    """A third of the rows in one group with one score: counts collapse and sizes stay exact."""
    df = spark.range(30000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") % 1009) / 1009.0).alias("score"),
        (F.col("id") % 7 == 0).cast("int").alias("churn"),
    ).withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    rows = {r["g"]: r for r in classification_metrics(df, by=["g"]).collect()}
    assert sum(r["n"] for r in rows.values()) == 30000
    assert rows["hot"]["n"] == 10000 and rows["hot"]["roc_auc"] == pytest.approx(0.5)
    split = stratified_split(df, "g", "id")
    assert split.where("is_test = 1").count() == 6000 and split.count() == 30000
    assert bootstrap(df.select("id"), "id", 45000).count() == 45000


def test_drift_of_a_column_with_one_dominant_value(spark):
    reference = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 0.0).otherwise(F.col("id") * 1.0).alias("x"))
    row = column_drift(reference, reference.where("x = 0")).first()
    assert row["drifted"] and row["method"] == "wasserstein"
