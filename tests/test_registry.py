from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from retentia.operators.metrics import METRICS, evaluate, evaluate_models
from retentia.operators.decisions import PromotionRule, decided, model_deltas, promotion_decision
from retentia.operators.registry import Registry


def test_writers_at_the_same_time_get_numbers_of_their_own(spark, tmp_path):
    store = Registry(spark, str(tmp_path / "store"))
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: store.register("a model/with a slash", f"run {i}", f"path {i}"), range(20)))
    assert sorted(numbers) == list(range(1, 21))
    assert sorted(r["version"] for r in store.versions().collect()) == list(range(1, 21)) and store.latest("a model/with a slash") == 20
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: store.promote("a model/with a slash", n), numbers[:6]))
    moves = store.aliases().orderBy("step").collect()
    assert [r["step"] for r in moves] == list(range(1, 7)) and store.champion("a model/with a slash") == moves[-1]["version"]


def test_a_claim_without_a_row_is_skipped(spark, tmp_path):
    """A writer that died between its claim and its commit."""
    store = Registry(spark, str(tmp_path / "store"))
    assert store._claim("versions", "m", 1) == 1
    assert store.register("m", "run", "path") == 2 and store.latest("m") == 2
    assert store.register("other", "run", "path") == 1


@pytest.mark.parametrize("scheme", ["", "file://", "viewfs"])
def test_a_file_is_created_once(spark, tmp_path, scheme):
    path = f"{'' if scheme == 'viewfs' else scheme}{tmp_path}/claims/x/1"
    store = Registry(spark, str(tmp_path))
    if scheme == "viewfs":  # any other file system goes through the cluster's own interface
        spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.claims.link./claims", f"file://{tmp_path}")
        path = "viewfs://claims/claims/x/1"
    assert store._create(path) and not store._create(path)


def test_models_are_evaluated_in_one_pass(spark):
    df = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("plan"),
        (F.col("id") % 5 < 2).cast("int").alias("churn"),
        ((F.col("id") * 7) % 11 / 11.0).alias("s1"),
        ((F.col("id") * 5) % 13 / 13.0).alias("s2"),
    ).withColumns({"p1": (F.col("s1") > 0.5).cast("int"), "p2": (F.col("s2") > 0.5).cast("int")})
    both = evaluate_models(df, ["plan"], {"old": ("p1", "s1"), "new": ("p2", "s2")})
    alone = {"old": evaluate(df, ["plan"], "churn", "p1", "s1"), "new": evaluate(df, ["plan"], "churn", "p2", "s2")}
    for model, frame in alone.items():
        want = {r["segment"]: [r[m] for m in METRICS] for r in frame.collect()}
        got = {r["segment"]: [r[m] for m in METRICS] for r in both.where(F.col("model") == model).collect()}
        assert got == {k: pytest.approx(v) for k, v in want.items()} and "plan=a" in want
    rule = PromotionRule(margin=-1.0, segment_tolerance=0.0)
    one = decided(model_deltas(both, "old", "new"), rule).first()
    assert one == promotion_decision(alone["old"], alone["new"], rule).first()
    assert list(one["regression_deltas"]) == one["regressions"] and all(d < 0 for d in one["regression_deltas"].values())
