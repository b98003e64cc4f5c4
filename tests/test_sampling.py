from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F

from retentia.operators import sampling
from retentia.operators.sampling import (
    BatchPlan,
    CategoricalReweight,
    NumericShift,
    apply_drift,
    bootstrap,
    drift_spec,
    drift_sweep,
    level_intervals,
    quotas_of,
    row_index,
    stratified_folds,
    stratified_split,
)


def labelled(spark, n, every):
    return spark.range(n).select(F.col("id"), (F.col("id") % every == 0).cast("int").alias("y"))


@pytest.mark.parametrize("n, every", [(50, 3), (101, 4), (7, 2), (1000, 7)])
def test_split_has_exact_size_and_keeps_shares(spark, n, every):
    out = stratified_split(labelled(spark, n, every), "y", "id", 0.2, seed=1, slices=16)
    got = {(r["y"], r["is_test"]): r["count"] for r in out.groupBy("y", "is_test").count().collect()}
    n_test = sum(c for (_, t), c in got.items() if t == 1)
    assert n_test == -(-n * 2 // 10)
    positives = sum(c for (y, _), c in got.items() if y == 1)
    assert abs(got.get((1, 1), 0) - positives * n_test / n) < 1


def test_split_depends_on_seed_but_not_on_partitions_or_slices(spark):
    df = labelled(spark, 300, 4)
    first = rows(stratified_split(df, "y", "id", slices=8))
    assert first == rows(stratified_split(df.repartition(13), "y", "id", slices=1024))
    assert first != rows(stratified_split(df, "y", "id", seed=7, slices=8))


def test_folds_are_even_within_classes(spark):
    out = stratified_folds(labelled(spark, 203, 3), "y", "id", 5, slices=16)
    assert out.where(F.col("fold").between(0, 4)).count() == 203
    for y in (0, 1):
        sizes = [r["count"] for r in out.where(F.col("y") == y).groupBy("fold").count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_row_index_is_dense(spark):
    assert sorted(r["row_index"] for r in row_index(spark.range(500), "id", 32).collect()) == list(range(500))


def test_bootstrap_has_exactly_n_rows_with_replacement(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, v string")
    out = bootstrap(df, "id", 10)
    assert out.count() == 10 and {r["v"] for r in out.collect()} <= {"a", "b", "c"}
    assert rows(out) == rows(bootstrap(df.repartition(3), "id", 10))


def batch(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"draw bigint, x {kind}")


def test_shift_at_zero_changes_nothing(spark):
    out = apply_drift(batch(spark, [10.0, 20.0, 30.0]), {"x": NumericShift(15.0, 0.5)}, 0.0)
    assert sorted(r["x"] for r in out.collect()) == [10.0, 20.0, 30.0]


def test_shift_moves_the_mean_and_scales_the_spread(spark):
    out = sorted(r["x"] for r in apply_drift(batch(spark, [10.0, 20.0, 30.0]), {"x": NumericShift(15.0, 0.5)}, 1.0).collect())
    assert out == [20.0, 35.0, 50.0]


def test_shift_is_clipped_and_null_stays(spark):
    out = apply_drift(batch(spark, [1.0, 2.0, None]), {"x": NumericShift(-10.0, clip_min=0)}, 1.0)
    assert sorted((r["x"] for r in out.collect()), key=str) == [0.0, 0.0, None]


@pytest.mark.parametrize("intensity, target, want", [(0.0, 0.3, 0.8), (1.0, 0.3, 0.3), (0.5, 0.3, 0.55)])
def test_reweight_reaches_the_interpolated_share(spark, intensity, target, want):
    df = spark.range(5000).select(F.col("id").alias("draw"), F.when(F.col("id") < 4000, "x").otherwise("y").alias("x"))
    out = apply_drift(df, {"x": CategoricalReweight({"x": target, "y": 1 - target})}, intensity)
    assert out.where("x = 'x'").count() / 5000 == pytest.approx(want, abs=0.03)


def test_reweight_adds_new_levels_and_drops_nulls(spark):
    df = spark.range(1000).select(F.col("id").alias("draw"), F.when(F.col("id") < 900, "x").alias("x"))
    out = apply_drift(df, {"x": CategoricalReweight({"z": 1.0})}, 0.5)
    assert {r["x"] for r in out.collect()} == {"x", "z"}


@pytest.mark.parametrize("intensity, few", [(0.0, 10), (0.4, 10), (1.0, 10), (0.4, 10_000)])
def test_reweight_of_many_levels_tiles_the_unit_interval(spark, monkeypatch, intensity, few):
    monkeypatch.setattr(sampling, "FEW_LEVELS", few)
    n = 3000
    df = spark.range(n).select(F.col("id").alias("draw"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id"))).otherwise("hot").alias("x"))
    spec = CategoricalReweight({"hot": 0.2, "zz": 0.3, "v1": 0.5})
    edges = level_intervals(df, "x", spec, [intensity])[0].select("level", "low", "high").distinct().orderBy("low").collect()
    assert edges[0]["low"] == 0.0 and edges[-1]["high"] == 2.0 and all(a["high"] == b["low"] for a, b in zip(edges, edges[1:]))
    now = {"hot": 1 / 3} | {f"v{i}": 1 / n for i in range(n) if i % 3}
    want = {k: (1 - intensity) * now.get(k, 0) + intensity * spec.target.get(k, 0) for k in now | spec.target}
    got = {r["level"]: min(r["high"], 1.0) - r["low"] for r in edges}
    assert got.keys() == {k for k, w in want.items() if w > 0} and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in got)
    out = apply_drift(df, {"x": spec}, intensity)
    assert out.count() == n and out.where("x IS NULL").count() == 0


def test_reweight_without_values_or_weights(spark):
    df = spark.range(5).select(F.col("id").alias("draw"), F.lit(None).cast("string").alias("x"))
    assert {r["x"] for r in apply_drift(df, {"x": CategoricalReweight({"a": 1.0})}, 0.0).collect()} == {None}
    assert {r["x"] for r in apply_drift(df, {"x": CategoricalReweight({"a": 1.0})}, 0.5).collect()} == {"a"}
    assert apply_drift(df.limit(0), {"x": CategoricalReweight({"a": 1.0})}, 0.5).count() == 0


def test_quotas_of_billions_of_rows_do_not_overflow(spark):
    counts = spark.createDataFrame([("a", 5 * 10**9), ("b", 4 * 10**9 + 1), ("c", 3)], "y string, n bigint")
    out = {r["y"]: r["n_train"] for r in quotas_of(counts, "y", 0.2).collect()}
    total = 9 * 10**9 + 4
    want = total - -(-total * 2 // 10)
    assert sum(out.values()) == want and all(abs(out[k] - n * want / total) < 1 for k, n in {"a": 5 * 10**9, "b": 4 * 10**9 + 1, "c": 3}.items())


def test_guards(spark):
    with pytest.raises(ValueError, match="can't be perturbed"):
        apply_drift(batch(spark, [1.0]), {"x": NumericShift(1.0)}, 1.0, target="x")
    with pytest.raises(ValueError, match="unknown drift type"):
        drift_spec({"type": "bogus"})
    assert drift_spec({"type": "numeric_shift", "mean_shift": 1.0}) == NumericShift(1.0)


def test_sweep_repeats_the_same_draws_per_intensity(spark):
    df = spark.range(100).select("id", (F.col("id") * 1.0).alias("charge"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("plan"), F.col("id").alias("other"))
    plan = BatchPlan(batch_size=40, intensities=(0.0, 1.0), specs={"charge": NumericShift(5.0), "plan": CategoricalReweight({"a": 0.9, "b": 0.1})})
    out = drift_sweep(df, "id", plan, "label")
    per = {r["batch_name"]: (r["n"], r["mean"], r["others"]) for r in out.groupBy("batch_name").agg(F.count("*").alias("n"), F.avg("charge").alias("mean"), F.sum("other").alias("others")).collect()}
    base, moved = per["batch_intensity_0.00"], per["batch_intensity_1.00"]
    assert base[0] == moved[0] == 40 and base[2] == moved[2]
    assert moved[1] - base[1] == pytest.approx(5.0)
    assert rows(out) == rows(drift_sweep(df.repartition(7), "id", plan, "label"))
    other = drift_sweep(df, "id", BatchPlan(batch_size=40, seed=1, intensities=(0.0, 1.0), specs=plan.specs), "label")
    assert rows(out) != rows(other)


def test_null_labels_are_a_class(spark):
    from retentia.operators.sampling import bootstrap, stratified_folds, stratified_split

    df = spark.range(1000).selectExpr("id", "case when id % 4 = 0 then null else cast(id % 2 as int) end as y")
    out = stratified_split(df, "y", "id")
    assert sorted((r["y"] is None, r["y"] or 0, r["n"]) for r in out.where("is_test = 1").groupBy("y").agg(F.count("*").alias("n")).collect()) == [(False, 0, 50), (False, 1, 100), (True, 0, 50)]
    sizes = stratified_folds(df, "y", "id").where("y is null").groupBy("fold").count().collect()
    assert sorted(r["count"] for r in sizes) == [50] * 5


@pytest.mark.parametrize("few", [0, 10_000])
def test_bootstrap_of_repeated_and_null_keys(spark, monkeypatch, few):
    """One key holds a third of the rows, some rows are equal, some keys null: every row is drawn about as often as any other."""
    monkeypatch.setattr(sampling, "FEW_DRAWS", few)
    parts = ["case when id % 3 = 0 then 7 when id % 50 = 1 then null else id % 20 end as k", "case when id % 5 = 0 then -1 else id end as v", "cast(null as string) as draw_note"]
    df = spark.range(600).selectExpr(*parts)
    drawn = bootstrap(df, "k", 6000, seed=3, slices=64)
    assert drawn.columns == ["draw", "k", "v", "draw_note"]
    out = drawn.collect()
    assert sorted(r["draw"] for r in out) == list(range(6000))
    there = Counter((r["k"], r["v"]) for r in df.collect())
    got = Counter((r["k"], r["v"]) for r in out)
    assert got.keys() <= there.keys()
    # Ten draws are expected per row; five deviations of a Poisson count.
    assert all(abs(got[k] - 10 * n) <= 5 * (10 * n) ** 0.5 + 1 for k, n in there.items())
    assert rows(drawn, "draw", "v") == rows(bootstrap(df.repartition(5), "k", 6000, seed=3, slices=64), "draw", "v")
    assert bootstrap(df.limit(0), "k", 10).count() == 0


def test_bootstrap_of_one_row_repeated(spark):
    assert bootstrap(spark.range(50).selectExpr("1 as k"), "k", 7).count() == 7
