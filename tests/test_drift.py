import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from itertools import combinations

from retentia.functions.stats import _chi_square_tail, _kolmogorov_exact, _stride, _walk, kolmogorov_tail
from retentia.operators.drift import DriftRule, column_drift, drift_summary, sweep_drift
from retentia.operators.drift_many import OTHER, many_drift, reference_counts


def normal_frame(spark, n, mean=0.0, share=0.5, seed=0, extra=()):
    rng = random.Random(seed)
    data = [(rng.gauss(mean, 1.0), "x" if rng.random() < share else "y", rng.choice("abc")) for _ in range(n)]
    return spark.createDataFrame([*data, *extra], "num double, two string, three string")


def by_column(frame):
    return {r["column"]: r for r in frame.collect()}


P_TESTS = DriftRule(numeric_test="ks", text_test="chi_square", column_tests={"two": "z_test"})


@pytest.mark.parametrize("n", [200, 1500])
@pytest.mark.parametrize("rule, methods", [(P_TESTS, {"ks", "z_test", "chi_square"}), (DriftRule(), {"wasserstein", "jensen_shannon"})])
def test_same_data_does_not_drift(spark, n, rule, methods):
    df = normal_frame(spark, n)
    got = column_drift(df, df, rule)
    assert {r["method"] for r in got.collect()} == methods
    assert drift_summary(got).first()["n_drifted_columns"] == 0


@pytest.mark.parametrize("rule", [P_TESTS, DriftRule()])
def test_moved_data_drifts(spark, rule):
    got = column_drift(normal_frame(spark, 200), normal_frame(spark, 200, mean=10.0, share=0.05, seed=1), rule)
    cols = by_column(got)
    assert cols["num"]["drifted"] and cols["two"]["drifted"]
    row = drift_summary(got).first()
    assert row["dataset_drift_share"] >= 0.5 and row["dataset_drifted"]


def test_distances_against_numpy(spark):
    ref, cur = normal_frame(spark, 1300, seed=2), normal_frame(spark, 400, mean=0.3, share=0.6, seed=3)
    cols = by_column(column_drift(ref, cur))
    a, b = np.array([r["num"] for r in ref.collect()]), np.array([r["num"] for r in cur.collect()])
    grid = np.sort(np.concatenate([a, b]))
    gap = np.abs(np.searchsorted(np.sort(a), grid[:-1], "right") / len(a) - np.searchsorted(np.sort(b), grid[:-1], "right") / len(b))
    assert cols["num"]["score"] == pytest.approx(float((gap * np.diff(grid)).sum() / a.std()))
    p = [r["two"] for r in ref.collect()].count("x") / 1300
    q = [r["two"] for r in cur.collect()].count("x") / 400
    js = 0.0
    for s, t in ((p, q), (1 - p, 1 - q)):
        js += 0.5 * (s * math.log2(2 * s / (s + t)) + t * math.log2(2 * t / (s + t)))
    assert cols["two"]["score"] == pytest.approx(math.sqrt(js))


def test_missing_values_are_left_out(spark):
    ref = normal_frame(spark, 1200, extra=[(None, None, "a"), (float("nan"), "x", None)])
    cols = by_column(column_drift(ref, ref))
    assert cols["num"]["score"] == 0.0 and cols["two"]["score"] == pytest.approx(0.0, abs=1e-9)


def test_new_level_makes_chi_square_reject(spark):
    ref = spark.createDataFrame([("a",), ("b",), ("c",)] * 50, "v string")
    cur = spark.createDataFrame([("a",), ("b",), ("z",)] * 50, "v string")
    for test in ("chi_square", "z_test"):
        row = column_drift(ref, cur, DriftRule(text_test=test)).first()
        assert (row["method"], row["score"], row["drifted"]) == (test, 0.0, True)


def test_a_test_that_the_kind_cannot_have_is_refused(spark):
    df = spark.createDataFrame([("a",)], "v string")
    with pytest.raises(ValueError, match="no test 'ks'"):
        column_drift(df, df, DriftRule(text_test="ks"))


def test_numbers_declared_as_levels(spark):
    ref = spark.range(2000).select((F.col("id") % 3).alias("v"))
    cur = spark.range(600).select(F.lit(1).cast("bigint").alias("v"))
    row = column_drift(ref, cur, DriftRule(column_tests={"v": "jensen_shannon"})).first()
    assert row["method"] == "jensen_shannon" and row["drifted"]
    assert column_drift(ref, cur).first()["method"] == "wasserstein"


def test_sweep_equals_one_comparison_per_batch(spark):
    ref = normal_frame(spark, 1100)
    parts = {"p": normal_frame(spark, 300, mean=0.2, seed=5), "q": normal_frame(spark, 200, mean=2.0, share=0.9, seed=6)}
    both = parts["p"].withColumn("batch_name", F.lit("p")).unionByName(parts["q"].withColumn("batch_name", F.lit("q")))
    sweep = {(r["batch"], r["column"]): r["score"] for r in sweep_drift(ref, both, ["p", "q"]).collect()}
    for name, part in parts.items():
        for r in column_drift(ref, part, DriftRule(), batch=name).collect():
            assert sweep[(name, r["column"])] == pytest.approx(r["score"])


@pytest.mark.parametrize("x, dof, want", [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05), (18.307038053275146, 10, 0.05), (0.0, 4, 1.0), (1e9, 10**9, 0.5), (1e9 + 1, 10**9 + 1, 0.5)])
def test_chi_square_tail(x, dof, want):
    assert _chi_square_tail(x, dof) == pytest.approx(want, abs=1e-9 if dof < 100 else 1e-5)


def test_columns_and_batches_without_values(spark):
    from retentia.operators.drift import column_drift, drift_summary

    schema = "a double, b double, c string, d string, e double"
    reference = spark.createDataFrame([(float(i), None, "x", None, float(i)) for i in range(40)], schema)
    batch = spark.createDataFrame([(float(i), float(i), None, None, float(i)) for i in range(30)], schema)
    out = {r["column"]: (r["method"] == "no_values", r["drifted"]) for r in column_drift(reference, batch).collect()}
    assert out == {"a": (False, out["a"][1]), "b": (True, True), "c": (True, True), "d": (True, False), "e": (False, out["e"][1])}
    empty = column_drift(reference, batch.limit(0))
    assert sorted((r["column"], r["drifted"]) for r in empty.collect()) == [("a", True), ("b", False), ("c", True), ("d", False), ("e", True)]
    assert drift_summary(empty).first()["n_columns"] == 5


@pytest.mark.parametrize("n1, n2", [(1, 1), (1, 5), (4, 4), (3, 7), (5, 6), (2, 9)])
def test_exact_ks_tail_against_every_order(n1, n2):
    distances = []
    for places in combinations(range(n1 + n2), n1):
        i = j = 0
        best = 0
        for at in range(n1 + n2):
            i, j = i + (at in places), j + (at not in places)
            best = max(best, abs(i * n2 - j * n1))
        distances.append(best)
    for reach in sorted(set(distances)):
        want = sum(d >= reach for d in distances) / len(distances)
        for a, b in ((n1, n2), (n2, n1)):
            assert _kolmogorov_exact(reach / (n1 * n2), a, b) == pytest.approx(want, rel=1e-12)
    assert _kolmogorov_exact(0.0, n1, n2) == 1.0 and math.isnan(_kolmogorov_exact(0.5, 0, n2))


def test_exact_and_asymptotic_ks_tails_agree_on_large_samples(spark):
    frame = spark.createDataFrame([(0.02, 3000, 5000), (0.035, 3000, 5000), (0.05, 4000, 4000)], "d double, a bigint, b bigint")
    for r in frame.select("d", "a", "b", kolmogorov_tail(F.col("d"), F.col("a"), F.col("b")).alias("p")).collect():
        assert _kolmogorov_exact(r["d"], r["a"], r["b"]) == pytest.approx(r["p"], rel=0.1)


@pytest.mark.parametrize("n, k", [(2000, 30), (200_000, 300), (200_000, 3162), (200_000, 9000)])
def test_exact_ks_tail_of_equal_samples_is_the_closed_sum(n, k):
    """Narrow and wide ranges, and a probability of 1e-176."""

    def term(j):
        return math.exp(2 * math.lgamma(n + 1) - math.lgamma(n - j * k + 1) - math.lgamma(n + j * k + 1))

    want = 2 * sum((-1) ** (j - 1) * term(j) for j in range(1, min(40, n // k) + 1))
    assert _kolmogorov_exact(k / n, n, n) == pytest.approx(want, rel=1e-7)


def test_exact_ks_tail_below_the_smallest_double_takes_no_steps():
    assert _kolmogorov_exact(1.0, 2 * 10**8, 3 * 10**9) == 0.0
    assert _kolmogorov_exact(1.0, 400, 500) == pytest.approx(2 * math.exp(math.lgamma(401) + math.lgamma(501) - math.lgamma(901)), rel=1e-9)


@pytest.mark.parametrize("up", [0.5, 0.2])
def test_a_stride_takes_the_same_steps_at_once(up):
    steps, width, margin = 200, 3000, 130
    rise = np.floor(np.arange(steps + 1) * up + 0.3).astype(int)
    mass = np.random.default_rng(3).random(width)
    for a, b in zip(_walk(mass, rise, rise + width - 1, up), _stride(mass, rise, rise + width - 1, up, margin), strict=True):
        assert a == pytest.approx(b, rel=1e-11)


def test_ks_tail_of_billions_of_rows_does_not_overflow(spark):
    frame = spark.createDataFrame([(3e-5, 5 * 10**9, 4 * 10**9)], "d double, a bigint, b bigint")
    p = frame.select(kolmogorov_tail(F.col("d"), F.col("a"), F.col("b"))).first()[0]
    assert 0.03 < p < 0.05


RULES = [DriftRule(), P_TESTS, DriftRule(numeric_test="ks_exact", text_test="chi_square"), DriftRule(numeric_test="jensen_shannon"), DriftRule(numeric_test="chi_square")]


@pytest.mark.parametrize("rule", RULES)
def test_many_batches_get_what_each_gets_alone(spark, rule):
    """Batches of all sizes, values the reference lacks, columns without values: the same as one batch at a time."""
    rng = random.Random(11)
    reference = normal_frame(spark, 300, seed=5, extra=[(None, None, None), (0.5, "x", "a"), (float("nan"), "y", "b")]).withColumn("empty", F.lit(None).cast("double"))
    data = []
    for name, n, mean in (("one", 1, 0.0), ("near", 60, 0.1), ("far", 80, 3.0), ("below", 30, -9.0), ("ties", 40, None), ("blank", 5, "none")):
        for _ in range(n):
            num = None if mean == "none" else rng.choice([-1.0, 0.0, 0.5]) if mean is None else rng.gauss(mean, 1.0)
            data.append((name, num, rng.choice("xy"), None if name == "blank" else rng.choice("abd" if name == "far" else "abc"), 1.0 if name == "far" else None))
    batches = spark.createDataFrame([*data, (None, 1.0, "x", "a", None)], "batch string, num double, two string, three string, empty double")
    got = {(r["batch"], r["column"]): r for r in many_drift(reference_counts(reference), batches, "batch", rule).collect()}
    names = sorted({d[0] for d in data})
    assert len(got) == len(names) * 4
    for name in names:
        alone = by_column(column_drift(reference, batches.where(F.col("batch") == name).drop("batch"), rule, batch=name))
        for c, want in alone.items():
            r = got[(name, c)]
            assert (r["kind"], r["method"], r["threshold"], r["drifted"]) == (want["kind"], want["method"], want["threshold"], want["drifted"]), (name, c)
            assert r["score"] == (None if want["score"] is None else pytest.approx(want["score"], abs=1e-9)), (name, c)


def test_rare_levels_are_pooled(spark):
    reference = spark.range(1000).select(F.when(F.col("id") < 800, "hot").when(F.col("id") < 950, "warm").otherwise(F.concat(F.lit("r"), F.col("id"))).alias("x"))
    counted = reference_counts(reference, top_levels=2)
    assert {r["txt"]: r["n_ref"] for r in counted.counts.collect()} == {"hot": 800, "warm": 150, OTHER: 50}
    # New rare levels are no drift as long as they are as rare as before.
    batch = spark.range(100).select(F.when(F.col("id") < 80, "hot").when(F.col("id") < 95, "warm").otherwise(F.concat(F.lit("n"), F.col("id"))).alias("x"))
    assert not many_drift(counted, batch, F.lit("b")).first()["drifted"]
    assert many_drift(reference_counts(reference), batch, F.lit("b"), DriftRule(text_test="chi_square")).first()["drifted"]
