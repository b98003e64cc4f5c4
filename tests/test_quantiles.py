import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentia.functions import quantiles
from retentia.functions.quantiles import selected_quantiles

ASKED = {"q0": 0.0, "q10": 0.1, "q25": 0.25, "q50": 0.5, "q99": 0.99, "q100": 1.0}
INF = math.inf


def expected(values):
    return np.percentile(np.array(values, float), [100 * p for p in ASKED.values()]).tolist()


def found(row):
    return [row[name] for name in ASKED]


COLUMNS = {
    "even": list(range(1000)),
    "ties": [1.0] * 700 + [2.0] * 299 + [3.5],
    "one": [4.25],
    "two": [-1.0, 7.0],
    "outlier": [random.Random(1).gauss(0, 1) for _ in range(900)] + [1e300, -1e300],
    "tiny": [5e-324 * i for i in range(200)],
    "huge": [-1.7e308, 1.7e308, 1e308, 0.0, 5.0],
    "powers": [2.0**-i for i in range(0, 900, 3)],
}


@pytest.mark.parametrize("bins, rows", [(4096, 200_000), (64, 1), (64, 150)])
def test_quantiles_of_odd_columns(spark, monkeypatch, bins, rows):
    """The same however many bins a pass has and however few values the last pass may bring."""
    monkeypatch.setattr(quantiles, "BINS", bins)
    monkeypatch.setattr(quantiles, "ROWS", rows)
    data = [(name, float(v)) for name, values in COLUMNS.items() for v in values]
    data += [("even", None), ("even", math.nan), (None, 3.0), ("empty", None), ("empty", math.nan)]
    df = spark.createDataFrame(data, "g string, v double").withColumn("w", -F.col("v"))
    got = {(r["g"], r["column"]): r for r in selected_quantiles(df, ["v", "w"], ASKED, ["g"]).collect()}
    assert got.keys() == {(g, c) for g in COLUMNS for c in "vw"}
    for name, values in COLUMNS.items():
        if name != "huge":  # numpy's own difference overflows
            assert found(got[(name, "v")]) == pytest.approx(expected(values), rel=1e-12, abs=1e-323)
        assert got[(name, "v")]["q0"] == min(values) and got[(name, "w")]["q0"] == -max(values)
    assert got[("huge", "v")]["q50"] == 5.0


def test_infinite_values_have_ranks(spark):
    df = spark.createDataFrame([(v,) for v in [-INF, -INF, 1.0, 2.0, 3.0, INF, INF]], "v double")
    row = selected_quantiles(df, ["v"], {"a": 0.0, "b": 0.5, "c": 1.0}).first()
    assert (row["a"], row["b"], row["c"]) == (-INF, 2.0, INF)


def test_without_rows_or_columns_with_values(spark):
    df = spark.createDataFrame([(None, 1.0)], "v double, w double")
    assert selected_quantiles(df.limit(0), ["v", "w"], ASKED).count() == 0
    assert [r["column"] for r in selected_quantiles(df, ["v", "w"], ASKED).collect()] == ["w"]


@pytest.mark.parametrize("name, value", [("SPANS", 4), ("PASSES", 1)])
def test_many_groups_and_slow_columns_go_by_running_sums(spark, monkeypatch, name, value):
    monkeypatch.setattr(quantiles, name, value)
    monkeypatch.setattr(quantiles, "ROWS", 1)
    rng = random.Random(6)
    data = [(i % 7, rng.choice([rng.random(), 0.5])) for i in range(700)]
    got = {r["g"]: r for r in selected_quantiles(spark.createDataFrame(data, "g int, v double"), ["v"], ASKED, ["g"]).collect()}
    for g in range(7):
        assert found(got[g]) == pytest.approx(expected([v for k, v in data if k == g]))


def test_a_pass_parts_the_ends_of_its_range(spark):
    """Every pass reads the rows of the open bins only, and none is lost between bins."""
    spans = [quantiles._Span((), "v", 0.0, 999.0, 0, 1000)]
    long = quantiles.long_values(spark.range(1000).select(F.col("id").cast("double").alias("v")), ["v"])
    bins = quantiles._parted(long, [], spans)
    assert sum(b.n for b in bins) == 1000 and [b.below for b in bins] == list(np.cumsum([0] + [b.n for b in bins[:-1]]))
    assert all(a.high < b.low for a, b in zip(bins, bins[1:]))
