import math
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retentia.functions.scalars import direction, merge_maps, prefix_keys, remaining_months, zip_to_map
from retentia.operators import explain
from retentia.operators.explain import leaf_paths, readable_feature, top_attributions, tree_contributions
from retentia.operators.value import ValueRule, retention_portfolio, retention_targets, with_retention_value


def valued(spark, *data):
    df = spark.createDataFrame(data, "id int, contract string, tenure_in_months int, monthly_charge double, churn_probability double")
    return with_retention_value(df, ValueRule())


@pytest.mark.parametrize("term, tenure, want", [(1, 0, 1), (1, 47, 1), (12, 3, 9), (24, 5, 19), (12, 12, 12), (24, 24, 24), (12, 0, 12)])
def test_remaining_months(spark, term, tenure, want):
    df = spark.createDataFrame([(term, tenure)], "term int, tenure int")
    assert df.select(remaining_months(F.col("term"), F.col("tenure"))).first()[0] == want


def test_worth_retaining(spark):
    row = valued(spark, (1, "One Year", 3, 100.0, 0.5)).first()
    assert (row["remaining_months"], row["value_at_risk"], row["expected_loss"], row["net_benefit"], row["worth_retaining"]) == (9, 900.0, 450.0, 400.0, True)


def test_not_worth_retaining(spark):
    row = valued(spark, (1, "Month-to-Month", 10, 20.0, 0.1)).first()
    assert row["expected_loss"] == 2.0 and row["net_benefit"] == -48.0 and not row["worth_retaining"]


def test_break_even_is_not_worth_it(spark):
    assert valued(spark, (1, "Month-to-Month", 10, 100.0, 0.5)).first()["worth_retaining"] is False


def test_unknown_contract_or_missing_input_gives_nulls(spark):
    for row in valued(spark, (1, "Weekly", 3, 10.0, 0.5), (2, "One Year", None, 10.0, 0.5), (3, "One Year", 2, None, 0.5)).collect():
        assert row["value_at_risk"] is None and row["worth_retaining"] is None


def test_portfolio_and_targets(spark):
    df = valued(spark, (1, "One Year", 3, 100.0, 0.5), (2, "One Year", 3, 100.0, 0.9), (3, "Month-to-Month", 10, 20.0, 0.1), (4, "Weekly", 1, 1.0, 1.0))
    row = retention_portfolio(df).first()
    assert (row["n_customers"], row["n_worth"], row["value_at_risk"]) == (4, 2, 1820.0)
    assert [r["id"] for r in retention_targets(df, "id", 5).collect()] == [2, 1]


def test_map_helpers(spark):
    one = spark.range(1)
    left, right = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(3))
    assert one.select(merge_maps(left, right)).first()[0] == {"a": 1, "b": 3}
    assert one.select(prefix_keys(right, "challenger_")).first()[0] == {"challenger_b": 3}
    with pytest.raises(Exception):
        spark.createDataFrame([(["a"], [1.0, 2.0])], "n array<string>, v array<double>").select(zip_to_map(F.col("n"), F.col("v"))).collect()


@pytest.mark.parametrize(
    "name, want",
    [
        ("numeric__Age", "Age"),
        ("categorical__Streaming Music_Yes", "Streaming Music: Yes"),
        ("categorical__Streaming_Yes", "Streaming: Yes"),
        ("categorical__City", "City"),
        ("categorical__Other_x", "Other_x"),
        ("plain", "plain"),
        ("other__a__b", "a__b"),
    ],
)
def test_readable_feature(spark, name, want):
    df = spark.createDataFrame([(name,)], "f string")
    assert df.select(readable_feature(F.col("f"), ["City", "Streaming", "Streaming Music"])).first()[0] == want


def test_top_attributions_rank_by_size(spark):
    df = spark.createDataFrame([(1, {"a": 0.1, "b": -2.0, "c": 0.0, "d": 1.5})], "id int, contributions map<string,double>")
    got = [(r["rank"], r["feature"], r["direction"]) for r in top_attributions(df, k=3).collect()]
    assert got == [(1, "b", "lowers risk"), (2, "d", "raises risk"), (3, "a", "raises risk")]
    assert spark.range(1).select(direction(F.lit(0.0))).first()[0] == "lowers risk"


def tree(spark=None):
    """Two trees over three features; a feature repeats on a path and one split is categorical."""
    columns = ["treeID", "id", "prediction", "rawCount", "leftChild", "rightChild", "feature", "left", "categories"]
    rows = [
        (0, 0, 0.0, 100, 1, 4, 0, [0.5], -1),
        (0, 1, 0.0, 60, 2, 3, 1, [0.0, 2.0], 3),
        (0, 2, 1.0, 20, -1, -1, -1, [], -1),
        (0, 3, -2.0, 40, -1, -1, -1, [], -1),
        (0, 4, 0.0, 40, 5, 6, 0, [0.8], -1),
        (0, 5, 3.0, 10, -1, -1, -1, [], -1),
        (0, 6, 0.5, 30, -1, -1, -1, [], -1),
        (1, 0, 0.0, 100, 1, 2, 2, [1.0], -1),
        (1, 1, 4.0, 70, -1, -1, -1, [], -1),
        (1, 2, -1.0, 30, -1, -1, -1, [], -1),
    ]
    return pd.DataFrame(rows, columns=columns)


def expected_value(nodes, weights, x, known):
    """Prediction with unknown features averaged by row shares."""
    total = 0.0
    for t, rows in nodes.groupby("treeID"):
        by_id = {r.id: r for r in rows.itertuples()}

        def walk(i):
            n = by_id[i]
            if n.leftChild < 0:
                return n.prediction
            if n.feature in known:
                goes_left = x[n.feature] <= n.left[0] if n.categories < 0 else x[n.feature] in n.left
                return walk(n.leftChild if goes_left else n.rightChild)
            left, right = by_id[n.leftChild], by_id[n.rightChild]
            return (left.rawCount * walk(n.leftChild) + right.rawCount * walk(n.rightChild)) / n.rawCount

        total += weights[t] * walk(0)
    return 2.0 * total


def test_leaves_with_and_without_tables_agree(monkeypatch):
    rng = np.random.default_rng(4)
    leaves = []
    for _ in range(30):
        features = rng.choice(9, size=rng.integers(1, 8), replace=False)
        path = [(int(f), float(rng.uniform(0.1, 0.9)), [(bool(rng.integers(2)), np.array([rng.uniform()]), -1) for _ in range(rng.integers(1, 3))]) for f in features]
        leaves.append((float(rng.normal()), path))
    x = rng.uniform(size=(300, 9))
    by_table = tree_contributions(x, leaves)
    monkeypatch.setattr(explain, "TABLE_FEATURES", 3)
    monkeypatch.setattr(explain, "BLOCK_ROWS", 64)
    assert np.allclose(by_table, tree_contributions(x, leaves), atol=1e-12)
    assert tree_contributions(x[:0], leaves).shape == (0, 9)


def test_tree_contributions_against_all_coalitions():
    nodes, weights = tree(), {0: 1.0, 1: 0.1}
    leaves = leaf_paths(nodes, weights)
    x = np.array([[0.3, 2.0, 0.0], [0.6, 1.0, 5.0], [0.9, 0.0, 1.0], [0.5, 1.0, 1.5]])
    got = tree_contributions(x, leaves)
    for row, values in zip(x, got):
        for i in range(3):
            others, want = [f for f in range(3) if f != i], 0.0
            for size in range(3):
                for s in combinations(others, size):
                    w = math.factorial(size) * math.factorial(2 - size) / math.factorial(3)
                    want += w * (expected_value(nodes, weights, row, {*s, i}) - expected_value(nodes, weights, row, set(s)))
            assert values[i] == pytest.approx(want)
        base = sum(v * math.prod(z for _, z, _ in path) for v, path in leaves)
        assert base + values.sum() == pytest.approx(expected_value(nodes, weights, row, {0, 1, 2}))
