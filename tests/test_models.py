import random

import numpy as np
import pytest
from helpers import customers, rows
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from retentia.operators import encoding, models, preprocess
from retentia.operators.contract import CUSTOMER_CONTRACT, coerce
from retentia.operators.explain import top_attributions, with_linear_explanation, with_tree_explanation
from retentia.operators.features import FeatureSpec
from retentia.operators.preprocess import ClassWeigher, TableEncoder, class_weights, encoded_features, imputed_and_scaled, onehot_long, positive_weight
from retentia.operators.tuning import FloatRange, IntRange, SearchPlan, best_trial, cv_search, draw_trials, search_range
from retentia.plans import flows
from retentia.plans.flows import Workspace
from retentia.operators.decisions import PromotionRule
from retentia.operators.sampling import BatchPlan, CategoricalReweight, NumericShift
from retentia.sources.artifacts import MissingArtifact, load_model, save_params

TREES = {"n_estimators": 3, "max_depth": 3}


def signal_frame(spark, n=160, seed=0):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        signal = rng.gauss(0, 1)
        plan = rng.choice(["Month", "Year"])
        data.append((i, signal if i % 11 else None, rng.random() * 100, plan, None if i % 5 == 0 else rng.choice("AB"), f"city {i % 20}", int(signal + (plan == "Month") * 0.5 > 0.2)))
    return spark.createDataFrame(data, "id bigint, signal double, charge double, plan string, offer string, City string, churn int")


def test_weights(spark):
    df = spark.range(100).select((F.col("id") >= 70).cast("int").alias("y"))
    assert {r["y"]: r["weight"] for r in class_weights(df, "y").collect()} == {0: pytest.approx(100 / 140), 1: pytest.approx(100 / 60)}
    assert positive_weight(df, "y") == pytest.approx(70 / 30)
    with pytest.raises(ValueError, match="no positive"):
        positive_weight(df.where("y = 0"), "y")
    weighed = ClassWeigher(labelCol="y", mode="positive").fit(df).transform(df)
    assert {(r["y"], round(r[preprocess.WEIGHT], 6)) for r in weighed.collect()} == {(0, 1.0), (1, round(70 / 30, 6))}


def test_encoder_imputes_encodes_and_drops(spark):
    df = spark.createDataFrame([(20.0, "a", "x"), (None, "b", "y"), (40.0, None, "z"), (31.0, "a", "w")], "Age double, Contract string, City string")
    model = TableEncoder(numericCols=["Age"], textCols=["Contract"]).fit(df)
    matrix = np.array([r[0] for r in model.transform(df).select(vector_to_array("features")).collect()])
    assert matrix.tolist() == [[20, 0, 1, 0], [31, 0, 0, 1], [40, 1, 0, 0], [31, 0, 1, 0]]
    assert [n for n, _, _ in encoded_features(model)] == ["numeric__Age", "categorical__Contract_Missing", "categorical__Contract_a", "categorical__Contract_b"]
    unseen = spark.createDataFrame([(1.0, "new")], "Age double, Contract string")
    assert model.transform(unseen).select(vector_to_array("features")).first()[0] == [1.0, 0.0, 0.0, 0.0]


def test_median_of_an_even_count_is_the_midpoint(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (7.0,), (None,)], "x double")
    assert preprocess.medians(df, ["x"]) == {"x": 3.0}


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    assert rows(imputed_and_scaled(df, ["x", "c"])) == [(-1.0, 0.0), (1.0, 0.0)]


def test_wide_text_columns_are_hashed_without_a_label(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("City"))
    model = TableEncoder(textCols=["City"], maxLevels=299, hashWidth=64).fit(df)
    matrix = np.array([r[0] for r in model.transform(df).select(vector_to_array("features")).collect()])
    assert matrix.shape == (300, 64) and (matrix.sum(axis=1) == 1).all() and len(encoded_features(model)) == 64
    listed = TableEncoder(textCols=["City"], maxLevels=300, hashWidth=64).fit(df)  # counted exactly
    assert len(encoded_features(listed)) == 300


def codes_by_hand(data, rule):
    """data: (level, label, fold). Codes of the training rows, and of any row that scores a level."""
    total, prior = len(data), rule.prior_rows
    inside = []
    for level, _, fold in data:
        rest = [(x, y) for x, y, f in data if f != fold]
        mean = sum(y for _, y in rest) / len(rest) if rest else 0.0
        own = [y for x, y in rest if x == level]
        inside.append((sum(own) + prior * mean) / (len(own) + prior))
    mean = sum(y for _, y, _ in data) / total
    scored = {level: (sum(y for x, y, _ in data if x == level) + prior * mean) / (sum(x == level for x, _, _ in data) + prior) for level in {x for x, _, _ in data}}
    return inside, scored, mean


def test_target_codes_by_hand(spark):
    rule = encoding.EncodingRule(folds=3, prior_rows=4.0)
    rng = random.Random(2)
    data = [(rng.choice(["a", "a", "a", "b", "c"]), rng.randint(0, 1), rng.randint(0, 2)) for _ in range(60)] + [("once", 1, 0)]
    df = spark.createDataFrame([(i, None if x == "c" else x, y, f) for i, (x, y, f) in enumerate(data)], "id int, x string, y int, f int")
    state = encoding.target_state(df, ["x"], "y", F.col("f"))
    inside, scored, mean = codes_by_hand([("Missing" if x == "c" else x, y, f) for x, y, f in data], rule)
    got = encoding.with_target_codes(df, state, ["x"], ["code"], rule, F.col("f")).orderBy("id").collect()
    assert [r["code"] for r in got] == pytest.approx(inside)
    asked = spark.createDataFrame([("a",), ("once",), (None,), ("new",)], "x string")
    codes = {r["x"]: r["code"] for r in encoding.with_target_codes(asked, state, ["x"], ["code"], rule).collect()}
    assert codes == {"a": pytest.approx(scored["a"]), "once": pytest.approx(scored["once"]), None: pytest.approx(scored["Missing"]), "new": pytest.approx(mean)}


@pytest.mark.parametrize("family", ["boosted_trees", "native_categories"])
def test_a_column_of_50_000_levels_trains_saves_and_scores(spark, tmp_path, family):
    """Two thirds of the rows have a level of their own, the rest share levels that tell the label."""
    hot = F.when(F.col("id") % 3 == 0, F.concat(F.lit("hot"), F.col("id") % 4)).otherwise(F.concat(F.lit("c"), F.col("id")))
    df = spark.range(75_000).select("id", hot.alias("City"), (F.col("id") % 7).cast("double").alias("x"), ((F.col("id") % 4) < 2).cast("int").alias("y"))
    model = models.fit_family(family, df, "y", {"n_estimators": 2, "max_depth": 2}, skip=["id"], high_cardinality=())
    models_path = str(tmp_path / "model")
    model.write().save(models_path)
    loaded = PipelineModel.load(models_path)
    asked = df.where("id % 3 = 0").limit(200).drop("y").unionByName(spark.createDataFrame([(-1, "unseen", 1.0), (-2, None, None)], "id bigint, City string, x double"))
    one, two = models.score(model, asked), models.score(loaded, asked)
    assert rows(one, "id", "churn_probability") == rows(two, "id", "churn_probability") and one.count() == 202
    known = {r["id"]: r["churn_prediction"] for r in two.where("id >= 0").collect()}
    assert all(known[i] == int(i % 4 < 2) for i in known)
    assert [n for n, c, _ in encoded_features(model.stages[0]) if c == "City"] == ["categorical__City"]


def test_names_with_quotes_are_encoded(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None)], "`an odd` double, `it's` string")
    model = TableEncoder(numericCols=["an odd"], textCols=["it's"]).fit(df)
    assert [r[0] for r in model.transform(df).select(vector_to_array("features")).collect()] == [[1.0, 0.0, 1.0], [1.0, 1.0, 0.0]]


def test_onehot_long(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, c string")
    assert rows(onehot_long(df, "id", ["c"])) == [(1, "categorical__c_a"), (2, "categorical__c_Missing")]


@pytest.mark.parametrize("family", list(models.DEFAULT_PARAMS))
def test_family_trains_and_scores_without_a_label(spark, family):
    df = signal_frame(spark)
    params = {"max_iter": 30} if family == "logistic_regression" else TREES
    model = models.fit_family(family, df, "churn", params, skip=["id"])
    scored = models.score(model, df.drop("churn"), 7)
    assert scored.columns == [*df.drop("churn").columns, "churn_probability", "churn_prediction", "model_version"]
    for r in scored.collect():
        assert 0 <= r["churn_probability"] <= 1 and r["churn_prediction"] == int(r["churn_probability"] >= 0.5) and r["model_version"] == "7"
    assert models.test_metrics(model, df, "churn").first()["roc_auc"] > 0.8


def test_city_is_left_out_unless_native(spark):
    df = signal_frame(spark)
    one_hot = models.fit_family("boosted_trees", df, "churn", TREES, skip=["id"])
    native = models.fit_family("native_categories", df, "churn", TREES, skip=["id"])
    assert not any(c == "City" for _, c, _ in encoded_features(one_hot.stages[-2]))
    assert "categorical__City" in [n for n, _, _ in encoded_features(native.stages[-2])]


def test_unknown_family_and_parameter(spark):
    df = signal_frame(spark, 20)
    with pytest.raises(ValueError, match="unknown model family"):
        models.family_pipeline("oracle", df, "churn")
    with pytest.raises(ValueError, match="unknown tree parameter"):
        models.tree_params({"num_leaves": 3})


def test_trials_stay_in_bounds_and_repeat(spark):
    plan = SearchPlan(trials=40, space={"n_estimators": IntRange(10, 50, 10), "learning_rate": FloatRange(0.05, 0.3, log=True)})
    drawn = [r["params"] for r in draw_trials(spark, plan).orderBy("trial").collect()]
    assert {p["n_estimators"] for p in drawn} == {10.0, 20.0, 30.0, 40.0, 50.0}
    assert all(0.05 <= p["learning_rate"] <= 0.3 for p in drawn)
    assert drawn == [r["params"] for r in draw_trials(spark, plan).orderBy("trial").collect()]
    with pytest.raises(ValueError, match="unknown parameter type"):
        search_range({"type": "choice"})
    assert search_range({"type": "float", "low": 0.1, "high": 1.0, "log": True}) == FloatRange(0.1, 1.0, True)


def test_search_returns_the_best_trial(spark):
    plan = SearchPlan(trials=2, folds=2, space={"n_estimators": IntRange(1, 3), "max_depth": IntRange(2, 3)})
    trials, best, model = cv_search(signal_frame(spark, 80), "churn", "id", plan)
    top = best_trial(trials).first()
    assert trials.count() == 2 and 0 <= top["mean_f1"] <= 1
    assert str(best["max_depth"]) in top["params"] and model.stages[-1].getNumTrees == int(best["n_estimators"])


def log_odds(p):
    return np.log(p / (1 - p))


@pytest.mark.parametrize("family", ["boosted_trees", "native_categories"])
def test_tree_contributions_add_up_to_the_log_odds(spark, family):
    df = signal_frame(spark)
    model = models.fit_family(family, df, "churn", TREES, skip=["id"])
    for r in models.score(model, with_tree_explanation(model, df)).collect():
        assert r["base_value"] + sum(r["contributions"].values()) == pytest.approx(log_odds(r["churn_probability"]), abs=1e-6)


def test_linear_contributions_add_up_to_the_log_odds(spark):
    df = signal_frame(spark)
    model = models.fit_family("logistic_regression", df, "churn", {"max_iter": 50}, skip=["id"])
    explained = with_linear_explanation(model, df, df)
    scored = models.score(model, df).select("id", "churn_probability")
    for r in explained.join(scored, "id").collect():
        assert r["base_value"] + sum(r["contributions"].values()) == pytest.approx(log_odds(r["churn_probability"]), abs=1e-6)
    assert top_attributions(explained.select("id", "contributions"), k=3).count() == 3 * df.count()


@pytest.fixture(scope="module")
def workspace(spark, tmp_path_factory):
    ws = Workspace(str(tmp_path_factory.mktemp("flow")))
    data = coerce(customers(spark, 150), CUSTOMER_CONTRACT)
    churned = F.when((F.col("Tenure in Months") < 25) | (F.col("Age") > 65), "Yes").otherwise("No")
    flows.build_dataset(data.withColumn("Churn Label", churned), ws)
    return ws


def test_flow_from_promotion_to_scores(spark, workspace):
    ws, rule = workspace, PromotionRule()
    registry = ws.registry(spark)
    with pytest.raises(LookupError):
        flows.promote(spark, ws, rule)
    save_params(spark, {"n_estimators": 1, "max_depth": 1, "learning_rate": 0.1}, ws.params)
    assert flows.retrain_model(spark, ws) == 1
    first = flows.promote(spark, ws, rule).first()
    assert (first["promote"], first["reason"], registry.champion(ws.model_name)) == (True, "bootstrap", 1)
    # A stronger model wins; comparing the champion with itself afterwards does not reach the margin.
    save_params(spark, {"n_estimators": 4, "max_depth": 4}, ws.params)
    assert flows.retrain_model(spark, ws) == 2
    better = flows.promote(spark, ws, PromotionRule(segment_tolerance=1.0)).first()
    assert (better["promote"], registry.champion(ws.model_name)) == (True, 2)
    assert load_model(registry.version_path(ws.model_name, 2)).stages[-1].getNumTrees == 4
    again = flows.promote(spark, ws, rule).first()
    assert (again["promote"], again["reason"], again["aggregate_margin"]) == (False, "margin not reached", 0.0)
    report = spark.read.option("header", True).csv(f"{ws.reports}/promotion")
    assert sorted(r["role"] for r in report.collect()) == ["challenger", "champion"]

    requests = customers(spark, 12).unionByName(customers(spark, 1, Age="old"))
    scored, rejected = flows.score_customers(spark, ws, requests, explain=True)
    assert scored.count() == 12 and {r["model_version"] for r in scored.collect()} == {"2"}
    assert [r["errors"] for r in rejected.collect()] == [["type:Age"]]
    top = flows.explained_top(scored, ws.key, CUSTOMER_CONTRACT.names)
    assert top.count() == 12 * 15 and not any("__" in r["feature"] for r in top.collect())


def test_missing_champion_files_are_an_error(spark, workspace, tmp_path):
    ws = Workspace(str(tmp_path))
    registry = ws.registry(spark)
    registry.register(ws.model_name, "r", str(tmp_path / "gone"))
    registry.promote(ws.model_name, 1)
    with pytest.raises(MissingArtifact, match="champion is registered"):
        flows.promote(spark, ws)


def test_selection_monitoring_and_retrain_check(spark, workspace):
    ranked, fitted = flows.select_model(spark, workspace, {"logistic_regression": {"max_iter": 20}, "boosted_trees": TREES})
    table = ranked.collect()
    assert [r["family"] for r in table] == [r["family"] for r in sorted(table, key=lambda r: (-r["f1"], r["family"]))] and set(fitted) == {"logistic_regression", "boosted_trees"}
    plan = BatchPlan(
        batch_size=60,
        intensities=(0.0, 1.0),
        specs={"Monthly Charge": NumericShift(50.0), "Tenure in Months": NumericShift(-20.0, clip_min=0), "Contract": CategoricalReweight({"Two Year": 1.0}), "Payment Method": CategoricalReweight({"Credit Card": 1.0}), "Age": NumericShift(40.0)},
    )
    summary = flows.monitor(spark, workspace, plan).collect()
    assert [r["batch_name"] for r in summary] == ["batch_intensity_0.00", "batch_intensity_1.00"]
    assert summary[1]["n_drifted_columns"] >= 5 and summary[0]["n_drifted_columns"] < summary[1]["n_drifted_columns"]
    verdict = flows.retrain_check(spark, workspace).first()
    assert verdict["should_retrain"] and verdict["triggering_batch"] == "batch_intensity_1.00"
    runs = workspace.registry(spark).runs()
    assert {"model-selection", "monitoring"} <= {r["experiment"] for r in runs.select("experiment").distinct().collect()}


def test_flow_features(workspace):
    assert FeatureSpec().target == "Churn Label" and workspace.key == "Customer ID"


def test_a_negative_depth_is_refused():
    with pytest.raises(ValueError, match="max_depth"):
        models.tree_params({"max_depth": -1})
