"""Registered queries that train models. SQL can't know what a learner finds, so they return what must hold whatever it finds.

The learners get small settings here; the search and family defaults are in the operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.functions.scalars import any_of
from retentia.operators import explain, models
from retentia.operators.metrics import METRICS
from retentia.operators.tuning import FloatRange, IntRange, SearchPlan
from retentia.operators.value import ValueRule
from retentia.plans import bindings as b
from retentia.plans.customer360 import customer360_table
from retentia.plans.flows import Workspace, build_dataset, explained_top, monitor, promote, retrain_check, retrain_model, score_customers, select_model, train_model
from retentia.plans.queries import query
from retentia.session import scratch_path, written
from retentia.sources.artifacts import load_reference, load_split, save_params

SMALL_TREES = {"n_estimators": 5, "max_depth": 3}
FAMILIES = {
    "logistic_regression": {"max_iter": 50},
    "boosted_trees": SMALL_TREES,
    "boosted_trees_deep": {"n_estimators": 5, "max_depth": 4},
    "native_categories": SMALL_TREES,
}
SMALL_SEARCH = SearchPlan(
    trials=2,
    folds=2,
    space={"n_estimators": IntRange(2, 4), "max_depth": IntRange(2, 3), "learning_rate": FloatRange(0.05, 0.3, log=True)},
)


def _workspace(spark: SparkSession, folder: str) -> Workspace:
    ws = Workspace(
        scratch_path(spark, "workspace"),
        key=b.KEY,
        features=b.FEATURES,
        contract=b.CUSTOMER360_CONTRACT,
        high_cardinality=(),
        contract_column="contract",
        charge_column="monthly_charge",
    )
    build_dataset(customer360_table(spark, folder), ws)
    return ws


@query
def dataset_sides(spark, folder):
    """The written train and test sides, by class."""
    train, test = load_split(spark, _workspace(spark, folder).processed)
    both = train.select(F.lit("train").alias("side"), "*").unionByName(test.select(F.lit("test").alias("side"), "*"))
    return both.groupBy("side", "churn_label").agg(F.count("*").alias("n"), F.sum(b.KEY).alias("id_sum"))


def _between(c: str) -> Column:
    return F.col(c).between(0.0, 1.0)


@query
def model_selection(spark, folder):
    """Four families on one split, ranked by F1: the rows they were tested on, and whether the metrics fit together."""
    ws = _workspace(spark, folder)
    ranked, _ = select_model(spark, ws, FAMILIES)
    _, test = load_split(spark, ws.processed)
    sizes = test.agg(F.count("*").alias("n_test"), F.sum("churn_label").alias("n_positive")).first()
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    order = [r["family"] for r in ranked.collect()]  # a row per family
    by_f1 = [r["family"] for r in ranked.orderBy(F.desc("f1"), "family").collect()]
    return ranked.select(
        "family",
        F.lit(sizes["n_test"]).cast("bigint").alias("n_test"),
        F.lit(sizes["n_positive"]).cast("bigint").alias("n_positive"),
        any_of([~_between(m) for m in METRICS]).alias("out_of_range"),
        (F.abs(F.col("f1") - f1) < 1e-9).alias("f1_fits"),
        F.lit(order == by_f1).alias("ranked"),
    )


@query
def cv_search(spark, folder):
    """Random search with stratified folds: the drawn parameters, whether the mean F1 is one, and the version of the best."""
    trials, version = train_model(spark, _workspace(spark, folder), SMALL_SEARCH)
    drawn = F.from_json("params", "map<string,double>")
    return trials.select(
        "trial", *[F.round(drawn[name], 9).alias(name) for name in SMALL_SEARCH.space], _between("mean_f1").alias("f1_in_range"), F.lit(version).cast("bigint").alias("version")
    )


def _promoted(spark: SparkSession, folder: str) -> tuple[Workspace, DataFrame, DataFrame]:
    """A first version promoted without a comparison, then a second one compared with it."""
    ws = _workspace(spark, folder)
    save_params(spark, {"n_estimators": 1, "max_depth": 1}, ws.params)
    retrain_model(spark, ws)
    first = promote(spark, ws, b.PROMOTION)
    save_params(spark, SMALL_TREES, ws.params)
    retrain_model(spark, ws)
    return ws, first, promote(spark, ws, b.PROMOTION)


@query
def promotion_flow(spark, folder):
    """Two promotions: whether each verdict follows from its own margin and regressions, and where the alias points after both."""
    ws, first, second = _promoted(spark, folder)
    rows = first.withColumn("step", F.lit(1)).unionByName(second.withColumn("step", F.lit(2)))
    wins = F.col("aggregate_margin") >= b.PROMOTION.margin
    verdict = F.when(F.col("step") == 1, True).otherwise(wins & (F.size("regressions") == 0))
    reason = F.when(F.col("step") == 1, "bootstrap").when(~wins, "margin not reached").when(F.size("regressions") > 0, "segment regression").otherwise("wins")
    registry = ws.registry(spark)
    moved = F.lit(registry.champion(ws.model_name)) == F.when(second.select("promote").scalar(), 2).otherwise(1)
    return rows.select(
        "step",
        (F.col("promote") == verdict).alias("verdict_fits"),
        (F.col("reason") == reason).alias("reason_fits"),
        F.lit(registry.latest(ws.model_name)).cast("bigint").alias("latest"),
        moved.alias("alias_fits"),
    )


def _champion(spark: SparkSession, folder: str) -> Workspace:
    ws = _workspace(spark, folder)
    save_params(spark, SMALL_TREES, ws.params)
    retrain_model(spark, ws)
    promote(spark, ws, b.PROMOTION)
    return ws


@query
def score_batch(spark, folder):
    """All customers scored by the champion: the value at risk, and whether the class, the loss and the benefit follow from the probability."""
    ws = _champion(spark, folder)
    scored, _ = score_customers(spark, ws, customer360_table(spark, folder), ValueRule(campaign_cost=50_000.0))
    p = F.col("churn_probability")
    return scored.select(
        b.KEY,
        _between("churn_probability").alias("is_probability"),
        (F.col("churn_prediction") == (p >= 0.5).cast("int")).alias("class_fits"),
        "model_version",
        "remaining_months",
        "value_at_risk",
        (F.abs(F.col("expected_loss") - p * F.col("value_at_risk")) < 1e-6).alias("loss_fits"),
        ((F.abs(F.col("net_benefit") - F.col("expected_loss") + 50_000.0) < 1e-6) & (F.col("worth_retaining") == (F.col("net_benefit") > 0))).alias("benefit_fits"),
    )


def _explained(scored: DataFrame, top: DataFrame) -> DataFrame:
    """Per customer: the number of listed reasons, whether they fall in size, and whether base and contributions give the log-odds."""
    total = F.aggregate(F.map_values("contributions"), F.col("base_value"), lambda acc, v: acc + v)
    odds = F.log(F.col("churn_probability") / (1 - F.col("churn_probability")))
    sums = scored.select(b.KEY, (F.abs(total - odds) < 1e-6).alias("adds_up"))
    sizes = F.transform(F.array_sort(F.collect_list(F.struct("rank", F.abs("value").alias("size")))), lambda e: e["size"])
    listed = top.groupBy(b.KEY).agg(F.count("*").alias("n_reasons"), sizes.alias("sizes"))
    falling = F.col("sizes") == F.reverse(F.array_sort("sizes"))
    return sums.join(listed.select(b.KEY, "n_reasons", falling.alias("in_order")), b.KEY)


@query
def tree_explain(spark, folder):
    """The 15 largest contributions per customer, boosted trees."""
    ws = _champion(spark, folder)
    scored, _ = score_customers(spark, ws, customer360_table(spark, folder), explain=True)
    scored = written(scored.select(b.KEY, "contributions", "base_value", "churn_probability"), "explained")
    return _explained(scored, explained_top(scored, b.KEY, [*b.NUMERIC, *b.TEXT, *b.FEATURES.service_columns]))


@query
def linear_model_explain(spark, folder):
    """The 15 largest contributions per customer, logistic regression."""
    train, test = load_split(spark, _workspace(spark, folder).processed)
    model = models.fit_family("logistic_regression", train, "churn_label", {"max_iter": 50}, skip=[b.KEY], high_cardinality=())
    explained = models.score(model, explain.with_linear_explanation(model, train.unionByName(test), train))
    explained = written(explained.select(b.KEY, "contributions", "base_value", "churn_probability"), "explained")
    return _explained(explained, explain.top_attributions(explained.select(b.KEY, "contributions")))


@query
def monitoring_flow(spark, folder):
    """Drifted batches against the training side, then the retrain check on the written summary."""
    ws = _workspace(spark, folder)
    summary = monitor(spark, ws, b.BATCHES)
    verdict = retrain_check(spark, ws).select("should_retrain", "triggering_batch")
    out = summary.drop("run_id").join(F.broadcast(verdict), F.col("batch_name") == F.col("triggering_batch"), "left").drop("triggering_batch")
    return out.withColumn("dataset_drift_share", F.round("dataset_drift_share", 6))


@query
def reference_without_label(spark, folder):
    """The training side as the monitoring reads it, by region; its columns have no label."""
    ws = _workspace(spark, folder)
    reference = load_reference(spark, ws.processed, ws.features.target)
    return reference.groupBy("region").agg(F.count("*").alias("n"), F.sum("num_extra_services").cast("bigint").alias("n_services")).withColumn(
        "has_label", F.lit(ws.features.target in reference.columns)
    )
