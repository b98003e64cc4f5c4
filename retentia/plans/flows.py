"""The end-to-end flows: build the dataset, train, monitor, decide, promote, score.

Each flow reads tables or files, writes tables or files, and returns small result frames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.operators.contract import CUSTOMER_CONTRACT, Contract, quarantine, with_original_names
from retentia.operators.decisions import PromotionRule, RetrainRule, best_model, promotion_decision, rank_models, retrain_decision
from retentia.operators.drift import DriftRule, drift_summary, sweep_drift
from retentia.operators.explain import readable_feature, top_attributions, with_tree_explanation
from retentia.operators.features import FeatureSpec, add_features, build_feature_table, scoring_contract
from retentia.operators.metrics import METRICS, OVERALL, evaluate
from retentia.operators.models import compare_families, fit_family, score
from retentia.operators.registry import Registry
from retentia.operators.sampling import BatchPlan, drift_sweep, stratified_split
from retentia.operators.tuning import SearchPlan, cv_search
from retentia.operators.value import ValueRule, with_retention_value
from retentia.session import written
from retentia.sources.artifacts import (
    MissingArtifact,
    load_model,
    load_params,
    load_reference,
    load_report,
    load_split,
    path_exists,
    save_drift_detail,
    save_model,
    save_params,
    save_report,
    save_split,
)
from retentia.sources.customers import load_customers

DRIFT_REPORT_SCHEMA = "batch_name string, intensity double, run_id string, n_drifted_columns bigint, dataset_drift_share double"


@dataclass(frozen=True)
class Workspace:
    """Where the flows keep their files, below one folder that all executors share."""

    root: str
    model_name: str = "customer-churn"
    key: str = "Customer ID"
    features: FeatureSpec = field(default_factory=FeatureSpec)
    contract: Contract = CUSTOMER_CONTRACT
    high_cardinality: tuple[str, ...] = ("City",)
    contract_column: str = "Contract"
    charge_column: str = "Monthly Charge"

    @property
    def processed(self) -> str:
        return f"{self.root}/processed"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"

    @property
    def params(self) -> str:
        return f"{self.root}/models/best_params"

    def registry(self, spark: SparkSession) -> Registry:
        return Registry(spark, f"{self.root}/registry")


def build_dataset(customers: DataFrame, ws: Workspace, test_size: float = 0.2, seed: int = 42) -> None:
    """Feature table, exact stratified split, one parquet dataset with both sides. The key stays for later splits."""
    table = build_feature_table(customers, ws.features, keep=[ws.key])
    save_split(stratified_split(table, ws.features.target, ws.key, test_size, seed), ws.processed)


def build_dataset_from_csv(spark: SparkSession, path: str, ws: Workspace, contract: Contract = CUSTOMER_CONTRACT) -> None:
    build_dataset(load_customers(spark, path, contract), ws)


def _metrics_row(frame: DataFrame) -> dict[str, float]:
    row = frame.select(*METRICS).first()
    return {m: row[m] for m in METRICS}


def select_model(
    spark: SparkSession, ws: Workspace, families: Mapping[str, Mapping[str, object] | None], metric: str = "f1"
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Train every family on the same split, log a run each, write the ranked comparison."""
    train, test = load_split(spark, ws.processed)
    results, models = compare_families(
        train, test, ws.features.target, families, skip=[ws.key], high_cardinality=ws.high_cardinality
    )
    registry = ws.registry(spark)
    rows = []
    for r in results.collect():
        metrics = {m: r[m] for m in METRICS}
        run_id = registry.log_run("model-selection", r["family"], families[r["family"]] or {}, metrics)
        rows.append((r["family"], run_id, *[metrics[m] for m in METRICS]))
    schema = "family string, run_id string, " + ", ".join(f"{m} double" for m in METRICS)
    table = spark.createDataFrame(rows, schema)
    save_report(rank_models(table, metric), f"{ws.reports}/model_selection", [F.desc(metric), "family"])
    winner = best_model(table, metric).first()
    registry.log_run("model-selection", "summary", {"winner": winner["family"]}, {f"best_{metric}": winner[metric]})
    return rank_models(table, metric), models


def _register(spark: SparkSession, ws: Workspace, model: PipelineModel, params: Mapping[str, object], test: DataFrame, run: str) -> int:
    label = ws.features.target
    scored = score(model, test)
    metrics = _metrics_row(evaluate(scored, [], label, "churn_prediction", "churn_probability"))
    registry = ws.registry(spark)
    run_id = registry.log_run("training", run, params, metrics)
    path = f"{ws.root}/models/{run_id}"
    save_model(model, path)
    return registry.register(ws.model_name, run_id, path)


def train_model(spark: SparkSession, ws: Workspace, plan: SearchPlan = SearchPlan(), family: str = "boosted_trees_deep") -> tuple[DataFrame, int]:
    """Search, refit, test once, register: returns the trials and the new version."""
    train, test = load_split(spark, ws.processed)
    trials, best, model = cv_search(train, ws.features.target, ws.key, plan, family=family, high_cardinality=ws.high_cardinality)
    save_params(spark, best, ws.params)
    return trials, _register(spark, ws, model, best, test, "search")


def retrain_model(spark: SparkSession, ws: Workspace, fixed: Mapping[str, object] | None = None, family: str = "boosted_trees_deep") -> int:
    """Refit with the stored parameters, without a search."""
    params = load_params(spark, ws.params, fixed)
    train, test = load_split(spark, ws.processed)
    model = fit_family(family, train, ws.features.target, params, skip=[ws.key], high_cardinality=ws.high_cardinality)
    return _register(spark, ws, model, params, test, "retrain")


def monitor(spark: SparkSession, ws: Workspace, plan: BatchPlan = BatchPlan(), rule: DriftRule = DriftRule()) -> DataFrame:
    """Drifted batches against the training rows: detail and summary reports, one run per batch."""
    reference = load_reference(spark, ws.processed, ws.features.target)
    batches = drift_sweep(reference, ws.key, plan, ws.features.target)
    names = {f"batch_intensity_{i:.2f}": i for i in plan.intensities}
    detail = sweep_drift(reference, batches, list(names), rule, skip=[ws.key]).persist()
    try:
        save_drift_detail(detail, f"{ws.reports}/drift_detail")
        registry = ws.registry(spark)
        rows = []
        for r in drift_summary(detail, rule).collect():  # one row per batch of the plan
            name, metrics = r["batch_name"], {"n_drifted_columns": r["n_drifted_columns"], "dataset_drift_share": r["dataset_drift_share"]}
            params = {"batch_name": name, "intensity": names[name], "drift_share_threshold": rule.drift_share}
            run_id = registry.log_run("monitoring", name, params, metrics)
            rows.append((name, float(names[name]), run_id, r["n_drifted_columns"], r["dataset_drift_share"]))
    finally:
        detail.unpersist()
    table = spark.createDataFrame(rows, DRIFT_REPORT_SCHEMA).orderBy("intensity")
    save_report(table, f"{ws.reports}/drift_summary", ["intensity"])
    registry.log_run("monitoring", "summary", {"batches": len(rows)}, {})
    return table


def retrain_check(spark: SparkSession, ws: Workspace, rule: RetrainRule = RetrainRule()) -> DataFrame:
    """Decide from the written drift summary; it informs and starts nothing."""
    summary = load_report(spark, f"{ws.reports}/drift_summary", DRIFT_REPORT_SCHEMA, "the drift monitoring")
    return retrain_decision(summary, rule)


def promote(spark: SparkSession, ws: Workspace, rule: PromotionRule = PromotionRule()) -> DataFrame:
    """Compare the newest version with the champion on the test rows and move the alias if it wins.

    Without a champion the newest version is promoted without a comparison. A version's files never
    change, so moving the alias is all a promotion does.
    """
    registry = ws.registry(spark)
    challenger, champion = registry.latest(ws.model_name), registry.champion(ws.model_name)
    if challenger is None:
        raise LookupError(f"{ws.model_name} has no registered version")
    champion_path = registry.version_path(ws.model_name, champion) if champion is not None else None
    if champion_path and not path_exists(spark, champion_path):
        raise MissingArtifact(f"a champion is registered but {champion_path} does not exist")
    _, test = load_split(spark, ws.processed)
    label = ws.features.target
    segments = list(rule.segment_columns)

    def measured(path: str) -> DataFrame:
        return evaluate(score(load_model(path), test), segments, label, "churn_prediction", "churn_probability")

    def role(frame: DataFrame, name: str, version: int) -> DataFrame:
        overall = frame.where(F.col("segment_column") == OVERALL)
        return overall.select(F.lit(name).alias("role"), F.lit(version).cast("bigint").alias("version"), *METRICS)

    new = written(measured(registry.version_path(ws.model_name, challenger)), "challenger-metrics")
    roles = role(new, "challenger", challenger)
    metrics = {f"challenger_{k}": v for k, v in _metrics_row(roles).items()}
    if champion is None:
        decision = spark.createDataFrame(
            [(True, "bootstrap", None, [], {})],
            "promote boolean, reason string, aggregate_margin double, regressions array<string>, regression_deltas map<string,double>",
        )
    else:
        old = written(measured(champion_path), "champion-metrics")
        decision = promotion_decision(old, new, rule)
        roles = roles.unionByName(role(old, "champion", champion))
        metrics |= {f"champion_{k}": v for k, v in _metrics_row(role(old, "champion", champion)).items()}
    verdict = decision.first()
    metrics["aggregate_margin"] = verdict["aggregate_margin"]
    params = {"challenger_version": challenger, "bootstrap": champion is None, "promote": verdict["promote"], "reason": verdict["reason"]}
    registry.log_run("promotion", "promotion-decision", params, metrics)
    save_report(roles, f"{ws.reports}/promotion", ["role"])
    if verdict["promote"]:
        registry.promote(ws.model_name, challenger)
    return spark.createDataFrame([verdict], decision.schema)


def score_customers(
    spark: SparkSession, ws: Workspace, customers: DataFrame, value: ValueRule = ValueRule(), *, explain: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(scored customers with money value, rejected rows with their errors) from the champion.

    Rows may use either spelling of the column names and need a key column; a row that breaks the
    request contract is rejected with its reasons while the others are scored.
    """
    contract = scoring_contract(ws.features, ws.contract)
    registry = ws.registry(spark)
    version = registry.champion(ws.model_name)
    if version is None:
        raise LookupError(f"{ws.model_name} has no champion")
    named = with_original_names(customers, contract)
    keyed = Contract((*contract.fields, *ws.contract.subset([ws.key]).fields))
    # Fields that may be null may also be left out of a request.
    optional = {f.name: F.lit(None).cast("string") for f in keyed.fields if f.nullable and f.name not in named.columns}
    clean, rejected = quarantine(named.withColumns(optional).select(*keyed.names), keyed)
    prepared = add_features(clean, ws.features)
    model = load_model(registry.version_path(ws.model_name, version))
    if explain:
        prepared = with_tree_explanation(model, prepared)
    scored = with_retention_value(
        score(model, prepared, version), value, ws.contract_column, ws.features.tenure_column, ws.charge_column, "churn_probability"
    )
    return scored, rejected


def explained_top(scored: DataFrame, key: str, known_columns: Sequence[str], k: int = 15) -> DataFrame:
    """(key, rank, feature, value, direction) with readable feature names."""
    top = top_attributions(scored.select(key, "contributions"), "contributions", k)
    return top.withColumn("feature", readable_feature(F.col("feature"), known_columns))
