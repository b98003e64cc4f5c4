"""The registered queries: every operator applied to the test tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.functions.scalars import batch_name, merge_maps, prefix_keys, segment_label, yes_flag
from retentia.operators import consistency, contract, decisions, drift, drift_many, encoding, explain, features, metrics, preprocess, profile, registry, sampling, value
from retentia.operators.metrics import OVERALL
from retentia.plans import bindings as b
from retentia.plans.customer360 import SERVICES, baseline_scores, customer360, customer360_table
from retentia.session import scratch_path, written
from retentia.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), n) for c, n in digits.items()})


def r6(df: DataFrame, *columns: str) -> DataFrame:
    return rounded(df, **dict.fromkeys(columns, 6))


def _c360(spark: SparkSession, folder: str) -> DataFrame:
    return baseline_scores(customer360_table(spark, folder))


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return features.build_feature_table(customer360_table(spark, folder), b.FEATURES, keep=[b.KEY, "recency_days"])


def _eras(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders before and from 1998: reference and current."""
    orders = table(spark, folder, "orders")
    cut = F.expr("TIMESTAMP_NTZ '1998-01-01 00:00:00'")
    return orders.where(F.col("o_orderdate") < cut), orders.where(F.col("o_orderdate") >= cut)


def _joined(c: Column | str) -> Column:
    return F.concat_ws(",", c)


# ---- source table -----------------------------------------------------------------------------------


@query
def customer_base(spark, folder):
    return customer360(spark, folder)


# ---- contracts --------------------------------------------------------------------------------------


@query
def contract_violations(spark, folder):
    orders = table(spark, folder, "orders").select(*b.ORDERS_CONTRACT.names)
    contract.check_columns(orders, b.ORDERS_CONTRACT)
    return contract.violations(orders, b.ORDERS_CONTRACT)


@query
def contract_quarantine(spark, folder):
    _, broken = contract.quarantine(table(spark, folder, "customer"), b.CUSTOMER_CONTRACT)
    return broken.select("c_custkey", _joined("errors").alias("errors"))


@query
def contract_clean_rows(spark, folder):
    clean, _ = contract.quarantine(table(spark, folder, "customer"), b.CUSTOMER_CONTRACT)
    return clean


@query
def contract_coercion(spark, folder):
    """Text columns declared as numbers: which values don't fit."""
    part = table(spark, folder, "part")
    text = part.select(F.col("p_size").cast("string").alias("p_size"), F.substring_index("p_brand", "#", -1).alias("p_brand"), F.col("p_type").alias("p_type"))
    declared = contract.Contract(tuple(contract.Field(n, "bigint", low=5) for n in ("p_size", "p_brand", "p_type")))
    return contract.violations(text, declared)


@query
def coerce_fractions(spark, folder):
    """Numbers as text declared as whole: a zero fraction fits, any other fraction is a violation, however small."""
    lines = table(spark, folder, "lineitem")
    text = lines.select(
        F.concat(F.col("l_linenumber"), F.lit(".000")).alias("zero"),
        F.concat(F.col("l_linenumber"), F.lit(".00000000000"), F.col("l_suppkey") % 3).alias("tiny"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.concat(F.col("l_quantity").cast("bigint"), F.lit("5e-1")).alias("exponent"),
    )
    return contract.violations(text, contract.Contract(tuple(contract.Field(n, "bigint", low=2) for n in text.columns)))


@query
def contract_duplicate_keys(spark, folder):
    return contract.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def scoring_request_errors(spark, folder):
    """Per-row error lists of scoring requests."""
    named = contract.with_request_names(_c360(spark, folder), b.SCORING_CONTRACT)
    checked = contract.with_errors(named, b.SCORING_CONTRACT)
    return checked.select("customer_id", F.size("errors").alias("n_errors"), _joined("errors").alias("errors"))


@query
def unknown_values(spark, folder):
    """Customers that no order names, in rows per customer."""
    return contract.unknown_values(table(spark, folder, "customer"), "c_custkey", table(spark, folder, "orders"), "o_custkey")


@query
def known_values(spark, folder):
    return contract.known_values(table(spark, folder, "part"), "p_brand")


# ---- profiling --------------------------------------------------------------------------------------


@query
def profile_shape(spark, folder):
    return profile.shape(table(spark, folder, "lineitem"))


@query
def profile_missing(spark, folder):
    return r6(profile.missing_values(_c360(spark, folder)), "pct_missing")


@query
def profile_nunique(spark, folder):
    return profile.distinct_counts(table(spark, folder, "orders"))


@query
def profile_constant(spark, folder):
    """Every column of the orders, and two that are constant."""
    return profile.constant_columns(table(spark, folder, "orders").withColumns({"quarter": F.lit("Q3"), "country": F.lit("US")}))


@query
def profile_duplicates(spark, folder):
    return profile.duplicate_rows(table(spark, folder, "documents"), ["text", "lang", "source"])


@query
def profile_duplicate_keys(spark, folder):
    return profile.duplicate_key_rows(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def profile_describe(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    out = profile.describe(lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return rounded(out, mean=4, std=4, min=4, q25=4, q50=4, q75=4, max=4)


@query
def median_by_class(spark, folder):
    return rounded(profile.medians_by(_c360(spark, folder), "churn", list(b.NUMERIC)), median=4)


@query
def profile_histogram(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    return r6(profile.histogram(lineitem, ["l_quantity", "l_extendedprice"], 30), "lower", "upper").drop("density")


@query
def histogram_by_class(spark, folder):
    out = profile.histogram(_c360(spark, folder), ["tenure_in_months", "monthly_charge"], 40, ["churn"])
    return rounded(out, lower=4, upper=4, density=8)


@query
def profile_corr(spark, folder):
    return r6(profile.correlations(_c360(spark, folder), list(b.NUMERIC)), "r")


@query
def value_counts(spark, folder):
    return r6(profile.value_counts(_c360(spark, folder), "internet_type"), "share")


@query
def value_counts_many(spark, folder):
    return profile.multi_value_counts(_c360(spark, folder), list(b.TEXT))


@query
def class_balance(spark, folder):
    return r6(profile.class_balance(_c360(spark, folder)), "pct_pos", "neg_per_pos")


@query
def churn_rate_by_category(spark, folder):
    return r6(profile.churn_rates(_c360(spark, folder), "internet_type"), "churn_rate")


@query
def churn_rate_ordinal(spark, folder):
    rates = profile.churn_rates(_c360(spark, folder), "contract")
    return r6(profile.in_order(rates, ["Month-to-Month", "One Year", "Two Year", "Three Year"]), "churn_rate")


@query
def service_churn(spark, folder):
    return r6(profile.service_churn(_c360(spark, folder), list(SERVICES)), "churn_rate")


@query
def top_reasons(spark, folder):
    errors = table(spark, folder, "events").where(F.col("event_type") == "error")
    return profile.top_values(errors, "props", 10)


@query
def value_domains(spark, folder):
    return r6(profile.value_domains(_c360(spark, folder), list(b.NUMERIC)), "low", "high")


@query
def out_of_domain(spark, folder):
    reference, current = _eras(spark, folder)
    columns = ["o_totalprice", "o_custkey"]
    return profile.out_of_domain(current, columns, profile.value_domains(reference, columns))


@query
def preview_head(spark, folder):
    return profile.first_rows(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 5)


@query
def preview_tail(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return profile.first_rows(orders, ["o_totalprice", "o_orderkey"], 5, last=True)


# ---- features and consistency -----------------------------------------------------------------------


@query
def feature_table(spark, folder):
    return _features(spark, folder).drop("recency_days")


@query
def fill_missing_levels(spark, folder):
    filled = features.fill_text(_c360(spark, folder), ["internet_type", "svc_economy"])
    return filled.groupBy("internet_type", "svc_economy").agg(F.count("*").alias("n"))


@query
def consistency_repair(spark, folder):
    fixed = consistency.repair(_c360(spark, folder), b.CONSISTENCY)
    return fixed.select("customer_id", "internet_type", *SERVICES, "n_orders", "monthly_charge")


@query
def inconsistent_rows(spark, folder):
    c = _c360(spark, folder)
    return c.where(consistency.inconsistent(c, b.CONSISTENCY)).select("customer_id")


@query
def determined_fields(spark, folder):
    out = consistency.determined_fields(_c360(spark, folder), b.CONSISTENCY)
    return out.select("customer_id", _joined("determined").alias("determined"))


@query
def sentinel_to_null(spark, folder):
    marked = _c360(spark, folder).select("customer_id", F.coalesce("internet_type", F.lit(consistency.NO_VALUE)).alias("internet_type"))
    cleared = consistency.clear_sentinel(marked)
    return cleared.groupBy("internet_type").agg(F.count("*").alias("n"))


# ---- sampling and drifted batches -------------------------------------------------------------------


@query
def stratified_split(spark, folder):
    return sampling.stratified_split(_c360(spark, folder), "churn", b.KEY).select(b.KEY, "churn", "is_test")


@query
def stratified_folds(spark, folder):
    return sampling.stratified_folds(_c360(spark, folder), "churn", b.KEY).select(b.KEY, "churn", "fold")


@query
def split_events(spark, folder):
    """The split at event scale, five classes; only sizes are reported."""
    flagged = sampling.stratified_split(table(spark, folder, "events").select("event_id", "event_type"), "event_type", "event_id")
    return flagged.groupBy("event_type", "is_test").agg(F.count("*").alias("n"), F.sum("event_id").alias("id_sum"))


@query
def bootstrap_batch(spark, folder):
    return sampling.bootstrap(_c360(spark, folder).select(b.KEY), b.KEY, 500)


@query
def bootstrap_lineitem_orders(spark, folder):
    """As many lines as there are orders, drawn by order key: how often orders are drawn."""
    n = table(spark, folder, "orders").count()
    drawn = sampling.bootstrap(table(spark, folder, "lineitem").select("l_orderkey"), "l_orderkey", n, seed=7)
    return drawn.groupBy("l_orderkey").agg(F.count("*").alias("times")).groupBy("times").agg(F.count("*").alias("n_orders"))


@query
def bootstrap_repeated_keys(spark, folder):
    """Whole lines drawn by a key that several of them share. A drawn line is one of its order's; ``known`` counts its equals among them."""
    lines = table(spark, folder, "lineitem")
    drawn = sampling.bootstrap(lines, "l_orderkey", 2000, seed=11)
    equals = lines.groupBy(*lines.columns).agg(F.count("*").alias("n"))
    found = drawn.join(equals, [F.equal_null(drawn[c], equals[c]) for c in lines.columns], "left")
    return found.select("draw", drawn["l_orderkey"], (F.col("n") > 0).cast("int").alias("known"))


@query
def numeric_shift(spark, folder):
    c = _c360(spark, folder).select(b.KEY, "monthly_charge", "tenure_in_months")
    specs = {"monthly_charge": sampling.NumericShift(1500.0, std_shift=0.4), "tenure_in_months": sampling.NumericShift(-60.0, clip_min=0)}
    return rounded(sampling.apply_drift(c, specs, 0.75, row=b.KEY), monthly_charge=4, tenure_in_months=6)


@query
def categorical_reweight(spark, folder):
    c = _c360(spark, folder).select(b.KEY, "contract", "internet_type")
    specs = {
        "contract": b.BATCHES.specs["contract"],
        "internet_type": sampling.CategoricalReweight({"DSL": 0.5, "Satellite": 0.5}),
    }
    return sampling.apply_drift(c, specs, 0.5, row=b.KEY)


@query
def reweight_many_levels(spark, folder):
    """Half way from the customers that orders have to a target of three, one of them new: one level per customer."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    spec = sampling.CategoricalReweight({"7": 0.25, "100": 0.5, "99999999": 0.25})
    return sampling.apply_drift(orders, {"o_custkey": spec}, 0.5, row="o_orderkey")


def _sweep(spark, folder):
    reference = _features(spark, folder).select(b.KEY, *b.NUMERIC, *b.TEXT)
    return reference, sampling.drift_sweep(reference, b.KEY, b.BATCHES, "churn_label")


@query
def drift_sweep(spark, folder):
    _, batches = _sweep(spark, folder)
    out = batches.select("batch_name", "intensity", "draw", b.KEY, "contract", "payment_method", "tenure_in_months", "monthly_charge")
    return rounded(out, tenure_in_months=6, monthly_charge=4)


# ---- encoding and search ----------------------------------------------------------------------------


@query
def target_codes(spark, folder):
    """Two text columns of the orders as codes, one of them with a level per customer: as training rows, and as rows to be scored."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer"), "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("y")
    )
    rule, columns = encoding.EncodingRule(), ["customer", "o_orderpriority"]
    fold = encoding.row_fold(["o_orderkey"], rule)
    state = written(encoding.target_state(orders, columns, "y", fold), "codes")
    trained = encoding.with_target_codes(orders, state, columns, ["customer_code", "priority_code"], rule, fold)
    both = encoding.with_target_codes(trained, state, columns, ["customer_score", "priority_score"], rule)
    return rounded(both.select("o_orderkey", "customer_code", "priority_code", "customer_score", "priority_score"), customer_code=9, priority_code=9, customer_score=9, priority_score=9)


@query
def level_counts(spark, folder):
    """Exact number of levels per text column."""
    documents = table(spark, folder, "documents")
    found = preprocess.level_counts(documents, ["lang", "source", "text"])
    return spark.createDataFrame(sorted(found.items()), "column string, n bigint")


# ---- drift ------------------------------------------------------------------------------------------


def _era_stats(spark, folder, numeric, text):
    reference, current = _eras(spark, folder)
    counts = drift.value_counts(reference, current, F.lit("b0"), {"b0": "b0"}, numeric, text)
    if numeric:
        return drift.numeric_distances(drift.numeric_counts(counts), ["b0"])
    return drift.level_distances(drift.text_counts(counts), ["b0"])


@query
def drift_wasserstein(spark, folder):
    reference, current = _eras(spark, folder)
    counts = drift.numeric_counts(drift.value_counts(reference, current, F.lit("b0"), {"b0": "b0"}, ["o_totalprice", "o_custkey"], []))
    joined = drift.numeric_distances(counts, ["b0"]).join(F.broadcast(drift.reference_spread(counts)), "column")
    return r6(joined.select("column", "n_ref", "n_cur", (F.col("wasserstein") / F.col("std")).alias("score")), "score")


@query
def drift_ks(spark, folder):
    return r6(_era_stats(spark, folder, ["o_totalprice", "o_custkey"], []).select("column", "ks"), "ks")


@query
def drift_jensen_shannon(spark, folder):
    out = _era_stats(spark, folder, [], ["o_orderpriority", "o_orderstatus"])
    return r6(out.select("column", "n_levels", "jensen_shannon"), "jensen_shannon")


@query
def drift_chi2(spark, folder):
    return r6(_era_stats(spark, folder, [], ["o_orderpriority", "o_orderstatus"]).select("column", "n_ref_values", "chi2"), "chi2")


@query
def drift_z(spark, folder):
    lineitem = table(spark, folder, "lineitem").select("l_shipdate", "l_linestatus")
    cut = F.expr("TIMESTAMP_NTZ '1998-01-01 00:00:00'")
    counts = drift.value_counts(
        lineitem.where(F.col("l_shipdate") < cut), lineitem.where(F.col("l_shipdate") >= cut), F.lit("b0"), {"b0": "b0"}, [], ["l_linestatus"]
    )
    return r6(drift.level_distances(drift.text_counts(counts), ["b0"]).select("column", "z"), "z")


@query
def drift_columns(spark, folder):
    """Test choice and verdict for every column of the orders eras."""
    reference, current = _eras(spark, folder)
    columns = ["o_totalprice", "o_custkey", "o_orderpriority", "o_orderstatus"]
    return r6(drift.column_drift(reference.select(*columns), current.select(*columns)), "score")


@query
def drift_p_values(spark, folder):
    """p-value tests, named in the rule: early against late customers."""
    c = _c360(spark, folder).select(*b.NUMERIC, *b.TEXT)
    reference, current = c.where("tenure_in_months < 55"), c.where("tenure_in_months >= 55")
    rule = drift.DriftRule(numeric_test="ks", text_test="chi_square")
    return drift.column_drift(reference, current, rule).select("column", "kind", "method", F.round("score", 6).alias("score"), "threshold", "drifted")


@query
def drift_summary(spark, folder):
    reference, batches = _sweep(spark, folder)
    names = [f"batch_intensity_{i:.2f}" for i in b.BATCHES.intensities]
    return r6(drift.drift_summary(drift.sweep_drift(reference, batches, names, skip=[b.KEY])), "dataset_drift_share")


def _customer_groups(spark, folder):
    """Orders before 1998 as the reference, and the later ones in 500 batches by customer."""
    reference, current = _eras(spark, folder)
    columns = ["o_totalprice", "o_custkey", "o_orderpriority", "o_orderstatus"]
    batch = F.format_string("group %03d", F.col("o_custkey") % 500)
    return drift_many.reference_counts(reference.select(*columns)), current.select(*columns, batch.alias("batch"))


@query
def drift_many_batches(spark, folder):
    """Drift of four columns in 500 batches, from one plan."""
    counted, batches = _customer_groups(spark, folder)
    return r6(drift_many.many_drift(counted, batches, "batch"), "score")


@query
def drift_ks_exact(spark, folder):
    """The p-value test without approximation, named in the rule: early against late customers."""
    c = _c360(spark, folder).select(*b.NUMERIC)
    reference, current = c.where("tenure_in_months < 55"), c.where("tenure_in_months >= 55")
    out = drift.column_drift(reference, current, drift.DriftRule(numeric_test="ks_exact"))
    return out.select("column", "method", F.round("score", 6).alias("score"), "drifted")


def _region_drift(spark, folder):
    """Monthly charges and contracts of each region against all customers, as one batch per region."""
    c = _c360(spark, folder).select("region", *b.NUMERIC, "segment", "contract", "payment_method", "internet_type")
    names = [r["region"] for r in c.select("region").where("region IS NOT NULL").distinct().orderBy("region").collect()]
    detail = drift.sweep_drift(c.drop("region"), c, names, batch_column="region")
    places = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(float(i)))])
    return drift.drift_summary(detail).withColumn("intensity", places[F.col("batch_name")])


@query
def retrain_decision(spark, folder):
    rule = decisions.RetrainRule(threshold=0.0)
    return r6(decisions.retrain_decision(_region_drift(spark, folder), rule), "observed_value")


# ---- preparation ------------------------------------------------------------------------------------


@query
def impute_scale(spark, folder):
    c = _c360(spark, folder).select(b.KEY, "tenure_in_months", "monthly_charge", F.when(F.col("internet_type").isNotNull(), F.col("n_orders")).alias("n_orders"))
    out = preprocess.imputed_and_scaled(c, ["tenure_in_months", "monthly_charge", "n_orders"])
    return r6(out, "tenure_in_months", "monthly_charge", "n_orders")


@query
def onehot_long(spark, folder):
    return preprocess.onehot_long(_c360(spark, folder), b.KEY, ["contract", "internet_type"])


@query
def class_weights(spark, folder):
    return r6(preprocess.class_weights(_c360(spark, folder), "churn"), "weight")


# ---- metrics ----------------------------------------------------------------------------------------


@query
def classification_metrics(spark, folder):
    return r6(metrics.classification_metrics(_c360(spark, folder)), *metrics.METRICS)


@query
def roc_auc(spark, folder):
    """A text-length score against document quality."""
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    scored = docs.join(table(spark, folder, "labels"), "doc_id").withColumn("prediction", (F.col("n_chars") > 500).cast("int"))
    return r6(metrics.classification_metrics(scored, "quality", "prediction", "n_chars").select("n", "roc_auc"), "roc_auc")


@query
def average_precision(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    scored = docs.join(table(spark, folder, "labels"), "doc_id").withColumn("prediction", (F.col("n_chars") > 500).cast("int"))
    return r6(metrics.classification_metrics(scored, "quality", "prediction", "n_chars").select("n_pos", "pr_auc"), "pr_auc")


@query
def metrics_at_scale(spark, folder):
    """Returned items against their price, per ship status: many distinct scores in two groups."""
    items = table(spark, folder, "lineitem").select(
        "l_linestatus", "l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("returned"), (F.col("l_discount") > 0.05).cast("int").alias("prediction")
    )
    out = metrics.classification_metrics(items, "returned", "prediction", "l_extendedprice", ["l_linestatus"])
    return r6(out, *metrics.METRICS)


@query
def segment_metrics(spark, folder):
    return r6(metrics.segment_metrics(_c360(spark, folder), list(b.SEGMENTS)), *metrics.METRICS)


# ---- decisions and registry -------------------------------------------------------------------------


TWO_MODELS = {"recency": ("prediction", "score"), "volume": ("prediction_2", "score_2")}


def _evaluated(spark, folder):
    """Both scores, overall and by segment, from one pass over the customers."""
    return metrics.evaluate_models(_c360(spark, folder), list(b.SEGMENTS), TWO_MODELS)


def _decision(spark, folder, champion, challenger, rule):
    out = decisions.decided(decisions.model_deltas(_evaluated(spark, folder), champion, challenger, rule.metric), rule)
    deltas = F.transform(F.map_entries("regression_deltas"), lambda e: F.format_string("%s:%.6f", e["key"], e["value"]))
    return r6(out.withColumns({"regressions": _joined("regressions"), "regression_deltas": _joined(deltas)}), "aggregate_margin")


@query
def segment_regressions(spark, folder):
    """The second score against the first, segments that lose more than the tolerance."""
    deltas = decisions.model_deltas(_evaluated(spark, folder), "volume", "recency", b.PROMOTION.metric)
    regressed = deltas.where((F.col("segment_column") != OVERALL) & (F.col("delta") < -b.PROMOTION.segment_tolerance))
    return r6(regressed, "champion_value", "challenger_value", "delta")


@query
def promotion_decision(spark, folder):
    return _decision(spark, folder, "recency", "volume", b.PROMOTION)


@query
def promotion_blocked(spark, folder):
    """A permissive margin lets the segments decide."""
    return _decision(spark, folder, "volume", "recency", decisions.PromotionRule(margin=-1.0, segment_columns=b.SEGMENTS))


def _overall(spark, folder, *columns):
    return _evaluated(spark, folder).where(F.col("segment_column") == OVERALL).select(F.col("model").alias("family"), *columns)


@query
def model_ranking(spark, folder):
    return r6(decisions.rank_models(_overall(spark, folder, *metrics.METRICS)), *metrics.METRICS)


@query
def best_model(spark, folder):
    return r6(decisions.best_model(_overall(spark, folder, "accuracy", "f1"), "accuracy"), "accuracy", "f1")


@query
def registry_writers(spark, folder):
    """Every nation registers a version of its region's model and moves the alias, four at a time: the numbers have no gap and no double."""
    nations = table(spark, folder, "nation").join(table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey")).select("r_name", "n_name").collect()
    store = registry.Registry(spark, scratch_path(spark, "registry"))

    def register(nation):
        version = store.register(nation["r_name"], nation["n_name"], f"models/{nation['n_name']}")
        store.promote(nation["r_name"], version)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(register, nations))
    versions = store.versions().groupBy("model_name").agg(
        F.count("*").alias("n_versions"), F.count_distinct("version").alias("n_numbers"), F.max("version").alias("latest"), F.count_distinct("run_id").alias("n_runs")
    )
    moves = store.aliases().groupBy("model_name").agg(F.count("*").alias("n_moves"), F.max("step").alias("last_step"))
    return versions.join(moves, "model_name")


def _version_log(spark, folder):
    """The event log as a model registry: a user's signups register versions, purchases move the alias."""
    number = F.get_json_object("props", "$.k")
    return table(spark, folder, "events").select(F.col("user_id").alias("model_name"), "event_type", number.alias("version"), F.col("event_id").alias("step"))


@query
def latest_versions(spark, folder):
    versions = _version_log(spark, folder).where(F.col("event_type") == "signup")
    return registry.latest_versions(versions)


@query
def champion_lookup(spark, folder):
    moves = _version_log(spark, folder).where(F.col("event_type") == "purchase").withColumn("alias", F.lit(registry.CHAMPION))
    return registry.alias_targets(moves)


@query
def run_metrics_map(spark, folder):
    """Metric maps per region with prefixed keys, later values winning on equal keys."""
    c = _c360(spark, folder).groupBy("region").agg(F.count("*").cast("double").alias("n"), F.avg("churn").alias("rate"), F.avg("prediction").alias("hits"))
    first = F.create_map(F.lit("n"), F.col("n"), F.lit("rate"), F.col("rate"))
    second = F.create_map(F.lit("rate"), F.col("hits"))
    merged = prefix_keys(merge_maps(first, second), "challenger_")
    return r6(c.select("region", F.explode(merged).alias("metric", "metric_value")), "metric_value")


@query
def segment_names(spark, folder):
    """Distinct segment labels and batch names as the reports print them."""
    c = _c360(spark, folder)
    label = segment_label(F.lit("contract"), F.col("contract"))
    share = (F.sum(yes_flag(F.col("churn_label"))) / F.count("*")).alias("share")
    out = c.groupBy(label.alias("segment")).agg(share)
    return r6(out.withColumn("batch_name", batch_name(F.round("share", 6))), "share")


# ---- value ------------------------------------------------------------------------------------------


def _valued(spark, folder):
    rule = value.ValueRule(campaign_cost=50_000.0)
    return value.with_retention_value(_c360(spark, folder), rule, probability="score")


@query
def retention_value(spark, folder):
    return _valued(spark, folder).select("customer_id", "remaining_months", "value_at_risk", "expected_loss", "net_benefit", "worth_retaining")


@query
def retention_portfolio(spark, folder):
    return rounded(value.retention_portfolio(_valued(spark, folder), ["contract"]), value_at_risk=2, expected_loss=2, net_benefit=2)


@query
def retention_targets(spark, folder):
    return value.retention_targets(_valued(spark, folder), b.KEY, 100).select("customer_id", "contract", "net_benefit")


# ---- explanation ------------------------------------------------------------------------------------

LINEAR_WEIGHTS = {"tenure_in_months": -0.03, "recency_days": 0.004, "n_orders": -0.08, "monthly_charge": 0.00002}


def _linear(spark, folder):
    c = _c360(spark, folder)
    # A subquery can't feed each map entry on its own, so the means become one column first.
    with_means = c.withColumn("_means", explain.feature_means(c, list(LINEAR_WEIGHTS)))
    means = {n: F.col(f"_means.{n}") for n in LINEAR_WEIGHTS}
    out = with_means.withColumn("contributions", explain.linear_contributions(c, LINEAR_WEIGHTS, means))
    return out.select(b.KEY, F.transform_keys("contributions", lambda k, _: F.concat(F.lit("numeric__"), k)).alias("contributions"))


@query
def linear_score_explain(spark, folder):
    out = _linear(spark, folder).select(b.KEY, F.explode("contributions").alias("feature", "contribution"))
    return r6(out, "contribution")


@query
def top_attributions(spark, folder):
    top = explain.top_attributions(_linear(spark, folder), "contributions", 2)
    named = top.withColumn("feature", explain.readable_feature(F.col("feature"), list(LINEAR_WEIGHTS)))
    return r6(named, "value")


@query
def readable_features(spark, folder):
    long = preprocess.onehot_long(_c360(spark, folder), b.KEY, ["contract", "internet_type", "internet_service"])
    named = long.withColumn("label", explain.readable_feature(F.col("feature"), ["contract", "internet", "internet_type", "internet_service"]))
    return named.groupBy("feature", "label").agg(F.count("*").alias("n"))
