"""Registered queries over what the flows leave behind: files, reports, registry rows, encoded frames."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from retentia.functions.scalars import zip_to_map
from retentia.operators import consistency, contract, features, profile, tuning
from retentia.operators.preprocess import FEATURES, TableEncoder, encoded_features
from retentia.operators.registry import Registry
from retentia.plans import bindings as b
from retentia.plans.customer360 import customer360_table
from retentia.plans.queries import query, r6
from retentia.session import scratch_path
from retentia.sources.artifacts import (
    load_params,
    load_report,
    load_values,
    read_report,
    read_text,
    save_drift_detail,
    save_params,
    save_report,
    save_values,
)
from retentia.sources.customers import load_customers
from retentia.sources.tables import table

NULL_SPELLINGS = ("", "NA", "N/A", "null", "None", "NaN")


@query
def csv_customers(spark, folder):
    """The customers written as CSV text, missing values in six spellings, and loaded under their contract."""
    c = customer360_table(spark, folder).select(*b.CUSTOMER360_CONTRACT.names)
    spelling = F.get(F.array(*map(F.lit, NULL_SPELLINGS)), (F.col(b.KEY) % len(NULL_SPELLINGS)).cast("int"))
    path = scratch_path(spark, "customers-csv")
    c.select(*[F.coalesce(F.col(n).cast("string"), spelling).alias(n) for n in c.columns]).write.option("header", True).csv(path)
    return load_customers(spark, path, b.CUSTOMER360_CONTRACT)


@query
def column_differences(spark, folder):
    """Columns that the orders and the customers lack or have beyond a contract."""
    declared = {"orders": b.ORDERS_CONTRACT, "customer": contract.Contract((*b.CUSTOMER_CONTRACT.fields, contract.Field("c_segment_code"), contract.Field("c_since")))}
    rows = []
    for name, rules in declared.items():
        missing, extra = contract.column_differences(table(spark, folder, name), rules)
        rows += [(name, "missing", c) for c in missing] + [(name, "unexpected", c) for c in extra]
    return spark.createDataFrame(rows, "table string, kind string, column string")


@query
def renamed_requests(spark, folder):
    """Customers under request names and original names mixed, brought to the original ones."""
    rules = contract.Contract((contract.Field("Customer Key", "bigint"), contract.Field("Account Balance", "double"), contract.Field("Market Segment")))
    mixed = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_key"), F.col("c_acctbal").alias("Account Balance"), F.col("c_mktsegment").alias("market_segment")
    )
    named = contract.with_original_names(mixed, rules)
    contract.check_columns(named, rules)
    return named.select(F.col("Customer Key").alias("c_custkey"), F.col("Account Balance").alias("c_acctbal"), F.col("Market Segment").alias("c_mktsegment"))


@query
def report_round_trip(spark, folder):
    """Churn rates as a CSV report, read back as a required and as an optional report; reports never written are absent."""
    path = scratch_path(spark, "report")
    rates = r6(profile.churn_rates(customer360_table(spark, folder).withColumn("churn", (F.col("churn_label") == "Yes").cast("int")), "region"), "churn_rate")
    rates = rates.select(F.col("value").alias("region"), "churn_rate")
    save_report(rates, path, ["region"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rates.schema)
    required, optional = load_report(spark, path, schema, "the churn report"), read_report(spark, path, schema)
    absent = sum(x is None for x in (read_report(spark, f"{path}-none", schema), read_text(spark, f"{path}-none")))
    return required.unionByName(optional).groupBy("region").agg(F.max("churn_rate").alias("churn_rate"), F.count("*").alias("n_reads")).withColumn("n_absent", F.lit(absent))


@query
def value_list(spark, folder):
    """The known part types exported as JSON and read back."""
    path = scratch_path(spark, "values")
    save_values(contract.known_values(table(spark, folder, "part"), "p_type"), path)
    return load_values(spark, path, "p_type string")


@query
def stored_parameters(spark, folder):
    """Counts per segment stored as parameters; fixed settings are overlaid by the stored ones."""
    counts = table(spark, folder, "customer").groupBy("c_mktsegment").count().collect()  # five segments
    path = scratch_path(spark, "params")
    save_params(spark, {r["c_mktsegment"]: r["count"] for r in counts}, path)
    merged = load_params(spark, path, {"AUTOMOBILE": -1, "fixed": 7})
    return spark.createDataFrame(sorted(merged.items()), "name string, value bigint")


@query
def drift_detail_files(spark, folder):
    """Levels of orders per status as a per-batch JSON detail, read back."""
    path = scratch_path(spark, "detail")
    orders = table(spark, folder, "orders")
    save_drift_detail(orders.groupBy(F.col("o_orderstatus").alias("batch"), F.col("o_orderpriority").alias("column")).agg(F.count("*").alias("score")), path)
    return spark.read.schema("column string, score bigint, batch string").json(path).select("batch", "column", "score")


@query
def run_log(spark, folder):
    """One run per nation with its customers, in the registry's log."""
    customers = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.avg("c_acctbal").alias("balance"))
    store = Registry(spark, scratch_path(spark, "runs"))
    for r in customers.collect():  # 25 nations
        store.log_run("balances", f"nation {r['c_nationkey']}", {"n": r["n"]}, {"balance": round(r["balance"], 4), "none": None})
    return store.runs().select("experiment", "run_name", F.col("params")["n"].cast("bigint").alias("n"), F.col("metrics")["balance"].alias("balance"), F.size("metrics").alias("n_metrics"))


@query
def column_roles(spark, folder):
    """Numeric and text columns by type, and text columns too wide for one-hot encoding."""
    rows = []
    for name in ("documents", "orders", "part"):
        frame = table(spark, folder, name)
        numeric, text = features.column_types(frame)
        rows += [(name, c, "numeric") for c in numeric] + [(name, c, "text") for c in text]
        rows += [(name, c, "wide text") for c in features.wide_text_columns(frame)]
    return spark.createDataFrame(rows, "table string, column string, role string")


@query
def under_30_flags(spark, folder):
    """The age flag follows the age, and stays where the age is unknown."""
    age = F.when(F.col("c_custkey") % 7 > 0, F.col("c_custkey") % 60)
    customers = table(spark, folder, "customer").select("c_custkey", age.alias("age"), F.lit("unknown").alias("under_30"))
    return consistency.repair(customers, consistency.ConsistencyRules(switches=(), floors=())).select("c_custkey", "under_30")


@query
def zipped_names(spark, folder):
    """Numeric columns of the customers as a map by position, one row per entry."""
    c = customer360_table(spark, folder)
    values = F.array(*[F.col(n).cast("double") for n in b.NUMERIC])
    return c.select(b.KEY, F.explode(zip_to_map(F.array(*map(F.lit, b.NUMERIC)), values)).alias("name", "value"))


@query
def fold_scores(spark, folder):
    """Mean of fold scores per trial, and the best trial: orders by customer as trials, by key as folds."""
    orders = table(spark, folder, "orders")
    scores = orders.groupBy((F.col("o_custkey") % 20).alias("trial"), (F.col("o_orderkey") % 5).cast("int").alias("fold"))
    means = tuning.fold_means(scores.agg(F.avg("o_totalprice").alias("f1"))).withColumn("params", F.concat(F.lit("trial "), F.col("trial")))
    best = tuning.best_trial(means).select(F.col("trial").alias("best"))
    return r6(means.join(F.broadcast(best), F.col("trial") == F.col("best"), "left").select("trial", "mean_f1", F.col("best").isNotNull().alias("best")), "mean_f1")


@query
def encoded_customers(spark, folder):
    """The entries other than 0 of every customer's encoded vector, by feature name."""
    c = customer360_table(spark, folder)
    model = TableEncoder(numericCols=list(b.NUMERIC), textCols=list(b.TEXT)).fit(c)
    names = F.array(*[F.lit(n) for n, _, _ in encoded_features(model)])
    entries = F.explode(F.map_from_arrays(names, vector_to_array(FEATURES))).alias("feature", "value")
    return model.transform(c).select(b.KEY, entries).where(F.col("value") != 0)
