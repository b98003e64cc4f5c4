"""One row per customer with history, services and the churn label, from the order tables.

A customer is known if they ordered before the cutoff and has churned if they never order again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.session import scratch_path
from retentia.sources.tables import fingerprint, table

CUTOFF = "2000-08-01"
SERVICE_START = "2000-02-01"

SERVICES = {
    "svc_economy": "ECONOMY",
    "svc_small": "SMALL",
    "svc_medium": "MEDIUM",
    "svc_promo": "PROMO",
    "svc_standard": "STANDARD",
    "svc_large": "LARGE",
}


def customer360(spark: SparkSession, folder: str, cutoff: str = CUTOFF, service_start: str = SERVICE_START) -> DataFrame:
    """All customers with an order before ``cutoff``.

    History counts every order before the cutoff and the label every order after it. The services are those in use at the cutoff: of
    orders from ``service_start`` on, half a year by default. Both dates are settings of the features.
    """
    cut = F.expr(f"TIMESTAMP_NTZ '{cutoff} 00:00:00'")
    start = F.expr(f"TIMESTAMP_NTZ '{service_start} 00:00:00'")
    orders = table(spark, folder, "orders")
    past = F.col("o_orderdate") < cut

    # History and future label in one aggregation of orders, on the key the joins below use.
    history = (
        orders.groupBy("o_custkey")
        .agg(
            F.min(F.when(past, F.col("o_orderdate"))).alias("first_dt"),
            F.max(F.when(past, F.col("o_orderdate"))).alias("last_dt"),
            F.count(F.when(past, 1)).alias("n_orders"),
            F.sum(F.when(past, F.col("o_totalprice").cast("decimal(18,2)"))).alias("total_charges"),
            F.max((~past).cast("int")).alias("returned"),
        )
        .where("n_orders > 0")
    )
    recent = orders.where((F.col("o_orderdate") >= start) & past).select("o_orderkey", "o_custkey")
    services = (
        recent.join(table(spark, folder, "lineitem").select("l_orderkey", "l_partkey"), F.expr("o_orderkey = l_orderkey"))
        .join(table(spark, folder, "part").select("p_partkey", "p_type"), F.expr("l_partkey = p_partkey"))
        .groupBy(F.col("o_custkey").alias("s_custkey"))
        .agg(*[F.max((F.col("p_type") == kind).cast("int")).alias(name) for name, kind in SERVICES.items()])
    )
    places = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey"))
        .select("n_nationkey", "r_name")
    )
    joined = (
        table(spark, folder, "customer")
        .join(history, F.expr("c_custkey = o_custkey"))
        .join(services, F.expr("c_custkey = s_custkey"), "left")
        .join(places, F.expr("c_nationkey = n_nationkey"))
    )
    tenure = F.floor(F.datediff(cut, "first_dt") / 30.0).cast("int")
    has_services = F.col("s_custkey").isNotNull()
    internet_type = (
        F.when(~has_services, F.lit(None).cast("string"))
        .when(F.col("svc_economy") == 1, "Fiber Optic")
        .when(F.col("svc_small") == 1, "Cable")
        .otherwise("DSL")
    )
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"),
        F.when(F.col("n_orders") < 7, "Month-to-Month")
        .when(F.col("n_orders") < 10, "One Year")
        .otherwise("Two Year")
        .alias("contract"),
        F.when(F.col("c_acctbal") < 0, "Mailed Check")
        .when(F.col("c_acctbal") < 5000, "Bank Withdrawal")
        .otherwise("Credit Card")
        .alias("payment_method"),
        F.when(has_services, "Yes").otherwise("No").alias("internet_service"),
        internet_type.alias("internet_type"),
        *[F.when(F.col(s) == 1, "Yes").when(F.col(s) == 0, "No").alias(s) for s in SERVICES],
        tenure.alias("tenure_in_months"),
        F.datediff(cut, "last_dt").cast("int").alias("recency_days"),
        F.col("n_orders").cast("int").alias("n_orders"),
        F.col("total_charges").cast("double").alias("total_charges"),
        (F.col("total_charges").cast("double") / F.greatest(tenure, F.lit(1))).alias("monthly_charge"),
        F.when(F.col("returned") == 1, "No").otherwise("Yes").alias("churn_label"),
    )


SOURCES = ("orders", "lineitem", "part", "nation", "region", "customer")
_written: dict[tuple[str, str, str], str] = {}


def customer360_table(spark: SparkSession, folder: str) -> DataFrame:
    """``customer360`` written to the shared folder and read from there, once per session and state of the source files.

    Most flows read it several times; the written table spares them the joins and survives the loss
    of the executors that made it.
    """
    key = (spark.sparkContext.applicationId, folder, fingerprint(spark, folder, SOURCES))
    if key in _written:
        try:
            return spark.read.parquet(_written[key])
        except AnalysisException:
            pass  # the shared folder was emptied in the meantime
    path = scratch_path(spark, "customer360")
    customer360(spark, folder).write.parquet(path)
    _written[key] = path
    return spark.read.parquet(path)


def baseline_scores(frame: DataFrame) -> DataFrame:
    """Two fixed scores with their 0.5-threshold predictions, usable before any model is trained."""
    recency = F.least(F.col("recency_days") / F.lit(400.0), F.lit(1.0))
    volume = F.lit(1.0) - F.least(F.col("n_orders") / F.lit(20.0), F.lit(1.0))
    return frame.withColumns(
        {
            "churn": (F.col("churn_label") == "Yes").cast("int"),
            "score": recency,
            "prediction": (recency >= 0.5).cast("int"),
            "score_2": volume,
            "prediction_2": (volume >= 0.5).cast("int"),
        }
    )
