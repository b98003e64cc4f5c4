"""How the operators apply to the customer360 table and the other test tables."""

from __future__ import annotations

from retentia.operators.contract import Contract, Field
from retentia.operators.consistency import ConsistencyRules, Floor, Switch
from retentia.operators.decisions import PromotionRule
from retentia.operators.features import FeatureSpec
from retentia.operators.sampling import BatchPlan, CategoricalReweight, NumericShift
from retentia.plans.customer360 import SERVICES

KEY = "customer_id"
SEGMENTS = ("contract", "payment_method", "internet_type")
NUMERIC = ("tenure_in_months", "recency_days", "n_orders", "total_charges", "monthly_charge")
TEXT = ("segment", "region", "contract", "payment_method", "internet_service", "internet_type")

FEATURES = FeatureSpec(
    id_columns=(KEY,),
    leakage_columns=("recency_days",),
    low_signal_columns=(),
    constant_columns=(),
    service_columns=tuple(SERVICES),
    tenure_column="tenure_in_months",
    new_customer_tenure=48,
    target="churn_label",
)

PROMOTION = PromotionRule(segment_columns=SEGMENTS)

BATCHES = BatchPlan(
    specs={
        "monthly_charge": NumericShift(5000.0, std_shift=0.5),
        "tenure_in_months": NumericShift(-8.0, clip_min=0),
        "contract": CategoricalReweight({"Month-to-Month": 0.70, "One Year": 0.20, "Two Year": 0.10}),
        "payment_method": CategoricalReweight({"Bank Withdrawal": 0.35, "Credit Card": 0.35, "Mailed Check": 0.30}),
    }
)

# A customer without internet has no services; charges have a floor.
CONSISTENCY = ConsistencyRules(
    switches=(Switch("internet_service", {"internet_type": None, **dict.fromkeys(SERVICES, "No")}),),
    floors=(
        Floor("monthly_charge", 20000.0),
        Floor("n_orders", 9, "svc_economy"),
    ),
)

CUSTOMER360_CONTRACT = Contract(
    (
        Field(KEY, "bigint", unique=True),
        Field("segment"),
        Field("region"),
        Field("contract", allowed=("Month-to-Month", "One Year", "Two Year")),
        Field("payment_method", allowed=("Bank Withdrawal", "Credit Card", "Mailed Check")),
        Field("internet_service", allowed=("Yes", "No")),
        Field("internet_type", nullable=True, allowed=("Cable", "DSL", "Fiber Optic")),
        *[Field(s, nullable=True, allowed=("Yes", "No")) for s in SERVICES],
        Field("tenure_in_months", "int", low=0),
        Field("recency_days", "int", low=0),
        Field("n_orders", "int", low=1),
        Field("total_charges", "double", low=0),
        Field("monthly_charge", "double"),
        Field("churn_label", allowed=("Yes", "No")),
    )
)

ORDERS_CONTRACT = Contract(
    (
        Field("o_orderkey", "bigint", unique=True),
        Field("o_custkey", "bigint", low=0),
        Field("o_orderstatus", allowed=("F", "O")),
        Field("o_totalprice", "double", low=1000, high=400000),
        Field("o_orderpriority", allowed=("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")),
    )
)

CUSTOMER_CONTRACT = Contract(
    (
        Field("c_custkey", "bigint", unique=True),
        Field("c_name"),
        Field("c_nationkey", "int", low=0, high=20),
        Field("c_acctbal", "double", low=0),
        Field("c_mktsegment", allowed=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")),
    )
)

SCORING_CONTRACT = Contract(
    (
        Field("contract", allowed=("Month-to-Month", "Two Year")),
        Field("payment_method", allowed=("Bank Withdrawal", "Credit Card", "Mailed Check")),
        Field("internet_type", nullable=True, allowed=("Cable", "DSL")),
        Field("svc_economy", nullable=True, allowed=("Yes", "No")),
        Field("tenure_in_months", "int", low=24, high=66),
        Field("monthly_charge", "double", low=10000),
        Field("internet_service", allowed=("Yes", "No")),
    )
)
