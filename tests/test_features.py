import pytest
from helpers import customers
from pyspark.sql import functions as F

from retentia.operators import consistency as cons
from retentia.operators.contract import CUSTOMER_CONTRACT, coerce
from retentia.operators.features import FeatureSpec, add_features, build_feature_table, column_types, drop_excluded, encode_target, fill_text, onehot_columns, wide_text_columns
from retentia.plans import bindings


def test_feature_table_has_39_features_and_the_label(spark):
    table = build_feature_table(coerce(customers(spark, 6), CUSTOMER_CONTRACT))
    spec = FeatureSpec()
    assert len(table.columns) == 40
    assert not set(spec.excluded) & set(table.columns)
    assert table.schema["Churn Label"].dataType.simpleString() == "int"


def test_missing_excluded_column_is_an_error(spark):
    with pytest.raises(ValueError, match="Quarter"):
        drop_excluded(customers(spark, 1).drop("Quarter"), FeatureSpec())


def test_new_customer_is_strictly_below_the_threshold(spark):
    spec = FeatureSpec(service_columns=("s",), tenure_column="t")
    df = spark.createDataFrame([(11, "Yes"), (12, "No"), (None, None)], "t int, s string")
    assert [tuple(r)[2:] for r in add_features(df, spec).orderBy("t").collect()] == [(0, 0), (1, 1), (0, 0)]


def test_services_are_counted_and_null_counts_nothing(spark):
    spec = FeatureSpec(service_columns=("a", "b", "c"), tenure_column="t")
    df = spark.createDataFrame([(1, "Yes", "Yes", "No"), (2, None, "Yes", None)], "t int, a string, b string, c string")
    assert [r["num_extra_services"] for r in add_features(df, spec).orderBy("t").collect()] == [2, 1]


def test_only_yes_is_positive(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("yes",), (None,)], "y string")
    assert sorted(r["y"] for r in encode_target(df, "y").collect()) == [0, 0, 0, 1]


def test_column_roles(spark):
    df = spark.createDataFrame([(1, 2.0, "x", "y")], "a int, b double, City string, d string")
    assert column_types(df) == (["a", "b"], ["City", "d"])
    assert onehot_columns(df) == (["a", "b"], ["d"])
    many = spark.range(500).select(F.col("id").cast("string").alias("wide"), F.lit("x").alias("narrow"))
    assert wide_text_columns(many, 100) == ["wide"]


def test_fill_text_leaves_numbers(spark):
    df = spark.createDataFrame([(None, None)], "a int, b string")
    assert tuple(fill_text(df, ["b"]).first()) == (None, "Missing")


def _repair(spark, schema, row):
    return cons.repair(spark.createDataFrame([row], schema)).first().asDict()


def test_no_internet_clears_what_depends_on_it(spark):
    got = _repair(
        spark,
        "internet_service string, internet_type string, online_security string, avg_monthly_gb_download bigint, streaming_tv string",
        ("No", "DSL", "Yes", 20, None),
    )
    assert got == {"internet_service": "No", "internet_type": None, "online_security": "No", "avg_monthly_gb_download": 0, "streaming_tv": "No"}


def test_no_phone_clears_long_distance(spark):
    got = _repair(spark, "phone_service string, multiple_lines string, avg_monthly_long_distance_charges double", ("No", "Yes", 12.5))
    assert got["multiple_lines"] == "No" and got["avg_monthly_long_distance_charges"] == 0.0


def test_conditional_floor_only_with_its_source(spark):
    schema = "dependents string, number_of_dependents bigint, referred_a_friend string, number_of_referrals bigint"
    assert _repair(spark, schema, ("Yes", 0, "No", 3)) == {"dependents": "Yes", "number_of_dependents": 1, "referred_a_friend": "No", "number_of_referrals": 0}


def test_fixed_floors_and_free_columns(spark):
    got = _repair(spark, "monthly_charge double, total_charges double, total_revenue double, total_refunds double", (0.0, 0.0, 0.0, 0.0))
    assert got == {"monthly_charge": 18.55, "total_charges": 18.80, "total_revenue": 21.36, "total_refunds": 0.0}


def test_null_is_not_raised_to_a_floor(spark):
    assert _repair(spark, "monthly_charge double", (None,)) == {"monthly_charge": None}


@pytest.mark.parametrize("age, flag, want", [(29, "No", "Yes"), (30, "Yes", "No"), (None, "Yes", "Yes")])
def test_under_30_follows_age(spark, age, flag, want):
    assert _repair(spark, "age int, under_30 string", (age, flag))["under_30"] == want


def test_repair_is_idempotent_and_marks_what_it_changes(spark):
    df = spark.createDataFrame(
        [("No", "DSL", "Yes", 5, 40, "Yes"), ("Yes", "DSL", "Yes", 0, 20, "No"), ("Yes", None, "No", 7, 31, "No")],
        "internet_service string, internet_type string, online_security string, avg_monthly_gb_download bigint, age int, under_30 string",
    )
    once = cons.repair(df)
    assert once.collect() == cons.repair(once).collect()
    assert df.where(cons.inconsistent(df)).count() == 2
    assert once.where(cons.inconsistent(once)).count() == 0


def test_determined_fields(spark):
    df = spark.createDataFrame([("No", "Yes"), ("Yes", "No")], "phone_service string, dependents string")
    got = [r["determined"] for r in cons.determined_fields(df).collect()]
    assert got == [
        ["avg_monthly_long_distance_charges", "multiple_lines", "total_long_distance_charges", "under_30"],
        ["number_of_dependents", "under_30"],
    ]


def test_sentinel_becomes_null(spark):
    df = spark.createDataFrame([(cons.NO_VALUE, 1), ("Offer A", 2)], "offer string, n int")
    assert [tuple(r) for r in cons.clear_sentinel(df).orderBy("n").collect()] == [(None, 1), ("Offer A", 2)]


def test_binding_uses_table_columns(spark):
    assert bindings.FEATURES.excluded == ("customer_id", "recency_days")
