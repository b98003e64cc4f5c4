import pytest
from helpers import customers, rows
from pyspark.sql import functions as F

from retentia.operators.contract import (
    CUSTOMER_CONTRACT,
    Contract,
    ContractViolation,
    Field,
    check_columns,
    coerce,
    enforce,
    known_values,
    quarantine,
    unknown_values,
    violations,
    with_errors,
    with_original_names,
    with_request_names,
)
from retentia.operators.features import FeatureSpec, scoring_contract


def test_valid_rows_pass_and_get_their_types(spark):
    out = enforce(customers(spark, 3), CUSTOMER_CONTRACT)
    assert out.schema["Age"].dataType.simpleString() == "bigint"
    assert out.schema["Latitude"].dataType.simpleString() == "double"
    assert out.count() == 3


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"Churn Label": "Maybe"}, "allowed:Churn Label"),
        ({"Gender": None}, "not_null:Gender"),
        ({"Age": "thirty-five"}, "type:Age"),
        ({"Age": "35.5"}, "type:Age"),
        ({"Age": "121"}, "max:Age"),
        ({"Satisfaction Score": "0"}, "min:Satisfaction Score"),
        ({"Total Charges": "-0.01"}, "min:Total Charges"),
    ],
)
def test_broken_rule_is_named(spark, change, rule):
    with pytest.raises(ContractViolation, match=rule):
        enforce(customers(spark, 1, **change), CUSTOMER_CONTRACT)


def test_structural_null_and_free_lower_bound_pass(spark):
    change = {"Internet Service": "No", "Internet Type": None, "Offer": None, "Churn Category": None, "Churn Reason": None, "Monthly Charge": "-5"}
    assert enforce(customers(spark, 1, **change), CUSTOMER_CONTRACT).count() == 1


def test_bounds_are_inclusive(spark):
    assert enforce(customers(spark, 1, Age="120", **{"Churn Score": "100", "Satisfaction Score": "5"}), CUSTOMER_CONTRACT).count() == 1


def test_duplicate_key_is_a_violation(spark):
    twice = customers(spark, 1).union(customers(spark, 1))
    with pytest.raises(ContractViolation, match="unique:Customer ID"):
        enforce(twice, CUSTOMER_CONTRACT)


def test_column_set_is_closed(spark):
    df = customers(spark, 1)
    with pytest.raises(ContractViolation, match="missing columns \\['Age'\\]"):
        check_columns(df.drop("Age"), CUSTOMER_CONTRACT)
    with pytest.raises(ContractViolation, match="unexpected columns \\['Extra'\\]"):
        check_columns(df.withColumn("Extra", F.lit(1)), CUSTOMER_CONTRACT)


def test_report_lists_every_rule_with_zeros(spark):
    report = {(r["rule"], r["column"]): r["n_violations"] for r in violations(customers(spark, 4, Age="x"), CUSTOMER_CONTRACT).collect()}
    assert report[("type", "Age")] == 4
    assert report[("not_null", "Age")] == 0
    assert report[("unique", "Customer ID")] == 0


def test_quarantine_keeps_every_row_on_one_side(spark):
    df = customers(spark, 5).unionByName(customers(spark, 2, Age="x", Gender="?"))
    clean, broken = quarantine(df, CUSTOMER_CONTRACT)
    assert clean.count() == 5
    assert {tuple(sorted(r["errors"])) for r in broken.collect()} == {("allowed:Gender", "type:Age")}


def test_scoring_contract_has_37_fields_and_both_spellings(spark):
    contract = scoring_contract(FeatureSpec())
    assert len(contract.names) == 37
    snake = with_request_names(customers(spark, 1).select(*contract.names), contract)
    assert "avg_monthly_gb_download" in snake.columns and "under_30" in snake.columns
    back = with_original_names(snake, contract)
    assert back.columns == contract.names
    assert with_errors(back, contract).first()["errors"] == []


def test_error_list_per_row(spark):
    small = Contract((Field("a", "bigint", low=0), Field("b", allowed=("x",))))
    df = spark.createDataFrame([("1", "x"), ("-1", "y"), (None, None)], "a string, b string")
    got = {r["a"]: sorted(r["errors"]) for r in with_errors(df, small).collect()}
    assert got == {"1": [], "-1": ["allowed:b", "min:a"], None: ["not_null:a", "not_null:b"]}


def test_known_and_unknown_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "city string")
    known = spark.createDataFrame([("a",)], "city string")
    assert [r["city"] for r in known_values(df, "city").collect()] == ["a", "b"]
    assert rows(unknown_values(df, "city", known, "city")) == [("b", 1)]


def test_a_value_is_cast_once_for_all_its_rules(spark, capsys):
    texts = {"7": 7, " +7\n": 7, "7.000": 7, "70e-1": 7, "0.7E1": 7, "7.": 7, "7.0000000000001": None, "75e-1": None, "seven": None, "7e": None, "99999999999999999999": None, "": None, "1e400": None}
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    bounded = Contract((Field("a", "bigint", low=8, high=6),))
    assert dict(coerce(df.select("a", F.col("a").alias("text")), Contract((Field("text"), Field("a", "bigint")))).collect()) == texts
    out = violations(df, bounded)
    out.explain()
    plan = capsys.readouterr().out
    assert plan.count(r"\d+\.0*") == 1 and plan.count("as bigint)") == 3
    assert sorted(r["n_violations"] for r in out.collect()) == [0, 6, 6, 7]
