import pytest
from helpers import customer_row, customers
from pyspark.sql import functions as F

from retentia.operators.contract import CUSTOMER_CONTRACT, ContractViolation
from retentia.operators.registry import Registry, alias_targets, latest_versions
from retentia.session import shared_dir, written
from retentia.sources import artifacts as art
from retentia.sources.customers import load_customers, scan_csv


def write_csv(path, rows):
    names = CUSTOMER_CONTRACT.names
    lines = [",".join(names)]
    for row in rows:
        lines.append(",".join('"' + str(row[n]).replace('"', '""') + '"' if row[n] is not None else "" for n in names))
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_is_read_typed_with_null_tokens(spark, tmp_path):
    quoted = customer_row(1, City='San "Q" José, CA', Offer="None", **{"Internet Type": "NA", "Churn Reason": ""})
    path = write_csv(tmp_path / "c.csv", [customer_row(0), quoted])
    out = {r["Customer ID"]: r for r in load_customers(spark, path).collect()}
    row = out["C-00001"]
    assert row["City"] == 'San "Q" José, CA' and row["Offer"] is None and row["Internet Type"] is None and row["Churn Reason"] is None
    assert isinstance(row["Age"], int) and isinstance(row["Total Charges"], float)


def test_csv_columns_may_come_in_any_order(spark, tmp_path):
    path = write_csv(tmp_path / "c.csv", [customer_row(0)])
    raw = scan_csv(spark, path)
    assert set(raw.columns) == set(CUSTOMER_CONTRACT.names)


def test_csv_with_a_broken_row_is_refused(spark, tmp_path):
    path = write_csv(tmp_path / "c.csv", [customer_row(0), customer_row(1, Age="NaN")])
    with pytest.raises(ContractViolation, match="not_null:Age"):
        load_customers(spark, path)


def test_split_round_trip(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") % 2).cast("int").alias("y"), (F.col("id") < 3).cast("int").alias("is_test"))
    art.save_split(df, str(tmp_path / "d"))
    train, test = art.load_split(spark, str(tmp_path / "d"))
    assert (train.count(), test.count()) == (7, 3) and "is_test" not in train.columns
    assert art.load_reference(spark, str(tmp_path / "d"), "y").columns == ["id"]


def test_missing_files_name_the_step_that_writes_them(spark, tmp_path):
    with pytest.raises(art.MissingArtifact, match="run the drift monitoring first"):
        art.load_report(spark, str(tmp_path / "none"), "a string", "the drift monitoring")
    assert art.read_report(spark, str(tmp_path / "none"), "a string") is None
    assert art.read_text(spark, str(tmp_path / "none")) is None
    with pytest.raises(art.MissingArtifact, match="training search"):
        art.load_params(spark, str(tmp_path / "none"))


def test_reports_values_and_params_round_trip(spark, tmp_path):
    table = spark.createDataFrame([("b", 0.5), ("a", 0.9)], "family string, f1 double")
    art.save_report(table, str(tmp_path / "r"), [F.desc("f1")])
    assert [r["family"] for r in art.load_report(spark, str(tmp_path / "r"), "family string, f1 double", "x").collect()] == ["a", "b"]
    art.save_values(spark.createDataFrame([("Málaga",)], "city string"), str(tmp_path / "v"))
    assert art.load_values(spark, str(tmp_path / "v"), "city string").first()["city"] == "Málaga"
    art.save_params(spark, {"max_depth": 4, "learning_rate": 0.1}, str(tmp_path / "p"))
    assert art.load_params(spark, str(tmp_path / "p"), {"max_depth": 9, "seed": 1}) == {"max_depth": 4, "learning_rate": 0.1, "seed": 1}


def test_latest_version_is_numeric_and_alias_log_wins_last(spark):
    versions = spark.createDataFrame([("m", "9"), ("m", "10"), ("k", "2")], "model_name string, version string")
    assert {r["model_name"]: r["latest"] for r in latest_versions(versions).collect()} == {"m": 10, "k": 2}
    moves = spark.createDataFrame([("m", "champion", 2, 1), ("m", "champion", 1, 2), ("m", "other", 9, 3)], "model_name string, alias string, version bigint, step bigint")
    assert [tuple(r) for r in alias_targets(moves).collect()] == [("m", 1)]


def test_registry(spark, tmp_path):
    registry = Registry(spark, str(tmp_path / "registry"))
    assert registry.latest("m") is None and registry.champion("m") is None
    assert [registry.register("m", f"run{i}", f"/m/{i}") for i in (1, 2)] == [1, 2]
    registry.promote("m", 2)
    registry.promote("m", 1)
    assert registry.champion("m") == 1 and registry.latest("m") == 2 and registry.version_path("m", 2) == "/m/2"
    run = registry.log_run("e", "r", {"a": 1}, {"f1": 0.5, "none": None})
    row = registry.runs().where(F.col("run_id") == run).first()
    assert row["params"] == {"a": "1"} and row["metrics"] == {"f1": 0.5}


def test_shared_folder_follows_the_session_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    out = written(spark.range(5), "test")
    assert out.count() == 5 and out.inputFiles()[0].startswith("file:" + "//" + shared_dir(spark))


def test_helper_rows_are_valid(spark):
    assert customers(spark, 2).count() == 2
