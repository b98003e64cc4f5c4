import pytest
from compare import DATA, compare, connect

from __spark_entry__ import entry, queries
from retentia.plans import artifact_queries, model_queries  # noqa: F401  (they register their queries)
from retentia.plans.oracle import ORACLE
from retentia.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect()


def test_names_line_up():
    assert set(ORACLE) <= set(QUERIES) <= set(queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLE[name]) is None


def test_flagship(spark):
    assert entry(spark).columns == ["promote", "reason", "aggregate_margin", "regressions", "regression_deltas"]


def test_linear_explanation_covers_every_customer(spark):
    out = queries()["linear_model_explain"](spark, DATA)
    assert out.select("customer_id").distinct().count() == 1496
