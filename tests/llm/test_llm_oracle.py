"""Every query with SQL against DuckDB, and held-out accuracy of the language query."""

import pytest
from compare import DATA, compare, connect

from retentia.llm.oracle import ORACLE
from retentia.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(), name, QUERIES[name], ORACLE[name]) is None


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    scored = QUERIES["op8_language_id"](spark, DATA).where("held_out").join(docs, "doc_id")
    assert scored.selectExpr("avg(cast(lang = lang_pred as int)) as a").first()["a"] > 0.98
