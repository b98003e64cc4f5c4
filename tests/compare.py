"""Run the registered queries next to their SQL and compare. Usage: python tests/compare.py [name...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str = DATA):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, repr(v + 0.0))
    return (1, str(v))


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, con, name: str, spark_query, sql: str, folder: str = DATA) -> str | None:
    """None if rows, columns and types agree, else what differs."""
    df = spark_query(spark, folder)
    left_columns = sorted(df.columns)
    left = sorted(tuple(_cell(r[c]) for c in left_columns) for r in df.collect())
    result = con.execute(sql)
    description = result.description
    columns = [d[0] for d in description]
    rows = result.fetchall()
    if sorted(columns) != left_columns:
        return f"columns {left_columns} != {sorted(columns)}"
    types = {d[0]: str(d[1]) for d in description}
    wrong = {f.name: (f.dataType.simpleString(), types[f.name]) for f in df.schema if TYPES.get(f.dataType.simpleString()) != types[f.name]}
    position = [columns.index(c) for c in left_columns]
    right = sorted(tuple(_cell(r[i]) for i in position) for r in rows)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        return f"{len(different)} of {len(left)} rows differ, e.g. {left_columns}: {different[0]}"
    return f"types {wrong}" if wrong else None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from retentia.session import local_session

    spark = local_session()
    con, sqls, bad = connect(), oracle_sql(), 0
    for name, f in queries().items():
        if sys.argv[1:] and name not in sys.argv[1:]:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, name, f, sqls[name])
            else:
                problem = None if f(spark, DATA).collect() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {'' if name in sqls else '(rows only)'} {problem or ''}", flush=True)
    print("failed:", bad)
