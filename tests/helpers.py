"""Small customer rows that meet the raw contract."""

from __future__ import annotations

from retentia.operators.contract import CUSTOMER_CONTRACT


def customer_row(i: int = 0, **overrides) -> dict[str, str | None]:
    """A valid raw row as text, one value per contract column."""
    row: dict[str, str | None] = {}
    for f in CUSTOMER_CONTRACT.fields:
        if f.unique:
            row[f.name] = f"C-{i:05d}"
        elif f.allowed:
            row[f.name] = f.allowed[i % len(f.allowed)]
        elif f.type == "bigint":
            row[f.name] = str(int(f.low or 0) + i % 5)
        elif f.type == "double":
            row[f.name] = str(20.5 + i % 7)
        else:
            row[f.name] = f"text {i % 3}"
    row["Tenure in Months"] = str(i % 60)
    row["Age"] = str(20 + i % 50)
    row.update(overrides)
    return row


def customers(spark, n: int = 1, **overrides):
    schema = ", ".join(f"`{name}` string" for name in CUSTOMER_CONTRACT.names)
    rows = [tuple(customer_row(i, **overrides)[name] for name in CUSTOMER_CONTRACT.names) for i in range(n)]
    return spark.createDataFrame(rows, schema)


def rows(df, *columns):
    columns = columns or df.columns
    return sorted(tuple(r[c] for c in columns) for r in df.collect())
