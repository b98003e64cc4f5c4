"""Table profiling: missing values, duplicates, cardinality, distributions, correlations, churn rates.

Each report is one pass over the columns it names, and returns long frames.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentia.functions.quantiles import clean, selected_quantiles
from retentia.functions.scalars import missing, yes_flag
from retentia.session import written


def _is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))


def _long_row(row: DataFrame, columns: Sequence[str], build) -> DataFrame:
    """Turn a one-row wide aggregate into one row per column; ``build`` names a column's struct fields."""
    entries = [F.struct(F.lit(c).alias("column"), *build(c)) for c in columns]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def missing_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_missing, pct_missing) for columns that miss any value, most missing first."""
    columns = list(columns or df.columns)
    row = df.agg(F.count("*").alias("_n"), *[F.count(F.when(missing(F.col(c), _is_float(df, c)), 1)).alias(c) for c in columns])
    long = _long_row(row, columns, lambda c: [F.col(c).alias("n_missing"), (F.col(c) / F.col("_n") * 100).alias("pct_missing")])
    return long.where("n_missing > 0").orderBy(F.desc("n_missing"), "column")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, *, exact: bool = True) -> DataFrame:
    """(column, n_distinct), nulls excluded."""
    columns = list(columns or df.columns)
    count = F.count_distinct if exact else F.approx_count_distinct
    row = df.agg(*[count(F.col(c)).alias(c) for c in columns])
    return _long_row(row, columns, lambda c: [F.col(c).alias("n_distinct")])


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with a single value. Minimum and maximum decide, so no distinct set is built."""
    columns = list(columns or df.columns)
    row = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns])
    long = _long_row(row, columns, lambda c: [(F.col(f"{c}.lo") == F.col(f"{c}.hi")).alias("constant")])
    return long.where("constant").select("column")


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first copy. Rows are grouped by a 256-bit digest, so long texts don't travel."""
    columns = list(columns or df.columns)
    digest = F.sha2(F.to_json(F.struct(*columns)), 256)
    groups = df.groupBy(digest.alias("digest")).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


def duplicate_key_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    groups = df.groupBy(*key).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max): sample deviation, exact interpolated quartiles."""
    values = {c: clean(c) for c in columns}
    row = df.agg(
        *[
            F.struct(
                F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")
            ).alias(c)
            for c, v in values.items()
        ]
    )
    moments = _long_row(row, columns, lambda c: [F.col(f"{c}.{m}").alias(m) for m in ("count", "mean", "std", "min", "max")])
    quartiles = selected_quantiles(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    # One row per described column on both sides.
    return moments.join(F.broadcast(quartiles), "column", "left").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def medians_by(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """(by, column, median), exact."""
    return selected_quantiles(df, columns, {"median": 0.5}, [by])


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, bin, lower, upper, n, density): equal-width bins between minimum and maximum.

    The last bin is closed; a column with one value gets a unit-wide range around it. With ``by`` each
    group has its own range. Empty bins are not listed.
    """
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    rows = df.select(*by, F.explode(F.array(*entries)).alias("e")).select(*by, "e.column", "e.value")
    rows = rows.where(F.col("value").isNotNull() & ~F.isnan("value"))
    keys = [*by, "column"]
    spans = rows.groupBy(*keys).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.count("*").alias("_n"))
    flat = F.col("_lo") == F.col("_hi")
    spans = spans.select(
        *keys,
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        (F.when(flat, F.lit(1.0)).otherwise(F.col("_hi") - F.col("_lo")) / F.lit(bins)).alias("_width"),
        "_n",
    )
    place = F.floor((F.col("value") - F.col("_lo")) / F.col("_width"))
    # Stored spans: joined by their real size, and a group that most rows share is split by the adaptive join.
    ranged = rows.join(written(spans, "spans"), keys)
    binned = ranged.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("bigint"))
    grouped = binned.groupBy(*keys, "bin").agg(F.count("*").alias("n"), F.max("_lo").alias("_lo"), F.max("_width").alias("_width"), F.max("_n").alias("_n"))
    return grouped.select(
        *keys,
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("lower"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_width")).alias("upper"),
        "n",
        (F.col("n") / (F.col("_n") * F.col("_width"))).alias("density"),
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r): Pearson matrix over pairwise complete rows, both halves, in one aggregation."""
    clean = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    pairs = list(combinations_with_replacement(columns, 2))
    row = df.agg(*[F.corr(clean[a], clean[b]).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        entries.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r")))
        if a != b:
            entries.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"r{i}").alias("r")))
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n, share), nulls excluded, most frequent first."""
    kept = df.where(F.col(column).isNotNull())
    counts = kept.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = kept.agg(F.count("*")).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), "value")


def multi_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for several text columns in one pass."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    rows = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where(F.col("value").isNotNull())
    return rows.groupBy("column", "value").agg(F.count("*").alias("n"))


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values, by name on ties."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "value").limit(k)


def class_balance(df: DataFrame, label: str = "churn") -> DataFrame:
    """(n, n_pos, pct_pos, neg_per_pos, pos_weight): ratio is null without positives."""
    y = F.col(label).cast("bigint")
    row = df.agg(F.count(y).alias("n"), F.sum(y).alias("n_pos"))
    neg = F.col("n") - F.col("n_pos")
    return row.select(
        "n", "n_pos", (F.col("n_pos") / F.col("n") * 100).alias("pct_pos"), F.when(F.col("n_pos") > 0, neg / F.col("n_pos")).alias("neg_per_pos")
    )


def churn_rates(df: DataFrame, column: str, label: Column | None = None) -> DataFrame:
    """(value, n, churn_rate %) per non-null value, highest first."""
    churned = yes_flag(F.col("churn_label")) if label is None else label
    grouped = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    return grouped.agg(F.count("*").alias("n"), (F.avg(churned) * 100).alias("churn_rate")).orderBy(F.desc("churn_rate"), "value")


def in_order(rates: DataFrame, order: Sequence[str], key: str = "value") -> DataFrame:
    """Align to a fixed key order: a listed key without a row gets nulls, other keys go away."""
    keys = rates.sparkSession.createDataFrame(list(enumerate(order)), f"pos bigint, {key} string")
    return F.broadcast(keys).join(rates, key, "left").orderBy("pos")


def service_churn(df: DataFrame, services: Sequence[str], label: Column | None = None) -> DataFrame:
    """(service, state, n, churn_rate %) for customers with and without each service, in one pass."""
    churned = yes_flag(F.col("churn_label")) if label is None else label
    entries = [F.struct(F.lit(s).alias("service"), F.col(s).alias("state")) for s in services]
    rows = df.select(churned.alias("_y"), F.explode(F.array(*entries)).alias("e")).select("_y", "e.*")
    grouped = rows.where(F.col("state").isin("Yes", "No")).groupBy("service", "state")
    return grouped.agg(F.count("*").alias("n"), (F.avg("_y") * 100).alias("churn_rate"))


def value_domains(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, low, high) of the numeric columns."""
    row = df.agg(*[F.struct(F.min(F.col(c).cast("double")).alias("lo"), F.max(F.col(c).cast("double")).alias("hi")).alias(c) for c in columns])
    return _long_row(row, columns, lambda c: [F.col(f"{c}.lo").alias("low"), F.col(f"{c}.hi").alias("high")])


def out_of_domain(df: DataFrame, columns: Sequence[str], domains: DataFrame) -> DataFrame:
    """(column, n_below, n_above): values outside the domains learned on another frame."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    rows = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    # One domain row per column of the schema.
    return (
        rows.join(F.broadcast(domains), "column")
        .groupBy("column")
        .agg(F.count(F.when(F.col("value") < F.col("low"), 1)).alias("n_below"), F.count(F.when(F.col("value") > F.col("high"), 1)).alias("n_above"))
    )


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5, *, last: bool = False) -> DataFrame:
    """Head or tail preview; both need an order to mean anything on a distributed table."""
    keys = [F.desc(c) if last else F.asc(c) for c in order]
    return df.orderBy(*keys).limit(n)
