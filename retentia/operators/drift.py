"""Per-column drift between a reference and one or more batches, and the dataset share.

Every test is computed from value counts: one row per (column, value) with the reference count and one
count per batch side by side. The reference is counted once however many batches there are, and the
counts are written to the shared folder because several tests read them.

The test of a column is declared in the rule, by kind or by column, and never follows from how many rows or
values were seen:

* ``wasserstein`` (numeric columns; over the reference's standard deviation) and ``jensen_shannon``: drifted when >= 0.1;
* ``ks`` (two-sample Kolmogorov-Smirnov, numeric columns, asymptotic), ``ks_exact`` (the same without approximation; its steps
  grow with the rows of both sides and run in one task per partition of the report, a few microseconds a row), ``chi_square`` and ``z_test``
  (two-sided, two proportions): p-values, drifted when < 0.05.

A test of levels on a numeric column takes its values as levels. ``z_test`` is for columns of two levels: more than two on
both sides together give the p-value 0. A test without a defined score has a null score and counts as drifted.

A column without any value in the reference or in the batch can't be tested. It gets a row with the method
``no_values`` and no score, counts as drifted if only one of the two lacks values, and stays in the dataset share.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.functions.ordered import running_sums
from retentia.functions.scalars import lookup
from retentia.functions.stats import chi_square_tail, kolmogorov_exact, kolmogorov_tail, two_sided_normal_tail
from retentia.operators.features import column_types
from retentia.session import written

REFERENCE = "ref"
NO_VALUES = "no_values"
LEVEL_TESTS = ("jensen_shannon", "chi_square", "z_test")
NUMERIC_TESTS = ("wasserstein", "ks", "ks_exact", *LEVEL_TESTS)
P_VALUES = ("ks", "ks_exact", "chi_square", "z_test")


@dataclass(frozen=True)
class DriftRule:
    """The defaults are fixed values."""

    distance_threshold: float = 0.1
    p_threshold: float = 0.05
    min_std: float = 0.001
    log_base: float = 2.0
    drift_share: float = 0.5
    numeric_test: str = "wasserstein"
    text_test: str = "jensen_shannon"
    column_tests: Mapping[str, str] = field(default_factory=dict)

    def test(self, column: str, kind: str) -> str:
        """The test declared for a column; one that its kind can't have is an error."""
        name = self.column_tests.get(column, self.numeric_test if kind == "numeric" else self.text_test)
        if name not in (NUMERIC_TESTS if kind == "numeric" else LEVEL_TESTS):
            raise ValueError(f"no test {name!r} for the {kind} column {column!r}")
        return name


def long_values(df: DataFrame, numeric: Sequence[str], text: Sequence[str], frame: Column) -> DataFrame:
    """(frame, column, num, txt) with one row per non-missing value; NaN counts as missing."""
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    entries = [
        F.struct(F.lit(c).alias("column"), F.nanvl(F.col(f"`{c}`").cast("double"), no_number).alias("num"), no_text.alias("txt"))
        for c in numeric
    ] + [F.struct(F.lit(c).alias("column"), no_number.alias("num"), F.col(f"`{c}`").alias("txt")) for c in text]
    rows = df.select(frame.alias("frame"), F.explode(F.array(*entries)).alias("e")).select("frame", "e.*")
    return rows.where(F.col("num").isNotNull() | F.col("txt").isNotNull())


def value_counts(
    reference: DataFrame, batches: DataFrame, frame: Column, names: Mapping[str, str], numeric: Sequence[str], text: Sequence[str]
) -> DataFrame:
    """(column, num, txt, n_ref, n_<alias>...): each frame is read once for all columns and batches.

    ``frame`` tells which batch a row of ``batches`` belongs to; ``names`` maps column aliases to them.
    Counting happens per task before anything is shuffled.
    """
    rows = long_values(reference, numeric, text, F.lit(REFERENCE)).unionByName(long_values(batches, numeric, text, frame))
    frames = {REFERENCE: REFERENCE, **names}
    return rows.groupBy("column", "num", "txt").agg(
        *[F.count(F.when(F.col("frame") == name, 1)).alias(f"n_{alias}") for alias, name in frames.items()]
    )


def numeric_counts(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("num").isNotNull()).withColumnRenamed("num", "value").drop("txt")


def text_counts(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("txt").isNotNull()).withColumnRenamed("txt", "value").drop("num")


def _xlog(p: Column, m: Column, base: float) -> Column:
    return F.when(p > 0, p * (F.ln(p / m) / F.ln(F.lit(base)))).otherwise(F.lit(0.0))


def _level_terms(ref: Column, cur: Column, ref_total: Column, cur_total: Column, rule: DriftRule) -> dict[str, Column]:
    """Aggregates over the levels of one column for the categorical tests."""
    p, q = F.try_divide(ref, ref_total), F.try_divide(cur, cur_total)
    middle = (p + q) / 2
    expected = p * cur_total
    gap = cur - expected
    return {
        "js": F.sum(_xlog(p, middle, rule.log_base) + _xlog(q, middle, rule.log_base)),
        # A level the reference lacks makes the statistic infinite.
        "chi2": F.sum(F.when(expected > 0, gap * gap / expected).when(cur > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))),
        "n_levels": F.count(F.when((ref > 0) | (cur > 0), 1)),
        # (p - q)^2 over the pooled share: for two levels, the squared z statistic up to the sample sizes.
        "gap": F.sum(F.when(ref + cur > 0, (p - q) * (p - q) * (ref_total + cur_total) / (ref + cur)).otherwise(F.lit(0.0))),
    }


def _per_batch(rows: DataFrame, batches: Sequence[str], terms, kind: str, rule: DriftRule) -> DataFrame:
    """One aggregation per column over all batches side by side, then one row per (batch, column)."""
    ref, ref_total = F.col("n_ref"), F.col("n_ref_total")
    aggs = []
    for b in batches:
        columns = terms(F.col(f"n_{b}"), F.col(f"n_{b}_total"), b)
        aggs.append(F.struct(F.lit(b).alias("batch"), *[c.alias(name) for name, c in columns.items()]).alias(f"_{b}"))
    per_column = rows.groupBy("column").agg(
        F.count(F.when(ref > 0, 1)).alias("n_ref_values"), F.max(ref_total).alias("n_ref"), *aggs
    )
    each = F.explode(F.array(*[F.col(f"_{b}") for b in batches])).alias("e")
    frame = per_column.select("column", "n_ref_values", "n_ref", each).select("column", "n_ref_values", "n_ref", "e.*")
    n1, n2 = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    return frame.select(
        "batch",
        "column",
        F.lit(kind).alias("kind"),
        "n_ref",
        "n_cur",
        "n_ref_values",
        F.sqrt(F.greatest(F.lit(0.5) * F.col("js"), F.lit(0.0))).alias("jensen_shannon"),
        "chi2",
        "n_levels",
        F.sqrt(F.col("gap") / (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2))).alias("z"),
        "ks",
        "wasserstein",
    )


def numeric_distances(counts: DataFrame, batches: Sequence[str], rule: DriftRule = DriftRule()) -> DataFrame:
    """All statistics of numeric columns, one row per (batch, column), from one cumulative pass."""
    measures = ["n_ref", *[f"n_{b}" for b in batches]]
    # `column` ranges over the schema's columns, so the cut and offset tables have a fixed size.
    run = running_sums(counts, ["column"], "value", measures, bounded_keys=True, with_next=True)
    width = F.coalesce(F.col("next_value"), F.col("value")) - F.col("value")
    ref, ref_total = F.col("n_ref"), F.col("n_ref_total")
    ref_cdf = F.try_divide(F.col("n_ref_before") + ref, ref_total)

    def terms(cur: Column, cur_total: Column, b: str) -> dict[str, Column]:
        gap = F.abs(ref_cdf - F.try_divide(F.col(f"n_{b}_before") + cur, cur_total))
        levels = _level_terms(ref, cur, ref_total, cur_total, rule)
        return {**levels, "ks": F.max(gap), "wasserstein": F.sum(gap * width), "n_cur": F.max(cur_total)}

    return _per_batch(run, batches, terms, "numeric", rule)


def level_distances(counts: DataFrame, batches: Sequence[str], rule: DriftRule = DriftRule()) -> DataFrame:
    """All statistics of text columns, one row per (batch, column)."""
    measures = ["n_ref", *[f"n_{b}" for b in batches]]
    totals = counts.groupBy("column").agg(*[F.sum(m).alias(f"{m}_total") for m in measures])
    # One row per column of the schema.
    joined = counts.join(F.broadcast(totals), "column")
    ref, ref_total = F.col("n_ref"), F.col("n_ref_total")

    def terms(cur: Column, cur_total: Column, b: str) -> dict[str, Column]:
        nothing = F.max(F.lit(None).cast("double"))
        levels = _level_terms(ref, cur, ref_total, cur_total, rule)
        return {**levels, "ks": nothing, "wasserstein": nothing, "n_cur": F.max(cur_total)}

    return _per_batch(joined, batches, terms, "text", rule)


def reference_spread(counts: DataFrame) -> DataFrame:
    """(column, std): population standard deviation of the reference, from numeric value counts."""
    n, v = F.col("n_ref"), F.col("value")
    means = counts.groupBy("column").agg(F.try_divide(F.sum(n * v), F.sum(n)).alias("mean"))
    # One row per column of the schema.
    centred = counts.join(F.broadcast(means), "column")
    gap = v - F.col("mean")
    return centred.groupBy("column").agg(F.sqrt(F.try_divide(F.sum(n * gap * gap), F.sum(n))).alias("std"))


def choose_tests(stats: DataFrame, spread: DataFrame, tests: Mapping[str, str], rule: DriftRule = DriftRule()) -> DataFrame:
    """Score and verdict by each column's declared test: (batch, column, kind, method, score, threshold, drifted).

    Only the tests that are declared enter the plan, and the tail probabilities get no input from rows of other tests.
    """
    absent = (F.col("n_ref") == 0) | (F.col("n_cur") == 0)
    tested = stats.join(F.broadcast(spread), "column", "left").withColumn(
        "method", F.when(absent, NO_VALUES).otherwise(lookup(F.col("column"), tests))
    )

    def only(name: str, value: Column) -> Column:
        return F.when(F.col("method") == name, value.cast("double"))

    scores = {
        "ks": lambda: kolmogorov_tail(F.col("ks"), F.col("n_ref"), F.col("n_cur")),
        "ks_exact": lambda: kolmogorov_exact(only("ks_exact", F.col("ks")), F.col("n_ref"), F.col("n_cur")),
        "chi_square": lambda: chi_square_tail(only("chi_square", F.col("chi2")), only("chi_square", F.col("n_levels") - 1)),
        "z_test": lambda: F.when(F.col("n_levels") > 2, 0.0).otherwise(two_sided_normal_tail(only("z_test", F.col("z")))),
        "wasserstein": lambda: F.col("wasserstein") / F.greatest(F.col("std"), F.lit(rule.min_std)),
        "jensen_shannon": lambda: F.col("jensen_shannon"),
    }
    score = F.coalesce(F.lit(None).cast("double"), *[F.when(F.col("method") == name, scores[name]()) for name in sorted(set(tests.values()))])
    is_p = F.col("method").isin(*P_VALUES)
    scored = tested.withColumn("score", F.nanvl(score, F.lit(None).cast("double"))).withColumn(
        "threshold", F.when(is_p, F.lit(rule.p_threshold)).otherwise(F.lit(rule.distance_threshold))
    )
    one_sided = (F.col("n_ref") == 0) != (F.col("n_cur") == 0)
    drifted = F.when(F.col("method") == NO_VALUES, one_sided).when(is_p, F.col("score") < F.col("threshold")).otherwise(F.col("score") >= F.col("threshold"))
    return scored.select("batch", "column", "kind", "method", "score", "threshold", F.coalesce(drifted, F.lit(True)).alias("drifted"))


def _drift(
    reference: DataFrame, batches: DataFrame, frame: Column, names: Sequence[str], rule: DriftRule, skip: Sequence[str]
) -> DataFrame:
    numeric, text = column_types(reference, skip)
    kinds = [(c, "numeric") for c in numeric] + [(c, "text") for c in text]
    tests = {c: rule.test(c, k) for c, k in kinds}
    aliases = {f"b{i}": name for i, name in enumerate(names)}
    counts = written(value_counts(reference, batches, frame, aliases, numeric, text), "drift-counts")
    stats, spread = [], reference.sparkSession.createDataFrame([], "column string, std double")
    if numeric:
        stats.append(numeric_distances(numeric_counts(counts), list(aliases), rule))
        spread = reference_spread(numeric_counts(counts))
    if text:
        stats.append(level_distances(text_counts(counts), list(aliases), rule))
    chosen = choose_tests(reduce(DataFrame.unionByName, stats), spread, tests, rule)
    # A row for every column of the schema and every batch, also where neither side has a value.
    listed = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind")) for c, k in kinds])
    frames = F.array(*[F.lit(a) for a in aliases])
    every = reference.sparkSession.range(1).select(F.explode(listed).alias("c"), F.lit(0).alias("_")).select("c.*", F.explode(frames).alias("batch"))
    chosen = every.join(chosen.drop("kind"), ["batch", "column"], "left").select(
        "batch",
        "column",
        "kind",
        F.coalesce("method", F.lit(NO_VALUES)).alias("method"),
        "score",
        F.coalesce("threshold", F.lit(rule.distance_threshold)).alias("threshold"),
        F.coalesce("drifted", F.lit(False)).alias("drifted"),
    )
    return chosen.withColumn("batch", lookup(F.col("batch"), aliases))


def column_drift(
    reference: DataFrame, current: DataFrame, rule: DriftRule = DriftRule(), *, skip: Sequence[str] = (), batch: str = "current"
) -> DataFrame:
    """Drift of every column of one batch. The value counts are written once and read by all tests."""
    return _drift(reference, current, F.lit(batch), [batch], rule, skip)


def sweep_drift(
    reference: DataFrame,
    batches: DataFrame,
    names: Sequence[str],
    rule: DriftRule = DriftRule(),
    *,
    batch_column: str = "batch_name",
    skip: Sequence[str] = (),
) -> DataFrame:
    """Drift of every column for all batches of a sweep, from one count of the reference."""
    return _drift(reference, batches, F.col(batch_column), names, rule, skip)


def drift_summary(columns: DataFrame, rule: DriftRule = DriftRule()) -> DataFrame:
    """(batch_name, n_columns, n_drifted_columns, dataset_drift_share, dataset_drifted) per batch."""
    flag = F.col("drifted").cast("int")
    return columns.groupBy(F.col("batch").alias("batch_name")).agg(
        F.count("*").alias("n_columns"),
        F.sum(flag).cast("bigint").alias("n_drifted_columns"),
        F.avg(flag).alias("dataset_drift_share"),
        (F.avg(flag) >= rule.drift_share).alias("dataset_drifted"),
    )
