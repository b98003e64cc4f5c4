"""Drift of any number of batches against one reference, in one plan whose size does not depend on them.

The batch is a key of the rows, not a column of the plan. Counts are sparse: a batch is represented by the values that it has,
and what the reference alone has enters in closed form:

* Levels. Those that a batch lacks add ``share * log 2`` to the divergence, their expected count to chi-square and their
  share to the pooled difference, so the sum of the reference's counts over the batch's own levels is enough.
* Kolmogorov-Smirnov. Between two values of a batch its distribution is flat and the reference's rises, so the largest gap stands
  at a value of the batch or just before one.
* Wasserstein. The area between two values of a batch follows from the reference's integrated distribution at both ends,
  and at the point where the reference crosses the batch's level. That point is a rank of the reference.

The reference's running sums are taken once for all batches. ``ReferenceCounts`` are stored, so later batches, as those of a
stream, don't read the reference again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentia.functions.ordered import holding, running_sums
from retentia.operators.drift import NO_VALUES, DriftRule, choose_tests, long_values
from retentia.operators.features import column_types
from retentia.session import written

OTHER = "(other levels)"


@dataclass(frozen=True)
class ReferenceCounts:
    """The stored value counts of a reference: ``counts`` has (column, num, txt, n_ref)."""

    counts: DataFrame
    numeric: tuple[str, ...]
    text: tuple[str, ...]
    top_levels: int | None = None


def reference_counts(reference: DataFrame, *, skip: Sequence[str] = (), top_levels: int | None = None) -> ReferenceCounts:
    """Count the reference once. With ``top_levels``, a text column keeps its most frequent levels and pools the others.

    The pooled level stands for every level outside the reference's top, in the reference and in all batches.
    """
    numeric, text = column_types(reference, skip)
    rows = long_values(reference, numeric, text, F.lit(None).cast("string"))
    counts = rows.groupBy("column", "num", "txt").agg(F.count("*").alias("n_ref"))
    if top_levels is not None:
        stored = written(counts, "reference-levels")
        kept = _top(stored, top_levels)
        counts = _pooled(stored, kept).groupBy("column", "num", "txt").agg(F.sum("n_ref").alias("n_ref"))
    return ReferenceCounts(written(counts, "reference-counts"), tuple(numeric), tuple(text), top_levels)


def _top(counts: DataFrame, k: int) -> DataFrame:
    """(column, txt) of the k most frequent levels per text column, by name on ties. Each task sends k rows per column at most."""
    order = Window.partitionBy("column").orderBy(F.desc("n_ref"), "txt")
    ranked = counts.where(F.col("txt").isNotNull()).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
    return ranked.select("column", "txt", F.lit(True).alias("_kept"))


def _pooled(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Text values outside ``kept`` become one level."""
    joined = rows.join(kept, ["column", "txt"], "left")
    pooled = F.when(F.col("txt").isNotNull() & F.col("_kept").isNull(), F.lit(OTHER)).otherwise(F.col("txt"))
    return joined.withColumn("txt", pooled).drop("_kept").select(*rows.columns)


def batch_counts(batches: DataFrame, batch: Column, reference: ReferenceCounts) -> DataFrame:
    """(batch, column, num, txt, n) of all batches, counted per task before anything is shuffled. Rows without a batch don't count."""
    rows = long_values(batches.where(batch.isNotNull()), list(reference.numeric), list(reference.text), batch.cast("string"))
    counts = rows.withColumnRenamed("frame", "batch").groupBy("batch", "column", "num", "txt").agg(F.count("*").alias("n"))
    if reference.top_levels is None:
        return written(counts, "batch-counts")
    levels = reference.counts.where(F.col("txt").isNotNull() & (F.col("txt") != OTHER)).select("column", "txt", F.lit(True).alias("_kept"))
    pooled = _pooled(counts, levels).groupBy("batch", "column", "num", "txt").agg(F.sum("n").alias("n"))
    return written(pooled, "batch-counts")


def _totals(reference: ReferenceCounts) -> DataFrame:
    """A row per column that has values: (column, n_ref_total, n_ref_values, mean, std)."""
    n, v = F.col("n_ref"), F.col("num")
    sums = reference.counts.groupBy("column").agg(
        F.sum(n).alias("n_ref_total"), F.count("*").alias("n_ref_values"), F.try_divide(F.sum(n * v), F.sum(n)).alias("mean")
    )
    gap = v - F.col("mean")
    spread = reference.counts.join(F.broadcast(sums.select("column", "mean")), "column").groupBy("column")
    spread = spread.agg(F.sqrt(F.try_divide(F.sum(n * gap * gap), F.sum(n))).alias("std"))
    return written(sums.join(F.broadcast(spread), "column"), "reference-totals")


def _level_aggregates(rule: DriftRule) -> list[Column]:
    """Sums over the levels that a batch has, completed for those that the reference alone has."""
    ref, cur = F.col("n_ref"), F.col("n")
    ref_total, cur_total = F.col("n_ref_total").cast("double"), F.col("n_total").cast("double")
    p, q = F.try_divide(ref, ref_total), F.try_divide(cur, cur_total)
    log2 = F.ln(F.lit(2.0)) / F.ln(F.lit(rule.log_base))

    def xlog(x: Column) -> Column:
        return F.when(x > 0, x * (F.ln(2 * x / (p + q)) / F.ln(F.lit(rule.log_base)))).otherwise(F.lit(0.0))

    expected = p * cur_total
    first = lambda c: F.max(c)  # noqa: E731  (constant within a batch and column)
    absent = (first(F.col("n_ref_total")) - F.sum(ref)).cast("double")
    share = F.coalesce(F.try_divide(absent, first(ref_total)), F.lit(0.0))
    chi2 = F.sum(F.when(expected > 0, (cur - expected) * (cur - expected) / expected).otherwise(F.lit(float("inf"))))
    gap = F.sum((p - q) * (p - q) * (ref_total + cur_total) / (ref + cur))
    return [
        first(F.col("n_ref_total")).alias("n_ref"),
        first(F.col("n_total")).alias("n_cur"),
        first(F.col("n_ref_values")).alias("n_ref_values"),
        (F.sum(xlog(p) + xlog(q)) + share * log2).alias("js"),
        (chi2 + share * first(cur_total)).alias("chi2"),
        (first(F.col("n_ref_values")) + F.count(F.when(ref == 0, 1))).alias("n_levels"),
        (gap + F.coalesce(F.try_divide((first(ref_total) + first(cur_total)) * absent, first(ref_total) * first(ref_total)), F.lit(0.0))).alias("gap"),
    ]


def _statistics(sums: DataFrame, kind: str) -> DataFrame:
    n1, n2 = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    return sums.select(
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


def _text_statistics(counts: DataFrame, reference: ReferenceCounts, totals: DataFrame, rule: DriftRule) -> DataFrame:
    own = counts.where(F.col("txt").isNotNull()).select("batch", "column", "txt", "n")
    sizes = own.groupBy("batch", "column").agg(F.sum("n").alias("n_total"))
    known = reference.counts.where(F.col("txt").isNotNull()).select("column", "txt", "n_ref")
    rows = own.join(known, ["column", "txt"], "left").join(sizes, ["batch", "column"]).join(F.broadcast(totals), "column", "left")
    rows = rows.fillna(0, ["n_ref", "n_ref_total", "n_ref_values"])
    nothing = F.max(F.lit(None).cast("double"))
    return _statistics(rows.groupBy("batch", "column").agg(*_level_aggregates(rule), nothing.alias("ks"), nothing.alias("wasserstein")), "text")


def _numeric_statistics(counts: DataFrame, reference: ReferenceCounts, totals: DataFrame, rule: DriftRule) -> DataFrame:
    own = counts.where(F.col("num").isNotNull()).select("batch", "column", F.col("num").alias("value"), "n")
    known = reference.counts.where(F.col("num").isNotNull()).select("column", F.col("num").alias("value"), "n_ref")
    # The reference's running sums at its own values and at those of all batches: moments are taken around its mean.
    seen = own.select("column", "value").distinct().withColumn("n_ref", F.lit(0).cast("bigint"))
    points = known.unionByName(seen).groupBy("column", "value").agg(F.sum("n_ref").alias("n_ref"))
    small = F.broadcast(totals.select("column", "mean"))  # a row per column
    points = points.join(small, "column", "left").select(
        "column", "value", "n_ref", (F.col("n_ref") * (F.col("value") - F.coalesce("mean", F.lit(0.0)))).alias("m_ref"), F.lit(1).alias("here")
    )
    sums = running_sums(points, ["column"], "value", ["n_ref", "m_ref", "here"], bounded_keys=True)
    sums = sums.join(small, "column", "left")
    off = F.col("value") - F.coalesce("mean", F.lit(0.0))
    curve = written(
        sums.select(
            "column",
            "value",
            "n_ref",
            F.col("n_ref_before").alias("below"),
            # The integral of the reference's counts up to the value, and that of the counts above it from the value on.
            (off * F.col("n_ref_before") - F.col("m_ref_before")).alias("area"),
            (F.col("m_ref_total") - F.col("m_ref_before") - F.col("m_ref") - off * (F.col("n_ref_total") - F.col("n_ref_before") - F.col("n_ref"))).alias("rest"),
        ),
        "reference-curve",
    )
    steps = running_sums(own, ["batch", "column"], "value", ["n"], with_next=True)
    following = curve.select("column", F.col("value").alias("next_value"), F.col("below").alias("next_below"), F.col("area").alias("next_area"))
    rows = steps.join(curve, ["column", "value"]).join(following, ["column", "next_value"], "left")
    rows = rows.join(F.broadcast(totals.select("column", "n_ref_total", "n_ref_values")), "column", "left").fillna(0, ["n_ref_total", "n_ref_values"])
    # The rank of the reference at which its distribution reaches the batch's: cumulative counts as decimals, whose products are exact.
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    upto = (F.col("n_before") + F.col("n")).cast("decimal(19,0)")
    rows = rows.withColumns({"_want": upto * whole("n_ref_total"), "_size": whole("n_total")})
    rows = written(rows.withColumn("rank", F.expr("(_want + _size - 1) div _size")).drop("_want", "_size"), "batch-steps")
    crossed = F.col("next_value").isNotNull() & (F.col("below") + F.col("n_ref") < F.col("rank")) & (F.col("rank") <= F.col("next_below"))
    asked = rows.where(crossed).select("batch", "column", "value", (F.col("rank") - 1).alias("place"), F.expr("1 + n_ref_total div 4096").alias("w"))
    spans = curve.where("n_ref > 0").select("column", "below", F.col("n_ref").alias("n"), F.col("value").alias("turn"), F.col("area").alias("turn_area"))
    spans = spans.join(F.broadcast(totals.select("column", F.expr("1 + n_ref_total div 4096").alias("w"))), "column")
    turns = holding(asked, spans, ["column"], "place", "w", ["turn", "turn_area"]).select("batch", "column", "value", "turn", "turn_area")
    rows = rows.join(turns, ["batch", "column", "value"], "left")

    ref_total, cur_total = F.col("n_ref_total").cast("double"), F.col("n_total").cast("double")
    level = upto.cast("double") / cur_total
    at, before = F.try_divide(F.col("below") + F.col("n_ref"), ref_total), F.try_divide(F.col("below"), ref_total)
    gap = F.greatest(F.abs(at - level), F.abs(before - F.col("n_before") / cur_total))

    def area(low: Column, low_area: Column, high: Column, high_area: Column) -> Column:
        """The signed area between the reference's distribution and the batch's level."""
        return F.try_divide(high_area - low_area, ref_total) - level * (high - low)

    value, after = F.col("value"), F.col("next_value")
    straight = F.abs(area(value, F.col("area"), after, F.col("next_area")))
    bent = F.abs(area(value, F.col("area"), F.col("turn"), F.col("turn_area"))) + F.abs(area(F.col("turn"), F.col("turn_area"), after, F.col("next_area")))
    inner = F.when(after.isNull(), F.try_divide(F.col("rest"), ref_total)).when(F.col("turn").isNotNull(), bent).otherwise(straight)
    outer = F.when(F.col("n_before") == 0, F.try_divide(F.col("area"), ref_total)).otherwise(F.lit(0.0))
    sums = rows.groupBy("batch", "column").agg(*_level_aggregates(rule), F.max(gap).alias("ks"), F.sum(inner + outer).alias("wasserstein"))
    return _statistics(sums, "numeric")


def many_drift(
    reference: ReferenceCounts, batches: DataFrame, batch: Column | str, rule: DriftRule = DriftRule()
) -> DataFrame:
    """(batch, column, kind, method, score, threshold, drifted) for every batch and every column of the reference.

    The same tests and the same rules for missing values as for a single batch. ``batch`` names a row's batch; rows without
    one are left out.
    """
    batch = F.col(batch) if isinstance(batch, str) else batch
    kinds = [(c, "numeric") for c in reference.numeric] + [(c, "text") for c in reference.text]
    tests = {c: rule.test(c, k) for c, k in kinds}
    named = batches.where(batch.isNotNull()).select(batch.cast("string").alias("batch")).distinct()
    counts = batch_counts(batches, batch, reference)
    totals = _totals(reference)
    stats = []
    if reference.numeric:
        stats.append(_numeric_statistics(counts, reference, totals, rule))
    if reference.text:
        stats.append(_text_statistics(counts, reference, totals, rule))
    chosen = choose_tests(reduce(DataFrame.unionByName, stats), totals.select("column", "std"), tests, rule)
    listed = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind")) for c, k in kinds]))
    every = named.select("batch", listed.alias("c")).select("batch", "c.*")
    # A column that the batch lacks has no row above; it drifted if the reference has values of it.
    one_sided = F.coalesce(F.col("n_ref_total") > 0, F.lit(False))
    done = every.join(chosen.drop("kind"), ["batch", "column"], "left").join(F.broadcast(totals.select("column", "n_ref_total")), "column", "left")
    return done.select(
        "batch",
        "column",
        "kind",
        F.coalesce("method", F.lit(NO_VALUES)).alias("method"),
        "score",
        F.coalesce("threshold", F.lit(rule.distance_threshold)).alias("threshold"),
        F.coalesce("drifted", one_sided).alias("drifted"),
    )
