"""Running sums over an order, spread over many tasks.

A plain ``Window.partitionBy(key).orderBy(value)`` puts each key on one task, and a metric over the
whole table has one key. Here each key's values are cut into ranges first. Their number follows the
session's shuffle partitions. The cuts come from a sample picked by hash, so they are the same on every run and never change a result; they only decide
how the work is spread. Each range then needs one offset (a few rows per key) plus a window inside
the range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LEAST_RANGES = 256


def default_ranges(spark: SparkSession) -> int:
    """A power of two, no less than the session's shuffle partitions, so that one key can use all of them."""
    return 1 << (max(LEAST_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions"))) - 1).bit_length()


def range_cuts(counts: DataFrame, keys: Sequence[str], value: str, ranges: int) -> DataFrame:
    """Up to ``ranges`` sorted sample values per key, as an array column ``cuts``.

    One value per hash cell (the one with the smallest second hash): a mergeable, order-free sample
    of the distinct values whose size is bounded by ``ranges`` whatever the input holds.
    """
    cell = F.pmod(F.xxhash64(F.col(value)), F.lit(ranges))
    # min_by keeps two plain numbers per cell and so hashes; a minimum of structs would sort.
    pick = F.min_by(F.col(value), F.xxhash64(F.col(value), F.lit(1)))
    picked = counts.groupBy(*keys, cell.alias("cell")).agg(pick.alias("pick"))
    return picked.groupBy(*keys).agg(F.array_sort(F.collect_list("pick")).alias("cuts"))


def with_range(df: DataFrame, value: str, cuts: str, ranges: int, column: str) -> DataFrame:
    """Add how many of the first ``ranges - 1`` sorted cuts are <= ``value``, by binary search.

    Each step is a projection of its own, so that a step's result is computed once and not inlined
    into the next one; all of them run inside one generated stage.
    """
    if ranges < 1 or ranges & (ranges - 1):
        raise ValueError("ranges must be a power of two")
    out = df.withColumn(column, F.lit(0))
    step = ranges // 2
    while step:
        # Past the end of a shorter array the lookup is null and the step is not taken.
        probe = F.get(F.col(cuts), F.col(column) + F.lit(step - 1))
        out = out.withColumn(column, F.col(column) + F.when(probe <= F.col(value), F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    return out


def running_sums(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    measures: Sequence[str],
    *,
    ranges: int | None = None,
    bounded_keys: bool = False,
    with_next: bool = False,
) -> DataFrame:
    """Add ``<m>_before`` (sum over smaller values) and ``<m>_total`` per key for every measure.

    ``counts`` holds one row per (keys, value), already aggregated, with no null in ``keys`` or
    ``value`` and otherwise only non-negative numbers of which at least one is positive. ``with_next`` adds
    ``next_value``, the following value of the same key.
    ``bounded_keys`` states that the number of keys is fixed by a schema or a config; only then are
    the cut and offset tables hinted as broadcasts. Otherwise the join is left to the optimizer,
    which broadcasts on measured size and splits skewed partitions beyond it.
    """
    keys, ranges = list(keys), ranges or default_ranges(counts.sparkSession)
    small = F.broadcast if bounded_keys else (lambda frame: frame)
    # The filter keeps every row. It makes all three readers of `counts` ask for the same columns,
    # so that they share one shuffled copy instead of reading the input three times.
    carried = [c for c in counts.columns if c not in (*keys, value)]
    counts = counts.where(F.greatest(*[F.col(c) for c in carried], F.lit(0)) > 0)
    cuts = range_cuts(counts, keys, value, ranges)
    if keys:
        beside_cuts = counts.join(small(cuts), keys)
    else:
        # One row of cuts: a subquery instead of a join without keys. At most `ranges` offsets follow.
        beside_cuts, small = counts.withColumn("cuts", cuts.scalar()), F.broadcast
    ranged = with_range(beside_cuts, value, "cuts", ranges, "_range").drop("cuts")

    per_range = ranged.groupBy(*keys, "_range").agg(
        *[F.sum(m).alias(m) for m in measures], F.min(value).alias("_first")
    )
    per_key = Window.partitionBy(*(keys or [F.lit(0)]))  # over at most `ranges` rows per key
    by_range = per_key.orderBy("_range")
    before = by_range.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_{m}_offset") for m in measures],
        *[F.sum(m).over(per_key).alias(f"{m}_total") for m in measures],
        *([F.lead("_first").over(by_range).alias("_next_first")] if with_next else []),
    )

    in_range = Window.partitionBy(*keys, "_range").orderBy(value)
    in_before = in_range.rowsBetween(Window.unboundedPreceding, -1)
    joined = ranged.join(small(offsets), [*keys, "_range"])
    return joined.select(
        *counts.columns,
        *[
            (F.col(f"_{m}_offset") + F.coalesce(F.sum(m).over(in_before), F.lit(0))).alias(f"{m}_before")
            for m in measures
        ],
        *[F.col(f"{m}_total") for m in measures],
        *(
            [F.coalesce(F.lead(value).over(in_range), F.col("_next_first")).alias("next_value")]
            if with_next
            else []
        ),
    )


def holding(points: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, width: str, payload: Sequence[str]) -> DataFrame:
    """``points`` with the ``payload`` of the span that holds them.

    Spans of a group (``keys``) are (``below``, ``n``, payload): they lie side by side from 0 on and hold n places each. Both
    sides have a column ``width`` that cuts a group's places into blocks. A span stands once in every block it reaches, and
    within a block a point takes the last span that starts before it. So a span of any size is spread over its blocks, and
    neither side compares pairs.
    """
    payload_kind = spans.select(F.struct(*payload).alias("s")).schema["s"].dataType
    asked = points.withColumn("_point", F.struct(*points.columns))
    point_kind = asked.schema["_point"].dataType
    asked = asked.select(*keys, F.expr(f"{at} div {width}").alias("_block"), F.col(at).cast("bigint").alias("_at"), F.lit(None).cast(payload_kind).alias("_span"), "_point")
    reached = F.explode(F.sequence(F.expr(f"below div {width}"), F.expr(f"(below + n - 1) div {width}")))
    starts = spans.select(*keys, reached.alias("_block"), F.col("below").alias("_at"), F.struct(*payload).alias("_span"), F.lit(None).cast(point_kind).alias("_point"))
    both = starts.unionByName(asked)
    in_block = Window.partitionBy(*keys, "_block").orderBy("_at", F.col("_point").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_span", F.last("_span", ignorenulls=True).over(in_block)).where(F.col("_point").isNotNull())
    return found.select("_point.*", *[F.col(f"_span.{p}") for p in payload])


def exact_quantiles(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    n: str,
    probabilities: dict[str, float],
    *,
    bounded_keys: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per key from (keys, value, n) counts, one column per name.

    Position ``p * (N - 1)`` with linear interpolation between its two neighbours. The exact
    ``percentile`` aggregate gives the same number but keeps every distinct value of a key in one
    task's buffer.
    """
    run = running_sums(counts, keys, value, [n], ranges=ranges, bounded_keys=bounded_keys)
    total, below = F.col(f"{n}_total"), F.col(f"{n}_before")
    upto = below + F.col(n)

    def at(rank: Column) -> Column:
        return F.max(F.when((below <= rank) & (rank < upto), F.col(value)))

    aggs = []
    for name, p in probabilities.items():
        position = F.lit(float(p)) * (total - 1)
        low, high = F.floor(position), F.ceil(position)
        aggs += [
            at(low).alias(f"_{name}_lo"),
            at(high).alias(f"_{name}_hi"),
            F.max(position - low).alias(f"_{name}_frac"),
        ]
    grouped = run.groupBy(*keys).agg(*aggs)
    return grouped.select(
        *keys,
        *[
            (
                F.col(f"_{name}_lo")
                + (F.col(f"_{name}_hi") - F.col(f"_{name}_lo")) * F.col(f"_{name}_frac")
            ).alias(name)
            for name in probabilities
        ],
    )
