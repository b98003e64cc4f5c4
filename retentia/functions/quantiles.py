"""Exact quantiles by rank selection, without ordering the data.

A quantile needs one or two ranks of its column. The first pass takes each column's count, minimum and maximum; every
further pass counts the rows of 4096 equal bins between them and goes on with the bins that hold a wanted rank. A bin is known
by its own smallest and largest value, so the filter of the next pass is exact, and each pass parts a bin's ends. Once
a bin holds few rows or a single value, its values are counted and the rank is read off.

Every pass is one aggregation with partial results on the map side. The driver sees bin counts only, a bounded number
for each bin that goes on; columns by groups beyond ``SPANS`` are left to the distributed running sums instead.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentia.functions.ordered import exact_quantiles

BINS = 4096
SPANS = 256  # (group, column) pairs that are selected on side by side
ROWS = 200_000  # values that the last pass may bring to the driver, over all bins
PASSES = 8  # more only where each pass parts off few values; then the running sums take over


@dataclass(frozen=True)
class _Span:
    """The rows of a (group, column) with values from ``low`` to ``high``: ``n`` rows, ``below`` smaller ones."""

    group: tuple
    column: str
    low: float
    high: float
    below: int
    n: int

    @property
    def key(self) -> tuple:
        return self.group, self.column

    def holds(self, rank: int) -> bool:
        return self.below <= rank < self.below + self.n


def clean(column: str) -> Column:
    """The column as a double, missing where it is not a number."""
    name = column.replace("`", "``")
    return F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None).cast("double"))


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value) for every value that is not missing, of groups that are not null."""
    entries = [F.struct(F.lit(c).alias("column"), clean(c).alias("value")) for c in columns]
    rows = df.select(*by, F.explode(F.array(*entries)).alias("e")).select(*by, "e.column", "e.value").where("value IS NOT NULL")
    for key in by:
        rows = rows.where(F.col(key).isNotNull())
    return rows


def _bin(low: Column, high: Column, bins: int) -> Column:
    """A bin number that never falls as the value grows; infinite values have bins of their own."""
    value, infinity = F.col("value"), F.lit(math.inf)
    # The halves don't overflow where the difference does.
    wide = (high - low) == infinity
    share = F.when(wide, F.try_divide(value / 2 - low / 2, high / 2 - low / 2)).otherwise(F.try_divide(value - low, high - low))
    inside = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    return F.when(value == -infinity, F.lit(-1)).when(value == infinity, F.lit(bins)).otherwise(inside)


def _matched(long: DataFrame, by: Sequence[str], spans: Sequence[_Span]) -> DataFrame:
    """The rows of the spans, with the span's place in the list and its finite ends."""
    largest = math.nextafter(math.inf, 0)
    rows = [(*s.group, s.column, i, s.low, s.high, max(s.low, -largest), min(s.high, largest)) for i, s in enumerate(spans)]
    fields = [long.schema[k] for k in (*by, "column")] + [T.StructField("span", T.IntegerType())]
    fields += [T.StructField(n, T.DoubleType()) for n in ("low", "high", "first", "last")]
    table = F.broadcast(long.sparkSession.createDataFrame(rows, T.StructType(fields)))  # a row per span
    return long.join(table, [*by, "column"]).where(F.col("value").between(F.col("low"), F.col("high")))


def _first_spans(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> list[_Span] | None:
    """One span per group and column that has values; None where there are too many."""
    kept = df
    for key in by:
        kept = kept.where(F.col(key).isNotNull())
    stats = [F.struct(F.count(clean(c)), F.min(clean(c)), F.max(clean(c))).alias(f"c{i}") for i, c in enumerate(columns)]
    most = max(1, SPANS // max(1, len(columns)))
    rows = kept.groupBy(*by).agg(*stats).limit(most + 1).collect()
    if len(rows) > most:
        return None
    spans = []
    for r in rows:
        for i, c in enumerate(columns):
            n, low, high = r[f"c{i}"]
            if n:
                spans.append(_Span(tuple(r[k] for k in by), c, low, high, 0, n))
    return spans


def _parted(long: DataFrame, by: Sequence[str], spans: Sequence[_Span]) -> list[_Span]:
    """The bins of the spans, each with its count and ends."""
    number = max(64, min(BINS, ROWS // len(spans)))
    bins = _matched(long, by, spans).withColumn("bin", _bin(F.col("first"), F.col("last"), number)).groupBy("span", "bin")
    rows = bins.agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
    out, below = [], {}
    for r in sorted(rows, key=lambda r: (r["span"], r["bin"])):
        whole = spans[r["span"]]
        start = below.get(r["span"], whole.below)
        out.append(_Span(whole.group, whole.column, r["low"], r["high"], start, r["n"]))
        below[r["span"]] = start + r["n"]
    return out


def selected_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """(by..., column, one column per probability): exact, at position p * (n - 1) with linear interpolation.

    Missing values and null groups don't count; a column without values in a group has no row.
    """
    by, columns = list(by), list(columns)
    fields = [df.schema[k] for k in by] + [T.StructField("column", T.StringType())] + [T.StructField(p, T.DoubleType()) for p in probabilities]
    spans = _first_spans(df, columns, by)
    long = long_values(df, columns, by)
    if spans is None:
        return _by_running_sums(long, by, probabilities)
    positions = {s.key: {p: q * (s.n - 1) for p, q in probabilities.items()} for s in spans}
    wanted = {k: {r for x in own.values() for r in (math.floor(x), math.ceil(x))} for k, own in positions.items()}
    values: dict[tuple, float] = {}
    for _ in range(PASSES):
        hits = [(s, [r for r in wanted[s.key] if s.holds(r)]) for s in spans]
        values |= {(s.key, r): s.low for s, ranks in hits if s.low == s.high for r in ranks}
        open_ = [s for s, ranks in hits if ranks and s.low != s.high]
        if open_ and max(s.n for s in open_) <= ROWS // len(open_):
            values |= _read(long, by, open_, wanted)
            open_ = []
        if not open_:
            break
        spans = _parted(long, by, open_)
    else:
        return _by_running_sums(long, by, probabilities)
    rows = []
    for key, own in positions.items():
        ends = [(values[key, math.floor(x)], values[key, math.ceil(x)], x - math.floor(x)) for x in own.values()]
        rows.append((*key[0], key[1], *[a + (b - a) * part if part else a for a, b, part in ends]))
    return df.sparkSession.createDataFrame(rows, T.StructType(fields))


def _read(long: DataFrame, by: Sequence[str], spans: Sequence[_Span], wanted: Mapping[tuple, set[int]]) -> dict[tuple, float]:
    """The values at the wanted ranks inside spans of few rows."""
    counts = _matched(long, by, spans).groupBy("span", "value").agg(F.count(F.lit(1)).alias("n")).collect()
    out, below = {}, {}
    for r in sorted(counts, key=lambda r: (r["span"], r["value"])):
        s = spans[r["span"]]
        start = below.get(r["span"], s.below)
        below[r["span"]] = start + r["n"]
        out |= {(s.key, rank): r["value"] for rank in wanted[s.key] if start <= rank < start + r["n"]}
    return out


def _by_running_sums(long: DataFrame, by: Sequence[str], probabilities: Mapping[str, float]) -> DataFrame:
    counts = long.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    return exact_quantiles(counts, [*by, "column"], "value", "n", dict(probabilities), bounded_keys=not by)
