"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target / source size. The expected copies
are prefix-summed within the source, one random offset is added, and a document is emitted once for each whole
number its stretch of the sum crosses. Documents stand in order of size (slices of about 1 %), so what a source
gives differs from its target by a few documents at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentia.llm.common import draw, fresh, word_count

OFFSET_STEPS = 1024  # a power of two, so that offset + whole number is exact in a double
HASH_SLICES = 256  # a size slice of a source is cut so many times more: equal sizes don't meet in one task


def source_targets(sizes: DataFrame, source: str, size: str, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``sizes`` (one row per source) with ``target``.

    Sources by name, null last, take the weights in turn and share the whole size by them. A target stops at
    ``cap`` times its source's size; what is cut off is shared again by weight among the others. Sources sorted
    by cap / weight reach their cap in that order, so running sums give the final level at once. The windows
    are over one row per source.
    """
    if cap < 1 or not weights or min(weights) < 1:
        raise ValueError("weights are positive and the cap is 1 at least")
    number = F.row_number().over(Window.orderBy(F.col(source).isNull(), F.col(source)))
    weight = F.get(F.array(*[F.lit(int(w)) for w in weights]), (number - 1) % len(weights)).cast("bigint")
    most = F.col(size) * F.lit(cap)
    weighed = sizes.withColumn("_weight", weight).withColumn("_most", most)
    order = Window.orderBy(F.col("_most").cast("double") / F.col("_weight"), F.col(source).isNull(), F.col(source))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum(size).over(whole) - F.coalesce(F.sum("_most").over(before), F.lit(0))
    weights_left = F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    levels = weighed.withColumn("_level", left.cast("double") / weights_left)
    capped = F.col("_most").cast("double") / F.col("_weight") < F.col("_level")
    levels = levels.withColumn("_capped", capped)
    # The level falls after the first source below its cap, and that one sets the level of all that follow.
    level = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(whole)
    target = F.when(F.col("_capped"), F.col("_most").cast("double")).otherwise(F.col("_weight") * level)
    return levels.withColumn("target", target).drop("_weight", "_most", "_level", "_capped")


def _size_slice(size: Column) -> Column:
    """Grows with the size; neighbours differ by 1 % or less."""
    digits = F.length(F.bin(size))
    return digits * 128 + F.call_function("shiftright", size, F.greatest(digits - 7, F.lit(0))).cast("int")


def mix_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    cap: int = 3,
    seed: int = 0,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(key, size, source_size, target, copies, *keep): how often the mix takes each document.

    A column of ``keep`` that has the name of another result column, the key among them, is returned as ``kept_<name>``. Texts of any length count in full.
    Size is the number of words. Null texts have size 0; a source that is null counts as one more source, the
    last. Repeated rows are documents of their own; ties in size stand in order of a hash of the key. No
    document is taken more than ``cap`` times. The same rows give the same mix whatever the partitioning. A
    source whose texts are all empty has target 0 and gives nothing. An empty table gives an empty mix.
    """
    rows = docs.select(
        F.col(key).alias("_key"),
        F.col(source).alias("_source"),
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")).alias("_part"),
        word_count(F.col(text)).alias("_size"),
        draw(seed, "mix", F.col(key)).alias("_hash"),
        *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)],
    )
    rows = rows.withColumn("_slice", _size_slice(F.col("_size"))).withColumn("_cell", F.pmod(F.col("_hash"), F.lit(HASH_SLICES)).cast("int"))
    cells = rows.groupBy("_part", "_source", "_slice", "_cell").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_words"))
    in_source = Window.partitionBy("_part").orderBy("_slice", "_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("_before", F.coalesce(F.sum("_n").over(in_source), F.lit(0)))
    sources = cells.groupBy("_part", "_source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sources, "_source", "source_size", weights, cap).drop("_source")
    offsets = offsets.join(targets, "_part").drop("_source", "_n", "_words")
    placed = rows.join(offsets, ["_part", "_slice", "_cell"])
    in_cell = Window.partitionBy("_part", "_slice", "_cell").orderBy("_size", "_hash", "_key")
    rank = F.col("_before") + F.row_number().over(in_cell)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = F.pmod(draw(seed, "offset", F.col("_part")), F.lit(OFFSET_STEPS)).cast("double") / OFFSET_STEPS
    placed = placed.withColumn("_rank", rank).withColumn("_rate", rate).withColumn("_start", start)
    crossed = F.floor(F.col("_start") + F.col("_rank") * F.col("_rate")) - F.floor(F.col("_start") + (F.col("_rank") - 1) * F.col("_rate"))
    taken = {key.lower(), "size", "source_size", "target", "copies"}
    return placed.select(
        F.col("_key").alias(key),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        F.least(crossed, F.lit(cap)).cast("bigint").alias("copies"),
        *[F.col(f"_keep{i}").alias(f"kept_{c}" if c.lower() in taken else c) for i, c in enumerate(keep)],
    )


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed rows with all columns of ``docs``: each document as many times as it is taken."""
    counted = mix_counts(docs.select("*", F.struct("*").alias(row := fresh(docs, "_row"))), keep=[row], **settings)
    emitted = counted.where(F.col("copies") > 0).select(row, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return emitted.select(f"{row}.*")
