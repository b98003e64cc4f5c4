"""Exact stratified splits and folds, exact-size bootstraps, and drifted what-if batches.

Order is by a hash of the row key, so results depend on neither partitioning nor engine. Exact sizes
come from counts per hash slice plus a ranking inside the few slices where a cut falls; the wide rows
are never shuffled for it.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from hashlib import md5
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentia.functions.hashing import HASH_BITS, hash_bucket, hash_key, uniform
from retentia.functions.ordered import holding, running_sums
from retentia.functions.scalars import batch_name, lower_clip
from retentia.session import written

DEFAULT_SLICES = 4096
BOOTSTRAP_SLICES = 1 << 14
FEW_DRAWS = 100_000  # draws that are dealt to their slices on the driver
FEW_LEVELS = 10_000  # levels whose shares are summed up on the driver; the sums of more are spread over ranges
MOST_BLOCKS = 1 << 20  # of a reweight's intervals


def _stratum(label: str) -> Column:
    """The class as text; rows without a label are a class of their own."""
    return F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("null"))


def _rank_cuts(keyed: DataFrame, stratum: str, targets: DataFrame, slices: int) -> DataFrame:
    """The (h, id) at each wanted 1-based rank within its stratum.

    ``keyed`` has (stratum, h, id); ``targets`` has (stratum, cut, target_rank). The slice counts have ``slices`` rows per class, the
    result one row per class and cut. Both are stored, so the joins with them are planned by their real size.
    """
    sliced = keyed.withColumn("slice", hash_bucket("h", slices))
    counts = sliced.groupBy(stratum, "slice").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(stratum).orderBy("slice"))
    offsets = counts.select(stratum, "slice", (upto - F.col("n")).alias("below"), upto.alias("upto"))
    hit = (F.col("below") < F.col("target_rank")) & (F.col("target_rank") <= F.col("upto"))
    wanted = offsets.join(targets, stratum).where(hit)
    wanted = written(wanted.select(stratum, "slice", "cut", (F.col("target_rank") - F.col("below")).alias("rank")), "wanted-ranks")
    in_slice = Window.partitionBy(stratum, "slice").orderBy("h", "id")
    # Only the slices with a cut get past this join and into the window.
    inside = sliced.join(wanted.select(stratum, "slice").distinct(), [stratum, "slice"])
    ranked = inside.withColumn("rank", F.row_number().over(in_slice).cast("bigint"))
    return written(ranked.join(wanted, [stratum, "slice", "rank"]).select(stratum, "cut", "h", "id"), "cuts")


def train_quotas(df: DataFrame, label: str, test_size: float) -> DataFrame:
    """(label, n, n_train): the test side has ceil(test_size * N) rows, classes by largest remainder."""
    return quotas_of(df.groupBy(label).agg(F.count("*").alias("n")), label, test_size)


def quotas_of(counts: DataFrame, label: str, test_size: float) -> DataFrame:
    """The same from (label, n), one row per class."""
    # The windows below run over one row per class.
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(everything)
    n_train = (total - F.ceil(total * F.lit(test_size))).cast("bigint")
    # The product of two counts exceeds a long; as a decimal it is exact, and so are quotient and rest.
    product = F.col("n").cast("decimal(19,0)") * n_train.cast("decimal(19,0)")
    whole = total.cast("decimal(19,0)")
    base = counts.select(label, "n", n_train.alias("want"), product.alias("product"), whole.alias("whole")).select(
        label, "n", "want", F.expr("product div whole").alias("floor"), F.expr("product % whole").alias("rest")
    )
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("rest"), label)
    spare = F.col("want") - F.sum("floor").over(everything)
    return base.withColumns({"spare": spare, "place": F.row_number().over(order)}).select(
        label, "n", (F.col("floor") + (F.col("place") <= F.col("spare")).cast("bigint")).alias("n_train")
    )


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    test_size: float = 0.2,
    seed: int = 42,
    slices: int = DEFAULT_SLICES,
    column: str = "is_test",
) -> DataFrame:
    """Add a 0/1 ``is_test`` column: exact total size, class shares kept. ``key`` must be unique. Rows without a label are a class too.

    The rows with the smallest hashes of each class go to the test side. Every class has one cut point,
    so the full-width pass is a comparison against a row per class and shuffles nothing while the classes fit a broadcast.
    """
    keyed = df.select(_stratum(label).alias("_class"), hash_key(seed, "split", key).alias("h"), F.col(key).alias("id"))
    quotas = train_quotas(df, label, test_size)
    targets = quotas.select(_stratum(label).alias("_class"), F.lit(1).alias("cut"), (F.col("n") - F.col("n_train")).alias("target_rank"))
    cuts = _rank_cuts(keyed, "_class", targets.where("target_rank > 0"), slices)
    limit = cuts.select("_class", F.struct("h", "id").alias("_cut"))
    mine = F.struct(hash_key(seed, "split", key).alias("h"), F.col(key).alias("id"))
    flagged = df.withColumn("_class", _stratum(label)).join(limit, "_class", "left")
    return flagged.withColumn(column, F.coalesce((mine <= F.col("_cut")).cast("int"), F.lit(0))).drop("_cut").select(*df.columns, column)


def stratified_folds(
    df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42, slices: int = DEFAULT_SLICES, column: str = "fold"
) -> DataFrame:
    """Add ``fold`` 0..k-1: within each class, fold sizes differ by at most one. ``key`` must be unique."""
    keyed = df.select(_stratum(label).alias("_class"), hash_key(seed, "fold", key).alias("h"), F.col(key).alias("id"))
    sizes = df.groupBy(_stratum(label).alias("_class")).agg(F.count("*").alias("n"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(k - 1)))
    targets = sizes.select("_class", "n", steps.alias("cut")).select(
        "_class", "cut", F.ceil(F.col("cut") * F.col("n") / F.lit(k)).cast("bigint").alias("target_rank")
    )
    cuts = _rank_cuts(keyed, "_class", targets, slices)
    limits = cuts.groupBy("_class").agg(F.collect_list(F.struct("h", "id")).alias("_cuts"))
    mine = F.struct(hash_key(seed, "fold", key).alias("h"), F.col(key).alias("id"))
    passed = F.size(F.filter("_cuts", lambda c: c < mine))
    classed = df.withColumn("_class", _stratum(label)).join(limits, "_class", "left")
    return classed.withColumn(column, F.coalesce(passed, F.lit(0)).cast("int")).select(*df.columns, column)


def row_index(df: DataFrame, key: str, slices: int = DEFAULT_SLICES) -> DataFrame:
    """(key, row_index): dense 0-based numbers in hash order, without ordering the table on one task.

    A key that is null or stands in two rows is an error: its rows could not be told apart later.
    """
    keyed = df.select(F.col(key), hash_key(0, "row", key).alias("h")).withColumn("slice", hash_bucket("h", slices))
    counts = keyed.groupBy("slice").agg(F.count("*").alias("n"))
    # At most `slices` rows.
    offsets = counts.select(
        "slice", (F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("slice")) - F.col("n")).alias("offset")
    )
    in_slice = Window.partitionBy("slice").orderBy("h", key)
    repeated = F.col(key).isNull() | F.coalesce(F.lag(key).over(in_slice) == F.col(key), F.lit(False))
    place = F.when(repeated, F.raise_error(F.lit(f"{key} is null or repeated")).cast("int")).otherwise(F.row_number().over(in_slice) - 1)
    numbered = keyed.withColumn("place", place).join(F.broadcast(offsets), "slice")
    return numbered.select(key, (F.col("offset") + F.col("place")).cast("bigint").alias("row_index"))


def drawn_place(seed: int, draw: int, total: int) -> int:
    """The place of a draw among ``total`` rows: what ``hash_key`` gives for it, modulo the rows."""
    return int(md5(f"{seed}:draw:{draw}".encode()).hexdigest()[: HASH_BITS // 4], 16) % total


def bootstrap(df: DataFrame, key: str, n: int, seed: int = 42, slices: int = BOOTSTRAP_SLICES) -> DataFrame:
    """Exactly ``n`` rows drawn with replacement, with their draw number in ``draw``; any row may be drawn any number of times.

    Rows are numbered by the hash of their key, then the key (null last), then a digest of their content; rows that are equal in all
    columns are one entry with a count. A draw is a number below the row count. Counts per hash slice tell which slice holds it,
    only the slices that hold a draw are numbered, and full rows are fetched for the drawn entries alone: three readings
    of ``df``, and one more if a drawn key has several rows. An empty table gives no draws.
    """
    spark = df.sparkSession
    keyed = df.select(hash_key(0, "row", key).alias("h"), F.col(key).alias("k")).withColumn("slice", hash_bucket("h", slices))
    sizes = {r["slice"]: r["n"] for r in keyed.groupBy("slice").agg(F.count("*").alias("n")).collect()}  # at most `slices` rows
    held = sorted(sizes)
    starts = [0, *accumulate(sizes[s] for s in held)]
    total = starts[-1]
    if not total:
        return df.limit(0).select(F.lit(None).cast("bigint").alias("draw"), "*")

    # Equal keys are one entry with a count; an entry's first place is its slice's offset plus the rows before it.
    few = n <= FEW_DRAWS
    if few:  # the draws are known here, so only their slices are numbered; more draws than that meet all slices
        places = [(i, drawn_place(seed, i, total)) for i in range(n)]
        dealt = [(i, p, bisect_right(starts, p) - 1) for i, p in places]
        draws = spark.createDataFrame([(i, p, held[at]) for i, p, at in dealt], "draw bigint, place bigint, slice bigint")
        offsets = [(held[at], starts[at]) for at in sorted({at for _, _, at in dealt})]
    else:
        draws = spark.range(n).select(F.col("id").alias("draw"), F.pmod(hash_key(seed, "draw", "id"), F.lit(total)).alias("place"))
        offsets = list(zip(held, starts))
    offsets = F.broadcast(spark.createDataFrame(offsets, "slice bigint, offset bigint"))
    entries = keyed.join(offsets, "slice").groupBy("slice", "offset", "h", "k").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("slice").orderBy("h", F.col("k").isNull(), "k").rowsBetween(Window.unboundedPreceding, -1))
    entries = entries.withColumn("below", F.col("offset") + F.coalesce(before, F.lit(0)))
    if few:
        inside = (F.col("below") <= F.col("place")) & (F.col("place") < F.col("below") + F.col("n"))
        drawn = entries.join(F.broadcast(draws), "slice").where(inside)
    else:
        width = F.lit(-(-total // slices)).cast("bigint")
        drawn = holding(draws.withColumn("w", width), entries.withColumn("w", width), [], "place", "w", ["h", "k", "n", "below"])
    drawn = written(drawn.select("draw", "h", "k", "n", (F.col("place") - F.col("below")).alias("place")), "drawn")

    wide = df.select(hash_key(0, "row", key).alias("_h"), F.struct("*").alias("_row"))
    same = (F.col("h") == F.col("_h")) & F.col("k").eqNullSafe(F.col(f"_row.{key}"))
    single = drawn.where("n = 1").join(wide, same).select("draw", "_row.*")
    several = drawn.where("n > 1")
    return single if several.isEmpty() else single.unionByName(_fetched(wide, several, key))


def _fetched(wide: DataFrame, drawn: DataFrame, key: str) -> DataFrame:
    """The drawn rows of keys that have several; ``drawn`` has (draw, h, k, n, place) with the place among the key's rows.

    A key's rows stand in the order of a 128-bit digest of their content. Places are counted per digest slice first,
    so the rows of one key are spread too.
    """
    digests = [F.xxhash64("_row").alias("a"), F.xxhash64(F.lit(1), "_row").alias("b")]
    keys = drawn.select("h", "k", F.col("n").alias("all")).distinct()
    rows = wide.select(F.col("_h").alias("h"), F.col(f"_row.{key}").alias("k"), *digests)
    mine = rows.join(keys.select(F.col("h").alias("_h"), F.col("k").alias("_k"), "all"), (F.col("h") == F.col("_h")) & F.col("k").eqNullSafe(F.col("_k")))
    entries = written(mine.groupBy("h", "k", "all", "a", "b").agg(F.count("*").alias("n")), "entries")
    part = F.shiftright("a", 52).alias("part")
    parts = entries.groupBy("h", "k", part).agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("h", "k").orderBy("part"))  # over 4096 rows per key at most
    parts = parts.select("h", "k", "part", (upto - F.col("n")).alias("start"))
    placed = entries.withColumn("part", part).alias("e").join(
        parts.alias("p"), (F.col("e.h") == F.col("p.h")) & F.col("e.k").eqNullSafe(F.col("p.k")) & (F.col("e.part") == F.col("p.part"))
    ).select("e.*", "p.start")
    before = F.sum("n").over(Window.partitionBy("h", "k", "part").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("below", F.col("start") + F.coalesce(before, F.lit(0)))
    width = F.expr("1 + all div 4096")
    asked = drawn.select("draw", "h", "k", "place", F.expr("1 + n div 4096").alias("w"))
    found = written(holding(asked, placed.withColumn("w", width), ["h", "k"], "place", "w", ["a", "b"]), "drawn-entries")
    # Equal rows are interchangeable, so one of them stands for all.
    contents = found.select(F.col("h").alias("fh"), F.col("a").alias("fa"), F.col("b").alias("fb")).distinct()
    bodies = wide.select("*", *digests).join(contents, (F.col("_h") == F.col("fh")) & (F.col("a") == F.col("fa")) & (F.col("b") == F.col("fb")), "left_semi")
    bodies = bodies.groupBy("_h", "a", "b").agg(F.first("_row").alias("_row"))
    match = (F.col("f.h") == F.col("b._h")) & (F.col("f.a") == F.col("b.a")) & (F.col("f.b") == F.col("b.b"))
    return found.alias("f").join(bodies.alias("b"), match).select("f.draw", "b._row.*")


@dataclass(frozen=True)
class NumericShift:
    mean_shift: float
    std_shift: float = 0.0
    clip_min: float | None = None


@dataclass(frozen=True)
class CategoricalReweight:
    target: Mapping[str, float]


DriftSpec = NumericShift | CategoricalReweight


def drift_spec(settings: Mapping[str, object]) -> DriftSpec:
    """A spec from its config form; an unknown type is an error."""
    kind = settings["type"]
    if kind == "numeric_shift":
        return NumericShift(settings["mean_shift"], settings.get("std_shift", 0.0), settings.get("clip_min"))
    if kind == "categorical_reweight":
        return CategoricalReweight(dict(settings["target_distribution"]))
    raise ValueError(f"unknown drift type: {kind}")


@dataclass(frozen=True)
class BatchPlan:
    """The defaults are fixed values."""

    batch_size: int = 500
    seed: int = 42
    intensities: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 1.0)
    specs: Mapping[str, DriftSpec] = field(
        default_factory=lambda: {
            "Monthly Charge": NumericShift(15.0),
            "Tenure in Months": NumericShift(-8.0, clip_min=0),
            "Contract": CategoricalReweight({"Month-to-Month": 0.70, "One Year": 0.20, "Two Year": 0.10}),
            "Payment Method": CategoricalReweight({"Bank Withdrawal": 0.35, "Credit Card": 0.35, "Mailed Check": 0.30}),
        }
    )
    # One stream for all columns draws the same uniforms for each of them, which ties them together.
    shared_stream: bool = False


def shifted(value: Column, mean: Column, intensity: Column, spec: NumericShift) -> Column:
    """Move the mean by intensity * mean_shift and scale the spread around the old mean."""
    moved = mean + (value - mean) * (F.lit(1.0) + intensity * F.lit(float(spec.std_shift))) + intensity * F.lit(float(spec.mean_shift))
    return lower_clip(moved, None if spec.clip_min is None else float(spec.clip_min))


def level_intervals(df: DataFrame, column: str, spec: CategoricalReweight, strengths: Sequence[float]) -> tuple[DataFrame, int]:
    """((strength, level, block, low, high), number of blocks): each level's part of [0, 1) in the interpolated distribution.

    Levels stand in their own order; the shares now are counts without nulls, and levels of either side take part. The
    edges come from prefix sums, spread over ranges of levels where there are many. A level's interval
    stands once in every block of [0, 1) that it reaches; there are about as many blocks as levels, so a uniform draw
    meets two candidates on average.
    """
    kind = df.schema[column].dataType
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("level")).agg(F.count("*").alias("n"))
    target = df.sparkSession.createDataFrame([(str(k), float(v)) for k, v in spec.target.items()], "level string, share double")
    # Decimal sums don't depend on their order.
    target = target.select(F.col("level").cast(kind).alias("level"), F.col("share").cast("decimal(28,18)").alias("t"))
    levels = counts.join(target, "level", "full").select(
        "level", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("t", F.lit(0).cast("decimal(28,18)")).alias("t")
    )
    levels = levels.where("n > 0 OR t > 0")
    sums, number = _summed(levels, kind)
    blocks = min(MOST_BLOCKS, 1 << max(0, number - 1).bit_length())
    share = lambda n: F.coalesce(F.try_divide(n.cast("double"), F.col("n_total")), F.lit(0.0))
    low_n, high_n = share(F.col("n_before")), share(F.col("n_before") + F.col("n"))
    low_t, high_t = F.col("t_before").cast("double"), (F.col("t_before") + F.col("t")).cast("double")
    i = F.col("strength")
    whole = (F.lit(1.0) - i) * (F.col("n_total") > 0).cast("double") + i * F.col("t_total").cast("double")
    edge = lambda n, t: F.try_divide((F.lit(1.0) - i) * n + i * t, whole)
    each = sums.withColumn("strength", F.explode(F.array(*[F.lit(float(x)) for x in strengths])))
    # Rounding can leave the last edge below 1, and a draw can be 1 itself: both belong to the last level that has any weight.
    last = ((i == 1) | (F.col("n_before") + F.col("n") == F.col("n_total"))) & ((i == 0) | (F.col("t_before") + F.col("t") == F.col("t_total")))
    edges = each.select("strength", "level", edge(low_n, low_t).alias("low"), edge(high_n, high_t).alias("high"), last.alias("last"))
    edges = edges.where("low < high").withColumn("high", F.when(F.col("last"), F.lit(2.0)).otherwise(F.col("high"))).drop("last")
    block = lambda x: F.least(F.floor(x * F.lit(float(blocks))), F.lit(blocks - 1))
    return edges.withColumn("block", F.explode(F.sequence(block(F.col("low")), block(F.col("high"))))), blocks


def _summed(levels: DataFrame, kind) -> tuple[DataFrame, int]:
    """((level, n, t, n_before, n_total, t_before, t_total), number of levels): sums over the levels before each one."""
    rows = levels.orderBy("level").limit(FEW_LEVELS + 1).collect()
    if len(rows) > FEW_LEVELS:
        stored = written(levels, "levels")
        return running_sums(stored, [], "level", ["n", "t"]), stored.count()
    n, t = [0, *accumulate(r["n"] for r in rows)], [Decimal(0), *accumulate(r["t"] for r in rows)]
    sums = [(r["level"], r["n"], r["t"], n[i], n[-1], t[i], t[-1]) for i, r in enumerate(rows)]
    amount = T.DecimalType(38, 18)
    fields = [T.StructField("level", kind), T.StructField("n", T.LongType()), T.StructField("t", amount)]
    fields += [T.StructField(c, T.LongType()) for c in ("n_before", "n_total")] + [T.StructField(c, amount) for c in ("t_before", "t_total")]
    return levels.sparkSession.createDataFrame(sums, T.StructType(fields)), len(rows)


def _reweighted(batch: DataFrame, column: str, intervals: DataFrame, blocks: int, strength: Column, draw: Column) -> DataFrame:
    """The batch with the column's values drawn anew: a join of its draws to the intervals of their block.

    The intervals are broadcast or shuffled as their measured size allows.
    """
    u = batch.withColumns({"_u": draw, "_strength": strength.cast("double")})
    u = u.withColumn("_block", F.least(F.floor(F.col("_u") * F.lit(float(blocks))), F.lit(blocks - 1)))
    intervals = intervals.select("strength", "block", "low", "high", F.col("level").alias("_level"))
    inside = (F.col("_strength") == F.col("strength")) & (F.col("_block") == F.col("block")) & (F.col("low") <= F.col("_u")) & (F.col("_u") < F.col("high"))
    return u.join(intervals, inside, "left").select(*[F.col("_level").alias(c) if c == column else F.col(f"`{c}`") for c in batch.columns])


def apply_drift(
    batch: DataFrame,
    specs: Mapping[str, DriftSpec],
    intensity: Column | float,
    *,
    source: DataFrame | None = None,
    target: str = "Churn Label",
    seed: int = 42,
    row: str = "draw",
    shared_stream: bool = False,
    strengths: Sequence[float] | None = None,
) -> DataFrame:
    """Perturb the listed columns of a batch; the label can't be listed, other columns stay.

    ``source`` holds the unperturbed batch that means and shares are taken from when ``batch`` repeats
    it for several intensities; ``row`` identifies a row of it. Where ``intensity`` is a column, ``strengths`` lists its values; if not given
    they are read from the batch.
    """
    if target in specs:
        raise ValueError(f"the label {target!r} can't be perturbed")
    source = batch if source is None else source
    if isinstance(intensity, (int, float)):
        strength, strengths = F.lit(float(intensity)), [float(intensity)]
    else:
        strength = intensity
    changes, drawn = {}, {}
    for column, spec in specs.items():
        if isinstance(spec, NumericShift):
            value = F.col(column).cast("double")
            mean = source.agg(F.avg(F.col(column).cast("double"))).scalar()
            changes[column] = shifted(value, mean, strength, spec)
        elif isinstance(spec, CategoricalReweight):
            drawn[column] = spec
        else:
            raise ValueError(f"unknown drift spec for {column}: {spec!r}")
    if drawn and strengths is None:
        strengths = [r[0] for r in batch.select(strength.cast("double")).distinct().collect() if r[0] is not None]  # one per batch
    out = batch.withColumns(changes)
    for column, spec in drawn.items():
        stream = "reweight" if shared_stream else f"reweight:{column}"
        intervals, blocks = level_intervals(source, column, spec, strengths)
        out = _reweighted(out, column, intervals, blocks, strength, uniform(seed, stream, row))
    return out


def drift_sweep(reference: DataFrame, key: str, plan: BatchPlan = BatchPlan(), target: str = "Churn Label") -> DataFrame:
    """The drifted batches of all intensities in one frame, with ``batch_name`` and ``intensity``.

    All intensities perturb the same drawn rows, so the draw happens once.
    """
    drawn = written(bootstrap(reference, key, plan.batch_size, plan.seed), "batch")
    levels = F.explode(F.array(*[F.lit(float(i)) for i in plan.intensities]))
    batches = drawn.withColumn("intensity", levels).withColumn("batch_name", batch_name(F.col("intensity")))
    return apply_drift(
        batches,
        plan.specs,
        F.col("intensity"),
        source=drawn,
        target=target,
        seed=plan.seed,
        shared_stream=plan.shared_stream,
        strengths=plan.intensities,
    )
