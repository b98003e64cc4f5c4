"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retentia.session import shared_dir

ASCII_SPACE_WORD = r"[^\x20\x09-\x0D]+"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_DEFAULT, BATCH_BYTES = "67108864b", "4194304b"
HEAVY = 100_000  # rows of a key that a shuffled join takes out of its shuffle
ASCII_LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, *ASCII_LETTERS)


def draw(seed: int, stream: str, key: Column) -> Column:
    """A 60-bit non-negative integer from the key alone; a null key draws like the empty string."""
    digest = F.md5(F.concat_ws(":", F.lit(f"{seed}:{stream}"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def draw_sql(seed: int, stream: str, key: str) -> str:
    """The same draw for the SQL counterparts."""
    return f"('0x' || substr(md5('{seed}:{stream}:' || coalesce(cast({key} AS VARCHAR), '')), 1, 15))::BIGINT"


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(ASCII_SPACE_WORD)), F.lit(0)).cast("bigint")


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's limit on an Arrow batch to 4 MB where it is at its default of 64 MB.

    A task holds a batch several times, in the JVM and in Python, and text reaches 64 MB in a few thousand rows. No
    result depends on where batches end.
    """
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def release_memory() -> None:
    """Give a Python worker's free memory back to the system.

    Spark reuses its workers, and each keeps the most that any of its tasks needed for as long as the executor lives.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def releasing(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that releases memory when its task has read its last batch."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(rows)
        release_memory()

    return batches


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, read back: cuts the lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/retentia-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, order: list[Column], name: str, table: str) -> DataFrame:
    """``rows`` with their number from 1 in ``order``, stored; no two rows may be equal in ``order``.

    Rows are dealt and sorted by ranges of the order, and a range's first number is the count of the ranges before it. Only
    one row per range goes through a window.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    stored = written(sorted_, table).withColumn("_range", F.shiftright("_at", 33))
    sizes = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.col("_at") - F.shiftleft("_range", 33)
    return stored.join(F.broadcast(starts), "_range").withColumn(name, (F.col("_before") + own + 1).cast("bigint")).select(*rows.columns, name)


def matched(rows: DataFrame, keys: DataFrame, on: list[str], few: int, heavy: int = HEAVY) -> DataFrame:
    """``rows`` joined with ``keys``, a stored table with one row per key and the number ``n_rows`` of rows that have it.

    Up to ``few`` keys are broadcast. Of more, those of ``heavy`` rows or more are: there is at most one per ``heavy`` rows of the
    table. All other keys bring a bounded number of rows to a task.
    """
    if keys.count() <= few:
        return rows.join(F.broadcast(keys.drop("n_rows")), on)
    many, light = (keys.where(c).drop("n_rows") for c in (F.col("n_rows") >= heavy, F.col("n_rows") < heavy))
    rest = rows.join(F.broadcast(many.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(many), on).unionByName(rest.join(light, on))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
