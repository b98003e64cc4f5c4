"""Line deduplication by fingerprints of line runs.

Every run of as many non-blank lines as are asked for, with the blank lines between them, is a fingerprint, so equal
fingerprints are equal runs and the first place of one is a true partner of all others: this is winnowing with windows
of one fingerprint, the only ones that lose no run of the least length. A run that stood earlier is deleted; longer runs
are unions of such runs. Blank lines at the ends of a run belong to it as far as an earlier place has them too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, matched, releasing, written

FEW = 500_000  # runs that may be broadcast; above, the same join is shuffled
BLANK = 1 << 60  # larger than any line's hash


@dataclass(frozen=True)
class LineSettings:
    least: int = 2  # lines that are not blank in a run to be deleted

    def __post_init__(self) -> None:
        if self.least < 1:
            raise ValueError("a run has 1 line or more")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _hashes(lines: Column) -> Column:
    digest = lambda x: F.conv(F.substring(F.md5(F.trim(x)), 1, 15), 16, 10).cast("bigint")
    return F.transform(lines, lambda x: F.when(F.trim(x) == "", F.lit(BLANK)).otherwise(digest(x)))


def _runs(rows: DataFrame, least: int) -> DataFrame:
    """One row per run of ``least`` non-blank lines in ``h``: first and last line, the run's lines, blank lines before and after it.

    ``body`` has the hashes of the non-blank lines, then how many lines further each stands than the first.
    """
    filled = F.filter(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("at"))), lambda p: p["h"] != BLANK)
    rows = rows.withColumn("n", F.size("h")).withColumn("filled", filled)
    count = F.size("filled") - least + 1
    at = lambda i: F.get("filled", i)["at"]

    def run(i: Column) -> Column:
        own = F.slice("filled", i + 1, least)
        first, last = at(i), at(i + (least - 1))
        hashes = F.transform(own, lambda p: p["h"])
        steps = F.transform(own, lambda p: (p["at"] - first).cast("bigint"))
        before = first - F.coalesce(F.when(i > 0, at(i - 1)), F.lit(-1)) - 1
        after = F.coalesce(at(i + least), F.col("n")) - last - 1
        return F.struct(first.alias("first"), last.alias("last"), F.concat(hashes, steps).alias("body"), before.alias("before"), after.alias("after"))

    runs = F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), run))
    return rows.select("key", "text_hash", F.explode(runs).alias("run")).select("key", "text_hash", "run.*")


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: LineSettings = LineSettings()) -> DataFrame:
    """(key, text_hash, runs): the lines to delete per document, as an array of (first, last) line numbers from 0.

    Documents stand in order of key, null last, then of a hash of the text; the first place of a run stays, all others
    go, whatever stands around them. Lines are compared without blanks at their ends.
    """
    rows = docs.select(F.col(key).alias("key"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), _hashes(_lines(F.col(text))).alias("h"))
    runs = _runs(rows, settings.least)
    # The run alone, and with 1, 2, ... of the blank lines before or after it.
    edges = F.explode(F.sequence(-F.col("before"), F.col("after")))
    runs = runs.withColumn("edge", edges)
    marks = runs.select(
        *[F.xxhash64(F.lit(i), "body", "edge").alias(m) for i, m in enumerate(("mark", "second"))],  # 128 bits
        F.struct(F.col("key").isNull().alias("late"), "key", "text_hash", "first").alias("place"),
        F.struct((F.col("first") + F.least("edge", F.lit(0))).alias("first"), (F.col("last") + F.greatest("edge", F.lit(0))).alias("last")).alias("run"),
    )
    marks = written(marks, "line-marks")
    # Counted per task first, so a frequent run is no more than a row per task.
    owners = marks.groupBy("mark", "second").agg(F.min("place").alias("owner"), F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    later = matched(marks, written(owners, "line-owners"), ["mark", "second"], FEW).where(F.col("place") != F.col("owner"))
    return later.groupBy("place.key", "place.text_hash").agg(F.collect_set("run").alias("runs"))


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A text's lines outside its runs; the work grows with lines and runs, not with their product."""
    for batch in batches:
        kept, counts = [], np.zeros((2, batch.num_rows), np.int64)  # lines, removed lines
        for i, (text, runs) in enumerate(zip(batch.column("text").to_pylist(), batch.column("runs"))):
            if text is None or not runs.is_valid:
                kept.append(text)
                counts[0, i] = 0 if text is None else text.count("\n") + 1
                continue
            lines = text.split("\n")
            edges = np.zeros(len(lines) + 1, np.int64)
            np.add.at(edges, runs.values.field("first").to_numpy(), 1)
            np.add.at(edges, runs.values.field("last").to_numpy() + 1, -1)
            stays = np.cumsum(edges)[:-1] == 0
            kept.append("\n".join(compress(lines, stays.tolist())))
            counts[:, i] = len(lines), len(lines) - int(stays.sum())
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, pa.string()), *map(pa.array, counts)], ["row", "kept", "n_lines", "n_removed"])


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: LineSettings = LineSettings()) -> DataFrame:
    """All columns of ``docs`` in ``row``, with ``kept`` (the text without the later repeated runs), ``n_lines`` and ``n_removed``.

    Null texts stay null and have no lines; blank lines go only inside a deleted run. Texts and lines of any length are read whole. Rows that repeat key
    and text are one document and get the same result. An empty table gives an empty result, and other columns may have any name.
    """
    bounded_batches(docs.sparkSession)
    runs = written(repeated_runs(docs, key, text, settings), "line-runs")
    runs = runs.select(F.col("key").alias("_key"), F.col("text_hash").alias("_hash"), "runs")
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("_own"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("_text"), F.col(text).alias("text"))
    joined = rows.join(runs, F.col("_own").eqNullSafe(F.col("_key")) & (F.col("_text") == F.col("_hash")), "left").select("row", "text", "runs")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(releasing(_kept_rows), f"row {kind}, kept string, n_lines long, n_removed long")
