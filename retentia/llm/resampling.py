"""Importance resampling towards a target text set, by hashed word runs and Gumbel noise.

Every run of 1 to ``grams`` consecutive words is a feature, and a feature's CRC-32 picks its bucket. A bucket's gain is the
scaled log ratio of its share in the target to its share in the documents; gains are one array with an entry per bucket, and
a document's weight is that array summed over its features. Noise that depends on the key alone turns the highest
weights into a draw without replacement.

The cutoff of the draw is found without sorting all scores: a quantile sketch brackets it, exact counts outside the bracket
prove that the cutoff is inside or widen the bracket, and only the rows inside are sorted.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, numbered, releasing, written

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NO_WORD = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
PIECE = 1 << 20  # bytes of a text whose words are held at once
FEW = 1_000_000  # ranks that may be broadcast; above, the same join is shuffled
ACCURACY = 1000  # of the quantile sketch: ranks are off by one thousandth of the rows at most
NOISE_STEPS = 1 << 32


@dataclass(frozen=True)
class ResamplingSettings:
    buckets: int = 10_000
    grams: int = 1  # words in the longest feature
    least_words: int = 20  # of a document that may be drawn
    share: tuple[int, int] = (10, 100)  # of the documents that may be drawn
    scale: int = 1000  # steps of a unit of log weight
    seed: int = 2024

    def __post_init__(self) -> None:
        if self.buckets < 1 or self.grams < 1 or not 0 <= self.share[0] <= self.share[1] or self.share[1] < 1:
            raise ValueError("one bucket, one word and a share between 0 and 1 are needed")


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, A-Z in lower case, about 1 MB of text at a time; no word is cut."""
    at = 0
    while at < len(text):
        gap = NO_WORD.search(text, min(at + PIECE, len(text)))
        end = gap.start() if gap else len(text)
        yield WORD.findall(text[at:end].lower())
        at = end if end > at else at + 1


def _buckets(text: bytes, settings: ResamplingSettings) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them), piece by piece."""
    before: list[bytes] = []
    for words in _words(text):
        runs = words if settings.grams == 1 else list(_runs(before, words, settings.grams))
        yield len(words), np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)) % settings.buckets
        before = (before + words)[-(settings.grams - 1) :] if settings.grams > 1 else []


def _runs(before: list[bytes], words: list[bytes], longest: int) -> Iterator[bytes]:
    whole = before + words
    for end in range(len(before) + 1, len(whole) + 1):
        for start in range(max(0, end - longest), end):
            yield b" ".join(whole[start:end])


def _count_rows(settings: ResamplingSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(settings.buckets, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                for _, found in _buckets(text.as_buffer().to_pybytes(), settings):
                    counts += np.bincount(found, minlength=settings.buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["bucket", "n"])

    return run


def _weight_rows(settings: ResamplingSettings, gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.zeros((3, batch.num_rows), np.int64)  # words, features, weight
            for i, text in enumerate(batch.column("text")):
                for n, found in _buckets(text.as_buffer().to_pybytes(), settings):
                    sums[:, i] += (n, len(found), int(gains[found].sum()))
            columns = [batch.column("row"), batch.column("key"), *[pa.array(s, pa.int64()) for s in sums]]
            yield pa.RecordBatch.from_arrays(columns, ["row", "key", "n_words", "n_features", "weight"])

    return run


def _body(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")


def bucket_counts(docs: DataFrame, text: str, settings: ResamplingSettings) -> np.ndarray:
    """Features per bucket over all texts. A task sends one row per bucket, and the driver gets ``settings.buckets`` rows at most."""
    rows = docs.select(_body(text)).mapInArrow(releasing(_count_rows(settings)), "bucket long, n long")
    counts = np.zeros(settings.buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray, settings: ResamplingSettings) -> np.ndarray:
    """floor(scale * ln of the ratio of smoothed shares) per bucket."""
    buckets = settings.buckets
    all_source, all_target = float(source.sum()) + buckets, float(target.sum()) + buckets
    ratio = [(float(t) + 1) * all_source / ((float(s) + 1) * all_target) for s, t in zip(source, target)]
    return np.array([math.floor(settings.scale * math.log(r)) for r in ratio], np.int64)


def _noise(key: Column, settings: ResamplingSettings) -> Column:
    """floor(-scale * ln(-ln(u))) for a u in (0, 1) from the key alone; a null key draws like an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(NOISE_STEPS))
    return F.floor(F.lit(float(-settings.scale)) * F.log(-F.log(u))).cast("bigint")


def _cutoff(able: DataFrame, share: tuple[int, int]) -> dict | None:
    """The last row that is drawn: its score, key and place; None where nothing is drawn.

    The sketch's bracket around the cutoff's rank holds if fewer than the wanted rows lie above it and enough of them
    above its low end; exact counts tell. Where they do not, the bracket gets four times as wide, up to all scores.
    """
    n = able.count()
    wanted = n * share[0] // share[1]
    if wanted == 0:
        return None
    middle, reach = 1 - wanted / n, 2 / ACCURACY
    while True:
        edges = F.percentile_approx("score", [max(0.0, middle - reach), min(1.0, middle + reach)], F.lit(ACCURACY * 10))
        ends = able.agg(edges.alias("edges"), F.min("score").alias("low"), F.max("score").alias("high")).first()
        low = ends["low"] if middle - reach <= 0 else ends["edges"][0]
        high = ends["high"] if middle + reach >= 1 else ends["edges"][1]
        outside = able.agg(F.count(F.when(F.col("score") > high, 1)).alias("above"), F.count(F.when(F.col("score") >= low, 1)).alias("reached")).first()
        if outside["above"] < wanted <= outside["reached"]:
            break
        reach *= 4
    inside = numbered(able.where(F.col("score").between(low, high)).select("score", "key", "place"), _order(), "number", "bracket")
    return inside.where(F.col("number") == wanted - outside["above"]).first().asDict()


def _order() -> list[Column]:
    """From the highest score down; ties to the smaller key, null last, then to the row that was stored first."""
    return [F.desc("score"), F.col("key").isNull(), F.col("key"), F.col("place")]


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", settings: ResamplingSettings = ResamplingSettings(), keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (all, if None) in ``row``, with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    ``rank`` counts the drawn documents from 1 and is null for the others; the rows with a rank are the sample. ``target`` has
    its texts in a column of the same name. Null and empty texts have no features and weight 0; texts of any length count
    in full. Equal scores go to the smaller key, a null key is last, and rows that repeat a key take ranks of their
    own. Without target texts or documents all gains are those of the smoothing. An empty table gives an empty
    result. Other columns stay in ``row`` whatever their names.
    """
    bounded_batches(docs.sparkSession)
    each = gains(bucket_counts(docs, text, settings), bucket_counts(target, text, settings), settings)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), F.col(key).alias("key"), _body(text))
    kinds = f"row {rows.schema['row'].dataType.simpleString()}, key {rows.schema['key'].dataType.simpleString()}"
    weighted = rows.mapInArrow(releasing(_weight_rows(settings, each)), f"{kinds}, n_words long, n_features long, weight long")
    # A stored table gives each row a place of its own, the same for every reader.
    scored = weighted.withColumn("score", F.col("weight") + _noise(F.col("key"), settings)).withColumn("place", F.monotonically_increasing_id())
    scored = written(scored, "scored")
    able = scored.where(F.col("n_words") >= settings.least_words)
    last = _cutoff(able, settings.share)
    if last is None:
        return scored.select("row", "n_words", "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    ranks = numbered(able.where(_reaches(last)).select("score", "key", "place"), _order(), "rank", "ranks").select("place", "rank")
    ranks = F.broadcast(ranks) if ranks.count() <= FEW else ranks
    return scored.join(ranks, "place", "left").select("row", "n_words", "n_features", "weight", "score", "rank")


def _reaches(last: dict) -> Column:
    """Whether a row stands no later than ``last`` in the order of the draw."""
    score, key, place = F.col("score"), F.col("key"), F.col("place")
    if last["key"] is None:
        tied = key.isNotNull() | (place <= last["place"])
    else:
        tied = (key < F.lit(last["key"])) | ((key == F.lit(last["key"])) & (place <= last["place"]))
    return (score > last["score"]) | ((score == last["score"]) & F.coalesce(tied, F.lit(False)))


def sampled(docs: DataFrame, target: DataFrame, settings: ResamplingSettings = ResamplingSettings(), **columns: str) -> DataFrame:
    """The drawn documents alone, with the columns of ``docs``."""
    return resample(docs, target, settings=settings, **columns).where(F.col("rank").isNotNull()).select("row.*")
