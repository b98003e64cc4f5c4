"""Repeated word windows, found through super-k-mers.

A window is ``length`` consecutive words of one document. Its minimiser is the run of ``gram`` words in it with the smallest
hash; consecutive windows that share a minimiser form one packed string, some 70 words for 22 windows. Equal windows
have equal minimisers, so each minimiser is a bucket of its own:

1. Minimisers of one text alone are left out: none of their windows can repeat elsewhere.
2. The other packed strings travel to their bucket, as digests with a place where they stand. Equal strings meet there first,
   so copies are one string with the first document that has it.
3. In buckets with several strings the strings are cut into windows, each in one text that has it. Equal windows meet; the
   first document of each is exact.

Buckets are Spark groups with map-side partial results, so a bucket that a third of all documents share isn't gathered anywhere.
Packed strings and windows are compared by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, matched, releasing, written
from retentia.llm.texthash import SPACE, U, WordHasher, byte_codes, shingle_hashes

PIECE = 1 << 20  # window starts of a text handled at once
BITS = U(24)  # of a place within a piece
ROWS = 4096  # packed strings of a text sent at once
FEW = 1_000_000  # keys or stretches that may be broadcast; above, the same joins are shuffled


@dataclass(frozen=True)
class WindowSettings:
    length: int = 50  # words of a window
    gram: int = 8  # words of a minimiser

    def __post_init__(self) -> None:
        if not 1 <= self.gram <= self.length or self.length - self.gram > 62:
            raise ValueError("a minimiser has 1 word or more, and 63 windows at most can share one")


class _Words:
    """Hashes and places of the words of a text; case counts."""

    def __init__(self, seed: int) -> None:
        self.hasher = WordHasher(seed)
        self.hasher.codes = byte_codes(seed)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        return self.hasher(data, np.array([0, len(data)]))[0]

    @staticmethod
    def places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte of every word, and the byte after it."""
        edges = np.diff((~SPACE[data]).view(np.int8), prepend=np.int8(0), append=np.int8(0))
        return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """The smallest of every ``w`` consecutive entries, by doubling."""
    step, done = 1, x
    while step * 2 <= w:
        done, step = np.minimum(done[:-step], done[step:]), step * 2
    return np.minimum(done[: len(x) - w + 1], done[w - step :]) if w > step else done


def super_kmers(words: np.ndarray, settings: WindowSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, minimiser) of each run of consecutive windows that share a minimiser."""
    firsts, counts, minimisers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, U)]
    mask = (U(1) << BITS) - U(1)
    for a in range(0, len(words) - settings.length + 1, PIECE):
        grams = shingle_hashes(words[a : a + PIECE + settings.length - 1], settings.gram)
        low = _least((grams & ~mask) | np.arange(len(grams), dtype=U), settings.length - settings.gram + 1)
        place = (low & mask).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        firsts.append(first + a)
        counts.append(np.diff(np.append(first, len(place))))
        minimisers.append(grams[place[first]])
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(minimisers)


def _minimiser_rows(settings: WindowSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(1)
        for batch in batches:
            parts = [super_kmers(words.hashes(np.frombuffer(t.as_buffer(), np.uint8)), settings) for t in batch.column("text")]
            if not parts:
                continue
            first, n, minimiser = (np.concatenate(c) for c in zip(*parts))
            own = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
            columns = [batch.column("digest").take(pa.array(own)), pa.array(minimiser.view(np.int64)), pa.array(first, pa.int32()), pa.array(n, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "minimiser", "first", "n"])

    return run


def _string_rows(settings: WindowSettings):
    """The packed strings of a text, each as a digest of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (text, runs) in enumerate(zip(batch.column("text"), batch.column("runs"))):
                raw = text.as_buffer().to_pybytes()
                start, end = _Words.places(np.frombuffer(raw, np.uint8))
                for a in range(0, len(runs.values), ROWS):
                    part = runs.values.slice(a, ROWS)
                    first, n = part.field("first").to_numpy(), part.field("n").to_numpy()
                    ends = end[first + n + settings.length - 2]
                    digests = [hashlib.md5(b" ".join(raw[i:j].split())).digest() for i, j in zip(start[first].tolist(), ends.tolist())]
                    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                    same = pa.array(np.full(len(part), row))
                    columns = [*(batch.column(c).take(same) for c in ("digest", "owner")), *(part.field(c) for c in ("minimiser", "first", "n"))]
                    columns += [pa.array(np.ascontiguousarray(halves[:, i])) for i in (0, 1)]
                    yield pa.RecordBatch.from_arrays(columns, ["digest", "owner", "minimiser", "first", "n", "string", "second"])

    return run


def _window_rows(settings: WindowSettings):
    """The windows of the strings that are listed beside a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _Words(2), _Words(3)
        for batch in batches:
            column = batch.column("text").cast(pa.large_binary())
            if not len(column):
                continue
            starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2], np.uint8)[starts[0] : starts[-1]]
            words, first = one.hasher(data, starts - starts[0])
            hashes = [shingle_hashes(w, settings.length) for w in (words, two.hasher(data, starts - starts[0])[0])]
            lists = batch.column("strings")
            strings = lists.flatten()
            begin = np.repeat(first[:-1], lists.value_lengths().to_numpy()) + strings.field("first").to_numpy()
            for a in range(0, len(strings), ROWS):
                part = strings.slice(a, ROWS)
                n = part.field("n").to_numpy().astype(np.int64)  # windows of each string
                own = np.repeat(np.arange(len(n)), n)
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                place = begin[a : a + ROWS][own] + at
                columns = [part.field(c).take(pa.array(own)) for c in ("string", "second", "owner")]
                columns += [pa.array(at, pa.int32()), *(pa.array(h[place].view(np.int64)) for h in hashes)]
                yield pa.RecordBatch.from_arrays(columns, ["string", "second", "owner", "at", "window", "other"])

    return run


def _span_rows(settings: WindowSettings):
    """The marked windows of a text as spans of words. Bit i of a run's marks stands for the window at word first + i."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends, sizes = [], [], []
            for runs in batch.column("runs"):
                first, marks = (runs.values.field(c).to_numpy() for c in ("first", "marks"))
                hits = [first[(marks >> at) & 1 == 1] + at for at in range(settings.length - settings.gram + 1)]
                begin = np.unique(np.concatenate(hits))
                new = np.flatnonzero(np.append(True, begin[1:] > begin[:-1] + settings.length))
                starts.append(begin[new])
                ends.append(begin[np.append(new[1:], len(begin)) - 1] + settings.length)
                sizes.append(len(new))
            fields = [pa.array(np.concatenate(x) if x else [], pa.int32()) for x in (starts, ends)]
            spans = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.StructArray.from_arrays(fields, ["start", "end"]))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), spans], ["digest", "spans"])

    return run


def _kept_rows(settings: WindowSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, digests, counts = [], [], np.zeros((3, batch.num_rows), np.int64)  # words, removed words, spans
            for i, (text, spans, copy) in enumerate(zip(batch.column("text"), batch.column("spans"), batch.column("copy"))):
                raw = text.as_buffer().to_pybytes()
                start, end = _Words.places(np.frombuffer(raw, np.uint8))
                edges = np.zeros(len(start) + 1, np.int64)
                if copy.as_py() and len(start) >= settings.length:
                    edges[[0, -1]] += (1, -1)
                if spans.is_valid:
                    edges[spans.values.field("start").to_numpy()] += 1
                    edges[spans.values.field("end").to_numpy()] -= 1
                gone = np.cumsum(edges)[:-1] > 0
                turns = np.flatnonzero(np.diff(gone.view(np.int8), prepend=np.int8(1), append=np.int8(1)))  # kept stretches start and end here
                stretches = zip(start[turns[::2]].tolist(), end[turns[1::2] - 1].tolist())
                words = b" ".join(b" ".join(raw[a:b].split()) for a, b in stretches)
                kept.append(words if gone.any() else raw)
                digests.append(hashlib.sha256(words).hexdigest())
                counts[:, i] = len(start), int(gone.sum()), int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
            columns = [batch.column("row"), pa.array(kept, pa.binary()), pa.array(digests, pa.string()), *map(pa.array, counts)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "kept", "kept_sha256", "n_words", "n_removed", "n_spans"])

    return run


def _texts(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (one row per digest) with the text, once per digest."""
    ids = wanted.select("digest")
    some = base.join(F.broadcast(ids) if ids.count() <= FEW else ids, "digest", "left_semi")
    return some.groupBy("digest").agg(F.first("text").alias("text")).join(wanted, "digest")


def repeated_windows(base: DataFrame, owners: DataFrame, settings: WindowSettings = WindowSettings()) -> DataFrame:
    """(digest, spans): the words of each text that windows cover which also start in a document before the text's first one.

    Spans are apart from each other and in order; only texts that have any are listed. ``base`` has (digest, text as bytes), equal
    digests are equal texts, and ``owners`` names the first document of each as (digest, owner).
    """
    rows = base.mapInArrow(releasing(_minimiser_rows(settings)), "digest binary, minimiser long, first int, n int")
    found = written(rows, "minimisers")
    text_of = F.xxhash64("digest")
    several = found.groupBy("minimiser").agg(F.min(text_of).alias("a"), F.max(text_of).alias("b"), F.count(F.lit(1)).alias("n_rows"))
    shared = written(several.where(F.col("a") != F.col("b")).select("minimiser", "n_rows"), "shared-minimisers")
    runs = matched(found, shared, ["minimiser"], FEW).groupBy("digest").agg(F.collect_set(F.struct("first", "n", "minimiser")).alias("runs"))
    runs = written(runs, "runs")

    kind = owners.schema["owner"].dataType.simpleString()
    texts = _texts(base, runs).join(owners, "digest")
    owned = texts.mapInArrow(releasing(_string_rows(settings)), f"digest binary, owner {kind}, minimiser long, first int, n int, string long, second long")
    owned = written(owned, "owned")

    place = F.min(F.struct("digest", "first", "n", "minimiser")).alias("place")
    strings = owned.groupBy("string", "second").agg(F.min("owner").alias("owner"), F.count(F.lit(1)).alias("n_rows"), place)
    strings = written(strings.select("string", "second", "owner", "n_rows", "place.*"), "strings")
    crowded = strings.groupBy("minimiser").agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    crowded = matched(strings.drop("n_rows"), written(crowded, "crowded"), ["minimiser"], FEW)
    lists = crowded.groupBy("digest").agg(F.collect_list(F.struct("first", "n", "string", "second", "owner")).alias("strings"))
    lists = written(lists, "crowded-strings")
    windows = _texts(base, lists).mapInArrow(releasing(_window_rows(settings)), f"string long, second long, owner {kind}, at int, window long, other long")
    windows = written(windows, "windows")
    groups = windows.groupBy("window", "other").agg(F.min("owner").alias("earliest"), F.max("owner").alias("latest"), F.count(F.lit(1)).alias("n_rows"))
    groups = written(groups.where(F.col("earliest") < F.col("latest")).drop("latest"), "window-groups")
    later = matched(windows, groups, ["window", "other"], FEW).where(F.col("owner") > F.col("earliest"))
    marks = later.groupBy("string", "second").agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("marks"))
    verdicts = strings.select("string", "second", F.col("owner").alias("earliest"), "n_rows").join(marks, ["string", "second"], "left")
    verdicts = written(verdicts.where((F.col("n_rows") > 1) | F.col("marks").isNotNull()), "verdicts")

    judged = matched(owned, verdicts, ["string", "second"], FEW)
    every = F.expr("shiftleft(1L, n) - 1")
    judged = judged.withColumn("marks", F.when(F.col("owner") > F.col("earliest"), every).otherwise(F.col("marks"))).where("marks IS NOT NULL")
    gathered = judged.groupBy("digest").agg(F.collect_list(F.struct("first", "marks")).alias("runs"))
    return gathered.mapInArrow(releasing(_span_rows(settings)), "digest binary, spans array<struct<start:int,end:int>>")


def remove_repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: WindowSettings = WindowSettings()) -> DataFrame:
    """All columns of ``docs`` in ``row``, with ``kept``, ``kept_sha256``, ``n_words``, ``n_removed`` and ``n_spans``.

    ``kept`` is the text's bytes as they are where nothing goes, else the remaining words, one space between them; ``kept_sha256`` is the digest of the
    remaining words, one space between them, in both cases.
    Every word goes that a window covers which also starts in a document with a smaller key; null keys come last. Windows
    are judged on the input. Null and empty texts have no words; texts shorter than a window stay whole, and texts of
    any length are read whole, about a million windows at a time. Repeated rows and documents that share a key do not remove each other; a window
    that repeats inside one document alone stays. An empty table gives an empty result, and other columns may have any name.
    """
    bounded_batches(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    digest = F.unhex(F.md5(body))
    place = F.struct(F.col(key).isNull().alias("late"), F.col(key).alias("key"))
    places = docs.select(digest.alias("digest"), place.alias("place")).groupBy("digest")
    owners = written(places.agg(F.min("place").alias("owner"), F.max("place").alias("last")), "owners")
    spans = written(repeated_windows(docs.select(digest.alias("digest"), body.alias("text")), owners.drop("last"), settings), "repeated-windows")
    copied = owners.where(F.col("owner") < F.col("last")).drop("last")
    found = written(copied.join(spans, "digest", "full"), "found").withColumnRenamed("digest", "_digest")
    weight = found.agg(F.sum(F.coalesce(F.size("spans"), F.lit(0)) + 1)).first()[0] or 0
    rows = docs.select(F.struct("*").alias("row"), digest.alias("_own"), place.alias("place"), body.alias("text"))
    joined = rows.join(F.broadcast(found) if weight <= FEW else found, F.col("_own") == F.col("_digest"), "left")
    joined = joined.select("row", "text", "spans", F.coalesce(F.col("place") > F.col("owner"), F.lit(False)).alias("copy"))
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(releasing(_kept_rows(settings)), f"row {kind}, kept binary, kept_sha256 string, n_words long, n_removed long, n_spans long")
