"""Repeated byte strings: every byte covered by a string of a given length that also starts elsewhere.

A suffix's match with an earlier or later one counts here once it reaches ``length`` bytes, so suffixes need an
order by their first ``length`` bytes only; those that agree in them stand together. The work follows that order
without building it whole, which would take several bytes per byte of text:

1. Each window of ``length`` bytes picks an anchor, its smallest k-gram hash. Equal windows have equal anchors at
   equal offsets, and there is about one anchor per 170 bytes. Windows whose anchor is unique can't repeat.
2. The windows of an anchor fall into cells of 32 neighbouring offsets. The bytes common to a cell's windows (its
   core) must repeat; and where all the cell's bytes repeat, so do all its windows.
3. Only where that leaves a cell open are its windows compared one by one.

Groups meet by hash; counts of two or more are found by the smallest and largest place, which combine on the map
side, so no group is gathered in one task. Exact copies are one text. The core and the window hashes are
independent, 128 bits together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, matched, written
from retentia.llm.texthash import BASE, U, byte_codes, inverse, mixed, powers

LENGTH = 400
GRAM = 64
CELL = 32
PIECE = 1 << 20  # window starts handled at once
FEW = 1_000_000  # digests of 16 bytes, or stretches, that may be broadcast; above, the same joins are shuffled
BITS = U(24)


class _Rolling:
    """Hashes of any stretch of a piece of text, from sums over its bytes."""

    def __init__(self, seed: int) -> None:
        self.codes, self.base = byte_codes(seed), BASE + U(seed << 20)
        self.powers, self.inverses = powers(self.base, 0), powers(inverse(self.base), 0)

    def over(self, data: np.ndarray) -> np.ndarray:
        if len(data) > len(self.powers):
            n = max(len(data), 1 << 16)
            self.powers, self.inverses = powers(self.base, n + 1), powers(inverse(self.base), n + 1)
        sums = np.zeros(len(data) + 1, U)
        np.cumsum(self.codes[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.inverses[start])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The smallest of every w consecutive entries: suffix minima of one block meet prefix minima of the next."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(U).max, U)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def _anchors(data: np.ndarray, rolling: _Rolling, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(place, first window, last window, hash) of the anchors of one text."""
    out = []
    for a in range(0, len(data) - length + 1, PIECE):
        part = data[a : a + PIECE + length - 1]
        sums = rolling.over(part)
        at = np.arange(len(part) - gram + 1)
        hashes = rolling.of(sums, at, at + gram)
        low = _sliding_min((hashes & ~((U(1) << BITS) - U(1))) | at.astype(U), length - gram + 1)
        place = (low & ((U(1) << BITS) - U(1))).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        last = np.append(first[1:], len(place)) - 1
        out.append((place[first] + a, first + a, last + a, hashes[place[first]].view(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = _Rolling(1)
        for batch in batches:
            for digest, text in zip(batch.column("digest"), batch.column("text")):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                place, first, last, key = _anchors(data, rolling, length, gram)
                same = pa.array([digest.as_py()] * len(place), pa.binary())
                columns = [same, pa.array(place, pa.int32()), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(key, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "place", "first", "last", "key"])

    return run


def _cell_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core_hash, span_hash = _Rolling(1), _Rolling(2)
        for batch in batches:
            for digest, text, list_ in zip(batch.column("digest"), batch.column("text"), batch.column("anchors")):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                anchors = list_.values
                place, first, last = (anchors.field(c).to_numpy().astype(np.int64) for c in ("place", "first", "last"))
                low, high = (first - place) // CELL, (last - place) // CELL
                n = high - low + 1
                each = np.repeat(np.arange(len(place)), n)
                cell = low[each] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.maximum(place[each] + cell * CELL, first[each])
                end = np.minimum(place[each] + cell * CELL + CELL - 1, last[each])
                at = place[each] + cell * CELL + CELL - 1
                one, two = core_hash.over(data), span_hash.over(data)
                core = mixed(core_hash.of(one, at, at - CELL + 1 + length) + (cell + (1 << 20)).astype(U))
                span = mixed(span_hash.of(two, start, end + length) + ((start - place[each] + (1 << 20)) * CELL + (end - start)).astype(U))
                columns = [pa.array([digest.as_py()] * len(at), pa.binary()), pa.array(core.view(np.int64)), pa.array(span.view(np.int64))]
                columns += [pa.array(c, pa.int32()) for c in (at, start, end)]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "core", "span", "at", "start", "end"])

    return run


def _window_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = _Rolling(2)
        for batch in batches:
            for digest, text, list_ in zip(batch.column("digest"), batch.column("text"), batch.column("cells")):
                sums = rolling.over(np.frombuffer(text.as_buffer(), np.uint8))
                cells = list_.values
                start, end, n = (cells.field(c).to_numpy().astype(np.int64) for c in ("start", "end", "n"))
                count = end - start + 1
                each = np.repeat(np.arange(len(start)), count)
                at = start[each] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                window = rolling.of(sums, at, at + length).view(np.int64)
                core = cells.field("core").to_numpy()[each]
                columns = [pa.array([digest.as_py()] * len(at), pa.binary()), pa.array(core), pa.array(window), pa.array(at, pa.int32()), pa.array(n[each], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "core", "window", "start", "n"])

    return run


def _merged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching stretches of a text become one."""
    for batch in batches:
        out = []
        for spans in batch.column("spans"):
            start, end = (spans.values.field(c).to_numpy() for c in ("start", "end"))
            order = np.argsort(start, kind="stable")
            start, reach = start[order], np.maximum.accumulate(end[order])
            first = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
            out.append([{"start": int(a), "end": int(b)} for a, b in zip(start[first], reach[np.append(first[1:], len(start)) - 1])])
        yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(out, batch.schema.field("spans").type)], ["digest", "spans"])


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, removed, runs = [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            data = text.as_buffer()
            if not spans.is_valid:
                kept, removed, runs = [*kept, data.to_pybytes()], [*removed, 0], [*runs, 0]
                continue
            whole = np.frombuffer(data, np.uint8)
            edges = np.zeros(len(whole) + 1, np.int64)
            np.add.at(edges, spans.values.field("start").to_numpy(), 1)
            np.add.at(edges, spans.values.field("end").to_numpy(), -1)
            covered = np.cumsum(edges)[:-1] > 0
            kept.append(whole[~covered].tobytes())
            removed.append(int(covered.sum()))
            runs.append(int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum()))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64())], ["row", "kept", "n_removed", "n_spans"])


def _several(rows: DataFrame, keys: list[str], place: Column) -> DataFrame:
    """The keys that have two places or more, with their number of rows."""
    counts = rows.groupBy(*keys).agg((F.min(place) != F.max(place)).alias("several"), F.count(F.lit(1)).alias("n_rows"))
    return counts.where("several").drop("several")


def _texts(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (one row per digest) with the text, once per digest."""
    ids = wanted.select("digest")
    some = base.join(F.broadcast(ids) if ids.count() <= FEW else ids, "digest", "left_semi")
    return some.groupBy("digest").agg(F.first("text").alias("text")).join(wanted, "digest")


def repeated_spans(base: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(digest, spans): the stretches of each text to remove, apart from each other; only texts that have any.

    ``base`` has (digest, text as bytes); equal digests are equal texts.
    """
    if not CELL < gram <= length - 2 * CELL:
        raise ValueError("a gram is longer than a cell and much shorter than the strings")
    long = base.where(F.octet_length("text") >= length)
    anchors = written(long.mapInArrow(_anchor_rows(length, gram), "digest binary, place int, first int, last int, key long"), "anchors")
    repeated = written(_several(anchors, ["key"], F.xxhash64("digest", "place")), "repeated")
    candidates = matched(anchors, repeated, ["key"], FEW).groupBy("digest").agg(F.collect_set(F.struct("place", "first", "last")).alias("anchors"))
    candidates = written(candidates, "candidates")
    cells = _texts(long, candidates).mapInArrow(_cell_rows(length), "digest binary, core long, span long, at int, start int, end int")
    cells = written(cells, "cells")

    cores = written(_several(cells, ["core"], F.xxhash64("digest", "at")), "cores")
    likely = written(matched(cells, cores, ["core"], FEW).drop("at"), "likely")
    place = F.xxhash64("digest", "start")
    spans = likely.groupBy("core", "span").agg(
        (F.min(place) != F.max(place)).alias("several"),
        F.min(F.struct("digest", "start", "end")).alias("one"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    spans = written(spans, "spans")
    sure = matched(likely, spans.where("several").select("core", "span", "n_rows"), ["core", "span"], FEW).select("digest", "start", (F.col("end") + length).alias("end"))

    # Cells whose bytes are unique as a whole: their windows, against one example of every other cell of the core.
    open_cores = spans.groupBy("core").agg(F.max(~F.col("several")).alias("open"), F.count(F.lit(1)).alias("n")).where(F.col("open") & (F.col("n") > 1)).select("core")
    opened = spans.join(open_cores, "core").select("core", "one.*", F.when(F.col("several"), 2).otherwise(1).alias("n"))
    opened = opened.groupBy("digest").agg(F.collect_list(F.struct("core", "start", "end", "n")).alias("cells"))
    opened = written(opened, "opened")
    windows = _texts(long, opened).mapInArrow(_window_rows(length), "digest binary, core long, window long, start int, n int")
    windows = written(windows, "windows")
    twice = windows.groupBy("core", "window").agg(F.sum("n").alias("n")).where(F.col("n") > 1).select("core", "window")
    single = windows.where(F.col("n") == 1).join(twice, ["core", "window"]).select("digest", "start", (F.col("start") + length).alias("end"))

    copies = long.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("end")).where(F.col("n") > 1)
    copies = copies.select("digest", F.lit(0).alias("start"), "end")
    every = sure.unionByName(single).unionByName(copies)
    gathered = every.groupBy("digest").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return gathered.mapInArrow(_merged_rows, gathered.schema)


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """All columns of ``docs`` in ``row``, with ``kept`` (the remaining bytes), ``n_removed`` and ``n_spans``.

    Every byte goes that is covered by a string of ``length`` bytes that also starts anywhere else in the table;
    strings never cross documents and are judged on the input. Null texts count as empty; texts shorter than
    ``length`` stay whole; repeated rows are each other's copies. Texts of any length are read whole, a megabyte of windows at a
    time for their anchors. An empty table gives an empty result, and other columns may have any name.
    """
    bounded_batches(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    base = docs.select(F.unhex(F.md5(body)).alias("digest"), body.alias("text"))
    spans = written(repeated_spans(base, length, gram), "removed").withColumnRenamed("digest", "_digest")
    few = (spans.agg(F.sum(F.size("spans"))).first()[0] or 0) <= FEW
    rows = docs.select(F.struct("*").alias("row"), F.unhex(F.md5(body)).alias("_own"), body.alias("text"))
    joined = rows.join(F.broadcast(spans) if few else spans, F.col("_own") == F.col("_digest"), "left").select("row", "text", "spans")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_kept_rows, f"row {kind}, kept binary, n_removed long, n_spans long")
