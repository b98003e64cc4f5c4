"""Near-duplicate documents by HyperMinHash.

A document's shingles are hashed once. The leading bits of a hash pick one of the registers; the smallest rest
per register is kept as its number of leading zeros plus a few mantissa bits (16 bits in all). Bands of
compressed registers, which cover all registers, give the buckets; the Jaccard estimate of two sketches, corrected for chance collisions of
registers, drops poor candidates; the links are then confirmed on the full shingle sets.

No bucket is expanded into all its pairs. Texts with equal shingle sets are one class. Each bucket first compares its members
with a hub, the member that meets most others over all bands. Only buckets that still span several components
go on: there, members of different components are compared in blocks of a bounded number of members, so that no link between
components is lost whatever the size of a bucket. A block's memory grows with the length of its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, releasing, written
from retentia.llm.components import connected_components
from retentia.llm.texthash import U, WordHasher, shingle_hashes, slices, text_buffer

REGISTER_BITS, MANTISSA_BITS = 7, 10
REGISTERS = 1 << REGISTER_BITS
BYTES_AT_ONCE = 4 << 20
BLOCK = 512  # members of a bucket compared with as many others in one task
BROADCAST_IDS = 1_000_000  # ids; above, the same join is shuffled
COLLISION = 0.169919487  # of two unequal registers, times 2**-mantissa bits and the evenness of the sizes


@dataclass(frozen=True)
class NearDuplicates:
    words: int = 5
    threshold: tuple[int, int] = (85, 100)
    rows: int = 5  # registers per band, the last band has the rest: a pair at 0.85 misses all bands with a chance of 2e-7
    slack: float = 0.15  # pairs estimated lower than threshold - slack are dropped; 4.7 deviations at 128 registers

    @property
    def bands(self) -> int:
        return -(-REGISTERS // self.rows)

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """The sorted distinct shingle hashes; a shorter text is one shingle, no words none."""
        if not len(words):
            return np.zeros(0, U)
        return np.unique(shingle_hashes(words, min(self.words, len(words))))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of sorted distinct hashes; 0 is an empty register."""
    out = np.zeros(REGISTERS, np.uint16)
    first = np.searchsorted(hashes, np.arange(REGISTERS, dtype=U) << U(64 - REGISTER_BITS))
    filled = np.flatnonzero(np.diff(np.append(first, len(hashes))) > 0)
    rest = hashes[first[filled]] << U(REGISTER_BITS)
    zeros = (53 - np.frexp((rest >> U(11)).astype(np.float64))[1]).astype(U)
    mantissa = (rest << (zeros + U(1))) >> U(64 - MANTISSA_BITS)
    out[filled] = ((zeros + U(1)) << U(MANTISSA_BITS)) | mantissa
    return out


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates of sketches (row by row) of sets of n and m shingles, corrected for chance collisions."""
    same = ((a == b) & (a > 0)).sum(-1)
    either = np.maximum(((a > 0) | (b > 0)).sum(-1), 1)
    even = 4 * n * m / np.maximum((n + m) ** 2.0, 1)
    chance = (either - same) * COLLISION * even * 2.0**-MANTISSA_BITS
    return np.clip((same - chance) / either, 0, 1)


SKETCH = "doc_id long, n_shingles int, digest binary, registers binary"


def _sketched(settings: NearDuplicates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            data, starts = text_buffer(batch.column("text"))
            for a, b in slices(starts, BYTES_AT_ONCE):
                words, at = hasher(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
                counts, digests, sketches = [], [], []
                for i in range(b - a):
                    hashes = settings.shingles(words[at[i] : at[i + 1]])
                    counts.append(len(hashes))
                    digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                    sketches.append(registers(hashes).tobytes())
                columns = [batch.column("doc_id").slice(a, b - a), pa.array(counts, pa.int32()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "registers"])

    return run


def _sketch_matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), REGISTERS)


def _likely(settings: NearDuplicates):
    least = settings.threshold[0] / settings.threshold[1] - settings.slack

    @F.pandas_udf("boolean")
    def likely(a: pd.Series, b: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        if a.empty:
            return pd.Series([], dtype=bool)
        return pd.Series(estimate(_sketch_matrix(a), _sketch_matrix(b), n.to_numpy(float), m.to_numpy(float)) >= least)

    return likely


def _confirmed(settings: NearDuplicates):
    part, whole = settings.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()

        def sets(column: pa.Array) -> list[np.ndarray]:
            unique = column.dictionary_encode()  # a hub's text is hashed once per batch
            data, starts = text_buffer(unique.dictionary)
            out = []
            for a, b in slices(starts, BYTES_AT_ONCE):
                words, at = hasher(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
                out += [settings.shingles(words[at[i] : at[i + 1]]) for i in range(b - a)]
            return [out[i] for i in unique.indices.to_pylist()]

        for batch in batches:
            keep = []
            for x, y in zip(sets(batch.column("text_a")), sets(batch.column("text_b")), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(whole * both >= part * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _across(part: pd.DataFrame, sketch: np.ndarray, settings: NearDuplicates) -> Iterator[tuple[int, np.ndarray]]:
    """For each member of a block, the later members of other components that are likely partners.

    A pair that shares several buckets counts in the first of its bands alone.
    """
    least, ratio = settings.threshold[0] / settings.threshold[1] - settings.slack, settings.threshold[0] / settings.threshold[1]
    label, n, side, band = (part[c].to_numpy() for c in ("label", "n_shingles", "side", "band"))
    whole = np.pad(sketch, ((0, 0), (0, settings.bands * settings.rows - REGISTERS)))
    banded = whole.reshape(len(sketch), settings.bands, settings.rows)
    filled = banded.any(-1)
    for i in range(len(part) - 1):
        rows = np.arange(i + 1, len(part))
        small, large = np.minimum(n[i], n[rows]), np.maximum(n[i], n[rows])
        rows = rows[(label[rows] != label[i]) & (small >= ratio * large) & ((side[rows] != side[i]) | (side[i] == 2))]
        if len(rows):
            rows = rows[estimate(sketch[rows], sketch[i], n[rows].astype(float), float(n[i])) >= least]
        if len(rows):
            rows = rows[((banded[rows] == banded[i]).all(-1) & filled[i]).argmax(-1) == band[i]]
        if len(rows):
            yield i, rows


def _active(settings: NearDuplicates):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        found = []
        for key, part in group.groupby("key", sort=False):
            ids = part["id"].to_numpy()
            hit = np.zeros(len(ids), bool)
            for i, rows in _across(part, _sketch_matrix(part["registers"]), settings):
                hit[i] = hit[rows] = True
            found.append(pd.DataFrame({"key": key, "id": ids[hit]}, dtype="int64"))
        return pd.concat(found)

    return run


def _linked(settings: NearDuplicates):
    share, whole = settings.threshold

    def run(group: pd.DataFrame) -> pd.DataFrame:
        hasher, known, found = WordHasher(), {}, []
        for text in group["text"].unique():
            data = np.frombuffer(text.encode(), np.uint8)
            known[text] = settings.shingles(hasher(data, np.array([0, len(data)]))[0])
        for _, part in group.groupby("key", sort=False):
            ids, label = part["id"].to_numpy(), part["label"].to_numpy()
            sets = [known[text] for text in part["text"]]
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while parent.get(x, x) != x:
                    x = parent[x]
                return x

            for i, rows in _across(part, np.stack([registers(x) for x in sets]), settings):
                for j in rows:
                    if (a := root(label[i])) == (b := root(label[j])):
                        continue  # connected by a link found here already
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if whole * both >= share * (len(sets[i]) + len(sets[j]) - both):
                        parent[a] = b
                        found.append((ids[i], ids[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


class _Finder:
    """The steps of one search; the written tables are shared by its steps."""

    def __init__(self, docs: DataFrame, key: str, text: str, settings: NearDuplicates) -> None:
        self.settings = settings
        self.docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
        self.sketches = written(self.docs.mapInArrow(releasing(_sketched(settings)), SKETCH), "sketches")
        known = self.sketches.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
        # Equal shingle sets are one class, known by its smallest id.
        self.classes = known.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
        self.classes = written(self.classes, "classes")

    def members(self) -> DataFrame:
        """(key, band, id, size) of the buckets with two classes or more."""
        width = 2 * self.settings.rows
        sizes = [min(width, 2 * REGISTERS - i * width) for i in range(self.settings.bands)]
        bands = [F.substring("registers", i * width + 1, size) for i, size in enumerate(sizes)]
        keys = F.array(*[F.when(b != F.lit(bytes(size)), F.xxhash64(F.lit(i), b)) for i, (b, size) in enumerate(zip(bands, sizes, strict=True))])
        rows = self.classes.select("id", F.posexplode(keys).alias("band", "key")).where(F.col("key").isNotNull()).distinct()
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
        return written(rows.join(sizes, "key"), "members")

    def star_pairs(self, members: DataFrame) -> DataFrame:
        """Each member with its bucket's hub, once over all buckets."""
        meets = members.groupBy("id").agg(F.sum("size").alias("meets"))
        ranked = members.join(meets, "id").groupBy("key").agg(F.max_by("id", F.struct("meets", -F.col("id"))).alias("hub"))
        pairs = members.join(ranked, "key").where(F.col("id") != F.col("hub"))
        return pairs.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()

    def _dealt(self, rows: DataFrame, tasks: int) -> DataFrame:
        """Small buckets share ``tasks`` tasks; a large one has a task for each two of its blocks."""
        sizes = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        rows = rows.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
        shared = F.pmod(F.xxhash64("key"), F.lit(max(8, tasks)))
        rows = rows.withColumn("task", F.when(F.col("blocks") == 1, shared).otherwise(F.col("key")))
        side = F.when(F.col("low") == F.col("high"), 2).when(F.col("own") == F.col("low"), 0).otherwise(1)
        return rows.withColumn("side", side).drop("own", "other", "blocks", "size")

    def rest_links(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Links across the components of a bucket.

        The sketches tell which members have a likely partner; the texts of those go to the blocks, where pairs are
        confirmed and a link is reported only if it connects what the block's links don't connect yet.
        """
        marked = members.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
        several = marked.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where(F.col("low") != F.col("high")).select("key")
        marked = marked.join(several, "key").join(self.classes.select("id", "n_shingles", "registers"), "id")
        marked = written(marked, "across")
        block = ["task", "low", "high"]
        dealt = self._dealt(marked, marked.count() // 20_000)
        active = written(dealt.groupBy(*block).applyInPandas(_active(self.settings), "key long, id long").distinct(), "active")
        rows = marked.drop("registers").join(active, ["key", "id"])
        bytes_ = rows.agg(F.sum("n_shingles")).first()[0] or 0
        texts = self._texts(active.select(F.col("id").alias("doc_id")).distinct(), "active")
        rows = rows.join(texts.distinct().withColumnRenamed("doc_id", "id"), "id")
        dealt = self._dealt(rows, 8 * bytes_ // (16 << 20))
        return dealt.groupBy(*block).applyInPandas(_linked(self.settings), "a long, b long")

    def _texts(self, ids: DataFrame, name: str) -> DataFrame:
        """The texts of the ids, which are broadcast only if they are few."""
        ids = written(ids, f"{name}-ids")
        return written(self.docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi"), f"{name}-texts")

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs whose full shingle sets reach the threshold."""
        sketch = self.classes.select("id", "n_shingles", "registers")
        for end in ("a", "b"):
            pairs = pairs.join(sketch.select(F.col("id").alias(end), F.col("n_shingles").alias(f"n_{end}"), F.col("registers").alias(f"r_{end}")), end)
        pairs = pairs.where(_likely(self.settings)("r_a", "r_b", "n_a", "n_b")).select("a", "b")
        pairs = written(pairs, f"{name}-pairs")
        texts = self._texts(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), name)
        for end in ("a", "b"):
            pairs = pairs.join(texts.select(F.col("doc_id").alias(end), F.col("text").alias(f"text_{end}")), end)
        return written(pairs.mapInArrow(releasing(_confirmed(self.settings)), "a long, b long"), f"{name}-links")

    def components(self) -> DataFrame:
        members = self.members()
        links = self.links(self.star_pairs(members), "star")
        labels = connected_components(links)
        return connected_components(links.unionByName(self.rest_links(members, labels)))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: NearDuplicates = NearDuplicates()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row: the smallest id reachable over near-duplicate links.

    Null and empty texts and texts of white space have no shingles and link with nothing. Rows with a null key
    can't be named as partners: component null, kept. Rows that repeat a key are one node, so what their texts
    link to is connected. Texts of any length are compared whole, pieces of 4 MB at a time where they are hashed. An empty table gives an
    empty result. Columns other than key and text are not read, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    finder = _Finder(docs, key, text, settings)
    labels = finder.components().withColumnRenamed("node", "id").withColumnRenamed("label", "component_id")
    classes = finder.classes.select("digest", "id").join(labels, "id", "left")
    classes = classes.select("digest", F.coalesce("component_id", "id").alias("component_id"))
    rows = finder.sketches.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("digest")).alias("digest"))
    joined = rows.join(classes, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", F.col("n_shingles").cast("bigint").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
