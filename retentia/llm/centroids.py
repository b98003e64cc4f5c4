"""Exact k-means over whole-number vectors, with blocks of neighbours that leave far centroids out.

Vectors are sorted along a Hilbert curve through their most spread components and cut into blocks. A block keeps the
smallest and largest value of each component: its box. A centroid whose least distance to the box is above the largest distance of
another centroid to the box can't be the nearest of any vector in it, so only the other centroids, the block's
candidates, are compared with its vectors. Ties are kept among the candidates, so the result is that of comparing all.

The blocks are stored once. A round is one pass over them that returns sums and counts per centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, releasing, written

LIMIT = 1 << 27  # magnitude of a scaled component, so that distances of 64 components stay below 2**63
BLOCK_TYPE = "ids array<{id}>, cells binary, low array<long>, high array<long>"


@dataclass(frozen=True)
class ClusterSettings:
    clusters: int = 8
    rounds: int = 10
    size: int = 64  # components of a vector
    scale: int = 1024
    seed: int = 3
    block: int = 256  # vectors
    curve: tuple[int, int] = (8, 7)  # components of the curve, bits of each: 63 bits at most

    def __post_init__(self) -> None:
        if min(self.clusters, self.size, self.scale, self.block, *self.curve) < 1 or self.rounds < 0:
            raise ValueError("clusters, size, scale and block are positive")
        if self.curve[0] * self.curve[1] > 63:
            raise ValueError("a place on the curve has 63 bits at most")


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (whole numbers below 2**bits).

    The axes are first turned into the curve's transposed form by undoing, from the highest bit down, the exchanges and
    inversions of the subcubes; then Gray-decoded and interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        rest = bit - 1
        for i in range(axes):
            inverted = (x[i] & bit) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & rest)
            x[0] ^= np.where(inverted, rest, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((x[-1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    place = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            place = (place << 1) | ((x[i] >> b) & 1)
    return place


def whole_vectors(table: DataFrame, key: str, vector: str, settings: ClusterSettings) -> DataFrame:
    """(id, values) with floor(scale * x) for each component of the vectors that count.

    Vectors that are null, of another length, or hold a null or non-finite component are left out.
    """
    number = lambda x: x.cast("double")
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(number(x)) | (F.abs(number(x)) == F.lit(float("inf"))))
    rows = table.where(F.col(vector).isNotNull() & (F.size(vector) == settings.size) & ~F.coalesce(bad, F.lit(False)))
    scaled = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(settings.scale)) * number(x)).cast("bigint"))
    return rows.select(F.col(key).alias("id"), scaled.alias("values"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, size)


def _place_rows(axes: list[int], low: np.ndarray, width: np.ndarray, settings: ClusterSettings):
    bits = settings.curve[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = _matrix(batch.column("values"), settings.size)[:, axes]
            cells = np.minimum(((chosen - low) / width * (1 << bits)).astype(np.int64), (1 << bits) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert(cells, bits))], [*batch.schema.names, "place"])

    return run


def _block_rows(settings: ClusterSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values = batch.column("id"), _matrix(batch.column("values"), settings.size)
            cuts = range(0, batch.num_rows, settings.block)
            parts = [values[a : a + settings.block] for a in cuts]
            columns = [
                pa.array([ids[a : a + settings.block].to_pylist() for a in cuts], pa.list_(ids.type)),
                pa.array([p.astype(np.int32).tobytes() for p in parts], pa.binary()),
                pa.array([p.min(axis=0) for p in parts], pa.list_(pa.int64())),
                pa.array([p.max(axis=0) for p in parts], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["ids", "cells", "low", "high"])

    return run


def stored_blocks(vectors: DataFrame, settings: ClusterSettings) -> DataFrame:
    """The vectors in blocks along the curve, as a stored table of (ids, cells, low, high)."""
    spread = vectors.select(F.posexplode("values").alias("at", "x")).groupBy("at")
    spread = spread.agg(F.min("x").alias("low"), F.max("x").alias("high"), F.var_pop("x").alias("spread")).collect()  # a row per component
    wide = sorted(spread, key=lambda r: (-r["spread"], r["at"]))[: settings.curve[0]]
    if any(max(-r["low"], r["high"]) > LIMIT for r in spread):
        raise ValueError(f"a scaled component is beyond {LIMIT}: distances would not fit in a long")
    low, width = np.array([r["low"] for r in wide], np.int64), np.array([r["high"] - r["low"] + 1 for r in wide], np.float64)
    kind = vectors.schema["id"].dataType.simpleString()
    placed = vectors
    if wide:
        placed = vectors.mapInArrow(_place_rows([r["at"] for r in wide], low, width, settings), f"id {kind}, values array<long>, place long")
        parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        order = ["place", F.xxhash64("id", "values"), "id"]  # equal vectors need not share a task
        placed = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("place")
    return written(placed.mapInArrow(_block_rows(settings), BLOCK_TYPE.format(id=kind)), "blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be the nearest of a vector in the box."""
    gap = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    far = np.maximum(np.abs(centroids - low), np.abs(high - centroids))
    return np.flatnonzero((gap * gap).sum(axis=1) <= (far * far).sum(axis=1).min())


def nearest(values: np.ndarray, centroids: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector, among the centroids ``some``; the smaller number wins ties."""
    best = np.full(len(values), np.iinfo(np.int64).max)
    cluster = np.zeros(len(values), np.int64)
    for c in some:
        gap = values - centroids[c]
        distance = np.einsum("ij,ij->i", gap, gap)
        closer = distance < best
        best[closer], cluster[closer] = distance[closer], c
    return cluster, best


def _blocks(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(row, vectors, cluster, distance, number of candidates) of every block."""
    for i, (cells, low, high) in enumerate(zip(batch.column("cells"), batch.column("low"), batch.column("high"))):
        values = np.frombuffer(cells.as_buffer(), np.int32).reshape(-1, centroids.shape[1]).astype(np.int64)
        some = candidates(low.values.to_numpy(), high.values.to_numpy(), centroids)
        yield i, values, *nearest(values, centroids, some), len(some)


def _sum_rows(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, compared = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            for _, values, cluster, _, n in _blocks(batch, centroids):
                counts += np.bincount(cluster, minlength=len(centroids))
                compared[0] += n * len(values)
                for c in np.unique(cluster):
                    sums[c] += values[cluster == c].sum(axis=0)
        columns = [pa.array(range(len(counts)), pa.int32()), pa.array(counts), pa.array(compared), pa.array(list(sums), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "compared", "sums"])

    return run


def _assigned_rows(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, cluster, distance, _ in _blocks(batch, centroids):
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, pa.array(cluster, pa.int32()), pa.array(distance)], ["id", "cluster", "distance"])

    return run


def _first_centroids(vectors: DataFrame, settings: ClusterSettings) -> np.ndarray:
    """The vectors whose ids have the smallest hashes; of rows that share an id the smaller vectors come first."""
    digest = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(digest.alias("digest"), "values").orderBy("digest", "values").limit(settings.clusters).collect()
    return np.array([r["values"] for r in rows], np.int64).reshape(-1, settings.size)


def fit(blocks: DataFrame, centroids: np.ndarray, settings: ClusterSettings) -> tuple[np.ndarray, list[float]]:
    """(centroids after all rounds, per round the share of vector-centroid pairs that were compared).

    A round gathers one row per task and centroid, adds them up in Spark, and brings a row per centroid and component to the driver.
    """
    shares = []
    for _ in range(settings.rounds):
        parts = blocks.mapInArrow(releasing(_sum_rows(centroids)), "cluster int, n long, compared long, sums array<long>")
        sums = parts.select("cluster", "n", "compared", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at")
        rows = sums.agg(F.sum("n").alias("n"), F.sum("compared").alias("compared"), F.sum("x").alias("x")).collect()
        moved, count = centroids.copy(), {r["cluster"]: r["n"] for r in rows}
        for r in rows:
            if r["n"]:
                moved[r["cluster"], r["at"]] = r["x"] // r["n"]
        total = sum(count.values()) * len(centroids)
        shares.append(sum(r["compared"] for r in rows if r["at"] == 0) / total if total else 0.0)
        centroids = moved
    return centroids, shares


def cluster_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", settings: ClusterSettings = ClusterSettings()) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256) per vector that counts.

    ``centroid`` is the cluster's final centroid and ``distance`` the squared distance to it. Vectors that are null, of another length or with a
    null or non-finite component have no row. A null key hashes like an empty one; rows that repeat a key or a vector
    each count and each get a row; equal distances go to the smaller centroid number. With fewer vectors than
    clusters each starts a centroid of its own; without any the result is empty. Scaled components beyond 2**27 are an
    error. Other columns of the table are not read.
    """
    bounded_batches(table.sparkSession)
    vectors = written(whole_vectors(table, key, vector, settings), "vectors")
    start = _first_centroids(vectors, settings)
    blocks = stored_blocks(vectors, settings)
    centroids, _ = fit(blocks, start, settings)
    kind = vectors.schema["id"].dataType.simpleString()
    assigned = written(blocks.mapInArrow(releasing(_assigned_rows(centroids)), f"id {kind}, cluster int, distance long"), "assigned")
    inner = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # a row per cluster
    inertia = sum(inner.values())
    named = []
    for c, centroid in enumerate(centroids.tolist()):
        digest = hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
        named.append((c, inner.get(c, 0), inertia, centroid, digest))
    clusters = table.sparkSession.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
    columns = [F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256"]
    return assigned.join(F.broadcast(clusters), "cluster").select(*columns)
