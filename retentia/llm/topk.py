"""Exact top-k inner products by a three-phase uniform threshold.

A vector's dimensions are split into lists; a score is the sum of its lists' partial scores. Phase 1 takes each
query's best entries of every list and block and scores them in full: the k-th best of these is a safe cutoff,
since the true k-th score can't be lower. Phase 2 collects every entry with a partial score of at least
cutoff / number of lists in any list: a score of the cutoff or more has such a list. Phase 3 adds up the
remaining lists of what was collected and keeps what reaches the cutoff. Queries and candidates meet block by
block; a block has a fixed number of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retentia.llm.common import written

ROWS_IN_BLOCK = 8192  # candidates
QUERIES_IN_BLOCK = 1024
RESULT = "query_id long, vec_id long, score long"


def _matrix(values: pd.Series, floats: bool) -> np.ndarray:
    """Whole numbers as doubles where every inner product stays exact in a double, else as 64-bit integers."""
    return np.array(values.tolist(), dtype=np.float64 if floats else np.int64).reshape(len(values), -1)


def _pair(left: pd.DataFrame, right: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    size = max(len(left["values"].iloc[0]), 1)
    peak = max(float(left["peak"].max()), float(right["peak"].max()))
    floats = peak * peak * size < 2.0**52
    return _matrix(left["values"], floats), _matrix(right["values"], floats)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        at_least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= at_least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def _lists(size: int, lists: int) -> list[slice]:
    edges = np.linspace(0, size, min(lists, max(size, 1)) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _first_phase(k: int, lists: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or rows.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        q, x = _pair(queries, rows)
        ids = rows["vec_id"].to_numpy()
        parts = [q[:, s] @ x[:, s].T for s in _lists(q.shape[1], lists)]
        out = []
        for i, own in enumerate(queries["vec_id"].to_numpy()):
            other = np.flatnonzero(ids != own)
            seen = np.unique(np.concatenate([other[_best(ids[other], p[i, other], k)] for p in parts]))
            total = sum(p[i, seen] for p in parts).astype(np.int64)
            best = _best(ids[seen], total, k)
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids[seen[best]], "score": total[best]}))
        return pd.concat(out).astype("int64")

    return run


def _other_phases(k: int, lists: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or rows.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        q, x = _pair(queries, rows)
        ids = rows["vec_id"].to_numpy()
        cuts = queries["cutoff"].to_numpy().astype(q.dtype)
        parts = [q[:, s] @ x[:, s].T for s in _lists(q.shape[1], lists)]
        n, out = len(parts), []
        collected = np.zeros(parts[0].shape, bool)
        for p in parts:
            collected |= p * n >= cuts[:, None]
        for i, own in enumerate(queries["vec_id"].to_numpy()):
            some = np.flatnonzero(collected[i] & (ids != own))
            total = sum(p[i, some] for p in parts).astype(np.int64)
            some, total = some[total >= cuts[i]], total[total >= cuts[i]]
            best = _best(ids[some], total, k)
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids[some[best]], "score": total[best]}))
        return pd.concat(out).astype("int64")

    return run


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, values, peak) with floor(scale * x) for every component; peak is the largest magnitude.

    Left out: null keys and vectors that are null or hold a null, infinite or undefined component.
    """
    values = F.transform(F.col(vector), lambda x: F.floor(F.lit(scale).cast("double") * x.cast("double")))
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False)))
    rows = rows.select(F.col(key).cast("bigint").alias("vec_id"), values.alias("values"))
    return rows.withColumn("peak", F.coalesce(F.array_max(F.transform("values", lambda x: F.abs(x).cast("double"))), F.lit(0.0)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, lists: int = 4) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products, ties to the smaller vec_id.

    Both inputs are ``whole_vectors``. A query's own row (the same vec_id) is no candidate; fewer than k
    candidates are all returned. Only vectors of the query's length are compared. Rows repeated under one
    vec_id each take a rank of their own. Empty inputs give an empty result. Vectors of any length are read whole; other
    columns of the table were left behind by ``whole_vectors``.
    """
    vectors, queries = written(vectors, "vectors"), written(queries, "queries")
    sizes = [c.select(F.count(F.lit(1)).alias("n")).first()["n"] for c in (vectors, queries)]
    blocks, query_blocks = max(1, -(-sizes[0] // ROWS_IN_BLOCK)), max(1, -(-sizes[1] // QUERIES_IN_BLOCK))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        at = F.pmod(F.xxhash64("vec_id", "values"), F.lit(n_own)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        return df.withColumn("size", F.size("values")).withColumn(own, at).withColumn(other, copies)

    block = ["size", "block", "query_block"]
    rows = dealt(vectors, "block", blocks, "query_block", query_blocks).groupBy(*block)
    asked = dealt(queries, "query_block", query_blocks, "block", blocks)
    seen = asked.groupBy(*block).cogroup(rows).applyInPandas(_first_phase(k, lists), RESULT)
    lowest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    cutoffs = seen.withColumn("place", F.row_number().over(lowest)).where(F.col("place") <= k).groupBy("query_id")
    # With fewer than k entries seen every candidate is needed.
    floor = F.lit(-(2**62)).cast("bigint")
    cutoffs = cutoffs.agg(F.when(F.count(F.lit(1)) < k, floor).otherwise(F.min("score")).alias("cutoff"))
    cutoffs = written(cutoffs, "cutoffs")
    bounded = asked.join(cutoffs, asked["vec_id"] == cutoffs["query_id"]).drop("query_id")
    found = bounded.groupBy(*block).cogroup(rows).applyInPandas(_other_phases(k, lists), RESULT)
    ranked = found.withColumn("rank", F.row_number().over(lowest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
