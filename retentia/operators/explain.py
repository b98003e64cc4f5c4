"""Additive explanations in log-odds: one contribution per encoded feature plus a base value."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from retentia.functions.scalars import direction
from retentia.operators.preprocess import FEATURES, encoded_features
from retentia.session import scratch_path

TOP = 15
TABLE_FEATURES = 8  # of a leaf's path: a table of 2**8 patterns
BLOCK_ROWS = 4096  # rows whose node conditions are held at once


def linear_contributions(df: DataFrame, weights: Mapping[str, float], means: Mapping[str, Column | float]) -> Column:
    """Map feature -> weight * (value - mean) for columns with fixed weights."""
    pairs = [(F.lit(c), F.lit(float(w)) * (F.col(c) - means[c])) for c, w in weights.items()]
    return F.create_map(*chain.from_iterable(pairs))


def feature_means(df: DataFrame, columns: Sequence[str]) -> Column:
    """Means of several columns as one scalar subquery (a struct)."""
    return df.agg(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()


def top_attributions(df: DataFrame, contributions: str = "contributions", k: int = TOP) -> DataFrame:
    """(…, rank, feature, value, direction): the k largest contributions by size, per row, no shuffle."""
    entries = F.map_entries(contributions)
    by_size = F.array_sort(
        F.transform(entries, lambda e: F.struct((-F.abs(e["value"])).alias("size"), e["key"].alias("feature"), e["value"].alias("value")))
    )
    others = [c for c in df.columns if c != contributions]
    exploded = df.select(*others, F.posexplode(F.slice(by_size, 1, k)).alias("pos", "e"))
    return exploded.select(
        *others,
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("e.feature").alias("feature"),
        F.col("e.value").alias("value"),
        direction(F.col("e.value")).alias("direction"),
    )


def readable_feature(name: Column, known_columns: Sequence[str]) -> Column:
    """``categorical__Contract_One Year`` to "Contract: One Year"; the longest known column that fits wins."""
    kind = F.substring_index(name, "__", 1)
    rest = F.substring(name, F.length(kind) + 3, F.length(name))
    text = rest
    for column in sorted(known_columns, key=len):
        label = F.when(rest == column, F.lit(column)).when(
            F.startswith(rest, F.lit(f"{column}_")), F.concat(F.lit(f"{column}: "), F.substring(rest, F.lit(len(column) + 2), F.length(rest)))
        )
        text = F.coalesce(label, text)
    return F.when(~F.contains(name, F.lit("__")), name).when(kind == "categorical", text).otherwise(rest)


def with_linear_explanation(model: PipelineModel, df: DataFrame, background: DataFrame) -> DataFrame:
    """Add ``contributions`` and ``base_value`` for a pipeline that ends in a logistic regression.

    Feature j adds w_j * (x_j - mean_j); the means come from one pass over the background rows.
    """
    encoder, learner = model.stages[-2], model.stages[-1]
    weights = [float(w) for w in learner.coefficients.toArray()]
    summary = encoder.transform(background).select(vector_to_array(FEATURES).alias("x"))
    averages = summary.agg(*[F.avg(F.col("x")[j]).alias(f"m{j}") for j in range(len(weights))]).first()
    means = [averages[j] or 0.0 for j in range(len(weights))]
    names = F.array(*[F.lit(n) for n, _, _ in encoded_features(encoder)])
    values = F.transform(
        F.arrays_zip(
            vector_to_array(FEATURES).alias("x"), F.array(*map(F.lit, weights)).alias("w"), F.array(*map(F.lit, means)).alias("m")
        ),
        lambda e: e["w"] * (e["x"] - e["m"]),
    )
    base = learner.intercept + sum(w * m for w, m in zip(weights, means))
    return encoder.transform(df).select(*df.columns, F.map_from_arrays(names, values).alias("contributions"), F.lit(float(base)).alias("base_value"))


def tree_nodes(spark: SparkSession, learner) -> tuple[pd.DataFrame, dict[int, float]]:
    """The nodes and tree weights of a boosted model, read from its saved tables (model-sized)."""
    path = scratch_path(spark, "trees")
    learner.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    flat = nodes.select(
        "treeID",
        "id",
        "prediction",
        "rawCount",
        "leftChild",
        "rightChild",
        F.col("split.featureIndex").alias("feature"),
        F.col("split.leftCategoriesOrThreshold").alias("left"),
        F.col("split.numCategories").alias("categories"),
    )
    weights = {i: w for i, w in enumerate(learner.treeWeights)}
    return flat.toPandas(), weights


def leaf_paths(nodes: pd.DataFrame, weights: Mapping[int, float], scale: float = 2.0) -> list[tuple[float, list]]:
    """Every leaf as (value, [(feature, share of rows that pass, [(goes left, left values, categories)])]).

    Conditions on the same feature along a path merge into one entry: shares multiply.
    """
    leaves = []
    for tree, rows in nodes.groupby("treeID"):
        by_id = {r.id: r for r in rows.itertuples()}
        stack = [(by_id[0], {})]
        while stack:
            node, path = stack.pop()
            if node.leftChild < 0:
                leaves.append((scale * weights[tree] * node.prediction, [(f, z, c) for f, (z, c) in path.items()]))
                continue
            for child, goes_left in ((by_id[node.leftChild], True), (by_id[node.rightChild], False)):
                share, conditions = path.get(node.feature, (1.0, []))
                condition = (goes_left, np.asarray(node.left, dtype=float), node.categories)
                stack.append((child, {**path, node.feature: (share * child.rawCount / node.rawCount, [*conditions, condition])}))
    return leaves


def _in_left(x: np.ndarray, feature: int, left: tuple, categories: int) -> np.ndarray:
    """Whether a node sends each row to its left child."""
    return x[:, feature] <= left[0] if categories < 0 else np.isin(x[:, feature], left)


def _leaf_game(value: float, shares: Sequence[float], hits: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Shapley values of one leaf, an array per feature of its path.

    The game's value is v * prod(o_j for known j) * prod(z_j for the others), with o_j = the row meets the leaf's
    conditions on feature j and z_j = the share of training rows that do. Feature i gets v * (o_i - z_i) times the weighted
    coefficients of prod(z_j + o_j t) over the other features.
    """
    m = len(shares)
    size_weight = [math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)]
    out = []
    for i in range(m):
        coefficients = [np.ones(len(hits[0]))]
        for j in range(m):
            if j == i:
                continue
            grown = [shares[j] * c for c in coefficients] + [np.zeros(len(hits[0]))]
            for k, c in enumerate(coefficients):
                grown[k + 1] = grown[k + 1] + hits[j] * c
            coefficients = grown
        out.append(value * (hits[i] - shares[i]) * sum(w * c for w, c in zip(size_weight, coefficients)))
    return out


class LeafTables:
    """The leaves of a tree ensemble, with their Shapley values by the pattern of met conditions.

    A row meets a leaf's conditions on m features in one of 2**m patterns, and the pattern alone decides what the leaf gives
    to each feature. So each leaf has a table of m values per pattern, built once, and a block of rows needs one
    pattern per leaf and a look-up. Leaves of more than ``TABLE_FEATURES`` features have no table and are computed row by row.
    """

    def __init__(self, leaves: Sequence[tuple[float, list]]) -> None:
        self.nodes: list[tuple[int, tuple, int]] = []
        place: dict[tuple, int] = {}
        self.leaves = []
        for value, path in leaves:
            if not path:
                continue
            conditions = []
            for feature, _, own in path:
                met = []
                for goes_left, left, categories in own:
                    node = (feature, tuple(left.tolist()), categories)
                    if node not in place:
                        place[node] = len(self.nodes)
                        self.nodes.append(node)
                    met.append((place[node], goes_left))
                conditions.append(met)
            shares = [z for _, z, _ in path]
            self.leaves.append((value, [f for f, _, _ in path], shares, conditions, self._table(value, shares)))

    @staticmethod
    def _table(value: float, shares: list[float]) -> np.ndarray | None:
        m = len(shares)
        if m > TABLE_FEATURES:
            return None
        patterns = np.arange(1 << m)
        return np.stack(_leaf_game(value, shares, [((patterns >> j) & 1).astype(float) for j in range(m)]))

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """Shapley values for a block of rows, one column per feature."""
        parts = [self._block(x[a : a + BLOCK_ROWS]) for a in range(0, len(x), BLOCK_ROWS)]
        return np.concatenate(parts) if parts else np.zeros(x.shape)

    def _block(self, x: np.ndarray) -> np.ndarray:
        lefts = [_in_left(x, *node) for node in self.nodes]
        out = np.zeros(x.shape[::-1])
        for value, features, shares, conditions, table in self.leaves:
            hits = []
            for met in conditions:
                hit = None
                for node, goes_left in met:
                    one = lefts[node] if goes_left else ~lefts[node]
                    hit = one if hit is None else hit & one
                hits.append(hit)
            if table is None:
                values = _leaf_game(value, shares, [h.astype(float) for h in hits])
            else:
                pattern = np.zeros(len(x), np.int64)
                for j, hit in enumerate(hits):
                    pattern |= hit.astype(np.int64) << j
                values = table[:, pattern]
            for feature, added in zip(features, values):
                out[feature] += added
        return out.T


def tree_contributions(x: np.ndarray, leaves: Sequence[tuple[float, list]]) -> np.ndarray:
    """Shapley values of a tree ensemble for a block of rows, one column per feature."""
    return LeafTables(leaves).contributions(x)


def with_tree_explanation(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``contributions`` and ``base_value`` for a pipeline that ends in boosted trees, in log-odds.

    Trees go to the tasks as one broadcast of model size; rows stay where they are.
    """
    encoder, learner = model.stages[-2], model.stages[-1]
    leaves = leaf_paths(*tree_nodes(df.sparkSession, learner))
    base = float(sum(v * math.prod(z for _, z, _ in path) for v, path in leaves))
    shared = df.sparkSession.sparkContext.broadcast(LeafTables(leaves))

    def explain(x: pd.Series) -> pd.Series:
        return pd.Series(list(shared.value.contributions(np.stack(x.to_numpy()))) if len(x) else [])

    values = F.pandas_udf(explain, ArrayType(DoubleType()))(vector_to_array(FEATURES))
    names = F.array(*[F.lit(n) for n, _, _ in encoded_features(encoder)])
    return encoder.transform(df).select(*df.columns, F.map_from_arrays(names, values).alias("contributions"), F.lit(base).alias("base_value"))
