"""Isolation forest (Liu, Ting and Zhou 2008) as a Spark job.

Trees grow from small hash-chosen samples inside ``applyInPandas`` groups; scoring is a
vectorised Pandas UDF over all batches. Samples depend on row keys only, so the result is
the same for any partitioning.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwatch.functions.ranking import exact_quantiles
from lotwatch.params import DetectionParams
from lotwatch.session import materialize

# Workers get these functions by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Levels of a tree: the logarithm of the usual sample of 256 rows.
DEPTH = 8
INNER = 2**DEPTH - 1
HASH_RANGE = 2**31
_TREE_SCHEMA = "tree INT, feature ARRAY<INT>, cut ARRAY<DOUBLE>, leaf ARRAY<DOUBLE>"


def _mean_path(n: float) -> float:
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def grow_tree(points: np.ndarray, rng: np.random.Generator):
    """One tree in heap order; a leaf above the last level sends everything left."""
    feature = np.zeros(INNER, dtype=np.int32)
    cut = np.full(INNER, np.inf)
    leaf = np.zeros(INNER + 1)
    todo = [(0, 0, points)]
    while todo:
        node, depth, rows = todo.pop()
        spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(points.shape[1])
        if depth == DEPTH or len(rows) <= 1 or not spread.any():
            bottom = node
            for _ in range(DEPTH - depth):
                bottom = 2 * bottom + 1
            leaf[bottom - INNER] = depth + _mean_path(len(rows))
            continue
        f = int(rng.choice(np.flatnonzero(spread)))
        low, high = rows[:, f].min(), rows[:, f].max()
        at = max(rng.uniform(low, high), np.nextafter(low, high))
        feature[node], cut[node] = f, at
        right = rows[:, f] >= at
        todo.append((2 * node + 1, depth + 1, rows[~right]))
        todo.append((2 * node + 2, depth + 1, rows[right]))
    return feature, cut, leaf


@dataclass(frozen=True)
class Forest:
    """Trees of fixed size (255 cuts, 256 leaves each), small enough to broadcast."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    sample_size: int


def forest_score(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray,
                 sample_size: int) -> np.ndarray:
    paths = np.zeros(len(x))
    rows = np.arange(len(x))
    for tree_feature, tree_cut, tree_leaf in zip(feature, cut, leaf):
        node = np.zeros(len(x), dtype=np.int32)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, tree_feature[node]] >= tree_cut[node])
        paths += tree_leaf[node - INNER]
    return np.exp2(-paths / (len(leaf) * _mean_path(sample_size)))


def fit(df: DataFrame, key: str, features: list[str], total: int, trees: int, sample: int,
        seed: int = 42) -> Forest:
    """Grow the forest, each tree from the ``sample`` rows with the smallest hash of (key, tree).

    Every row of the table is a candidate for every tree. A hash threshold lets about twice the
    sample through for each, so what is shuffled depends on the forest, not on the table.
    """
    row_hash = lambda t: F.pmod(F.xxhash64(F.col(key), t), F.lit(HASH_RANGE))
    below = int(min(1.0, 2 * sample / max(total, 1)) * HASH_RANGE)
    rows = df.select(key, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    ids = F.array(*[F.lit(t) for t in range(trees)])
    sampled = rows.withColumn(
        "tree", F.explode(F.filter(ids, lambda t: row_hash(t) < below))
    ).withColumn("_h", row_hash(F.col("tree")))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_h", key]).head(sample)
        tree = int(group["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        feature, cut, leaf = grow_tree(group[features].to_numpy(dtype=float), rng)
        return pd.DataFrame({"tree": [tree], "feature": [feature], "cut": [cut], "leaf": [leaf]})

    grown = sampled.groupBy("tree").applyInPandas(grow, _TREE_SCHEMA).collect()
    grown.sort(key=lambda row: row["tree"])
    return Forest(
        np.array([r["feature"] for r in grown], dtype=np.int32),
        np.array([r["cut"] for r in grown]),
        np.array([r["leaf"] for r in grown]),
        min(sample, total),
    )


def score(df: DataFrame, forest: Forest, features: list[str]) -> DataFrame:
    """Add ``outlier_score`` in (0, 1]."""
    spark: SparkSession = df.sparkSession
    shared = spark.sparkContext.broadcast(
        (forest.feature, forest.cut, forest.leaf, forest.sample_size))

    @F.pandas_udf("double")
    def isolation(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        # Many batches share a point, so each distinct one is scored once.
        points, position = np.unique(x, axis=0, return_inverse=True)
        return pd.Series(forest_score(points, *shared.value)[position.ravel()])

    inputs = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]
    return df.withColumn("outlier_score", isolation(*inputs))


def flag_outliers(batches: DataFrame, params: DetectionParams) -> DataFrame:
    """batch_id, outlier_score, is_outlier: the highest-scoring share of the batches."""
    features = ["observed_defect_rate", "fail_count"]
    points = materialize(batches.select("batch_id", *features))
    total = points.count()
    if total < params.min_outlier_rows:
        return points.select("batch_id", F.lit(0.0).alias("outlier_score"),
                             F.lit(False).alias("is_outlier"))
    forest = fit(points, "batch_id", features, total, params.outlier_trees, params.outlier_sample)
    scores = score(points, forest, features).select("batch_id", "outlier_score")
    cut = exact_quantiles(scores, [], "outlier_score", [1 - params.contamination], ["cut"]).first()["cut"]
    return scores.withColumn("is_outlier", F.col("outlier_score") > cut)
