"""Anomaly detection: Isolation Forest (N1) and agreement counts.

LOF (N2) lives with the other neighbour operators in
:mod:`paramo.operators.pairwise`.

Isolation Forest on Spark:

* per tree, a seeded uniform per row ``u = hash(key, seed, tree)``; each tree
  keeps the ``psi`` rows with the smallest ``u`` of all rows — a sample without
  replacement that does not depend on partitioning;
* ``groupBy(tree).applyInPandas`` grows each tree on its ``psi`` rows (random
  feature, uniform threshold, depth ``ceil(log2 psi)``) and returns it as
  node rows; the forest (at most trees x (2^(depth+1) - 1) nodes) is the model
  that reaches the driver;
* scoring is ``mapInPandas`` over all rows with the forest broadcast:
  ``score = -2^(-E[h(x)] / c(psi))``; anomalies are rows strictly below the
  ``contamination`` percentile of all scores (exact, distributed).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paramo.functions import pct_of
from paramo.operators.pairwise import flag_lowest
from paramo.plans.materialize import materialize
from paramo.sources.normals import KEY

_NODE_SCHEMA = "tree INT, node INT, feature INT, threshold DOUBLE, left INT, right INT, size INT, depth INT"


def _c(n):
    """Average path length of an unsuccessful search in a BST of n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + np.euler_gamma) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, len(idx), depth])
        if depth >= max_depth or len(idx) <= 1:
            return me
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        for f in rng.permutation(x.shape[1]):
            if hi[f] > lo[f]:
                thr = rng.uniform(lo[f], hi[f])
                left = idx[sub[:, f] <= thr]
                right = idx[sub[:, f] > thr]
                nodes[me][0], nodes[me][1] = int(f), float(thr)
                nodes[me][2] = build(left, depth + 1)
                nodes[me][3] = build(right, depth + 1)
                break
        return me

    build(np.arange(x.shape[0]), 0)
    return nodes


def tree_samples(points: DataFrame, features: Sequence[str], n: int, n_trees: int, psi: int, seed: int, key: str = KEY) -> DataFrame:
    """``(tree, key, u, *features)``: for every tree a uniform sample of all ``n`` rows that holds its ``psi`` smallest draws.

    Every row draws for every tree; draws above a rate sized for ``psi`` rows
    with a wide margin are dropped where they are made, so about twice
    ``psi`` rows a tree are shuffled, whatever the number of rows.  Should a
    tree have got too few, all draw again with a higher rate, to the same order."""
    rate = (psi + 10 * math.sqrt(psi) + 64) / max(n, 1)
    while True:
        u = F.pmod(F.xxhash64(F.col(key), F.lit(seed), F.col("tree")), F.lit(1 << 53)).cast("double") / float(1 << 53)
        drawn = points.select(key, *features).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1)))).withColumn("u", u)
        drawn = materialize(drawn.where(F.col("u") < min(rate, 2.0)), "tree_samples")
        if rate >= 1 or drawn.groupBy("tree").count().where(F.col("count") >= psi).count() == n_trees:
            return drawn
        rate *= 4


def isolation_forest(points: DataFrame, features: Sequence[str], n_trees: int = 100,
                     max_samples: int = 256, contamination: float = 0.05, seed: int = 42,
                     key: str = KEY) -> DataFrame:
    """``(key, anomaly_score_if, is_anomaly_if)``."""
    feats = list(features)
    spark = points.sparkSession
    n = points.count()
    psi = min(max_samples, n)
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    cand = tree_samples(points, feats, n, n_trees, psi, seed, key)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["u", key]).head(psi)
        t = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, t])
        nodes = _grow(pdf[feats].to_numpy(dtype=float), rng, max_depth)
        arr = np.array(nodes, dtype=object)
        return pd.DataFrame({"tree": t, "node": np.arange(len(nodes)), "feature": arr[:, 0].astype(int),
                             "threshold": arr[:, 1].astype(float), "left": arr[:, 2].astype(int),
                             "right": arr[:, 3].astype(int), "size": arr[:, 4].astype(int),
                             "depth": arr[:, 5].astype(int)})

    forest = cand.groupBy("tree").applyInPandas(grow, _NODE_SCHEMA).toPandas()
    return flag_lowest(forest_scores(points, feats, forest, psi, key), "anomaly_score_if", "is_anomaly_if", contamination)


def forest_scores(points: DataFrame, features: Sequence[str], forest: pd.DataFrame, psi: int, key: str = KEY) -> DataFrame:
    """``(key, anomaly_score_if)`` of every row by a grown forest (node rows as in ``_NODE_SCHEMA``) of samples of ``psi`` rows.

    The forest, at most trees x (2^(depth + 1) - 1) nodes, is broadcast."""
    feats, deepest = list(features), int(forest["depth"].max()) if len(forest) else 0
    trees = [forest[forest["tree"] == t].sort_values("node") for t in sorted(forest["tree"].unique())]
    packed = [(g["feature"].to_numpy(), g["threshold"].to_numpy(), g["left"].to_numpy(),
               g["right"].to_numpy(), g["depth"].to_numpy() + _c(g["size"].to_numpy())) for g in trees]
    bc = points.sparkSession.sparkContext.broadcast(packed)
    norm = float(_c(np.array([psi]))[0]) or 1.0

    def score(it):
        forest_ = bc.value
        for pdf in it:
            x = pdf[feats].to_numpy(dtype=float)
            total = np.zeros(len(pdf))
            for feat, thr, left, right, leaf_h in forest_:
                node = np.zeros(len(pdf), dtype=int)
                for _ in range(deepest + 1):
                    f = feat[node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    go_left = x[np.arange(len(pdf)), np.where(inner, f, 0)] <= thr[node]
                    node = np.where(inner, np.where(go_left, left[node], right[node]), node)
                total += leaf_h[node]
            mean_h = total / max(len(forest_), 1)
            yield pd.DataFrame({key: pdf[key].to_numpy(), "anomaly_score_if": -np.power(2.0, -mean_h / norm)})

    return points.select(key, *feats).mapInPandas(score, f"{key} long, anomaly_score_if double")


def anomaly_agreement(flags: DataFrame) -> DataFrame:
    """Counts and percentages for each method and for both."""
    both = F.col("is_anomaly_if") & F.col("is_anomaly_lof")
    t = flags.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if("is_anomaly_if").alias("n_if"),
                  F.count_if("is_anomaly_lof").alias("n_lof"),
                  F.count_if(both).alias("n_ambos"))
    return t.select("n", "n_if", pct_of("n_if", "n").alias("pct_if"),
                    "n_lof", pct_of("n_lof", "n").alias("pct_lof"),
                    "n_ambos", pct_of("n_ambos", "n").alias("pct_ambos"))
