"""Property tests for the learned / iterative operators (no SQL oracle)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paramo.operators import anomaly as N
from paramo.operators import clustering as K
from paramo.operators import features as FE
from paramo.operators import pairwise as P
from paramo.operators import supervised as S
from paramo.operators.ranking import exact_quantiles, global_rank


def _frame(spark, x: np.ndarray, extra=None):
    pdf = pd.DataFrame({"id_fila": np.arange(len(x), dtype="int64")})
    pdf["x"] = list(x.astype(float))
    for j in range(x.shape[1]):
        pdf[f"f{j}"] = x[:, j].astype(float)
    if extra is not None:
        for k, v in extra.items():
            pdf[k] = v
    return spark.createDataFrame(pdf)


def _moons(n=60, seed=0):
    rng = np.random.default_rng(seed)
    t = rng.uniform(0, np.pi, n // 2)
    a = np.c_[np.cos(t), np.sin(t)]
    b = np.c_[1 - np.cos(t), 0.5 - np.sin(t)]
    x = np.r_[a, b] + rng.normal(0, 0.05, (n, 2))
    return np.r_[x, [[3.0, 3.0], [-2.0, 2.5]]]


def _dbscan_reference(x, eps, ms):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    nb = d <= eps
    core = nb.sum(1) >= ms
    lab = -np.ones(len(x), int)
    c = 0
    for i in range(len(x)):
        if lab[i] != -1 or not core[i]:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if lab[j] != -1:
                continue
            lab[j] = c
            if core[j]:
                stack.extend(np.flatnonzero(nb[j] & (lab == -1)))
        c += 1
    return lab


@pytest.mark.parametrize("block", [2000, 16])
def test_dbscan_matches_reference(spark, block):
    x = _moons()
    df = _frame(spark, x)
    got = P.dbscan(df, 0.2, 4, block_size=block).toPandas().sort_values("id_fila")["cluster_dbscan"].to_numpy()
    want = _dbscan_reference(x, 0.2, 4)
    # same partition of core rows; border rows go to the lowest-numbered reaching cluster
    assert (got == -1).sum() == (want == -1).sum()
    pairs = set(zip(got, want))
    assert len(pairs) == len(set(want))


def test_lof_matches_bruteforce(spark):
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(0, 1, (80, 3)), [[6, 6, 6]]]
    got = P.lof(_frame(spark, x), k=10, block_size=32).toPandas().sort_values("id_fila")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    idx = np.argsort(d, 1, kind="stable")[:, :10]
    dk = np.take_along_axis(d, idx, 1)
    kd = dk[:, -1]
    lrd = 1 / (np.maximum(dk, kd[idx]).mean(1) + 1e-10)
    lof = lrd[idx].mean(1) / lrd
    np.testing.assert_allclose(got["anomaly_score_lof"].to_numpy(), -lof, rtol=1e-9)
    assert bool(got["is_anomaly_lof"].iloc[-1])


def test_knn_distance_bruteforce(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (50, 4))
    got = P.knn_distance(_frame(spark, x), block_size=8).toPandas().sort_values("id_fila")["k_dist"].to_numpy()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = np.sort(d, 1)[:, 4]
    np.testing.assert_allclose(got, want, rtol=1e-12)


def _ward_bruteforce(x):
    clusters = {i: [i] for i in range(len(x))}
    heights = []
    while len(clusters) > 1:
        best = None
        keys = list(clusters)
        for a in range(len(keys)):
            for b in range(a + 1, len(keys)):
                ca, cb = clusters[keys[a]], clusters[keys[b]]
                na, nb = len(ca), len(cb)
                h = np.sqrt(2 * na * nb / (na + nb)) * np.linalg.norm(x[ca].mean(0) - x[cb].mean(0))
                if best is None or h < best[0]:
                    best = (h, keys[a], keys[b])
        h, a, b = best
        clusters[a] = clusters[a] + clusters.pop(b)
        heights.append(h)
    return np.array(heights)


def test_ward_exact_on_small_data(spark):
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(0, 0.3, (20, 2)), rng.normal(3, 0.3, (20, 2)), rng.normal((0, 3), 0.3, (20, 2))]
    df = _frame(spark, x)
    labels, merges = K.ward(df, ["f0", "f1"], 3)
    z = merges.orderBy("step").toPandas()
    np.testing.assert_allclose(z["height"].to_numpy(), np.sort(_ward_bruteforce(x)), rtol=1e-9)
    lab = labels.toPandas().sort_values("id_fila")["cluster_jerarquico"].to_numpy()
    truth = np.repeat([0, 1, 2], 20)
    assert len(set(zip(lab, truth))) == 3


def test_global_rank_and_quantiles(spark):
    rng = np.random.default_rng(4)
    g = rng.integers(0, 3, 500)
    g[:200] = 0  # a hot group
    v = rng.normal(0, 1, 500).round(2)
    df = spark.createDataFrame(pd.DataFrame({"g": g.astype("int64"), "v": v}))
    r = global_rank(df, ["g"], ["v"], num_partitions=7).toPandas()
    for _, grp in r.groupby("g"):
        assert sorted(grp["rank"]) == list(range(len(grp)))
        assert (grp.sort_values("rank")["v"].diff().dropna() >= 0).all()
    q = exact_quantiles(df, ["g"], "v", [0.1, 0.5, 0.9]).toPandas()
    for (gg, qq), val in q.set_index(["g", "q"])["value"].items():
        assert val == pytest.approx(np.percentile(v[g == gg], qq * 100), abs=1e-12)


def test_rank_splits_a_hot_value(spark):
    df = spark.range(4000).selectExpr("CAST(0 AS INT) AS g", "CAST(id % 3 = 0 AS DOUBLE) AS v")
    r = global_rank(df, ["g"], ["v"], num_partitions=8).toPandas()
    assert sorted(r["rank"]) == list(range(4000))
    assert (r.sort_values("rank")["v"].diff().dropna() >= 0).all()


def test_kmeans_nearest_centre(spark):
    rng = np.random.default_rng(5)
    x = np.r_[rng.normal(0, 0.2, (40, 2)), rng.normal(4, 0.2, (40, 2))]
    df = FE.standardize_sample(_frame(spark, x), ["f0", "f1"])
    sweep, models = K.kmeans_sweep(df, 2, 3)
    assert K.best_k(sweep).first()["k"] == 2
    lab = K.kmeans_assign(models[2], df).toPandas()
    assert lab["cluster_kmeans"].nunique() == 2


def test_isolation_forest_flags_planted(spark):
    rng = np.random.default_rng(6)
    x = np.r_[rng.normal(0, 1, (380, 3)), rng.normal(0, 1, (20, 3)) + 8]
    out = N.isolation_forest(_frame(spark, x), ["f0", "f1", "f2"], n_trees=50).toPandas().sort_values("id_fila")
    flagged = out["is_anomaly_if"].to_numpy()
    assert 15 <= flagged.sum() <= 25
    assert flagged[-20:].sum() >= 15


def test_pca_ratios(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (100, 4)) @ rng.normal(0, 1, (4, 4))
    df = FE.standardize_population(_frame(spark, x), [f"f{j}" for j in range(4)])
    v = FE.pca_variance(df, [f"f{j}" for j in range(4)]).toPandas()
    assert (v["varianza_explicada"].diff().dropna() <= 1e-9).all()
    assert v["varianza_acumulada"].iloc[-1] <= 1.0001


def test_forest_separable(spark):
    rng = np.random.default_rng(8)
    x = np.r_[rng.normal(0, 0.3, (60, 2)), rng.normal(3, 0.3, (60, 2))]
    y = np.repeat([0, 1], 60)
    df = _frame(spark, x, {"y": y})
    model, pred = S.train_rf(df, ["f0", "f1"], "y", n_trees=20, anomaly=None)
    assert S.accuracy(pred).first()[0] > 0.95
    assert S.macro_f1(pred).first()[0] > 0.95
    folds = S.stratified_folds(df, "y", 5).groupBy("y", "fold").count().toPandas()
    assert set(folds["count"]) == {12}


def test_silhouettes_single_cluster(spark):
    x = np.random.default_rng(9).normal(0, 1, (30, 2))
    df = _frame(spark, x, {"lab": np.zeros(30, int)})
    assert P.silhouette_euclid(df, "lab").first()["silhouette"] == 0.0


def test_pca_variance_uses_scaled_columns(spark):
    """Ratios must not depend on feature units: rescaling a raw column changes
    nothing once the columns are standardised."""
    rng = np.random.default_rng(10)
    x = rng.normal(0, 1, (200, 3)) @ rng.normal(0, 1, (3, 3))
    y = x.copy()
    y[:, 0] *= 1000.0
    feats = ["f0", "f1", "f2"]
    a = FE.pca_variance(FE.standardize_population(_frame(spark, x), feats), feats).toPandas()
    b = FE.pca_variance(FE.standardize_population(_frame(spark, y), feats), feats).toPandas()
    np.testing.assert_allclose(a["varianza_explicada"], b["varianza_explicada"], atol=1e-4)
