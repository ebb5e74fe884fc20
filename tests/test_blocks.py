"""Compact blocks: pairs that are skipped, exact ties, hubs, rounds of quantiles, samples of trees."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paramo.operators import anomaly as N
from paramo.operators import blocks as B
from paramo.operators import pairwise as P
from paramo.operators import ranking as R
from paramo.operators.skew import hub_join
from paramo.operators.wide import correlations
from tests.test_properties import _dbscan_reference, _frame


def _clusters(n_clusters=12, each=60, dims=3, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.permutation(n_clusters * 4)[:n_clusters, None] * 100.0 + rng.normal(size=(n_clusters, dims))
    return np.concatenate([c + rng.normal(0, 0.5, (each, dims)) for c in centres])


def _knn(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(len(x)), d.shape), d), axis=1)[:, :k]
    return order, np.take_along_axis(d, order, axis=1)


def _rows(df):
    return {(r["id_fila"], r["rn"]): r["nbr"] for r in df.collect()}


def test_distant_blocks_are_not_visited(spark):
    x = _clusters()
    blocks, near, asked = P.knn_parts(_frame(spark, x).select("id_fila", "x"), "id_fila", "x", 5, block_size=30)
    pairs = asked.select("frm", "to").distinct().count()
    assert blocks.count >= len(x) / 30 and pairs < 0.25 * blocks.count * (blocks.count - 1)
    got, (want, _) = _rows(P.knn_table(_frame(spark, x), "id_fila", "x", 5, block_size=30)), _knn(x, 5)
    assert got == {(i, j + 1): want[i, j] for i in range(len(x)) for j in range(5)}


@pytest.mark.parametrize("dims,side", [(4, 4), (6, 3)])
def test_ties_go_by_key_on_a_grid(spark, dims, side):
    """On a grid very many neighbours are equally far."""
    x = np.stack(np.meshgrid(*[np.arange(side, dtype=float)] * dims), -1).reshape(-1, dims)
    want, dist = _knn(x, 20)
    frame = _frame(spark, x)
    got = _rows(P.knn_table(frame, "id_fila", "x", 20, block_size=100))
    assert got == {(i, j + 1): want[i, j] for i in range(len(x)) for j in range(20)}
    kd = dist[:, -1]
    lrd = 1 / (np.maximum(dist, kd[want]).mean(1) + 1e-10)
    scores = {r["id_fila"]: r["anomaly_score_lof"] for r in P.lof_scores(frame, 20, block_size=100).collect()}
    np.testing.assert_allclose([scores[i] for i in range(len(x))], -(lrd[want].mean(1) / lrd), rtol=1e-9)


def test_a_place_with_many_equal_points_is_several_blocks(spark):
    x = np.concatenate([np.zeros((300, 2)), np.random.default_rng(2).normal(size=(100, 2)) * 9])
    blocks = B.compact_blocks(_frame(spark, x), "id_fila", "x", 50)
    sizes = [len(r["keys"]) // 8 for r in blocks.df.collect()]
    assert sum(sizes) == 400 and max(sizes) < 100
    got = P.dbscan(_frame(spark, x), 1.0, 5, block_size=50).toPandas().sort_values("id_fila")["cluster_dbscan"].to_numpy()
    want = _dbscan_reference(x, 1.0, 5)
    assert ((got == -1) == (want == -1)).all() and len(set(zip(got, want))) == len(set(want))


def test_core_rows_are_settled_without_visits(spark):
    """Dense clusters: no row has to look beyond its block to know that it is core, and few blocks touch."""
    x = _clusters(each=100)
    got = P.dbscan(_frame(spark, x), 1.5, 4, block_size=60).toPandas().sort_values("id_fila")["cluster_dbscan"].to_numpy()
    want = _dbscan_reference(x, 1.5, 4)
    assert ((got == -1) == (want == -1)).all() and len(set(zip(got, want))) == len(set(want))


def test_components_of_a_long_chain_and_a_hub(spark):
    n = 300
    chain = [(i, i + 1) for i in range(n)]
    hub = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame(chain + hub, "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in {v for e in chain + hub for v in e} | {5000}], "node long")
    got = {r["node"]: r["comp"] for r in P._connected_components(edges, nodes).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(200)}, 5000: 5000}


def test_hubs_are_joined_in_parts(spark):
    many = spark.range(5000).select((F.col("id") % 1000 * (F.col("id") % 2)).alias("k"), F.col("id").alias("row"))
    one = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = sorted(map(tuple, many.join(one, "k").select("k", "row", "v").collect()))
    split = hub_join(many, one, "k", "row", 5000, hub=100)
    assert sorted(map(tuple, split.select("k", "row", "v").collect())) == plain and len(plain) == 5000
    assert hub_join(many, one.where("k > 0"), "k", "row", 5000, "left", hub=100).where("v IS NULL").count() == 2500


@pytest.mark.parametrize("kind", ["normal", "heavy", "two", "infinite"])
def test_quantiles_in_rounds(spark, kind, monkeypatch):
    """40,000 rows in two groups; brackets are narrowed until 50 rows are inside."""
    monkeypatch.setattr(R, "BOUND", 50)
    rng = np.random.default_rng(3)
    n = 40_000
    v = {"normal": rng.normal(size=n), "heavy": np.where(rng.random(n) < 0.6, 7.0, rng.normal(size=n) * 9), "two": rng.integers(0, 2, n).astype(float),
         "infinite": np.where(rng.random(n) < 0.1, np.inf, rng.exponential(size=n))}[kind]
    g = (rng.random(n) < 0.3).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v}))
    probs = [0.0, 0.05, 0.25, 0.5, 0.85, 1.0]
    got = {(r["g"], r["q"]): r["value"] for r in R.exact_quantiles(df, ["g"], "v", probs).collect()}
    for k in (0, 1):
        with np.errstate(invalid="ignore"):
            want = np.nan_to_num(np.quantile(v[g == k], probs), nan=np.inf)  # between equal infinite values
        np.testing.assert_allclose([got[k, q] for q in probs], want, rtol=1e-12)


def test_windows_of_quantiles_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(R, "BOUND", 50)
    df = spark.range(30_000).select(F.lit(0).alias("g"), (F.col("id") * 7919 % 30_000).cast("double").alias("v"))
    state = df.select(F.col("g").alias("_g0"), F.col("v").alias("_v"))
    start = state.groupBy("_g0").agg(F.count(F.lit(1)).alias("_n")).select("_g0", "_n", F.expr(f"named_struct('rank', 15000L, 'base', 0L, 'lo', cast(null as double), 'hi', cast(null as double), 'inside', 30000L, 'value', cast(null as double))").cast(R._TARGET).alias("t0"))
    once = R.narrowed(state, start, ["_g0"], 1, True).first()["t0"]
    assert once["value"] is not None or once["inside"] <= 4 * 30_000 / R.CELLS
    assert R.exact_quantiles(df, ["g"], "v", [0.5]).first()["value"] == 14_999.5


def test_every_tree_draws_from_all_rows(spark):
    """100,000 rows: exactly 256 for every tree, spread evenly, and different for each tree."""
    n = 100_000
    rows = spark.range(n).select(F.col("id").alias("id_fila"), F.col("id").cast("double").alias("f"))
    drawn = N.tree_samples(rows, ["f"], n, 40, 256, 42).toPandas()
    samples = [set(g.sort_values(["u", "id_fila"]).head(256)["id_fila"]) for _, g in drawn.groupby("tree")]
    assert len(samples) == 40 and all(len(s) == 256 for s in samples)
    tenths = np.bincount([i * 10 // n for s in samples for i in s], minlength=10)
    assert abs(tenths - 1024).max() < 6 * np.sqrt(1024 * 0.9)
    assert len(set.union(*samples)) > 0.93 * 40 * 256  # one small pool would repeat rows much more


def test_correlations_with_missing_values(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 4)) @ rng.normal(size=(4, 4)) + 1e6
    x[rng.random((500, 4)) < 0.2] = np.nan
    x[:, 3] = 0.1
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd"))).repartition(5)
    got = {(r["i"], r["j"]): r["r"] for r in correlations(df, list("abcd")).collect()}
    want = pd.DataFrame(x).corr()
    for (i, j), r in got.items():
        assert r is None if j == 3 else r == pytest.approx(want.iloc[i, j], abs=1e-9)
    plan = correlations(df, list("abcd"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan
