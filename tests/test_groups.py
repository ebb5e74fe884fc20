"""Groups of rows and blocks: what is shuffled does not grow with the number of blocks, and nothing is lost."""

import threading

import numpy as np
import pandas as pd

from paramo.operators import blocks as B
from paramo.operators import clustering as K
from paramo.operators import pairwise as P
from tests.test_properties import _frame


def test_records_are_shuffled_a_fixed_number_of_times(spark):
    x = np.random.default_rng(5).normal(size=(1500, 3))
    for block_size in (100, 20):
        blocks = B.compact_blocks(_frame(spark, x), "id_fila", "x", block_size)
        seen = B.met(blocks.df, blocks, blocks.df, lambda r: (np.arange(len(r["keys"]) // 8), np.full(len(r["keys"]) // 8, 99.0), np.zeros(len(r["keys"]) // 8)),
                     lambda visit, record: [[visit["frm"]], [record["blk"]]], "frm long, to long")
        assert seen.rdd.getNumPartitions() == int(np.ceil(np.sqrt(4 * spark.sparkContext.defaultParallelism))) ** 2  # whatever the number of blocks
        pairs = [tuple(r) for r in seen.collect()]
        assert len(pairs) == len(set(pairs)) == blocks.count * (blocks.count - 1)


def test_close_pairs_miss_none():
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=(300, 5)) + 1e4, rng.normal(size=(700, 5)) + 1e4
    d2 = ((a[:, None] - b[None]) ** 2).sum(-1)
    limit = np.sort(d2, axis=1)[:, 9]
    got = set(zip(*(v.tolist() for v in B.close_pairs(a, b, limit))))
    want = set(zip(*(v.tolist() for v in np.nonzero(d2 <= limit[:, None]))))
    assert want <= got and len(got) < 1.1 * len(want)


def test_silhouette_of_many_clusters(spark, monkeypatch):
    """Clusters that lie in several groups, one with half of the rows, copies and single rows."""
    monkeypatch.setattr(P, "_TILE", 50)
    rng = np.random.default_rng(7)
    n = 600
    lab = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 90, n))
    x = rng.normal(size=(n, 4)) + lab[:, None] % 5
    x[10:20] = x[0]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    sums = np.stack([d[:, lab == c].sum(1) for c in np.unique(lab)], axis=1)
    size, own = np.bincount(np.unique(lab, return_inverse=True)[1]), np.unique(lab, return_inverse=True)[1]
    mean = sums / size
    mean[np.arange(n), own] = np.inf
    inner, outer = sums[np.arange(n), own] / np.maximum(size[own] - 1, 1), mean.min(1)
    want = np.where(size[own] > 1, (outer - inner) / np.maximum(inner, outer), 0.0)
    frame = spark.createDataFrame(pd.DataFrame({"id_fila": np.arange(n), "x": x.tolist(), "lab": lab}))
    summed = {r["id_fila"]: r["s"] for r in P.silhouette_samples(frame, "lab").collect()}
    np.testing.assert_allclose([summed[i] for i in range(n)], want, rtol=1e-9, atol=1e-12)


def test_a_distance_counts_for_both_its_rows(monkeypatch):
    """Two groups that share a cluster: every pair is made once, and both sides get their sums."""
    monkeypatch.setattr(P, "_TILE", 50)
    made, segment_sums = [], P._segment_sums
    monkeypatch.setattr(P, "_segment_sums", lambda d, cuts, axis: (made.append(d.size if axis else 0), segment_sums(d, cuts, axis))[1])
    rng = np.random.default_rng(9)
    lab = np.sort(np.concatenate([np.full(300, 3), np.full(30, 4), rng.integers(0, 40, 700)]))
    x = rng.normal(size=(len(lab), 4)) + lab[:, None] % 5
    x[5:15] = x[600]
    size = np.bincount(lab, minlength=40)
    a, b = np.arange(450), np.arange(450, len(lab))
    assert lab[449] == lab[450]
    got = {}
    for (of_a, rows), c, s in P._label_sums(x[a], lab[a], size[lab[a]], x[b], lab[b], size[lab[b]], False):
        got.update({(int((a if of_a else b)[r]), int(k)): v for r, k, v in zip(rows, c, s)})
    assert sum(made) == len(a) * len(b)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for side, other in ((a, b), (b, a)):
        sums = np.stack([d[side][:, other][:, lab[other] == c].sum(1) for c in range(40)], axis=1)
        held = np.bincount(lab[other], minlength=40)
        whole = (held == size) & (held > 0)
        assert whole.sum() > 5
        near = np.where(whole, sums / np.maximum(size, 1), np.inf).argmin(1)
        for i, row in enumerate(side):
            told = {c: got.pop((row, c)) for c in range(40) if (row, c) in got}
            assert set(told) == {near[i], *np.flatnonzero((held > 0) & ~whole)}
            np.testing.assert_allclose(list(told.values()), sums[i, list(told)], rtol=1e-9)
    assert not got


def test_nearest_cluster_up_to_a_known_height():
    rng = np.random.default_rng(8)
    c, n = rng.normal(size=(400, 3)), rng.integers(1, 30, 400).astype(float)
    ids = np.arange(400)
    h = K._heights(c[:, None], n[:, None], c[None], n[None])
    np.fill_diagonal(h, np.inf)
    to, height = K._best_partner(ids, c, n, ids, c, n)
    assert (to == h.argmin(1)).all() and (height == h.min(1)).all()
    low = np.median(height)
    to, height = K._best_partner(ids, c, n, ids, c, n, np.full(400, low))
    assert ((to >= 0) == (h.min(1) <= low)).all() and (to[to >= 0] == h.argmin(1)[to >= 0]).all()
    to, _ = K._best_partner(ids, c, n, ids, c, n, np.where(ids % 2 == 0, np.inf, low))  # alone in its block: nothing known yet
    assert (to[::2] == h.argmin(1)[::2]).all()


def test_fits_run_at_a_time(spark, monkeypatch):
    """A fit waits for another one to have begun."""
    both, fit = threading.Barrier(2, timeout=60), K.KMeans.fit
    monkeypatch.setattr(K.KMeans, "fit", lambda self, df: (both.wait(), fit(self, df))[1])
    df = spark.createDataFrame(pd.DataFrame({"id_fila": range(60), "a": [float(i % 7) for i in range(60)], "b": [float(i % 5) for i in range(60)]}))
    from paramo.operators.features import standardize_sample
    sweep, models = K.kmeans_sweep(standardize_sample(df, ["a", "b"]), 2, 3)
    assert [r["k"] for r in sweep.orderBy("k").collect()] == [2, 3] and sorted(models) == [2, 3]
