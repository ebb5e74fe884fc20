"""The distributed random forest against plain loops, with subtrees made small so that upper levels are grown by counts."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paramo.operators import forest
from paramo.operators import supervised as S


def _rows(n=1500, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 4))
    x[:, 2] = np.round(x[:, 2])
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] + rng.normal(0, 0.5, n) > 0.5)
    return pd.DataFrame({"id_fila": np.arange(n), **{f"f{j}": x[:, j] for j in range(4)}, "y": y})


FEATS = ["f0", "f1", "f2", "f3"]


def _fitted(spark, monkeypatch, deep, n_trees=5, depth=30):
    monkeypatch.setattr(forest, "DEEP", deep)
    df = spark.createDataFrame(_rows())
    rows = forest.prepare(df.select(F.col("id_fila").alias("_key"), F.col("y").cast("double").alias("_y"), F.lit(-1).alias("_out"), F.lit(0).alias("_by"), *FEATS), 42)
    return rows, *forest.fit(rows, FEATS, n_trees, 42, depth)


def _whole(model):
    """Per tree its nodes: (tree, node, place below or None) -> (feature, cut, child keys, counts)."""
    below = {(r["tree"], r["node"]): r for r in model.subtrees.where("alone IS NULL").collect()}

    def way(t, x):
        tree = model.upper[t]
        i, depth = 0, 0
        while tree.feature[i] >= 0:
            i, depth = tree.child[i] + int(x[tree.feature[i]] > tree.cut[i]), depth + 1
        if tree.feature[i] == forest.LEAF:
            return ("upper", t, int(i)), tree.counts[i], depth
        r = below[t, int(i)]
        feature, cut, child = np.frombuffer(r["feature"], np.int16), np.frombuffer(r["cut"], np.uint8), np.frombuffer(r["child"], np.int32)
        j = 0
        while feature[j] >= 0:
            j, depth = child[j] + int(x[feature[j]] > cut[j]), depth + 1
        return ("below", t, int(i), int(j)), np.frombuffer(r["counts"], np.float32).reshape(-1, model.classes)[j], depth

    return way, below


@pytest.mark.parametrize("deep,depth", [(300, 30), (10_000, 30), (300, 3)])
def test_leaves_hold_the_drawn_rows_and_votes_are_their_shares(spark, monkeypatch, deep, depth):
    rows, model, binned = _fitted(spark, monkeypatch, deep, depth=depth)
    b = binned.toPandas()
    x = np.stack([np.frombuffer(v, np.uint8) for v in b["_x"]])
    h = b["_h"].to_numpy().view(np.uint64)
    way, below = _whole(model)
    votes = np.zeros((len(b), model.classes))
    for t in range(5):
        w, held, told = forest.weights(h, t), {}, {}
        for i in range(len(b)):
            leaf, counts, d = way(t, x[i])
            assert d <= depth
            held.setdefault(leaf, np.zeros(model.classes))[b["_y"][i]] += w[i]
            told[leaf] = counts
            votes[i] += np.rint(counts.astype(float) / counts.sum() * forest.PARTS)
        for leaf, counts in told.items():
            np.testing.assert_array_equal(held[leaf], counts)
        assert all(np.frombuffer(r["counts"], np.float32).reshape(-1, model.classes)[0].sum() <= deep for k, r in below.items() if k[0] == t)
        assert (len(model.upper[t].feature) > 1) == (deep < len(b))
    got = model.predict(binned).toPandas().set_index("_row")["_yhat"]
    assert len(got) == len(b) and (got[b["_row"]].to_numpy() == votes.argmax(axis=1)).all()
    assert model.importances().sum() == pytest.approx(1)


def test_the_driver_holds_upper_levels_only(spark, monkeypatch):
    monkeypatch.setattr(forest, "DEEP", 300)
    df = spark.createDataFrame(_rows())
    model, pred = S.train_rf(df, FEATS, "y", n_trees=10, anomaly=None)
    assert S.accuracy(pred).first()[0] > 0.95 and pred.count() == 1500
    deep = model.subtrees.agg(F.sum(F.length("feature") / 2)).first()[0]
    assert sum(len(t.feature) for t in model.upper) < 10 * 2 * 60 < deep


def test_best_split_is_that_of_a_plain_loop():
    rng = np.random.default_rng(1)
    x, y, w = rng.integers(0, 6, (200, 3)), rng.integers(0, 3, 200), rng.integers(1, 4, 200)
    slots = np.array([[2, 0, 1]])
    slot, cut, gain = forest.best_splits(forest.histogram(x, y, w, np.zeros(200, int), slots, 6, 3))

    def gini(m):
        n = w[m].sum()
        return n * (1 - sum((w[m & (y == c)].sum() / n) ** 2 for c in range(3))) if n else 0.0

    all_ = np.ones(200, bool)
    plain = {(j, c): gini(all_) - gini(x[:, f] <= c) - gini(x[:, f] > c) for j, f in enumerate(slots[0]) for c in range(5)}
    assert gain[0] == pytest.approx(max(plain.values())) == pytest.approx(plain[slot[0], cut[0]])


def test_cuts_are_middles_between_values_that_occur(spark):
    pdf = pd.DataFrame({"a": np.arange(1000) * 2.0, "b": np.arange(1000) % 5 * 10.0, "c": 7.0})
    a, b, c = forest.cut_points(spark.createDataFrame(pdf), ["a", "b", "c"])
    assert len(a) == 31 and (a % 2 == 1).all() and abs(np.diff(np.append(a, 2000)) - 62.5).max() < 5
    assert b.tolist() == [5, 15, 25, 35] and c.tolist() == []


def test_a_fold_does_not_learn_from_its_own_rows(spark):
    """One feature tells the class but for one fold's rows, where it tells the wrong one."""
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"_key": np.arange(600), "_y": np.tile([0.0, 1.0], 300), "_out": np.repeat([0, 1], 300), "f1": rng.normal(0, 1, 600)})
    pdf["_by"], pdf["f0"] = pdf["_out"], np.where(pdf["_out"] == 0, 1 - pdf["_y"], pdf["_y"])
    rows = forest.prepare(spark.createDataFrame(pdf).withColumns({"_out": F.col("_out").cast("int"), "_by": F.col("_by").cast("int")}), 42)
    model, binned = forest.fit(rows, ["f0", "f1"], 15, 42, 5, groups=2)
    wrong = rows.join(model.predict(binned), "_row").where(F.col("_y") != F.col("_yhat")).count()
    assert wrong > 590


def test_anomalies_are_predicted_but_not_learned(spark):
    pdf = _rows(400)
    pdf["is_anomaly_if"] = np.arange(400) % 10 == 0
    pdf.loc[pdf["is_anomaly_if"], "y"] = 3
    _, pred = S.train_rf(spark.createDataFrame(pdf), FEATS, "y", n_trees=10)
    told = pred.toPandas()
    assert len(told) == 400 and (told["y"] == 3).sum() == 40 and (told["yhat"] < 3).all()


def test_odd_rows(spark):
    """Equal and null keys all come back, rows without a feature do not; constant features give one leaf; labels have to be classes."""
    pdf = pd.DataFrame({"id_fila": [None, None, 1, 1, 2], "f0": [1.0, 1.0, 1.0, 1.0, None], "y": [0, 0, 1, 0, 1]}).astype({"id_fila": "Int64"})
    df = spark.createDataFrame([(None if pd.isna(k) else int(k), None if pd.isna(f) else f, int(y)) for k, f, y in pdf.itertuples(index=False)], "id_fila LONG, f0 DOUBLE, y INT")
    model, pred = S.train_rf(df, ["f0"], "y", n_trees=20, anomaly=None)
    assert sorted((r["y"], r["yhat"]) for r in pred.collect()) == [(0, 0)] * 3 + [(1, 0)]
    assert model.importances().tolist() == [0.0]
    for bad in (-1, None):
        with pytest.raises(ValueError):
            S.train_rf(df.withColumn("y", F.lit(bad).cast("int")), ["f0"], "y", n_trees=2, anomaly=None)
    with pytest.raises(ValueError):
        S.train_rf(df.where("id_fila > 5"), ["f0"], "y", n_trees=2, anomaly=None)
