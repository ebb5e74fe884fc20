"""Ward in rounds (K11, K12) against merging one pair at a time."""

import numpy as np
import pytest

from paramo.operators import clustering as K
from tests.test_properties import _ward_bruteforce


def _frame(spark, x):
    return spark.createDataFrame([(int(i) * 3, *map(float, r)) for i, r in enumerate(x)], "id_fila long, " + ", ".join(f"f{j} double" for j in range(x.shape[1])))


def _tree(z, n):
    """Rows of every node, by following left and right."""
    rows = {i: {i} for i in range(n)}
    for step, left, right, _, size in z:
        assert left < right < n + step - 1  # children come before
        rows[n + step - 1] = rows[left] | rows[right]
        assert len(rows[n + step - 1]) == size
    return rows


@pytest.mark.parametrize(("n", "tail", "block"), [(90, 2000, 2000), (120, 40, 30)])
def test_rounds_give_the_exact_tree(spark, n, tail, block):
    rng = np.random.default_rng(n + tail)
    x = rng.normal(size=(n, 3)) + rng.integers(0, 4, (n, 1)) * 5
    x[10:20] = x[0]  # copies
    labels, merges = K.ward(_frame(spark, x), ["f0", "f1", "f2"], 4, tail=tail, block_size=block)
    z = [tuple(r) for r in merges.orderBy("step").collect()]
    assert [r[0] for r in z] == list(range(1, n))
    np.testing.assert_allclose([r[3] for r in z], np.maximum.accumulate(_ward_bruteforce(x)), rtol=1e-9, atol=1e-9)
    assert np.isclose(sum(r[3] ** 2 for r in z) / 2, ((x - x.mean(0)) ** 2).sum())
    rows = _tree(z, n)
    assert len(rows[2 * n - 2]) == n
    # the labels undo the last three merges, and count clusters by their lowest leaf
    parts = [rows[c] for r in z[-3:] for c in r[1:3] if c < 2 * n - 1 - 3]
    want = {}
    for i, part in enumerate(sorted(parts, key=min)):
        want |= {3 * leaf: i for leaf in part}
    assert {r["id_fila"]: r["cluster_jerarquico"] for r in labels.collect()} == want


def test_ties_and_one_row(spark):
    grid = np.array([[i, j] for i in range(7) for j in range(7)], float)
    _, merges = K.ward(_frame(spark, grid), ["f0", "f1"], 2, tail=20, block_size=15)
    z = [tuple(r) for r in merges.orderBy("step").collect()]
    assert len(z) == 48 and np.isclose(sum(r[3] ** 2 for r in z) / 2, ((grid - grid.mean(0)) ** 2).sum())
    _tree(z, 49)
    labels, merges = K.ward(_frame(spark, grid[:1]), ["f0", "f1"], 2)
    assert merges.count() == 0 and [r[1] for r in labels.collect()] == [0]


@pytest.mark.parametrize("in_a_task", [60, 0])
def test_rounds_in_a_task_are_those_of_the_cluster(spark, monkeypatch, in_a_task):
    """Merge by merge, ties and copies included, wherever the rounds of one task begin."""
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal(size=(110, 3)) + rng.integers(0, 3, (110, 1)) * 4, rng.integers(0, 4, (90, 3))])
    x[20:30] = x[0]
    leaves = K.ward_leaves(_frame(spark, x), ["f0", "f1", "f2"])
    in_one = [tuple(r) for r in K.ward_merges(leaves, 20, 40).orderBy("round", "lo").collect()]
    calls, nearest = [], K._nearest_clusters
    monkeypatch.setattr(K, "_nearest_clusters", lambda *args: (calls.append(1), nearest(*args))[1])
    assert len(in_one) == len(x) - 1 and not calls
    monkeypatch.setattr(K, "ROUNDS_IN_A_TASK", in_a_task)
    over_all = [tuple(r) for r in K.ward_merges(leaves, 20, 40).orderBy("round", "lo").collect()]
    assert calls and [r[:2] + r[3:] for r in in_one] == [r[:2] + r[3:] for r in over_all]
    np.testing.assert_allclose([r[2] for r in in_one], [r[2] for r in over_all], rtol=1e-12)
