"""Operator 13: mined negatives against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paramo.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, positives=5, negatives=5, low=80, high=100, anchor=lambda i: i % 100 == 0):
    part = [(i, lab, [math.floor(256 * x) for x in v], n) for n, (i, v, lab) in enumerate(rows)
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a in (r for r in part if anchor(r[0])):
        score = lambda r: sum(x * y for x, y in zip(a[2], r[2]))  # noqa: B023, E731
        order = sorted((r for r in part if r[3] != a[3]), key=lambda r: (-score(r), r[0], r[3]))
        for p in [r for r in order if r[1] == a[1]][:positives]:
            found = [r for r in order if r[1] != a[1] and low * score(p) <= 100 * score(r) <= high * score(p)][:negatives]
            out += [(a[0], p[0], k + 1, r[0], score(p), score(r)) for k, r in enumerate(found)]
    return sorted(out)


def mined(df, **more):
    return sorted(map(tuple, N.hard_negatives(df, lambda key: key % 100 == 0, **more).collect()))


def vectors(n, dims=64, seed=1, step=1 / 64, spread=40):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.randrange(-spread, spread) * step)) for _ in range(dims)], rng.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("n,dims,blocks", [(700, 64, (256, 4096)), (900, 64, (3, 100)), (400, 5, (2, 7)), (300, 13, (1, 1000))])
def test_against_brute_force(spark, n, dims, blocks):
    rows = vectors(n, dims)
    got = mined(spark.createDataFrame(rows, SCHEMA).repartition(3), anchor_block=blocks[0], candidate_block=blocks[1])
    assert got == plain(rows) and got


def test_ties_and_repeated_rows(spark):
    rows = vectors(500, 4, spread=3, step=0.25)
    rows += [rows[0], rows[0], rows[100], rows[7], rows[300]] + [(1000 + i, rows[3][1], i % 4) for i in range(200)]
    assert mined(spark.createDataFrame(rows, SCHEMA), candidate_block=64) == plain(rows)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(260, 3) + [(None, [1.0, 1.0, 1.0], 1), (300, None, 1), (400, [1.0, None, 1.0], 1), (500, [nan, 1.0, 1.0], 2), (600, [1.0, inf, 0.0], 2), (700, [1.0, -inf, 0.0], 2), (800, [9.0, 9.0, 9.0], None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for extra in ("id", "row", "q", "c0", "planes", "p"):
        df = df.withColumn(extra, df["label"])
    assert mined(df) == plain(rows)


def test_short_empty_and_long_vectors(spark):
    rows = vectors(150, 9) + [(200, [], 1), (201, [], 1), (300, [0.5], 2), (301, [0.25, 1.5], 2), (302, [1.0] * 2000, 3), (400, [0.5] * 2000, 3)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain([(i, v + [0.0] * (2000 - len(v)), lab) for i, v, lab in rows])


def test_empty_table_and_no_anchor(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(1, [0.5], 1), (2, [0.5], 2)], SCHEMA)) == []


def test_large_components_use_more_planes_and_too_large_ones_raise(spark):
    rows = [(i, [x * 1000.0 for x in v], lab) for i, v, lab in vectors(220, 6)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain(rows)
    with pytest.raises(ValueError):
        mined(spark.createDataFrame([(0, [3e37], 1), (1, [1.0], 1)], SCHEMA))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 20).flatmap(lambda d: st.tuples(*[st.lists(st.lists(st.integers(-(2**20), 2**20 - 1), min_size=d, max_size=d), min_size=1, max_size=6)] * 2)))
def test_lookups_give_inner_products(pair):
    a, c = (np.array(x, np.int64) for x in pair)
    got = N.scores(N.packed(c, 21), N.subset_sums(a, np.int64))
    assert (got == c @ a.T).all()


def test_first_rows_by_score_id_and_row():
    points = np.array([[5, 5, 9, 5, 1]], np.int32)
    c, a = N.best(points, np.array([[True, True, True, True, False]]), np.array([4, 2, 9, 2, 0]), np.array([0, 7, 2, 3, 4]), 3)
    assert c.tolist() == [2, 3, 1] and a.tolist() == [0, 0, 0]
