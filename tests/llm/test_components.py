import random

from paramo.llm.components import components


def test_against_union_find(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(1900, 2100)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
