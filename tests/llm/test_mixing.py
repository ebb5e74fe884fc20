import re
from collections import Counter
from fractions import Fraction

import pytest

from paramo.llm import mixing as M
from tests.llm.helpers import documents, empty, messy


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = Fraction(sum(sizes.values())), set(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * unit > most * sizes[s]}
        if not full:
            out |= {s: weight[s] * unit for s in free}
            break
        out |= {s: Fraction(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        free -= full
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 70}, {"a": 0, "b": 0}, {"é": 3, "z": 9, "Z": 1, "": 50, "b": 900, "c": 2, "d": 1}, {"a": 7}, {None: 4, "a": 1000, "b": 1000}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in M.targets(frame).collect()}
    want = plain_targets(sizes)
    assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def test_taken_is_near_the_targets(spark):
    plan = M.mix_plan(documents(spark, "/root/testdata/sf0.1")).collect()
    taken, goal, spread = Counter(), {}, Counter()
    for r in plan:
        taken[r["source_size"]] += r["taken"]
        goal[r["source_size"]] = r["target"]
        share = r["target"] / r["source_size"] % 1
        spread[r["source_size"]] += share * (1 - share) * r["size"] ** 2  # the variance that independent draws have
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert abs(sum(taken.values()) / sum(goal.values()) - 1) < 0.02
    assert all(abs(taken[s] - goal[s]) <= 4 * spread[s] ** 0.5 for s in goal)


def test_mix_emits_what_the_plan_says_and_reruns_agree(spark):
    docs = messy(spark).unionByName(documents(spark), allowMissingColumns=True)
    plan = M.mix_plan(docs)
    want = sum(r["copies"] for r in plan.collect())
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    rows = Counter((r["doc_id"], r["text"]) for r in mixed.select("doc_id", "text").collect())
    assert sum(rows.values()) == want
    again = Counter((r["doc_id"], r["text"]) for r in M.mix(docs.repartition(3)).select("doc_id", "text").collect())
    assert rows == again
    assert all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for r, t in zip(*[sorted(x, key=str) for x in ([r for r in plan.where("doc_id = 7").collect()], [r["text"] for r in docs.where("doc_id = 7").collect()])]) if r["doc_id"] == 7 and t and t.startswith("long"))


def test_empty(spark):
    assert M.mix_plan(empty(spark)).collect() == [] and M.mix(empty(spark)).collect() == []
