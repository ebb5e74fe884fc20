"""Operator 12: the manifest against a plain recursion."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from paramo.llm import merkle as M
from paramo.llm import queries as Q
from tests.llm.helpers import SCHEMA, empty, messy


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, fields=M.FIELDS):
    return h(*("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in fields))


def tree(hashes, arity):
    """Root, and for each leaf its siblings (left, right) level by level."""
    paths, nodes = [[] for _ in hashes], [(x, [i]) for i, x in enumerate(hashes)]
    while len(nodes) > 1:
        up = []
        for at in range(0, len(nodes), arity):
            run = nodes[at : at + arity]
            for k, (_, under) in enumerate(run):
                for i in under:
                    paths[i].append(("".join(x for x, _ in run[:k]), "".join(x for x, _ in run[k + 1 :])))
            up.append((h(*(x for x, _ in run)), [i for _, under in run for i in under]))
        nodes = up
    return nodes[0][0], paths


def plain(rows, arity=16):
    """Sorted (id, leaf, subroot, root, siblings) of all rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    out, subroots = [], []
    for s in order:
        members = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        root, paths = tree([leaf(r) for r in members], arity)
        subroots.append(root)
        out.append([(r["doc_id"], leaf(r), root, p) for r, p in zip(members, paths)])
    top, above = tree(subroots, arity)
    return sorted(((i, x, sub, top, "".join(a + b for a, b in p + above[g])) for g, members in enumerate(out) for i, x, sub, p in members), key=str)


def told(found):
    rows = M.verified(found.proofs).select("id", *[M.hex_of(F.col(c)) for c in ("hash", "subroot", "root")], M.siblings(F.col("path")).alias("s"), "folded_root", "verified").collect()
    assert all(r["verified"] and r["folded_root"] == r[3] for r in rows)
    return sorted((tuple(r)[:5] for r in rows), key=str)


def frame(spark, sizes, seed=1):
    rng, rows = random.Random(seed), []
    for s, n in enumerate(sizes):
        rows += [(rng.randrange(10**9), f"Text {rng.random()}" if rng.random() > 0.1 else None, rng.choice(["en", "", None]), [None, "", "a", "é", "z", "Z"][s % 6] if s < 6 else f"s{s}", rng.randrange(99))
                 for _ in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("arity,sizes", [(16, [1]), (16, [1, 2, 15, 16, 17, 300]), (16, [1] * 40), (2, [1, 2, 3, 8, 13])])
def test_against_recursion(spark, arity, sizes):
    docs = frame(spark, sizes)
    found = M.manifest(docs, arity=arity)
    assert told(found) == plain(docs.collect(), arity)
    assert sorted((r["name"] is not None, r["name"] or "", r["n"]) for r in found.groups.collect()) == sorted((s is not None, s or "", n) for (s, n) in docs.groupBy("source").count().collect())


def test_messy_rows(spark):
    docs = messy(spark)
    assert told(M.manifest(docs)) == plain(docs.collect())


def test_empty_table(spark):
    found = M.manifest(empty(spark))
    assert M.verified(found.proofs).collect() == [] and found.groups.collect() == []


def test_order_of_rows_and_partitions_does_not_matter(spark):
    docs = frame(spark, [40, 7, 100])
    again = docs.repartition(5, "text").orderBy(F.desc("n_chars"))
    assert told(M.manifest(docs)) == told(M.manifest(again))


def test_only_tampered_rows_fail(spark):
    docs = frame(spark, [3, 50, 20]).withColumn("row", F.lit(1))
    found = M.verified(M.manifest(docs, claim=Q.tampered).proofs)
    by_id = {r["doc_id"]: r["text"] for r in docs.collect()}
    import zlib

    for r in found.collect():
        text = by_id[r["id"]]
        changed = zlib.crc32(str(r["id"]).encode()) % 5 == 0 and text is not None
        assert r["verified"] == (not changed)


def test_one_level_is_one_equijoin(spark):
    nodes = spark.range(100).select(F.lit(0).cast("long").alias("g"), F.col("id").alias("idx"), F.lit(100).cast("long").alias("n"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("hash"))
    plan = M.linked(nodes)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and "collect_list" in plan
    rows = {r["idx"]: r for r in M.linked(nodes).collect()}
    assert len(rows[99]["left"]) == 3 * 32 and len(rows[99]["right"]) == 0 and len(rows[17]["left"]) == 32 and len(rows[17]["right"]) == 14 * 32
