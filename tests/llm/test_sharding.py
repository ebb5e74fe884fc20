import hashlib
from collections import Counter

import pytest

from paramo.llm import sharding as S
from paramo.llm.queries import SHARDS
from tests.llm.helpers import documents, empty, messy


def h(s):
    return int(hashlib.md5(s.encode()).hexdigest()[:15], 16)


def plain_table(shards, m):
    prefs = [[(h("offset:" + s) % m + j * (h("skip:" + s) % (m - 1) + 1 if m > 2 else 1)) % m for j in range(m)] for s in shards]
    table, at, claimed = [None] * m, [0] * len(shards), 0
    while True:
        for i in range(len(shards)):
            while table[prefs[i][at[i]]] is not None:
                at[i] += 1
            table[prefs[i][at[i]]] = i
            claimed += 1
            if claimed == m:
                return table


def table(spark, shards, m):
    return [r["shard"] for r in S.lookup_table(spark, shards, m).orderBy("slot").collect()]


@pytest.mark.parametrize(("n", "m"), [(1, 2), (1, 101), (2, 2), (3, 7), (5, 499), (7, 7), (40, 4001)])
def test_table(spark, n, m):
    names = [f"s{i}" for i in range(n)]
    assert table(spark, names, m) == plain_table(names, m)


def test_balanced_and_steady(spark):
    names = [f"node-{i}" for i in range(20)]
    before = table(spark, names, 2003)
    counts = Counter(before)
    assert max(counts.values()) - min(counts.values()) <= 1
    after = table(spark, names[:-1], 2003)
    moved = sum(a != b for a, b in zip(after, before) if b != 19)
    assert moved < 0.1 * 2003


def test_bad_tables(spark):
    for shards, m in (([], None), (["a", "a"], None), (["a", "b", "c"], 2), (["a"], 100)):
        with pytest.raises(ValueError):
            S.lookup_table(spark, shards, m)
    assert [S.next_prime(n) for n in (0, 2, 3, 8, 6400)] == [2, 2, 3, 11, 6421]


def test_placement(spark):
    docs = messy(spark)
    want = plain_table(SHARDS, 6421)
    got = S.assign_shards(docs, SHARDS).collect()
    assert len(got) == docs.count()
    for r in got:
        assert want[r["slot"]] == r["shard"]
        if r["doc_id"] is not None:
            assert r["slot"] == h(str(r["doc_id"])) % 6421
    assert {r["slot"] for r in got if r["doc_id"] is None} == {h("none") % 6421, h("text:" + hashlib.md5("Der Hund und die Katze sind mit dem Ball in den Garten gelaufen.".encode()).hexdigest()) % 6421}
    whole = S.with_shard(docs, SHARDS)
    assert whole.columns == [c for c in docs.columns if c != "shard"] + ["shard"] and whole.count() == docs.count()
    assert S.assign_shards(empty(spark), SHARDS).collect() == []


def test_written_shards_hold_all_rows(spark, tmp_path):
    placed = S.with_shard(documents(spark), SHARDS[:5])
    S.write_shards(placed, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out").select(*placed.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, placed.collect()))
