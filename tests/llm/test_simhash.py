import numpy as np
import xxhash
from pyspark.sql import functions as F

from paramo.llm import simhash as S
from tests.llm.helpers import documents, empty, messy


def plain_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=4):
    """Smallest id by fingerprint, from all pairs."""
    fps = sorted({p for _, p in prints})
    arr = np.array(fps, np.uint64)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= radius) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    at = {p: find(i) for i, p in enumerate(fps)}
    for i, p in prints:
        if i is not None:
            least[at[p]] = min(i, least.get(at[p], i))
    return {p: least.get(at[p]) for p in fps}


def check(docs, **kw):
    prints = [(r["doc_id"], plain_print(r["text"])) for r in docs.select("doc_id", "text").collect()]
    want = plain_components(prints)
    got = S.near_duplicates(docs, **kw).collect()
    assert sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=str) == sorted(((i, p, want[p]) for i, p in prints), key=str)
    return got


def test_documents(spark):
    got = check(documents(spark))
    assert len({r["component_id"] for r in got}) < len({r["fp"] for r in got})  # some copies are near ones


def test_edges(spark):
    check(messy(spark))
    assert S.near_duplicates(empty(spark)).collect() == []
    r = spark.createDataFrame([(0, "ff")], "n long, x string").select(S.hex_of(F.lit(255)).alias("h"), S.hex_of(F.lit(-1)).alias("m")).first()
    assert (r["h"], r["m"]) == ("00000000000000ff", "f" * 16)


def test_masks_cover_the_radius():
    masks = S.covering_masks(4)
    rng = np.random.default_rng(1)
    assert len(masks) == 31
    for _ in range(3000):
        bits = rng.choice(64, rng.integers(0, 5), replace=False)
        apart = np.uint64(sum(1 << int(b) for b in bits))
        assert (masks & apart == 0).any()


def test_crowded_keys_are_split(spark):
    """Every key above three fingerprints takes the second pass; the components stay the same."""
    rng = np.random.default_rng(3)
    fps = {0, 1 << 63}
    for c in rng.integers(0, 2**63, 12):
        for _ in range(25):
            fps.add(int(c) ^ sum(1 << int(b) for b in rng.choice(64, 2, replace=False)))
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    frame = spark.createDataFrame(signed, "fp long")
    want = plain_components([(f, f) for f in fps])
    from paramo.llm.components import components
    for crowd in (3, 10_000):
        roots = {r["node"] % 2**64: r["root"] % 2**64 for r in components(S.links(frame, 4, crowd)).collect()}
        groups = {}
        for f in fps:
            groups.setdefault(roots.get(f, f), set()).add(want[f])
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_one_of_each_group_stays(spark):
    docs = messy(spark)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    rows = S.near_duplicates(docs).collect()
    assert len(ids) == len({r["root"] for r in rows})
    assert set(ids) == {r["component_id"] for r in rows} and ids.count(1) == 1
    assert S.keep_one(empty(spark)).collect() == []


def test_crowds_that_a_sample_tells_are_not_scanned(spark, monkeypatch):
    """A third of all fingerprints under a few keys; components do not depend on how crowds are found."""
    import numpy as np
    from pyspark.sql import functions as F

    from paramo.llm.components import components

    rng = np.random.default_rng(11)
    # half of them differ in the top 14 bits only, so they share the keys whose masks leave those out
    prints = np.unique(np.concatenate([rng.integers(0, 2**63, 400), (rng.integers(0, 2**14, 500) << 49) | 12345]))
    frame = spark.createDataFrame([(int(x),) for x in prints], "fp long")
    want = None
    for sampled, crowd in ((64, 10_000), (2, 20), (1, 20), (64, 20)):
        monkeypatch.setattr(S, "SAMPLED", sampled)
        roots = {r["node"]: r["root"] for r in components(S.links(frame, 4, crowd)).collect()}
        want = want or roots
        assert roots == want and len(set(roots.values())) < len(roots)
