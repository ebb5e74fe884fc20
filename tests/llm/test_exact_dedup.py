import hashlib
import re

from pyspark.sql import functions as F

from paramo.llm import exact_dedup as D
from tests.llm.helpers import documents, empty, messy


def brute(rows):
    """{(id, text): (keep id, group size)} by a dictionary of normalised texts."""
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((i, text or ""))
    out = {}
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        for i, text in members:
            out[i, text] = (keep, len(members), hashlib.sha256(norm.encode()).hexdigest())
    return out


def check(docs, **kw):
    want = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r["doc_id"], []).append(r["text"] or "")
    got = D.exact_dedup(docs, **kw).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r["keep_id"], r["group_size"], r["text_sha256"]) in {want[r["doc_id"], t] for t in texts[r["doc_id"]]}
    return got


def test_documents(spark):
    got = check(documents(spark))
    assert sum(r["kept"] for r in got) == len({r["text_sha256"] for r in got})


def test_collisions_are_chained_and_compared_by_bytes(spark):
    got = check(documents(spark), text_hash=lambda norm: F.pmod(F.xxhash64(norm), F.lit(7)), capacity=3, max_depth=6)
    assert max(r["chain"] for r in got) > 50


def test_directory_doubles_until_buckets_fit(spark):
    hashes = documents(spark).select(F.xxhash64("text").alias("h"))
    depth, entries = D.directory(hashes, capacity=20, max_depth=16)
    prefix = F.expr(f"shiftrightunsigned(h, {64 - depth})")
    held = hashes.distinct().withColumn("entry", prefix).join(entries, "entry").groupBy("bucket").agg(F.count("*").alias("n"), F.min("depth").alias("d"), F.max("depth").alias("e")).collect()
    assert sum(r["n"] for r in held) == hashes.distinct().count()
    assert all(r["n"] <= 20 and r["d"] == r["e"] for r in held)
    assert depth > min(r["d"] for r in held)  # buckets that fit did not split with the directory
    assert D.directory(hashes, capacity=10**6)[0] == 0


def test_edges(spark):
    docs = messy(spark)
    rows = check(docs)
    got = {(r["doc_id"], r["n_chars"]): r for r in sorted(rows, key=lambda r: r["kept"])}
    assert len({r["text_sha256"] for r in rows}) == sum(r["kept"] for r in rows)
    assert got[3, 0]["keep_id"] == 5 and got[4, 0]["group_size"] == 4  # null, empty and blank texts are equal; the longest stays
    assert got[1, 64]["keep_id"] == 1 and got[1, 64]["kept"] and got[1, 64]["group_size"] == 2
    assert got[None, 64]["keep_id"] is None and got[None, 64]["kept"]
    assert D.exact_dedup(empty(spark)).collect() == []
    extreme = spark.createDataFrame([(-(2**63), "a"), (2**63 - 1, "a"), (None, "a")], "doc_id long, text string")
    assert {r["keep_id"] for r in D.exact_dedup(extreme).collect()} == {-(2**63)}


def test_of_repeated_rows_one_stays(spark):
    """Also of rows that agree in key and text, and of rows without a key; the same as the query's SQL."""
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "ab"), (2, "a b"), (None, "x"), (None, "x"), (None, "x"), (7, None), (7, "")], "doc_id long, text string")
    got = D.exact_dedup(docs).collect()
    assert len(got) == 9
    for digest in {r["text_sha256"] for r in got}:
        assert sum(r["kept"] for r in got if r["text_sha256"] == digest) == 1


def test_probes_go_through_the_directory(spark):
    """With a directory that names wrong buckets the entries are not found."""
    docs = documents(spark)
    n = docs.count()
    assert D.exact_dedup(docs, capacity=50).count() == n
    wrong = D.exact_dedup(docs, capacity=50, spoiled=lambda e: e.withColumn("bucket", (F.col("bucket") + 1) % 8))
    assert wrong.count() < n / 2
