"""Operator 4, near-duplicates by SimHash and covering locality-sensitive hashing.

A fingerprint bit is set if more than half of the hashes of a text's word
shingles have it.  Fingerprints within ``radius`` bits link.  For radius r
every bit position gets a random vector of r + 1 bits, and for each of the
2**(r+1) - 1 non-zero vectors v there is a table, keyed by the fingerprint
under the mask of the positions whose vector has an odd product with v.  The
vectors of any r positions leave some v with which all their products are
even, so every pair within the radius agrees on some mask: no link is missed.

Fingerprints are made distinct first, so copies meet as one row.  A task
streams a table's keys in order and joins the fingerprints of one key by
growing clusters: each found one is compared with those not found yet, and
one edge is kept for each, so a key with k fingerprints gives at most k - 1
edges.  Keys with more than ``crowd`` fingerprints go to a second pass that
deals pairs of blocks of them to many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paramo.llm.common import numbered, pick, restored, store
from paramo.llm.components import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Fingerprints of one key that a single task takes.
CROWD = 20_000
#: Of so many fingerprints one is in the sample that tells crowded keys beforehand.
SAMPLED = 64
MASK_SEED = 42


def fingerprint(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text, A-Z lower-cased; fewer words than a shingle: the whole sequence; none: 0."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    line, n = b" ".join(words), len(words)
    size = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(size + 1) - 1
    begin = end - size
    if n > shingle:
        begin, end = begin[: n - shingle + 1], end[shingle - 1 :]
    else:
        begin, end = begin[:1], end[-1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(begin), 1 << 16):  # bounded memory for long texts
        part = slice(at, at + (1 << 16))
        hashes = np.array([digest(line[i:j], seed) for i, j in zip(begin[part].tolist(), end[part].tolist())], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begin), bitorder="little").view("<u8")[0])


def printed(rows: DataFrame, shingle: int = 4) -> DataFrame:
    """``rows`` with ``fp``, the 64 bits of the fingerprint of their column ``txt`` as a signed long, in place of ``txt``."""
    at = rows.columns.index("txt")
    kept = [i for i in range(len(rows.columns)) if i != at]
    names = [*[rows.columns[i] for i in kept], "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(x, shingle) for x in b.column(at).cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in kept], pa.array(found.view(np.int64))], names)

    return rows.mapInArrow(run, rows.drop("txt").withColumn("fp", F.lit(0).cast("long")).schema)


def covering_masks(radius: int, seed: int = MASK_SEED) -> np.ndarray:
    """2**(radius + 1) - 1 masks, one of which avoids any given ``radius`` bits (so do all sets of fewer)."""
    vectors = np.random.default_rng(seed).integers(0, 1 << (radius + 1), 64)
    tables = np.arange(1, 1 << (radius + 1))
    odd = np.array([[bin(int(v) & int(a)).count("1") & 1 for a in vectors] for v in tables], np.uint64)
    return (odd << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def joined(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among distinct fingerprints, in memory of their size."""
    left, todo, a, b = fps.copy(), [], [], []
    while len(left) or todo:
        if not todo:
            todo.append(left[-1])
            left = left[:-1]
        x = todo.pop()
        near = np.bitwise_count(left ^ x) <= radius
        if near.any():
            new = left[near]
            todo.extend(new)
            a.append(np.full(len(new), x))
            b.append(new)
            left = left[~near]
        elif not len(left):
            break
    empty = np.empty(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def links(distinct: DataFrame, radius: int = 4, crowd: int = CROWD) -> DataFrame:
    """``(a, b)`` edges that join every pair of fingerprints (``fp``) within the radius, directly or over others."""
    masks = covering_masks(radius)
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.lit(int(m)) for m in masks.view(np.int64)])).alias("tab", "mask"))
    keyed = keyed.select("fp", "tab", F.col("fp").bitwiseAND(F.col("mask")).alias("k"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the order of (tab, k): an edge per joined fingerprint; for a crowd its (tab, k) instead."""
        held = [np.empty(0, np.int64)] * 3

        def done(tab, k, fp):
            out = ([], [], [])
            if len(fp) == 0:
                return None
            cut = np.flatnonzero((tab[1:] != tab[:-1]) | (k[1:] != k[:-1])) + 1
            starts = np.concatenate([[0], cut])
            ends = np.concatenate([cut, [len(fp)]])
            for i, j in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
                if j - i > crowd:
                    out[0].append(np.array([tab[i]])), out[1].append(np.array([k[i]])), out[2].append(np.array([True]))
                else:
                    a, b = joined(fp[i:j].view(np.uint64), radius)
                    out[0].append(a.view(np.int64)), out[1].append(b.view(np.int64)), out[2].append(np.zeros(len(a), bool))
            if not out[0]:
                return None
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["a", "b", "crowd"])

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            tab, k, fp = (np.concatenate([h, n]) for h, n in zip(held, new))
            if not len(fp):
                continue
            same = (tab == tab[-1]) & (k == k[-1])
            at = int(np.argmax(same))  # the last key goes on, perhaps
            if len(fp) - at > crowd + 1:  # of a crowd only as many are held as show it to be one
                held = [tab[at : at + crowd + 1], k[at : at + crowd + 1], fp[at : at + crowd + 1]]
            else:
                held = [tab[at:], k[at:], fp[at:]]
            if (out := done(tab[:at], k[:at], fp[:at])) is not None:
                yield out
        if (out := done(*held)) is not None:
            yield out

    # keys that a sample shows to be crowded are not scanned in one task; a crowd that it misses is found by the scan
    some = keyed.where(F.pmod(F.xxhash64("fp"), F.lit(SAMPLED)) == 0).groupBy("tab", "k").agg(F.count(F.lit(1)).alias("n"))
    known = store(some.where(F.col("n") > max(crowd // SAMPLED, 1)).select("tab", "k"), "simhash-crowds")  # SAMPLED * keys / crowd rows at most
    scanned = keyed if known.isEmpty() else keyed.join(known, ["tab", "k"], "left_anti").select(*keyed.columns)
    dealt = scanned.repartition("tab", "k").sortWithinPartitions("tab", "k").select("tab", "k", "fp")
    found = store(dealt.select(F.col("tab").cast("long"), "k", "fp").mapInArrow(scan, "a long, b long, crowd boolean"), "simhash-links")
    edges = found.where("NOT crowd").select("a", "b")
    crowds = found.where("crowd").select(F.col("a").cast("int").alias("tab"), F.col("b").alias("k")).union(known.select("tab", "k"))
    if crowds.isEmpty():
        return edges
    members = keyed.join(crowds, ["tab", "k"])
    blocks = members.groupBy("tab", "k").agg(F.count(F.lit(1)).alias("n")).select("tab", "k", F.ceil(F.col("n") / (crowd / 2.0)).cast("int").alias("m"))
    own = members.join(blocks, ["tab", "k"]).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("m")).cast("int"))
    paired = own.select("fp", F.explode(F.expr("transform(sequence(0, m - 1), x -> struct(tab, k, least(own, x) AS p, greatest(own, x) AS q))")).alias("g")).select("g.*", "fp")

    def together(rows: pa.Table) -> pa.Table:
        a, b = joined(rows.column("fp").to_numpy().view(np.uint64), radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return edges.union(paired.groupBy("tab", "k", "p", "q").applyInArrow(together, "a long, b long"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4, crowd: int = CROWD) -> DataFrame:
    """``(key, fp, component_id, root)`` for every row of ``docs``: the smallest key that links reach, its own included.

    ``root`` is the smallest fingerprint of the component.  Null and blank
    texts have fingerprint 0 and link like others; rows without a key take
    part, and have a null component only where none of it has one.  Repeated
    rows share their component; an empty table gives an empty result.  Texts
    are read once and whole; other columns are not read."""
    prints = store(printed(pick(docs, id=key, txt=text), shingle), "simhash-prints")
    least = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(least.select("fp"), radius, crowd))
    grouped = least.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = store(grouped.select("fp", "root").join(smallest, "root"), "simhash-components")
    return prints.join(by_print, "fp").select(F.col("id").alias(key), "fp", "component_id", "root")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, columns as they are: the one whose key names the component.

    Of several rows with that key the one with the smallest text stays (of
    equal texts any one); a component without any key leaves one row likewise.
    So one of repeated rows stays; null and blank texts are one group; an empty
    table stays empty."""
    found = near_duplicates(docs, key, text, shingle, radius).toDF("id", "fp", "component_id", "root")
    own = store(found.where("id = component_id").groupBy("id").agg(F.count(F.lit(1)).alias("rows")).withColumnRenamed("id", "own"), "simhash-stay")
    rows, plain = numbered(docs, id=key, txt=text)
    least = F.min_by(F.struct(*plain), F.struct(F.col("txt").isNotNull(), "txt")).alias("row")
    # the staying keys grow with the corpus, so they are never broadcast: a shuffle join at any size
    staying = rows.join(own.hint("merge"), F.col("id") == F.col("own"))
    out = staying.where("rows = 1").select(*plain)
    if not own.where("rows > 1").isEmpty():
        out = out.union(staying.where("rows > 1").groupBy("id").agg(least).select("row.*"))
    unnamed = found.where("component_id IS NULL").select("fp", "root").distinct()
    if not unnamed.isEmpty():
        loose = rows.where("id IS NULL")
        again = printed(loose.withColumn("whole", F.struct(*loose.columns)), shingle).select("fp", "whole.*")
        out = out.union(again.join(unnamed, "fp").groupBy("root").agg(least).select("row.*"))
    return restored(out, docs)


def hex_of(fp):
    """16 lowercase hex digits of a fingerprint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
