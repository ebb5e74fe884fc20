"""Operator 1, exact deduplication over an extendible-hash index.

Texts are equal when they hold the same bytes once ASCII white space is
deleted.  The normalised texts are written once, with a number for each row;
the index is built from their 64-bit hashes:

1. Counts of distinct hashes by their leading bits size the buckets.  While a
   bucket holds more than ``capacity`` hashes, the directory doubles: one
   more leading bit, and each overfull bucket splits in two.  Buckets that
   are not overfull keep their smaller depth, and several directory entries.
2. Insertion: rows look their bucket up in the directory and are combined by
   bucket, hash and bytes, before the shuffle and after it, so a text with a
   third of all rows is one row a map task.  Texts that differ in bytes under
   one hash stay apart: the hash's chain.  Owner tasks take the entries by
   ranges of buckets, number each chain, and write the index to the shared
   folder.
3. Probing: a row looks its bucket up in the directory and meets, in that
   bucket, the chain of its hash.  A chain of one entry is the row's, as every
   row was inserted; along a longer one the row's bytes are compared with
   those of each entry.  Bucket and chain are what tells a row its group.

Main path: DataFrame and SQL functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paramo.llm.common import pick, store

#: Distinct hashes that a bucket takes before it splits, and the bits after which none does (a directory of at most 2**20 entries).
CAPACITY, MAX_DEPTH = 4_096, 20
TWO_63, TWO_65 = f"{2**63}BD", f"{2**65}BD"


def normalised(text: Column) -> Column:
    """The text without the characters ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in " \n\t\r\x0b\x0c":
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def directory(hashes: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> tuple[int, DataFrame]:
    """The global depth g and ``(entry, bucket, depth)``: for each directory entry (the g leading bits of a hash ``h``)
    the bucket that serves it, named by its first entry, and that bucket's own depth.

    Works on the counts of at most 2**max_depth prefixes.  Entries whose
    bucket holds no hash have no row."""
    longest = store(hashes.select("h").distinct().groupBy(F.expr(f"shiftrightunsigned(h, {64 - max_depth})").alias("p"))
                    .agg(F.count(F.lit(1)).alias("n")), "dedup-prefixes")

    def at(depth: int) -> DataFrame:
        return longest.groupBy(F.expr(f"shiftright(p, {max_depth - depth})").alias("e")).agg(F.sum("n").alias("n"))

    depth = 0
    while depth < max_depth and (at(depth).agg(F.max("n")).first()[0] or 0) > capacity:
        depth += 1
    tree = (at(depth).select("n", F.explode(F.expr(f"transform(sequence(0, {depth}), d -> struct(d, shiftright(e, {depth} - d) AS q))")).alias("x"))
            .groupBy("x.d", "x.q").agg(F.sum("n").alias("n")))
    # the smallest depth at which a prefix fits its bucket; overfull ones split, up to the global depth
    fits = tree.where((F.col("n") <= capacity) | (F.col("d") == depth))
    span = fits.select("d", F.explode(F.expr(f"sequence(shiftleft(q, {depth} - d), shiftleft(q + 1, {depth} - d) - 1)")).alias("entry"))
    own = span.groupBy("entry").agg(F.min("d").alias("depth"))
    return depth, own.select("entry", F.expr(f"shiftleft(shiftright(entry, {depth} - depth), {depth} - depth)").alias("bucket"), "depth")


def with_bucket(rows: DataFrame, entries: DataFrame, depth: int) -> DataFrame:
    """``rows`` with the bucket that the directory names for their hash ``h``.

    The directory is broadcast: at most 2**max_depth entries."""
    entry = F.expr(f"shiftrightunsigned(h, {64 - depth})" if depth else "0L")
    return rows.withColumn("entry", entry).join(F.broadcast(entries.select("entry", "bucket")), "entry").drop("entry")


def inserted(texts: DataFrame, entries: DataFrame, depth: int) -> DataFrame:
    """``(bucket, h, chain, links, keep_id, keep_n, group_size, digest)``: the index, a row for each distinct normalised text.

    ``texts`` has row, id, n (code points of the original), norm and h.
    ``chain`` counts the ``links`` texts under one hash from 1."""
    # the longest original first, then the smallest id, null ids last, as one number: decimals combine in hash aggregates, structs do not
    rank = F.expr(f"cast(n as decimal(11,0)) * {TWO_65} + coalesce({TWO_63} - cast(id as decimal(20,0)), 0BD)").cast("decimal(38,0)")
    distinct = with_bucket(texts, entries, depth).groupBy("bucket", "h", "norm").agg(F.count(F.lit(1)).alias("group_size"), F.max(rank).alias("best"))
    found = distinct.select("bucket", "h", "group_size", F.sha2("norm", 256).alias("digest"),
                            F.expr(f"cast(best DIV {TWO_65} as int)").alias("keep_n"), F.expr(f"pmod(best, {TWO_65})").alias("rest"))
    found = found.withColumn("keep_id", F.expr(f"if(rest = 0, null, cast({TWO_63} - rest as long))"))
    chain = W.partitionBy("bucket", "h")
    owned = found.repartitionByRange("bucket")
    return store(owned.select("bucket", "h", F.row_number().over(chain.orderBy("digest")).alias("chain"), F.count(F.lit(1)).over(chain).alias("links"),
                              "keep_id", "keep_n", "group_size", "digest"), "dedup-index")


def probed(rows: DataFrame, index: DataFrame, entries: DataFrame, depth: int) -> DataFrame:
    """``rows(h, norm, ..)`` without their texts, each with its entry of the index."""
    located = with_bucket(rows, entries, depth)
    chains = index.where("links > 1")
    if chains.isEmpty():  # then no text is read again
        return located.drop("norm").join(index, ["bucket", "h"])
    # the bytes of the entries of chains; the digest tells them apart
    kept = rows.join(chains.select(F.col("h").alias("ch")).distinct(), F.col("h") == F.col("ch"), "left_semi")
    bytes_ = kept.select("h", "norm").distinct().withColumn("digest", F.sha2("norm", 256)).withColumnRenamed("norm", "entry_norm")
    told = index.join(bytes_, ["h", "digest"], "left")
    return located.join(told, ["bucket", "h"]).where((F.col("links") == 1) | (F.col("norm") == F.col("entry_norm"))).drop("norm", "entry_norm")


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, max_depth: int = MAX_DEPTH,
                text_hash: Callable[[Column], Column] = F.xxhash64, spoiled: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``(key, keep_id, group_size, kept, text_sha256, n_chars, bucket, chain)`` for every row of ``docs``.

    Of equal texts one row stays: that with the most code points, then the
    smallest key, which is a whole number; of rows that agree in key and
    length, the first one stored.  Null text counts as empty.  Rows without a
    key stay only where no row of their group and length has one; keep_id is
    then null.  An empty table gives an empty result.  Other columns are not
    read.  ``spoiled`` (for tests) changes the directory that probes use."""
    rows = pick(docs, id=key, txt=text).select("id", F.length(F.coalesce("txt", F.lit(""))).alias("n"), normalised(F.col("txt")).alias("norm"))
    texts = store(rows.withColumns({"h": text_hash(F.col("norm")).cast("long"), "row": F.monotonically_increasing_id()}), "dedup-texts")
    depth, entries = directory(texts, capacity, max_depth)
    entries = store(entries, "dedup-directory")
    index = inserted(texts, entries, depth)
    entries = spoiled(entries) if spoiled else entries
    # the row that stays: of those with its key and length, the first
    mine = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_n"))
    stays = probed(texts, index, entries, depth).where(mine).groupBy("bucket", "h", "chain").agg(F.min("row").alias("keep_row"))
    index = store(index.join(stays, ["bucket", "h", "chain"]), "dedup-stays")
    found = probed(texts, index, entries, depth)
    return found.select(F.col("id").alias(key), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                        F.col("digest").alias("text_sha256"), F.col("n").alias("n_chars"), "bucket", "chain")
