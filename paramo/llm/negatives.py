"""Operator 13, hard-negative mining with Four-Russians scoring.

Vectors are made whole numbers, ``floor(scale * x)``.  A candidate is stored
as its bit planes: eight dimensions make a group, and the bits that the eight
numbers of a group have at one place make a byte, so a vector of 64 numbers of
10 bits is 80 bytes.  For an anchor and a group, the sums of all 256 subsets
of the anchor's eight numbers are precomputed.  The exact inner product then
needs no multiplication: the byte of each plane and group looks its subset
sum up, and the planes are added from the highest on, doubling in between (the
highest plane, the sign's, counts negatively).

Anchors are a query set: they are written to the shared folder, and every
task streams them past its candidates, a block of either at a time, and emits
an anchor's best few rows of the block.  A first pass finds the positives, a
second one, which knows their scores, the negatives below them.  Memory is
bounded by the two block sizes; a window by anchor joins the blocks' bests.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paramo.llm.common import pick, scratch_path, shared_folder, store

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 5, 80, 100
#: Anchors whose tables and scores are held at a time; candidates scored at a time.
ANCHOR_BLOCK, CANDIDATE_BLOCK = 256, 4_096
SUBSETS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def packed(numbers: np.ndarray, planes: int) -> np.ndarray:
    """Bytes ``(rows, planes, groups)`` of the bit planes of whole numbers ``(rows, dimensions)``, in two's complement, lowest plane first."""
    rows, dims = numbers.shape
    whole = np.pad(numbers, ((0, 0), (0, -dims % 8)))
    bits = (whole[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """Tables ``(groups, 256, anchors)``: for each byte the sum of the anchor's numbers at its set bits."""
    rows, dims = anchors.shape
    groups = np.pad(anchors, ((0, 0), (0, -dims % 8))).reshape(rows, -1, 8)
    return np.einsum("sb,agb->gsa", SUBSETS, groups).astype(kind)


def scores(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Inner products ``(candidates, anchors)`` by lookups, shifts and additions."""
    rows, n, groups = planes.shape
    out = np.zeros((rows, tables.shape[2]), tables.dtype)
    looked = np.empty((min(rows, 512), tables.shape[2]), tables.dtype)
    for at in range(0, rows, 512):  # so that sums stay in the processor's cache
        total, some = out[at : at + 512], planes[at : at + 512]
        for p in range(n - 1, -1, -1):
            total <<= 1
            for g in range(groups):
                total += np.take(tables[g], some[:, p, g], axis=0, out=looked[: len(some)], mode="clip")
            if p == n - 1:
                np.negative(total, out=total)
    return out


def best(points: np.ndarray, allowed: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (candidate, anchor) of each anchor's first ``k`` allowed candidates, by higher score, then id, then row; ``points`` and ``allowed`` are (anchors, candidates)."""
    n = points.shape[1]
    ranked = np.where(allowed, points, np.iinfo(points.dtype).min)
    kth = np.partition(ranked, n - k, axis=1)[:, n - k, None] if n > k else np.iinfo(points.dtype).min
    a, c = np.nonzero(allowed & (ranked >= kth))
    order = np.lexsort((rows[c], ids[c], -points[a, c].astype(np.int64), a))
    a, c = a[order], c[order]
    keep = np.arange(len(a)) - np.searchsorted(a, a) < k
    return c[keep], a[keep]


def _numbers(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled up with zeros."""
    out = np.zeros((len(column), dims), np.int64)
    for i, x in enumerate(column):
        out[i, : len(x)] = x.values.to_numpy()
    return out


def whole_vectors(vectors: DataFrame, key: str, label: str, vec: str, scale: int) -> DataFrame:
    """``(row, id, label, q)`` of the rows that take part."""
    cells = pick(vectors, id=key, label=label, vec=vec)
    number = cells.withColumn("vec", F.transform("vec", lambda x: x.cast("double")))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = number.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).where(sound)
    whole = F.transform("vec", lambda x: F.floor(x * scale).cast("long"))
    return kept.select(F.monotonically_increasing_id().alias("row"), F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), whole.alias("q"))


def hard_negatives(vectors: DataFrame, is_anchor: Callable[[Column], Column], key: str = "vec_id", label: str = "label", vec: str = "embedding", scale: int = SCALE,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   anchor_block: int = ANCHOR_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows whose key (``is_anchor`` of it) is chosen.  An
    anchor's positives are its first ``positives`` other rows of the same
    label, by inner product, then smaller key; for each, the first
    ``negatives`` rows of other labels with ``low * positive <= 100 *
    negative <= high * positive`` are returned, ranked from 1.

    Rows without a key, label or vector, and those with a null or non-finite
    component, take no part.  Rows that repeat a key are rows of their own, each
    an anchor if its key is one; an anchor without positives, and a positive
    without negatives, give no row.  Shorter vectors count as filled up with
    zeros; an empty vector scores 0.  Keys and labels are whole numbers.
    Other columns are not read; an empty table gives an empty result.  Numbers
    so large that a score could leave 64 bits raise ValueError."""
    spark = vectors.sparkSession
    rows = store(whole_vectors(vectors, key, label, vec, scale), "negatives-rows")
    most = rows.agg(F.max(F.array_max(F.transform("q", lambda x: F.greatest(x, F.bitwise_not(x))))).alias("high"), F.max(F.size("q")).alias("dims")).first()
    dims, planes = max(most["dims"] or 0, 1), int(most["high"] or 0).bit_length() + 1
    bound = dims << (2 * planes - 2)  # no score is larger
    if bound * max(low, high, 100) >= 2**63:
        raise ValueError(f"components of {planes} bits in {dims} dimensions: scores could leave 64 bits")
    kind = np.int32 if bound < 2**30 else np.int64
    width = planes * -(-dims // 8)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = packed(_numbers(b.column(3), dims), planes).reshape(len(b), width)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(list(map(bytes, raw)), pa.binary())], ["row", "id", "label", "planes"])

    candidates = store(rows.mapInArrow(pack, "row long, id long, label long, planes binary"), "negatives-planes")

    def streamed(anchors: DataFrame, find: Callable, schema: str) -> DataFrame:
        """What ``find(anchors' columns, their scores, candidates)`` emits for each pair of blocks."""
        path = scratch_path(spark, "negatives-anchors")
        anchors.write.parquet(path)
        names = [f.split()[0] for f in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, base = shared_folder(path)
            asked = pa.dataset.dataset(base, filesystem=fs, format="parquet", schema=pa.schema([("row", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("q", pa.list_(pa.int64())), ("p", pa.list_(
                pa.struct([("row", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])))]))
            for whole in batches:
                for at in range(0, len(whole), candidate_block):
                    b = whole.slice(at, candidate_block)
                    own = [b.column(i).to_numpy() for i in range(3)]
                    bytes_ = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8).reshape(len(b), planes, -1)
                    for block in asked.to_batches(batch_size=anchor_block):
                        if len(block):
                            tables = subset_sums(_numbers(block.column(3), dims), kind)
                            found = find(block, np.ascontiguousarray(scores(bytes_, tables).T), *own)
                            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names)

        return candidates.mapInArrow(run, schema)

    def near(block: pa.RecordBatch, points: np.ndarray, row: np.ndarray, ident: np.ndarray, label: np.ndarray):
        a_row, a_label = block.column(0).to_numpy(), block.column(2).to_numpy()
        c, a = best(points, (label[None, :] == a_label[:, None]) & (row[None, :] != a_row[:, None]), ident, row, positives)
        return a_row[a], row[c], ident[c], points[a, c]

    def below(block: pa.RecordBatch, points: np.ndarray, row: np.ndarray, ident: np.ndarray, label: np.ndarray):
        a_row, a_id, a_label = (block.column(i).to_numpy() for i in range(3))
        told, other = block.column(4).to_pylist(), label[None, :] != a_label[:, None]
        out = []
        for j in range(max(map(len, told))):
            some = np.array([i for i, p in enumerate(told) if j < len(p)])
            p_row, p_id, p_score = (np.array([told[i][j][x] for i in some]) for x in ("row", "id", "score"))
            # whole-number ends of the interval
            least, top = -(-low * p_score // 100), high * p_score // 100
            part = points[some]
            c, a = best(part, other[some] & (part >= least[:, None]) & (part <= top[:, None]), ident, row, negatives)
            out.append((a_row[some][a], a_id[some][a], p_row[a], p_id[a], p_score[a], row[c], ident[c], part[a, c]))
        return [np.concatenate(x) for x in zip(*out)]

    anchors = rows.where(is_anchor(F.col("id")))
    nothing = F.array().cast("array<struct<row: bigint, id: bigint, score: bigint>>")
    seen = streamed(anchors.withColumn("p", nothing), near, "a long, row long, id long, score long")
    first = F.row_number().over(W.partitionBy("a").orderBy(F.desc("score"), "id", "row"))
    chosen = seen.withColumn("place", first).where(F.col("place") <= positives)
    chosen = chosen.groupBy("a").agg(F.collect_list(F.struct("row", "id", "score")).alias("p"))  # ``positives`` at most
    known = store(anchors.join(chosen.withColumnRenamed("a", "row"), "row"), "negatives-positives")
    found = streamed(known.select("row", "id", "label", "q", "p"), below, "a long, anchor_id long, p long, positive_id long, positive_score long, row long, negative_id long, negative_score long")
    place = F.row_number().over(W.partitionBy("a", "p").orderBy(F.desc("negative_score"), "negative_id", "row"))
    ranked = found.withColumn("rank", place.cast("int")).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
