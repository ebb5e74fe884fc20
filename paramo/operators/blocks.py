"""Compact blocks: an index of boxes over points, by which distance operators skip most pairs.

Splitting planes are learned from a bounded sample of the points (median of
the widest dimension, again and again); every point goes to its leaf, and a
leaf above the block size is split further by a hash of the key, so a place
with a third of all points is many blocks of bounded size.  A block is stored
as one record: its keys, its coordinates, and the box around them.

The boxes, at most ``MAX_BLOCKS`` of them (blocks grow beyond that), are all
that reaches the driver.  A block's points visit another block only if the
box is near enough for them (:func:`visits`): no pair is looked at whose
distance cannot matter, and none is missed, as a box is never farther than
the points in it.  Without structure in the data nothing can be skipped and
the work is that of all pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paramo.plans.materialize import materialize

#: Points that the planes are learned from, about; blocks at most, whose boxes every task holds; points whose distances to a block are held at a time.
SAMPLE, MAX_BLOCKS, CHUNK = 20_000, 100_000, 256
#: Relative room for rounding when a pair of blocks is skipped, and in single precision.
SLACK, ROOM = 1e-9, 2.5e-7
#: Points, about, that a task of :func:`met` holds of either side.
GROUP_ROWS = 500_000


@dataclass
class Blocks:
    """Stored records ``(blk, keys, xs, ..)``, as bytes of 64-bit numbers, and their boxes as ``(blk, lo, hi)`` arrays."""

    df: DataFrame
    boxes: Broadcast
    dims: int
    count: int
    rows: int


def planes(sample: np.ndarray, leaves: int) -> list[tuple[int, float, int, int]]:
    """Nodes ``(dimension, threshold, left, right)`` of a tree with up to ``leaves`` leaves; a leaf is (-1, 0, number, 0)."""
    nodes: list[tuple[int, float, int, int]] = []
    made = 0

    def build(x: np.ndarray, want: int) -> int:
        nonlocal made
        me = len(nodes)
        nodes.append((-1, 0.0, 0, 0))
        spread = x.max(axis=0) - x.min(axis=0) if len(x) else np.zeros(x.shape[1])
        d = int(np.argmax(spread)) if len(spread) else 0
        if want > 1 and len(x) > 1 and spread[d] > 0:
            at = float(np.quantile(x[:, d], want // 2 / want, method="lower"))
            left = x[:, d] <= at
            if left.all():  # the plane has to part the points: below their largest value
                at = float(x[x[:, d] < at][:, d].max())
                left = x[:, d] <= at
            lo, hi = build(x[left], want // 2), build(x[~left], want - want // 2)
            nodes[me] = (d, at, lo, hi)
        else:
            nodes[me] = (-1, 0.0, made, 0)
            made += 1
        return me

    build(sample, leaves)
    return nodes


def leaf_of(x: np.ndarray, nodes: list[tuple[int, float, int, int]]) -> np.ndarray:
    dim, at, left, right = (np.array(c) for c in zip(*nodes))
    node = np.zeros(len(x), int)
    while (inner := dim[node] >= 0).any():
        some = np.flatnonzero(inner)
        here = node[some]
        node[some] = np.where(x[some, dim[here]] <= at[here], left[here], right[here])
    return left[node]


def matrix(raw: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(raw, np.float64).reshape(-1, dims)


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dims)


def compact_blocks(points: DataFrame, key: str, vec: str, block_size: int, carry: Sequence[str] = ()) -> Blocks:
    """The blocks of ``points(key, vec, ..)``; keys are whole numbers, vectors of one length without nulls.

    The columns of ``carry``, doubles, travel along in the records under their names."""
    spark = points.sparkSession
    told = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec)).alias("d")).first()
    n, dims = told["n"], max(told["d"] or 0, 0)
    cores = spark.sparkContext.defaultParallelism
    block_size = max(block_size, math.ceil(n / MAX_BLOCKS))
    # small data are parted more finely: enough blocks for all cores
    leaves = max(1, math.ceil(n / block_size), min(2 * cores, math.ceil(n / 256)))
    rate = min(1.0, SAMPLE / max(n, 1))
    drawn = points.where(F.pmod(F.xxhash64(key, F.lit("planes")), F.lit(1 << 30)) < int(rate * (1 << 30))).select(vec) if rate < 1 else points.select(vec)
    tree = planes(_vectors(drawn.toArrow().column(0).combine_chunks(), max(dims, 1)) if n and dims else np.zeros((0, max(dims, 1))), leaves)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _vectors(b.column(1), dims) if dims else np.zeros((len(b), 1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf_of(x, tree), pa.int64())], [*b.schema.names, "leaf"])

    extra = [f"x_{c}" for c in carry]
    rows = points.select(F.col(key).cast("long").alias("key"), F.col(vec).cast("array<double>").alias("vec"), *[F.col(c).cast("double").alias(x) for c, x in zip(carry, extra)])
    placed = rows.mapInArrow(assign, "key long, vec array<double>, " + "".join(f"{x} double, " for x in extra) + "leaf long")
    placed = materialize(placed, "placed")
    # one row a leaf, at most as many as the sample has points
    parts = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block_size).alias("parts"))
    split = placed.join(F.broadcast(parts), "leaf").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))

    def pack(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        order = np.argsort(group.column("key").to_numpy(), kind="stable")
        keys = group.column("key").to_numpy()[order]
        x = (_vectors(group.column("vec").combine_chunks(), dims) if dims else np.zeros((len(keys), 0)))[order]
        blk = group.column("leaf")[0].as_py() * (1 << 32) + group.column("part")[0].as_py()
        others = {c: [group.column(e).to_numpy()[order].tobytes()] for c, e in zip(carry, extra)}
        kind = [("blk", pa.int64()), ("keys", pa.binary()), ("xs", pa.binary()), *[(c, pa.binary()) for c in carry], ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64()))]
        return pa.table({"blk": [blk], "keys": [keys.tobytes()], "xs": [x.tobytes()], **others, "lo": [x.min(axis=0).tolist()], "hi": [x.max(axis=0).tolist()]}, pa.schema(kind))

    packed = split.groupBy("leaf", "part").applyInArrow(pack, "blk long, keys binary, xs binary, " + "".join(f"{c} binary, " for c in carry) + "lo array<double>, hi array<double>")
    packed = materialize(packed, "blocks")
    boxes = packed.select("blk", "lo", "hi").toArrow()  # MAX_BLOCKS rows, about, at most
    held = (boxes.column("blk").to_numpy(), *(_vectors(boxes.column(c).combine_chunks(), dims) if len(boxes) else np.zeros((0, dims)) for c in ("lo", "hi")))
    return Blocks(packed.drop("lo", "hi"), spark.sparkContext.broadcast(held), dims, len(boxes), n)


def box_distance(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Distance of points to boxes, a little less for rounding; broadcasts over leading axes."""
    gap = np.maximum(np.maximum(lo - x, x - hi), 0.0)
    return np.sqrt(np.einsum("...i,...i->...", gap, gap)) * (1 - SLACK)


def _spread(records: DataFrame) -> DataFrame:
    """Records over all cores: a stored table of few bytes is read by few tasks, but a record is much work."""
    return records.repartition(2 * records.sparkSession.sparkContext.defaultParallelism)


def visits(records: DataFrame, blocks: Blocks, asks: Callable, upward: bool = False) -> DataFrame:
    """``(frm, to, keys, xs, extra)``: the points of each record that have to look at another block.

    ``asks(record)`` gives the rows of a record (a dict of its columns) that
    still ask, how far each of them looks, and eight bytes of each, of one
    kind, that travel along.  With ``upward`` a pair of blocks comes once.
    A block's points go to another one only where the box is within reach."""
    boxes, dims, names = blocks.boxes, blocks.dims, records.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, low, high = boxes.value
        for b in batches:
            for i in range(len(b)):
                record = {c: b.column(j)[i].as_py() for j, c in enumerate(names)}
                rows, reach, extra = asks(record)
                if not len(rows):
                    continue
                x, keys = matrix(record["xs"], dims)[rows], np.frombuffer(record["keys"], np.int64)[rows]
                gap = np.maximum(np.maximum(low - x.max(axis=0), x.min(axis=0) - high), 0.0)
                near = np.sqrt((gap * gap).sum(axis=1)) * (1 - SLACK) <= reach.max()
                near &= ids > record["blk"] if upward else ids != record["blk"]
                for at in np.flatnonzero(near).tolist():
                    some = box_distance(x, low[at], high[at]) <= reach
                    if some.any():
                        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in (
                            (record["blk"], pa.int64()), (int(ids[at]), pa.int64()), (keys[some].tobytes(), pa.binary()), (x[some].tobytes(), pa.binary()), (extra[some].tobytes(), pa.binary()))],
                            ["frm", "to", "keys", "xs", "extra"])

    return _spread(records).mapInArrow(run, "frm long, to long, keys binary, xs binary, extra binary")


def close_pairs(a: np.ndarray, b: np.ndarray, limit: np.ndarray, weight: np.ndarray | None = None, share: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(row of a, row of b)`` of all pairs whose squared distance is at most ``limit[i]`` (plus ``weight[i] * share[j]``), and of few that are a little farther.

    One single-precision product a tile, with room for its rounding: callers decide by direct differences."""
    centre = a.mean(axis=0)
    x, y = a - centre, b - centre
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    extra = ([], []) if weight is None else ([-weight[:, None]], [share[:, None]])
    left = np.hstack([-2.0 * x, np.ones((len(x), 1)), xx[:, None], *extra[0]]).astype(np.float32)
    right = np.ascontiguousarray(np.hstack([y, yy[:, None], np.ones((len(y), 1)), *extra[1]]).astype(np.float32).T)
    most = limit if weight is None else limit + weight * share.max()
    top = limit + ROOM * (a.shape[1] + 4) * (xx + yy.max() + np.where(np.isfinite(most), most, 0.0))
    rows, cols = [], []
    for s in range(0, len(x), CHUNK):
        hit = np.flatnonzero((left[s:s + CHUNK] @ right <= top[s:s + CHUNK, None].astype(np.float32)).ravel())
        i = hit // len(y)
        rows.append(i + s)
        cols.append(hit - i * len(y))
    return np.concatenate(rows), np.concatenate(cols)


def met(records: DataFrame, blocks: Blocks, held: DataFrame, asks: Callable, meet: Callable, schema: str, upward: bool = False, done: Callable | None = None) -> DataFrame:
    """What ``meet(visit, record)`` returns, a list of columns, for each record that has to look at a block of ``held``.

    Records and blocks are dealt into as many groups each as make some tasks
    a core (more where a group would hold over ``GROUP_ROWS`` points), and a
    task gets one group of either: what is shuffled is a fixed multiple of
    the points, however many pairs of blocks there are.  ``asks`` and
    ``upward`` are those of :func:`visits`; a visit holds the points that are
    within reach of the block, their places ``rows`` among those that ask, and
    for all blocks that the record meets in the task one ``state`` and the
    ``reach`` of its points, which ``meet`` may lessen.  ``done(record, state)``
    returns columns after the last one.  Nearest blocks come first."""
    spark, dims, boxes = records.sparkSession, blocks.dims, blocks.boxes
    groups = max(math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism)), math.ceil(blocks.rows / GROUP_ROWS))
    each = F.sequence(F.lit(0), F.lit(groups - 1))
    group = F.pmod(F.shiftright("blk", 32) + F.col("blk").bitwiseAND(F.lit((1 << 32) - 1)), F.lit(groups)).cast("int")
    asking = records.select(F.explode(F.transform(each, lambda j: group * groups + j)).alias("cell"), F.struct(*records.columns).alias("asking"), F.lit(None).cast(held.select(F.struct(*held.columns).alias("h")).schema["h"].dataType).alias("held"))
    there = held.select(F.explode(F.transform(each, lambda i: i * groups + group)).alias("cell"), F.lit(None).cast(asking.schema["asking"].dataType).alias("asking"), F.struct(*held.columns).alias("held"))
    fields = [f.split()[0] for f in schema.split(", ")]

    def out(found):
        if found is not None and len(found[0]):
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in found], fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        askers, blks = [], []
        for b in batches:
            for one, other in zip(b.column(1), b.column(2)):
                (askers if one.is_valid else blks).append((one if one.is_valid else other).as_py())
        if not askers or not blks:
            return
        ids, low, high = boxes.value
        order = np.argsort(ids)
        at = order[np.searchsorted(ids, [r["blk"] for r in blks], sorter=order)]
        ids, low, high = ids[at], low[at], high[at]
        while askers:
            record = askers.pop()
            rows, reach, extra = asks(record)
            if not len(rows):
                continue
            x, keys = matrix(record["xs"], dims)[rows], np.frombuffer(record["keys"], np.int64)[rows]
            gap = np.maximum(np.maximum(low - x.max(axis=0), x.min(axis=0) - high), 0.0)
            gap = np.sqrt((gap * gap).sum(axis=1)) * (1 - SLACK)
            near = (ids > record["blk"] if upward else ids != record["blk"])
            state, reach = {}, np.array(reach, float)
            centre = x.mean(axis=0)
            from_centre = np.where(gap > 0, gap, 0) + 1e-3 * np.sqrt((((low + high) / 2 - centre) ** 2).sum(axis=1))
            for k in np.argsort(from_centre, kind="stable").tolist():
                if near[k] and gap[k] <= reach.max():
                    some = np.flatnonzero(box_distance(x, low[k], high[k]) <= reach)
                    if len(some):
                        yield from out(meet({"frm": record["blk"], "keys": keys[some], "xs": x[some], "extra": extra[some], "rows": some, "reach": reach, "state": state}, blks[k]))
            if done is not None:
                yield from out(done({**record, "asked": rows, "extra": extra}, state))

    return asking.unionByName(there).repartitionById(groups * groups, "cell").mapInArrow(run, schema)


def alone(records: DataFrame, work: Callable, schema: str) -> DataFrame:
    """What ``work(record)`` returns, a list of columns, for each record by itself."""
    names, fields = records.columns, [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                found = work({c: b.column(j)[i].as_py() for j, c in enumerate(names)})
                if found is not None and len(found[0]):
                    yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in found], fields)

    return _spread(records).mapInArrow(run, schema)
