"""Random forest whose trees are grown and applied across the cluster.

A tree learns as Spark ML's does: Poisson(1) weights of the rows, at most 32
bins a feature, a drawn subset of sqrt(d) features a node, the split of the
largest Gini gain, children merged where they agree, and classes voted for by
the shares in the leaves.  It differs in where this happens:

* **upper levels**: while a node holds more than ``DEEP`` rows, all such nodes
  of all trees are split in one pass: tasks count (node, feature, bin, class),
  ``groupBy(tree, node)`` adds the counts up and picks the split.  Only splits
  and the class weights of their children reach the driver;
* **subtrees**: rows of a node of at most ``DEEP`` rows are shuffled to one task
  (a node a group, in packed rows) that grows all below it.  Subtrees are rows
  of a written table and never reach the driver;
* **votes**: rows walk the upper levels where they are read, and are shuffled to
  the subtree where they end.  Every row gets the sum of its trees' votes.

So the driver holds a few nodes for each ``DEEP`` rows of a tree, a task
``DEEP`` rows (when predicting, the rows to predict that end in the same node),
and what is shuffled is a fixed multiple of rows x trees.  Weights and subsets are drawn by
hashes of the row's number, the tree and the node, so a pass that is run again
(a lost task) draws the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paramo.plans.materialize import materialize

#: Bins a feature; rows (by weight) of a node from which on it is split by distributed counts; cells of a block of counts; rows of a block.
BINS, DEEP, CELLS, BATCH = 32, 250_000, 1 << 20, 50_000
#: A feature of a node: it is a leaf, or a subtree grows from it.
LEAF, GROWN = -1, -2
#: Parts of a vote, so that sums do not depend on their order.
PARTS = 1 << 40
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(19)])
_SPLIT = "tree INT, node INT, feature INT, cut INT, gain DOUBLE, low ARRAY<DOUBLE>, high ARRAY<DOUBLE>"
_SUBTREE = "tree INT, node INT, feature BINARY, cut BINARY, child BINARY, counts BINARY, alone ARRAY<DOUBLE>, gain ARRAY<DOUBLE>"


def weights(h: np.ndarray, tree: int) -> np.ndarray:
    """Poisson(1) draws of rows with hashes ``h`` (uint64) for a tree."""
    z = h + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.searchsorted(_POISSON, ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53, side="right")


def walk(tree, x: np.ndarray) -> np.ndarray:
    """The node where the way of every row of bins ends."""
    at = np.zeros(len(x), np.int64)
    rows = np.arange(len(x)) if tree.feature[0] >= 0 else at[:0]
    while len(rows):
        here = at[rows]
        at[rows] = tree.child[here] + (x[rows, tree.feature[here]] > tree.cut[here])
        rows = rows[tree.feature[at[rows]] >= 0]
    return at


def histogram(x, y, w, node, slots, bins: int, classes: int) -> np.ndarray:
    """Weights by (node, slot, bin, class); ``slots`` names the features of every node."""
    n, k = slots.shape
    rows = np.arange(len(y))
    flat = [((node * k + j) * bins + x[rows, slots[node, j]]) * classes + y for j in range(k)]
    return np.bincount(np.concatenate(flat), np.tile(w, k), n * k * bins * classes).reshape(n, k, bins, classes)


def best_splits(hist: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot, bin and weighted Gini gain (0: none) of the best split of every node."""
    left = hist.cumsum(axis=2)
    total = left[:, 0, -1]
    left = left[:, :, :-1]
    right = total[:, None, None] - left
    nl, nr = left.sum(-1), right.sum(-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        pure = np.where((nl > 0) & (nr > 0), (left**2).sum(-1) / nl + (right**2).sum(-1) / nr, -np.inf).reshape(len(hist), -1)
    at, n = pure.argmax(axis=1), np.maximum(total.sum(-1), 1)
    gain = pure[np.arange(len(hist)), at] - (total**2).sum(-1) / n
    return at // left.shape[2], at % left.shape[2], np.where(gain > 1e-9 * n, gain, 0.0)


def merge(tree) -> None:
    """Make a node a leaf whose children are leaves that tell the same class."""
    told = tree.counts.argmax(axis=1)
    while True:
        inner = np.flatnonzero(tree.feature >= 0)
        c = tree.child[inner]
        same = inner[(tree.feature[c] == LEAF) & (tree.feature[c + 1] == LEAF) & (told[c] == told[c + 1])]
        if not len(same):
            return
        tree.feature[same], tree.gain[same] = LEAF, 0.0


def grow(x, y, w, classes: int, bins: int, subset: int, depth: int, rng: np.random.Generator):
    """The tree of a bounded number of rows, level by level; what merged nodes had below is left out."""
    at, levels, size = np.zeros(len(y), np.int64), [], 1
    counts = np.bincount(y, w, classes)[None]
    for level in range(depth + 1):
        n = len(counts)
        feature, cut, gain, child = np.full(n, LEAF), np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.int64)
        live = np.flatnonzero(counts.max(axis=1) < counts.sum(axis=1)) if level < depth else np.zeros(0, int)
        place = np.full(n, -1)
        place[live] = np.arange(len(live))
        here = place[at]
        order = np.argsort(here, kind="stable")[np.count_nonzero(here < 0):]
        x, y, w, here = x[order], y[order], w[order], here[order]
        slots = rng.random((len(live), x.shape[1])).argsort(axis=1)[:, :subset]
        step = max(1, CELLS // (subset * bins * classes))
        for a in range(0, len(live), step):
            i, j = np.searchsorted(here, [a, a + step])
            some = live[a:a + step]
            slot, at_bin, won = best_splits(histogram(x[i:j], y[i:j], w[i:j], here[i:j] - a, slots[a:a + step], bins, classes))
            feature[some] = np.where(won > 0, slots[a + np.arange(len(some)), slot], LEAF)
            cut[some], gain[some] = at_bin, won
        split = np.flatnonzero(feature >= 0)
        child[split] = size + 2 * np.arange(len(split))
        levels.append((feature, cut, gain, child, counts))
        node = live[here]
        kept = feature[node] >= 0
        x, y, w, node = x[kept], y[kept], w[kept], node[kept]
        at = child[node] - size + (x[np.arange(len(y)), feature[node]] > cut[node])
        size += 2 * len(split)
        if not len(split):
            break
        counts = np.bincount(at * classes + y, w, 2 * len(split) * classes).reshape(-1, classes)
    tree = SimpleNamespace(**{k: np.concatenate(v) for k, v in zip(("feature", "cut", "gain", "child", "counts"), zip(*levels))})
    merge(tree)
    reached, front = np.zeros(len(tree.feature), bool), np.zeros(1, np.int64)
    while len(front):
        reached[front] = True
        front = tree.child[front[tree.feature[front] >= 0]]
        front = np.concatenate([front, front + 1])
    tree.child = np.where(tree.feature >= 0, (np.cumsum(reached) - 1)[tree.child], 0)
    return SimpleNamespace(**{k: v[reached] for k, v in vars(tree).items()})


def _blocks(frames: Iterator[pd.DataFrame], groups: int) -> Iterator[SimpleNamespace]:
    """The rows as arrays, in blocks of about ``BATCH``; bins as (row, group, feature)."""
    def block(held):
        pdf = pd.concat(held, ignore_index=True)
        x = np.frombuffer(b"".join(pdf["_x"]), np.uint8).reshape(len(pdf), groups, -1)
        return SimpleNamespace(x=x, y=pdf["_y"].to_numpy(np.int64), out=pdf["_out"].to_numpy(), by=pdf["_by"].to_numpy(),
                               row=pdf["_row"].to_numpy(np.int64), h=pdf["_h"].to_numpy(np.int64).view(np.uint64))

    held = []
    for pdf in frames:
        if len(pdf):
            held.append(pdf)
        if sum(map(len, held)) >= BATCH:
            yield block(held)
            held = []
    if held:
        yield block(held)


def _runs(node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that brings rows of a node together, the nodes, and where each begins and the last ends."""
    order = np.argsort(node, kind="stable")
    told, first = np.unique(node[order], return_index=True)
    return order, told, np.append(first, len(node))


def cut_points(rows: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Per feature at most 31 values, ascending; bin i holds values up to the i-th.

    The values are quantiles of all rows, or, where there are at most 32, all that occur; a cut is
    the middle between one and the next one that occurs."""
    d = len(features)
    asked = [i / BINS for i in range(1, BINS)]
    told = rows.agg(*[F.percentile_approx(f, asked, 2_000).alias(f"q{i}") for i, f in enumerate(features)],
                    *[F.approx_count_distinct(f).alias(f"n{i}") for i, f in enumerate(features)]).first()
    # the estimate is off by a few per cent; the values are counted where it is near
    few = [i for i in range(d) if told[f"n{i}"] <= 2 * BINS]
    values: dict[int, list[float]] = {i: [] for i in few}
    if few:
        items = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(features[i]).cast("double").alias("v")) for i in few])).alias("_e")
        for r in rows.select(items).select("_e.i", "_e.v").distinct().collect():
            values[r["i"]].append(r["v"])
    cuts = []
    for i in range(d):
        v = np.unique(np.array(values.get(i, []), float))
        cuts.append(v[:-1] if 0 < len(v) <= BINS else np.unique(np.array(told[f"q{i}"], float)))

    def lowest(frames):
        least = np.full((d, BINS), np.inf)
        for pdf in frames:
            for i, f in enumerate(features):
                v = pdf[f].to_numpy(float)
                np.minimum.at(least[i], np.searchsorted(cuts[i], v, side="left"), v)
        i, b = np.nonzero(np.isfinite(least))
        yield pd.DataFrame({"i": i, "b": b, "v": least[i, b]})

    # a cut is the middle between its value and the next one that occurs
    middles = [c.copy() for c in cuts]
    for r in rows.select(*features).mapInPandas(lowest, "i INT, b INT, v DOUBLE").groupBy("i", "b").agg(F.min("v").alias("v")).where("b > 0").collect():
        low = cuts[r["i"]][r["b"] - 1]
        if np.isfinite(low) and np.isfinite(r["v"]):
            middles[r["i"]][r["b"] - 1] = low + (r["v"] - low) / 2
    return middles


class Forest:
    """``groups`` forests of ``n_trees`` trees each; forest g learned from the rows whose ``_out`` is not g.

    ``upper`` holds the upper levels of every tree, ``subtrees`` is the written table of what grows below."""

    def __init__(self, features: list[str], cuts: list[list[np.ndarray]], n_trees: int, classes: int, upper: list, subtrees: DataFrame):
        self.features, self.cuts, self.n_trees, self.classes, self.upper, self.subtrees = features, cuts, n_trees, classes, upper, subtrees

    def importances(self) -> np.ndarray:
        """Mean over all trees of each tree's weighted gains by feature, which add up to 1 in a tree; then made to add up to 1."""
        d = len(self.features)
        deep = self.subtrees.where("alone IS NULL").groupBy("tree").agg(F.array(*[F.sum(F.col("gain")[i]) for i in range(d)]).alias("gain"))
        gains = np.zeros((len(self.upper), d))
        for r in deep.collect():
            gains[r["tree"]] += r["gain"]
        for t, tree in enumerate(self.upper):
            inner = tree.feature >= 0
            gains[t] += np.bincount(tree.feature[inner], tree.gain[inner], d)
        totals = gains.sum(axis=1, keepdims=True)
        mean = np.divide(gains, totals, out=np.zeros_like(gains), where=totals > 0).sum(axis=0)
        return mean / mean.sum() if mean.sum() > 0 else mean

    def predict(self, binned: DataFrame) -> DataFrame:
        """``(_row, _yhat)``: the class with most votes of the trees of forest ``_by``, the smallest one of equals."""
        upper, n_trees, classes, groups = self.upper, self.n_trees, self.classes, len(self.cuts)

        def ends(frames):
            for b in _blocks(frames, groups):
                for t, tree in enumerate(upper):
                    who = np.flatnonzero(b.by == t // n_trees)
                    if len(who):
                        x = b.x[who, t // n_trees]
                        yield b, t, tree, who, x, walk(tree, x)

        def scatter(frames):
            for b, t, tree, who, x, at in ends(frames):
                deep = tree.feature[at] == GROWN
                who, x, (order, nodes, first) = who[deep], x[deep], _runs(at[deep])
                rows, x = b.row[who[order]], x[order]
                yield pd.DataFrame({"tree": t, "node": nodes, "rows": [rows[i:j].tobytes() for i, j in zip(first, first[1:])],
                                    "x": [x[i:j].tobytes() for i, j in zip(first, first[1:])]})

        def above(frames):
            sums, block = None, None
            for b, t, tree, who, _, at in ends(frames):
                if b is not block:
                    if block is not None:
                        yield _told(block.row, sums)
                    block, sums = b, np.zeros((len(b.row), classes), np.int64)
                leaf = tree.feature[at] == LEAF
                sums[who[leaf]] += _shares(tree.counts)[at[leaf]]
            if block is not None:
                yield _told(block.row, sums)

        def below(rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
            if not len(rows) or not len(trees):
                return _told(np.zeros(0, np.int64), np.zeros((0, classes), np.int64))
            tree = SimpleNamespace(feature=np.frombuffer(trees["feature"][0], np.int16), cut=np.frombuffer(trees["cut"][0], np.uint8), child=np.frombuffer(trees["child"][0], np.int32))
            counts = np.frombuffer(trees["counts"][0], np.float32).reshape(-1, classes)
            row = np.frombuffer(b"".join(rows["rows"]), np.int64)
            x = np.frombuffer(b"".join(rows["x"]), np.uint8).reshape(len(row), -1)
            return _told(row, _shares(counts)[walk(tree, x)])

        schema = "_row LONG, cls INT, votes LONG"
        sent = binned.mapInPandas(scatter, "tree INT, node INT, rows BINARY, x BINARY").groupBy("tree", "node")
        votes = sent.cogroup(self.subtrees.where("alone IS NULL").select("tree", "node", "feature", "cut", "child", "counts").groupBy("tree", "node")).applyInPandas(below, schema)
        if any((t.feature == LEAF).any() for t in upper):
            votes = votes.unionByName(binned.mapInPandas(above, schema))
        sums = votes.repartition("_row").groupBy("_row", "cls").agg(F.sum("votes").alias("votes"))
        return sums.groupBy("_row").agg((-F.max(F.struct("votes", (-F.col("cls")).alias("c")))["c"]).alias("_yhat"))


def _shares(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=1, keepdims=True, dtype=float)
    return np.rint(np.divide(counts, total, out=np.zeros(counts.shape), where=total > 0) * PARTS).astype(np.int64)


def _told(row: np.ndarray, votes: np.ndarray) -> pd.DataFrame:
    i, c = np.nonzero(votes)
    return pd.DataFrame({"_row": row[i], "cls": c, "votes": votes[i, c]})


def _binned(rows: DataFrame, features: Sequence[str], cuts: list[list[np.ndarray]]) -> DataFrame:
    """The rows with ``_x``: for every group's cut points a byte a feature."""
    feats, kept = list(features), ["_row", "_y", "_out", "_by", "_h"]

    def put(frames):
        for pdf in frames:
            x = np.empty((len(pdf), len(cuts), len(feats)), np.uint8)
            for i, f in enumerate(feats):
                v = pdf[f].to_numpy(float)
                for g, of in enumerate(cuts):
                    x[:, g, i] = np.searchsorted(of[i], v, side="left")
            yield pdf[kept].assign(_x=[r.tobytes() for r in x])

    return rows.select(*kept, *feats).mapInPandas(put, "_row LONG, _y INT, _out INT, _by INT, _h LONG, _x BINARY")


def prepare(df: DataFrame, seed: int) -> DataFrame:
    """The rows written, each with a number (``_row``) and a hash to draw by (``_h``)."""
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.withColumn("_h", F.xxhash64("_row", F.lit(seed)))
    return materialize(rows.repartition(df.sparkSession.sparkContext.defaultParallelism), "forest_rows")


def fit(rows: DataFrame, features: Sequence[str], n_trees: int, seed: int, max_depth: int, groups: int = 1) -> tuple[Forest, DataFrame]:
    """The forests of all groups, and the binned rows to predict.

    ``rows`` (:func:`prepare`) have ``_y`` (a class from 0), ``_out`` (the group that does not
    learn from a row, or -1), ``_by`` (the group that predicts it) and the features, no value missing."""
    feats, spark = list(features), rows.sparkSession
    by_out = rows.groupBy("_out").agg(F.count(F.lit(1)).alias("n"), F.min("_y").alias("lo"), F.max("_y").alias("hi"),
                                      F.count_if(F.col("_y").isNull() | (F.col("_y") != F.floor("_y"))).alias("bad")).collect()
    n = [sum(r["n"] for r in by_out if r["_out"] != g) for g in range(groups)]
    if not by_out or min(n) == 0:
        raise ValueError("a forest needs rows to learn from")
    if any(r["bad"] or r["lo"] < 0 for r in by_out):
        raise ValueError("labels have to be whole numbers from 0")
    classes = int(max(r["hi"] for r in by_out)) + 1
    cuts = [cut_points(rows.where(F.col("_out") != g), feats) for g in range(groups)]
    binned = materialize(_binned(rows.withColumn("_y", F.col("_y").cast("int")), feats, cuts), "forest_bins")
    d, bins = len(feats), max(2, 1 + max(len(c) for of in cuts for c in of))
    subset = math.ceil(math.sqrt(d))

    # a tree's nodes while it grows: feature, cut, child, counts (of the root unknown at first), gain, depth
    upper = [SimpleNamespace(feature=[GROWN], cut=[0], child=[0], counts=[np.zeros(classes)], gain=[0.0], depth=[0],
                             open=[0] if n[t // n_trees] > DEEP and max_depth > 0 else []) for t in range(groups * n_trees)]

    def frozen(tree):
        return SimpleNamespace(feature=np.array(tree.feature), cut=np.array(tree.cut), child=np.array(tree.child))

    while any(tree.open for tree in upper):
        at_once, room = {}, CELLS * 4 // (subset * bins * classes) + 1
        for t, tree in enumerate(upper):
            if tree.open and room > 0:
                some = tree.open[:room]
                room -= len(some)
                slots = np.array([np.random.default_rng([seed, t, i]).permutation(d)[:subset] for i in some])
                at_once[t] = (frozen(tree), np.array(some), slots)
        for r in _counted(binned, at_once, n_trees, groups, bins, classes).collect():
            tree, i = upper[r["tree"]], r["node"]
            low, high = np.array(r["low"]), np.array(r["high"])
            tree.counts[i] = low + high
            tree.feature[i] = LEAF
            if r["gain"] > 0:
                tree.feature[i], tree.cut[i], tree.gain[i], tree.child[i] = r["feature"], r["cut"], r["gain"], len(tree.feature)
                for counts in (low, high):
                    new, done = len(tree.feature), counts.max() == counts.sum() or tree.depth[i] + 1 >= max_depth
                    tree.feature.append(LEAF if done else GROWN)
                    tree.counts.append(counts)
                    tree.cut.append(0)
                    tree.child.append(0)
                    tree.gain.append(0.0)
                    tree.depth.append(tree.depth[i] + 1)
                    if not done and counts.sum() > DEEP:
                        tree.open.append(new)
        for t, (_, some, _) in at_once.items():
            gone = set(some.tolist())
            upper[t].open = [i for i in upper[t].open if i not in gone]

    depths = [dict(enumerate(tree.depth)) for tree in upper]
    subtrees = materialize(_grown(binned, [frozen(tree) for tree in upper], depths, n_trees, groups, bins, classes, subset, seed, max_depth), "subtrees")
    # a subtree that is one leaf is a leaf of the upper levels, and may merge there
    for r in subtrees.where("alone IS NOT NULL").select("tree", "node", "alone").collect():
        upper[r["tree"]].feature[r["node"]], upper[r["tree"]].counts[r["node"]] = LEAF, np.array(r["alone"])
    done = []
    for tree in upper:
        whole = SimpleNamespace(**vars(frozen(tree)), counts=np.array(tree.counts), gain=np.array(tree.gain))
        merge(whole)
        done.append(whole)
    return Forest(feats, cuts, n_trees, classes, done, subtrees), binned


def _counted(binned: DataFrame, at_once: dict, n_trees: int, groups: int, bins: int, classes: int) -> DataFrame:
    """One pass of counts for the open nodes of all trees in ``at_once``, and the best split of each."""
    def count(frames):
        sums = {}
        for b in _blocks(frames, groups):
            for t, (tree, nodes, slots) in at_once.items():
                g = t // n_trees
                w = weights(b.h, t) * (b.out != g)
                used = np.flatnonzero(w)
                place = np.full(len(tree.feature), -1)
                place[nodes] = np.arange(len(nodes))
                here = place[walk(tree, b.x[used, g])]
                used, here = used[here >= 0], here[here >= 0]
                told = histogram(b.x[used, g], b.y[used], w[used], here, slots, bins, classes)
                sums[t] = sums[t] + told if t in sums else told
        for t, hist in sums.items():
            yield pd.DataFrame({"tree": t, "node": at_once[t][1], "hist": [h.tobytes() for h in hist]})

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        t, node = int(pdf["tree"][0]), int(pdf["node"][0])
        _, nodes, slots = at_once[t]
        of = slots[np.flatnonzero(nodes == node)[0]]
        hist = sum(np.frombuffer(h) for h in pdf["hist"]).reshape(1, len(of), bins, classes)
        slot, cut, gain = (v[0] for v in best_splits(hist))
        low, high = hist[0, slot, :cut + 1].sum(axis=0), hist[0, slot, cut + 1:].sum(axis=0)
        return pd.DataFrame({"tree": [t], "node": [node], "feature": [of[slot]], "cut": [cut], "gain": [gain], "low": [low], "high": [high]})

    return binned.mapInPandas(count, "tree INT, node INT, hist BINARY").groupBy("tree", "node").applyInPandas(choose, _SPLIT)


def _grown(binned: DataFrame, upper: list, depths: list, n_trees: int, groups: int, bins: int, classes: int,
           subset: int, seed: int, max_depth: int) -> DataFrame:
    """The subtrees below the upper levels, one task for the rows of one."""
    def scatter(frames):
        for b in _blocks(frames, groups):
            for t, tree in enumerate(upper):
                g = t // n_trees
                w = weights(b.h, t) * (b.out != g)
                used = np.flatnonzero(w)
                at = walk(tree, b.x[used, g])
                deep = tree.feature[at] == GROWN
                order, nodes, first = _runs(at[deep])
                used = used[deep][order]
                x, y, w = b.x[used, g], b.y[used].astype(np.int32), w[used].astype(np.uint8)
                cut = [*zip(first, first[1:])]
                yield pd.DataFrame({"tree": t, "node": nodes, "x": [x[i:j].tobytes() for i, j in cut], "y": [y[i:j].tobytes() for i, j in cut], "w": [w[i:j].tobytes() for i, j in cut]})

    def below(pdf: pd.DataFrame) -> pd.DataFrame:
        t, node = int(pdf["tree"][0]), int(pdf["node"][0])
        y = np.frombuffer(b"".join(pdf["y"]), np.int32).astype(np.int64)
        x = np.frombuffer(b"".join(pdf["x"]), np.uint8).reshape(len(y), -1)
        w = np.frombuffer(b"".join(pdf["w"]), np.uint8).astype(float)
        tree = grow(x, y, w, classes, bins, subset, max_depth - depths[t][node], np.random.default_rng([seed, t, node, 1]))
        inner = tree.feature >= 0
        gain = np.bincount(tree.feature[inner], tree.gain[inner], x.shape[1])
        return pd.DataFrame({"tree": [t], "node": [node], "feature": [tree.feature.astype(np.int16).tobytes()], "cut": [tree.cut.astype(np.uint8).tobytes()],
                             "child": [tree.child.astype(np.int32).tobytes()], "counts": [tree.counts.astype(np.float32).tobytes()],
                             "alone": [tree.counts[0] if len(tree.feature) == 1 else None], "gain": [gain]})

    return binned.mapInPandas(scatter, "tree INT, node INT, x BINARY, y BINARY, w BINARY").groupBy("tree", "node").applyInPandas(below, _SUBTREE)
