"""Clustering.

K-Means, its silhouette and cost are Spark ML (distributed).  Ward
agglomeration merges, round by round, all pairs of clusters that are nearest
to each other; clusters and merges stay DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paramo.functions import round_half_up
from paramo.operators.blocks import alone, close_pairs, compact_blocks, matrix, met
from paramo.operators.ranking import global_rank
from paramo.plans.materialize import materialize
from paramo.sources.normals import KEY


#: K-Means fits that run at a time.
FITS = 4


def kmeans_sweep(features: DataFrame, k_min: int = 2, k_max: int = 8, seed: int = 42,
                 max_iter: int = 100, vec: str = "features") -> tuple[DataFrame, dict]:
    """K1: per k, silhouette (squared Euclidean, round 4) and inertia (round 2).

    Returns the sweep table and the fitted models by k.  ``features`` should
    be persisted by the caller (it is scanned once per k).
    """
    ev = ClusteringEvaluator(featuresCol=vec, predictionCol="prediction",
                             metricName="silhouette", distanceMeasure="squaredEuclidean")

    def fitted(k: int):
        model = KMeans(featuresCol=vec, predictionCol="prediction", k=k, seed=seed,
                       initMode="k-means||", maxIter=max_iter).fit(features)
        return model, (k, float(ev.evaluate(model.transform(features))), float(model.summary.trainingCost))

    # fits are many short jobs, which do not depend on each other: some at a time
    with ThreadPoolExecutor(FITS) as pool:
        found = list(pool.map(inheritable_thread_target(features.sparkSession)(fitted), range(k_min, k_max + 1)))
    models, rows = {row[0]: model for model, row in found}, [row for _, row in found]
    sweep = features.sparkSession.createDataFrame(rows, "k INT, sil DOUBLE, cost DOUBLE").select(
        "k", round_half_up("sil", 4).alias("silhouette"), round_half_up("cost", 2).alias("inertia"))
    return sweep, models


def best_k(sweep: DataFrame) -> DataFrame:
    """K2: the k with the highest rounded silhouette (first k on a tie)."""
    return sweep.orderBy(F.col("silhouette").desc(), F.col("k")).limit(1)


def kmeans_assign(model, features: DataFrame, key: str = KEY, out: str = "cluster_kmeans") -> DataFrame:
    """K3: ``(key, label)`` from a fitted model; the key travels with the row."""
    return model.transform(features).select(key, F.col("prediction").cast("int").alias(out))


def cluster_stats(df: DataFrame, label: str) -> DataFrame:
    """K4: rows, mean/min/max ANUAL and mean altitude per cluster (round 2,
    NULL -> 0), ordered by cluster."""
    z = lambda c: F.coalesce(c, F.lit(0.0))
    return (df.groupBy(F.col(label).alias("cluster"))
            .agg(F.count(F.lit(1)).alias("registros"),
                 z(round_half_up(F.avg("ANUAL"), 2)).alias("promedio_mm"),
                 z(round_half_up(F.min("ANUAL"), 2)).alias("min_mm"),
                 z(round_half_up(F.max("ANUAL"), 2)).alias("max_mm"),
                 z(round_half_up(F.avg("ALTITUD_m"), 2)).alias("altitud_prom"))
            .orderBy("cluster"))


def silhouette_sq(df: DataFrame, label: str, vec: str = "x") -> DataFrame:
    """K5: squared-Euclidean silhouette (Spark's closed form over per-cluster
    n, sum of x and sum of |x|^2), rounded to 4.  ``vec`` may be an array or
    a vector column."""
    data = df.select(F.col(label).cast("double").alias("_lab"), F.col(vec).alias("_v"))
    if dict(data.dtypes)["_v"].startswith("array"):
        data = data.withColumn("_v", array_to_vector("_v"))
    ev = ClusteringEvaluator(featuresCol="_v", predictionCol="_lab", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    value = float(ev.evaluate(data))
    return df.sparkSession.createDataFrame([(value,)], "s DOUBLE").select(
        round_half_up("s", 4).alias("silhouette"))


# ------------------------------------------------------------------ Ward

#: Clusters from which on a single task finishes the merging, in some seconds (the result is the same either way).
TAIL = 32_768
#: Clusters from which on a single task makes what rounds are left.
ROUNDS_IN_A_TASK = 32_768
_CLUSTER = "cid long, n double, c array<double>, h double, born_round int, born_cid long"
_MERGE = "lo long, hi long, height double, size double, round int, lo_round int, lo_cid long, hi_round int, hi_cid long"


def _heights(ca: np.ndarray, na: np.ndarray, cb: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Ward heights of pairs of clusters, the same in either direction."""
    diff = ca - cb
    return np.sqrt(2.0 * (na * nb / (na + nb)) * np.einsum("...j,...j->...", diff, diff))


def _best_partner(ids, c, n, other_ids, oc, on, known=None):
    """For each cluster the other one with the smallest (height, lower id, higher id): arrays of partner id and height (inf: none).

    Only those up to the heights ``known`` are looked for; without, up to that
    of a partner which double precision products take for the nearest.
    Single precision products give candidates; direct differences decide."""
    partner, height = np.full(len(ids), -1, np.int64), np.full(len(ids), np.inf)
    known = np.full(len(ids), np.inf) if known is None else np.array(known)
    unknown, square = np.flatnonzero(np.isinf(known)), (oc * oc).sum(1)
    for s in range(0, len(unknown) if len(other_ids) else 0, 512):
        at = unknown[s:s + 512]
        a, na = c[at], n[at]
        d = ((a * a).sum(1)[:, None] + square[None, :] - 2.0 * (a @ oc.T)) / (1.0 / na[:, None] + 1.0 / on[None, :])
        d[ids[at, None] == other_ids[None, :]] = np.inf
        j = d.argmin(axis=1)
        found = d[np.arange(len(at)), j] < np.inf
        known[at[found]] = _heights(a[found], na[found], oc[j[found]], on[j[found]])
    rows = np.flatnonzero(np.isfinite(known))
    if not len(rows) or not len(other_ids):
        return partner, height
    half = known[rows] ** 2 / 2.0
    i, j = close_pairs(c[rows], oc, half / n[rows], half, 1.0 / on)
    i = rows[i]
    keep = ids[i] != other_ids[j]
    i, j = i[keep], j[keep]
    h = _heights(c[i], n[i], oc[j], on[j])
    keep = h <= known[i]
    i, j, h = i[keep], j[keep], h[keep]
    lo, hi = np.minimum(ids[i], other_ids[j]), np.maximum(ids[i], other_ids[j])
    order = np.lexsort((hi, lo, h, i))
    first = order[np.unique(i[order], return_index=True)[1]]
    partner[i[first]], height[i[first]] = other_ids[j[first]], h[first]
    return partner, height


def _finish(pdf: pd.DataFrame, start: int) -> pd.DataFrame:
    """All merges of the given clusters, by nearest-neighbour chains; numbered on from round ``start``.

    Distances of one cluster to all come from a matrix product; those that
    rounding leaves in doubt are decided by direct differences.  Merged
    clusters are left out of the arrays once they are half of them."""
    ids, n, h = pdf["cid"].to_numpy().copy(), pdf["n"].to_numpy(float).copy(), pdf["h"].to_numpy(float).copy()
    c = np.stack(pdf["c"].to_numpy()).astype(float)
    square = (c * c).sum(1)
    born = list(zip(pdf["born_round"].tolist(), pdf["born_cid"].tolist()))
    alive, chain, out, left = np.ones(len(ids), bool), [], [], len(ids)
    while left > 1:
        if 2 * left < len(ids):
            keep = np.flatnonzero(alive)
            place = {int(k): i for i, k in enumerate(keep)}
            ids, n, h, c, square, born, chain = ids[keep], n[keep], h[keep], c[keep], square[keep], [born[k] for k in keep], [place[x] for x in chain]
            alive = np.ones(left, bool)
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        a = chain[-1]
        near = square + square[a] - 2.0 * (c @ c[a])
        slack = 1e-9 * (square + square[a] + 1.0)
        coef = 2.0 * n * n[a] / (n + n[a])
        low, high = coef * (near - slack), coef * (near + slack)
        low[~alive] = high[~alive] = np.inf
        low[a] = high[a] = np.inf
        some = np.flatnonzero(low <= high.min())
        d = _heights(c[some], n[some], c[a], n[a])
        best = np.lexsort((ids[some], d))[0]
        b, dist = int(some[best]), d[best]
        if len(chain) > 1 and (back := _heights(c[chain[-2]], n[chain[-2]], c[a], n[a])) <= dist:
            b, dist = chain[-2], back
            chain = chain[:-2]
            lo, hi = (a, b) if ids[a] < ids[b] else (b, a)
            top = max(dist, h[lo], h[hi])
            out.append((ids[lo], ids[hi], top, n[lo] + n[hi], start + len(out), *born[lo], *born[hi]))
            c[lo] = (n[lo] * c[lo] + n[hi] * c[hi]) / (n[lo] + n[hi])
            square[lo] = c[lo] @ c[lo]
            n[lo] += n[hi]
            h[lo], alive[hi] = top, False
            born[lo] = (out[-1][4], int(ids[lo]))
            left -= 1
        else:
            chain.append(b)
    return pd.DataFrame(out, columns=["lo", "hi", "height", "size", "round", "lo_round", "lo_cid", "hi_round", "hi_cid"])


def _nearer(me: np.ndarray, to: np.ndarray, h: np.ndarray, was: np.ndarray, old: np.ndarray) -> np.ndarray:
    """Where the pair ``(me, to)`` of height ``h`` comes before ``(me, was)`` of height ``old``, by (height, lower id, higher id); -1 is no pair."""
    rank = [np.where(t >= 0, f(t, me), np.iinfo(np.int64).max) for t in (to, was) for f in (np.minimum, np.maximum)]
    return (to >= 0) & ((h < old) | ((h == old) & ((rank[0] < rank[2]) | ((rank[0] == rank[2]) & (rank[1] < rank[3])))))


def _in_rounds(pdf: pd.DataFrame, start: int, tail: int, block_size: int) -> tuple[pd.DataFrame, pd.DataFrame, int]:
    """The rounds of :func:`ward_merges` over clusters that one task holds, down to ``tail``: the merges, the clusters that are left, the next round.

    ``to`` and ``best``, the nearest cluster and its height, are kept between rounds (-1 and inf where a cluster is to look again)."""
    ids, n, h, c = pdf["cid"].to_numpy().copy(), pdf["n"].to_numpy(float).copy(), pdf["h"].to_numpy(float).copy(), np.stack(pdf["c"].to_numpy()).astype(float)
    born_round, born_cid = pdf["born_round"].to_numpy().copy(), pdf["born_cid"].to_numpy().copy()
    to, best = pdf["to"].to_numpy().copy(), pdf["best"].to_numpy(float).copy()
    out, rounds = [], start
    while len(ids) > max(tail, 1):
        at = np.flatnonzero(to < 0)
        partner, height = np.full(len(at), -1, np.int64), np.full(len(at), np.inf)
        for s in range(0, len(ids), block_size):
            t, d = _best_partner(ids[at], c[at], n[at], ids[s:s + block_size], c[s:s + block_size], n[s:s + block_size], height)
            some = _nearer(ids[at], t, d, partner, height)
            partner[some], height[some] = t[some], d[some]
        to[at], best[at] = partner, height
        # the lowest pair that a cluster is offered by those that looked
        there = np.searchsorted(ids, partner)
        order = np.lexsort((np.maximum(ids[at], partner), np.minimum(ids[at], partner), height, there))
        first = order[np.unique(there[order], return_index=True)[1]]
        some = first[_nearer(partner[first], ids[at][first], height[first], to[there[first]], best[there[first]])]
        to[there[some]], best[there[some]] = ids[at][some], height[some]
        # pairs that both their clusters chose
        mate = np.searchsorted(ids, to)
        lo = np.flatnonzero((to[mate] == ids) & (ids < to))
        hi = mate[lo]
        top, size = np.maximum(best[lo], np.maximum(h[lo], h[hi])), n[lo] + n[hi]
        out.append(pd.DataFrame({"lo": ids[lo], "hi": ids[hi], "height": top, "size": size, "round": rounds,
                                 "lo_round": born_round[lo], "lo_cid": born_cid[lo], "hi_round": born_round[hi], "hi_cid": born_cid[hi]}))
        gone = np.zeros(len(ids), bool)
        gone[lo] = gone[hi] = True
        lost = gone | gone[mate]
        to[lost], best[lost] = -1, np.inf
        c[lo] = (n[lo, None] * c[lo] + n[hi, None] * c[hi]) / size[:, None]
        n[lo], h[lo], born_round[lo], born_cid[lo] = size, top, rounds, ids[lo]
        keep = np.ones(len(ids), bool)
        keep[hi] = False
        ids, n, h, c, born_round, born_cid, to, best = (v[keep] for v in (ids, n, h, c, born_round, born_cid, to, best))
        rounds += 1
    merges = pd.concat(out) if out else pd.DataFrame(columns=["lo", "hi", "height", "size", "round", "lo_round", "lo_cid", "hi_round", "hi_cid"])
    return merges, pd.DataFrame({"cid": ids, "n": n, "h": h, "c": list(c), "born_round": born_round, "born_cid": born_cid}), rounds


def _ended(pdf: pd.DataFrame, start: int, tail: int, block_size: int) -> pd.DataFrame:
    """All merges that are left: in rounds down to ``tail`` clusters, then by chains."""
    pdf = pdf.sort_values("cid").reset_index(drop=True)
    if len(pdf) <= max(tail, 1):
        return _finish(pdf, start)
    made, rest, start = _in_rounds(pdf, start, tail, block_size)
    return pd.concat([made, _finish(rest, start)]) if len(rest) > 1 else made


def _nearest_clusters(clusters: DataFrame, least: float, block_size: int) -> DataFrame:
    """``(cid, height, lo, hi)`` for every cluster of ``clusters(cid, n, c, stale)`` that is stale: the smallest such pair it is part of.

    In compact blocks: the nearest one of the own block first; then a block
    is visited only if a cluster of the ``least`` size at the edge of its box
    would be near enough.  Ward's height of a pair is its distance times a
    factor that grows with either size, so that bounds the distance."""
    blocks = compact_blocks(clusters, "cid", "c", block_size, carry=("n", "stale"))
    dims = blocks.dims

    def numbers(record, name):
        return np.frombuffer(record[name], np.float64)

    def own(record):
        rows = np.flatnonzero(numbers(record, "stale"))
        x, ids, n = matrix(record["xs"], dims), np.frombuffer(record["keys"], np.int64), numbers(record, "n")
        to, h = _best_partner(ids[rows], x[rows], n[rows], ids, x, n)
        return [[record["blk"]], [record["keys"]], [record["xs"]], [record["n"]], [rows.tobytes()], [to.tobytes()], [h.tobytes()]]

    near = materialize(alone(blocks.df, own, "blk long, keys binary, xs binary, n binary, rows binary, to binary, height binary"), "ward_own")

    def asks(record):
        rows, n = np.frombuffer(record["rows"], np.int64), numbers(record, "n")
        known, own_n = numbers(record, "height"), n[rows]
        return rows, known / np.sqrt(2.0 * own_n * least / (own_n + least)), np.stack([own_n, known], axis=1)

    def search(visit, record):
        rows, state = visit["rows"], visit["state"]
        n, known = visit["extra"][:, 0], visit["extra"][:, 1]
        if "height" in state:
            known = np.minimum(known, state["height"][rows])
        else:
            state["height"], state["to"] = np.full(len(visit["reach"]), np.inf), np.full(len(visit["reach"]), -1, np.int64)
        ids = np.frombuffer(record["keys"], np.int64)
        to, h = _best_partner(visit["keys"], visit["xs"], n, ids, matrix(record["xs"], dims), numbers(record, "n"), known)
        better = _nearer(visit["keys"], to, h, state["to"][rows], state["height"][rows])
        state["height"][rows[better]], state["to"][rows[better]] = h[better], to[better]
        visit["reach"][rows[better]] = np.minimum(visit["reach"][rows[better]], h[better] / np.sqrt(2.0 * n[better] * least / (n[better] + least)))

    def best(record, state):
        some = np.flatnonzero(state["to"] >= 0) if state else []
        return [np.frombuffer(record["keys"], np.int64)[record["asked"]][some], state["to"][some], state["height"][some]] if len(some) else None

    def told(record):
        to = np.frombuffer(record["to"], np.int64)
        some = to >= 0
        return [np.frombuffer(record["keys"], np.int64)[np.frombuffer(record["rows"], np.int64)][some], to[some], numbers(record, "height")[some]]

    schema = "cid long, to long, height double"
    found = alone(near.select("keys", "rows", "to", "height"), told, schema).unionByName(met(near, blocks, blocks.df, asks, search, schema, done=best))
    order = F.struct("height", F.least("cid", "to").alias("lo"), F.greatest("cid", "to").alias("hi"))
    return found.groupBy("cid").agg(F.min(order).alias("found"))


def ward_leaves(points: DataFrame, features: Sequence[str], key: str = KEY) -> DataFrame:
    """``(key, c, cid)``: the rows as leaves, numbered 0.. by key."""
    rows = points.select(key, F.array(*[F.col(f).cast("double") for f in features]).alias("c")).withColumn("_g", F.lit(0))
    return materialize(global_rank(rows, ["_g"], [key], "cid").drop("_g"), "ward_leaves")


def ward_merges(leaves: DataFrame, tail: int = TAIL, block_size: int = 2000) -> DataFrame:
    """The exact Ward merges of all leaves, one row each, in rounds.

    Every cluster keeps its nearest one.  In a round all pairs that are
    nearest to each other merge; Ward's distance never shrinks by a merge, so
    this gives the tree that merging one pair at a time gives, and a cluster
    whose nearest one did not merge keeps it.  Only new clusters and those
    whose nearest one merged look again, in compact blocks of which they skip
    what is too far (:func:`_nearest_clusters`); of equally near ones the pair
    with the lowest numbers is taken, which a new cluster offers to the one it
    found.  Rows with equal features are merged first, without looking at
    pairs.  When at most ``ROUNDS_IN_A_TASK`` clusters are left, one task makes
    the same rounds over those (:func:`_in_rounds`), and when at most ``tail``
    are left, one task merges them by chains."""
    first = leaves.groupBy("c").agg(F.min("cid").alias("lo"), F.count(F.lit(1)).alias("n"))
    clusters = materialize(first.select(F.col("lo").alias("cid"), F.col("n").cast("double").alias("n"), "c", F.lit(0.0).alias("h"),
                                        F.when(F.col("n") > 1, F.col("n") - 1).otherwise(-1).cast("int").alias("born_round"), F.col("lo").alias("born_cid")), "ward_clusters")
    told = clusters.agg(F.count(F.lit(1)).alias("left"), F.max("n").alias("most")).first()
    left, rounds, merges = told["left"], int(told["most"] or 1), []
    if rounds > 1:
        # equal rows: the lowest leaf takes the others in turn, at height 0
        copies = global_rank(leaves.select("c", "cid"), ["c"], ["cid"], "at")
        zero = copies.where("at > 0").join(first, "c").select(
            "lo", F.col("cid").alias("hi"), F.lit(0.0).alias("height"), (F.col("at") + 1).cast("double").alias("size"), F.col("at").cast("int").alias("round"),
            F.when(F.col("at") > 1, F.col("at") - 1).otherwise(-1).cast("int").alias("lo_round"), F.col("lo").alias("lo_cid"), F.lit(-1).alias("hi_round"), F.col("cid").alias("hi_cid"))
        merges.append(materialize(zero, "ward_merges"))
    kept = "struct<height: double, lo: bigint, hi: bigint>"
    plain = clusters.columns
    clusters = clusters.withColumns({"best": F.lit(None).cast(kept), "stale": F.lit(1.0)})
    while left > max(tail, ROUNDS_IN_A_TASK, 1):
        least = float(clusters.agg(F.min("n")).first()[0])
        found = materialize(_nearest_clusters(clusters.select("cid", "n", "c", "stale"), least, block_size), "ward_nearest")
        partner = F.when(F.col("found.lo") == F.col("cid"), F.col("found.hi")).otherwise(F.col("found.lo"))
        offers = found.groupBy(partner.alias("cid")).agg(F.min("found").alias("offer"))
        now = clusters.join(found, "cid", "left").join(offers, "cid", "left")
        now = materialize(now.withColumn("best", F.least(F.when(F.col("stale") > 0, F.col("found")).otherwise(F.col("best")), F.col("offer"))).drop("found", "offer"), "ward_kept")
        # a pair that both its clusters chose
        pairs = now.groupBy("best.lo", "best.hi").agg(F.count(F.lit(1)).alias("votes"), F.first("best.height").alias("d")).where("votes = 2").drop("votes")
        low, high = (now.select(*plain).toDF(*[f"{side}_{c}" for c in plain]) for side in ("l", "r"))
        merged = (pairs.join(low, pairs["lo"] == low["l_cid"]).join(high, pairs["hi"] == high["r_cid"])
                  .withColumns({"height": F.greatest("d", "l_h", "r_h"), "size": F.col("l_n") + F.col("r_n"), "round": F.lit(rounds)}))
        merged = materialize(merged, "ward_round")
        merges.append(merged.select("lo", "hi", "height", "size", "round", F.col("l_born_round").alias("lo_round"), F.col("l_born_cid").alias("lo_cid"),
                                    F.col("r_born_round").alias("hi_round"), F.col("r_born_cid").alias("hi_cid")))
        mean = F.zip_with(F.col("l_c"), F.col("r_c"), lambda x, y: (F.col("l_n") * x + F.col("r_n") * y) / (F.col("l_n") + F.col("r_n")))
        new = merged.select(F.col("lo").alias("cid"), F.col("size").alias("n"), mean.alias("c"), F.col("height").alias("h"), F.col("round").alias("born_round"), F.col("lo").alias("born_cid"),
                            F.lit(None).cast(kept).alias("best"), F.lit(1.0).alias("stale"))
        gone = merged.select(F.explode(F.array("lo", "hi")).alias("cid"))
        rest = now.join(gone, "cid", "left_anti").withColumn("to", F.when(F.col("best.lo") == F.col("cid"), F.col("best.hi")).otherwise(F.col("best.lo")))
        rest = rest.join(gone.select(F.col("cid").alias("to"), F.lit(1.0).alias("lost")), "to", "left")
        rest = rest.select(*plain, F.when(F.col("lost").isNull(), F.col("best")).alias("best"), F.coalesce("lost", F.lit(0.0)).alias("stale"))
        clusters = materialize(rest.unionByName(new), "ward_clusters")
        left, rounds = clusters.count(), rounds + 1
    if left > 1:
        # at most ``tail`` or ``ROUNDS_IN_A_TASK`` clusters: bounded whatever the rows
        kept_to = F.when(F.col("stale") == 0, F.when(F.col("best.lo") == F.col("cid"), F.col("best.hi")).otherwise(F.col("best.lo")))
        rest = clusters.select(*plain, F.coalesce(kept_to, F.lit(-1)).cast("long").alias("to"), F.coalesce(F.when(F.col("stale") == 0, F.col("best.height")), F.lit(float("inf"))).alias("best"))
        rest = rest.withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(lambda pdf: _ended(pdf, rounds, tail, block_size), _MERGE)
        merges.append(materialize(rest, "ward_merges"))
    out = leaves.sparkSession.createDataFrame([], _MERGE)
    for more in merges:
        out = out.unionByName(more)
    return out


def ward(points: DataFrame, features: Sequence[str], k: int, key: str = KEY, tail: int = TAIL,
         block_size: int = 2000) -> tuple[DataFrame, DataFrame]:
    """K11 + K12: Ward labels ``(key, cluster_jerarquico)`` at ``k`` clusters and the
    merge table ``(step, left, right, height, size)`` of all rows.

    Leaves are numbered 0.. by key, the cluster made in step s is n + s - 1;
    steps go by height.  Labels are numbered by each cluster's lowest leaf."""
    leaves = ward_leaves(points, features, key)
    merges = materialize(global_rank(ward_merges(leaves, tail, block_size).withColumn("_g", F.lit(0)), ["_g"], ["height", "round", "lo"], "at").drop("_g"), "ward_tree")
    n = leaves.count()
    made = merges.select(F.col("round").alias("r"), F.col("lo").alias("c"), (F.col("at") + n).alias("node"))
    named = (merges.join(made.toDF("lo_round", "lo_cid", "lo_node"), ["lo_round", "lo_cid"], "left")
             .join(made.toDF("hi_round", "hi_cid", "hi_node"), ["hi_round", "hi_cid"], "left")
             .withColumns({"lo_node": F.coalesce("lo_node", "lo_cid"), "hi_node": F.coalesce("hi_node", "hi_cid")}))
    table = named.select((F.col("at") + 1).cast("int").alias("step"), F.least("lo_node", "hi_node").alias("left"), F.greatest("lo_node", "hi_node").alias("right"),
                         "height", F.col("size").cast("long").alias("size"))
    # every merge but the last k - 1 points its higher leaf at its lower one: jump, twice between writes, until nothing moves
    up = merges.where(F.col("at") < n - k).select(F.col("hi").alias("leaf"), F.col("lo").alias("to"))
    while True:
        once = _jumped(up)
        twice = materialize(_jumped(once.select("leaf", "to")), "ward_up")
        up = twice.select("leaf", "to")
        if twice.where("moved").isEmpty():
            break
    rooted = materialize(leaves.select(key, F.col("cid").alias("leaf")).join(up, "leaf", "left").select(key, F.coalesce("to", "leaf").alias("root")), "ward_roots")
    # k roots
    numbers = rooted.select("root").distinct().withColumn("cluster_jerarquico", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("root")) - 1)
    labels = rooted.join(numbers, "root").select(key, F.col("cluster_jerarquico").cast("int").alias("cluster_jerarquico"))
    return labels, table


def _jumped(up: DataFrame) -> DataFrame:
    """Pointers ``(leaf, to)`` followed once more, and whether that moved them."""
    onward = up.select(F.col("leaf").alias("to"), F.col("to").alias("end"))
    return up.join(onward, "to", "left").select("leaf", F.coalesce("end", "to").alias("to"), F.col("end").isNotNull().alias("moved"))


def ward_summary(labels: DataFrame, k: int, silhouette: DataFrame, n_linked: int) -> DataFrame:
    """K, linkage, silhouette (round 4) and the number of linked units."""
    return silhouette.select(F.lit(int(k)).alias("n_clusters"), F.lit("ward").alias("linkage"),
                             round_half_up("silhouette", 4).alias("silhouette"),
                             F.lit(int(n_linked)).alias("n_muestra"))


def label_counts(labels: DataFrame, label: str) -> DataFrame:
    """Rows per label (``Cluster i``)."""
    return (labels.groupBy(label).agg(F.count(F.lit(1)).alias("registros"))
            .select(F.concat(F.lit("Cluster "), F.col(label).cast("string")).alias("etiqueta"),
                    F.col(label).alias("cluster"), "registros").orderBy("cluster"))


def compare_clusterings(spark, rows: Sequence[tuple]) -> DataFrame:
    """One row per method that ran: ``(metodo, tipo, silhouette_sq,
    silhouette_euclid, clusters, ventaja)``; both silhouette kinds are reported
    because the methods are scored on different distances."""
    return spark.createDataFrame(
        list(rows), "metodo STRING, tipo STRING, silhouette_sq DOUBLE, silhouette_euclid DOUBLE, "
                    "clusters INT, ventaja STRING")
