"""Exact ranks and quantiles without putting a whole group in one task.

``row_number() OVER (PARTITION BY g ORDER BY v)`` and the exact
``percentile`` aggregate both finish a group inside one task; with one group
holding a third of all rows that task holds a third of the data.  Here the
rows are range-partitioned on ``(g, v)`` instead, so a large group spans many
consecutive partitions of bounded size:

1. ``repartitionByRange`` + ``sortWithinPartitions``; each row gets its
   partition id and its position inside the partition; the result is
   written once to the shared checkpoint folder so positions are stable
   when an executor is lost and the plan re-runs;
2. a small table of (partition, group) -> first position, row count, and the
   running count of the group in earlier partitions (a window over at most
   #partitions rows per group);
3. rank = offset + position - first position.

Quantiles need no such order: see :func:`exact_quantiles`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paramo.plans.materialize import materialize


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def global_rank(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                rank_col: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based exact rank of each row within ``group_cols`` by ``order_cols``.

    Ties in ``order_cols`` get distinct consecutive ranks (as ``row_number``).
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    parts = _partitions(df, num_partitions)
    # a unique tiebreaker in the range key: many equal values (a hot value)
    # are split over partitions instead of landing in one
    keys = group_cols + order_cols + ["_tb"]
    s = (
        df.withColumn("_tb", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id()
                    - F.shiftleft(F.col("_pid").cast("long"), 33))
    )
    s = materialize(s, "ranked")
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = (
        s.groupBy("_pid", *group_cols)
        .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select("_pid", *group_cols, "_first", "_off")
    )
    return (
        s.join(stats, ["_pid", *group_cols])
        .withColumn(rank_col, F.col("_off") + F.col("_pos") - F.col("_first"))
        .drop("_pid", "_pos", "_first", "_off", "_tb")
    )


#: Cells of the sketch of one round, and its accuracy; rows inside a bracket from which on another round narrows it.
CELLS, ACCURACY, BOUND = 1024, 10_000, 10_000
_TARGET = "struct<rank: bigint, base: bigint, lo: double, hi: double, inside: bigint, value: double>"


def _between(v: Column, lo: Column, hi: Column) -> Column:
    """Strictly between; a null end is open."""
    return (lo.isNull() | (v > lo)) & (hi.isNull() | (v < hi))


def _with_state(rows: DataFrame, state: DataFrame, groups: Sequence[str]) -> DataFrame:
    here = state.toDF(*[f"_s{i}" if c in groups else c for i, c in enumerate(state.columns)])
    same = [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(state.columns) if c in groups]
    return rows.join(here, reduce(and_, same)).drop(*[f"_s{i}" for i, c in enumerate(state.columns) if c in groups])


def narrowed(rows: DataFrame, state: DataFrame, groups: Sequence[str], n_targets: int, first: bool) -> DataFrame:
    """The targets' brackets after one more round: a sketch of the rows inside proposes narrower ones, and a pass of counts tells where the wanted rank is.

    A heavy value at an end of the proposal is counted by itself, so the rows
    inside always become fewer; a proposal that misses the rank is no error,
    the rank is then sought beside it."""
    names = [f"t{i}" for i in range(n_targets)]
    v = F.col("_v")

    def sketch(t: str) -> Column:
        active = F.col(f"{t}.value").isNull() & (F.col(f"{t}.inside") > BOUND)
        return F.percentile_approx(F.when(active & _between(v, F.col(f"{t}.lo"), F.col(f"{t}.hi")), v), [i / CELLS for i in range(CELLS + 1)], ACCURACY)

    # in the first round all brackets of a group are the same: one sketch does
    seen = names[:1] if first else names
    told = _with_state(rows, state, groups).groupBy(*groups).agg(*[sketch(t).alias(f"k_{t}") for t in seen])
    told = _with_state(state, told, groups)

    def proposal(t: str) -> Column:
        cells, x = F.col(f"k_{seen[0] if first else t}"), F.col(f"{t}.rank") - F.col(f"{t}.base")
        cell = F.floor((x + 0.5) / F.col(f"{t}.inside") * CELLS).cast("int")
        return F.struct(F.when(cell >= 1, F.get(cells, cell - 1)).otherwise(F.col(f"{t}.lo")).alias("lo"),
                        F.when(cell + 2 <= CELLS, F.get(cells, cell + 2)).otherwise(F.col(f"{t}.hi")).alias("hi"))

    told = told.select(*groups, "_n", *names, *[F.when(F.col(f"k_{seen[0] if first else t}").isNotNull(), proposal(t)).alias(f"p_{t}") for t in names])

    def counts(t: str) -> list[Column]:
        lo, hi, plo, phi = F.col(f"{t}.lo"), F.col(f"{t}.hi"), F.col(f"p_{t}.lo"), F.col(f"p_{t}.hi")
        own, low_end = _between(v, lo, hi), ~plo.eqNullSafe(lo)
        return [F.count_if(own & low_end & (v < plo)).alias(f"below_{t}"), F.count_if(own & low_end & (v == plo)).alias(f"low_{t}"),
                F.count_if(own & _between(v, plo, phi)).alias(f"in_{t}"), F.count_if(own & (v == phi) & (~low_end | (v > plo))).alias(f"high_{t}")]

    counted = _with_state(rows, told, groups).groupBy(*groups).agg(*[c for t in names for c in counts(t)])
    after = _with_state(told, counted, groups)

    def moved(t: str) -> Column:
        rank, base, lo, hi, inside = (F.col(f"{t}.{f}") for f in ("rank", "base", "lo", "hi", "inside"))
        x, plo, phi = rank - base, F.col(f"p_{t}.lo"), F.col(f"p_{t}.hi")
        below, low, mid, high = (F.col(f"{c}_{t}") for c in ("below", "low", "in", "high"))

        def to(base, lo, hi, inside, value=F.lit(None)):
            return F.struct(rank.alias("rank"), base.alias("base"), lo.alias("lo"), hi.alias("hi"), inside.alias("inside"), value.cast("double").alias("value")).cast(_TARGET)

        found = (F.when(x < below, to(base, lo, plo, below)).when(x < below + low, to(base, plo, plo, F.lit(0), plo))
                 .when(x < below + low + mid, to(base + below + low, plo, phi, mid)).when(x < below + low + mid + high, to(base, phi, phi, F.lit(0), phi))
                 .otherwise(to(base + below + low + mid + high, phi, hi, inside - below - low - mid - high)))
        return F.when(F.col(f"p_{t}").isNull(), F.col(t)).otherwise(found)

    return after.select(*groups, "_n", *[moved(t).alias(t) for t in names])


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (the pandas/numpy default).

    NULL and NaN values are ignored.  Returns ``group_cols + [q, value]`` with
    one row per group and probability.  No group is sorted: a rank is sought
    in a bracket of values, at first a whole group, which rounds narrow
    (:func:`narrowed`) by a factor of some hundreds each until at most ``BOUND``
    rows are inside; the distinct values of those are counted and the rank
    found among them.  A round is two passes whose partial aggregates leave
    a row a group and task."""
    group_cols, probs = list(group_cols), [float(p) for p in probs]
    groups = [f"_g{i}" for i in range(len(group_cols))]
    v = F.col(value_col)
    rows = df.select(*[F.col(c).alias(g) for c, g in zip(group_cols, groups)], v.cast("double").alias("_v")).where(v.isNotNull() & ~F.isnan(v.cast("double")))
    n_targets = 2 * len(probs)

    def target(i: int) -> Column:
        floor = F.floor(F.lit(probs[i // 2]) * (F.col("_n") - 1))
        rank = F.least(floor + i % 2, F.col("_n") - 1)
        return F.struct(rank.alias("rank"), F.lit(0).alias("base"), F.lit(None).alias("lo"), F.lit(None).alias("hi"), F.col("_n").alias("inside"), F.lit(None).alias("value")).cast(_TARGET)

    state = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    state = materialize(state.select(*groups, "_n", *[target(i).alias(f"t{i}") for i in range(n_targets)]), "quantile_state")
    wide = " OR ".join(f"(t{i}.value IS NULL AND t{i}.inside > {BOUND})" for i in range(n_targets))
    first = True
    while not state.where(wide).isEmpty():
        state, first = materialize(narrowed(rows, state, groups, n_targets, first), "quantile_state"), False
    targets = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"t{i}").alias("t")) for i in range(n_targets)])
    open_ = F.filter(targets, lambda x: x["t"]["value"].isNull())
    inside = F.filter("_open", lambda x: _between(F.col("_v"), x["t"]["lo"], x["t"]["hi"]))
    near = _with_state(rows, state.select(*groups, open_.alias("_open")), groups).select(*groups, "_v", F.explode(inside).alias("_x"))
    counted = near.groupBy(*groups, F.col("_x.i").alias("i"), F.col("_x.t.base").alias("base"), F.col("_x.t.rank").alias("rank"), "_v").agg(F.count(F.lit(1)).alias("_c"))
    # BOUND values at most for each group and rank
    upto = F.sum("_c").over(Window.partitionBy(*groups, "i").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = counted.withColumn("_upto", F.col("base") + upto).where(F.col("_upto") > F.col("rank")).groupBy(*groups, "i").agg(F.min("_v").alias("_v"))
    settled = state.select(*groups, F.explode(F.filter(targets, lambda x: x["t"]["value"].isNotNull())).alias("_x")).select(*groups, F.col("_x.i").alias("i"), F.col("_x.t.value").alias("_v"))
    values = found.unionByName(settled).groupBy(*groups).agg(*[F.max(F.when(F.col("i") == i, F.col("_v"))).alias(f"v{i}") for i in range(n_targets)])
    both = _with_state(state.select(*groups, "_n"), values, groups)

    def value(k: int) -> Column:
        pos, low, high = F.lit(probs[k]) * (F.col("_n") - 1), F.col(f"v{2 * k}"), F.col(f"v{2 * k + 1}")
        frac, diff = pos - F.floor(pos), high - low
        # equal ends, infinite ones included, need no interpolation
        return F.when((frac == 0) | (low == high), low).when(frac >= 0.5, high - diff * (1 - frac)).otherwise(low + diff * frac)

    answers = F.explode(F.array(*[F.struct(F.lit(p).alias("q"), value(k).alias("value")) for k, p in enumerate(probs)]))
    return both.select(*[F.col(g).alias(c) for g, c in zip(groups, group_cols)], answers.alias("_a")).select(*group_cols, "_a.q", "_a.value")
