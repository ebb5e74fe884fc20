"""Operator 10, mixing sources to target weights.

Words are summed per source; the sources, ordered by code point with null
last, weigh 5, 2, 1, 5, 2, 1, ... and share the total.  A source's target
stops at ``most`` times its words and what it cannot take goes to the others
by weight, until none is above.  A document is then emitted floor(rate) times,
and once more with a probability equal to the fraction, drawn from a hash of
its key: reruns draw alike, whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paramo.llm.common import WORD_CLASS, numbered, pick, restored, store

SEED = "mix-1"


def words(text: Column) -> Column:
    """Number of runs without ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.0, most: int = 3) -> DataFrame:
    """``(source, source_size, target, rate)`` from ``(source, size)`` rows, one row a source.

    Ordered by ``most * size / weight`` the sources that hit their limit come
    first: source k does if that ratio is below the level
    ``(total - limits before k) / (weights from k on)``, and the level at the
    first one that does not is what all the others get for each unit of weight.
    The windows run over one row a source, not over documents."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name)
    ladder = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = total.withColumn("place", place).withColumn("weight", ladder).withColumn("limit", F.col("source_size") * most)
    by_ratio = W.orderBy(F.col("limit").cast("double") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, W.unboundedFollowing)
    all_rows = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    wanted = F.sum("source_size").over(all_rows).cast("double") * F.lit(float(share))
    level = (wanted - F.coalesce(F.sum("limit").over(before), F.lit(0)).cast("double")) / F.sum("weight").over(onward)
    laid = weighed.withColumn("level", level)
    free = F.when(F.col("limit").cast("double") / F.col("weight") >= F.col("level"), F.col("level"))
    # from the first free source on the levels only fall, so the largest is the one of the first
    laid = laid.withColumn("common", F.max(free).over(all_rows))
    target = F.least(F.col("limit").cast("double"), F.coalesce(F.col("weight") * F.col("common"), F.col("limit").cast("double")))
    return laid.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))


def copies(rate: Column, key: Column, text: Column, seed: str = SEED) -> Column:
    """floor(rate), and one more where the key's hash, as a number in [0, 1), is below the fraction.

    A row without a key draws from its text."""
    drawn = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.concat(F.lit("text:"), F.md5(text)), F.lit("none"))))
    u = F.conv(F.substring(drawn, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
    whole = F.floor(rate)
    return (whole + F.when(u < rate - whole, 1).otherwise(0)).cast("long")


def mix_plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
             weights: Sequence[int] = (5, 2, 1), share: float = 1.0, most: int = 3, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: key, size, source_size, target, copies, taken.

    Null text counts 0 words; null is a source of its own; a source without
    words takes none.  Repeated rows draw alike.  The texts are read once:
    sizes are written to the shared folder and everything after reads those."""
    rows = pick(docs, id=key, txt=text, source=source)
    sizes = store(rows.select("id", "source", words(F.col("txt")).alias("size"),
                              F.when(F.col("id").isNull(), F.md5("txt")).alias("txt")), "mix-sizes")
    goal = store(targets(sizes, weights, share, most).withColumnRenamed("source", "goal_source"), "mix-targets")
    joined = sizes.join(goal, F.col("source").eqNullSafe(F.col("goal_source")))
    counted = joined.withColumn("copies", copies(F.col("rate"), F.col("id"), F.col("txt"), seed))
    return counted.select(F.col("id").alias(key), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = (5, 2, 1), share: float = 1.0, most: int = 3, seed: str = SEED) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it, columns as they are.

    Repeated rows are taken equally often; rows without words as their source
    is, at no cost to its target; a source without words is not taken; an
    empty table stays empty.
    Only the table of sources (one row each) meets the documents; it is
    written first, so the planner broadcasts it if it is small and else
    shuffles, where AQE splits a hot source."""
    sizes = pick(docs, txt=text, source=source).select("source", words(F.col("txt")).alias("size"))
    goal = store(targets(sizes, weights, share, most).select(F.col("source").alias("goal_source"), "rate"), "mix-targets")
    rows, _ = numbered(docs, id=key, txt=text, source=source)
    joined = rows.join(goal, F.col("source").eqNullSafe(F.col("goal_source")))
    # copies() hashes the text itself here only where the key is null
    n = copies(F.col("rate"), F.col("id"), F.when(F.col("id").isNull(), F.md5("txt")), seed)
    return restored(joined.withColumn("copy", F.explode(F.array_repeat(F.lit(1), n.cast("int")))), docs)
