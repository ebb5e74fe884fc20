"""Aggregates on the wide table.

All of them are one-pass aggregates (partial + final) except the quantile
based ones (E7, E9), which go through the range-partitioned exact rank of
:mod:`paramo.operators.ranking`.  Per-feature statistics unpivot the
features into ``(feature, value)`` rows with one ``Expand`` so that a single
``groupBy(feature)`` computes all of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paramo.functions import ALTITUDE_BANDS_LONG, altitude_band, altitude_order, round_half_up
from paramo.operators.clean import find_column, resolve_features
from paramo.operators.ranking import exact_quantiles
from paramo.sources.normals import KEY


def _r(c: Column, digits: int | None) -> Column:
    return c if digits is None else round_half_up(c, digits)


def global_indicators(df: DataFrame) -> DataFrame:
    """count/mean/std/min/max of ANUAL and mean altitude, rounded to 2."""
    return df.select(
        F.count("ANUAL").alias("total_registros"),
        round_half_up(F.avg("ANUAL"), 2).alias("prom_anual"),
        round_half_up(F.stddev("ANUAL"), 2).alias("desv_anual"),
        round_half_up(F.min("ANUAL"), 2).alias("min_anual"),
        round_half_up(F.max("ANUAL"), 2).alias("max_anual"),
        round_half_up(F.avg("ALTITUD_m"), 2).alias("altitud_prom"),
    )


def altitude_zones(df: DataFrame) -> DataFrame:
    """Rows, mean rain (2) and mean altitude (0) per altitude zone, by order."""
    return (
        df.withColumn("zona", altitude_band("ALTITUD_m", ALTITUDE_BANDS_LONG))
        .withColumn("orden", altitude_order("ALTITUD_m"))
        .groupBy("zona", "orden")
        .agg(F.count(F.lit(1)).alias("registros"),
             round_half_up(F.avg("ANUAL"), 2).alias("prom_precip"),
             round_half_up(F.avg("ALTITUD_m"), 0).alias("altitud_media"))
        .orderBy("orden")
    )


def top_departments(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` places with the highest mean ANUAL (tie: name).

    Empty (same schema) when no column name contains DEPART.
    """
    col = find_column(df, "DEPART")
    schema = "departamento STRING, estaciones BIGINT, prom_precip DOUBLE, max_precip DOUBLE"
    if col is None:
        return df.sparkSession.createDataFrame([], schema)
    return (
        df.groupBy(F.col(col).cast("string").alias("departamento"))
        .agg(F.count(F.lit(1)).alias("estaciones"),
             round_half_up(F.avg("ANUAL"), 2).alias("prom_precip"),
             round_half_up(F.max("ANUAL"), 2).alias("max_precip"))
        .orderBy(F.col("prom_precip").desc_nulls_last(), "departamento")
        .limit(n)
    )


def department_stats(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Count, mean, sample std and max of ANUAL per place (unrounded by default)."""
    col = find_column(df, "DEPART")
    if col is None:
        return df.sparkSession.createDataFrame(
            [], "departamento STRING, n BIGINT, avg_anual DOUBLE, std_anual DOUBLE, max_anual DOUBLE")
    return df.groupBy(F.col(col).cast("string").alias("departamento")).agg(
        F.count(F.lit(1)).alias("n"),
        _r(F.avg("ANUAL"), digits).alias("avg_anual"),
        _r(F.stddev("ANUAL"), digits).alias("std_anual"),
        _r(F.max("ANUAL"), digits).alias("max_anual"),
    )


def band_stats(df: DataFrame, digits: int | None = None) -> DataFrame:
    """E5: rows, mean ANUAL and mean altitude per short altitude band."""
    return df.groupBy(altitude_band("ALTITUD_m").alias("piso")).agg(
        F.count(F.lit(1)).alias("n"),
        _r(F.avg("ANUAL"), digits).alias("avg_anual"),
        _r(F.avg("ALTITUD_m"), digits).alias("avg_altitud"),
    )


def annual_summary(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Count (non-NULL), mean, sample std, min and max of ANUAL."""
    return df.select(
        F.count("ANUAL").alias("n"),
        _r(F.avg("ANUAL"), digits).alias("avg_anual"),
        _r(F.stddev("ANUAL"), digits).alias("std_anual"),
        _r(F.min("ANUAL"), digits).alias("min_anual"),
        _r(F.max("ANUAL"), digits).alias("max_anual"),
    )


def long_features(df: DataFrame, features: Sequence[str] | None = None,
                  key: str = KEY, keep: Sequence[str] = ()) -> DataFrame:
    """``(key, *keep, feature, orden, value)`` rows, NULL/NaN values dropped."""
    feats = list(features) if features is not None else resolve_features(df)
    order = F.array_position(F.array(*[F.lit(f) for f in feats]), F.col("feature")).cast("int")
    return (
        df.select(key, *keep, *[F.col(f).cast("double").alias(f) for f in feats])
        .unpivot([key, *keep], feats, "feature", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .withColumn("orden", order)
    )


def _corrected_moments(n: Column, g1: Column, g2: Column, m2_zero: Column) -> tuple[Column, Column]:
    """Bias-corrected sample skewness G1 and excess kurtosis G2 from the
    population moments Spark computes (as pandas/DuckDB report them)."""
    nd = n.cast("double")
    skew = g1 * F.sqrt(nd * (nd - 1)) / F.nullif(nd - 2, F.lit(0.0))
    kurt = (nd - 1) / F.nullif((nd - 2) * (nd - 3), F.lit(0.0)) * ((nd + 1) * g2 + 6)
    skew = F.when(n < 3, F.lit(None)).when(m2_zero, F.lit(0.0)).otherwise(skew)
    kurt = F.when(n < 4, F.lit(None)).when(m2_zero, F.lit(0.0)).otherwise(kurt)
    return skew, kurt


def eda_stats(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Per feature count, mean, std, min, p25, median, p75, max (round 2),
    skewness and kurtosis (bias-corrected, round 3); NULLs dropped per feature."""
    long = long_features(df, features)
    moments = long.groupBy("feature", "orden").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("value").alias("mean"),
        F.stddev("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.skewness("value").alias("g1"),
        F.kurtosis("value").alias("g2"),
        (F.var_pop("value") == 0).alias("flat"),
    )
    q = (exact_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75])
         .groupBy("feature")
         .agg(F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("p25"),
              F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("median"),
              F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("p75")))
    skew, kurt = _corrected_moments(F.col("count"), F.col("g1"), F.col("g2"), F.col("flat"))
    return (
        moments.join(q, "feature")
        .select("feature", "orden", "count",
                *[round_half_up(c, 2).alias(c) for c in ("mean", "std", "min", "p25", "median", "p75", "max")],
                round_half_up(skew, 3).alias("skewness"),
                round_half_up(kurt, 3).alias("kurtosis"))
        .orderBy("orden")
    )


def correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(i, j, r)`` with i < j: Pearson correlation of each pair of features over the rows that have both; NULL without spread.

    A task adds its rows, block by block, to one triangle of pairwise counts,
    sums and products (matrix products over values and their presence) and
    emits that: a record per task and pair, whatever its rows.  Values are
    taken from the column's mean, so the sums stay small (a constant column's
    from its value, so they are zero)."""
    feats, d = list(features), len(features)
    plain = df.select(*[F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")).alias(f"x{i}") for i, f in enumerate(feats)])
    told = plain.agg(*[F.when(F.min(f"x{i}") == F.max(f"x{i}"), F.min(f"x{i}")).otherwise(F.avg(f"x{i}")).alias(f"m{i}") for i in range(d)]).first()
    centre = np.array([0.0 if m is None or not np.isfinite(m) else m for m in told])
    upper = np.triu_indices(d, 1)

    def triangle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, d, d))
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns]) - centre
            here = ~np.isnan(x)
            x[~here] = 0.0
            m = here.astype(float)
            # of pair (i, j): rows, sum of i, of j, of squares of i, of j, of products
            parts = m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x
            sums += np.stack([parts[0], parts[1], parts[1].T, parts[2], parts[2].T, parts[3]])
        cells = sums[:, upper[0], upper[1]]
        yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), *map(pa.array, cells)], ["i", "j", "n", "si", "sj", "qi", "qj", "p"])

    per_task = plain.mapInArrow(triangle, "i int, j int, n double, si double, sj double, qi double, qj double, p double")
    total = per_task.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "qi", "qj", "p")])
    n = F.nullif(F.col("n"), F.lit(0.0))
    spread = F.sqrt(F.greatest(F.col("qi") - F.col("si") ** 2 / n, F.lit(0.0))) * F.sqrt(F.greatest(F.col("qj") - F.col("sj") ** 2 / n, F.lit(0.0)))
    return total.select("i", "j", ((F.col("p") - F.col("si") * F.col("sj") / n) / F.nullif(spread, F.lit(0.0))).alias("r"))


def top_correlations(df: DataFrame, features: Sequence[str] | None = None,
                     min_abs: float = 0.3, n: int = 10) -> DataFrame:
    """Feature pairs (i < j) with |r| > ``min_abs`` on the unrounded Pearson
    r, by |rounded r| descending (ties: pair order), first ``n``; pairs of
    values of which either is missing do not count."""
    feats = list(features) if features is not None else resolve_features(df)
    names = F.array(*[F.lit(f) for f in feats])
    return (
        correlations(df, feats).where(F.abs("r") > min_abs)
        .select("i", "j", F.get(names, F.col("i")).alias("feat1"), F.get(names, F.col("j")).alias("feat2"), round_half_up("r", 3).alias("correlation"))
        .orderBy(F.abs("correlation").desc(), "i", "j")
        .limit(n)
        .drop("i", "j")
    )


def iqr_outliers(df: DataFrame, features: Sequence[str] | None = None, k: float = 1.5) -> DataFrame:
    """Per feature, values strictly outside [Q1 - k*IQR, Q3 + k*IQR].

    Returns ``feature, orden, n_outliers``; the report's total is their sum
    (a row may count once per feature).
    """
    long = long_features(df, features)
    q = (exact_quantiles(long, ["feature"], "value", [0.25, 0.75])
         .groupBy("feature")
         .agg(F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
              F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3")))
    iqr = F.col("q3") - F.col("q1")
    outside = (F.col("value") < F.col("q1") - k * iqr) | (F.col("value") > F.col("q3") + k * iqr)
    # One row of bounds per feature: bounded by the number of features.
    return (
        long.join(F.broadcast(q), "feature")
        .groupBy("feature", "orden")
        .agg(F.count_if(outside).alias("n_outliers"))
        .orderBy("orden")
    )


def iqr_outlier_total(df: DataFrame, features: Sequence[str] | None = None, k: float = 1.5) -> DataFrame:
    """E9 total: the summed outlier count over all features."""
    return iqr_outliers(df, features, k).agg(F.sum("n_outliers").cast("long").alias("n_outliers_iqr"))
