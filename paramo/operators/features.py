"""Feature engineering (F1-F6): assembly, scaling and PCA.

Only model parameters reach the driver: per-feature means and deviations
(2 x d numbers), the d x d principal axes and their variances.  Applying them
is column arithmetic with literals, so it stays in generated code.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paramo.functions import round_half_up
from paramo.operators.clean import resolve_features
from paramo.sources.normals import KEY


def assemble(df: DataFrame, features: Sequence[str] | None = None, out: str = "features_raw") -> DataFrame:
    """dense vector of the features; rows with a NULL/NaN feature are skipped."""
    feats = list(features) if features is not None else resolve_features(df)
    return VectorAssembler(inputCols=feats, outputCol=out, handleInvalid="skip").transform(df)


def standardize_sample(df: DataFrame, features: Sequence[str] | None = None,
                       out: str = "features") -> DataFrame:
    """vector column centred and divided by the sample (n-1) deviation."""
    asm = assemble(df, features)
    model = StandardScaler(inputCol="features_raw", outputCol=out, withMean=True, withStd=True).fit(asm)
    return model.transform(asm)


def scaling_params(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per feature (zero deviation -> 1)."""
    row = df.select(*[F.avg(f).alias(f"m_{i}") for i, f in enumerate(features)],
                    *[F.stddev_pop(f).alias(f"s_{i}") for i, f in enumerate(features)]).first()
    out = {}
    for i, f in enumerate(features):
        s = row[f"s_{i}"]
        out[f] = (float(row[f"m_{i}"]), float(s) if s not in (None, 0.0) else 1.0)
    return out


def standardize_population(df: DataFrame, features: Sequence[str] | None = None,
                           keep: Sequence[str] = (KEY,), array_col: str | None = "x") -> DataFrame:
    """``(x - mean) / std_pop`` per feature (zero variance divides by 1).

    Returns ``keep`` columns, the scaled features under their own names and,
    unless ``array_col`` is None, the same values as one ``ARRAY<DOUBLE>``.
    Rows with a missing feature are dropped (as the assembler does).
    """
    feats = list(features) if features is not None else resolve_features(df)
    cond = F.lit(True)
    for f in feats:
        cond = cond & F.col(f).isNotNull() & ~F.isnan(f)
    base = df.where(cond)
    params = scaling_params(base, feats)
    cols = [((F.col(f) - F.lit(params[f][0])) / F.lit(params[f][1])).alias(f) for f in feats]
    out = base.select(*keep, *cols)
    if array_col:
        out = out.withColumn(array_col, F.array(*[F.col(f) for f in feats]))
    return out


def _sign_fixed(pc: np.ndarray) -> np.ndarray:
    """Flip each axis so its largest-magnitude loading is positive."""
    idx = np.argmax(np.abs(pc), axis=0)
    signs = np.sign(pc[idx, np.arange(pc.shape[1])])
    signs[signs == 0] = 1.0
    return pc * signs


class PcaModel:
    """Principal axes (d x k, sign-fixed) and explained-variance ratios."""

    def __init__(self, features: list[str], axes: np.ndarray, ratios: np.ndarray):
        self.features = features
        self.axes = axes
        self.ratios = ratios

    def project(self, df: DataFrame, prefix: str = "PC") -> list[Column]:
        return [sum((F.col(f) * float(self.axes[i, j]) for i, f in enumerate(self.features)), F.lit(0.0))
                .alias(f"{prefix}{j + 1}") for j in range(self.axes.shape[1])]


def fit_pca(scaled: DataFrame, features: Sequence[str], k: int | None = None) -> PcaModel:
    """Spark ML PCA (distributed Gramian) on already-scaled feature columns
    (the output of :func:`standardize_population`; raw columns would weight
    features by their units)."""
    feats = list(features)
    k = k or min(len(feats), 8)
    vec = VectorAssembler(inputCols=feats, outputCol="_v", handleInvalid="skip").transform(scaled)
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(vec.select("_v"))
    axes = _sign_fixed(model.pc.toArray())
    return PcaModel(feats, axes, np.array(model.explainedVariance.toArray()))


def pca_variance(scaled: DataFrame, features: Sequence[str], k: int | None = None) -> DataFrame:
    """component, explained ratio and cumulative ratio (round 4), and the
    flag of the first component reaching 80 % (``componentes_80pct``)."""
    model = fit_pca(scaled, features, k)
    cum = np.cumsum(model.ratios)
    n80 = next((i + 1 for i, v in enumerate(cum) if v >= 0.80), len(cum))
    rows = [(f"PC{i + 1}", i + 1, float(model.ratios[i]), float(cum[i]), i + 1 == n80)
            for i in range(len(cum))]
    df = scaled.sparkSession.createDataFrame(
        rows, "componente STRING, orden INT, ratio DOUBLE, acumulada DOUBLE, alcanza_80 BOOLEAN")
    return df.select("componente", "orden", round_half_up("ratio", 4).alias("varianza_explicada"),
                     round_half_up("acumulada", 4).alias("varianza_acumulada"), "alcanza_80")


def pca_project(scaled: DataFrame, features: Sequence[str], k: int | None = None,
                key: str = KEY) -> DataFrame:
    """PC1..PCk coordinates (k = min(3, d)) of population-scaled rows."""
    feats = list(features)
    model = fit_pca(scaled, feats, k or min(3, len(feats)))
    return scaled.select(key, *model.project(scaled))


def pca_loadings(scaled: DataFrame, features: Sequence[str], k: int | None = None,
                 top: int = 5) -> DataFrame:
    """per component its variance % (1 digit) and the ``top`` features by
    |loading| with the loading rounded to 3."""
    feats = list(features)
    model = fit_pca(scaled, feats, k or min(3, len(feats)))
    rows = []
    for j in range(model.axes.shape[1]):
        order = np.argsort(-np.abs(model.axes[:, j]), kind="stable")[:top]
        for rank, i in enumerate(order):
            rows.append((f"PC{j + 1}", float(model.ratios[j]) * 100, rank + 1, feats[i],
                         float(model.axes[i, j])))
    df = scaled.sparkSession.createDataFrame(
        rows, "PC STRING, pct DOUBLE, rango INT, feature STRING, loading DOUBLE")
    return df.select("PC", round_half_up("pct", 1).alias("varianza_pct"), "rango", "feature",
                     round_half_up("loading", 3).alias("loading"))
