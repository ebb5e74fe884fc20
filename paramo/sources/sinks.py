"""Sinks: exported labels (A3) and the result bundle (A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from paramo.sources.normals import KEY

# Exported label/score columns, in report order.
LABEL_COLUMNS = ["cluster_kmeans", "cluster_dbscan", "cluster_jerarquico",
                 "is_anomaly_if", "anomaly_score_if", "is_anomaly_lof", "anomaly_score_lof",
                 "PC1", "PC2"]


def label_frame(df: DataFrame, key: str = KEY) -> DataFrame:
    """The key plus the label/score columns that exist."""
    return df.select(key, *[c for c in LABEL_COLUMNS if c in df.columns])


def write_labels(df: DataFrame, path: str, fmt: str = "csv", key: str = KEY) -> None:
    """A3: write the labels (with the row key), header + UTF-8 for CSV."""
    w = label_frame(df, key).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).option("encoding", "UTF-8").csv(path)
    else:
        w.format(fmt).save(path)


def write_bundle(results: dict[str, DataFrame], path: str, fmt: str = "json") -> list[str]:
    """A4: one folder per named result table; returns the names written."""
    for name, df in results.items():
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "json":
            writer = writer.option("ignoreNullFields", False)
        writer.save(f"{path}/{name}")
    return sorted(results)
