"""Whole analysis plan and the sinks (A3, A4) on the smallest fixture."""

import os
import tempfile

from pyspark.sql import functions as F

from paramo.plans.analysis import result_bundle, run_analysis, wide_table
from paramo.sources.sinks import write_bundle, write_labels

from .conftest import SF_SMALL


def test_run_analysis_and_sinks(spark):
    wide = wide_table(spark, SF_SMALL)
    out = run_analysis(wide, k_min=2, k_max=3, n_trees=10, rf_depth=5)
    labels = out["etiquetas"]
    assert labels.count() == wide.count()
    assert {"cluster_kmeans", "cluster_dbscan", "cluster_jerarquico", "is_anomaly_if",
            "is_anomaly_lof", "PC1", "PC2"} <= set(labels.columns)
    assert out["perfiles"].count() >= 2
    compared = out["comparativa_clustering"].collect()
    assert [r["metodo"] for r in compared] == ["K-Means (Spark MLlib)", "DBSCAN", "Jerárquico (Ward)"]
    assert all(-1 <= r[c] <= 1 for r in compared for c in ("silhouette_sq", "silhouette_euclid"))
    summary = out["resumen"].first()
    assert summary["num_registros"] == wide.count() and summary["mejor_k"] in (2, 3) and len(summary["features_usadas"]) == 16
    assert {"exito", "motor", "tiempo_procesamiento", "mejor_silhouette", "mejor_inertia"} <= set(out["resumen"].columns)
    assert out["eda"].first().asDict().keys() == {"n_outliers_iqr", "n_features"}
    assert {"contamination", "n_neighbors"} <= set(out["anomalias"].columns)
    assert {"accuracy", "f1_score", "n_estimators", "top_feature"} == set(out["random_forest"].columns)
    assert out["cluster_info"].agg({"registros": "sum"}).first()[0] == wide.count()
    assert out["jerarquico"].first()["n_muestra"] == wide.count()
    tmp = tempfile.mkdtemp(prefix="paramo-sink-")
    write_labels(labels, os.path.join(tmp, "labels"))
    back = spark.read.option("header", True).csv(os.path.join(tmp, "labels"))
    assert back.count() == labels.count() and "id_fila" in back.columns
    names = write_bundle({k: v for k, v in out.items() if k in ("dbscan", "anomalias", "perfiles")},
                         os.path.join(tmp, "bundle"))
    assert names == ["anomalias", "dbscan", "perfiles"]
    assert spark.read.json(os.path.join(tmp, "bundle", "dbscan")).count() == 1
    write_bundle({"nulls": spark.sql("SELECT 1 AS a, CAST(NULL AS INT) AS num_mes")}, os.path.join(tmp, "nulls"))
    assert "num_mes" in spark.read.json(os.path.join(tmp, "nulls", "nulls")).columns
    bundle = result_bundle(out)
    assert {"tabla_metricas", "cluster_info", "cluster_stats", "analiticas", "eda", "pca", "dbscan", "jerarquico", "anomalias", "random_forest", "perfiles", "comparativa_clustering"} <= set(bundle)
    names = write_bundle({k: v for k, v in bundle.items() if not k.startswith(("grafico", "etiquetas"))}, os.path.join(tmp, "report"))
    one = {k: spark.read.json(os.path.join(tmp, "report", k)).collect() for k in names}
    eda, pca, an, rf, ana = (one[k][0].asDict(recursive=True) for k in ("eda", "pca", "anomalias", "random_forest", "analiticas"))
    assert len(eda["estadisticas"]) == 16 and eda["n_features"] == 16 and len(eda["top_correlaciones"]) <= 10
    assert len(pca["varianza_explicada"]) == len(pca["varianza_acumulada"]) == 8 and 1 <= pca["componentes_80pct"] <= 8 and len(pca["loadings"]) == 15
    assert an["isolation_forest"].keys() == {"n_anomalias", "pct", "contamination"} and an["lof"].keys() == {"n_anomalias", "pct", "n_neighbors"} and "detectadas_por_ambos" in an
    assert len(rf["cv_scores"]) == min(5, summary["mejor_k"]) and rf["feature_importance"][0]["feature"] == rf["top_feature"]
    assert ana.keys() == {"indicadores", "zonas", "top_departamentos"} and sum(c["registros"] for c in one["dbscan"][0]["cluster_counts"]) == wide.count()
