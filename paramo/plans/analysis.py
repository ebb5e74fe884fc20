"""The deep-analysis pipeline as a plan of DataFrames.

``run_analysis`` runs the stages in the reference order (EDA, K-Means sweep,
PCA, DBSCAN, Ward, Isolation Forest, LOF, random forest, profiles,
comparison, wide-table queries) and returns a dict of result tables, the
bundle :func:`paramo.sources.sinks.write_bundle` persists.  Stage data
dependencies are kept: best k feeds Ward, the forest target and profiles;
Isolation Forest precedes the forest and profiles; PCA precedes scatters.

The fixed-label helpers below let metric operators be checked against SQL
independently of any learned model.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paramo.functions import round_half_up
from paramo.operators import anomaly as N
from paramo.operators import clustering as K
from paramo.operators import features as FE
from paramo.operators import pairwise as P
from paramo.operators import profiles as H
from paramo.operators import supervised as S
from paramo.operators import wide as W
from paramo.operators.clean import clean_normals, resolve_features
from paramo.plans.materialize import materialize
from paramo.sources.normals import KEY, normals_from_tpch


def wide_table(spark: SparkSession, sf_dir: str, materialize: bool = False) -> DataFrame:
    """Cleaned wide table derived from the test tables."""
    return clean_normals(normals_from_tpch(spark, sf_dir), materialize)


def scaled_table(wide: DataFrame, features=None) -> DataFrame:
    """F3 on the wide table: key, scaled features and their array ``x``."""
    feats = list(features) if features is not None else resolve_features(wide)
    return FE.standardize_population(wide, feats, keep=(KEY,))


def fixed_label(df: DataFrame, name: str = "lab") -> DataFrame:
    """Deterministic label ``id_fila % 3`` (three rain regimes of the fixture)."""
    return df.withColumn(name, (F.col(KEY) % 3).cast("int"))


def fixed_flags(df: DataFrame) -> DataFrame:
    return df.select(KEY, (F.col(KEY) % 20 == 0).alias("is_anomaly_if"),
                     (F.col(KEY) % 7 == 0).alias("is_anomaly_lof"))


def eps_params(scaled: DataFrame) -> tuple[float, int]:
    """K8 on a scaled frame, as two driver scalars (the DBSCAN parameters)."""
    row = P.auto_eps(scaled).first()
    return float(row["eps"]), int(row["min_samples"])


# Method names, kinds and advantages of the comparison.
KMEANS = ("K-Means (Spark MLlib)", "Centroide", "Escalable, reproducible, distribuido")
DBSCAN = ("DBSCAN", "Densidad", "Forma arbitraria, detecta ruido ({} pts)")
WARD = ("Jerárquico (Ward)", "Jerárquico", "Dendrograma interpretable, sin k previo")


def both_silhouettes(scaled: DataFrame, labels: DataFrame, label: str, exclude_noise: bool = False) -> tuple[float, float]:
    """K5 and K6 of one labelling; with noise left out, 0 unless two clusters and a spare row remain."""
    points = materialize(scaled.select(KEY, "x").join(labels.select(KEY, label), KEY), "labelled")
    if exclude_noise:
        points = points.where(F.col(label) != -1)
    euclid = P.silhouette_euclid(points, label).select("silhouette", "k", "n").first()
    told = euclid["k"] >= 2 and euclid["n"] > euclid["k"]
    return (float(K.silhouette_sq(points, label).first()["silhouette"]) if told else 0.0), float(euclid["silhouette"])


def run_analysis(wide: DataFrame, k_min: int = 2, k_max: int = 8, seed: int = 42, n_trees: int = 100, rf_depth: int = 30,
                 contamination: float = 0.05, n_neighbors: int = 20) -> dict[str, DataFrame]:
    """Every stage of the deep analysis; returns the result tables by name.

    The wide and scaled tables and every method's labels and scores are
    written once and read by all that follows; K6, whose work is that of all
    pairs, runs once a method."""
    started = time.time()
    spark = wide.sparkSession
    wide = materialize(wide, "normals")
    feats = resolve_features(wide)
    n_rows = wide.count()
    out: dict[str, DataFrame] = {}
    out["eda_estadisticas"] = W.eda_stats(wide, feats)
    out["eda_top_correlaciones"] = W.top_correlations(wide, feats)
    outliers = materialize(W.iqr_outliers(wide, feats), "outliers")
    out["eda_outliers_iqr"] = outliers
    out["eda"] = outliers.agg(F.sum("n_outliers").cast("long").alias("n_outliers_iqr"), F.lit(len(feats)).alias("n_features"))

    vec = materialize(FE.standardize_sample(wide, feats).select(KEY, "features", *feats), "features")
    sweep, models = K.kmeans_sweep(vec, k_min, k_max, seed)
    sweep = materialize(sweep, "sweep")
    best = K.best_k(sweep).first()
    k = int(best["k"])
    km = materialize(K.kmeans_assign(models[k], vec), "kmeans")
    out["kmeans_por_k"] = sweep
    out["kmeans_cluster_stats"] = K.cluster_stats(wide.join(km, KEY), "cluster_kmeans")
    out["cluster_info"] = K.label_counts(km, "cluster_kmeans")

    scaled = materialize(FE.standardize_population(wide, feats, keep=(KEY,)), "scaled")
    out["pca_varianza"] = FE.pca_variance(scaled, feats)
    pcs = materialize(FE.pca_project(scaled, feats), "pcs")
    out["pca_loadings"] = FE.pca_loadings(scaled, feats)

    eps, ms = eps_params(scaled)
    db = materialize(P.dbscan(scaled, eps, ms), "dbscan")
    db_sq, db_eu = both_silhouettes(scaled, db, "cluster_dbscan", exclude_noise=True)
    out["dbscan"] = materialize(P.dbscan_summary(db, eps, ms, spark.range(1).select(F.lit(db_eu).alias("silhouette"))), "dbscan_summary")
    out["dbscan_conteos"] = P.dbscan_counts(db)

    ward_labels, merges = K.ward(scaled, feats, k)
    ward_labels, merges = materialize(ward_labels, "ward"), materialize(merges, "ward_merges")
    w_sq, w_eu = both_silhouettes(scaled, ward_labels, "cluster_jerarquico")
    out["jerarquico"] = K.ward_summary(ward_labels, k, spark.range(1).select(F.lit(w_eu).alias("silhouette")), n_rows)
    out["jerarquico_conteos"] = K.label_counts(ward_labels, "cluster_jerarquico")

    iso = materialize(N.isolation_forest(scaled, feats, seed=seed, contamination=contamination), "iforest")
    lof = materialize(P.lof(scaled, n_neighbors, contamination), "lof")
    out["anomalias"] = N.anomaly_agreement(iso.join(lof, KEY)).withColumns(
        {"contamination": F.lit(contamination), "n_neighbors": F.lit(n_neighbors)})

    labelled = materialize(scaled.join(km, KEY).join(iso.select(KEY, "is_anomaly_if"), KEY), "labelled")
    model, pred = S.train_rf(labelled, feats, "cluster_kmeans", n_trees, seed, rf_depth)
    pred = materialize(pred, "rf")
    imp = S.feature_importance(model, feats, spark)
    top = imp.first()
    acc, f1 = S.accuracy(pred).first()["accuracy"], S.macro_f1(pred).first()["f1_macro"]
    out["random_forest"] = spark.range(1).select(
        round_half_up(F.lit(acc), 4).alias("accuracy"), round_half_up(F.lit(f1), 4).alias("f1_score"),
        F.lit(n_trees).alias("n_estimators"), F.lit(top["feature"] if top else "").alias("top_feature"))
    out["rf_cv"] = S.cross_validate(S.training_rows(labelled), feats, "cluster_kmeans", n_trees, seed, rf_depth)
    out["rf_importancia"] = imp

    out["perfiles"] = H.cluster_profiles(wide.join(km, KEY).join(iso, KEY), "cluster_kmeans", feats)
    _, km_eu = both_silhouettes(scaled, km, "cluster_kmeans")
    db_row = out["dbscan"].first()
    out["comparativa_clustering"] = K.compare_clusterings(spark, [
        (*KMEANS[:2], float(best["silhouette"]), km_eu, k, KMEANS[2]),
        (*DBSCAN[:2], db_sq, db_eu, int(db_row["n_clusters"]), DBSCAN[2].format(db_row["n_noise"])),
        (*WARD[:2], w_sq, w_eu, k, WARD[2]),
    ])

    out["indicadores_globales"] = W.global_indicators(wide)
    out["zonas_altitudinales"] = W.altitude_zones(wide)
    out["top_departamentos"] = W.top_departments(wide)

    out["grafico_elbow"] = H.elbow_data(sweep, k)
    out["grafico_scree"] = H.scree_data(out["pca_varianza"])
    out["grafico_scatter_kmeans"] = H.scatter_data(pcs, km, "cluster_kmeans")
    out["grafico_scatter_dbscan"] = H.scatter_data(pcs, db, "cluster_dbscan")
    out["grafico_dendrograma"], out["grafico_dendrograma_corte"] = H.dendrogram_data(merges, k)
    out["grafico_anomalias_if"] = H.score_histogram(iso, "anomaly_score_if", "is_anomaly_if")
    out["grafico_anomalias_lof"] = H.score_histogram(lof, "anomaly_score_lof", "is_anomaly_lof")
    out["grafico_importancia"] = H.importance_top(imp)
    out["grafico_perfiles"] = H.boxplot_data(wide.join(km, KEY), "cluster_kmeans")
    out["etiquetas"] = (wide.select(KEY).join(km, KEY).join(db, KEY).join(ward_labels, KEY)
                        .join(iso, KEY).join(lof, KEY).join(pcs.select(KEY, "PC1", "PC2"), KEY))
    out["resumen"] = spark.range(1).select(
        F.lit(True).alias("exito"), F.lit(f"Apache Spark {spark.version}").alias("motor"),
        F.lit(round(time.time() - started, 2)).alias("tiempo_procesamiento"), F.lit(n_rows).alias("num_registros"),
        F.lit(k).alias("mejor_k"), F.lit(float(best["silhouette"])).alias("mejor_silhouette"),
        F.lit(float(best["inertia"])).alias("mejor_inertia"), F.array(*[F.lit(f) for f in feats]).alias("features_usadas"))
    return out


def _list(df: DataFrame, order: str, **named: str) -> DataFrame:
    """One row with one array of structs, in order; for result tables, which are a few rows whatever the input."""
    item = F.struct(F.col(order).alias("_o"), *[F.col(c).alias(n) for n, c in named.items()])
    return df.agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: F.struct(*[x[n].alias(n) for n in named])).alias("items"))


def result_bundle(out: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A4: the results of :func:`run_analysis` under the keys, and nested as, a reader of the reference's result dictionary knows them.

    A scalar entry is in the one row of ``resumen``; a list is a table; a
    dictionary is one row, with nested lists as arrays of structs."""
    spark = out["resumen"].sparkSession
    one = lambda **parts: spark.range(1).select(*[F.lit(v).alias(k) for k, v in parts.items()])

    def beside(base: DataFrame, **lists: DataFrame) -> DataFrame:
        for name, rows in lists.items():
            base = base.withColumn("_j", F.lit(1)).join(rows.select(F.lit(1).alias("_j"), F.col("items").alias(name)), "_j").drop("_j")
        return base

    pca, an, cv = out["pca_varianza"], out["anomalias"], out["rf_cv"]
    reached = F.coalesce(F.max(F.when(F.col("alcanza_80"), F.col("orden"))), F.max("orden"))
    anomalies = an.select(F.struct(F.col("n_if").alias("n_anomalias"), F.col("pct_if").alias("pct"), "contamination").alias("isolation_forest"),
                          F.struct(F.col("n_lof").alias("n_anomalias"), F.col("pct_lof").alias("pct"), "n_neighbors").alias("lof"),
                          F.col("n_ambos").alias("detectadas_por_ambos"), "pct_ambos")
    scores = cv.agg(F.transform(F.sort_array(F.collect_list(F.struct("fold", "f1_macro"))), lambda x: x["f1_macro"]).alias("cv_scores"),
                    F.first("cv_mean").alias("cv_mean"), F.first("cv_std").alias("cv_std"))
    forest = out["random_forest"].withColumn("_j", F.lit(1)).join(scores.withColumn("_j", F.lit(1)), "_j").drop("_j")
    graphs = {k: v for k, v in out.items() if k.startswith("grafico_")}
    counts = dict(etiqueta="etiqueta", registros="registros")
    return {
        "resumen": out["resumen"],
        "tabla_metricas": out["kmeans_por_k"],
        "cluster_info": out["cluster_info"],
        "cluster_stats": out["kmeans_cluster_stats"],
        "analiticas": beside(one(exito=True), indicadores=_list(out["indicadores_globales"], "total_registros", **{c: c for c in out["indicadores_globales"].columns}),
                             zonas=_list(out["zonas_altitudinales"], "orden", **{c: c for c in out["zonas_altitudinales"].columns}),
                             top_departamentos=_list(out["top_departamentos"].withColumn("_r", -F.col("prom_precip")), "_r", **{c: c for c in out["top_departamentos"].columns})).drop("exito"),
        "eda": beside(out["eda"], estadisticas=_list(out["eda_estadisticas"], "orden", **{c: c for c in out["eda_estadisticas"].columns if c != "orden"}),
                      top_correlaciones=_list(out["eda_top_correlaciones"].withColumn("_r", -F.abs("correlation")), "_r", **{c: c for c in out["eda_top_correlaciones"].columns})),
        "pca": beside(pca.agg(F.transform(F.sort_array(F.collect_list(F.struct("orden", "varianza_explicada"))), lambda x: x["varianza_explicada"]).alias("varianza_explicada"),
                              F.transform(F.sort_array(F.collect_list(F.struct("orden", "varianza_acumulada"))), lambda x: x["varianza_acumulada"]).alias("varianza_acumulada"),
                              reached.alias("componentes_80pct")),
                      loadings=_list(out["pca_loadings"].withColumn("_r", F.struct("PC", "rango")), "_r", **{c: c for c in out["pca_loadings"].columns})),
        "dbscan": beside(out["dbscan"], cluster_counts=_list(out["dbscan_conteos"], "cluster_dbscan", **counts)),
        "jerarquico": beside(out["jerarquico"], cluster_counts=_list(out["jerarquico_conteos"], "cluster", **counts)),
        "anomalias": anomalies,
        "random_forest": beside(forest, feature_importance=_list(out["rf_importancia"].withColumn("_r", F.struct(-F.col("importance"), "feature")), "_r", feature="feature", importance="importance")),
        "perfiles": out["perfiles"],
        "comparativa_clustering": out["comparativa_clustering"],
        "etiquetas": out["etiquetas"],
        **graphs,
    }


def rounded(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.withColumns({c: round_half_up(c, digits) for c in cols})
