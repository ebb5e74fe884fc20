"""

``entry(spark)`` runs the flagship query (D5, rainiest peak months: five
joins, a distinct count and two rank windows) on sf0.001.  ``queries()``
maps every registered operator to a ``(spark, sf_dir) -> DataFrame``
callable; ``oracle_sql()`` gives the DuckDB SQL computing the same result
from the raw tables.  Operators whose result is not expressible in SQL
(learned models: K-Means, PCA projection, Isolation Forest, random forest)
have no oracle entry and are checked by property tests in ``tests/``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paramo import oracle_checks as ochecks  # noqa: E402
from paramo import oracle_sql as osql  # noqa: E402
from paramo.operators import dashboard as D  # noqa: E402
from paramo.operators import wide as W  # noqa: E402
from paramo.operators.clean import clean_normals  # noqa: E402
from paramo.sources.normals import normals_from_tpch  # noqa: E402
from paramo.sources.star import star_from_tpch  # noqa: E402
from paramo.plans import analysis as A  # noqa: E402
from paramo.plans import checks  # noqa: E402
from paramo.operators import pairwise as P  # noqa: E402
from paramo.operators import clustering as K  # noqa: E402
from paramo.operators import anomaly as N  # noqa: E402
from paramo.operators import supervised as S  # noqa: E402
from paramo.operators import profiles as H  # noqa: E402
from paramo.operators import features as FE  # noqa: E402
from paramo.operators.clean import resolve_features  # noqa: E402
from paramo.plans.materialize import materialize as written  # noqa: E402
from paramo.sources.normals import KEY  # noqa: E402
from paramo.functions import round_half_up  # noqa: E402
from paramo.operators.ranking import global_rank  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from paramo.llm import queries as llm_queries  # noqa: E402
except ModuleNotFoundError as missing:  # the corpus operators, or a package that only they use, may be absent
    if (missing.name or "").split(".")[0] in ("paramo", "corpus_pipeline") and missing.name not in ("corpus_pipeline", "paramo.llm", "paramo.llm.queries"):
        raise
    print(f"corpus operators are not registered: {missing}", file=sys.stderr)
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Registered filter-query parameter sets.
D10_CASES = {
    "d10_filter_param": ("TEMPERATURA MEDIA", "", ""),
    "d10_filter_param_depto": ("PRECIPITACIÓN", "NATION_7", ""),
    "d10_filter_all": ("No. DE DIAS CON LLUVIA", "NATION_3", "1998-2001"),
    "d10_filter_empty": ("", "", ""),
}


def entry(spark: SparkSession) -> DataFrame:
    return D.rainiest_peak_months(star_from_tpch(spark, SMOKE_DIR))


def _star_query(fn):
    return lambda spark, sf_dir: fn(star_from_tpch(spark, sf_dir))


def _d10(case):
    p, g, per = case
    return lambda spark, sf_dir: D.filter_query(star_from_tpch(spark, sf_dir), p, g, per)


def wide_table(spark: SparkSession, sf_dir: str, materialize: bool = False) -> DataFrame:
    """The cleaned wide table (B1-B6) derived from the test tables."""
    return clean_normals(normals_from_tpch(spark, sf_dir), materialize)


def _scaled(spark, sf_dir, feats=None):
    return A.scaled_table(wide_table(spark, sf_dir, materialize=True), feats)


def _q_f3(spark, sf_dir):
    s = _scaled(spark, sf_dir)
    return A.rounded(s.drop("x"), osql.FEATURES)


def _q_k7(spark, sf_dir):
    return A.rounded(P.knn_distance(_scaled(spark, sf_dir)), ["k_dist"])


def _q_k8(spark, sf_dir):
    return A.rounded(P.auto_eps(_scaled(spark, sf_dir)), ["eps"])


def _q_k9(feats=None):
    def q(spark, sf_dir):
        s = written(_scaled(spark, sf_dir, feats), "scaled")
        eps, ms = A.eps_params(s)
        return P.dbscan(s, eps, ms)
    return q


def _q_k6(spark, sf_dir):
    s = A.fixed_label(_scaled(spark, sf_dir))
    return A.rounded(P.silhouette_euclid(s, "lab"), ["silhouette"])


def _q_k5(spark, sf_dir):
    return K.silhouette_sq(A.fixed_label(_scaled(spark, sf_dir)), "lab")


def _q_k4(spark, sf_dir):
    return K.cluster_stats(A.fixed_label(wide_table(spark, sf_dir)), "lab")


def _q_n2(spark, sf_dir):
    return A.rounded(P.lof(_scaled(spark, sf_dir)), ["anomaly_score_lof"])


def _q_n3(spark, sf_dir):
    return N.anomaly_agreement(A.fixed_flags(wide_table(spark, sf_dir)))


def _fixed_pred(spark, sf_dir):
    w = wide_table(spark, sf_dir)
    return w.select(KEY, (F.col(KEY) % 3).cast("int").alias("y"),
                    (F.floor("ANUAL").cast("long") % 3).cast("int").alias("yhat"))


def _q_r4(spark, sf_dir):
    return A.rounded(S.accuracy(_fixed_pred(spark, sf_dir)), ["accuracy"])


def _q_r5(spark, sf_dir):
    return A.rounded(S.macro_f1(_fixed_pred(spark, sf_dir)), ["f1_macro"])


def _q_r2(spark, sf_dir):
    folds = S.stratified_folds(A.fixed_label(wide_table(spark, sf_dir)), "lab", 3)
    return folds.groupBy("lab", "fold").agg(F.count(F.lit(1)).alias("n"))


def _q_h1(spark, sf_dir):
    w = A.fixed_label(wide_table(spark, sf_dir)).withColumn("is_anomaly_if", F.col(KEY) % 20 == 0)
    return H.cluster_profiles(w, "lab", osql.FEATURES).withColumnRenamed("lab", "cluster")


def _q_v5(spark, sf_dir):
    w = wide_table(spark, sf_dir)
    sc = w.select(KEY, (F.col("ANUAL") / 1000.0 - (F.col(KEY) % 7)).alias("s"), (F.col(KEY) % 20 == 0).alias("flag"))
    return A.rounded(H.score_histogram(sc, "s", "flag"), ["desde", "hasta", "umbral"])


def _q_v7(spark, sf_dir):
    b = H.boxplot_data(A.fixed_label(wide_table(spark, sf_dir, materialize=True)), "lab")
    return A.rounded(b, ["q1", "mediana", "q3", "bigote_inf", "bigote_sup"])


# Learned-model operators: rows-only checks (no SQL oracle), property tests in tests/.

def _vec(spark, sf_dir):
    w = wide_table(spark, sf_dir, materialize=True)
    feats = resolve_features(w)
    return w, feats, written(FE.standardize_sample(w, feats).select(KEY, "features", *feats), "features")


def _q_k1(spark, sf_dir):
    _, _, v = _vec(spark, sf_dir)
    return K.kmeans_sweep(v)[0]


def _q_k3(spark, sf_dir):
    _, _, v = _vec(spark, sf_dir)
    sweep, models = K.kmeans_sweep(v)
    return K.kmeans_assign(models[int(K.best_k(sweep).first()["k"])], v)


def _q_f4(spark, sf_dir):
    # ratios are the same for sample- or population-standardised columns
    return FE.pca_variance(_scaled(spark, sf_dir), osql.FEATURES)


def _q_f5(spark, sf_dir):
    s = _scaled(spark, sf_dir)
    return FE.pca_project(s, osql.FEATURES)


def _q_f6(spark, sf_dir):
    return FE.pca_loadings(_scaled(spark, sf_dir), osql.FEATURES)


def _q_k11(spark, sf_dir):
    return K.ward(_scaled(spark, sf_dir), osql.FEATURES, 2)[0]


def _q_k12(spark, sf_dir):
    return K.ward(_scaled(spark, sf_dir), osql.FEATURES, 2)[1]


def _q_n1(spark, sf_dir):
    return N.isolation_forest(_scaled(spark, sf_dir), osql.FEATURES)


def _q_r1(spark, sf_dir):
    s = A.fixed_label(_scaled(spark, sf_dir))
    return S.train_rf(s, osql.FEATURES, "lab", anomaly=None)[1]


def _q_k2(spark, sf_dir):
    _, _, v = _vec(spark, sf_dir)
    return K.best_k(K.kmeans_sweep(v)[0])


def _dbscan_parts(spark, sf_dir, feats=None):
    s = written(_scaled(spark, sf_dir, feats), "scaled")
    eps, ms = A.eps_params(s)
    return s, written(P.dbscan(s, eps, ms), "dbscan"), eps, ms


def _q_k10(spark, sf_dir):
    s, db, eps, ms = _dbscan_parts(spark, sf_dir)
    sil = P.silhouette_euclid(s.join(db, KEY), "cluster_dbscan", exclude_noise=True)
    return P.dbscan_summary(db, eps, ms, sil)


def _q_k10_counts(spark, sf_dir):
    return P.dbscan_counts(_dbscan_parts(spark, sf_dir)[1])


def _q_k13(spark, sf_dir):
    s = _scaled(spark, sf_dir)
    labels, _ = K.ward(s, osql.FEATURES, 2)
    sil = P.silhouette_euclid(s.join(labels, KEY), "cluster_jerarquico")
    return K.ward_summary(labels, 2, sil, s.count())


def _q_v4(spark, sf_dir):
    return H.dendrogram_data(K.ward(_scaled(spark, sf_dir), osql.FEATURES, 2)[1], 2)[0]


def _q_v1(spark, sf_dir):
    _, _, v = _vec(spark, sf_dir)
    sweep = written(K.kmeans_sweep(v)[0], "sweep")
    return H.elbow_data(sweep, int(K.best_k(sweep).first()["k"]))


def _q_v2(spark, sf_dir):
    return H.scree_data(FE.pca_variance(_scaled(spark, sf_dir), osql.FEATURES))


def _q_v3(spark, sf_dir):
    s = _scaled(spark, sf_dir)
    return H.scatter_data(FE.pca_project(s, osql.FEATURES), A.fixed_label(s.select(KEY)), "lab")


def _q_r3(spark, sf_dir):
    s = A.fixed_label(_scaled(spark, sf_dir))
    return S.cross_validate(s, osql.FEATURES, "lab")


def _q_v6(spark, sf_dir):
    return H.importance_top(_q_r6(spark, sf_dir))


def _q_k14(spark, sf_dir):
    """The comparison of three methods, on fixed labels in their place."""
    s = written(_scaled(spark, sf_dir), "scaled")
    rows = []
    for (name, kind, text), label, noise in ((A.KMEANS, F.col(KEY) % 3, False), (A.DBSCAN, F.col(KEY) % 4 - 1, True), (A.WARD, F.col(KEY) % 2, False)):
        labels = s.select(KEY, label.cast("int").alias("lab"))
        sq, eu = A.both_silhouettes(s, labels, "lab", exclude_noise=noise)
        found = labels.where("lab <> -1").select("lab").distinct().count()
        rows.append((name, kind, sq, eu, found, text.format(labels.where("lab = -1").count())))
    return A.rounded(K.compare_clusterings(spark, rows), ["silhouette_euclid"])


def _q_f2(spark, sf_dir):
    w = wide_table(spark, sf_dir)
    v = FE.standardize_sample(w, osql.FEATURES).select(KEY, vector_to_array("features").alias("v"))
    return A.rounded(v.select(KEY, *[F.col("v")[i].alias(f) for i, f in enumerate(osql.FEATURES)]), osql.FEATURES)


def _fixed_dbscan(spark, sf_dir):
    return wide_table(spark, sf_dir).select(KEY, (F.col(KEY) % 4 - 1).cast("int").alias("cluster_dbscan"))


def _q_k10_fixed(spark, sf_dir):
    return P.dbscan_summary(_fixed_dbscan(spark, sf_dir), 0.5, 4, spark.range(1).select(F.lit(0.25).alias("silhouette")))


def _q_k12_totals(spark, sf_dir):
    merges = K.ward(_scaled(spark, sf_dir), osql.FEATURES, 2)[1]
    return A.rounded(merges.agg(F.count(F.lit(1)).alias("merges"), (F.sum(F.col("height") ** 2) / 2).alias("half_squares")), ["half_squares"], 4)


def _q_k13_fixed(spark, sf_dir):
    s = A.fixed_label(written(_scaled(spark, sf_dir), "scaled"))
    return K.ward_summary(s, 3, P.silhouette_euclid(s, "lab"), s.count())


def _fixed_sweep(spark, sf_dir):
    per_k = wide_table(spark, sf_dir).groupBy((F.col(KEY) % 7 + 2).cast("int").alias("k"))
    return per_k.agg(round_half_up(F.avg("ANUAL") / 10000, 4).alias("silhouette"), round_half_up(F.sum("ANUAL"), 2).alias("inertia"))


def _q_v1_fixed(spark, sf_dir):
    sweep = written(_fixed_sweep(spark, sf_dir), "sweep")
    return H.elbow_data(sweep, int(K.best_k(sweep).first()["k"]))


def _q_v4_fixed(spark, sf_dir):
    w = wide_table(spark, sf_dir).select(F.lit(0).alias("_g"), KEY, F.col("ANUAL").alias("height"))
    merges = global_rank(w, ["_g"], [KEY], "at").select(
        (F.col("at") + 1).cast("int").alias("step"), F.col(KEY).alias("left"), (F.col(KEY) + 1).alias("right"), "height", F.lit(2).cast("long").alias("size"))
    last, cut = H.dendrogram_data(merges, 3)
    return last.withColumn("umbral", F.lit(cut.first()["umbral"]))


def _q_v6_fixed(spark, sf_dir):
    w = wide_table(spark, sf_dir)
    return H.importance_top(w.groupBy(F.col("DEPARTAMENTO").alias("feature")).agg(round_half_up(F.count(F.lit(1)) / F.lit(float(w.count())), 4).alias("importance")))


def _q_r1_rows(spark, sf_dir):
    w = wide_table(spark, sf_dir)
    return S.training_rows(w.withColumn("is_anomaly_if", F.col(KEY) % 20 == 0)).select(KEY)


def _q_r6(spark, sf_dir):
    s = A.fixed_label(_scaled(spark, sf_dir))
    model, _ = S.train_rf(s, osql.FEATURES, "lab", anomaly=None)
    return S.feature_importance(model, osql.FEATURES, spark)


def _wide_query(fn, materialize=False, **kw):
    return lambda spark, sf_dir: fn(wide_table(spark, sf_dir, materialize), **kw)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "d1_precip_by_month_period": _star_query(D.precip_by_month_period),
        "d2_thermal_range_top15": _star_query(D.thermal_range_top15),
        "d3_combined_index": _star_query(D.combined_index),
        "d4_trend_by_period": _star_query(D.trend_by_period),
        "d5_rainiest_peak_months": _star_query(D.rainiest_peak_months),
        "d6_list_departamentos": _star_query(D.list_departamentos),
        "d7_list_parametros": _star_query(lambda star: D.list_parametros(star, used_only=True)),
        "d8_list_periodos": _star_query(lambda star: D.list_periodos(star, used_only=True)),
        "d11_free_select": lambda spark, sf_dir: D.free_select(
            spark, star_from_tpch(spark, sf_dir), osql.FREE_SQL),
    }
    for name, case in D10_CASES.items():
        q[name] = _d10(case)
    q.update({
        "b_clean_normals": wide_table,
        "e1_global_indicators": _wide_query(W.global_indicators),
        "e2_altitude_zones": _wide_query(W.altitude_zones),
        "e3_top_departments": _wide_query(W.top_departments),
        "e4_department_stats": _wide_query(W.department_stats, digits=6),
        "e5_band_stats": _wide_query(W.band_stats, digits=6),
        "e6_annual_summary": _wide_query(W.annual_summary, digits=6),
        "e7_eda_stats": _wide_query(W.eda_stats, materialize=True),
        "e8_top_correlations": _wide_query(W.top_correlations, materialize=True),
        "e9_iqr_outliers": _wide_query(W.iqr_outliers, materialize=True),
        "e9_iqr_outlier_total": _wide_query(W.iqr_outlier_total, materialize=True),
        "f3_standardize_population": _q_f3,
        "k7_knn_distance": _q_k7,
        "k8_auto_eps": _q_k8,
        "k9_dbscan": _q_k9(),
        "k9_dbscan_anual_altitud": _q_k9(["ANUAL", "ALTITUD_m"]),
        "k6_silhouette_euclid_fixed": _q_k6,
        "k5_silhouette_sq_fixed": _q_k5,
        "k4_cluster_stats_fixed": _q_k4,
        "n2_lof": _q_n2,
        "n3_anomaly_agreement_fixed": _q_n3,
        "r4_accuracy_fixed": _q_r4,
        "r5_macro_f1_fixed": _q_r5,
        "r2_stratified_fold_sizes": _q_r2,
        "h1_cluster_profiles_fixed": _q_h1,
        "v5_score_histogram_fixed": _q_v5,
        "v7_boxplot_fixed": _q_v7,
        "k1_kmeans_sweep": _q_k1,
        "k3_kmeans_assign": _q_k3,
        "f4_pca_variance": _q_f4,
        "f5_pca_project": _q_f5,
        "f6_pca_loadings": _q_f6,
        "k11_ward_labels": _q_k11,
        "k12_ward_merges": _q_k12,
        "n1_isolation_forest": _q_n1,
        "r1_random_forest_predictions": _q_r1,
        "r6_feature_importance": _q_r6,
        "k2_best_k": _q_k2,
        "k10_dbscan_summary": _q_k10,
        "k10_dbscan_counts": _q_k10_counts,
        "k13_ward_summary": _q_k13,
        "f2_standardize_sample": _q_f2,
        "k14_compare_clusterings_fixed": _q_k14,
        "k13_ward_summary_fixed": _q_k13_fixed,
        "k12_ward_totals": _q_k12_totals,
        "k10_dbscan_summary_fixed": _q_k10_fixed,
        "k10_dbscan_counts_fixed": lambda spark, sf_dir: P.dbscan_counts(_fixed_dbscan(spark, sf_dir)),
        "k2_best_k_fixed": lambda spark, sf_dir: K.best_k(_fixed_sweep(spark, sf_dir)),
        "v1_elbow_fixed": _q_v1_fixed,
        "v4_dendrogram_fixed": _q_v4_fixed,
        "v6_importance_top_fixed": _q_v6_fixed,
        "r1_training_rows_fixed": _q_r1_rows,
        "r3_cross_validate": _q_r3,
        "v1_elbow": _q_v1,
        "v2_scree": _q_v2,
        "v3_scatter": _q_v3,
        "v4_dendrogram": _q_v4,
        "v6_importance_top": _q_v6,
    })
    q.update(checks.QUERIES)
    if llm_queries is not None:
        q.update(llm_queries.QUERIES)
        q["pipeline"] = corpus_pipeline.run
    return q


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per registered query (views over the raw test tables)."""
    o = {
        "d1_precip_by_month_period": osql.D1,
        "d2_thermal_range_top15": osql.D2,
        "d3_combined_index": osql.D3,
        "d4_trend_by_period": osql.D4,
        "d5_rainiest_peak_months": osql.D5,
        "d6_list_departamentos": osql.D6,
        "d7_list_parametros": ochecks.D7_USED,
        "d8_list_periodos": ochecks.D8_USED,
        "d11_free_select": osql.D11,
    }
    for name, case in D10_CASES.items():
        o[name] = osql.d10(*case)
    o.update({
        "b_clean_normals": osql.B_CLEAN,
        "e1_global_indicators": osql.E1,
        "e2_altitude_zones": osql.E2,
        "e3_top_departments": osql.E3,
        "e4_department_stats": osql.E4,
        "e5_band_stats": osql.E5,
        "e6_annual_summary": osql.E6,
        "e7_eda_stats": osql.E7,
        "e8_top_correlations": osql.E8,
        "e9_iqr_outliers": osql.E9,
        "e9_iqr_outlier_total": osql.E9_TOTAL,
        "f3_standardize_population": osql.F3,
        "k7_knn_distance": osql.K7,
        "k8_auto_eps": osql.K8,
        "k9_dbscan": osql.K9,
        "k9_dbscan_anual_altitud": osql.K9_2F,
        "k6_silhouette_euclid_fixed": osql.K6,
        "k5_silhouette_sq_fixed": osql.K5,
        "k4_cluster_stats_fixed": osql.K4,
        "n2_lof": osql.N2,
        "n3_anomaly_agreement_fixed": osql.N3,
        "r4_accuracy_fixed": osql.R4,
        "r5_macro_f1_fixed": osql.R5,
        "r2_stratified_fold_sizes": osql.r2_fold_sizes(3),
        "h1_cluster_profiles_fixed": osql.H1,
        "v5_score_histogram_fixed": osql.V5,
        "v7_boxplot_fixed": osql.V7,
        "f2_standardize_sample": osql.F2,
        "k14_compare_clusterings_fixed": osql.K14_FIXED,
        "k13_ward_summary_fixed": osql.K13_FIXED,
        "k12_ward_totals": osql.K12_TOTALS,
        "k10_dbscan_summary_fixed": osql.K10_FIXED,
        "k10_dbscan_counts_fixed": osql.K10_COUNTS_FIXED,
        "k2_best_k_fixed": osql.K2_FIXED,
        "v1_elbow_fixed": osql.V1_FIXED,
        "v4_dendrogram_fixed": osql.V4_FIXED,
        "v6_importance_top_fixed": osql.V6_FIXED,
        "r1_training_rows_fixed": osql.R1_ROWS_FIXED,
    })
    o.update(ochecks.ORACLES)
    if llm_queries is not None:
        o.update(llm_queries.ORACLES)
        if corpus_pipeline.ORACLE_SQL is not None:
            o["pipeline"] = corpus_pipeline.ORACLE_SQL
    return o
