"""Queries that check operators whose own result SQL cannot state.

Two kinds, each registered with SQL (:mod:`paramo.oracle_checks`):

* ingest over *dirty views* of the wide table: raw headers, numbers as texts
  among texts that are none, just enough or just too few matching rows, no
  key and equal rows, a CSV file;
* *identities* of learned models: what has to hold of the result whatever the
  model learned, as sums that are conserved or counts that follow from the
  input alone.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paramo.functions import round_half_up
from paramo.operators import anomaly as N
from paramo.operators import clean as C
from paramo.operators import clustering as K
from paramo.operators import dashboard as D
from paramo.operators import features as FE
from paramo.operators import profiles as H
from paramo.operators import supervised as S
from paramo.operators import wide as W
from paramo.operators.ranking import global_rank
from paramo.plans import analysis as A
from paramo.plans.materialize import materialize, scratch_path
from paramo.sources.normals import COLUMNAS_BASE, KEY, MESES, normals_from_tpch, read_normals
from paramo.sources.sinks import write_bundle, write_labels
from paramo.sources.star import star_from_tpch

FEATURES = COLUMNAS_BASE + MESES
#: Cleaned name -> raw header.
HEADERS = {"ALTITUD_m": " ALTITUD (m) ", "LATITUD": "LATITUD ", "LONGITUD": " LONGITUD", "ESTACION": "ESTACION ", "DEPARTAMENTO": " DEPARTAMENTO"}
TREE = [(-1, 0.0, -1, -1, 40, 2), (-1, 0.0, -1, -1, 3, 2), (-1, 0.0, -1, -1, 1, 1)]


def _scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(A.scaled_table(A.wide_table(spark, sf_dir, materialize=True)), "scaled")


# ------------------------------------------------------------------ ingest

def _raw_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[HEADERS.get(c, c) for c in df.columns])


def a2_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "normals_csv")
    _raw_headers(normals_from_tpch(spark, sf_dir)).write.option("header", True).csv(path)
    return C.clean_normals(read_normals(spark, path, "csv"))


def b1_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_columns(_raw_headers(normals_from_tpch(spark, sf_dir)))


def _matching(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """``n`` rows, those of the smallest keys, name the parameter in one way or another; others name another one or none."""
    ranked = global_rank(normals_from_tpch(spark, sf_dir).withColumn("_g", F.lit(0)), ["_g"], [KEY], "_r").drop("_g")
    named = F.when(F.col(KEY) % 2 == 0, "Precipitación total").otherwise("PRECIPITACION MEDIA")
    other = F.when(F.col(KEY) % 3 == 0, None).otherwise("EVAPORACIÓN")
    return ranked.withColumn("PARAMETRO", F.when(F.col("_r") < n, named).otherwise(other)).drop("_r")


def b2_support(n: int):
    return lambda spark, sf_dir: C.filter_min_support(_matching(spark, sf_dir, n)).select(KEY, "PARAMETRO")


def b3_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = normals_from_tpch(spark, sf_dir)
    text = {c: F.col(c).cast("string") for c in FEATURES}
    k = F.col(KEY)
    texts = raw.withColumns(text | {
        "ENE": F.when(k % 11 == 0, "n/d").otherwise(text["ENE"]), "FEB": F.when(k % 13 == 0, F.concat(text["FEB"], F.lit("d"))).otherwise(text["FEB"]),
        "MAR": F.when(k % 7 == 0, F.concat(F.lit("  "), text["MAR"], F.lit(" "))).when(k % 7 == 1, "").otherwise(text["MAR"]),
        "ABR": F.when(k % 5 == 0, "1,5").when(k % 5 == 1, "-2.5e1").otherwise(text["ABR"])})
    return C.coerce_numeric(texts).select(KEY, *FEATURES)


def b6_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key, most of them equal to others, get distinct numbers from 0 on."""
    numbered = C.with_row_key(normals_from_tpch(spark, sf_dir).select("LATITUD", "PARAMETRO"))
    return numbered.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(KEY).alias("n_keys"), F.min(KEY).alias("lo"), F.max(KEY).alias("hi"))


def f1_assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a NULL feature have no vector."""
    raw = normals_from_tpch(spark, sf_dir)
    return FE.assemble(raw.withColumn("ENE", F.when(F.col(KEY) % 4 != 0, F.col("ENE"))), FEATURES).select(KEY)


# ------------------------------------------------------- results and sinks

def a3_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "labels")
    k = F.col(KEY)
    write_labels(A.wide_table(spark, sf_dir).select(KEY, "ANUAL", (k % 3).cast("int").alias("cluster_kmeans"), (k % 20 == 0).alias("is_anomaly_if"), (F.col("ANUAL") / 8).alias("PC1")), path)
    return spark.read.option("header", True).schema(f"{KEY} long, cluster_kmeans int, is_anomaly_if boolean, PC1 double").csv(path)


def _named_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows") for name, df in tables.items()])


def a4_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, wide = scratch_path(spark, "bundle"), A.wide_table(spark, sf_dir, materialize=True)
    names = write_bundle({"indicadores": W.global_indicators(wide), "zonas": W.altitude_zones(wide), "cluster_stats": K.cluster_stats(A.fixed_label(wide), "lab")}, path)
    return _named_counts({name: spark.read.json(f"{path}/{name}") for name in names})


def d9_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_counts(D.dashboard_bundle(star_from_tpch(spark, sf_dir)))


def j2_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = A.wide_table(spark, sf_dir)
    labels = A.fixed_label(wide.select(KEY).where(F.col(KEY) % 5 != 0))
    return wide.join(labels, KEY, "left").groupBy("lab").agg(F.count(F.lit(1)).alias("n"), round_half_up(F.sum("ANUAL"), 2).alias("anual"))


def v3_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scaled(spark, sf_dir)
    return H.scatter_data(FE.pca_project(s, FEATURES), A.fixed_label(s.select(KEY)), "lab").groupBy("lab").agg(F.count(F.lit(1)).alias("n"), F.count("PC1").alias("n_pc1"))


# -------------------------------------------------------------- identities

def k1_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every k: the squares within clusters (the inertia) and between them are all the squares."""
    wide = A.wide_table(spark, sf_dir, materialize=True)
    vec = materialize(FE.standardize_sample(wide, FEATURES).select(KEY, "features"), "features")
    _, models = K.kmeans_sweep(vec)
    rows = []
    for k, model in models.items():
        means = model.transform(vec).groupBy("prediction").agg(Summarizer.mean(F.col("features")).alias("m"), F.count(F.lit(1)).alias("n")).collect()  # k rows
        rows.append((k, float(model.summary.trainingCost) + sum(r["n"] * float(r["m"].dot(r["m"])) for r in means)))
    return A.rounded(spark.createDataFrame(rows, "k INT, total DOUBLE"), ["total"], 4)


def k3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No row is nearer to another centre than to its own."""
    wide = A.wide_table(spark, sf_dir, materialize=True)
    vec = materialize(FE.standardize_sample(wide, FEATURES).select(KEY, "features"), "features")
    _, models = K.kmeans_sweep(vec, 3, 3)
    centres = [c.tolist() for c in models[3].clusterCenters()]
    from pyspark.ml.functions import vector_to_array
    x = K.kmeans_assign(models[3], vec).join(vec, KEY).withColumn("x", vector_to_array("features"))
    far = [F.aggregate(F.zip_with("x", F.array(*[F.lit(v) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d) for c in centres]
    told = x.withColumn("far", F.array(*far))
    astray = F.get("far", F.col("cluster_kmeans")) > F.array_min("far") + 1e-9
    return told.agg(F.count(F.lit(1)).alias("n"), F.count_if(astray).alias("astray"))


def f4_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All components explain everything, and the last one's cumulative share says so (V2)."""
    shares = FE.pca_variance(_scaled(spark, sf_dir), FEATURES, len(FEATURES))
    scree = H.scree_data(shares)
    return scree.agg(F.count(F.lit(1)).alias("components"), round_half_up(F.sum("pct") / 100, 2).alias("total"), F.max("pct_acumulado").alias("last_pct"), F.max("linea_80").alias("line"))


def f5_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projected on all components, rows keep their length: the mean square is the number of features that vary; components are centred and uncorrelated."""
    p = FE.pca_project(_scaled(spark, sf_dir), FEATURES, len(FEATURES))
    squares = sum((F.col(f"PC{i + 1}") ** 2 for i in range(len(FEATURES))), F.lit(0.0))
    return p.agg(F.count(F.lit(1)).alias("n"), round_half_up(F.avg(squares), 6).alias("mean_square"), round_half_up(F.avg("PC1"), 6).alias("mean_1"),
                 round_half_up(F.covar_pop("PC1", "PC2"), 6).alias("covar_12"))


def f6_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All loadings of a component make a unit vector."""
    loadings = FE.pca_loadings(_scaled(spark, sf_dir), FEATURES, top=len(FEATURES))
    return loadings.groupBy("PC").agg(F.count(F.lit(1)).alias("n"), round_half_up(F.sum(F.col("loading") ** 2), 2).alias("length"))


def k11_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels' counts are the sizes that the merge table leaves when its last merges are undone."""
    labels, merges = K.ward(_scaled(spark, sf_dir), FEATURES, 3, tail=150)
    told = labels.groupBy("cluster_jerarquico").agg(F.count(F.lit(1)).alias("size"))
    n = labels.count()
    last = merges.where(F.col("step") > n - 3)
    sizes = merges.select((F.col("step") + n - 1).alias("node"), F.col("size"))
    parts = last.select(F.explode(F.array("left", "right")).alias("node")).where(F.col("node") < 2 * n - 3).join(sizes, "node", "left").select(F.coalesce("size", F.lit(1)).alias("size"))
    both = told.agg(F.sort_array(F.collect_list("size")).alias("a"), F.sum("size").alias("n"), F.count(F.lit(1)).alias("clusters")).withColumn("_j", F.lit(1))
    return both.join(parts.agg(F.sort_array(F.collect_list("size")).alias("b")).withColumn("_j", F.lit(1)), "_j").select("clusters", "n", (F.col("a") == F.col("b")).alias("agree"))


def k12_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals of the merge table where most merges are made in rounds."""
    merges = K.ward(_scaled(spark, sf_dir), FEATURES, 2, tail=100)[1]
    return A.rounded(merges.agg(F.count(F.lit(1)).alias("merges"), (F.sum(F.col("height") ** 2) / 2).alias("half_squares")), ["half_squares"], 4)


def n1_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tree has its sample size of all rows, and no row twice."""
    wide = A.wide_table(spark, sf_dir, materialize=True)
    n = wide.count()
    psi = min(256, n)
    drawn = N.tree_samples(wide, ["ANUAL"], n, 100, psi, 42)
    first = global_rank(drawn, ["tree"], ["u", KEY], "place").where(F.col("place") < psi)
    return first.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(KEY).alias("n_keys"))


def n1_fixed_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by a tree that is given: altitude up to 2,000, then rain up to 500."""
    nodes = [(0, 2000.0, 1, 2, 44, 0), (1, 500.0, 3, 4, 43, 1), TREE[2], TREE[1], TREE[0]]
    forest = pd.DataFrame([(0, i, *node) for i, node in enumerate(nodes)], columns=["tree", "node", "feature", "threshold", "left", "right", "size", "depth"])
    scores = N.forest_scores(A.wide_table(spark, sf_dir), ["ALTITUD_m", "ANUAL"], forest, 44)
    return A.rounded(scores, ["anomaly_score_if"])


def r1_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row is predicted, with a label that was trained on."""
    _, pred = S.train_rf(A.fixed_label(_scaled(spark, sf_dir)), FEATURES, "lab", n_trees=20, anomaly=None)
    return pred.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("yhat").between(0, 2)).alias("known"))


def r3_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row is predicted once, in its fold."""
    pred = S.fold_predictions(A.fixed_label(_scaled(spark, sf_dir)), FEATURES, "lab", n_trees=10)
    return pred.groupBy(F.col("y").alias("lab"), "fold").agg(F.count(F.lit(1)).alias("n"))


def r6_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All importances add up to one."""
    model, _ = S.train_rf(A.fixed_label(_scaled(spark, sf_dir)), FEATURES, "lab", n_trees=20, anomaly=None)
    return S.feature_importance(model, FEATURES, spark).agg(F.count(F.lit(1)).alias("features"), round_half_up(F.sum("importance"), 2).alias("total"))


QUERIES = {
    "a2_csv": a2_csv,
    "a3_labels_round_trip": a3_labels,
    "a4_bundle_round_trip": a4_bundle,
    "b1_clean_columns": b1_headers,
    "b2_support_99": b2_support(99),
    "b2_support_100": b2_support(100),
    "b3_coerce_numeric": b3_numbers,
    "b6_row_keys": b6_keys,
    "d9_bundle_rows": d9_bundle,
    "j2_label_counts": j2_labels,
    "f1_assembled_rows": f1_assembled,
    "f4_total_variance": f4_total,
    "f5_projected_norms": f5_norms,
    "f6_unit_loadings": f6_lengths,
    "k1_sums_of_squares": k1_sums,
    "k3_nearest_centres": k3_nearest,
    "k11_label_sizes": k11_sizes,
    "k12_ward_rounds": k12_rounds,
    "n1_sample_sizes": n1_samples,
    "n1_fixed_tree": n1_fixed_tree,
    "r1_prediction_counts": r1_counts,
    "r3_fold_rows": r3_folds,
    "r6_total_importance": r6_total,
    "v3_scatter_counts": v3_counts,
}
