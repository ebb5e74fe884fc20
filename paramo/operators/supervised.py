"""Supervised model on the clustering labels.

The random forest is :mod:`paramo.operators.forest` (trees grown and applied
across the cluster; only their upper levels reach the driver).  Folds are
exactly stratified without gathering a class in one task: rows are ranked
within their class by a seeded hash through the range-partitioned global
rank, and ``fold = rank mod n``.  Scores are computed from a confusion table
(``groupBy(y, yhat)``), so macro-F1 is the unweighted mean of per-class F1
(Spark's own "f1" metric is weighted, hence not used).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paramo.functions import round_half_up
from paramo.operators import forest
from paramo.operators.ranking import global_rank
from paramo.plans.materialize import materialize
from paramo.sources.normals import KEY


def _assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with every feature, as numbers; ``_y`` is the label."""
    rows = VectorAssembler(inputCols=list(features), outputCol="_fv", handleInvalid="skip").transform(df)
    return rows.drop("_fv").withColumns({f: F.col(f).cast("double") for f in features})


def training_rows(df: DataFrame, anomaly: str | None = "is_anomaly_if", min_rows: int = 50) -> DataFrame:
    """Rows to train on: non-anomalous ones when more than ``min_rows`` remain."""
    if anomaly is None or anomaly not in df.columns:
        return df
    clean = df.where(~F.coalesce(F.col(anomaly), F.lit(False)))
    return clean if clean.count() > min_rows else df


def train_rf(df: DataFrame, features: Sequence[str], label: str, n_trees: int = 100, seed: int = 42,
             max_depth: int = 30, anomaly: str | None = "is_anomaly_if", key: str = KEY):
    """Fit on the training rows, predict every row.

    Returns ``(model, predictions(key, y, yhat))``.
    """
    data = _assemble(df.withColumn("_y", F.col(label).cast("double")), features)
    learned = training_rows(data, anomaly)
    left_out = F.lit(-1) if learned is data else F.when(F.coalesce(F.col(anomaly), F.lit(False)), 0).otherwise(-1)
    rows = forest.prepare(data.select(F.col(key).alias("_key"), "_y", left_out.alias("_out"), F.lit(0).alias("_by"), *features), seed)
    model, binned = forest.fit(rows, features, n_trees, seed, max_depth)
    return model, _predicted(model, binned, rows).select(F.col("_key").alias(key), "y", "yhat")


def _predicted(model: forest.Forest, binned: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows with ``y`` and ``yhat``."""
    return rows.join(model.predict(binned), "_row", "left").withColumns(
        {"y": F.col("_y").cast("int"), "yhat": F.coalesce(F.col("_yhat"), F.lit(0)).cast("int")})


def stratified_folds(df: DataFrame, label: str, n_splits: int, seed: int = 42, key: str = KEY) -> DataFrame:
    """R2: ``(key, label, fold)`` with each class spread evenly over folds."""
    if n_splits < 2:
        raise ValueError("stratified folds need at least two classes")
    h = F.xxhash64(F.col(key), F.lit(seed))
    ranked = global_rank(df.select(key, label).withColumn("_h", h), [label], ["_h", key], "_r")
    return ranked.select(key, label, (F.col("_r") % n_splits).cast("int").alias("fold"))


def accuracy(pred: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Share of rows with ``y == yhat``."""
    return pred.agg(F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"))


def macro_f1(pred: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Unweighted mean over classes (in y or yhat) of 2tp / (2tp + fp + fn)."""
    conf = pred.groupBy(F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(F.count(F.lit(1)).alias("c"))
    per_class = (
        conf.select(F.explode(F.array(
            F.struct(F.col("y").alias("cls"), F.when(F.col("y") == F.col("yhat"), F.col("c")).otherwise(0).alias("tp"),
                     F.lit(0).cast("long").alias("fp"),
                     F.when(F.col("y") != F.col("yhat"), F.col("c")).otherwise(0).alias("fn")),
            F.struct(F.col("yhat").alias("cls"), F.lit(0).cast("long").alias("tp"),
                     F.when(F.col("y") != F.col("yhat"), F.col("c")).otherwise(0).alias("fp"),
                     F.lit(0).cast("long").alias("fn")))).alias("s"))
        .select("s.*").groupBy("cls").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    )
    f1 = F.coalesce(2 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0)), F.lit(0.0))
    return per_class.agg(F.avg(f1).alias("f1_macro"))


def _splits(df: DataFrame, label: str) -> int:
    return min(5, df.select(label).distinct().count())


def fold_predictions(df: DataFrame, features: Sequence[str], label: str, n_trees: int = 100, seed: int = 42,
                     max_depth: int = 30, key: str = KEY) -> DataFrame:
    """``(key, fold, y, yhat)``: every row predicted once, by the forest of its fold.

    One prepared table with the fold of every row is written; the forests of
    all folds are grown in the same passes, each from the rows of the other
    folds, and each predicts its own."""
    n_splits = _splits(df, label)
    folds = stratified_folds(df, label, n_splits, seed, key).select(key, "fold")
    data = _assemble(df.join(folds, key).select(key, "fold", F.col(label).cast("double").alias("_y"), *features), features)
    rows = forest.prepare(data.select(F.col(key).alias("_key"), "_y", F.col("fold").alias("_out"), F.col("fold").alias("_by"), *features), seed)
    model, binned = forest.fit(rows, features, n_trees, seed, max_depth, n_splits)
    out = _predicted(model, binned, rows).select(F.col("_key").alias(key), F.col("_by").alias("fold"), "y", "yhat")
    return materialize(out, "fold_predictions")


def cross_validate(df: DataFrame, features: Sequence[str], label: str, n_trees: int = 100, seed: int = 42,
                   max_depth: int = 30, key: str = KEY) -> DataFrame:
    """Macro-F1 per stratified fold, plus mean and population std (round 4)."""
    pred = fold_predictions(df, features, label, n_trees, seed, max_depth, key)
    scores = [(f, float(macro_f1(pred.where(F.col("fold") == f)).first()["f1_macro"])) for f in range(_splits(df, label))]
    out = df.sparkSession.createDataFrame(scores, "fold INT, f1 DOUBLE")
    return out.select("fold", round_half_up("f1", 4).alias("f1_macro"),
                      round_half_up(F.avg("f1").over(_all()), 4).alias("cv_mean"),
                      round_half_up(F.stddev_pop("f1").over(_all()), 4).alias("cv_std"))


def _all():
    from pyspark.sql import Window
    return Window.partitionBy(F.lit(0))


def feature_importance(model, features: Sequence[str], spark) -> DataFrame:
    """Impurity importance per feature (round 4), descending."""
    imp = model.importances()
    rows = [(f, float(imp[i]) if i < len(imp) else 0.0) for i, f in enumerate(features)]
    return (spark.createDataFrame(rows, "feature STRING, imp DOUBLE")
            .select("feature", round_half_up("imp", 4).alias("importance"))
            .orderBy(F.col("importance").desc(), "feature"))
