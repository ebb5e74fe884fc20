"""Lineage cuts as written tables in the shared checkpoint folder.

``materialize(df)`` writes ``df`` as parquet under the folder the cluster
names in ``spark.checkpoint.dir`` and returns a DataFrame reading it back.
Compared with keeping a long plan alive this

* survives executor loss (the table is on shared storage; a lost task
  re-reads it instead of re-running the chain),
* freezes non-deterministic columns (partition ids, positions) once,
* hands later plans a plain parquet leaf with real size statistics, so the
  optimizer neither re-derives the upstream filters nor guesses sizes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from paramo.session import ensure_checkpoint_dir

_written: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder, which :func:`release` deletes too."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/paramo-{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the tables this process has materialised so far; call it when no result that reads them is needed any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone
