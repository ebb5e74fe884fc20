"""Session helpers: a local session for tests/bench and the checkpoint folder rule."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "paramo") -> SparkSession:
    """A local session configured the way the tests and the bench expect.

    On a cluster the caller builds its own session; every operator only
    relies on ``spark.sql.adaptive.enabled`` being on (the default).
    """
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PARAMO_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The folder comes from ``spark.checkpoint.dir``.  Only on a local master a
    fresh scratch folder stands in when it is unset; on a cluster a folder of
    the driver's machine would not be seen by the executors, so that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: it has to name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="paramo-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
