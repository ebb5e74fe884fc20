"""Wide station x month "normals" table (A2).

* :func:`read_normals` — CSV with header (UTF-8) or parquet.  The workbook
  input of the original application is re-aimed as CSV/Parquet.
* :func:`normals_from_tpch` — the wide table derived from the TPC-H-shaped
  test tables (part -> station, monthly lineitem quantity -> rainfall).

Both return raw columns; cleaning is :mod:`paramo.operators.clean`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Month columns and base numeric columns of the wide table.
MESES = ["ENE", "FEB", "MAR", "ABR", "MAY", "JUN", "JUL", "AGO", "SEP", "OCT", "NOV", "DIC"]
COLUMNAS_BASE = ["ALTITUD_m", "LATITUD", "LONGITUD", "ANUAL"]
KEY = "id_fila"


def read_normals(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read the wide table: CSV (header, UTF-8) or parquet.

    CSV columns are texts, which B3 makes numbers, but for the row key: where
    the table has one it is a whole number (a BIGINT), whatever the source."""
    if fmt == "csv":
        raw = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    return raw.withColumn(KEY, F.trim(F.col(KEY).cast("string")).cast("long")) if KEY in raw.columns else raw


def normals_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide table from ``part`` and ``lineitem`` (one row per part with sales).

    One aggregate over lineitem keyed by part (partial aggregation before the
    shuffle) gives the annual total and each month's total; the join to part
    reuses that hash partitioning on the key.
    """
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    m = F.month("l_shipdate")
    monthly = [F.sum(F.when(m == i + 1, F.col("l_quantity"))).alias(f"_m{i + 1}") for i in range(12)]
    per_part = (lineitem.groupBy(F.col("l_partkey").alias("k"))
                .agg(F.sum("l_quantity").alias("_total"), *monthly))
    regime = (1 + F.col("p_partkey") % 3)
    return (
        part.join(per_part, F.col("p_partkey") == F.col("k"))
        .select(
            F.col("p_partkey").alias(KEY),
            F.col("p_name").alias("ESTACION"),
            F.col("p_brand").alias("DEPARTAMENTO"),
            F.lit("PRECIPITACIÓN").alias("PARAMETRO"),
            (F.col("p_size") * 80).cast("double").alias("ALTITUD_m"),
            ((F.col("p_partkey") % 17).cast("double") - 4).alias("LATITUD"),
            (F.lit(-79.0) + (F.col("p_partkey") % 13).cast("double")).alias("LONGITUD"),
            (F.col("_total") * regime).alias("ANUAL"),
            *[(F.col(f"_m{i + 1}") * regime).alias(name) for i, name in enumerate(MESES)],
        )
    )
