"""Frames with the cases that every operator has to stand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def messy(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns under names that operators use inside."""
    rows = [
        (1, "The cat sat on the mat and the dog ran over the hill to the sea.", "en", "a", 60),
        (1, "The cat sat on the mat and the dog ran over the hill to the sea.", "en", "a", 60),
        (2, "the cat sat on the mat and the dog ran over the hill to the sea. ", None, "a", None),
        (None, "Der Hund und die Katze sind mit dem Ball in den Garten gelaufen.", "de", None, 64),
        (None, "Der Hund und die Katze sind mit dem Ball in den Garten gelaufen.", "de", None, 64),
        (3, None, "en", "b", 0),
        (4, "", "en", "b", 0),
        (5, " \t\n", None, "b", 3),
        (6, "12345 --- 678", "de", "b", 13),
        (7, "long words here " * 20_000, "en", "c", 320_000),
        (8, "x" * 200_000, None, "c", 200_000),
        (None, None, None, None, None),
        (-9, "\x00odd\x1f́ signs ퟿ \U0001f600 ÄÖ", "fr", "b", 20),
    ]
    out = spark.createDataFrame(rows, SCHEMA)
    for extra in ("id", "txt", "fp", "h", "norm", "row", "shard", "slot", "copies", "rate", "size", "component_id", "lang_pred", "score", "c0", "a.b"):
        out = out.withColumn(extra, out["n_chars"])
    return out


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def documents(spark: SparkSession, sf: str = MEDIUM) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")
