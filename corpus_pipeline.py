"""The corpus pipeline: STAGES applied in turn to ``documents``.

Nulls, empty texts, ties and repeated rows are treated as the operators'
docstrings tell; extra columns pass through; every stage leaves an empty table empty.

Each stage takes (spark, docs, sf_dir) and returns the rows that go on, with
the columns of ``documents`` (the last one adds the shard).  ``run`` writes
each stage's rows as parquet in the shared folder and rereads them for the
next, so a lost executor costs the current stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paramo.llm import decontam, langid, mixing, sharding, simhash
from paramo.llm.common import store
from paramo.llm.queries import RADIUS, SHARDS, SHINGLE


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (3): documents go whose language the classifier rejects."""
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (4): the document with the smallest id of each group stays."""
    return simhash.keep_one(docs, shingle=SHINGLE, radius=RADIUS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (9): spans of test items are cut out; documents that are mostly such spans go."""
    clean = decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights (10): each document as often as the mix takes it."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding (6): every row with the shard that it goes to."""
    return sharding.with_shard(docs, SHARDS)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The stages classify by compressed size and link fingerprints transitively, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
