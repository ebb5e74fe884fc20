"""Helpers shared by the operators: exact column picking and stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paramo.session import ensure_checkpoint_dir

#: ASCII white space as the contracts name it: space and \x09-\x0D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it stands in what ``use`` makes, inner lambdas included."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blocks(items: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of each run of about sqrt(n) items, in order."""
    def runs(a: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(a).cast("double"))).cast("int"), F.lit(1))
        firsts = F.when(F.size(a) > 0, F.sequence(F.lit(1), F.size(a), width)).otherwise(F.array().cast("array<int>"))
        return F.transform(firsts, lambda at: use(F.slice(a, at, width)))

    return let(items, runs)


def _folded(numbers: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each number of an array what ``step`` made of those before it.

    Goes run by run of about sqrt(n) numbers, as an array that grows by one
    is copied each time: n * sqrt(n) copies in all, instead of n * n.  ``step``
    has to be associative, with ``start`` as its neutral number."""
    kind = "struct<at: int, out: array<int>>"

    def within(a: Column) -> Column:
        return F.aggregate(a, F.struct(start.alias("at"), F.array().alias("out")).cast(kind),
                           lambda s, x: F.struct(step(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")).cast(kind))

    def joined(parts: Column) -> Column:
        starts = within(F.transform(parts, lambda p: p["at"]))["out"]
        return F.flatten(F.zip_with(parts, starts, lambda p, at: F.transform(p["out"], lambda x: step(at, x))))

    return let(_blocks(numbers, within), joined)


def running(lengths: Column) -> Column:
    """For each number of an array the sum of those before it."""
    return _folded(lengths, F.lit(0), lambda a, b: a + b)


def highest_before(numbers: Column) -> Column:
    """For each number, none negative, of an array the largest of those before it; 0 for the first."""
    return _folded(numbers, F.lit(0), F.greatest)


def pieces_at(text: Column, spans: Column) -> Column:
    """The pieces ``[start, end)`` of the text, in code points.

    Cuts the text to runs of about sqrt(n) spans first and those to the spans,
    as each cut walks from the start of what it cuts; spans in about ascending
    order keep what a run spans short."""
    def run(some: Column) -> Column:
        ends = F.struct(F.array_min(F.transform(some, lambda s: s["start"])).alias("a"), F.array_max(F.transform(some, lambda s: s["end"])).alias("b"))
        return let(ends, lambda e: let(F.substr(text, e["a"] + 1, e["b"] - e["a"]),
                                       lambda part: F.transform(some, lambda s: F.substr(part, s["start"] - e["a"] + 1, s["end"] - s["start"]))))

    return F.flatten(_blocks(spans, run))


def position(df: DataFrame, name: str) -> int:
    """Index of the column called exactly ``name``; else the one column that differs in case only."""
    exact = [i for i, c in enumerate(df.columns) if c == name]
    found = exact or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if not found or (not exact and len(found) > 1):
        raise ValueError(f"no column {name!r} among {df.columns}")
    return found[0]


def pick(df: DataFrame, **named: str) -> DataFrame:
    """``pick(df, id="doc_id")``: only the named columns, under new names.

    Picks by position, so columns that clash with internal names, differ
    only in case or hold dots cannot make a reference ambiguous."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{position(df, src)}").alias(dst) for dst, src in named.items()])


def numbered(df: DataFrame, **named: str) -> tuple[DataFrame, list[str]]:
    """All columns as ``c0, c1, ..``, plus the named ones again under new names (which never start with ``c``)."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    own = [F.col(f"c{position(df, src)}").alias(dst) for dst, src in named.items()]
    return plain.select("*", *own), plain.columns


def restored(df: DataFrame, like: DataFrame, **replaced: str) -> DataFrame:
    """The numbered columns of ``df`` under the names of ``like``; ``replaced`` maps a name to the column that takes its place."""
    swap = {position(like, name): col for name, col in replaced.items()}
    out = df.select(*[F.col(swap.get(i, f"c{i}")).alias(f"o{i}") for i in range(len(like.columns))])
    return out.toDF(*like.columns)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"


def shared_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a folder that tasks read and write themselves."""
    if uri.startswith("file:") and "://" not in uri:
        uri = uri.replace("file:", "file://", 1)
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


class PlacedFile:
    """A file in a shared folder that appears under its name when it is complete, so a task that runs twice leaves one whole file."""

    def __init__(self, folder: str, name: str):
        self.fs, base = shared_folder(folder)
        self.fs.create_dir(base, recursive=True)
        self.name, self.part = f"{base}/{name}", f"{base}/.{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.part)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.name)


def store(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the real
    size, by which it decides on a broadcast itself."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
