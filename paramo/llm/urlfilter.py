"""Operator 8, URL filter: rules of hosts and paths, and a classifier for the rest.

The classifier is a logistic regression on hashed character n-grams of host
and path, fitted on a labelled table of URLs.  At most ``most`` labelled rows
are used (those with the smallest hashes); all URLs are judged.

Main path: DataFrame and ML functions of the JVM only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paramo.llm.common import pick, store

#: Labelled rows that a model is fitted on, at most; hashed features; lengths of n-grams.
MOST, FEATURES, GRAMS = 20_000, 1 << 14, (3, 4, 5)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_after(url), r"\A([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Then up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(_after(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct ``(rule, verdict)`` of the longest rule ``(verdict, host, path)`` that fits, or null.

    A rule fits its host and that host's subdomains if the path starts with
    the rule's; of equally long ones the longer host wins, then the first."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, h, p in sorted(reversed(rules), key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(host: Column, path: Column, sizes: Sequence[int] = GRAMS) -> Column:
    """Character n-grams of ``^host$`` and ``^path$``, marked by where they come from."""
    def of(mark: str, s: Column, n: int) -> Column:
        s = F.concat(F.lit("^"), s, F.lit("$"))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - n + 1, F.lit(1))), lambda i: F.concat(F.lit(mark), F.substr(s, i, F.lit(n))))

    return F.concat(*[of(mark, s, n) for mark, s in (("h", host), ("p", path)) for n in sizes])


class NoLabelledUrl(ValueError):
    """Nothing to fit a model on."""


def fit(labelled: DataFrame, url: str = "url", label: str = "label", most: int = MOST, features: int = FEATURES):
    """A model from labelled URLs (label 1: block, 0: allow); rows without label or url are left out.

    Raises NoLabelledUrl if no labelled row is left.  The ``most`` rows with the
    smallest hashes of the URL are used; repeated rows count once."""
    rows = pick(labelled, url=url, label=label).where("url IS NOT NULL AND label IS NOT NULL").distinct()
    bounded = rows.orderBy(F.xxhash64("url"), "url", "label").limit(most)
    ready = store(bounded.select(grams(host_of(F.col("url")), path_of(F.col("url"))).alias("grams"), F.col("label").cast("double").alias("label")).coalesce(4), "url-labelled")
    if ready.first() is None:
        raise NoLabelledUrl("no labelled URL")
    hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=features, binary=True)
    return Pipeline(stages=[hashing, LogisticRegression(maxIter=40, regParam=1e-3, standardization=False)]).fit(ready)


def judge(pages: DataFrame, model, rules: Sequence[tuple[str, str, str]] = (), key: str = "page_id", url: str = "url", threshold: float = 0.5, default: str = "allow") -> DataFrame:
    """``(key, host, path, rule, verdict, p_block)`` for every row of ``pages``.

    The verdict is the longest fitting rule's, else block where the model's
    probability is above ``threshold``; without a model (None) it is
    ``default``, and p_block is null.  A null URL has empty host and path
    and is judged like any; repeated rows are judged alike; an empty table
    gives an empty result.  Other columns are not read."""
    rows = pick(pages, id=key, url=url).select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if model is None:
        scored, guess = rows.withColumn("p_block", F.lit(None).cast("double")), F.lit(default)
    else:
        scored = model.transform(rows.withColumn("grams", grams(F.col("host"), F.col("path")))).withColumn("p_block", vector_to_array("probability")[1])
        guess = F.when(F.col("p_block") > threshold, "block").otherwise("allow")
    ruled = scored.withColumn("fit", matched_rule(F.col("host"), F.col("path"), rules))
    return ruled.select(F.col("id").alias(key), "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", guess).alias("verdict"), "p_block")
