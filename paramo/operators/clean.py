"""Ingest and cleaning of the wide table.

The "keep the filtered rows only if enough remain" rules (B2, B5) decide on
one distributed ``count`` whose single number comes back to the driver; the
rows themselves never leave the executors, and no cross join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paramo.functions import altitude_band  # noqa: F401  (B8 lives in functions)
from paramo.sources.normals import COLUMNAS_BASE, KEY, MESES

#: Plain and scientific decimal notation, and the words for infinity and not-a-number.
NUMBER = r"(?i)[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|[+-]?inf(inity)?|nan"
CORE = ["ALTITUD_m", "LATITUD", "LONGITUD", "ANUAL"]


def clean_name(name: str) -> str:
    return name.strip().replace(" ", "_").replace("(", "").replace(")", "")


def clean_columns(df: DataFrame) -> DataFrame:
    """B1: strip names, spaces -> ``_``, drop parentheses."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def _matches(column: str, text: str) -> Column:
    return F.coalesce(F.lower(F.col(column)).contains(text.lower()), F.lit(False))


def filter_min_support(df: DataFrame, column: str = "PARAMETRO", text: str = "PRECIP",
                       min_rows: int = 100, n_match: int | None = None) -> DataFrame:
    """B2: keep rows whose ``column`` contains ``text`` (case-insensitive, NULL
    never matches) when at least ``min_rows`` match; otherwise keep all rows.
    No-op when the column is absent.  A caller that has counted the matches
    passes them as ``n_match``."""
    if column not in df.columns:
        return df
    match = _matches(column, text)
    if n_match is None:
        n_match = df.where(match).count()
    return df.where(match) if n_match >= min_rows else df


def coerce_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The named (default: base + month) columns as DOUBLE, non-numbers -> NULL.

    Numeric columns are cast; texts count as numbers only when the whole
    trimmed text is one (``1d`` or ``0x1p3`` are not)."""
    cols = [c for c in (columns if columns is not None else MESES + COLUMNAS_BASE) if c in df.columns]

    def number(c: str) -> Column:
        if isinstance(df.schema[c].dataType, T.NumericType):
            return F.col(c).cast("double")
        text = F.trim(F.col(c).cast("string"))
        return F.when(F.regexp_like(text, F.lit(f"^({NUMBER})$")), text.try_cast("double"))

    return df.withColumns({c: number(c) for c in cols})


def resolve_features(df: DataFrame) -> list[str]:
    """Base columns then months, those present, in that order."""
    return [c for c in COLUMNAS_BASE + MESES if c in df.columns]


def _valid(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(F.col(c))


def _all_valid(cols: Sequence[str]) -> Column:
    """One opaque predicate ``#missing == 0`` (NULL or NaN counts as missing).

    A single arithmetic test rather than a conjunction of 2 x len(cols)
    terms: the optimizer then carries one constraint instead of re-deriving
    dozens through every later projection.
    """
    if not cols:
        return F.lit(True)
    missing = sum((F.when(_valid(c), F.lit(0)).otherwise(F.lit(1)) for c in cols), F.lit(0))
    return missing == 0


def drop_incomplete(df: DataFrame, features: Sequence[str] | None = None,
                    min_rows: int = 50, n_complete: int | None = None) -> DataFrame:
    """Drop rows missing a core feature; then drop rows missing any feature
    only if at least ``min_rows`` complete rows remain.  NaN counts as missing.
    A caller that has counted the complete rows passes them as ``n_complete``."""
    feats = list(features) if features is not None else resolve_features(df)
    base = df.where(_all_valid([c for c in CORE if c in df.columns]))
    complete = _all_valid(feats)
    if n_complete is None:
        n_complete = base.where(complete).count()
    return base.where(complete) if n_complete >= min_rows else base


def with_row_key(df: DataFrame, key: str = KEY) -> DataFrame:
    """A unique row key.  Keeps an existing business key; otherwise the
    row's rank by content hash, 0 to n - 1: independent of partitioning and row
    order, and different for equal rows.  The numbered table is written once."""
    if key in df.columns:
        return df
    from paramo.operators.ranking import global_rank
    columns = [F.col(c) for c in df.columns]
    hashed = df.withColumns({"_g": F.lit(0), "_h1": F.xxhash64(*columns), "_h2": F.xxhash64(F.lit(1), *columns)})
    return global_rank(hashed, ["_g"], ["_h1", "_h2"], key).drop("_g", "_h1", "_h2")


def find_column(df: DataFrame, text: str = "DEPART") -> str | None:
    """First column whose upper-cased name contains ``text``."""
    return next((c for c in df.columns if text in c.upper()), None)


def clean_normals(df: DataFrame, materialize: bool = False) -> DataFrame:
    """B1 -> B2 -> B3 -> B5 -> B6, the ingest chain of the analysis.

    Both keep-all decisions come from one aggregate, of which three numbers
    reach the driver; the result is lazy, so an aggregate over it reads the
    columns it needs and writes nothing.  A caller that reads the table many
    times asks for ``materialize``: it is then written once to the shared
    checkpoint folder."""
    from paramo.plans.materialize import materialize as _write
    out = coerce_numeric(clean_columns(df))
    complete = _all_valid([c for c in CORE if c in out.columns]) & _all_valid(resolve_features(out))
    match = _matches("PARAMETRO", "PRECIP") if "PARAMETRO" in out.columns else F.lit(True)
    n = out.agg(F.count_if(match).alias("matching"), F.count_if(match & complete).alias("both"),
                F.count_if(complete).alias("complete")).first()
    kept = filter_min_support(out, n_match=n["matching"])
    out = with_row_key(drop_incomplete(kept, n_complete=n["complete"] if kept is out else n["both"]))
    return _write(out, "normals") if materialize else out
