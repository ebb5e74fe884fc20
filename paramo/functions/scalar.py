"""Scalar expressions shared by the operators.

All of them return :class:`pyspark.sql.Column` built from built-in functions,
so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Altitude band edges (metres) and their labels, as the
# analysis reports them.  Edges are exclusive upper bounds; NULL altitude
# falls into the last band.
ALTITUDE_EDGES = (500, 1500, 2500, 3500)
ALTITUDE_BANDS_SHORT = ("Bajo", "Calido", "Templado", "Frio", "Paramo")
ALTITUDE_BANDS_LONG = (
    "Tierras bajas (<500 m)",
    "Piso cálido (500-1500 m)",
    "Piso templado (1500-2500 m)",
    "Piso frío (2500-3500 m)",
    "Páramo (>3500 m)",
)

# Cluster description thresholds (strictly greater than).
RELIEF_RULES = ((2500, "Alta montaña"), (1000, "Zona templada"))
RELIEF_DEFAULT = "Tierra baja"
RAIN_RULES = ((3000, "muy lluvioso"), (1500, "lluvioso"), (700, "moderado"))
RAIN_DEFAULT = "seco"
DESCRIPTION_JOIN = " — régimen "


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def no_neg_zero(c: str | Column) -> Column:
    """Turn -0.0 into 0.0 (``x + 0.0``) so value hashes agree across engines."""
    return _col(c) + F.lit(0.0)


def round_half_up(c: str | Column, digits: int) -> Column:
    """Round half away from zero on the decimal value, as SQL engines print it.

    ``CAST(ROUND(CAST(x AS DECIMAL(28,8)), d) AS DOUBLE)``: the first cast
    fixes the binary representation at 8 decimals so ties round the same way
    in every engine; the result is a DOUBLE without negative zero.
    """
    dec = _col(c).cast("decimal(28,8)")
    return F.round(dec, digits).cast("double") + F.lit(0.0)


def altitude_band(c: str | Column, labels=ALTITUDE_BANDS_SHORT) -> Column:
    """Band label for an altitude column (``<500, <1500, <2500, <3500, else``)."""
    x = _col(c)
    expr = F.when(x < ALTITUDE_EDGES[0], F.lit(labels[0]))
    for edge, label in zip(ALTITUDE_EDGES[1:], labels[1:-1]):
        expr = expr.when(x < edge, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def altitude_order(c: str | Column) -> Column:
    """Ordinal 1..5 of :func:`altitude_band`."""
    return altitude_band(c, labels=(1, 2, 3, 4, 5)).cast("int")


def _threshold_label(x: Column, rules, default: str) -> Column:
    expr = None
    for edge, label in rules:
        expr = F.when(x > edge, F.lit(label)) if expr is None else expr.when(x > edge, F.lit(label))
    return expr.otherwise(F.lit(default))


def cluster_description(mean_altitude: str | Column, mean_rain: str | Column) -> Column:
    """``"<relief> — régimen <rain>"`` from a (rounded) mean altitude and rain.

    A NULL mean counts as 0, as the profile reports a missing feature.
    """
    alt = F.coalesce(_col(mean_altitude), F.lit(0.0))
    rain = F.coalesce(_col(mean_rain), F.lit(0.0))
    return F.concat(
        _threshold_label(alt, RELIEF_RULES, RELIEF_DEFAULT),
        F.lit(DESCRIPTION_JOIN),
        _threshold_label(rain, RAIN_RULES, RAIN_DEFAULT),
    )


def pct_of(part: str | Column, total: str | Column, digits: int = 1) -> Column:
    """``round(100 * part / total, digits)``; NULL when the total is 0."""
    return round_half_up(F.lit(100.0) * _col(part) / F.nullif(_col(total).cast("double"), F.lit(0.0)), digits)
