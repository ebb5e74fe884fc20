"""Scalar column builders (JVM-side expressions, no Python UDFs)."""

from paramo.functions.scalar import (
    ALTITUDE_BANDS_LONG,
    ALTITUDE_BANDS_SHORT,
    altitude_band,
    altitude_order,
    cluster_description,
    no_neg_zero,
    pct_of,
    round_half_up,
)

__all__ = [
    "ALTITUDE_BANDS_LONG",
    "ALTITUDE_BANDS_SHORT",
    "altitude_band",
    "altitude_order",
    "cluster_description",
    "no_neg_zero",
    "pct_of",
    "round_half_up",
]
