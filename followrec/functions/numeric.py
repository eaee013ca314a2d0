"""Exact fixed-point helpers for weights.

A weight is carried as ``w8``: the weight times 10^8, rounded, as bigint. That
is exactly the 8-decimal text the pipeline publishes, and sums of ``w8`` are
exact, so a ranking never depends on the order doubles were added in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

SCALE = 100_000_000
WEIGHT_TYPE = DecimalType(18, 8)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round8(sum_rem_col: str, lookback_seconds: int) -> Column:
    """round_half_up(sum_rem / L, 8 decimals) * 10^8, for sum_rem >= 0.

    Split into quotient and remainder so no intermediate overflows a bigint:
    sum_rem = q * L + r, r < L  =>  w8 = q * 10^8 + round(r * 10^8 / L).
    """
    s, L = f"`{sum_rem_col}`", int(lookback_seconds)
    return F.expr(f"({s} div {L}) * {SCALE} + (({s} % {L}) * {SCALE} + {L // 2}) div {L}")


def weight_decimal(w8) -> Column:
    """w8 to DECIMAL(18,8) (the published weight type)."""
    return (_c(w8).cast(DecimalType(18, 0)) / F.lit(SCALE)).cast(WEIGHT_TYPE)


def fixed8_text(w8) -> Column:
    """'%.8f' text of the weight, from the exact integer form."""
    return weight_decimal(w8).cast("string")


def text_to_w8(text) -> Column:
    """Trimmed decimal text back to w8 (inverse of fixed8_text)."""
    return (F.trim(_c(text)).cast(DecimalType(28, 8)) * F.lit(SCALE)).cast("bigint")
