"""Ratios and fixed-scale rounding.

Rates stored in the KPI table are DECIMAL(p,s) with half-up rounding of the
exact quotient.  Spark's decimal division keeps at most 38 digits and would
round twice (once at its own scale, once to ours), so the quotient of two
integer counts is rounded exactly with integer arithmetic instead:

    round_half_up(n / d, s) = ((n * 10^s * 2 + d) div (2 d)) / 10^s   for n, d >= 0
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_ratio(num: str, den: str, scale: int, precision: int, times: int = 1) -> Column:
    """DECIMAL(precision, scale) of times * num / den, half-up, num/den non-negative
    integer columns (given by name).  den = 0 gives null (callers coalesce)."""
    k = 2 * times * (10 ** scale)
    q = F.expr(f"CASE WHEN {den} > 0 THEN ({num} * {k} + {den}) div ({den} * 2) END")
    unit = F.lit(Decimal(1).scaleb(-scale)) if scale else F.lit(Decimal(1))
    return (q.cast("decimal(20,0)") * unit).cast(f"decimal({precision},{scale})")


def pct(num, den) -> Column:
    """num / den * 100 as double; den = 0 gives 0 (never a division error)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.when(den > 0, num.cast("double") / den.cast("double") * F.lit(100.0)).otherwise(F.lit(0.0))


def round_half_even(c, digits: int = 1) -> Column:
    """numpy-style rounding: rint(x * 10^d) / 10^d (ties to even)."""
    c = F.col(c) if isinstance(c, str) else c
    k = float(10 ** digits)
    return F.bround(c * F.lit(k), 0) / F.lit(k)
