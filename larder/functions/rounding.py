"""Exact half-up averages and percentages.

Doubles are never rounded (``round(1.005, 2)`` differs between engines); the
quotient is rounded in integer arithmetic (SQL ``div``) and only the final value
becomes a double. ``AVG`` of integers keeps four decimals; ``ROUND(AVG(x), 2)``
rounds straight to two from the exact quotient. Ties go away from zero.

Arguments are the names of already-aggregated columns (a sum of either sign and
a count); the arithmetic is exact for any ``long`` sum and count. The final double
is the correctly rounded value while the scaled result is below 2^53 (averages
up to about 9·10^11 at four decimals); beyond that the integer-to-double step
rounds once more, the same way the SQL oracle does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _scaled(total: str, count: str, digits: int, factor: int = 1) -> str:
    """SQL text of ``round_half_up(factor * total / count * 10^digits)`` as ``decimal(38,0)``.

    The magnitude is rounded and gets its sign back. Split into quotient and remainder so no intermediate leaves its type:
    ``q = S div N`` and ``r = S - q*N`` are exact, the rounded fraction
    ``(2k*r + N) div 2N`` lies in ``[0, k]``, and the result ``q*k + fraction`` is
    assembled in ``decimal(38,0)``.
    """
    k = 10 ** digits
    big = f"(abs(cast(`{total}` as decimal(38,0))) * {factor})"
    n = f"nullif(cast(`{count}` as bigint), 0)"
    q = f"({big} div {n})"
    r = f"({big} - cast({q} as decimal(38,0)) * {n})"
    frac = f"((2 * {k} * {r} + {n}) div (2 * {n}))"
    return f"((cast({q} as decimal(38,0)) * {k} + {frac}) * case when `{total}` < 0 then -1 else 1 end)"


def avg_sql(total: str, count: str, digits: int = 4) -> str:
    """SQL text of ``total / count`` rounded half up to ``digits`` decimals, as a double."""
    return f"cast({_scaled(total, count, digits)} as double) / {10 ** digits}.0"


def percent_sql(total: str, count: str, digits: int = 2) -> str:
    """SQL text of ``ROUND(total / count * 100, digits)``."""
    return f"cast({_scaled(total, count, digits, factor=100)} as double) / {10 ** digits}.0"


def avg_half_up(total: str, count: str, digits: int = 4) -> Column:
    """``total / count`` rounded half up to ``digits`` decimals, as a double."""
    return F.expr(avg_sql(total, count, digits))


def round2_of_avg(total: str, count: str) -> Column:
    """``ROUND(AVG(x), 2)``, from the exact quotient."""
    return avg_half_up(total, count, 2)


def percent_half_up(total: str, count: str, digits: int = 2) -> Column:
    """``ROUND(total / count * 100, digits)`` of a sum and a count."""
    return F.expr(percent_sql(total, count, digits))
