"""Scalar cleaning expressions.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; none of them needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Text formats of the source files (day-month-year dates, ISO
# meal timestamps; one- or two-digit fields accepted, as strptime does), the
# participant-name pattern and the hour bands of the part-of-day buckets
# (inclusive hour ranges, the last label takes every other hour and a missing
# time).
# ---------------------------------------------------------------------------
INVOICE_DATE_FORMAT = "d-M-yyyy"
MEAL_TS_FORMAT = "yyyy-M-d H:m:s"
LEAD_DATE_FORMAT = "yyyy-M-d"
OFFSET_SEPARATOR = "+"
NAME_PATTERN = "'(.*?)'"
PART_OF_DAY_BANDS = [
    (5, 8, "Early Morning"),
    (9, 12, "Late Morning"),
    (13, 15, "Early Afternoon"),
    (16, 19, "Evening"),
    (20, 23, "Night"),
]
PART_OF_DAY_OTHERWISE = "Late Night"
MEAL_SORT_ORDER = ["Breakfast", "Lunch", "Dinner"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_invoice_date(c: str | Column, strict: bool = True) -> Column:
    """Invoice ``Date`` text (day-month-year) to ``date``.

    ``strict`` raises on text that does not match (ANSI), otherwise yields null.
    """
    if strict:
        return F.to_date(_col(c), INVOICE_DATE_FORMAT)
    return F.try_to_date(_col(c), INVOICE_DATE_FORMAT)


def parse_lead_date(c: str | Column, fmt: str = LEAD_DATE_FORMAT, strict: bool = True) -> Column:
    """Lead ``Date`` text to ``date`` with a configured format (default ISO)."""
    return F.to_date(_col(c), fmt) if strict else F.try_to_date(_col(c), fmt)


def strip_offset(c: str | Column) -> Column:
    """Keep the text before the first ``+``: the zone offset is dropped, not applied."""
    return F.substring_index(_col(c), OFFSET_SEPARATOR, 1)


def parse_meal_ts(c: str | Column, strict: bool = True) -> Column:
    """``Date of Meal`` text to a wall-clock ``timestamp_ntz`` (offset dropped)."""
    text = strip_offset(c)
    parsed = F.to_timestamp_ntz(text, F.lit(MEAL_TS_FORMAT))
    if strict:
        return parsed
    # validity from the zoned parser (same pattern rules), value from the
    # zone-free one, so a wall-clock time in a DST gap is never shifted
    return F.when(F.try_to_timestamp(text, F.lit(MEAL_TS_FORMAT)).isNotNull(), parsed)


def meal_hour(ts: str | Column) -> Column:
    return F.hour(_col(ts))


def part_of_day(ts: str | Column) -> Column:
    """Six-label bucket of the hour of day."""
    hour = meal_hour(ts)
    expr = None
    for lo, hi, label in PART_OF_DAY_BANDS:
        cond = hour.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(PART_OF_DAY_OTHERWISE))


def quote_count(c: str | Column) -> Column:
    """Number of single-quote characters in the text."""
    return F.regexp_count(_col(c), F.lit("'"))


def participant_count(c: str | Column, strict: bool = True) -> Column:
    """Quote characters divided by two, truncated (an odd count rounds down).

    The target column is a TINYINT: over 127 raises under ``strict`` (ANSI cast),
    otherwise gives null (and ``check_range`` reports it).
    """
    half = F.shiftright(quote_count(c), 1)
    return half.cast("tinyint") if strict else half.try_cast("tinyint")


def extract_names(c: str | Column) -> Column:
    """All non-greedy ``'...'`` matches, group 1, in text order.

    ``(?d)`` makes ``\\n`` the only line terminator, so ``.`` also matches ``\\r``
    and Unicode line separators, as Python's ``re`` does.
    """
    return F.regexp_extract_all(_col(c), F.lit("(?d)" + NAME_PATTERN), 1)


def meal_order(c: str | Column) -> Column:
    """Position of the meal type in the fixed sort list; 0 for unknown or null."""
    arr = F.array(*[F.lit(m) for m in MEAL_SORT_ORDER])
    return F.coalesce(F.array_position(arr, _col(c)), F.lit(0)).cast("int")
