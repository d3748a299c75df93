"""Date format of a text column, by a vote over all its values.

The source job lets its reader guess the format of the lead dates. Here one pass
counts for every candidate how many values it parses, and one format is taken for
the whole column: the first candidate, in order of preference, that parses all. If
another one parses all as well (days up to 12 only), the choice is ambiguous, which
is reported. A column that no candidate parses completely is mixed; that is an
error, never a guess row by row.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger("larder.dates")

# ---------------------------------------------------------------------------
# Candidate formats in order of preference (year first, then month
# first, as the source job's reader has it, then day first).
# ---------------------------------------------------------------------------
CANDIDATES = ["yyyy-M-d", "yyyy/M/d", "yyyyMMdd", "M/d/yyyy", "M-d-yyyy", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy"]


def format_votes(df: DataFrame, column: str = "Date", candidates: list[str] = CANDIDATES) -> DataFrame:
    """(preference, date_format, parsed, filled, chosen, ambiguous), one row a candidate, from one pass over the column."""
    text = F.col(f"`{column}`")
    counts = [F.count_if(F.try_to_date(text, f).isNotNull()).alias(f"_{k}") for k, f in enumerate(candidates)]
    row = df.agg(F.count(text).alias("filled"), *counts)
    votes = F.array(*[F.col(f"_{k}") for k in range(len(candidates))])
    row = row.select("filled", votes.alias("votes")).select("*", F.transform("votes", lambda v: v == F.col("filled")).alias("whole"))
    row = row.select("*", F.array_position("whole", True).alias("first"), F.size(F.filter("whole", lambda w: w)).alias("fitting"))
    names = F.array(*[F.lit(f) for f in candidates])
    each = row.select("filled", "first", "fitting", F.posexplode(F.arrays_zip(names.alias("name"), F.col("votes").alias("parsed"))).alias("k", "v"))
    chosen = F.col("first") == F.col("k") + 1
    return each.select(
        (F.col("k") + 1).alias("preference"), F.col("v.name").alias("date_format"), F.col("v.parsed").alias("parsed"), "filled",
        chosen.alias("chosen"), (chosen & (F.col("fitting") > 1) & (F.col("filled") > 0)).alias("ambiguous"),
    )


def infer_format(df: DataFrame, column: str = "Date", candidates: list[str] = CANDIDATES, mixed: bool = False) -> str:
    """The format of the whole column. Mixed columns raise, unless ``mixed``: then the format of most values is taken."""
    rows = sorted(format_votes(df, column, candidates).collect())  # one row a candidate
    for r in rows:
        if r.chosen:
            if r.ambiguous:
                others = [o.date_format for o in rows if o.parsed == o.filled and o is not r]
                log.warning("%s: taken as %s, but every value also parses as %s", column, r.date_format, ", ".join(others))
            return r.date_format
    if mixed:
        return max(rows, key=lambda r: (r.parsed, -r.preference)).date_format
    found = ", ".join(f"{r.date_format}: {r.parsed}" for r in rows if r.parsed)
    raise ValueError(f"{column}: no date format parses all {rows[0].filled} values ({found or 'none parses any'})")
