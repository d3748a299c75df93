"""Data-quality summaries of the raw frames: missing values, types, repeated rows.

Each summary is one aggregation pass per table (``count_if`` per column, or a
group-by over all columns), so the work is distributed and only a handful of
summary rows reach the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.sources.testdomain import ROW_ORDER


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ROW_ORDER]


def missing_counts(df: DataFrame, table_name: str) -> DataFrame:
    """(table_name, column_name, missing): nulls per column, one pass over the table."""
    cols = _data_columns(df)
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.unpivot(
        [], cols, "column_name", "missing"
    ).select(F.lit(table_name).alias("table_name"), "column_name", "missing")


def profile_nulls(frames: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [missing_counts(df, n) for n, df in frames.items()])


def duplicate_rows(df: DataFrame, table_name: str) -> DataFrame:
    """(table_name, duplicates): rows identical to an earlier row (nulls compare equal).

    First the rows' 64-bit hashes are counted (partially before the shuffle, so
    a row repeated very many times collapses); whole rows are compared only where
    a hash occurs more than once.
    """
    cols = _data_columns(df)
    hashed = df.select(F.xxhash64(*cols).alias("_hash"), *cols)
    again = hashed.groupBy("_hash").count().filter(F.col("count") > 1).select("_hash")
    counts = hashed.join(again, "_hash", "left_semi").groupBy(*cols).count()
    return counts.agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicates")
    ).select(F.lit(table_name).alias("table_name"), "duplicates")


def profile_duplicates(frames: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [duplicate_rows(df, n) for n, df in frames.items()])


# ---------------------------------------------------------------------------
# The bits of the value kinds, and the column type of each set of
# kinds that is more than plain text. The kinds of a column are joined with OR, so
# the join is the same in whatever order parts of the table are merged.
# ---------------------------------------------------------------------------
INTEGER, DECIMAL, DATE, TIMESTAMP, TEXT = 1, 2, 4, 8, 16
COLUMN_TYPES = {
    0: "empty",
    INTEGER: "integer",
    DECIMAL: "decimal", INTEGER | DECIMAL: "decimal",
    DATE: "date",
    TIMESTAMP: "timestamp", DATE | TIMESTAMP: "timestamp",
}
_INTEGER = r"^[+-]?[0-9]{1,18}$"
_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_DAY_FIRST = r"^[0-9]{2}-[0-9]{2}-[0-9]{4}$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"


def value_kind(c: Column) -> Column:
    """Bit of the narrowest kind that the text of a value has; 0 for a missing one.

    A date or timestamp must exist in the calendar; the time zone is not applied.
    """
    date = c.rlike(_ISO_DATE) & F.try_to_date(c, "yyyy-MM-dd").isNotNull()
    day_first = c.rlike(_DAY_FIRST) & F.try_to_date(c, "dd-MM-yyyy").isNotNull()
    wall_clock = F.concat(F.substring(c, 1, 10), F.lit(" "), F.substring(c, 12, 8))
    timestamp = c.rlike(_TIMESTAMP) & F.try_to_timestamp(wall_clock, F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()
    return (
        F.when(c.isNull(), 0).when(c.rlike(_INTEGER), INTEGER).when(c.rlike(_DECIMAL), DECIMAL)
        .when(date | day_first, DATE).when(timestamp, TIMESTAMP).otherwise(TEXT)
    )


def column_types(df: DataFrame, table_name: str) -> DataFrame:
    """(table_name, column_name, column_type): the type that every value of a column has, one pass over the table."""
    cols = _data_columns(df)
    kinds = df.agg(*[F.coalesce(F.bit_or(value_kind(F.col(f"`{c}`").cast("string"))), F.lit(0)).alias(c) for c in cols])
    named = F.create_map(*[x for bits, name in COLUMN_TYPES.items() for x in (F.lit(bits), F.lit(name))])
    return kinds.unpivot([], [F.col(f"`{c}`") for c in cols], "column_name", "bits").select(
        F.lit(table_name).alias("table_name"), "column_name", F.coalesce(F.try_element_at(named, F.col("bits")), F.lit("text")).alias("column_type")
    )


def profile_types(frames: dict[str, DataFrame]) -> DataFrame:
    """The column types that the values of all-text frames have."""
    return reduce(DataFrame.unionByName, [column_types(df, n) for n, df in frames.items()])


def declared_types(frames: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    """(table, column, type) from the schemas: metadata only, no job runs."""
    return [(n, c, t) for n, df in frames.items() for c, t in df.dtypes if c != ROW_ORDER]
