"""Target-schema enforcement before a table is written (column order and types)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Select the schema's columns in order, cast to its types.

    ``strict`` uses ANSI casts, so a value that does not fit (e.g. a price over
    the SMALLINT range) fails the load as the original database would;
    ``strict=False`` nulls it instead. Nullability is checked separately
    (``larder.operators.quality``).
    """
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if df.schema[f.name].dataType != f.dataType:
            c = c.cast(f.dataType) if strict else c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def with_collation(df: DataFrame, collation: str = "UNICODE_CI_AI", columns: list[str] | None = None) -> DataFrame:
    """Cast text columns to a collated string type.

    The original database compares text case- and accent-insensitively by default,
    so ``Ann Lee`` and ``ann lee`` form one group there. Applying this to the
    published tables before building the views gives the same grouping and join
    semantics (``UTF8_LCASE`` ignores case only). Customer ids are assigned
    before this step and stay case-sensitive, as in the original job. Grouping
    on a collated key runs as a sort aggregate; the default binary comparison
    keeps hash aggregation.
    """
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    }
    return df.select(*[
        F.col(f.name).cast(f"string collate {collation}").alias(f.name) if f.name in targets else F.col(f.name)
        for f in df.schema.fields
    ])
