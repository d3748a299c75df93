"""Cleaning of the three raw frames into the typed tables the views read.

One ``select`` per table: every step is a native column expression, so a whole
table is cleaned in a single narrow stage (no shuffle, no Python).
``strict=True`` keeps the source job's behaviour of failing on unparseable text
(ANSI casts); ``strict=False`` turns such values into nulls for quarantine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.scalar import (
    LEAD_DATE_FORMAT,
    parse_invoice_date,
    parse_lead_date,
    parse_meal_ts,
    part_of_day,
    participant_count,
)
from larder.sources.testdomain import ROW_ORDER


def underscore_columns(df: DataFrame) -> DataFrame:
    """Rename every column, replacing spaces with underscores."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def _cast(c: str, type_name: str, strict: bool) -> F.Column:
    return F.col(c).cast(type_name) if strict else F.col(c).try_cast(type_name)


def _extra(df: DataFrame) -> list[str]:
    return [ROW_ORDER] if ROW_ORDER in df.columns else []


def clean_invoices(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Raw invoice text -> typed invoice table (plus derived Part_of_Day and
    Number_of_Participants). Extra ``_row_order`` is carried when present."""
    df = underscore_columns(raw)
    meal_ts = parse_meal_ts("Date_of_Meal", strict)
    return df.select(
        *_extra(df),
        F.col("Order_Id"),
        parse_invoice_date("Date", strict).alias("Date"),
        F.col("Meal_Id"),
        F.col("Company_Id"),
        meal_ts.alias("Date_of_Meal"),
        F.col("Participants"),
        _cast("Meal_Price", "smallint", strict).alias("Meal_Price"),
        F.col("Type_of_Meal"),
        part_of_day(meal_ts).alias("Part_of_Day"),
        participant_count("Participants", strict).alias("Number_of_Participants"),
    )


def clean_leads(raw: DataFrame, date_format: str = LEAD_DATE_FORMAT, strict: bool = True) -> DataFrame:
    """Raw order-lead text -> typed ``orders`` table."""
    df = underscore_columns(raw)
    return df.select(
        *_extra(df),
        F.col("Order_Id"),
        F.col("Company_Id"),
        F.col("Company_Name"),
        parse_lead_date("Date", date_format, strict).alias("Date"),
        _cast("Order_Value", "smallint", strict).alias("Order_Value"),
        _cast("Converted", "smallint", strict).alias("Converted"),
    )


def clean_salesteam(raw: DataFrame) -> DataFrame:
    """Raw sales-team text -> ``salesteam`` table (all text, renamed)."""
    df = underscore_columns(raw)
    return df.select(*_extra(df), "Sales_Rep", "Sales_Rep_Id", "Company_Name", "Company_Id")
