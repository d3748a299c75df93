"""Column types from the values, and the date format of a column by a vote."""

import datetime as dt
import random

import pytest

from larder.operators import dates, profiling
from tests.fixtures import raw_sources

KINDS = {
    "integer": ["1", "-20", "+3", "0007"],
    "decimal": ["1.5", "-.5", "3.", "1e9", "12345678901234567890"],
    "date": ["2016-02-29", "29-02-2016"],
    "timestamp": ["2016-02-29 10:00:00", "2016-05-31T07:00:00+02:00", "2016-05-31 07:00:00.25Z"],
    "text": ["x", "2015-02-29", "31-11-2016", "2016-05-31 25:00:00", " 1", "1,5", "é", ""],
}
JOINS = {
    ("integer", "decimal"): "decimal", ("date", "timestamp"): "timestamp", ("integer", "date"): "text", ("decimal", "timestamp"): "text",
    ("date", "text"): "text", ("integer", "text"): "text",
}


def _type_of(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "`a b` string").repartition(parts)
    return profiling.column_types(df, "t").first().column_type


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_each_kind(spark, kind):
    for v in KINDS[kind]:
        assert _type_of(spark, [None, v], 1) == kind, v
    assert _type_of(spark, [*KINDS[kind], None] * 3) == kind


@pytest.mark.parametrize("pair", sorted(JOINS))
def test_joins_do_not_depend_on_order_or_partitioning(spark, pair):
    values = [v for k in pair for v in KINDS[k]] + [None]
    for seed in range(2):
        random.Random(seed).shuffle(values)
        assert _type_of(spark, values, 1 + 4 * seed) == JOINS[pair]


def test_columns_without_values_are_empty(spark):
    assert _type_of(spark, [None, None]) == "empty" and _type_of(spark, []) == "empty"


def test_types_of_the_sources(spark):
    got = {(r.table_name, r.column_name): r.column_type for r in profiling.profile_types(raw_sources(spark).as_dict()).collect()}
    assert got["invoices", "Date"] == "date" and got["invoices", "Date of Meal"] == "timestamp" and got["invoices", "Meal Price"] == "integer"
    assert got["invoices", "Participants"] == "text" and got["orderleads", "Converted"] == "integer" and len(got) == 18


def _column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "Date string")


def test_one_format_is_found_for_the_whole_column(spark):
    days = [dt.date(2016, 1, 28) + dt.timedelta(days=k) for k in range(40)]
    for fmt, text in (("yyyy-M-d", "%Y-%m-%d"), ("yyyy/M/d", "%Y/%m/%d"), ("yyyyMMdd", "%Y%m%d"), ("M/d/yyyy", "%m/%d/%Y"), ("d/M/yyyy", "%d/%m/%Y"), ("d.M.yyyy", "%d.%m.%Y")):
        assert dates.infer_format(_column(spark, [None, *(d.strftime(text) for d in days)])) == fmt


def test_ambiguous_columns_are_reported(spark, caplog):
    df = _column(spark, ["01/02/2016", "12/11/2017"])
    assert [(r.date_format, r.chosen, r.ambiguous) for r in dates.format_votes(df).collect() if r.parsed] == [("M/d/yyyy", True, True), ("d/M/yyyy", False, False)]
    assert dates.infer_format(df) == "M/d/yyyy" and "d/M/yyyy" in caplog.text


def test_mixed_columns_raise(spark):
    df = _column(spark, ["2016-01-02", "2016-01-03", "03/01/2016", "soon"])
    with pytest.raises(ValueError, match="no date format parses all 4 values"):
        dates.infer_format(df)
    assert dates.infer_format(df, mixed=True) == "yyyy-M-d"
    assert dates.infer_format(_column(spark, [None])) == "yyyy-M-d"
