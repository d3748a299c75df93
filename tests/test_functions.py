import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.functions import rounding, scalar
from larder.operators.cleaning import clean_invoices, underscore_columns
from tests.fixtures import (
    EXPECTED_COUNT,
    EXPECTED_DAYS,
    EXPECTED_HOURS,
    EXPECTED_PART,
    raw_sources,
)


def test_underscore_columns(spark):
    df = spark.createDataFrame([("a", "b")], "`Order Id` string, `Date of Meal` string")
    assert underscore_columns(df).columns == ["Order_Id", "Date_of_Meal"]


def test_clean_invoices_fixture_rows(spark):
    inv = clean_invoices(raw_sources(spark).invoices)
    rows = {r["Order_Id"]: r for r in inv.collect()}
    assert rows["O1"]["Date"] == dt.date(2016, 5, 27)
    assert rows["O2"]["Date"] == dt.date(2016, 10, 3)  # day-first, never month-first
    assert rows["O1"]["Date_of_Meal"] == dt.datetime(2016, 5, 31, 7, 0, 0)  # offset dropped, not applied
    assert rows["O5"]["Date_of_Meal"] == dt.datetime(2017, 1, 6, 23, 59, 59)
    for k, r in rows.items():
        assert r["Date_of_Meal"].hour == EXPECTED_HOURS[k]
        assert r["Part_of_Day"] == EXPECTED_PART[k]
        assert r["Number_of_Participants"] == EXPECTED_COUNT[k]
    assert dict(inv.schema.simpleString() and [(f.name, f.dataType.simpleString()) for f in inv.schema.fields])[
        "Date_of_Meal"] == "timestamp_ntz"


def test_days_between_sign(spark):
    from larder.plans.views import difference_days

    inv = clean_invoices(raw_sources(spark).invoices)
    got = {r["Date"]: r["Days_Between"] for r in difference_days(inv).collect()}
    want = {}
    for r in inv.collect():
        want[r["Date"]] = EXPECTED_DAYS[r["Order_Id"]]
    assert got == want


@pytest.mark.parametrize(
    "hour,label",
    [(4, "Late Night"), (5, "Early Morning"), (8, "Early Morning"), (9, "Late Morning"),
     (12, "Late Morning"), (13, "Early Afternoon"), (15, "Early Afternoon"), (16, "Evening"),
     (19, "Evening"), (20, "Night"), (23, "Night"), (0, "Late Night")],
)
def test_part_of_day_band_edges(spark, hour, label):
    ts = dt.datetime(2020, 1, 1, hour, 30)
    df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
    assert df.select(scalar.part_of_day("t")).first()[0] == label


def test_part_of_day_null_is_late_night(spark):
    df = spark.createDataFrame([(None,)], "t timestamp_ntz")
    assert df.select(scalar.part_of_day("t")).first()[0] == "Late Night"


def test_extract_names_and_count_follow_text_literally(spark):
    df = spark.createDataFrame(
        [("['A B' 'C D']",), ("[]",), ("[\"Pat O'Hara\" 'Ann Lee']",), ("['x' 'y",)], "p string"
    )
    rows = df.select(scalar.extract_names("p").alias("n"), scalar.participant_count("p").alias("c")).collect()
    assert [r["n"] for r in rows] == [["A B", "C D"], [], ['Hara" '], ["x"]]
    assert [r["c"] for r in rows] == [2, 0, 1, 1]  # 3 quotes -> 1 (truncated)


def test_strict_parse_raises_and_lenient_nulls(spark):
    df = spark.createDataFrame([("2016-13-45",)], "d string")
    with pytest.raises(Exception):
        df.select(scalar.parse_invoice_date("d")).collect()
    assert df.select(scalar.parse_invoice_date("d", strict=False)).first()[0] is None


def test_lead_date_format_is_a_parameter(spark):
    df = spark.createDataFrame([("10-03-2016",)], "d string")
    got = df.select(scalar.parse_lead_date("d", fmt="MM-dd-yyyy")).first()[0]
    assert got == dt.date(2016, 10, 3)


def test_meal_order(spark):
    df = spark.createDataFrame([("Breakfast",), ("Lunch",), ("Dinner",), ("Brunch",), (None,)], "m string")
    assert [r[0] for r in df.select(scalar.meal_order("m")).collect()] == [1, 2, 3, 0, 0]


def test_rounding_is_exact_half_up(spark):
    df = spark.createDataFrame([(201, 200), (1, 3), (2, 3), (1, 8), (0, 0), (None, 5)], "s long, n long")
    rows = df.select(
        rounding.avg_half_up("s", "n").alias("a4"),
        rounding.avg_half_up("s", "n", digits=2).alias("a2"),
        rounding.percent_half_up("s", "n").alias("p"),
        rounding.round2_of_avg("s", "n").alias("r2"),
    ).collect()
    assert [r["a4"] for r in rows] == [1.005, 0.3333, 0.6667, 0.125, None, None]
    assert [r["a2"] for r in rows] == [1.01, 0.33, 0.67, 0.13, None, None]  # 1.005 -> 1.01 exactly
    assert [r["p"] for r in rows] == [100.5, 33.33, 66.67, 12.5, None, None]
    assert [r["r2"] for r in rows] == [1.01, 0.33, 0.67, 0.13, None, None]


def test_round2_of_avg_rounds_the_exact_quotient(spark):
    df = spark.createDataFrame([(100495, 100000), (1004996, 1000000)], "s long, n long")
    assert [r[0] for r in df.select(rounding.round2_of_avg("s", "n")).collect()] == [1.0, 1.0]


def test_negative_sums_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(-16, 10), (-5, 1000), (-201, 200)], "s long, n long")
    rows = df.select(rounding.avg_half_up("s", "n").alias("a4"), rounding.round2_of_avg("s", "n").alias("r2")).collect()
    assert [tuple(r) for r in rows] == [(-1.6, -1.6), (-0.005, -0.01), (-1.005, -1.01)]


def test_rounding_large_sums_do_not_overflow(spark):
    s = 9_000_000_000_000_000  # 2 * 10^4 * s overflows a long
    df = spark.createDataFrame([(s, 3)], "s long, n long")
    assert df.select(rounding.avg_half_up("s", "n")).first()[0] == 3_000_000_000_000_000.0


def test_strip_offset(spark):
    df = spark.createDataFrame([("2016-05-31 07:00:00+02:00",), ("2016-05-31 07:00:00",)], "t string")
    assert [r[0] for r in df.select(scalar.strip_offset("t")).collect()] == ["2016-05-31 07:00:00"] * 2


def test_name_regex_matches_python_line_terminators(spark):
    import re

    text = "['a\rb' 'c d' 'e\nf' 'g']"
    df = spark.createDataFrame([(text,)], "p string")
    assert df.select(scalar.extract_names("p")).first()[0] == re.findall(r"'(.*?)'", text)


def test_single_digit_fields_parse(spark):
    df = spark.createDataFrame([("1-5-2016", "2016-5-3 7:00:00+01:00", "2016-5-3")], "d string, t string, l string")
    r = df.select(scalar.parse_invoice_date("d"), scalar.parse_meal_ts("t"), scalar.parse_lead_date("l")).first()
    assert (r[0], r[1], r[2]) == (dt.date(2016, 5, 1), dt.datetime(2016, 5, 3, 7, 0), dt.date(2016, 5, 3))


def test_lenient_meal_ts_keeps_wall_clock_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2016-03-13 02:30:00+02:00",), ("not a time",)], "t string")
        got = [r[0] for r in df.select(scalar.parse_meal_ts("t", strict=False)).collect()]
        assert got == [dt.datetime(2016, 3, 13, 2, 30), None]  # 02:30 does not exist in that zone that day
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_test_domain_meal_text_is_zone_free(spark):
    from larder.sources.testdomain import _ntz_text

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(dt.datetime(2000, 4, 2, 2, 50),)], "t timestamp_ntz")
        assert df.select(_ntz_text(F.col("t"))).first()[0] == "2000-04-02 02:50:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_participant_count_overflow(spark):
    text = "[" + " ".join(f"'n{i}'" for i in range(130)) + "]"
    df = spark.createDataFrame([(text,)], "p string")
    assert df.select(scalar.participant_count("p", strict=False)).first()[0] is None
    with pytest.raises(Exception):
        df.select(scalar.participant_count("p")).collect()
