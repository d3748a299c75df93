"""Brute-force checks against the single-machine semantics (Python's re, str.count,
decimal half-up rounding) on generated inputs."""

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from larder.functions import rounding, scalar
from larder.plans.catalog import register_views
from larder.sources.tables import Tables
from tests.fixtures import raw_sources

SETTINGS = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))


def _half_up(s, n, digits):
    return float((Decimal(s) / Decimal(n)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


@SETTINGS
@given(st.lists(st.tuples(st.integers(-(10**11), 10**11), st.integers(1, 10**9)), min_size=50, max_size=200))
def test_rounding_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "s long, n long")
    got = df.select(
        rounding.avg_half_up("s", "n").alias("a4"),
        rounding.percent_half_up("s", "n").alias("p"),
        rounding.round2_of_avg("s", "n").alias("r2"),
    ).collect()
    for (s, n), r in zip(pairs, got):
        assert r["a4"] == _half_up(s, n, 4)
        assert r["p"] == _half_up(100 * s, n, 2)
        assert r["r2"] == _half_up(s, n, 2)


TEXT = st.text(alphabet=st.sampled_from(list("ab '\"[]\r\n xyz")), max_size=40)


@SETTINGS
@given(st.lists(TEXT, min_size=50, max_size=200))
def test_participant_text_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    got = df.select(
        scalar.extract_names("p").alias("names"), scalar.participant_count("p").alias("n")
    ).collect()
    for t, r in zip(texts, got):
        assert r["names"] == re.findall(r"'(.*?)'", t)
        assert r["n"] == int(t.count("'") / 2)


def test_registered_views_are_queryable(spark):
    t = Tables(raw_sources(spark), as_of="2024-01-02")
    names = register_views(spark, t.as_dict(), prefix="fx_")
    assert len(names) == 11
    got = spark.sql("SELECT Year, Total_Invoices FROM fx_sales_by_year ORDER BY Year").collect()
    assert [(r[0], r[1]) for r in got] == [(2016, 3), (2017, 2)]


# The label of every hour.
HOUR_LABELS = [
    "Late Night", "Late Night", "Late Night", "Late Night", "Late Night", "Early Morning",
    "Early Morning", "Early Morning", "Early Morning", "Late Morning", "Late Morning", "Late Morning",
    "Late Morning", "Early Afternoon", "Early Afternoon", "Early Afternoon", "Evening", "Evening",
    "Evening", "Evening", "Night", "Night", "Night", "Night",
]


def test_part_of_day_every_hour_matches_python(spark):
    import datetime as dt

    rows = [(dt.datetime(2020, 1, 1, h, m),) for h in range(24) for m in (0, 59)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = [r[0] for r in df.select(scalar.part_of_day("t")).collect()]
    assert got == [HOUR_LABELS[t.hour] for (t,) in rows]
