import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from larder.oracle import oracle_queries
from larder.sources.testdomain import TEST_TABLES
from tests.conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import _digest, _types  # noqa: E402

KEYS = sorted(oracle_queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["company_name", "year", "month", "meal_typ_sale", "monthly_total",
                          "monthly_average", "number_of_sales", "year_to_date", "yearly_total"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    # keys of the corpus subpackage are held by its own tests
    assert set(KEYS) <= set(E.queries()) and set(KEYS) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    got = E.queries()[key](spark, SF_SMALL).toArrow()
    want = duck.sql(E.oracle_sql()[key]).to_arrow_table()
    assert got.num_rows == want.num_rows
    assert _types(got) == _types(want)
    assert _digest(got)[0] == _digest(want)[0]


def test_entry_schema_is_stable_across_scale_factors(spark):
    from larder.plans import views
    from larder.sources.tables import tables_from_test_data

    small = E.entry(spark).schema
    t = tables_from_test_data(spark, "/root/testdata/sf0.01")
    assert views.company_metrics(t.leads, t.invoice).schema == small


@pytest.mark.parametrize("key", ["strip_offset", "parse_meal_ts", "part_of_day", "difference_days"])
def test_meal_times_match_oracle_under_a_dst_zone(spark, key):
    # sf0.01 holds a meal time (order 7310) inside a US daylight-saving gap
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in TEST_TABLES:
        path = f"{sf}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = E.queries()[key](spark, sf).toArrow()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    want = con.sql(E.oracle_sql()[key]).to_arrow_table()
    assert _digest(got)[0] == _digest(want)[0]
