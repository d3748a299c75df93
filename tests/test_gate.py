"""Load gate: every row is admitted or rejected with its reasons; what is admitted breaks no constraint."""

import json

import pytest

from larder.operators import gate, quality
from larder.sources import publish
from larder.sources.tables import Tables
from tests.fixtures import INVOICES, LEADS, SALESTEAM, raw_sources

BAD_LEADS = [
    (7, "O2", "C1", "Acme", "2016-09-30", "300", "0"),  # repeats a key: the first one stays
    (8, None, "C1", "Acme", "2016-09-30", "300", "0"),
    (9, "O9", "C9", "Gone", "30.09.2016", "99999", "256"),  # three reasons; invoices and reps of C9 go with it
    (10, "O10", "C1", "x" * 256, "2016-09-30", "x", "0"),
]
BAD_INVOICES = [
    (6, "O9", "05-01-2017", "M9", "C9", "2017-01-06 10:00:00+01:00", "['Zed']", "1", "Lunch"),  # its lead is rejected
    (7, "O2", "05-01-2017", "M2", "C1", "2017-01-06 10:00:00+01:00", "[]", "1", "Lunch"),  # second invoice of O2
    (8, "O6", "2017-01-05", None, "C3", "soon", "'" * 260, "40000", "Brunch"),
]
BAD_TEAM = [(5, "Zoe", "R9", "Gone", "C9"), (6, "Yan", "R8", "Nowhere", None)]


@pytest.fixture
def decided(spark):
    return gate.decide(raw_sources(spark, INVOICES + BAD_INVOICES, LEADS + BAD_LEADS, SALESTEAM + BAD_TEAM))


def test_every_reason_is_listed_and_removal_goes_down_the_references(decided):
    got = {(r.table_name, r.row_order): r.reasons for r in decided.rejects().collect()}
    assert got == {
        ("orders", 7): "primary_key:Order_Id,Company_Id",
        ("orders", 8): "not_null:Order_Id",
        ("orders", 9): "format:Date,range:Order_Value,range:Converted",
        ("orders", 10): "length:Company_Name,range:Order_Value",
        ("invoice", 6): "foreign_key:Order_Id,foreign_key:Company_Id",
        ("invoice", 7): "unique:Order_Id",
        ("invoice", 8): "format:Date,format:Date_of_Meal,not_null:Meal_Id,length:Participants,domain:Type_of_Meal,range:Meal_Price,range:Number_of_Participants",
        ("salesteam", 5): "foreign_key:Company_Id",
    }
    row = next(r.row for r in decided.rejects().collect() if r.row_order == 9)
    assert json.loads(row)["Date"] == "30.09.2016"


def test_admitted_and_rejected_rows_partition_the_input(decided):
    admitted = {(r.table_name, r.row_order) for r in decided.admitted().collect()}
    rejected = {(r.table_name, r.row_order) for r in decided.rejects().collect()}
    assert not admitted & rejected
    every = {(t, r[0]) for t, rows in (("orders", LEADS + BAD_LEADS), ("invoice", INVOICES + BAD_INVOICES), ("salesteam", SALESTEAM + BAD_TEAM)) for r in rows}
    assert admitted | rejected == every


def test_admitted_rows_load_strictly_and_break_no_check(spark, decided):
    t = Tables(decided.accepted, as_of="2024-01-02")
    publish.refresh(spark, t.as_dict(), database="gate_mart")
    p = publish.published(spark, "gate_mart")
    checks = [quality.check_not_null(p), quality.check_pk(p), quality.check_unique_order(p), quality.check_fk(p), quality.check_length(p), quality.check_range(decided.accepted.as_dict())]
    assert all(r.violations == 0 for c in checks for r in c.collect())
    assert all(r.violations == 0 for r in quality.check_domain(p).collect() if r.check_name == "domain")


def test_a_third_of_all_rows_with_one_key(spark):
    leads = LEADS + [(100 + i, "O1", "C1", "Acme", "2016-05-20", "500", "1") for i in range(300)]
    got = gate.decide(raw_sources(spark, leads=leads))
    assert got.rejects().filter("table_name = 'orders'").count() == 300
    assert [r.row_order for r in got.admitted().filter("row_key = 'O1|C1'").collect()] == [1]


def test_empty_sources(spark):
    got = gate.decide(raw_sources(spark, INVOICES, [], []))
    assert got.rejects().count() == 5 and got.admitted().count() == 0
    assert {r.reasons for r in got.rejects().collect()} == {"foreign_key:Order_Id,foreign_key:Company_Id"}
