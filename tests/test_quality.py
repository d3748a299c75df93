from larder.operators import profiling, quality
from larder.sources.tables import Tables
from tests.fixtures import INVOICES, LEADS, SALESTEAM, raw_sources


def _counts(df):
    return {(r["check_name"], r["table_name"], r["column_name"]): r["violations"] for r in df.collect()}


def _bad_tables(spark):
    invoices = INVOICES + [
        # repeated Order_Id (PK, UNIQUE), odd quote count
        (6, "O1", "27-05-2016", "M6", "C1", "2016-05-31 09:00:00+02:00", "['Ann Lee' 'Bo", "100", "Lunch"),
        # orphan order and company, price outside SMALLINT, unknown meal type, long text
        (7, "O9", "01-01-2017", "M7", "C9", "2017-01-01 10:00:00+00:00", "['" + "x" * 300 + "']", "40000", "Brunch"),
    ]
    salesteam = SALESTEAM + [(5, "Vic", "R5", "Nowhere", "C7")]
    return Tables(raw_sources(spark, invoices=invoices, leads=LEADS, salesteam=salesteam), strict=False)


def test_clean_tables_have_no_violations_except_declared_domain(spark):
    t = Tables(raw_sources(spark), strict=False)
    tables = t.as_dict()
    for fn in (quality.check_not_null, quality.check_pk, quality.check_unique_order, quality.check_fk,
               quality.check_length, quality.check_participants):
        got = _counts(fn(tables))
        if fn is quality.check_participants:
            # the O'Hara row: 3 quotes (odd) and count 1 == 1 extracted name
            assert got[("participants", "invoice", "odd_quotes")] == 1
            assert got[("participants", "invoice", "count_vs_names")] == 0
        else:
            assert set(got.values()) == {0}, fn.__name__
    dom = _counts(quality.check_domain(tables))
    assert dom[("domain", "invoice", "Part_of_Day")] == 0
    assert dom[("domain_declared", "invoice", "Part_of_Day")] == 1  # the Evening row
    assert set(_counts(quality.check_range(t.raw.as_dict())).values()) == {0}


def test_violations_are_counted(spark):
    t = _bad_tables(spark)
    tables = t.as_dict()
    pk = _counts(quality.check_pk(tables))
    assert pk[("primary_key", "invoice", "Order_Id,Date")] == 2
    assert _counts(quality.check_unique_order(tables))[("unique", "invoice", "Order_Id")] == 2
    fk = _counts(quality.check_fk(tables))
    assert fk[("foreign_key", "invoice", "Order_Id -> orders.Order_Id")] == 1
    assert fk[("foreign_key", "invoice", "Company_Id -> orders.Company_Id")] == 1
    assert fk[("foreign_key", "salesteam", "Company_Id -> orders.Company_Id")] == 1
    dom = _counts(quality.check_domain(tables))
    assert dom[("domain", "invoice", "Type_of_Meal")] == 1
    ln = _counts(quality.check_length(tables))
    assert ln[("length", "invoice", "Participants")] == 1
    assert ln[("length", "customer_order", "Participant_Name")] == 1
    rng = _counts(quality.check_range(t.raw.as_dict()))
    assert rng[("range", "invoices", "Meal Price")] == 1
    parts = _counts(quality.check_participants(tables))
    assert parts[("participants", "invoice", "odd_quotes")] == 2
    assert parts[("participants", "invoice", "count_vs_names")] == 0
    # lenient cleaning: the out-of-range price becomes null instead of failing
    assert t.invoice.filter("Meal_Price IS NULL").count() == 1


def test_profiling(spark):
    leads = LEADS + [LEADS[0]]  # a repeated full row (its row-order key is ignored)
    raw = raw_sources(spark, leads=leads).as_dict()
    dup = {r["table_name"]: r["duplicates"] for r in profiling.profile_duplicates(raw).collect()}
    assert dup == {"invoices": 0, "orderleads": 1, "salesteam": 0}
    nulls = {(r["table_name"], r["column_name"]): r["missing"] for r in profiling.profile_nulls(raw).collect()}
    assert nulls[("orderleads", "Converted")] == 1
    assert nulls[("invoices", "Order Id")] == 0
    assert len(nulls) == 8 + 6 + 4
    types = profiling.declared_types(raw)
    assert ("invoices", "Meal Price", "string") in types


def test_violation_rows_name_the_offending_rows(spark):
    t = _bad_tables(spark)
    rows = {(r["check_name"], r["table_name"], r["column_name"], r["row_key"], r["detail"])
            for r in quality.violation_rows(t.as_dict(), t.raw.as_dict()).collect()}
    assert ("unique", "invoice", "Order_Id", "O1", "2") in rows
    assert ("foreign_key", "invoice", "Order_Id -> orders.Order_Id", "O9", "1") in rows
    assert ("foreign_key", "salesteam", "Company_Id -> orders.Company_Id", "C7", "1") in rows
    assert ("domain", "invoice", "Type_of_Meal", "O9", "Brunch") in rows
    assert ("domain_declared", "invoice", "Part_of_Day", "O2", "Evening") in rows
    assert ("range", "invoices", "Meal Price", "O9", "40000") in rows
    assert ("length", "invoice", "Participants", "O9", "304") in rows
    assert ("participants", "invoice", "odd_quotes", "O1", "3") in rows


def test_range_counts_participant_overflow_on_raw_text(spark):
    many = "[" + " ".join(f"'n{i}'" for i in range(130)) + "]"
    invoices = INVOICES + [(8, "O8", "01-02-2017", "M8", "C1", "2017-02-01 10:00:00+00:00", many, "10", "Lunch")]
    t = Tables(raw_sources(spark, invoices=invoices), strict=False)
    rng = _counts(quality.check_range(t.raw.as_dict()))
    assert rng[("range", "invoices", "Number_of_Participants")] == 1
    assert t.invoice.filter("Order_Id = 'O8'").first()["Number_of_Participants"] is None


def test_more_names_than_the_column_holds_are_reported_not_raised(spark):
    many = "[" + " ".join(f"'n{i}'" for i in range(200)) + "]"
    invoices = INVOICES + [(8, "O8", "01-02-2017", "M8", "C1", "2017-02-01 10:00:00+00:00", many, "10", "Lunch")]
    t = Tables(raw_sources(spark, invoices=invoices), strict=False)
    parts = _counts(quality.check_participants(t.as_dict(False)))
    assert parts[("participants", "invoice", "count_vs_names")] == 0
    rows = {tuple(r) for r in quality.violation_rows(t.as_dict(), t.raw.as_dict()).collect()}
    assert ("range", "invoices", "Number_of_Participants", "O8", "200") in rows
