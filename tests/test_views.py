from collections import defaultdict

from pyspark.sql import functions as F

from larder.plans import reports, views
from larder.sources.tables import Tables, tables_from_test_data
from tests.conftest import SF_SMALL
from tests.fixtures import INVOICES, raw_sources


def _t(spark, **kw):
    return Tables(raw_sources(spark, **kw), as_of="2024-01-02")


def _rows(df, key):
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}


def test_customer_stats(spark):
    t = _t(spark)
    got = _rows(views.customer_stats(t.customer_order, t.invoice), ["customer_name"])
    assert got[("David Bishop",)] == {"customer_name": "David Bishop", "number_of_order": 2,
                                      "total_spent": 350, "average_spent": 175.0}
    # listed twice in O5: counted twice; O4's text yields only 'Hara" ' (quote inside a name)
    assert got[("Ann Lee",)]["number_of_order"] == 3
    assert got[("Ann Lee",)]["total_spent"] == 250 + 60 + 60
    assert got[("Ann Lee",)]["average_spent"] == 123.3333
    assert got[('Hara" ',)]["total_spent"] == 75
    assert got[(None,)]["number_of_order"] == 1  # empty list forms its own group


def test_sales_rep_performance_fans_out_per_rep(spark):
    t = _t(spark)
    got = _rows(views.sales_rep_performance(t.salesteam, t.leads, t.invoice), ["Sales_Rep"])
    for rep in ("Rita", "Sam"):  # two reps of one company both get every order
        r = got[(rep,)]
        assert (r["Profit_by_Sales_Rep"], r["Min_Sale"], r["Max_Sale"]) == (350, 100, 250)
        assert r["Company_Name"] == "Acme" and r["Company_Id"] == "C1"
    assert got[("Tom",)]["Profit_by_Sales_Rep"] == 115
    assert got[("Uma",)]["Profit_by_Sales_Rep"] == 60  # O6 has no invoice


def test_customer_purchases_fan_out_and_loose_columns(spark):
    t = _t(spark)
    got = _rows(views.customer_purchases(t.invoice, t.customer_order, t.salesteam), ["Customer_Name", "Meal_Type"])
    r = got[("David Bishop", "Lunch")]
    # O2 belongs to Acme, which has two reps: the row counts twice
    assert (r["Number_of_Purchases"], r["Total_Spent"], r["Avg_Spent_per_Meal"]) == (2, 500, 250.0)
    assert (r["Part_of_Day"], r["Company_Name"]) == ("Evening", "Acme")
    r = got[("Ann Lee", "Dinner")]
    assert (r["Number_of_Purchases"], r["Total_Spent"]) == (2, 120)  # listed twice in O5 (Core, one rep)
    r = got[(None, "Dinner")]
    assert (r["Number_of_Purchases"], r["Part_of_Day"], r["Company_Name"]) == (1, "Late Morning", "Bolt")


def test_customer_purchases_loose_pick_is_smallest(spark):
    # same name and meal in two companies: the smallest (part of day, company) wins
    invoices = [
        (1, "O1", "27-05-2016", "M1", "C1", "2016-05-31 21:00:00+02:00", "['Kim']", "10", "Lunch"),
        (2, "O2", "28-05-2016", "M2", "C2", "2016-05-31 21:00:00+02:00", "['Kim']", "30", "Lunch"),
        (3, "O3", "29-05-2016", "M3", "C3", "2016-05-31 06:00:00+02:00", "['Kim']", "20", "Lunch"),
    ]
    t = _t(spark, invoices=invoices)
    r = views.customer_purchases(t.invoice, t.customer_order, t.salesteam).first()
    assert (r["Part_of_Day"], r["Company_Name"]) == ("Early Morning", "Core")
    assert (r["Number_of_Purchases"], r["Total_Spent"]) == (2 + 1 + 1, 10 * 2 + 30 + 20)
    assert r["Avg_Spent_per_Meal"] == 17.5


def test_percent_converted_denominators(spark):
    t = _t(spark)
    got = _rows(views.percent_converted(t.leads), ["Company_Name"])
    bolt = got[("Bolt",)]
    # one null lead: not in Converted_Total, but in the percentage denominator
    assert (bolt["Converted_Total"], bolt["Converted_to_Order"], bolt["Not_Converted"]) == (1, 1, 0)
    assert bolt["Percent_Converted"] == 50.0
    for r in got.values():
        assert r["Converted_to_Order"] + r["Not_Converted"] == r["Converted_Total"]


def test_total_sales_orders_unknown_meal_first(spark):
    extra = (6, "O6", "06-01-2017", "M6", "C3", "2017-01-06 10:00:00+00:00", "['Zed']", "10", "Brunch")
    t = _t(spark, invoices=INVOICES + [extra])
    rows = [(r["Year"], r["Type_of_Meal"]) for r in views.total_sales(t.invoice).collect()]
    assert rows == [(2016, "Breakfast"), (2016, "Lunch"), (2016, "Dinner"),
                    (2017, "Brunch"), (2017, "Lunch"), (2017, "Dinner")]


def test_company_metrics_properties(spark):
    t = tables_from_test_data(spark, SF_SMALL)
    rows = views.company_metrics(t.leads, t.invoice).collect()
    by_year = defaultdict(list)
    for r in rows:
        by_year[(r["company_name"], r["year"])].append(r)
    months = ["January", "February", "March", "April", "May", "June", "July", "August",
              "September", "October", "November", "December"]
    for group in by_year.values():
        group.sort(key=lambda r: months.index(r["month"]))
        total = sum(r["monthly_total"] for r in group)
        assert all(r["yearly_total"] == total for r in group)
        assert group[-1]["year_to_date"] == total
        running = 0
        for r in group:
            running += r["monthly_total"]
            assert r["year_to_date"] == running
    # rows come out ordered by company, year, calendar month
    keys = [(r["company_name"], r["year"], months.index(r["month"])) for r in rows]
    assert keys == sorted(keys)


def test_company_metrics_by_meal_rolls_up(spark):
    t = tables_from_test_data(spark, SF_SMALL)
    coarse = views.company_metrics(t.leads, t.invoice)
    fine = views.company_metrics_by_meal(t.leads, t.invoice)
    rolled = fine.groupBy("company_name", "year", "month").agg(
        F.sum("monthly_total").alias("t"), F.sum("number_of_sales").alias("n"))
    joined = coarse.join(rolled, ["company_name", "year", "month"])
    assert joined.count() == coarse.count()
    assert joined.filter((F.col("t") != F.col("monthly_total")) | (F.col("n") != F.col("number_of_sales"))).count() == 0


def test_sales_by_year_sums_to_invoices(spark):
    t = tables_from_test_data(spark, SF_SMALL)
    total = views.sales_by_year(t.invoice).agg(F.sum("Total_Invoices")).first()[0]
    assert total == t.invoice.count()


def test_previews(spark):
    t = _t(spark)
    top = reports.top_converted(views.percent_converted(t.leads), k=2).collect()
    assert len(top) == 2
    assert [r["Company_Name"] for r in top] == ["Acme", "Bolt"]  # all 50.0: tie broken by name
    prev = reports.preview_difference_days(views.difference_days(t.invoice)).collect()
    assert [str(r["Date"]) for r in prev] == ["2016-05-27", "2016-10-03"]
    ranked = [r["Average_Meal_Price"] for r in reports.avg_meal_price_ranked(views.avg_meal_price(t.invoice)).collect()]
    assert ranked == sorted(ranked, reverse=True)


def test_collation_option_groups_case_insensitively(spark):
    from larder.operators.conform import with_collation

    extra = (6, "O6", "06-01-2017", "M6", "C3", "2017-01-06 10:00:00+00:00", "['david bishop']", "10", "Lunch")
    t = _t(spark, invoices=INVOICES + [extra])
    binary = {r["customer_name"]: r["number_of_order"] for r in views.customer_stats(t.customer_order, t.invoice).collect()}
    assert binary["David Bishop"] == 2 and binary["david bishop"] == 1
    co, inv = with_collation(t.customer_order), with_collation(t.invoice)
    folded = {r["customer_name"].lower() if r["customer_name"] else None: r["number_of_order"]
              for r in views.customer_stats(co, inv).collect()}
    assert folded["david bishop"] == 3
