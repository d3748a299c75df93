"""The ten reporting views (plus the per-meal variant of company metrics).

Each view is a function of the published tables and returns a lazy DataFrame
with the contractual output columns. Conventions:

* averages of integer columns keep four decimals and percentages two, rounded
  half up in integer arithmetic (``larder.functions.rounding``);
* where the original query selects a column that is neither grouped nor
  aggregated, the value is made deterministic as the smallest
  ``struct(...)`` of those columns, so it comes from one real row;
* joins that fan out through the sales team (every rep of a company gets every
  order of that company) are computed by aggregating the big side per company
  *first* and joining the small per-company result, which gives the same sums,
  counts, minima and maxima as the row-level fan-out without multiplying rows
  and without shuffling the big side on a low-cardinality company key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.rounding import avg_half_up, percent_half_up, round2_of_avg
from larder.functions.scalar import meal_order


def _year(c: str = "Date") -> F.Column:
    return F.year(F.col(c)).cast("int")


def customer_stats(customer_order: DataFrame, invoice: DataFrame) -> DataFrame:
    """Per participant name: orders, total spent and average spent."""
    joined = customer_order.select("Order_Id", "Participant_Name").join(
        invoice.select("Order_Id", "Meal_Price"), "Order_Id"
    )
    agg = joined.groupBy("Participant_Name").agg(
        F.count(F.lit(1)).alias("number_of_order"),
        F.sum("Meal_Price").cast("long").alias("total_spent"),
        F.count("Meal_Price").alias("_n"),
    )
    return agg.select(
        F.col("Participant_Name").alias("customer_name"),
        "number_of_order",
        "total_spent",
        avg_half_up("total_spent", "_n").alias("average_spent"),
    )


def _monthly_by_meal(leads: DataFrame, invoice: DataFrame) -> DataFrame:
    """Hash aggregate at (company, year, month, meal type): fixed-width buffers only,
    partially combined before the shuffle."""
    joined = leads.select("Order_Id", "Company_Name").join(
        invoice.select("Order_Id", "Date", "Meal_Price", "Type_of_Meal"), "Order_Id"
    )
    return joined.groupBy(
        F.col("Company_Name").alias("company_name"),
        _year().alias("year"),
        F.month("Date").alias("month_no"),
        F.col("Type_of_Meal").alias("meal_typ_sale"),
    ).agg(
        F.sum("Meal_Price").cast("long").alias("monthly_total"),
        F.count("Meal_Price").alias("_n"),
        F.count(F.lit(1)).alias("number_of_sales"),
    )


def _monthly(leads: DataFrame, invoice: DataFrame) -> DataFrame:
    """Roll the per-meal aggregate up to (company, year, month); the smallest meal
    type is picked from the already-small per-meal rows.

    The per-meal rows (at most a few dozen per company and year) are partitioned
    once by (company, year): that partitioning serves this roll-up and both
    windows, so no further exchange is planned before the final ordering.
    """
    by_meal = _monthly_by_meal(leads, invoice).repartition("company_name", "year")
    return by_meal.groupBy("company_name", "year", "month_no").agg(
        F.min("meal_typ_sale").alias("meal_typ_sale"),
        F.sum("monthly_total").cast("long").alias("monthly_total"),
        F.sum("_n").alias("_n"),
        F.sum("number_of_sales").alias("number_of_sales"),
    )


def _company_windows(monthly: DataFrame, order_cols: list) -> DataFrame:
    part = Window.partitionBy("company_name", "year")
    running = part.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select(
        "company_name",
        "year",
        F.date_format(F.make_date("year", "month_no", F.lit(1)), "MMMM").alias("month"),
        "meal_typ_sale",
        "monthly_total",
        avg_half_up("monthly_total", "_n").alias("monthly_average"),
        "number_of_sales",
        F.sum("monthly_total").over(running).cast("long").alias("year_to_date"),
        F.sum("monthly_total").over(part).cast("long").alias("yearly_total"),
        "month_no",
    )


COMPANY_METRICS_COLUMNS = [
    "company_name", "year", "month", "meal_typ_sale", "monthly_total",
    "monthly_average", "number_of_sales", "year_to_date", "yearly_total",
]


def company_metrics(leads: DataFrame, invoice: DataFrame) -> DataFrame:
    """Per company, year and month: totals, average, count, running and yearly total.

    ``meal_typ_sale`` is the smallest meal type of the month (not a grouping key).
    ``yearly_total`` is the sum of the year's monthly totals.
    """
    out = _company_windows(_monthly(leads, invoice), ["month_no"])
    return out.orderBy("company_name", "year", "month_no").select(*COMPANY_METRICS_COLUMNS)


def company_metrics_by_meal(leads: DataFrame, invoice: DataFrame) -> DataFrame:
    """Same measures at the documented grain (company, year, month, meal type);
    the running total follows month, then the fixed meal order."""
    monthly = _monthly_by_meal(leads, invoice).withColumn("_meal_no", meal_order("meal_typ_sale"))
    out = _company_windows(monthly, ["month_no", "_meal_no", "meal_typ_sale"])
    out = out.withColumn("_meal_no", meal_order("meal_typ_sale"))
    return out.orderBy("company_name", "year", "month_no", "_meal_no").select(*COMPANY_METRICS_COLUMNS)


def sales_rep_performance(salesteam: DataFrame, leads: DataFrame, invoice: DataFrame) -> DataFrame:
    """Per (rep name, company name): sum, min and max meal price over every
    invoiced order of the rep's company."""
    per_company = (
        leads.select("Order_Id", "Company_Id")
        .join(invoice.select("Order_Id", "Meal_Price"), "Order_Id")
        .groupBy("Company_Id")
        .agg(
            F.sum("Meal_Price").alias("_sum"),
            F.min("Meal_Price").alias("_min"),
            F.max("Meal_Price").alias("_max"),
        )
    )
    joined = salesteam.select("Sales_Rep", "Sales_Rep_Id", "Company_Name", "Company_Id").join(
        per_company, "Company_Id"
    )
    agg = joined.groupBy("Sales_Rep", "Company_Name").agg(
        F.min(F.struct("Sales_Rep_Id", "Company_Id")).alias("_ids"),
        F.sum("_sum").cast("long").alias("Profit_by_Sales_Rep"),
        F.min("_min").alias("Min_Sale"),
        F.max("_max").alias("Max_Sale"),
    )
    return agg.select(
        "Sales_Rep",
        F.col("_ids.Sales_Rep_Id").alias("Sales_Rep_Id"),
        "Company_Name",
        F.col("_ids.Company_Id").alias("Company_Id"),
        "Profit_by_Sales_Rep",
        "Min_Sale",
        "Max_Sale",
    )


def _min_nulls_first(c: str) -> F.Column:
    """Smallest value with nulls ordered first (the order ``min(struct)`` uses)."""
    return F.when(F.max(F.col(c).isNull()), F.lit(None)).otherwise(F.min(c))


def customer_purchases(invoice: DataFrame, customer_order: DataFrame, salesteam: DataFrame) -> DataFrame:
    """Per (participant name, meal type): purchases, total and average spent, with
    every rep of the invoice's company counted (fan-out of the original join).

    The invoice-name rows are first hash-aggregated per (name, meal, company,
    part of day), with fixed-width buffers and a map-side partial aggregate; only
    that result meets the per-company rep table, so the fan-out is a multiply by
    the rep count, not a row explosion, and no raw row is shuffled by company.
    The smallest (part of day, company name) over those rows equals the smallest
    over the fanned-out rows, because every rep row of a company pairs with the
    same parts of day.
    """
    reps = salesteam.groupBy("Company_Id").agg(
        F.count(F.lit(1)).alias("_reps"), _min_nulls_first("Company_Name").alias("_cname")
    )
    # the name rows (the larger side) stream through the join; invoice rows buffer
    per_pod = (
        customer_order.select("Order_Id", "Participant_Name")
        .join(invoice.select("Order_Id", "Type_of_Meal", "Part_of_Day", "Company_Id", "Meal_Price"), "Order_Id")
        .groupBy("Participant_Name", "Type_of_Meal", "Company_Id", "Part_of_Day")
        .agg(
            F.count("Order_Id").alias("_cnt"),
            F.sum("Meal_Price").alias("_sum"),
            F.count("Meal_Price").alias("_nprice"),
        )
    )
    joined = per_pod.join(reps, "Company_Id")
    agg = joined.groupBy("Participant_Name", "Type_of_Meal").agg(
        F.min(F.struct(F.col("Part_of_Day").alias("_pod"), "_cname")).alias("_loose"),
        F.sum(F.col("_cnt") * F.col("_reps")).alias("Number_of_Purchases"),
        F.sum(F.col("_sum") * F.col("_reps")).cast("long").alias("Total_Spent"),
        F.sum(F.col("_nprice") * F.col("_reps")).alias("_n"),
    )
    return agg.select(
        F.col("Participant_Name").alias("Customer_Name"),
        F.col("Type_of_Meal").alias("Meal_Type"),
        F.col("_loose._pod").alias("Part_of_Day"),
        F.col("_loose._cname").alias("Company_Name"),
        "Number_of_Purchases",
        "Total_Spent",
        avg_half_up("Total_Spent", "_n").alias("Avg_Spent_per_Meal"),
    )


def sales_by_year(invoice: DataFrame) -> DataFrame:
    """Invoices per year."""
    return invoice.groupBy(_year().alias("Year")).agg(F.count(F.lit(1)).alias("Total_Invoices"))


def percent_converted(leads: DataFrame) -> DataFrame:
    """Per company name: leads with a known outcome, conversions, non-conversions
    and the conversion percentage over all leads (unknown included)."""
    conv = F.col("Converted")
    agg = leads.groupBy("Company_Name").agg(
        F.count(conv).alias("Converted_Total"),
        F.sum(F.when(conv == 1, conv).otherwise(F.lit(0))).cast("long").alias("Converted_to_Order"),
        F.sum(conv).alias("_converted_sum"),
        F.count(F.lit(1)).alias("_leads"),
    )
    return agg.select(
        "Company_Name",
        "Converted_Total",
        "Converted_to_Order",
        (F.col("Converted_Total") - F.col("Converted_to_Order")).alias("Not_Converted"),
        percent_half_up("_converted_sum", "_leads").alias("Percent_Converted"),
    )


def avg_meal_price(invoice: DataFrame) -> DataFrame:
    """Average meal price per meal type, two decimals."""
    agg = invoice.groupBy("Type_of_Meal").agg(
        F.sum("Meal_Price").alias("_sum"), F.count("Meal_Price").alias("_n")
    )
    return agg.select("Type_of_Meal", round2_of_avg("_sum", "_n").alias("Average_Meal_Price"))


def total_sales(invoice: DataFrame) -> DataFrame:
    """Meal-price total per year and meal type, ordered by year then meal order."""
    agg = invoice.groupBy(_year().alias("Year"), "Type_of_Meal").agg(
        F.sum("Meal_Price").cast("long").alias("Total_Sales")
    )
    return agg.orderBy("Year", meal_order("Type_of_Meal"))


def avg_participants(invoice: DataFrame) -> DataFrame:
    """Average number of participants per meal type (four decimals)."""
    agg = invoice.groupBy("Type_of_Meal").agg(
        F.sum("Number_of_Participants").alias("_sum"), F.count("Number_of_Participants").alias("_n")
    )
    return agg.select(
        "Type_of_Meal", avg_half_up("_sum", "_n").alias("Average_Participants_Per_Meal")
    )


def difference_days(invoice: DataFrame) -> DataFrame:
    """Order date minus meal date in whole days, per invoice."""
    return invoice.select(
        "Date",
        "Date_of_Meal",
        F.datediff(F.col("Date"), F.col("Date_of_Meal")).cast("int").alias("Days_Between"),
    )
