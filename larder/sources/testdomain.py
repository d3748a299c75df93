"""Raw source frames derived from the driver's TPC-H-style test tables.

The three source files of the original job (invoices, order leads, sales team)
are not available, so the raw frames are derived from the test tables, in raw
text form (string columns under the CSV header names) so that every cleaning
step runs. The mapping:

* invoices  <- orders ⋈ customer; the participant list is the sorted list of
  part names on the order's line items, a name as often as it is there.
* leads     <- orders ⋈ customer ⋈ nation (every order is a lead).
* salesteam <- supplier ⋈ nation (suppliers act as reps of the nation "company").

``_row_order`` carries the source row order (the order key) so that
first-appearance ids do not depend on Spark's partitioning.

Every frame is lazy. Joins are left to AQE: the dimension sides (customer,
nation, part) are broadcast only when their runtime size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, otherwise sort-merge.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_ORDER = "_row_order"

TEST_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _quoted_list(names_col: str) -> F.Column:
    """``['a' 'b']`` text of an array column; ``[]`` for a missing/empty list."""
    quoted = F.transform(F.col(names_col), lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.coalesce(F.array_join(quoted, " "), F.lit("")), F.lit("]"))


def _ntz_text(ts: F.Column) -> F.Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a ``timestamp_ntz`` from its fields.

    ``date_format`` would pass the value through the session time zone and move
    a wall-clock time that falls in a daylight-saving gap.
    """
    return F.format_string(
        "%04d-%02d-%02d %02d:%02d:%02d",
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts),
    )


def order_part_names(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """(l_orderkey, names): sorted part names per order, with repeats."""
    return (
        lineitem.select("l_orderkey", "l_partkey")
        .join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_list("p_name")).alias("names"))
    )


def raw_invoices(orders: DataFrame, customer: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    base = orders.join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    base = base.join(
        order_part_names(lineitem, part), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    ok = F.col("o_orderkey")
    meal_ts = F.col("o_orderdate") + F.make_dt_interval(
        (ok % 11 - 5).cast("int"), (ok * 7 % 24).cast("int"), (ok % 60).cast("int"), F.lit(0)
    )
    meal_type = (
        F.when(ok % 3 == 0, F.lit("Breakfast"))
        .when(ok % 3 == 1, F.lit("Lunch"))
        .otherwise(F.lit("Dinner"))
    )
    return base.select(
        ok.alias(ROW_ORDER),
        ok.cast("string").alias("Order Id"),
        F.date_format("o_orderdate", "dd-MM-yyyy").alias("Date"),
        F.concat(F.lit("M"), ok.cast("string")).alias("Meal Id"),
        F.col("c_nationkey").cast("string").alias("Company Id"),
        F.concat(_ntz_text(meal_ts), F.lit("+02:00")).alias("Date of Meal"),
        _quoted_list("names").alias("Participants"),
        F.floor(F.col("o_totalprice") / 100).cast("smallint").cast("string").alias("Meal Price"),
        meal_type.alias("Type of Meal"),
    )


def raw_leads(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    base = orders.join(
        customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    ).join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    ok = F.col("o_orderkey")
    converted = (
        F.when(ok % 97 == 0, F.lit(None).cast("string"))
        .when(F.col("o_orderstatus") == "F", F.lit("1"))
        .otherwise(F.lit("0"))
    )
    return base.select(
        ok.alias(ROW_ORDER),
        ok.cast("string").alias("Order Id"),
        F.col("c_nationkey").cast("string").alias("Company Id"),
        F.col("n_name").alias("Company Name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"),
        F.floor(F.col("o_totalprice") / 50).cast("smallint").cast("string").alias("Order Value"),
        converted.alias("Converted"),
    )


def raw_salesteam(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    base = supplier.join(
        nation.select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return base.select(
        F.col("s_suppkey").alias(ROW_ORDER),
        F.col("s_name").alias("Sales Rep"),
        F.col("s_suppkey").cast("string").alias("Sales Rep Id"),
        F.col("n_name").alias("Company Name"),
        F.col("n_nationkey").cast("string").alias("Company Id"),
    )


@dataclass
class RawSources:
    invoices: DataFrame
    leads: DataFrame
    salesteam: DataFrame
    path: str | None = None  # folder of the staged copy, if these frames read one

    def as_dict(self) -> dict[str, DataFrame]:
        """Raw frames under their source names."""
        return {"invoices": self.invoices, "orderleads": self.leads, "salesteam": self.salesteam}


def load_test_sources(spark: SparkSession, sf_dir: str) -> RawSources:
    t = {n: read_table(spark, sf_dir, n) for n in ("orders", "customer", "nation", "supplier", "part", "lineitem")}
    return RawSources(
        invoices=raw_invoices(t["orders"], t["customer"], t["lineitem"], t["part"]),
        leads=raw_leads(t["orders"], t["customer"], t["nation"]),
        salesteam=raw_salesteam(t["supplier"], t["nation"]),
    )


def flawed_sources(raw: RawSources) -> RawSources:
    """The same frames with rows that break constraints, for the load gate: dates in another format, values out of
    range, missing and unknown keys, repeated invoices (numbered behind all others)."""
    row = F.col(ROW_ORDER)
    leads = raw.leads.withColumns({
        "Date": F.when(row % 10 == 0, F.regexp_replace("Date", "-", ".")).otherwise(F.col("Date")),
        "Order Value": F.when(row % 17 == 0, F.concat("Order Value", F.lit("000"))).otherwise(F.col("Order Value")),
        "Company Id": F.when(row % 41 == 0, F.lit(None)).otherwise(F.col("Company Id")),
    })
    again = raw.invoices.filter(row % 13 == 0).withColumn(ROW_ORDER, row + 10**12)
    invoices = raw.invoices.unionByName(again).withColumns({
        "Type of Meal": F.when(row % 29 == 0, F.lit("Brunch")).otherwise(F.col("Type of Meal")),
        "Meal Id": F.when(row % 31 == 0, F.lit(None)).otherwise(F.col("Meal Id")),
    })
    salesteam = raw.salesteam.withColumn("Company Id", F.when(row % 11 == 0, F.lit("none")).otherwise(F.col("Company Id")))
    return RawSources(invoices=invoices, leads=leads, salesteam=salesteam)
