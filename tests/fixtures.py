"""Hand-made raw rows (text, CSV header names) with known expected values."""

from larder.sources.schemas import INVOICE_CSV_COLUMNS, LEADS_CSV_COLUMNS, SALESTEAM_CSV_COLUMNS, string_schema
from larder.sources.testdomain import ROW_ORDER, RawSources

# (row order, Order Id, Date, Meal Id, Company Id, Date of Meal, Participants, Meal Price, Type of Meal)
INVOICES = [
    (1, "O1", "27-05-2016", "M1", "C1", "2016-05-31 07:00:00+02:00", "['David Bishop']", "100", "Breakfast"),
    (2, "O2", "03-10-2016", "M2", "C1", "2016-10-01 16:00:00+02:00", "['David Bishop' 'Ann Lee']", "250", "Lunch"),
    (3, "O3", "04-10-2016", "M3", "C2", "2016-10-01 12:30:00+00:00", "[]", "40", "Dinner"),
    (4, "O4", "05-01-2017", "M4", "C2", "2017-01-05 00:15:00+01:00", "[\"Pat O'Hara\" 'Ann Lee']", "75", "Lunch"),
    (5, "O5", "05-01-2017", "M5", "C3", "2017-01-06 23:59:59+01:00", "['Ann Lee' 'Ann Lee']", "60", "Dinner"),
]
EXPECTED_HOURS = {"O1": 7, "O2": 16, "O3": 12, "O4": 0, "O5": 23}
EXPECTED_PART = {"O1": "Early Morning", "O2": "Evening", "O3": "Late Morning", "O4": "Late Night", "O5": "Night"}
EXPECTED_COUNT = {"O1": 1, "O2": 2, "O3": 0, "O4": 1, "O5": 2}
EXPECTED_DAYS = {"O1": -4, "O2": 2, "O3": 3, "O4": 0, "O5": -1}
# (Order_Id, Participant_Name, Customer_Id) in source order
EXPECTED_CUSTOMER_ORDER = [
    ("O1", "David Bishop", "1"),
    ("O2", "David Bishop", "1"),
    ("O2", "Ann Lee", "2"),
    ("O3", None, "0"),
    ("O4", 'Hara" ', "3"),
    ("O5", "Ann Lee", "2"),
    ("O5", "Ann Lee", "2"),
]

# (row order, Order Id, Company Id, Company Name, Date, Order Value, Converted)
LEADS = [
    (1, "O1", "C1", "Acme", "2016-05-20", "500", "1"),
    (2, "O2", "C1", "Acme", "2016-09-30", "300", "0"),
    (3, "O3", "C2", "Bolt", "2016-10-01", "200", None),
    (4, "O4", "C2", "Bolt", "2017-01-05", "100", "1"),
    (5, "O5", "C3", "Core", "2017-01-07", "50", "1"),
    (6, "O6", "C3", "Core", "2017-02-01", "70", "0"),
]

# (row order, Sales Rep, Sales Rep Id, Company Name, Company Id)
SALESTEAM = [
    (1, "Rita", "R1", "Acme", "C1"),
    (2, "Sam", "R2", "Acme", "C1"),
    (3, "Tom", "R3", "Bolt", "C2"),
    (4, "Uma", "R4", "Core", "C3"),
]


def _frame(spark, rows, columns):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(ROW_ORDER, T.LongType(), False), *string_schema(columns).fields])
    return spark.createDataFrame(rows, schema)


def raw_sources(spark, invoices=INVOICES, leads=LEADS, salesteam=SALESTEAM) -> RawSources:
    return RawSources(
        invoices=_frame(spark, invoices, INVOICE_CSV_COLUMNS),
        leads=_frame(spark, leads, LEADS_CSV_COLUMNS),
        salesteam=_frame(spark, salesteam, SALESTEAM_CSV_COLUMNS),
    )
