"""Raw and target schemas of the four tables.

Raw frames are read with every column as a string (type inference would, for
example, turn ``Date of Meal`` with its ``+02:00`` suffix into a zoned timestamp
and shift it); the cleaning step casts to the target types below.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# CSV header names in file order (rows bind by position), target
# column names and types, value domains and text-length limits of the target
# tables. These must equal the source system's contract.
# ---------------------------------------------------------------------------
INVOICE_CSV_COLUMNS = [
    "Order Id", "Date", "Meal Id", "Company Id", "Date of Meal",
    "Participants", "Meal Price", "Type of Meal",
]
LEADS_CSV_COLUMNS = [
    "Order Id", "Company Id", "Company Name", "Date", "Order Value", "Converted",
]
SALESTEAM_CSV_COLUMNS = ["Sales Rep", "Sales Rep Id", "Company Name", "Company Id"]

MEAL_TYPES = ["Breakfast", "Lunch", "Dinner"]
# Labels the part-of-day rule produces ("Evening" included) ...
PART_OF_DAY_LABELS = [
    "Early Morning", "Late Morning", "Early Afternoon", "Evening", "Night", "Late Night",
]
# ... and the narrower set the original table declaration accepts (no "Evening").
PART_OF_DAY_DECLARED = ["Early Morning", "Late Morning", "Early Afternoon", "Night", "Late Night"]

ID_MAX_LENGTH = 100
TEXT_MAX_LENGTH = 255

ORDERS_SCHEMA = T.StructType([
    T.StructField("Order_Id", T.StringType(), False),
    T.StructField("Company_Id", T.StringType(), False),
    T.StructField("Company_Name", T.StringType(), True),
    T.StructField("Date", T.DateType(), True),
    T.StructField("Order_Value", T.ShortType(), True),
    T.StructField("Converted", T.ShortType(), True),  # TINYINT UNSIGNED: 0..255
])

INVOICE_SCHEMA = T.StructType([
    T.StructField("Order_Id", T.StringType(), False),
    T.StructField("Date", T.DateType(), False),
    T.StructField("Meal_Id", T.StringType(), False),
    T.StructField("Company_Id", T.StringType(), False),
    T.StructField("Date_of_Meal", T.TimestampNTZType(), False),
    T.StructField("Participants", T.StringType(), True),
    T.StructField("Meal_Price", T.ShortType(), True),
    T.StructField("Type_of_Meal", T.StringType(), True),
    T.StructField("Part_of_Day", T.StringType(), True),
    T.StructField("Number_of_Participants", T.ByteType(), True),
])

SALESTEAM_SCHEMA = T.StructType([
    T.StructField("Sales_Rep", T.StringType(), True),
    T.StructField("Sales_Rep_Id", T.StringType(), True),
    T.StructField("Company_Name", T.StringType(), True),
    T.StructField("Company_Id", T.StringType(), True),
])

CUSTOMER_ORDER_SCHEMA = T.StructType([
    T.StructField("Order_Id", T.StringType(), True),
    T.StructField("Participant_Name", T.StringType(), True),
    T.StructField("Customer_Id", T.StringType(), True),
    T.StructField("Last_Updated", T.DateType(), True),
])

TARGET_SCHEMAS = {
    "orders": ORDERS_SCHEMA,
    "invoice": INVOICE_SCHEMA,
    "salesteam": SALESTEAM_SCHEMA,
    "customer_order": CUSTOMER_ORDER_SCHEMA,
}


def string_schema(columns: list[str]) -> T.StructType:
    """All-string schema for a raw CSV with the given header order."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
