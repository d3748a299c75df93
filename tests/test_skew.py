"""Hot keys: one name / one company holding a third of all rows.

Broadcasts are disabled and AQE's skew thresholds lowered so the shuffle-join
paths run with the hot partition split; results must equal the brute force.
"""

import contextlib
import io
import random

import pandas as pd
import pytest
from pyspark.sql import types as T

from larder.operators.participants import customer_order, explode_participants
from larder.sources.testdomain import ROW_ORDER

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _invoices(spark, n=3000, seed=3):
    rng = random.Random(seed)
    pool = [f"p{i:04d}" for i in range(500)]
    rows = []
    for order in range(n):
        names = [rng.choice(pool) for _ in range(rng.choice([1, 2, 3]))]
        if order % 3 == 0:
            names.insert(rng.randrange(len(names) + 1), "HOT")  # a third of invoices name HOT
        rows.append((order, str(order), "[" + " ".join(f"'{x}'" for x in names) + "]", names))
    schema = T.StructType([
        T.StructField(ROW_ORDER, T.LongType()), T.StructField("Order_Id", T.StringType()),
        T.StructField("Participants", T.StringType()),
    ])
    return spark.createDataFrame([r[:3] for r in rows], schema).repartition(6), rows


def test_hot_name_shuffle_join_is_exact(spark, skew_conf):
    inv, rows = _invoices(spark)
    want = pd.Series([x for r in rows for x in r[3]]).factorize()[0] + 1
    co = customer_order(inv, num_partitions=4)
    ex = explode_participants(inv)
    got = (
        ex.join(co.select("Order_Id", "Participant_Name", "Customer_Id").distinct(), ["Order_Id", "Participant_Name"])
        .orderBy(ROW_ORDER, "Position").select("Customer_Id").collect()
    )
    assert [int(r[0]) for r in got] == list(want)
    assert len(co.collect()) == len(want)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        co.explain()
    assert "isFinalPlan=true" in buf.getvalue() and "skew=true" in buf.getvalue()


def test_hot_company_fan_out_is_exact(spark, skew_conf):
    from larder.plans import views

    rng = random.Random(5)
    inv_rows, co_rows = [], []
    for i in range(3000):
        company = "C0" if i % 3 == 0 else f"C{rng.randrange(1, 40)}"
        inv_rows.append((str(i), company, rng.choice(["Breakfast", "Lunch", "Dinner"]), rng.choice(["Night", "Evening"]), rng.randrange(1, 500)))
        for _ in range(rng.randrange(1, 4)):
            co_rows.append((str(i), f"n{rng.randrange(200)}"))
    team = [(f"R{j}", f"R{j}", f"Co{j % 40}", f"C{j % 40}") for j in range(120)]
    invoice = spark.createDataFrame(inv_rows, "Order_Id string, Company_Id string, Type_of_Meal string, Part_of_Day string, Meal_Price smallint")
    co = spark.createDataFrame(co_rows, "Order_Id string, Participant_Name string")
    salesteam = spark.createDataFrame(team, "Sales_Rep string, Sales_Rep_Id string, Company_Name string, Company_Id string")
    got = {(r[0], r[1]): (r[4], r[5]) for r in views.customer_purchases(invoice, co, salesteam).collect()}
    # brute force: the literal fan-out join in pandas
    i = pd.DataFrame(inv_rows, columns=["Order_Id", "Company_Id", "Type_of_Meal", "Part_of_Day", "Meal_Price"])
    c = pd.DataFrame(co_rows, columns=["Order_Id", "Participant_Name"])
    s = pd.DataFrame(team, columns=["Sales_Rep", "Sales_Rep_Id", "Company_Name", "Company_Id"])
    j = i.merge(c, on="Order_Id").merge(s, on="Company_Id")
    want = j.groupby(["Participant_Name", "Type_of_Meal"]).agg(n=("Order_Id", "count"), t=("Meal_Price", "sum"))
    assert got == {k: (int(v.n), int(v.t)) for k, v in want.iterrows()}
