import pytest

import random

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.cleaning import clean_invoices
from larder.operators.participants import customer_order, explode_participants, first_appearance_ids
from larder.sources.testdomain import ROW_ORDER
from tests.fixtures import EXPECTED_CUSTOMER_ORDER, raw_sources


def test_customer_order_fixture(spark):
    inv = clean_invoices(raw_sources(spark).invoices)
    co = customer_order(inv, as_of="2024-01-02")
    assert sorted(map(str, [(r[0], r[1], r[2]) for r in co.select("Order_Id", "Participant_Name", "Customer_Id").collect()])) == sorted(
        map(str, EXPECTED_CUSTOMER_ORDER)
    )
    assert {r[0] for r in co.select("Last_Updated").distinct().collect()} == {__import__("datetime").date(2024, 1, 2)}
    assert co.count() == len(EXPECTED_CUSTOMER_ORDER)


def test_empty_list_gives_one_null_row(spark):
    inv = clean_invoices(raw_sources(spark).invoices)
    rows = explode_participants(inv).filter(F.col("Order_Id") == "O3").collect()
    assert len(rows) == 1 and rows[0]["Participant_Name"] is None and rows[0]["Position"] is None


def _pandas_factorize(rows):
    """Brute force: the original single-machine computation."""
    s = pd.Series([n for _, names in sorted(rows) for n in (names or [None])])
    codes = s.factorize()[0] + 1
    return [str(c) for c in codes]


def test_ids_match_brute_force_and_ignore_partitioning(spark):
    rng = random.Random(7)
    pool = [f"name{i:03d}" for i in range(300)]
    rows = []
    for order in rng.sample(range(100000), 2000):
        k = rng.choice([0, 1, 2, 3, 5])
        rows.append((order, [rng.choice(pool) for _ in range(k)]))
    want = _pandas_factorize(rows)
    schema = T.StructType([
        T.StructField(ROW_ORDER, T.LongType()),
        T.StructField("Order_Id", T.StringType()),
        T.StructField("Participants", T.StringType()),
    ])
    data = [(o, str(o), "[" + " ".join(f"'{n}'" for n in names) + "]") for o, names in rows]
    for parts in (1, 7):
        inv = spark.createDataFrame(data, schema).repartition(parts)
        for ranges in (1, 5):
            ids = first_appearance_ids(explode_participants(inv), num_partitions=ranges)
            exploded = explode_participants(inv).join(ids, "Participant_Name", "left")
            got = [
                str(r["Customer_Id"] or 0)
                for r in exploded.orderBy(ROW_ORDER, F.col("Position").asc_nulls_first()).collect()
            ]
            assert got == want, (parts, ranges)
        co = customer_order(inv, num_partitions=3)
        assert sorted(int(r[0]) for r in co.select("Customer_Id").collect()) == sorted(int(w) for w in want)


def test_ids_dense_from_one(spark):
    inv = clean_invoices(raw_sources(spark).invoices)
    ids = sorted(int(r[0]) for r in customer_order(inv).select("Customer_Id").distinct().collect())
    assert ids == [0, 1, 2, 3]


def test_unstaged_row_order_is_refused(spark):
    schema = "_row_order struct<f:string,s:long,r:long>, Order_Id string, Participants string"
    inv = spark.createDataFrame([(("a", 0, 2), "x", "['B']")], schema)
    with pytest.raises(ValueError, match="stage the sources"):
        customer_order(inv)


def test_shuffle_join_path_gives_same_ids(spark):
    inv = clean_invoices(raw_sources(spark).invoices)
    small = customer_order(inv, as_of="2024-01-02")
    want = sorted(map(str, small.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, customer_order(inv, as_of="2024-01-02").collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_names_at_all(spark):
    schema = "_row_order long, Order_Id string, Participants string"
    inv = spark.createDataFrame([(1, "a", "[]"), (2, "b", None)], schema)
    got = sorted((r[0], r[1], r[2]) for r in customer_order(inv).select("Order_Id", "Participant_Name", "Customer_Id").collect())
    assert got == [("a", None, "0"), ("b", None, "0")]
