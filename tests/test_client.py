"""Ordered client reads: total order, whole results, ranges of bounded size."""

import pyarrow as pa
from pyspark.sql import functions as F

from larder.plans import client


def test_all_rows_come_in_order_and_in_bounded_ranges(spark):
    df = spark.range(0, 40_000, 1, 7).select((F.col("id") * 7919 % 40_000).alias("k"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v"))
    batches = list(client.arrow_batches(df, ["v", "k"], rows=3000))
    table = pa.Table.from_batches(batches)
    want = sorted((r.v, r.k) for r in df.collect())
    assert list(zip(table["v"].to_pylist(), table["k"].to_pylist())) == want
    sizes = client.ordered_ranges(df, ["v"], 3000).groupBy(F.spark_partition_id()).count().collect()
    # a third of all rows share one value; it is spread over several ranges
    assert len(sizes) >= 12 and max(r["count"] for r in sizes) < 6000


def test_only_the_ranges_asked_for_are_read(spark):
    df = spark.range(100_000).withColumn("text", F.repeat(F.col("id").cast("string"), 20))
    reader = client.arrow_batches(df, ["id"], rows=1000)
    first = next(reader)
    assert first.num_rows <= 2000 and first.column(0)[0].as_py() == 0
    reader.close()


def test_empty_result_and_views(spark):
    assert list(client.arrow_batches(spark.range(0), ["id"])) == []
    nulls = spark.createDataFrame([(None, 2), ("a", 1), (None, 1)], "k string, n int")
    rows = pa.Table.from_batches(list(client.arrow_batches(nulls, ["k", "n"], rows=1))).to_pylist()
    assert rows == [{"k": None, "n": 1}, {"k": None, "n": 2}, {"k": "a", "n": 1}]
