"""Reading a view to the client in order, without holding all of it there.

The result is stored once, dealt into ranges of at most about ``rows`` rows and sorted
in each; the driver then asks for one range after the other (and the next one while
the caller works on the last), as Arrow batches. So what the driver holds is two
ranges, whatever the size of the result. The order is total: rows that the sort
columns leave equal are ordered by their place in the stored result, which also
spreads a value that very many rows share over several ranges.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import ensure_checkpoint_dir


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as writer:
            writer.write_batch(batch)
        yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["batch"])


def ordered_ranges(df: DataFrame, order_by: list[str], rows: int) -> DataFrame:
    """``df`` in ranges of the total order, one a partition, each sorted."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/client-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    n = max(1, math.ceil(stored.count() / rows))
    placed = stored.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    keys = [*order_by, "__file", "__row"]
    return placed.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("__file", "__row")


def arrow_batches(df: DataFrame, order_by: list[str], rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """The rows of ``df`` ordered by ``order_by``, as Arrow batches; at most two ranges of about ``rows`` rows are held."""
    packed = ordered_ranges(df, order_by, rows).mapInArrow(_packed, "batch binary")
    for row in packed.toLocalIterator(prefetchPartitions=True):
        with pa.ipc.open_stream(row["batch"]) as reader:
            yield from reader
