"""Participant lists: extract, explode, and number customers by first appearance.

The customer id of a name is its rank by first appearance in source row order
(row order, then position in the list), starting at 1; a row without a name gets
id 0. Spark has no global row order and a global ``row_number()`` would pull all
names into one task, so the ranking runs as a distributed zip-with-index:

1. one row per distinct name with its first appearance ``(row order, position)``
   (a hash aggregate, partially combined before the shuffle, so a very frequent
   name costs no more than a rare one);
2. range-partition those rows by first appearance and sort inside each partition;
   every row gets its in-partition index;
3. the result is checkpointed to the shared checkpoint directory so the range
   bounds and indexes stay fixed if an executor is lost;
4. the per-partition counts (one small row per partition, never the data) give
   running offsets, which are broadcast (their size is the partition count) and
   added to the local index.

Names are then joined back to the exploded rows. Spark chooses that join from
measured sizes; as a shuffle join, a skewed (hot) name is split on the exploded
side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.scalar import extract_names
from larder.session import ensure_checkpoint_dir
from larder.sources.testdomain import ROW_ORDER

def names_per_invoice(invoice: DataFrame) -> DataFrame:
    """(Order_Id, Name_Count, Names): extracted names, joined by ``|`` for display."""
    names = extract_names("Participants")
    return invoice.select(
        "Order_Id",
        F.size(names).cast("int").alias("Name_Count"),
        F.array_join(names, "|").alias("Names"),
    )


def explode_participants(invoice: DataFrame, keep_order: bool = True) -> DataFrame:
    """One row per (invoice, listed name); an empty or missing list gives one row
    with null ``Position`` and ``Participant_Name``."""
    cols = [ROW_ORDER] if keep_order and ROW_ORDER in invoice.columns else []
    return invoice.select(
        *cols,
        "Order_Id",
        F.posexplode_outer(extract_names("Participants")).alias("Position", "Participant_Name"),
    )


def first_appearance_ids(
    exploded: DataFrame,
    name_col: str = "Participant_Name",
    order_cols: tuple[str, ...] = (ROW_ORDER, "Position"),
    num_partitions: int | None = None,
) -> DataFrame:
    """(name, Customer_Id long): dense rank of each non-null name by first appearance."""
    spark = exploded.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    firsts = (
        exploded.filter(F.col(name_col).isNotNull())
        .groupBy(name_col)
        .agg(F.min(_appearance_key(exploded, order_cols)).alias("_first"))
    )
    ranked = (
        firsts.repartitionByRange(n, "_first")
        .sortWithinPartitions("_first")
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_rid", F.monotonically_increasing_id())
        .select(name_col, "_pid", "_rid")
    )
    ranked = ranked.checkpoint(eager=True)
    # one row per range partition (at most ``n`` rows): the partition sizes become
    # running offsets, exactly as RDD.zipWithIndex does it
    sizes = ranked.groupBy("_pid").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_rid").alias("_rid0"),
    ).collect()
    offsets, running = [], 0
    for row in sorted(sizes, key=lambda r: r["_pid"]):
        offsets.append((row["_pid"], row["_rid0"], running))
        running += row["_n"]
    offsets_df = spark.createDataFrame(offsets, "_pid int, _rid0 long, _offset long")
    return ranked.join(F.broadcast(offsets_df), "_pid").select(
        name_col,
        (F.col("_offset") + F.col("_rid") - F.col("_rid0") + F.lit(1)).alias("Customer_Id"),
    )


POSITION_SCALE = 10 ** 10  # list positions are ints (< 2^31 < 10^10)


def _appearance_key(df: DataFrame, order_cols: tuple[str, ...]) -> Column:
    """Sortable first-appearance key of (row order, list position).

    The pair is packed into one ``decimal(38,0)`` (``row * 10^10 + position``,
    exact for any long row order), whose ``min`` runs in a hash aggregate. Text
    sources get their long row order when they are staged.
    """
    row_col, pos_col = order_cols
    if not isinstance(df.schema[row_col].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        raise ValueError(f"{row_col} must be an integer row order; stage the sources first")
    return F.col(row_col).cast("decimal(38,0)") * F.lit(POSITION_SCALE) + F.col(pos_col)


def _run_date(as_of) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def customer_order(
    invoice: DataFrame,
    as_of=None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Order-to-participant table: Order_Id, Participant_Name, Customer_Id (text),
    Last_Updated (run date, default today)."""
    exploded = explode_participants(invoice)
    ids = first_appearance_ids(exploded, num_partitions=num_partitions)
    joined = exploded.join(ids, "Participant_Name", "left")
    return joined.select(
        "Order_Id",
        "Participant_Name",
        F.coalesce(F.col("Customer_Id"), F.lit(0)).cast("string").alias("Customer_Id"),
        _run_date(as_of).alias("Last_Updated"),
    )
