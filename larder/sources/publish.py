"""Publishing: full refresh of the four tables, catalog registration, audit.

A refresh writes every table under names of its own run, and becomes visible in one
catalog step. The public names are persistent views that never change: each reads
one of two slots, chosen by the pointer view ``current_slot``. A refresh points the
slot that nobody reads at its run's tables and then replaces the pointer, so a
reader sees all tables of one run or all of another, in any session; a failed write
leaves the previous set readable. The pointer is a literal, which the optimizer
folds: a plan holds the scan of the chosen slot only. ``drop_old_runs`` removes the
tables and files of earlier runs, and ``remove_staged`` a run's staged sources, when
no reader needs them any more. One refresh of a database may run at a time.

Layout choices for large data:

* ``invoice`` is partitioned by ``Year`` (directory per year) so filters on the
  year prune whole directories;
* ``invoice``, ``orders`` and ``customer_order`` are bucketed and sorted by
  ``Order_Id`` into the same number of buckets, so the views' joins on
  ``Order_Id`` read co-partitioned buckets and need no shuffle; each table is
  first repartitioned by the bucket key into the bucket count (the same hash
  Spark buckets with), so each write task holds exactly one bucket and writes
  one file for it (per year for ``invoice``), not one file per bucket per task;
* row counts are collected with ``observe`` while writing: the audit costs no
  extra scan.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.conform import conform
from larder.sources.schemas import TARGET_SCHEMAS

DEFAULT_DATABASE = "larder_mart"
BUCKET_KEY = "Order_Id"
BUCKETED = ("orders", "invoice", "customer_order")
RUN_MARK = "__run_"
SLOT_MARK = "__slot_"
SLOTS = ("a", "b")
POINTER = "current_slot"
REJECTED = "rejected_rows"
LOAD_ORDER = ("orders", "invoice", "salesteam", "customer_order")  # parents first


def stage_counts(raw: dict[str, DataFrame], tables: dict[str, DataFrame]) -> DataFrame:
    """(stage, table_name, row_count) for the extracted and the loadable tables."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(stage).alias("stage"), F.lit(name).alias("table_name"), "row_count"
        )
        for stage, frames in (("extract", raw), ("load", tables))
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def table_root(spark: SparkSession, database: str, root: str | None) -> str:
    """Directory the database's run folders go to: ``root``, else under the warehouse."""
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    return f"{warehouse.rstrip('/')}/{database}.data"


def with_year(invoice: DataFrame) -> DataFrame:
    return invoice.withColumn("Year", F.year("Date").cast("int"))


def write_table(
    df: DataFrame,
    table: str,
    path: str,
    buckets: int,
    partition_by: list[str] | None = None,
    bucket: bool = True,
) -> Observation:
    """Overwrite one table at ``path`` (registered as ``table``); returns the row-count observation."""
    obs = Observation(f"audit_{table.replace('.', '_')}_{uuid.uuid4().hex[:8]}")
    staged = df.repartition(buckets, BUCKET_KEY) if bucket else df
    # observed in the writing (result) stage: a re-run map stage after a lost
    # executor cannot count its rows twice
    writer_df = staged.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = writer_df.write.mode("overwrite").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket:
        writer = writer.bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY)
    writer.saveAsTable(table)
    return obs


def refresh(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    database: str = DEFAULT_DATABASE,
    root: str | None = None,
    buckets: int | None = None,
    strict: bool = True,
    rejected: DataFrame | None = None,
) -> DataFrame:
    """Full refresh of ``orders``, ``invoice``, ``salesteam``, ``customer_order``.

    ``rejected`` (rows that a load gate kept back) is published beside them as
    ``rejected_rows``. Returns the audit as a DataFrame (stage, table_name, row_count).
    """
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    run = f"{time.strftime('%Y%m%dT%H%M%S')}_{uuid.uuid4().hex[:8]}"
    base = f"{table_root(spark, database, root)}/run={run}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    written, observations = {}, {}
    for name in LOAD_ORDER:
        df = conform(tables[name], TARGET_SCHEMAS[name], strict=strict)
        parts = None
        if name == "invoice":
            df, parts = with_year(df), ["Year"]
        written[name] = f"{database}.{name}{RUN_MARK}{run}"
        observations[name] = write_table(
            df, written[name], f"{base}/{name}", n, partition_by=parts, bucket=name in BUCKETED
        )
    if rejected is not None:
        written[REJECTED] = f"{database}.{REJECTED}{RUN_MARK}{run}"
        write_table(rejected, written[REJECTED], f"{base}/{REJECTED}", n, bucket=False)
    _show(spark, database, run, {name: f"SELECT * FROM {table}" for name, table in written.items()})
    rows = [("load", name, int(observations[name].get["rows"])) for name in LOAD_ORDER]
    return spark.createDataFrame(rows, "stage string, table_name string, row_count long")


def replace_view(spark: SparkSession, name: str, sql: str) -> None:
    """Point a persistent view at ``sql`` in one catalog step."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")


def current_run(spark: SparkSession, database: str = DEFAULT_DATABASE) -> tuple[str, str] | None:
    """(slot, run) that the public names show, if any."""
    if not spark.catalog.tableExists(f"{database}.{POINTER}"):
        return None
    return tuple(spark.table(f"{database}.{POINTER}").select("slot", "run").first())


def _point(spark: SparkSession, database: str, slot: str, run: str) -> None:
    replace_view(spark, f"{database}.{POINTER}", f"SELECT '{slot}' AS slot, '{run}' AS run")


def _show(spark: SparkSession, database: str, run: str, selects: dict[str, str]) -> None:
    """Make the public names show these tables: fill the idle slot, then replace the pointer."""
    shown = current_run(spark, database)
    idle = SLOTS[1] if shown and shown[0] == SLOTS[0] else SLOTS[0]
    if REJECTED not in selects and spark.catalog.tableExists(f"{database}.{REJECTED}"):
        old = spark.table(f"{database}.{REJECTED}").schema  # this run has none: an empty table without files
        selects = {**selects, REJECTED: "SELECT " + ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in old) + " WHERE false"}
    for name, select in selects.items():
        replace_view(spark, f"{database}.{name}{SLOT_MARK}{idle}", select)
    if shown is None:
        _point(spark, database, idle, run)
    for name, select in selects.items():
        if not spark.catalog.tableExists(f"{database}.{name}"):
            other = SLOTS[SLOTS[0] == idle]
            replace_view(spark, f"{database}.{name}{SLOT_MARK}{other}", select if shown is None else f"{select} WHERE false")
            chosen = [f"SELECT * FROM {database}.{name}{SLOT_MARK}{s} WHERE (SELECT slot FROM {database}.{POINTER}) = '{s}'" for s in SLOTS]
            replace_view(spark, f"{database}.{name}", " UNION ALL ".join(chosen))
    _point(spark, database, idle, run)


def drop_old_runs(spark: SparkSession, database: str = DEFAULT_DATABASE, keep: int = 2) -> list[str]:
    """Drop the tables, files included, of all but the last ``keep`` runs; returns what was dropped.

    The run that the public names show is never dropped. Call it once readers of
    the older runs are done.
    """
    tables = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary and RUN_MARK in t.name]
    runs = sorted({t.split(RUN_MARK)[1] for t in tables})
    slot, shown = current_run(spark, database)
    old = [r for r in runs[: max(0, len(runs) - keep)] if r != shown.lower()]
    # the idle slot must not name tables that go: it shows the current ones from now on
    idle = SLOTS[SLOTS[0] == slot]
    for name in list_tables(spark, database):
        if spark.catalog.tableExists(f"{database}.{name}{SLOT_MARK}{idle}"):
            replace_view(spark, f"{database}.{name}{SLOT_MARK}{idle}", f"SELECT * FROM {database}.{name}{SLOT_MARK}{slot}")
    dropped = []
    for table in tables:
        if table.split(RUN_MARK)[1] in old:
            location = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{table}").filter("col_name = 'Location'").first()[1]
            spark.sql(f"DROP TABLE {database}.{table}")
            _remove(spark, location)
            dropped.append(table)
    return dropped


def _remove(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def published(spark: SparkSession, database: str = DEFAULT_DATABASE) -> dict[str, DataFrame]:
    """The published tables as DataFrames, all of one run (``invoice`` without its ``Year`` column)."""
    while True:
        shown = current_run(spark, database)
        out = {name: spark.table(f"{database}.{name}") for name in LOAD_ORDER}
        if current_run(spark, database) == shown:  # no refresh in between
            out["invoice"] = out["invoice"].drop("Year")
            return out


def list_tables(spark: SparkSession, database: str = DEFAULT_DATABASE) -> list[str]:
    """Public names of the schema (tables of single runs, slots and session temp views excluded)."""
    hidden = (RUN_MARK, SLOT_MARK, POINTER)
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary and not any(h in t.name for h in hidden))


def invoice_for_year(spark: SparkSession, year: int, database: str = DEFAULT_DATABASE) -> DataFrame:
    """Invoices of one year; the filter on the partition column prunes directories."""
    return spark.table(f"{database}.invoice").filter(F.col("Year") == year)


def refresh_from_raw(
    spark: SparkSession,
    raw,
    database: str = DEFAULT_DATABASE,
    root: str | None = None,
    buckets: int | None = None,
    strict: bool = True,
    as_of=None,
    lead_date_format: str | None = None,
    rejected: DataFrame | None = None,
    customer_order: DataFrame | None = None,
) -> DataFrame:
    """The whole job: clean the raw frames, number the customers, refresh the tables.

    The raw frames are expected to be stored (``stage_sources``): the cleaned
    invoice is one narrow select over them, read once for its own write and,
    column-pruned, for the customer table. ``customer_order`` is that table where
    the caller has numbered the names of these frames already.
    """
    from larder.sources.tables import Tables

    cleaned = Tables(raw, strict=strict, as_of=as_of, lead_date_format=lead_date_format)
    tables = cleaned.as_dict(with_customer_order=customer_order is None)
    if customer_order is not None:
        tables["customer_order"] = customer_order
    return refresh(spark, tables, database=database, root=root, buckets=buckets, strict=strict, rejected=rejected)


def stage_sources(spark: SparkSession, raw, root: str | None = None):
    """Write the raw frames once as Parquet and return frames that read them back.

    Profiling, the integrity checks and the load each pass over the sources; on
    text inputs every pass would re-parse the files. The staged copy (in shared
    storage: ``root`` or the checkpoint directory) is read column-pruned instead,
    and it cuts the lineage, so a lost executor never re-reads the text. Text
    sources get their rows numbered here. ``remove_staged`` deletes the copy.
    """
    from larder.session import ensure_checkpoint_dir
    from larder.sources.csv import number_rows
    from larder.sources.testdomain import ROW_ORDER, RawSources

    base = (root or ensure_checkpoint_dir(spark)).rstrip("/") + f"/staged-sources-{uuid.uuid4().hex}"
    frames = {}
    for name, df in (("invoices", raw.invoices), ("leads", raw.leads), ("salesteam", raw.salesteam)):
        df.write.mode("overwrite").parquet(f"{base}/{name}")
        stored = spark.read.parquet(f"{base}/{name}")
        text_order = ROW_ORDER in df.columns and isinstance(df.schema[ROW_ORDER].dataType, T.StructType)
        frames[name] = number_rows(stored) if text_order else stored
    return RawSources(**frames, path=base)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the checkpoint directory and read back, column-pruned by every later pass."""
    from larder.session import ensure_checkpoint_dir

    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_staged(spark: SparkSession, raw) -> None:
    """Delete a staged copy of the sources; frames over it cannot be read afterwards."""
    if raw.path:
        _remove(spark, raw.path)
