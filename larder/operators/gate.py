"""Load gate: which raw rows may be published, and why the others may not.

The declared constraints decide row by row, so that one bad row no longer stops a
load. Every rejected row is listed with all its reasons. The tables are decided
parents first:

1. leads: rules of a row (format, not null, length, range), then the first lead, in
   file order, of each primary key;
2. invoices: rules of a row, references to *accepted* leads, then the first invoice
   of each order (the unique key, which includes the primary key);
3. sales team: rules of a row, references to accepted leads.

Removing a lead so removes what refers to it, and since no reference points back, one
pass in this order is the state in which nothing changes any more. Participant rows
are made from accepted invoices and refer to their orders.

Keys are settled by ``min`` of the row order per key (partially aggregated) and a
join on the row order, which is unique, so a key that a third of all rows share is
no hot group. References meet the distinct accepted keys. Each decision is stored
once and read by the next.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.scalar import LEAD_DATE_FORMAT, parse_invoice_date, parse_lead_date, parse_meal_ts
from larder.operators import quality
from larder.session import ensure_checkpoint_dir
from larder.sources.schemas import MEAL_TYPES
from larder.sources.testdomain import ROW_ORDER, RawSources

REASONS = "_reasons"
#: Columns of a raw frame that name a row in the list of rejects.
ROW_KEYS = {"orders": ["Order Id", "Company Id"], "invoice": ["Order Id"], "salesteam": ["Sales Rep Id"]}


@dataclass
class Gate:
    """Decided raw rows: ``accepted`` feeds the load, ``decided`` holds every row and its reasons."""

    accepted: RawSources
    decided: dict[str, DataFrame]

    def rejects(self) -> DataFrame:
        """(table_name, row_order, row_key, reasons, row): rejected rows, with the raw text as JSON."""
        parts = None
        for table, df in self.decided.items():
            raw = [c for c in df.columns if c not in (ROW_ORDER, REASONS)]
            own = df.filter(F.size(REASONS) > 0).select(
                F.lit(table).alias("table_name"), F.col(ROW_ORDER).alias("row_order"), _row_key(table).alias("row_key"),
                F.array_join(REASONS, ",").alias("reasons"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw])).alias("row"),
            )
            parts = own if parts is None else parts.unionByName(own)
        return parts

    def admitted(self) -> DataFrame:
        """(table_name, row_order, row_key) of the rows that may be published."""
        parts = None
        for table, df in self.decided.items():
            own = df.filter(F.size(REASONS) == 0).select(F.lit(table).alias("table_name"), F.col(ROW_ORDER).alias("row_order"), _row_key(table).alias("row_key"))
            parts = own if parts is None else parts.unionByName(own)
        return parts


def _row_key(table: str) -> Column:
    return F.concat_ws("|", *[F.col(f"`{c}`") for c in ROW_KEYS[table]])


def _raw(column: str) -> Column:
    return F.col(f"`{column.replace('_', ' ')}`")


def _reasons(rules: list[tuple[str, Column]]) -> Column:
    """The names of the rules that a row breaks, in the order given."""
    named = F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules])
    return F.filter(named, lambda x: x.isNotNull())


def _common_rules(table: str, parsed: dict[str, Column]) -> list[tuple[str, Column]]:
    rules = [(f"format:{c}", _raw(c).isNotNull() & value.isNull()) for c, value in parsed.items()]
    rules += [(f"not_null:{c}", _raw(c).isNull()) for c in quality.NOT_NULL.get(table, [])]
    return rules + [(f"length:{c}", F.length(_raw(c)) > n) for c, n in quality.MAX_LENGTHS[table].items()]


def _range_rules(source: str) -> list[tuple[str, Column]]:
    return [(f"range:{c.replace(' ', '_')}", quality._out_of_range(F.col(f"`{c}`"), lo, hi)) for c, (lo, hi) in quality.RAW_RANGES[source].items()]


def _add(df: DataFrame, *rules: tuple[str, Column]) -> DataFrame:
    return df.withColumn(REASONS, F.concat(REASONS, _reasons(list(rules))))


def _only_first(df: DataFrame, keys: list[str], reason: str) -> DataFrame:
    """Rows without a reason but not the first of their key, in file order, get ``reason``."""
    good = df.filter(F.size(REASONS) == 0)
    firsts = good.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(ROW_ORDER).alias("_first")).select("_first", F.lit(True).alias("_is_first"))
    marked = df.join(firsts, F.col(ROW_ORDER) == F.col("_first"), "left")
    return _add(marked, (reason, (F.size(REASONS) == 0) & F.col("_is_first").isNull())).drop("_first", "_is_first")


def _refers(df: DataFrame, key: str, parents: DataFrame, reason: str) -> DataFrame:
    """Rows whose key is not null and not among the parents' get ``reason``."""
    known = parents.select(F.col(f"`{key}`").alias("_key"), F.lit(True).alias("_known")).distinct()
    marked = df.join(known, F.col(f"`{key}`") == F.col("_key"), "left")
    return _add(marked, (reason, F.col(f"`{key}`").isNotNull() & F.col("_known").isNull())).drop("_key", "_known")


def decide(raw: RawSources, lead_date_format: str | None = None, root: str | None = None) -> Gate:
    """Decide every row of the (staged) raw frames; the decisions are stored under ``root`` or the checkpoint folder."""
    spark = raw.leads.sparkSession
    base = f"{(root or ensure_checkpoint_dir(spark)).rstrip('/')}/gate-{uuid.uuid4().hex}"

    def stored(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    leads = raw.leads.withColumn(REASONS, _reasons([
        *_common_rules("orders", {"Date": parse_lead_date("Date", lead_date_format or LEAD_DATE_FORMAT, strict=False)}),
        *_range_rules("orderleads"),
    ]))
    leads = stored("orders", _only_first(leads, ["Order Id", "Company Id"], "primary_key:Order_Id,Company_Id"))
    parents = leads.filter(F.size(REASONS) == 0)

    invoices = raw.invoices.withColumn(REASONS, _reasons([
        *_common_rules("invoice", {"Date": parse_invoice_date("Date", strict=False), "Date_of_Meal": parse_meal_ts(_raw("Date_of_Meal"), strict=False)}),
        ("domain:Type_of_Meal", _raw("Type_of_Meal").isNotNull() & ~_raw("Type_of_Meal").isin(*MEAL_TYPES)),
        *_range_rules("invoices"),
        ("range:Number_of_Participants", quality._too_many_participants()),
    ]))
    invoices = _refers(invoices, "Order Id", parents, "foreign_key:Order_Id")
    invoices = _refers(invoices, "Company Id", parents, "foreign_key:Company_Id")
    invoices = stored("invoice", _only_first(invoices, ["Order Id"], "unique:Order_Id"))

    team = raw.salesteam.withColumn(REASONS, _reasons(_common_rules("salesteam", {})))
    team = stored("salesteam", _refers(team, "Company Id", parents, "foreign_key:Company_Id"))

    decided = {"orders": leads, "invoice": invoices, "salesteam": team}
    good = {k: df.filter(F.size(REASONS) == 0).drop(REASONS) for k, df in decided.items()}
    return Gate(RawSources(invoices=good["invoice"], leads=good["orders"], salesteam=good["salesteam"]), decided)
