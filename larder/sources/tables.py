"""The four cleaned tables the views read, built lazily from raw sources."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from larder.operators.cleaning import clean_invoices, clean_leads, clean_salesteam
from larder.operators.participants import customer_order, explode_participants
from larder.sources.testdomain import RawSources, load_test_sources


class Tables:
    """Cleaned ``invoice``, ``orders`` (leads), ``salesteam`` and ``customer_order``.

    ``orders`` here is the order-lead table; in code it is called ``leads`` so it
    is not confused with the TPC-H ``orders`` test table it is derived from.
    """

    def __init__(self, raw: RawSources, strict: bool = True, as_of=None, lead_date_format: str | None = None):
        self.raw = raw
        self.strict = strict
        self.as_of = as_of
        self.lead_date_format = lead_date_format

    @cached_property
    def invoice(self) -> DataFrame:
        return clean_invoices(self.raw.invoices, strict=self.strict)

    @cached_property
    def leads(self) -> DataFrame:
        kw = {"date_format": self.lead_date_format} if self.lead_date_format else {}
        return clean_leads(self.raw.leads, strict=self.strict, **kw)

    @cached_property
    def salesteam(self) -> DataFrame:
        return clean_salesteam(self.raw.salesteam)

    @cached_property
    def customer_order(self) -> DataFrame:
        # eager: ranks names and checkpoints the ranking
        return customer_order(self.invoice, as_of=self.as_of)

    @cached_property
    def order_names(self) -> DataFrame:
        """``customer_order`` without ids: same rows, no ranking."""
        return explode_participants(self.invoice, keep_order=False).select("Order_Id", "Participant_Name")

    def staged(self) -> Tables:
        """The same tables, each built once and stored with the sources, for work that passes over them often."""
        # imported here, since publish needs the operators that these tables are built with
        from larder.sources.publish import stage_sources, stored

        spark = self.raw.invoices.sparkSession
        out = Tables(stage_sources(spark, self.raw), strict=self.strict, as_of=self.as_of, lead_date_format=self.lead_date_format)
        out.invoice, out.leads = stored(out.invoice, "invoice"), stored(out.leads, "orders")
        out.customer_order = stored(out.customer_order, "customer-order")
        return out

    def as_dict(self, with_customer_order: bool = True, ids: bool = True) -> dict[str, DataFrame]:
        """Cleaned tables under their target table names."""
        out = {"orders": self.leads, "invoice": self.invoice, "salesteam": self.salesteam}
        if with_customer_order:
            out["customer_order"] = self.customer_order if ids else self.order_names
        return out


def tables_from_test_data(spark: SparkSession, sf_dir: str, strict: bool = True, as_of=None) -> Tables:
    return Tables(load_test_sources(spark, sf_dir), strict=strict, as_of=as_of)
