"""Benchmark: stage sources, full refresh, then every view, check and profile.

The raw frames are derived from the test tables and staged once as Parquet (as
the job stages its CSV inputs); the refresh cleans them, numbers customers and
writes the four tables; views and checks read the published tables, profiles and
cleaning steps the staged sources. Every key of the reference's operators is
timed; the corpus queries are measured by their own check.

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_EVENT_LOG (optional directory: write a Spark event log there, then read
it with tools/stage_times.py).
A short untimed warm-up at sf0.001 runs first so JVM start-up and code
generation are not billed to the first query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from larder.functions import scalar  # noqa: E402
from larder.operators import participants, profiling, quality  # noqa: E402
from larder.operators.cleaning import underscore_columns  # noqa: E402
from larder.operators.conform import conform  # noqa: E402
from larder.plans import reports, views  # noqa: E402
from larder.session import build_session  # noqa: E402
from larder.sources import publish  # noqa: E402
from larder.sources.schemas import TARGET_SCHEMAS  # noqa: E402
from larder.sources.tables import Tables  # noqa: E402
from larder.sources.testdomain import load_test_sources  # noqa: E402

WARMUP_DIR = "/root/testdata/sf0.001"


def view_queries(p: dict, raw: dict) -> dict:
    inv, leads, team, co = p["invoice"], p["orders"], p["salesteam"], p["customer_order"]
    return {
        "customer_stats": lambda: views.customer_stats(co, inv),
        "company_metrics": lambda: views.company_metrics(leads, inv),
        "company_metrics_by_meal": lambda: views.company_metrics_by_meal(leads, inv),
        "sales_rep_performance": lambda: views.sales_rep_performance(team, leads, inv),
        "customer_purchases": lambda: views.customer_purchases(inv, co, team),
        "sales_by_year": lambda: views.sales_by_year(inv),
        "percent_converted": lambda: views.percent_converted(leads),
        "avg_meal_price": lambda: views.avg_meal_price(inv),
        "total_sales": lambda: views.total_sales(inv),
        "avg_participants": lambda: views.avg_participants(inv),
        "difference_days": lambda: views.difference_days(inv),
        "top_converted": lambda: reports.top_converted(views.percent_converted(leads)),
        "profile_nulls": lambda: profiling.profile_nulls(raw),
        "profile_duplicates": lambda: profiling.profile_duplicates(raw),
        "check_not_null": lambda: quality.check_not_null(p),
        "check_pk": lambda: quality.check_pk(p),
        "check_fk": lambda: quality.check_fk(p),
        "check_domain": lambda: quality.check_domain(p),
        "check_length": lambda: quality.check_length(p),
        "check_range": lambda: quality.check_range(raw),
        "check_unique_order": lambda: quality.check_unique_order(p),
        "check_participants": lambda: quality.check_participants(p),
        "integrity_violations": lambda: quality.violation_rows(p, raw),
        "avg_meal_price_ranked": lambda: reports.avg_meal_price_ranked(views.avg_meal_price(inv)),
        "preview_difference_days": lambda: reports.preview_difference_days(views.difference_days(inv)),
        "invoice_year_pruned": lambda: publish.invoice_for_year(inv.sparkSession, 1998),
    }


def cleaning_queries(t: Tables) -> dict:
    """Cleaning steps, ids and loads from the staged sources."""
    lenient = Tables(t.raw, strict=False, as_of=t.as_of)
    return {
        "parse_invoice_date": lambda: t.invoice.select("Order_Id", "Date"),
        "parse_lead_date": lambda: t.leads.select("Order_Id", "Date"),
        "strip_offset": lambda: underscore_columns(t.raw.invoices).select("Order_Id", scalar.strip_offset("Date_of_Meal").alias("x")),
        "parse_meal_ts": lambda: t.invoice.select("Order_Id", "Date_of_Meal"),
        "meal_hour": lambda: t.invoice.select("Order_Id", scalar.meal_hour("Date_of_Meal").alias("Meal_Hour")),
        "part_of_day": lambda: t.invoice.select("Order_Id", "Part_of_Day"),
        "participant_count": lambda: t.invoice.select("Order_Id", "Number_of_Participants"),
        "extract_names": lambda: participants.names_per_invoice(t.invoice),
        "explode_participants": lambda: participants.explode_participants(t.invoice, keep_order=False),
        "customer_order": lambda: t.customer_order,
        "load_orders": lambda: conform(t.leads, TARGET_SCHEMAS["orders"]),
        "load_invoice": lambda: conform(t.invoice, TARGET_SCHEMAS["invoice"]),
        "load_salesteam": lambda: conform(t.salesteam, TARGET_SCHEMAS["salesteam"]),
        "load_customer_order": lambda: conform(Tables(t.raw, as_of=t.as_of).customer_order, TARGET_SCHEMAS["customer_order"]),
        "load_audit": lambda: publish.stage_counts(t.raw.as_dict(), lenient.as_dict(ids=False)),
    }


def run_all(spark, sf_dir: str) -> dict[str, float]:
    times: dict[str, float] = {}
    sc = spark.sparkContext
    sc.setJobDescription(f"stage_sources {sf_dir}")
    t0 = time.perf_counter()
    raw_sources = publish.stage_sources(spark, load_test_sources(spark, sf_dir))
    times["stage_sources"] = time.perf_counter() - t0
    sc.setJobDescription(f"full_refresh {sf_dir}")
    t0 = time.perf_counter()
    publish.refresh_from_raw(spark, raw_sources)
    times["full_refresh"] = time.perf_counter() - t0
    p = publish.published(spark)
    raw = raw_sources.as_dict()
    tables = Tables(raw_sources, as_of="2024-01-01")
    for name, q in {**view_queries(p, raw), **cleaning_queries(tables)}.items():
        sc.setJobDescription(f"{name} {sf_dir}")
        t0 = time.perf_counter()
        q().write.format("noop").mode("overwrite").save()
        times[name] = time.perf_counter() - t0
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="larder-bench-")
    extra = {
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.ui.showConsoleProgress": "false",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    if os.environ.get("BENCH_EVENT_LOG"):
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, extra=extra)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    if os.path.isdir(WARMUP_DIR) and sf_dir != WARMUP_DIR:
        run_all(spark, WARMUP_DIR)
    times = run_all(spark, sf_dir)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(m.group(1)) if m else sf_dir,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
