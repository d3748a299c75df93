"""Run the whole batch job from the three CSV files (``spark-submit -m`` style).

    python -m larder.job --invoices Invoices.csv --leads OrderLeads.csv \\
        --salesteam SalesTeam.csv --database larder_mart [--buckets 4096]

Stages: read (staged once as Parquet) → profile → integrity checks → clean,
number customers, refresh the four tables → register the views. Each stage logs its summary rows (small,
bounded DataFrames) so a missing line shows where a run stopped.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from larder.operators import dates, gate, profiling, quality
from larder.plans.catalog import create_views, register_views
from larder.session import build_session, ensure_checkpoint_dir
from larder.sources import publish
from larder.sources.csv import load_csv_sources
from larder.sources.tables import Tables

log = logging.getLogger("larder.job")

#: Checks whose findings do not stop a load: the source job loads such rows too.
REPORTED = ("domain_declared", "participants")


def _log_rows(title: str, df) -> None:
    log.info("%s:\n%s", title, "\n".join(str(r.asDict()) for r in df.collect()))


def run(
    spark: SparkSession,
    invoices: str,
    leads: str,
    salesteam: str,
    database: str = publish.DEFAULT_DATABASE,
    buckets: int | None = None,
    lead_date_format: str | None = None,
    as_of: str | None = None,
    publish_anyway: bool = False,
    multi_line: bool = True,
    reject_rows: bool = False,
) -> list[str]:
    """Load the three files; refuses to publish tables that break a declared constraint.

    With ``reject_rows`` the load gate keeps such rows back instead, lists them in
    ``rejected_rows`` and publishes the others. ``REPORTED`` checks are about text
    the load accepts: they are logged only.
    """
    ensure_checkpoint_dir(spark)
    raw = publish.stage_sources(spark, load_csv_sources(spark, invoices, leads, salesteam, multi_line))
    log.info("sources read and staged")
    _log_rows("missing values", profiling.profile_nulls(raw.as_dict()))
    _log_rows("repeated rows", profiling.profile_duplicates(raw.as_dict()))
    _log_rows("column types", profiling.profile_types(raw.as_dict()))
    lead_date_format = lead_date_format or dates.infer_format(raw.leads, mixed=reject_rows or publish_anyway)
    log.info("lead dates are %s", lead_date_format)
    rejected = None
    if reject_rows:
        decided = gate.decide(raw, lead_date_format)
        raw, rejected = decided.accepted, decided.rejects()
        _log_rows("rejected rows", rejected.groupBy("table_name").count())
    lenient = Tables(raw, strict=False, as_of=as_of, lead_date_format=lead_date_format)
    checks = [
        quality.check_not_null(lenient.as_dict(False)),
        quality.check_pk(lenient.as_dict(False)),
        quality.check_unique_order(lenient.as_dict(False)),
        quality.check_fk(lenient.as_dict(ids=False)),
        quality.check_domain(lenient.as_dict(False)),
        quality.check_length(lenient.as_dict()),
        quality.check_range(raw.as_dict()),
        quality.check_participants(lenient.as_dict(False)),
    ]
    violations = 0
    for c in checks:
        rows = c.collect()  # a handful of summary rows per check
        violations += sum(r["violations"] for r in rows if r["check_name"] not in REPORTED)
        log.info("%s", [r.asDict() for r in rows])
    if violations and not publish_anyway:
        raise RuntimeError(f"{violations} constraint violations; not publishing")
    # ids and names come from columns that are text either way, so the numbering just checked is loaded
    audit = publish.refresh_from_raw(
        spark, raw, database=database, buckets=buckets, as_of=as_of, lead_date_format=lead_date_format,
        rejected=rejected, customer_order=lenient.customer_order,
    )
    _log_rows("loaded", audit)
    published = publish.published(spark, database)
    names = register_views(spark, published)
    log.info("views registered: %s", ", ".join(names))
    log.info("views stored: %s", ", ".join(create_views(spark, database)))
    return names


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--invoices", required=True)
    ap.add_argument("--leads", required=True)
    ap.add_argument("--salesteam", required=True)
    ap.add_argument("--database", default=publish.DEFAULT_DATABASE)
    ap.add_argument("--buckets", type=int)
    ap.add_argument("--lead-date-format")
    ap.add_argument("--as-of")
    ap.add_argument("--publish-anyway", action="store_true",
                    help="publish even if rows break declared constraints")
    ap.add_argument("--single-line", action="store_true",
                    help="refuse files in which a CSV record is more than one line")
    ap.add_argument("--reject-rows", action="store_true",
                    help="publish the rows that break no constraint and list the others in rejected_rows")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = build_session()
    run(spark, args.invoices, args.leads, args.salesteam, args.database, args.buckets,
        args.lead_date_format, args.as_of, args.publish_anyway, not args.single_line, args.reject_rows)


if __name__ == "__main__":
    main()
