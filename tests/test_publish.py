import contextlib
import io

import pytest
from pyspark.sql import functions as F

from larder.plans import views
from larder.sources import publish
from larder.sources.tables import Tables
from larder.sources.testdomain import RawSources
from tests.fixtures import INVOICES, raw_sources


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def _snapshot(p):
    return {k: sorted(map(str, v.collect())) for k, v in p.items()}


def test_refresh_publishes_four_tables_and_is_repeatable(spark):
    t = Tables(raw_sources(spark), as_of="2024-01-02")
    audit = {r["table_name"]: r["row_count"] for r in publish.refresh(spark, t.as_dict(), database="t_mart").collect()}
    assert audit == {"orders": 6, "invoice": 5, "salesteam": 4, "customer_order": 7}
    assert publish.list_tables(spark, "t_mart") == ["customer_order", "invoice", "orders", "salesteam"]
    first = _snapshot(publish.published(spark, "t_mart"))
    publish.refresh(spark, t.as_dict(), database="t_mart")
    assert _snapshot(publish.published(spark, "t_mart")) == first
    inv = spark.table("t_mart.invoice")
    assert [f.dataType.simpleString() for f in inv.schema.fields][:10] == [
        "string", "date", "string", "string", "timestamp_ntz", "string", "smallint", "string", "string", "tinyint"]


def test_year_partition_pruning(spark):
    t = Tables(raw_sources(spark), as_of="2024-01-02")
    publish.refresh(spark, t.as_dict(), database="t_mart2")
    df = publish.invoice_for_year(spark, 2017, database="t_mart2")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(Year" in plan and "Year=2017]" in plan
    assert sorted(r["Order_Id"] for r in df.collect()) == ["O4", "O5"]


def test_bucketed_tables_join_without_shuffle(spark):
    t = Tables(raw_sources(spark), as_of="2024-01-02")
    publish.refresh(spark, t.as_dict(), database="t_mart3")
    p = publish.published(spark, "t_mart3")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = views.customer_stats(p["customer_order"], p["invoice"])
        plan = _plan(df, "simple")
        join_part = plan[plan.index("SortMergeJoin"):]
        assert "Exchange" not in join_part  # both sides read co-partitioned buckets
        assert df.count() == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_stage_counts(spark):
    t = Tables(raw_sources(spark), as_of="2024-01-02")
    got = {(r["stage"], r["table_name"]): r["row_count"] for r in publish.stage_counts(t.raw.as_dict(), t.as_dict()).collect()}
    assert got[("extract", "invoices")] == 5 and got[("load", "customer_order")] == 7


def test_key_checks_on_bucketed_tables_need_no_shuffle(spark):
    from larder.operators import quality

    t = Tables(raw_sources(spark), as_of="2024-01-02")
    publish.refresh(spark, t.as_dict(), database="t_mart4")
    p = publish.published(spark, "t_mart4")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        checks = [
            quality.orphan_rows(p["invoice"], "Order_Id", p["orders"], "Order_Id"),
            quality.orphan_rows(p["customer_order"], "Order_Id", p["orders"], "Order_Id"),
            p["invoice"].groupBy("Order_Id", "Date").count(),
        ]
        for df in checks:
            assert "Exchange" not in _plan(df, "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_persistent_views_equal_the_frames_and_follow_a_refresh(spark):
    from larder.plans.catalog import VIEW_BUILDERS, create_views

    t = Tables(raw_sources(spark), as_of="2024-01-02")
    publish.refresh(spark, t.as_dict(), database="t_mart5")
    names = create_views(spark, "t_mart5")
    assert len(names) == 11
    for _ in range(2):
        p = publish.published(spark, "t_mart5")
        for name, build in VIEW_BUILDERS.items():
            want, got = build(p), spark.newSession().table(f"t_mart5.{name}")  # seen by other sessions
            assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema], name
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
        refund = (6, "O6", "05-01-2018", "M6", "C3", "2018-01-06 10:00:00+01:00", "['Ann Lee']", "-77", "Dinner")
        t = Tables(raw_sources(spark, invoices=INVOICES + [refund]), as_of="2024-01-02")
        publish.refresh(spark, t.as_dict(), database="t_mart5")
    assert spark.table("t_mart5.invoice").count() == 6


def test_failed_write_leaves_the_previous_set(spark):
    from larder.plans.catalog import create_views

    t = Tables(raw_sources(spark), as_of="2024-01-02")
    publish.refresh(spark, t.as_dict(), database="t_mart6")
    create_views(spark, "t_mart6")
    before = _snapshot(publish.published(spark, "t_mart6"))
    stats = sorted(map(str, spark.table("t_mart6.customer_stats").collect()))
    bad = (6, "O6", "05-01-2018", "M6", "C3", "2018-01-06 10:00:00+01:00", "['Ann Lee']", "40000", "Dinner")  # price too large
    t = Tables(raw_sources(spark, invoices=INVOICES + [bad]), as_of="2024-01-02")
    with pytest.raises(Exception, match="(?i)overflow|CAST_INVALID"):
        publish.refresh(spark, t.as_dict(), database="t_mart6")
    assert _snapshot(publish.published(spark, "t_mart6")) == before
    assert sorted(map(str, spark.table("t_mart6.customer_stats").collect())) == stats


def test_old_runs_are_dropped_with_their_files(spark):
    t = Tables(raw_sources(spark), as_of="2024-01-02")
    for _ in range(3):
        publish.refresh(spark, t.as_dict(), database="t_mart7")
    before = _snapshot(publish.published(spark, "t_mart7"))
    dropped = publish.drop_old_runs(spark, "t_mart7", keep=1)
    assert len(dropped) == 8
    assert _snapshot(publish.published(spark, "t_mart7")) == before
    left = [x.name for x in spark.catalog.listTables("t_mart7") if publish.RUN_MARK in x.name]
    assert len(left) == 4


def test_staged_sources_can_be_removed(spark):
    raw = publish.stage_sources(spark, raw_sources(spark))
    assert raw.invoices.count() == 5
    publish.remove_staged(spark, raw)
    with pytest.raises(Exception):
        spark.read.parquet(raw.path + "/invoices")


def _company(spark, tag):
    """Sources in which every table names the run."""
    raw = raw_sources(spark)
    named = lambda df, *cols: df.withColumns({c: F.concat(F.lit(tag), F.col(f"`{c}`")) for c in cols})
    return Tables(RawSources(
        invoices=named(raw.invoices, "Order Id", "Company Id"), leads=named(raw.leads, "Order Id", "Company Id"),
        salesteam=named(raw.salesteam, "Company Id"),
    ), as_of="2024-01-02").as_dict()


def test_no_reader_ever_sees_two_runs(spark, monkeypatch):
    publish.refresh(spark, _company(spark, "r0"), database="t_one")
    seen = []

    def probe():
        other = spark.newSession()
        marks = {other.sql(f"SELECT min(left(Order_Id, 2)), max(left(Order_Id, 2)) FROM t_one.{t}").first() for t in ("orders", "invoice", "customer_order")}
        marks |= {other.sql("SELECT min(left(Company_Id, 2)), max(left(Company_Id, 2)) FROM t_one.salesteam").first()}
        assert len(marks) == 1 and len(set(next(iter(marks)))) == 1
        joined = other.sql("SELECT count(*) FROM t_one.orders o JOIN t_one.invoice i USING (Order_Id) JOIN t_one.customer_order c USING (Order_Id)").first()[0]
        assert joined == 7
        seen.append(next(iter(marks))[0])

    plain = publish.replace_view

    def probed(spark_, name, sql):
        probe()
        plain(spark_, name, sql)
        probe()

    monkeypatch.setattr(publish, "replace_view", probed)
    for tag in ("r1", "r2"):
        publish.refresh(spark, _company(spark, tag), database="t_one")
    assert [a for a, b in zip(seen, seen[1:] + [None]) if a != b] == ["r0", "r1", "r2"]


def test_rejected_rows_are_published_with_their_run(spark):
    t = Tables(raw_sources(spark), as_of="2024-01-02").as_dict()
    rejected = spark.createDataFrame([("orders", 7, "O7|C1", "primary_key", "{}")], "table_name string, row_order long, row_key string, reasons string, row string")
    publish.refresh(spark, t, database="t_rej")
    assert "rejected_rows" not in publish.list_tables(spark, "t_rej")
    for given, n in ((rejected, 1), (None, 0), (rejected.unionAll(rejected), 2)):
        publish.refresh(spark, t, database="t_rej", rejected=given)
        assert spark.newSession().table("t_rej.rejected_rows").count() == n
    publish.drop_old_runs(spark, "t_rej", keep=1)
    assert spark.table("t_rej.rejected_rows").count() == 2 and spark.table("t_rej.orders").count() == 6
