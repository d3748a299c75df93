import contextlib
import io
import os
import random

import pandas as pd
import pytest

from larder.operators.cleaning import clean_invoices
from larder.operators.participants import customer_order
from larder.sources.csv import load_csv_sources, scan_csv
from larder.sources.publish import stage_sources
from larder.sources.schemas import INVOICE_CSV_COLUMNS

INVOICES_CSV = '''Order Id,Date,Meal Id,Company Id,Date of Meal,Participants,Meal Price,Type of Meal
O1,27-05-2016,M1,C1,2016-05-31 07:00:00+02:00,['David Bishop'],100,Breakfast
O2,03-10-2016,M2,C1,2016-10-01 16:00:00+02:00,"['David Bishop'
 'Ann Lee']",250,Lunch
O3,04-10-2016,M3,C2,2016-10-01 12:30:00+00:00,[],NA,Dinner
O4,05-01-2017,M4,C2,2017-01-05 00:15:00+01:00,"[""Pat O'Hara"" 'Ann Lee']",75,Lunch
'''
LEADS_CSV = """Order Id,Company Id,Company Name,Date,Order Value,Converted
O1,C1,Acme,2016-05-20,500,1
O2,C1,Acme,2016-05-21,300,0
O3,C2,Bolt,2016-05-22,200,1
O4,C2,Bolt,2016-05-23,100,0
"""
TEAM_CSV = "Sales Rep,Sales Rep Id,Company Name,Company Id\nRita,R1,Acme,C1\n"


def _write(d, name, text):
    path = os.path.join(d, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_scan_csv_quotes_newlines_and_na(spark, scratch_dir):
    path = _write(scratch_dir, "Invoices.csv", INVOICES_CSV)
    df = scan_csv(spark, path, INVOICE_CSV_COLUMNS)
    rows = {r["Order Id"]: r for r in df.collect()}
    assert len(rows) == 4
    assert rows["O2"]["Participants"] == "['David Bishop'\n 'Ann Lee']"  # line break inside quotes
    assert rows["O4"]["Participants"] == "[\"Pat O'Hara\" 'Ann Lee']"  # doubled quotes
    assert rows["O3"]["Meal Price"] is None  # NA token


def test_csv_sources_end_to_end(spark, scratch_dir):
    raw = load_csv_sources(
        spark,
        _write(scratch_dir, "Invoices2.csv", INVOICES_CSV),
        _write(scratch_dir, "OrderLeads.csv", LEADS_CSV),
        _write(scratch_dir, "SalesTeam.csv", TEAM_CSV),
    )
    raw = stage_sources(spark, raw)
    inv = clean_invoices(raw.invoices)
    got = sorted(
        (r[0], r[1] or "", r[2]) for r in customer_order(inv).select("Order_Id", "Participant_Name", "Customer_Id").collect()
    )
    assert got == sorted([
        ("O1", "David Bishop", "1"), ("O2", "David Bishop", "1"), ("O2", "Ann Lee", "2"),
        ("O3", "", "0"), ("O4", 'Hara" ', "3"),
    ])
    assert raw.leads.count() == 4 and raw.salesteam.count() == 1


def test_job_runs_from_csv(spark, scratch_dir):
    from larder import job

    names = job.run(
        spark,
        _write(scratch_dir, "Invoices3.csv", INVOICES_CSV),
        _write(scratch_dir, "OrderLeads3.csv", LEADS_CSV),
        _write(scratch_dir, "SalesTeam3.csv", TEAM_CSV),
        database="job_mart",
        as_of="2024-01-02",
    )
    assert "customer_stats" in names
    rows = spark.sql("SELECT customer_name, number_of_order FROM customer_stats").collect()
    assert {r[0]: r[1] for r in rows}["David Bishop"] == 2


def _job(spark, d, tag, invoices=INVOICES_CSV, leads=LEADS_CSV, team=TEAM_CSV, **kw):
    from larder import job

    return job.run(
        spark, _write(d, f"I{tag}.csv", invoices), _write(d, f"L{tag}.csv", leads), _write(d, f"S{tag}.csv", team),
        database=f"job_{tag}", as_of="2024-01-02", **kw,
    )


def test_job_numbers_the_participants_once(spark, scratch_dir, monkeypatch):
    from larder.operators import participants

    calls = []
    rank = participants.first_appearance_ids
    monkeypatch.setattr(participants, "first_appearance_ids", lambda *a, **kw: calls.append(1) or rank(*a, **kw))
    _job(spark, scratch_dir, "once")
    assert len(calls) == 1
    rows = spark.sql("SELECT Order_Id, Participant_Name, Customer_Id FROM job_once.customer_order").collect()
    assert sorted((o, name or "", key) for o, name, key in rows) == sorted([
        ("O1", "David Bishop", "1"), ("O2", "David Bishop", "1"), ("O2", "Ann Lee", "2"),
        ("O3", "", "0"), ("O4", 'Hara" ', "3"),
    ])


BAD = {
    "fk": dict(leads=LEADS_CSV.replace("O3,C2", "O8,C2")),  # invoice O3 has no order
    "fk_company": dict(team=TEAM_CSV + "Zed,R9,Nowhere,C9\n"),
    "length": dict(team=TEAM_CSV + f"{'z' * 300},R9,Acme,C1\n"),
    "dup_key": dict(leads=LEADS_CSV + "O1,C1,Acme,2016-05-20,500,1\n"),
    "null_key": dict(leads=LEADS_CSV + ",C1,Acme,2016-05-20,500,1\n"),
}


@pytest.mark.parametrize("case", sorted(BAD))
def test_job_refuses_to_publish_broken_constraints(spark, scratch_dir, case):
    with pytest.raises(RuntimeError, match="violations"):
        _job(spark, scratch_dir, f"bad_{case}", **BAD[case])
    assert not spark.catalog.databaseExists(f"job_bad_{case}")


def test_job_publishes_anyway_when_told(spark, scratch_dir):
    _job(spark, scratch_dir, "anyway", publish_anyway=True, **BAD["fk_company"])
    assert spark.table("job_anyway.salesteam").count() == 2


@pytest.mark.parametrize("case", ["fk", "null_key"])
def test_job_publishes_the_good_rows_and_lists_the_others(spark, scratch_dir, case):
    _job(spark, scratch_dir, f"gate_{case}", reject_rows=True, **BAD[case])
    rejected = spark.table(f"job_gate_{case}.rejected_rows").collect()
    assert {r.table_name for r in rejected} == {"fk": {"invoice"}, "null_key": {"orders"}}[case]
    assert spark.table(f"job_gate_{case}.orders").count() == 4


def test_lead_date_format_reaches_the_checks(spark, scratch_dir):
    leads = LEADS_CSV.replace("2016-05-2", "2016/05/2")
    _job(spark, scratch_dir, "dates", leads=leads, lead_date_format="yyyy/M/d")
    assert spark.table("job_dates.orders").filter("Date IS NULL").count() == 0


def test_swapped_header_fails(spark, scratch_dir):
    path = _write(scratch_dir, "swapped.csv", INVOICES_CSV.replace("Meal Id,Company Id", "Company Id,Meal Id"))
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, path, INVOICE_CSV_COLUMNS).collect()


def _many(n, at=0):
    rows = [f"O{at + i},27-05-2016,M{at + i},C1,2016-05-31 07:00:00+02:00,['n{(at + i) * 7 % 50}' 'n{(at + i) * 3 % 40}'],10,Lunch" for i in range(n)]
    return "\n".join([INVOICES_CSV.splitlines()[0], *rows]) + "\n"


def _ids(inv):
    return {(r[0], r[1], int(r[2])) for r in customer_order(inv).select("Order_Id", "Participant_Name", "Customer_Id").collect()}


def _want(n):
    pairs = [(f"O{i}", f"n{k}") for i in range(n) for k in (i * 7 % 50, i * 3 % 40)]
    ids = pd.Series([p[1] for p in pairs]).factorize()[0] + 1
    return {(o, name, int(k)) for (o, name), k in zip(pairs, ids)}


def test_single_line_file_is_split_and_keeps_its_order(spark, scratch_dir):
    path = _write(scratch_dir, "many.csv", _many(4000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        raw = scan_csv(spark, path, INVOICE_CSV_COLUMNS, multi_line=False)
        assert raw.rdd.getNumPartitions() > 4
        empty = raw.limit(0)
        staged = stage_sources(spark, type("R", (), {"invoices": raw, "leads": empty, "salesteam": empty}))
        inv = clean_invoices(staged.invoices)
        assert _ids(inv) == _want(4000)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            from larder.operators.participants import _appearance_key, explode_participants
            from pyspark.sql import functions as F

            ex = explode_participants(inv)
            ex.groupBy("Participant_Name").agg(F.min(_appearance_key(ex, ("_row_order", "Position")))).explain()
        assert "HashAggregate" in buf.getvalue() and "SortAggregate" not in buf.getvalue()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_folder_of_many_multi_line_files_keeps_the_order_of_paths(spark, scratch_dir):
    folder = os.path.join(scratch_dir, "parts")
    os.makedirs(folder)
    for k in range(6):
        _write(folder, f"part-{k}.csv", _many(100, at=100 * k))
    raw = scan_csv(spark, folder, INVOICE_CSV_COLUMNS)
    empty = raw.limit(0)
    staged = stage_sources(spark, type("R", (), {"invoices": raw, "leads": empty, "salesteam": empty}))
    assert _ids(clean_invoices(staged.invoices)) == _want(600)


def test_single_line_read_refuses_broken_lines(spark, scratch_dir):
    with pytest.raises(ValueError, match="odd number of quotes"):
        scan_csv(spark, _write(scratch_dir, "odd.csv", INVOICES_CSV), INVOICE_CSV_COLUMNS, multi_line=False)


TABLE = ["a", "b", "c"]


def _pandas(path):
    df = pd.read_csv(path, dtype=str, keep_default_na=True)
    return [tuple(None if pd.isna(v) else v for v in r) for r in df.itertuples(index=False)]


@contextlib.contextmanager
def _splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def _in_order(df):
    return [tuple(r[1:]) for r in sorted(df.collect(), key=lambda r: tuple(r[0]))]


def _field(rng):
    plain = rng.choice(["x", "", "NA", "word", "é漢𝒳", " pad ", '5" pipe', "q'q", "tab\t"])
    quoted = '"' + "".join(rng.choice(["a", '""', ",", "\n", "\r\n", "\n\n", '"",""', " ", "é"]) for _ in range(rng.randrange(12))) + '"'
    return rng.choice([plain, plain, quoted, quoted + rng.choice(["", "", "t"])])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_scan_equals_pandas_at_every_split_size(spark, scratch_dir, end):
    rng = random.Random(len(end))
    rows = [",".join(["k" + str(k), *(_field(rng) for _ in range(rng.choice([2, 2, 2, 1, 0])))]) for k in range(120)]
    rows.insert(7, "")
    rows.insert(60, '"' + "long\n" * 400 + '",y,z')  # spans many small splits
    text = end.join(["a,b,c", *rows]) + rng.choice(["", end])
    path = os.path.join(scratch_dir, f"fuzz{len(end)}.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    want = _pandas(path)
    assert len(want) == 121 and any("\n" in (r[1] or "") for r in want)
    for size in ("37", "200", "1000", "128m"):
        with _splits(spark, size):
            df = scan_csv(spark, path, TABLE)
            assert _in_order(df) == want, size
            if size == "37":
                assert df.count() == 121 and spark.read.text(path).rdd.getNumPartitions() > 50


def test_rows_that_are_too_short_are_filled_and_too_long_ones_fail(spark, scratch_dir):
    assert _in_order(scan_csv(spark, _write(scratch_dir, "short.csv", "a,b,c\n1,2\n3\n4,5,6\n,,\n"), TABLE)) == [
        ("1", "2", None), ("3", None, None), ("4", "5", "6"), (None, None, None)]
    for text in ("a,b,c\n1,2,3,4\n", "a,b,c\n1,2,3,\n", 'a,b,c\n1,2,"x\ny",4,5\n'):
        with pytest.raises(Exception, match="too many fields"):
            scan_csv(spark, _write(scratch_dir, "long.csv", text), TABLE).count()


def test_a_quote_that_is_never_closed_fails(spark, scratch_dir):
    with pytest.raises(ValueError, match="never closed"):
        scan_csv(spark, _write(scratch_dir, "open.csv", 'a,b,c\n1,"2,3\n4,5,6\n'), TABLE)


def test_files_without_rows(spark, scratch_dir):
    assert scan_csv(spark, _write(scratch_dir, "head.csv", "a,b,c\n"), TABLE).count() == 0
    assert scan_csv(spark, _write(scratch_dir, "empty.csv", ""), TABLE).count() == 0
    assert _in_order(scan_csv(spark, _write(scratch_dir, "bom.csv", "\ufeffa,b,c\n1,2,3"), TABLE)) == [("1", "2", "3")]


def test_records_across_many_splits_keep_their_order_numbers(spark, scratch_dir):
    lines = [f'O{i},27-05-2016,M{i},C1,2016-05-31 07:00:00+02:00,"[\'n{i * 7 % 50}\'\n \'n{i * 3 % 40}\']",10,Lunch' for i in range(3000)]
    path = _write(scratch_dir, "torn.csv", "\n".join([INVOICES_CSV.splitlines()[0], *lines]) + "\n")
    with _splits(spark, "9k"):
        raw = scan_csv(spark, path, INVOICE_CSV_COLUMNS)
        assert raw.rdd.getNumPartitions() > 20
        empty = raw.limit(0)
        staged = stage_sources(spark, type("R", (), {"invoices": raw, "leads": empty, "salesteam": empty}))
        numbers = [(r[0], r["Order Id"]) for r in staged.invoices.collect()]
    assert [o for _, o in sorted(numbers)] == [f"O{i}" for i in range(3000)]
    assert _ids(clean_invoices(staged.invoices)) == _want(3000)
