"""Whole jobs over files, with what is missing or empty, and loads of a stream that comes again."""

from datetime import date
from pathlib import Path

import pytest

from kpiloom import contracts
from kpiloom.operators import history, ledger
from kpiloom.plans import history_flow, jobs
from kpiloom.streaming import ingest
from test_end_to_end import record


@pytest.fixture
def lookups(spark):
    tender = spark.createDataFrame([("4", "Card")], contracts.TENDER)
    items = spark.createDataFrame([("b1", "st", "c", "m")], contracts.ITEM)
    return tender, items


def names(written):
    return {fact: [Path(f).name for f in files] for fact, files in written.items()}


def test_feed_job(spark, tmp_path, lookups):
    inbound = tmp_path / "in"
    inbound.mkdir()
    target = jobs.Target(f"{tmp_path}/out", "JP", "BI", f"{tmp_path}/tables", {"now": "2024-05-07 12:00:00"})
    assert jobs.feed_job(spark, str(inbound), target, *lookups) == {f: [] for f in ("header", "line", "payment", "cancel")}
    (inbound / "empty.txt").write_text("")
    assert not any(jobs.feed_job(spark, str(inbound), target, *lookups).values())
    assert not (tmp_path / "out").exists() and not (tmp_path / "tables").exists()
    # The earliest order is cancelled and has no line: it names all files.
    early = record(1, cancel="2024%2F05%2F02", items=()).replace("05%2F01", "04%2F30")
    (inbound / "a.txt").write_text("\n".join([early, record(2), record(3)]))
    written = jobs.feed_job(spark, str(inbound), target, *lookups)
    assert names(written) == {
        "header": ["BI_JP_Transaction-20240430.csv"], "line": ["BI_JP_Line-20240430.csv"],
        "payment": ["BI_JP_Payment-20240430.csv"], "cancel": [],
    }
    window = jobs.window_job(spark, target, "feed", date(2024, 5, 7), date(2024, 5, 7))
    assert names(window)["line"] == ["BI_JP_Line_20240507_20240507.csv"] and window["cancel"] == []
    assert jobs.window_job(spark, target, "feed", date(2024, 5, 8), date(2024, 5, 8)) == {f: [] for f in written}


FLAT = "ORDER1,1,2024/05/02 9:5:3,4,m,1100,900,800,80,100,50,5,30,3,C,{n},x,b1,400,450,2,3,7,15,c,s,"


def test_flat_job(spark, tmp_path, lookups):
    inbound = tmp_path / "in"
    inbound.mkdir()
    header = ",".join(contracts.FLAT_SALES_COLUMNS)
    (inbound / "FY1.csv").write_text("\n".join([header, *[FLAT.format(n=n) for n in (2, 1, 3)]]))
    target = jobs.Target(f"{tmp_path}/out", "JP", "BI", f"{tmp_path}/tables", {"source": "flat", "batch": 1})
    written = jobs.flat_job(spark, str(inbound), target, *lookups)
    assert names(written) == {
        "header": ["BI_JP_Transaction-20240502.csv"], "line": ["BI_JP_Line-20240502.csv"],
        "payment": ["BI_JP_Payment-20240502.csv"], "cancel": [],
    }
    # One header and one payment per order, however many items it has.
    counts = {f: history_flow.read_history(spark, f"{tmp_path}/tables", f).count() for f in ("header", "line", "payment")}
    assert counts == {"header": 1, "line": 3, "payment": 1}
    lines = Path(written["line"][0]).read_text().splitlines()
    assert len(lines) == 4 and len(Path(written["header"][0]).read_text().splitlines()) == 2


def test_conformed_job_skips_what_is_missing(spark, tmp_path):
    inbound = tmp_path / "in"
    inbound.mkdir()
    tender = spark.createDataFrame([("CN", "a", "Card")], contracts.TENDER_BY_COUNTRY)
    (inbound / "demand_payment_recovery_file1.csv").write_text(
        ",".join(contracts.PAYMENT_COLUMNS) + "\n07301,1,2024/5/1 9:5,a,3,CNY\n"
    )
    (inbound / "demand_line_recovery_file1.csv").write_text(",".join(contracts.LINE_COLUMNS) + "\n")
    target = jobs.Target(f"{tmp_path}/out", "CN", "BI", f"{tmp_path}/tables")
    written = jobs.conformed_job(spark, str(inbound), target, tender)
    assert names(written) == {"payment": ["BI_CN_Payment-20240501.csv"], "header": [], "line": [], "cancel": []}
    assert [r.Tender_Amt for r in history_flow.read_history(spark, f"{tmp_path}/tables", "payment").collect()] == [3.0]


def test_envelope_job(spark, tmp_path):
    inbound = tmp_path / "in"
    inbound.mkdir()
    tender = spark.createDataFrame([("CN", "a", "Card")], contracts.TENDER_BY_COUNTRY)
    target = jobs.Target(f"{tmp_path}/out", "CN", "BI")
    assert not any(jobs.envelope_job(spark, str(inbound), target, tender).values())
    order = '{"Transaction_Nbr": "1", "Order_Date": "2024-05-03T10:00:00", "Demand_Net": "5", "Country": "CN", "Order_Lines": [], "Order_Payments": []}'
    # Written over several lines, as the pages are.
    (inbound / "CN-20240504-Sales-1.json").write_text('{"code": 0,\n "orders": [\n' + order + "\n]}")
    written = jobs.envelope_job(spark, str(inbound), target, tender)
    assert names(written) == {"header": ["BI_CN_Transaction-20240503.csv"], "line": [], "payment": [], "cancel": []}


@pytest.mark.parametrize("feed", ["feed", "flat", "conformed", "envelope"])
def test_every_flow_fits_the_tables(spark, feed):
    """Each flow's facts can be cast to the declared tables, and back."""
    from kpiloom.operators.quality import assign

    for fact, schema in jobs.fact_schemas(spark, feed).items():
        rows = assign(spark.createDataFrame([], schema), contracts.FACT_TABLES[fact])
        assert rows.schema.simpleString() == contracts.FACT_TABLES[fact].simpleString()


def table_of(spark, root):
    return history.read_done(spark, root, "header", "history", history_flow.table_schema("header"))


def test_a_batch_that_comes_again(spark, tmp_path, lookups, monkeypatch):
    """The process dies after the load is done and before the batch is committed, then before it is done."""
    inbound, root = tmp_path / "in", f"{tmp_path}/tables"
    inbound.mkdir()
    load = history_flow.load_history
    arguments = (spark, str(inbound), f"{tmp_path}/checkpoint", root, *lookups)

    def run():
        ingest.load_feed(*arguments, archive_root=f"{tmp_path}/archive", deduplicate=False)

    def dies_after(*args, **kwargs):
        load(*args, **kwargs)
        raise RuntimeError("after")

    (inbound / "a.txt").write_text("\n".join([record(1), record(2)]))
    with monkeypatch.context() as m:
        m.setattr(history_flow, "load_history", dies_after)
        with pytest.raises(Exception, match="after"):
            run()
    assert table_of(spark, root).count() == 2 and (inbound / "a.txt").exists()
    run()
    assert sorted(r.load_number for r in table_of(spark, root).collect()) == [1, 1]
    # Archived at the end of the run that committed the batch.
    assert not (inbound / "a.txt").exists() and len(list((tmp_path / "archive").rglob("a.txt"))) == 1

    def dies_before(*args, **kwargs):
        raise RuntimeError("before")

    (inbound / "b.txt").write_text(record(3))
    with monkeypatch.context() as m:
        m.setattr(history, "append_load", dies_before)
        with pytest.raises(Exception, match="before"):
            run()
    assert table_of(spark, root).count() == 2 and ledger.unfinished(spark, root) == [2]
    run()
    assert sorted((r.Transaction_Nbr, r.load_number) for r in table_of(spark, root).collect()) == [("1", 1), ("2", 1), ("3", 2)]
    assert len(list((tmp_path / "archive").rglob("*.txt"))) == 2
