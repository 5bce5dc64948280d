"""Landed feed files -> pickup -> four facts -> history -> export, run more than once."""

from datetime import date
from pathlib import Path

import pytest

from kpiloom import contracts
from kpiloom.plans import feed_flow, history_flow
from kpiloom.session import folder_exists, remove_folder, work_folder
from kpiloom.streaming.ingest import ingest_inbound


def record(number, cancel="", amount=100, device="1", items=(("b1", 2),)):
    pairs = [
        f"ORDER_DISP_NO=ORDER{number}", "ORDER_DATE=2024%2F05%2F01", f"CANCEL_DATE={cancel}", f"SEIKYU={amount}",
        "TAX=10", "DAIBIKI=0", "SORYO=0", "SORYO_TAX=0", "COUPON_WARIBIKI=0", "FREE_ITEM11=0", "TEIKA_SUM=90", "TEIKA_SUM_TAX=10",
        f"ORDER_H_ACCESS_BROWSER_KBN={device}", "KESSAI_ID=4",
    ]
    for i, (barcode, quantity) in enumerate(items, 1):
        pairs += [f"ORDER_D_NO_{i}={i}", f"ORDER_D_FREE_ITEM32_{i}={barcode}", f"TEIKA_{i}=5", f"QUANTITY_{i}={quantity}"]
    return "&".join(pairs)


@pytest.fixture
def run(spark, tmp_path):
    tender = spark.createDataFrame([("4", "Card")], contracts.TENDER)
    items = spark.createDataFrame([("b1", "st", "c", "m"), ("b2", "s,2", "c", "m")], contracts.ITEM)
    inbound = tmp_path / "in"
    inbound.mkdir()

    def go(day, deduplicate=True):
        def process(feed, batch_id):
            folder = work_folder(spark, "feed")
            facts = feed_flow.feed_facts(feed, tender, items, folder)
            history_flow.load_history(facts, f"{tmp_path}/tables", deduplicate, now=f"{day} 12:00:00")
            remove_folder(spark, folder)
            assert not folder_exists(spark, folder)

        ingest_inbound(spark, "form_feed", str(inbound), f"{tmp_path}/checkpoint", process)

    return go


def counts(spark, tmp_path, kind="history"):
    schemas = feed_flow.fact_schemas(spark)
    return {
        fact: history_flow.read_history(spark, f"{tmp_path}/tables", fact, schema, kind=kind).count()
        for fact, schema in schemas.items()
    }


def test_whole_chain(spark, tmp_path, run):
    inbound = tmp_path / "in"
    (inbound / "day1.txt").write_text("\n".join([
        record(1, items=(("b1", 2), ("b2", 1))), record(2, cancel="2024%2F05%2F02"), record(3, items=(("zz", 1),)),
    ]))
    run("2024-05-02")
    # Order 3 has an item of an unknown style: its line is quarantined, its header is not.
    assert counts(spark, tmp_path) == {"header": 2, "line": 2, "payment": 2, "cancel": 1}
    assert counts(spark, tmp_path, "error") == {"header": 0, "line": 1, "payment": 0, "cancel": 0}

    # Order 1 is sent again with one more item, and a new order comes.
    (inbound / "day2.txt").write_text("\n".join([record(1, items=(("b1", 2), ("b2", 1), ("b1", 9))), record(4)]))
    run("2024-05-03")
    run("2024-05-04")
    assert counts(spark, tmp_path) == {"header": 3, "line": 4, "payment": 3, "cancel": 1}

    schemas = feed_flow.fact_schemas(spark)
    files = history_flow.export_history(
        spark, f"{tmp_path}/tables", f"{tmp_path}/out", schemas, "JP", "BI", start=date(2024, 5, 2), end=date(2024, 5, 2)
    )
    (line_file,) = files["line"]
    assert Path(line_file).name == "BI_JP_Line_20240502_20240502.csv"
    lines = Path(line_file).read_bytes().decode().split("\r\n")
    assert lines[0].startswith("eCom_Store_ID,Transaction_Nbr,Order_Date,AX_Style_ID")
    assert sorted(line.split(",")[1:4] for line in lines[1:-1]) == [
        ["1", "2024-05-01 00:00:00", "s 2"], ["1", "2024-05-01 00:00:00", "st"],
    ]
    (cancel_file,) = files["cancel"]
    assert Path(cancel_file).read_text().splitlines()[1].split("|")[1] == "100.00"


def test_update(spark, tmp_path, run):
    inbound = tmp_path / "in"
    (inbound / "a.txt").write_text("\n".join([record(1, amount=100), record(2)]))
    run("2024-05-02", deduplicate=False)
    (inbound / "b.txt").write_text(record(1, amount=150))
    run("2024-05-03", deduplicate=False)
    schema = feed_flow.fact_schemas(spark)["payment"]
    rows = history_flow.read_history(spark, f"{tmp_path}/tables", "payment", schema).collect()
    assert sorted((r.Transaction_Nbr, r.Tender_Amt) for r in rows) == [("1", 150.0), ("2", 100.0)]
