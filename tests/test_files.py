import os
import time
import json
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kpiloom import contracts
from kpiloom.operators import export, nested
from kpiloom.plans import envelope_flow
from kpiloom.session import folder_exists, landed, shared_folder, work_folder
from kpiloom.sources import readers
from kpiloom.streaming.ingest import FLOW_SOURCES, ingest_inbound

ORDER = {
    "Transaction_Nbr": "T1",
    "eCom_Store_ID": "07301",
    "Country": "CN",
    "Order_Date": "2024-05-01T10:00:00",
    "Demand_Net": "12.5",
    "Device_Type": "2",
    "Employee_ID": "",
    "Order_Lines": [{"Item_Seq_Number": "1", "Gift_IND": ""}, {"Item_Seq_Number": "2"}],
    "Order_Payments": [{"Tender": "a", "Tender_Amt": ""}, {"Tender": "zz", "Tender_Amt": "3"}],
}


def page(path, orders, pages=1):
    envelope = {"code": 0, "message": "", "orders": orders, "pageSize": 200, "pages": pages, "success": True, "total": len(orders)}
    Path(path).write_text(json.dumps(envelope, indent=2))


def test_pretty_printed_pages(spark, tmp_path):
    page(tmp_path / "CN-20240501-Sales-1.json", [ORDER], pages=3)
    page(tmp_path / "CN-20240501-Sales-2.json", [])
    page(tmp_path / "CN-20240501-Cancel-1.json", [ORDER])
    (tmp_path / "CN-20240501-Sales-3.json").write_text('{"code": 1}')
    envelopes = readers.read_order_envelopes(spark, readers.inbound_glob(str(tmp_path), "sales_envelope"))
    assert envelopes.count() == 3
    orders = nested.explode_orders(envelopes)
    assert [Path(r[readers.SOURCE_FILE]).name for r in orders.collect()] == ["CN-20240501-Sales-1.json"]
    header = envelope_flow.build_header(orders).first()
    assert header.Device_Type == "Mobile Phone"
    assert (header.Order_Date, header.Demand_Net, header.Employee_ID, header.Tax) == ("2024-05-01 10:00:00", 12.5, None, None)
    assert sorted(r.Gift_IND for r in envelope_flow.build_line(orders).collect()) == [0, 1]
    tender = spark.createDataFrame([("CN", "a", "Card")], contracts.TENDER_BY_COUNTRY)
    facts = envelope_flow.sales_facts(envelopes, tender, work_folder(spark, "test"))
    assert sorted((r.Tender, r.Tender_Amt) for r in facts["payment"].collect()) == [("Card", 0.0), ("OTHER", 3.0)]
    assert facts["header"].count() == 1


def test_schema_document(spark, tmp_path):
    (tmp_path / "schema.json").write_text(json.dumps(json.loads(contracts.SALES_ENVELOPE.json()), indent=1))
    assert readers.load_schema(spark, str(tmp_path / "schema.json")) == contracts.SALES_ENVELOPE


def test_csv_dialects(spark, tmp_path):
    (tmp_path / "f.csv").write_text('h1,h2,h3\n"a,b","say ""hi""",3\n')
    schema = contracts.text_struct(["x", "y", "z"])
    assert tuple(readers.read_csv(spark, str(tmp_path), schema).first()) == ("a,b", 'say "hi"', "3")
    assert tuple(readers.read_csv(spark, str(tmp_path), schema, "raw").first()) == ('"a', 'b"', '"say ""hi"""')


def test_typed_csv(spark, tmp_path):
    values = ["1"] * 24
    values[4], values[11], values[12] = "x", "2.345", "n/a"
    (tmp_path / "f.csv").write_text(",".join(["c"] * 24) + "\n" + ",".join(values) + "\n")
    row = readers.read_csv(spark, str(tmp_path), contracts.CONFORMED_HEADER).first()
    assert (row.Device_Type, row.Freight_Tax, row.Demand_Net, row.Tax) == (None, Decimal("2.35"), None, Decimal("1.00"))


def test_conformed_layouts():
    sizes = [contracts.CONFORMED_HEADER, contracts.CONFORMED_LINE, contracts.CONFORMED_PAYMENT, contracts.CONFORMED_CANCEL]
    assert [len(s) for s in sizes] == [24, 17, 6, 35]
    assert (len(contracts.FLAT_SALES), len(contracts.FLAT_CANCEL)) == (27, 28)
    assert (len(contracts.FEED_HEADER_NAMES), len(contracts.FEED_LINE_NAMES)) == (93, 20)
    assert (len(contracts.HEADER_COLUMNS), len(contracts.CANCEL_COLUMNS), len(contracts.CANCEL_TEXT_FIELDS)) == (19, 35, 26)
    assert set(contracts.FEED_HEADER_USED) <= set(contracts.FEED_HEADER_NAMES)
    assert set(contracts.FLOW_GLOBS) == set(FLOW_SOURCES)


def test_only_a_missing_path_is_forgiven(spark, tmp_path):
    def scan():
        return readers.read_csv(spark, f"{tmp_path}/FY*.csv", contracts.FLAT_SALES, "raw")

    empty = readers.read_or_empty(spark, scan, contracts.FLAT_SALES)
    assert empty.columns == contracts.FLAT_SALES_COLUMNS
    assert not readers.has_rows(empty)
    with pytest.raises(PySparkException):
        readers.read_or_empty(spark, lambda: scan().select("no_such_column"), contracts.FLAT_SALES) and readers.read_or_empty(
            spark, lambda: spark.range(1).select("no_such_column"), contracts.FLAT_SALES
        )


def test_item_map_pushes_the_configuration_down(spark, tmp_path):
    path = f"{tmp_path}/items"
    data = [("b1", "s", "c", "m", "A", "long text"), ("b2", "s", "c", "m", "B", "")]
    spark.createDataFrame(data, "Barcode string, Style string, Color string, Size string, Config string, Note string").write.parquet(path)
    items = readers.read_item_map(spark, "parquet", {"path": path})
    assert [tuple(r) for r in items.collect()] == [("b1", "s", "c", "m")]
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Config,A)" in plan and "Note" not in plan.split("ReadSchema")[1]


def test_exported_bytes(spark, tmp_path):
    df = spark.createDataFrame(
        [("a,b|c", None, 1.5), ("", "x\r\ny", None), ('"q"', " pad ", 2.0)], "s string, t string, n double"
    ).coalesce(1)
    export.export_csv(df, f"{tmp_path}/out", sep=",")
    part = next(Path(f"{tmp_path}/out").glob("part-*")).read_bytes()
    lines = part.split(b"\r\n")
    assert lines[0] == b"s,t,n"
    assert sorted(lines[1:-1]) == sorted([b"a b|c,,1.5", b",x  y,", b'"q",pad,2.0'])
    assert lines[-1] == b""


def test_clashing_separator_can_be_an_error(spark, tmp_path):
    df = spark.createDataFrame([("a|b",)], "s string")
    with pytest.raises(PySparkException, match="separator in field"):
        export.export_csv(df, f"{tmp_path}/out", sep="|", on_clash="error")
    export.export_csv(df, f"{tmp_path}/fine", sep=",", on_clash="error")
    assert len(list(Path(f"{tmp_path}/fine").glob("part-*"))) == 1


def test_publish_names_and_reruns(spark, tmp_path):
    df = spark.createDataFrame([(f"{i}", "2024-05-02 00:00:00") for i in range(25)], "Store string, Status_Date string")
    many = export.publish(df, str(tmp_path), "cancel", "JP", "BI", files=3)
    assert [Path(f).name for f in many] == [f"BI_JP_Cancel-20240502-0000{i}.csv" for i in (1, 2, 3)]
    lines = [line for f in many for line in Path(f.removeprefix("file:")).read_text().splitlines()]
    assert len(lines) == 28 and lines[0] == "Store|Status_Date"
    one = export.publish(df, str(tmp_path), "cancel", "JP", "BI")
    assert [p.name for p in sorted((tmp_path / "cancels").glob("*.csv"))] == ["BI_JP_Cancel-20240502.csv"]
    assert one == [f"{tmp_path}/cancels/BI_JP_Cancel-20240502.csv"]
    empty = export.publish(df.filter("false"), str(tmp_path), "cancel", "JP", "BI", fallback=date(2024, 1, 2))
    assert Path(empty[0]).name == "BI_JP_Cancel-20240102.csv"
    # Without rows and dates there is no file.
    assert export.publish(df.filter("false"), str(tmp_path), "cancel", "JP", "BI") == []


def test_landing_uses_the_folder_of_the_cluster(spark):
    with landed(spark.range(3), "landing-test") as frame:
        (folder,) = {str(Path(f).parent) for f in frame.inputFiles()}
        assert shared_folder(spark) in folder
        assert frame.count() == 3
    assert not folder_exists(spark, folder)
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_each_file_is_processed_once(spark, tmp_path):
    inbound, archive = tmp_path / "in", tmp_path / "archive"
    inbound.mkdir()
    seen = []

    def process(df, batch_id):
        seen.append((batch_id, sorted((r.value, Path(r[readers.SOURCE_FILE]).name) for r in df.collect())))

    def run():
        ingest_inbound(
            spark, "form_feed", str(inbound), str(tmp_path / "checkpoint"), process, str(archive), now=datetime(2024, 5, 1)
        )

    (inbound / "a.txt").write_text("A=1\nA=2\n")
    (inbound / "FY-1.csv").write_text("not,mine\n")
    run()
    run()
    (inbound / "b.txt").write_text("A=3\n")
    run()
    assert seen == [(0, [("A=1", "a.txt"), ("A=2", "a.txt")]), (1, [("A=3", "b.txt")])]
    assert (inbound / "FY-1.csv").exists()
    (inbound / "c.txt").write_text("A=4\n")
    run()
    archived = [p.relative_to(archive).as_posix() for p in archive.rglob("*.txt")]
    assert archived and all(name.startswith("2024/05/01/") for name in archived)


def test_a_failed_batch_is_offered_again(spark, tmp_path):
    inbound = tmp_path / "in"
    inbound.mkdir()
    (inbound / "a.txt").write_text("A=1\n")
    seen = []

    def process(df, batch_id):
        seen.append(batch_id)
        if len(seen) == 1:
            raise RuntimeError("lost")

    def run():
        ingest_inbound(spark, "form_feed", str(inbound), str(tmp_path / "checkpoint"), process)

    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert seen == [0, 0]


def test_every_flow_can_be_streamed(spark, tmp_path):
    inbound = tmp_path / "in"
    inbound.mkdir()
    for flow in FLOW_SOURCES:
        frames = []
        ingest_inbound(spark, flow, str(inbound), str(tmp_path / flow), lambda df, _, f=frames: f.append(df.columns))


def test_nothing_is_written_next_to_the_source(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "s string").select(F.upper("s").alias("s"))
    export.export_csv(df, f"{tmp_path}/x/out")
    assert [p.name for p in tmp_path.iterdir()] == ["x"]


def test_without_a_named_folder_the_warehouse_has_one():
    class Session:
        conf = {"spark.sql.warehouse.dir": "/warehouse/"}

    assert shared_folder(Session()) == "/warehouse/work"


def test_names_do_not_depend_on_the_rows(spark, tmp_path):
    one = spark.createDataFrame([("a", "2024-05-02 00:00:00")], "Store string, Status_Date string")
    names = export.publish(one, str(tmp_path), "cancel", "JP", "BI", files=3)
    assert [Path(f).name for f in names] == ["BI_JP_Cancel-20240502-00001.csv"]
    assert export.publish(one.limit(0), str(tmp_path), "cancel", "CN", "BI") == []


def test_old_files_are_picked_up(spark, tmp_path):
    inbound, seen = tmp_path / "in", []
    inbound.mkdir()

    def run(name, days):
        (inbound / name).write_text("a=1\n")
        stamp = time.time() - 86_400 * days
        os.utime(inbound / name, (stamp, stamp))
        ingest_inbound(
            spark, "form_feed", str(inbound), str(tmp_path / "checkpoint"), lambda df, _: seen.append(df.count())
        )

    for name, days in [("a.txt", 0), ("a2.txt", 0), ("old.txt", 30), ("older.txt", 400)]:
        run(name, days)
    assert seen == [1, 1, 1, 1]
