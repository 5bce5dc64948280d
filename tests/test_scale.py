"""What is shuffled and written per row of the input."""

import re
import threading
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from kpiloom.catalog import derive
from kpiloom.catalog.registry import QUERIES
from kpiloom.functions import dates
from kpiloom.operators import export, history, key_filter
from kpiloom.plans import feed_flow, history_flow

SF_DIR = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not there")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_key_is_one_row_of_a_filter(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("2024-01").alias(key_filter.MONTH))
    words = key_filter.words(key_filter.with_generation(rows, {"2024-01": 1000}), ["k"])
    assert 0 < words.count() <= 1000
    filters = words.withColumn("load_number", F.lit(1).cast("long"))
    assert "Generate" not in plan(key_filter.maybe_known(rows, filters, ["k"]))


def test_new_rows_meet_no_join(spark, tmp_path, monkeypatch):
    """Whole rows of a first load go to the table in one shuffle, the invalid ones too."""
    plans = []
    original = history.append_load

    def watched(df, *args, **kwargs):
        plans.append(plan(df))
        return original(df, *args, **kwargs)

    monkeypatch.setattr(history, "append_load", watched)
    schema = "eCom_Store_ID string, Transaction_Nbr string, Order_Date string, Tender string, Tender_Amt double"
    day = "2024-04-01 00:00:00"
    batch = spark.createDataFrame([("s", "1", day, "Card", 1.0), ("s", None, day, "Card", 2.0)], schema)
    load = lambda: history_flow.load_fact(batch, f"{tmp_path}/t", "payment")
    assert load() == history_flow.LoadCount(2, 1, 0, 0, 1, 0)
    assert "Join" not in plans[0]
    assert load() == history_flow.LoadCount(2, 0, 0, 1, 0, 1)


def test_filters_of_the_form_before_are_no_filters(spark, tmp_path):
    """Keys that only an older filter has are looked up in the table."""
    root = f"{tmp_path}/t"
    schema = "eCom_Store_ID string, Transaction_Nbr string, Order_Date string, Tender string, Tender_Amt double"
    batch = spark.createDataFrame([("s", "1", "2024-04-01 00:00:00", "Card", 1.0)], schema)
    history_flow.load_fact(batch, root, "payment")
    Path(f"{root}/_key_blocks").rename(f"{root}/_keys")
    count = history_flow.load_fact(batch, root, "payment")
    assert (count.added, count.known) == (0, 1)


@needs_tables
@pytest.mark.parametrize("feed, shuffles", [("form_feed", 2), ("sales_envelopes", 1), ("conformed_line", 2)])
def test_feeds_shuffle_the_columns_of_the_tables_once(spark, feed, shuffles):
    assert len(re.findall(r"Exchange hashpartitioning", plan(getattr(derive, feed)(spark, SF_DIR)))) == shuffles


def test_one_file_is_printed_by_many_tasks(spark, tmp_path, monkeypatch):
    """The rows of a single export file go through no shuffle to one task."""
    monkeypatch.setattr(export, "export_csv", None)
    df = spark.range(0, 1000, 1, 4).select(F.concat(F.lit("T,"), "id").alias("Transaction_Nbr"), F.lit(None).cast("string").alias("Order_Date"))
    (file,) = export.publish(df, str(tmp_path), "header", "JP", "BI", fallback=date(2024, 5, 1))
    data = Path(file).read_bytes()
    assert data.startswith(b"Transaction_Nbr,Order_Date\r\n") and data.endswith(b"\r\n")
    assert sorted(data.split(b"\r\n")[1:-1]) == sorted(f"T {i},".encode() for i in range(1000))
    again = export.publish(df.limit(3), str(tmp_path), "header", "JP", "BI", fallback=date(2024, 5, 1))
    assert again == [file] and len(Path(file).read_bytes().split(b"\r\n")) == 5


def test_an_empty_date_is_not_parsed(spark):
    """Only the parser of a text that is there may fail; most orders have no date of cancellation."""
    df = spark.createDataFrame([("",), ("2024/05/01",), (None,)], "d string").select(dates.norm_ts(F.col("d"), dates.FEED_DATE).alias("t"))
    assert [r.t for r in df.collect()] == [None, "2024-05-01 00:00:00", None]
    assert "nullif" in plan(df).lower() or "= )" in plan(df)


@needs_tables
def test_ids_are_not_sorted_where_they_are_read(spark):
    text = plan(QUERIES["record_id"](spark, SF_DIR))
    below = text[text.index("partial_first") :].split("\n")
    assert any("Exchange hashpartitioning(record_id" in line for line in below[1:3])


@needs_tables
@pytest.mark.parametrize("per_task, tasks", [(200_000, 4), (1000, 8), (500, 15)])
def test_tasks_that_build_pages_grow_with_the_rows(spark, monkeypatch, per_task, tasks):
    """Sized by the narrow rows of the shuffle, a task spilled the wide pages that it makes of them."""
    monkeypatch.setattr(derive, "ROWS_PER_TASK", per_task)
    pages = derive.sales_envelopes(spark, SF_DIR)
    assert re.findall(r"hashpartitioning\(page#\d+L, (\d+)\), (\w+)", plan(pages)) == [(str(tasks), "REPARTITION_BY_NUM")]
    assert pages.agg(F.sum("total")).first()[0] == spark.read.parquet(f"{SF_DIR}/orders.parquet").count()


def test_the_parse_of_orders_and_items_is_compiled(spark):
    """The JVM interprets methods of more than 8,000 bytes, which made the one pass for both eight times as slow as each alone."""
    feed = spark.createDataFrame([("ORDER_DISP_NO=ORDER1&ORDER_D_NO_1=1&TEIKA_1=3&QUANTITY_1=2",), ("ORDER_DISP_NO=e2",)], "value string")
    records = feed_flow.parse_records(feed)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(records._jdf.queryExecution().executedPlan())
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes and max(sizes) < 8000
    rows = records.select("Transaction_Nbr", "place", "is_item", "line.Demand_Net").collect()
    assert sorted(map(tuple, rows)) == [("1", 0, True, 6.0), ("2", 0, False, None)]


PAYMENT = "eCom_Store_ID string, Transaction_Nbr string, Order_Date string, Tender string, Tender_Amt double"


def payments(spark, *orders):
    return spark.createDataFrame([("s", txn, "2024-04-01 00:00:00", "Card", 1.0) for txn in orders], PAYMENT)


def test_valid_and_invalid_rows_are_read_once(spark, tmp_path, monkeypatch):
    """The landed batch is read once to be written, also when some of its keys are known."""
    plans = []
    original = history.append_load

    def watched(df, *args, **kwargs):
        plans.append(plan(df))
        return original(df, *args, **kwargs)

    monkeypatch.setattr(history, "append_load", watched)
    load = lambda *orders: history_flow.load_fact(payments(spark, *orders), f"{tmp_path}/t", "payment", False)
    assert load("1", None) == history_flow.LoadCount(2, 1, 0, 0, 1, 0)
    assert load("1", "2", "") == history_flow.LoadCount(3, 2, 1, 0, 1, 0)
    assert [len(re.findall(r"Scan parquet .*Tender_Amt", text)) for text in plans] == [1, 1]


def test_facts_are_loaded_side_by_side(spark, tmp_path, monkeypatch):
    """While one fact's load lists or commits, the tasks of the others run."""
    all_there = threading.Barrier(3, timeout=60)
    monkeypatch.setattr(history_flow, "load_fact", lambda df, root, fact, *args, **kwargs: (all_there.wait(), fact)[1])
    facts = dict.fromkeys(("header", "line", "payment"), payments(spark, "1"))
    assert history_flow.load_history(facts, f"{tmp_path}/t") == {fact: fact for fact in facts}


def test_rows_that_nothing_replaces_meet_no_join(spark, tmp_path):
    """What is exported or written down is shuffled whole only where a key has a later version."""
    root = f"{tmp_path}/t"
    history_flow.load_fact(payments(spark, "1", "2"), root, "payment", False)
    history_flow.load_fact(payments(spark, "3"), root, "payment", False)
    keys, sets = ["eCom_Store_ID", "Transaction_Nbr", "Order_Date", "Tender"], ["eCom_Store_ID", "Transaction_Nbr", "Order_Date"]
    rows = history.read_done(spark, root, "payment", "history", history_flow.table_schema("payment"))
    assert "Join" not in plan(history.current(rows, keys, sets, f"{tmp_path}/a"))
    assert history_flow.compact_history(spark, root, ["payment"])["payment"]
    assert "Join" not in plan(history_flow.read_history(spark, root, "payment"))
    history_flow.load_fact(payments(spark, "3"), root, "payment", False)
    rows = history.read_done(spark, root, "payment", "history", history_flow.table_schema("payment"))
    landed = history.current(rows, keys, sets, f"{tmp_path}/b")
    assert "Join" in plan(landed) and (rows.count(), landed.count()) == (4, 3)
    assert history_flow.read_history(spark, root, "payment").count() == 3
