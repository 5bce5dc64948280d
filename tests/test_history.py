from datetime import date

import pytest
from pyspark.sql import functions as F

from kpiloom import contracts
from kpiloom.operators import history
from kpiloom.plans import history_flow

SCHEMA = "eCom_Store_ID string, Transaction_Nbr string, Order_Date string, Tender string, Tender_Amt double, Demand_Currency string"
DAY1, DAY2, DAY3 = "2024-05-01 09:00:00", "2024-05-02 09:00:00", "2024-05-03 23:59:59"


def payment(spark, *rows):
    return spark.createDataFrame([("s", txn, day, "Card", amount, "JPY") for txn, day, amount in rows], SCHEMA)


@pytest.fixture
def root(tmp_path):
    return f"{tmp_path}/tables"


def load(df, root, now, **options):
    history_flow.load_fact(df, root, "payment", now=now, **options)


def stored(spark, root, kind="history"):
    rows = history_flow.read_history(spark, root, "payment", payment(spark).schema, kind=kind)
    stamp = F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss")
    return sorted(map(tuple, rows.select("Transaction_Nbr", "Tender_Amt", stamp).collect()), key=str)


def test_insert_if_absent_is_repeatable(spark, root):
    first = payment(spark, ("1", "2024-04-01 00:00:00", 10.0), ("2", "2024-04-02 00:00:00", 20.0))
    load(first, root, DAY1)
    once = stored(spark, root)
    load(first, root, DAY1)
    load(payment(spark, ("2", "2024-04-02 00:00:00", 99.0), ("2", "2024-04-03 00:00:00", 30.0)), root, DAY2)
    assert once == [("1", 10.0, DAY1), ("2", 20.0, DAY1)]
    assert stored(spark, root) == [*once, ("2", 30.0, DAY2)]


def test_duplicates_of_a_batch_are_all_inserted(spark, root):
    load(payment(spark, ("1", "2024-04-01 00:00:00", 10.0), ("1", "2024-04-01 00:00:00", 11.0)), root, DAY1)
    assert [r[1] for r in stored(spark, root)] == [10.0, 11.0]


def test_upsert(spark, root):
    load(payment(spark, ("1", "2024-04-01 00:00:00", 10.0), ("2", "2024-04-02 00:00:00", 20.0)), root, DAY1, deduplicate=False)
    load(payment(spark, ("2", "2024-04-02 00:00:00", 21.0), ("2", "2024-04-02 00:00:00", 22.0)), root, DAY2, deduplicate=False)
    # Both payments of the re-sent order stay, the earlier version goes.
    assert stored(spark, root) == [("1", 10.0, DAY1), ("2", 21.0, DAY2), ("2", 22.0, DAY2)]
    load(payment(spark, ("1", "2024-04-01 00:00:00", 10.0)), root, DAY3, deduplicate=False)
    assert stored(spark, root) == [("1", 10.0, DAY3), ("2", 21.0, DAY2), ("2", 22.0, DAY2)]


def test_upserts_of_one_stamp(spark, root):
    for amount in (10.0, 12.0, 11.0):
        load(payment(spark, ("1", "2024-04-01 00:00:00", amount)), root, DAY1, deduplicate=False)
    assert stored(spark, root) == [("1", 11.0, DAY1)]


def test_a_repeated_batch_is_quarantined_once(spark, root):
    batch = payment(spark, ("", "2024-04-01 00:00:00", 2.0), (None, None, 3.0), (None, None, 3.0))
    for now in (DAY1, DAY2):
        load(batch, root, now)
    assert sorted(r[1] for r in stored(spark, root, "error")) == [2.0, 3.0, 3.0]


def test_keys_without_the_date(spark, root):
    keys = ["eCom_Store_ID", "Transaction_Nbr"]
    load(payment(spark, ("1", "2024-04-01 00:00:00", 10.0)), root, DAY1, keys=keys)
    load(payment(spark, ("1", "2024-05-01 00:00:00", 10.0)), root, DAY2, keys=keys)
    assert stored(spark, root) == [("1", 10.0, DAY1)]


def test_invalid_rows_go_to_the_error_table_unless_known(spark, root):
    batch = payment(spark, ("1", "2024-04-01 00:00:00", 1.0), ("", "2024-04-01 00:00:00", 2.0), (None, None, 3.0))
    load(batch, root, DAY1)
    assert [r[1] for r in stored(spark, root)] == [1.0]
    assert sorted(r[1] for r in stored(spark, root, "error")) == [2.0, 3.0]
    # An invalid row of a known key is dropped; here the amount makes it invalid.
    fields = [*contracts.MANDATORY["payment"], "Tender_Amt"]
    contracts.MANDATORY["payment"], before = fields, contracts.MANDATORY["payment"]
    try:
        load(payment(spark, ("1", "2024-04-01 00:00:00", None), ("9", "2024-04-01 00:00:00", None)), root, DAY2)
    finally:
        contracts.MANDATORY["payment"] = before
    assert [r[0] for r in stored(spark, root, "error") if r[2] == DAY2] == ["9"]


def test_line_key_counts_the_item(spark, root):
    schema = ", ".join(f"{c} {'double' if c == 'Demand_Net' else 'string'}" for c in contracts.LINE_COLUMNS)

    def line(number):
        amounts = dict.fromkeys(["Demand_Sales_Unit", "GiftChrg", "GiftTax", "DiscountAmt"], "2")
        values = amounts | {"ItmSeqNum": number, "Demand_Net": 1.0, "Order_Date": "2024-04-01 00:00:00"}
        return spark.createDataFrame([tuple(values.get(c, "x") for c in contracts.LINE_COLUMNS)], schema)

    def numbers():
        return sorted(r.ItmSeqNum for r in history_flow.read_history(spark, root, "line", line("1").schema).collect())

    history_flow.load_fact(line("1"), root, "line", now=DAY1)
    history_flow.load_fact(line("2"), root, "line", now=DAY2)
    assert numbers() == ["1", "2"]
    # By the keys of the order alone, a late item of a known order is not added.
    history_flow.load_fact(line("3"), root, "line", now=DAY3, keys=contracts.ORDER_KEYS["line"])
    assert numbers() == ["1", "2"]


def test_window_is_half_open_per_day_and_shows_the_latest_version(spark, root):
    load(payment(spark, ("1", "2024-04-01 00:00:00", 1.0), ("2", "2024-04-01 00:00:00", 2.0)), root, DAY1, deduplicate=False)
    load(payment(spark, ("2", "2024-04-01 00:00:00", 3.0)), root, "2024-05-02 00:00:00", deduplicate=False)
    load(payment(spark, ("3", "2024-04-01 00:00:00", 4.0)), root, DAY3, deduplicate=False)
    schema = history.table_schema(history_flow.checked_schema(payment(spark).schema))
    table = history.read_table(spark, history.table_path(root, "payment", "history"), schema)

    def window(start, end):
        rows = history.window_slice(table, contracts.PRIMARY_KEYS["payment"], start, end)
        return sorted((r.Transaction_Nbr, r.Tender_Amt) for r in rows.collect())

    assert window(date(2024, 5, 1), date(2024, 5, 1)) == [("1", 1.0)]
    assert window(date(2024, 5, 2), date(2024, 5, 3)) == [("2", 3.0), ("3", 4.0)]
    assert window(date(2024, 5, 4), date(2024, 5, 9)) == []
    plan = history.window_slice(table, ["Transaction_Nbr"], date(2024, 5, 2), date(2024, 5, 2))
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan._jdf.queryExecution().toString()


def test_anti_join_reads_only_the_dates_of_the_batch(spark, root):
    load(payment(spark, ("1", "2024-04-01 00:00:00", 1.0)), root, DAY1)
    schema = history.table_schema(history_flow.checked_schema(payment(spark).schema))
    table = history.read_table(spark, history.table_path(root, "payment", "history"), schema)
    near = history.near_batch(table, payment(spark, ("7", "2024-04-03 00:00:00", 1.0)), "Order_Date")
    pushed = near.select("Transaction_Nbr")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(Order_Date,2024-04-03 00:00:00)" in pushed
    assert near.count() == 0
    assert history.near_batch(table, payment(spark), "Order_Date").count() == 0


def test_snapshot(spark, root):
    load(payment(spark, ("1", "2024-04-01 00:00:00", 1.0)), root, DAY1, deduplicate=False)
    load(payment(spark, ("1", "2024-04-01 00:00:00", 2.0)), root, DAY2, deduplicate=False)
    schema = history.table_schema(history_flow.checked_schema(payment(spark).schema))
    table = history.read_table(spark, history.table_path(root, "payment", "history"), schema)
    history.snapshot(table, contracts.PRIMARY_KEYS["payment"], f"{root}/snapshot")
    assert [r.Tender_Amt for r in history.read_table(spark, f"{root}/snapshot", schema).collect()] == [2.0]


def test_one_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "w"), (None, 1, "n")], "k string, v int, w string")
    assert sorted(map(tuple, history.one_per_key(df, ["k"]).collect()), key=str) == [("a", 2, "w"), (None, 1, "n")]


def test_registered_table(spark, root):
    load(payment(spark, ("1", "2024-04-01 00:00:00", 1.0)), root, DAY1)
    load(payment(spark, ("2", "2024-04-01 00:00:00", 2.0)), root, DAY2)
    schema = history.table_schema(history_flow.checked_schema(payment(spark).schema))
    for _ in range(2):
        history.register_table(spark, "payment_history", history.table_path(root, "payment", "history"), schema)
    found = spark.sql("SELECT Transaction_Nbr FROM payment_history WHERE ingestion_date = DATE '2024-05-02'").collect()
    spark.sql("DROP TABLE payment_history")
    assert [r.Transaction_Nbr for r in found] == ["2"]
