"""Loads that count whole or not at all, whatever fails, and what they read and keep."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom import contracts
from kpiloom.operators import history, key_filter, ledger, quality
from kpiloom.plans import history_flow
from kpiloom.session import folder_exists

SCHEMA = "eCom_Store_ID string, Transaction_Nbr string, Order_Date string, Tender string, Tender_Amt double, Demand_Currency string"


def payments(spark, *rows):
    """(order, date, tender, amount)"""
    return spark.createDataFrame([("s", txn, day, tender, amount, "JPY") for txn, day, tender, amount in rows], SCHEMA)


def stored(spark, root, kind="history", fact="payment"):
    rows = history_flow.read_history(spark, root, fact, kind=kind)
    return sorted((r.Transaction_Nbr, r.Tender, r.Tender_Amt) for r in rows.collect())


def numbers(spark, root):
    table = history.read_done(spark, root, "payment", "history", history_flow.table_schema("payment"))
    return sorted(r[0] for r in table.select(history.LOAD).distinct().collect())


@pytest.fixture
def root(tmp_path):
    return f"{tmp_path}/tables"


DAY = "2024-04-01 00:00:00"


@pytest.mark.parametrize("deduplicate", [True, False])
def test_tenders_of_an_order_in_two_loads(spark, root, deduplicate):
    for tender, amount in [("Card", 10.0), ("Points", 5.0), (None, 1.0), (None, 1.0)]:
        history_flow.load_fact(payments(spark, ("1", DAY, tender, amount)), root, "payment", deduplicate)
    rows = history_flow.read_history(spark, root, "payment").collect()
    assert sorted((r.Tender or "", r.Tender_Amt) for r in rows) == [("", 1.0), ("Card", 10.0), ("Points", 5.0)]


def test_a_complete_order_replaces_its_tenders(spark, root):
    history_flow.load_fact(payments(spark, ("1", DAY, "Card", 10.0), ("2", DAY, "Card", 7.0)), root, "payment", False)
    history_flow.load_fact(payments(spark, ("1", DAY, "Points", 4.0)), root, "payment", False, complete=True)
    assert stored(spark, root) == [("1", "Points", 4.0), ("2", "Card", 7.0)]
    history_flow.compact_history(spark, root, ["payment"])
    history_flow.load_fact(payments(spark, ("2", DAY, "Cash", 1.0)), root, "payment", False, complete=True)
    assert stored(spark, root) == [("1", "Points", 4.0), ("2", "Cash", 1.0)]


def test_no_row_is_unaccounted_for(spark, root):
    first = payments(spark, ("1", DAY, "Card", 10.0), ("", DAY, "Card", 1.0), ("", DAY, "Card", 1.0))
    assert history_flow.load_fact(first, root, "payment") == history_flow.LoadCount(3, 1, 0, 0, 2, 0)
    again = first.unionByName(payments(spark, ("2", "2024-05-01", "Card", 1.0), ("3", None, "Card", 1.0)))
    assert history_flow.load_fact(again, root, "payment") == history_flow.LoadCount(5, 1, 0, 1, 1, 2)
    assert history_flow.load_fact(again, root, "payment", False) == history_flow.LoadCount(5, 2, 2, 0, 0, 3)
    assert history_flow.load_fact(first.limit(0), root, "payment") == history_flow.LoadCount(0, 0, 0, 0, 0, 0)


def test_a_load_that_fails_changes_nothing(spark, root, monkeypatch):
    good = payments(spark, ("1", DAY, "Card", 10.0), ("", DAY, "Card", 1.0))
    history_flow.load_history({"payment": good}, root)
    before = stored(spark, root), stored(spark, root, "error")
    later = payments(spark, ("2", DAY, "Card", 20.0), ("", DAY, "Cash", 2.0))

    def bad_line():
        columns = [F.lit("x").alias(c) for c in contracts.LINE_COLUMNS]
        return spark.range(1).select(*columns)

    # The second fact is refused when the first is written already.
    with pytest.raises(Exception, match="Demand_Net is no double: x"):
        history_flow.load_history({"payment": later, "line": bad_line()}, root, source="feed", batch=7)
    assert (stored(spark, root), stored(spark, root, "error")) == before
    assert ledger.unfinished(spark, root) == [2]

    # It fails while it writes.
    def broken(*args, **kwargs):
        raise RuntimeError("disk")

    with monkeypatch.context() as m:
        m.setattr(history, "append_load", broken)
        with pytest.raises(RuntimeError, match="disk"):
            history_flow.load_history({"payment": later}, root)
    assert (stored(spark, root), stored(spark, root, "error")) == before

    # A load of another name, then the failed one again, under its number and in full.
    history_flow.load_history({"payment": payments(spark, ("9", DAY, "Card", 9.0))}, root)
    history_flow.load_history({"payment": later}, root, source="feed", batch=7)
    assert stored(spark, root) == [("1", "Card", 10.0), ("2", "Card", 20.0), ("9", "Card", 9.0)]
    assert [r[2] for r in stored(spark, root, "error")] == [1.0, 2.0]
    assert numbers(spark, root) == [1, 2, 4]


def test_a_replayed_batch_changes_nothing(spark, root):
    batch = payments(spark, ("1", DAY, "Card", 10.0))
    for number in (0, 1):
        history_flow.load_history({"payment": batch}, root, deduplicate=False, source="stream", batch=number)
    counts = history_flow.load_history({"payment": payments(spark, ("1", DAY, "Card", 99.0))}, root, deduplicate=False, source="stream", batch=1)
    assert counts == {"payment": None}
    assert numbers(spark, root) == [1, 2] and stored(spark, root) == [("1", "Card", 10.0)]
    table = history.read_done(spark, root, "payment", "history", history_flow.table_schema("payment"))
    assert table.count() == 2


def test_numbers_follow_no_clock(spark, root):
    """A load whose clock was set back is still the later one."""
    history_flow.load_fact(payments(spark, ("1", DAY, "Card", 1.0)), root, "payment", False, now="2024-06-01 00:00:00")
    history_flow.load_fact(payments(spark, ("1", DAY, "Card", 2.0)), root, "payment", False, now="2024-05-01 00:00:00")
    assert stored(spark, root) == [("1", "Card", 2.0)]


def test_ledger_keeps_few_marks(spark, root, tmp_path):
    for batch in range(5):
        with ledger.loading(spark, root, "a", batch):
            pass
        with ledger.loading(spark, root):
            pass
    marks = [p.name for p in (tmp_path / "tables" / ledger.FOLDER).iterdir() if not p.name.startswith(".")]
    assert len(marks) <= 4
    assert ledger.begin(spark, root, "a", 4).done
    assert ledger.begin(spark, root).number == 11


def test_only_months_that_can_have_a_key_are_read(spark, root, monkeypatch):
    """New keys open no file of the table; a key that comes again opens its month only."""
    months = [f"2024-{m:02d}-03 00:00:00" for m in range(1, 7)]
    first = payments(spark, *[(f"{m}-{i}", m, "Card", 1.0) for m in months for i in range(50)])
    history_flow.load_fact(first, root, "payment")
    read = []
    original = history.read_months

    def listed(spark, path, wanted, schema, fmt="parquet"):
        if path.endswith("kind=history"):
            read.append(sorted(m or "" for m in wanted))
        return original(spark, path, wanted, schema, fmt)

    monkeypatch.setattr(history, "read_months", listed)
    new = payments(spark, *[(f"new-{m}-{i}", m, "Card", 1.0) for m in months for i in range(50)])
    assert history_flow.load_fact(new, root, "payment").added == 300
    assert read == [[]]
    read.clear()
    again = new.unionByName(payments(spark, ("x", months[0], "Card", 1.0)))
    again = again.filter((F.col("Order_Date") == months[2]) | (F.col("Transaction_Nbr") == "x"))
    count = history_flow.load_fact(again, root, "payment")
    assert (count.added, count.known) == (1, 50)
    assert read == [["2024-03"]]
    table = original(spark, history.table_path(root, "payment", "history"), ["2024-03", "1999-01"], history_flow.table_schema("payment"))
    files = table.inputFiles()
    assert files and all("order_month=2024-03" in f for f in files)


def test_reading_does_not_grow_with_the_loads(spark, root):
    """What a load of new orders reads of the table is the same after 1 and after 12 loads."""
    def files(n):
        batch = payments(spark, (f"n{n}", "2024-04-02 00:00:00", "Card", 1.0)).withColumn(key_filter.MONTH, F.lit("2024-04"))
        filters = history_flow._filters(spark, root, "payment", ["2024-04"])
        maybe = key_filter.maybe_known(batch, filters, contracts.PRIMARY_KEYS["payment"])
        return maybe.count()

    found = []
    for n in range(12):
        history_flow.load_fact(payments(spark, (str(n), DAY, "Card", 1.0)), root, "payment")
        found.append(files(n))
    assert found == [0] * 12


def test_filter_has_no_false_negatives_and_grows(spark, monkeypatch):
    monkeypatch.setattr(key_filter, "FIRST_KEYS", 128)
    keys = ["k", "n"]

    def keyed(a, b):
        month = F.when(F.col("id") % 3 == 0, "2024-01").otherwise(F.lit(None))
        return spark.range(a, b).select(F.col("id").cast("string").alias("k"), F.lit(None).cast("string").alias("n"), month.alias("order_month"))

    filters = spark.createDataFrame([], key_filter.SCHEMA)
    for start in range(0, 3000, 500):
        held = key_filter.held(filters)
        rows = key_filter.with_generation(keyed(start, start + 500), {m: held.get(m, 0) + 400 for m in ("2024-01", None)})
        words = key_filter.words(rows, keys).withColumn("load_number", F.lit(start).cast("long"))
        filters = spark.createDataFrame(filters.unionByName(words).collect(), key_filter.SCHEMA)
    assert {r[0] for r in filters.select("generation").distinct().collect()} >= {2, 3, 4}
    held = key_filter.held(filters)
    assert abs(held["2024-01"] - 1000) < 60 and abs(held[None] - 2000) < 120
    assert key_filter.maybe_known(keyed(0, 3000), filters, keys).count() == 3000
    assert key_filter.maybe_known(keyed(10_000, 20_000), filters, keys).count() < 60


def test_assign(spark):
    table = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.DoubleType()), T.StructField("i", T.IntegerType())])
    df = spark.createDataFrame([(1, "2.5"), (2, " "), (3, None)], "a int, n string")
    assert [tuple(r) for r in quality.assign(df, table).collect()] == [("1", 2.5, None), ("2", None, None), ("3", None, None)]
    bad = spark.createDataFrame([("x", "no", 7)], "a string, n string, i long")
    with pytest.raises(Exception, match="n is no double: no"):
        quality.assign(bad, table).collect()
    assert tuple(quality.assign(bad, table, "quarantine").first()) == ("x", None, 7, False)
    with pytest.raises(ValueError, match="b"):
        quality.assign(df.withColumn("b", F.lit(1)), table)
    with pytest.raises(ValueError, match="array"):
        quality.assign(df.withColumn("n", F.array(F.lit(1))), table)


def test_compaction(spark, root):
    april, may = "2024-04-01 00:00:00", "2024-05-01 00:00:00"
    load = lambda *rows: history_flow.load_fact(payments(spark, *rows), root, "payment", False)
    load(("1", april, "Card", 1.0), ("2", may, "Card", 2.0))
    load(("1", april, "Card", 1.5))
    assert history_flow.compact_history(spark, root, ["payment"]) == {"payment": ["2024-04", "2024-05"]}
    assert history_flow.compact_history(spark, root, ["payment"]) == {"payment": []}
    want = [("1", "Card", 1.5), ("2", "Card", 2.0)]
    assert stored(spark, root) == want
    load(("2", may, "Card", 2.5), ("3", may, "Card", 3.0))
    want = [("1", "Card", 1.5), ("2", "Card", 2.5), ("3", "Card", 3.0)]
    assert stored(spark, root) == want
    # Only the month that changed is written anew.
    assert history_flow.compact_history(spark, root, ["payment"]) == {"payment": ["2024-05"]}
    assert stored(spark, root) == want
    load(("4", april, "Card", 4.0))
    assert history_flow.compact_history(spark, root, ["payment"]) == {"payment": ["2024-04"]}
    want.append(("4", "Card", 4.0))
    assert stored(spark, root) == want
    # What the last compaction but one has named is still there for its readers; what it had replaced is gone.
    assert folder_exists(spark, f"{root}/_current/payment/order_month=2024-04/as_of=2")
    load(("5", may, "Card", 5.0))
    history_flow.compact_history(spark, root, ["payment"])
    assert not folder_exists(spark, f"{root}/_current/payment/order_month=2024-04/as_of=2")
    assert folder_exists(spark, f"{root}/_current/payment/order_month=2024-04/as_of=4")


def test_compaction_leaves_out_what_is_not_done(spark, root):
    history_flow.load_fact(payments(spark, ("1", DAY, "Card", 1.0)), root, "payment", False)
    with pytest.raises(RuntimeError, match="lost"), ledger.loading(spark, root, "s", 1) as load:
        history_flow.load_fact(payments(spark, ("1", DAY, "Card", 2.0)), root, "payment", False, load=load)
        raise RuntimeError("lost")
    history_flow.load_fact(payments(spark, ("1", DAY, "Card", 3.0)), root, "payment", False)
    history_flow.compact_history(spark, root, ["payment"])
    assert stored(spark, root) == [("1", "Card", 3.0)]
    with ledger.loading(spark, root, "s", 1) as load:
        history_flow.load_fact(payments(spark, ("5", DAY, "Card", 5.0)), root, "payment", False, load=load)
    assert stored(spark, root) == [("1", "Card", 3.0), ("5", "Card", 5.0)]
