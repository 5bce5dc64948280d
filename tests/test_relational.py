from datetime import date

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import joins, nested, quality, relational
from kpiloom.sources import pages
from kpiloom.sources.readers import SOURCE_FILE


def tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(params=["broadcast", "shuffle"])
def strategy(spark, request):
    """Both join strategies must give the same rows."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "10MB" if request.param == "broadcast" else "-1")
    yield
    spark.conf.set(key, before)


def test_tender_join(spark, strategy):
    pay = spark.createDataFrame(
        [(1, "CN", "a"), (2, "HK", "a"), (3, None, "a"), (4, "CN", None), (5, "CN", "b")], "id int, Country string, Tender string"
    )
    tender = spark.createDataFrame(
        [("CN", "a", "Card"), ("CN", "b", "Cash"), ("CN", "b", "Coin")], "Country string, TenderID string, TenderType string"
    )
    on = {"Country": "Country", "Tender": "TenderID"}
    kept = joins.join_tender(pay, tender, on).select("id", "TenderType")
    assert tuples(kept) == [(1, "Card"), (2, None), (3, None), (4, None), (5, "Cash"), (5, "Coin")]
    other = joins.join_tender(pay, tender, on, policy="other").select("id", "TenderType")
    assert tuples(other)[1] == (2, "OTHER")


def test_item_join(spark, strategy):
    lines = spark.createDataFrame([(1, "b1"), (2, None), (3, "zz")], "id int, Barcode string")
    items = spark.createDataFrame([("b1", " s ", "c", "m ")], "Barcode string, Style string, Color string, Size string")
    assert tuples(joins.with_item(lines, items))[0] == (1, "b1", " s ", "c", "m ")
    assert tuples(joins.with_item(lines, items, trim=True)) == [
        (1, "b1", "s", "c", "m"), (2, None, None, None, None), (3, "zz", None, None, None),
    ]


def test_cancel_match_fans_out_and_keeps_unmatched(spark, strategy):
    keys = "eCom_Store_ID string, Transaction_Nbr string"
    header = spark.createDataFrame(
        [("s", "t", "1"), ("s", "t", "01"), ("s", "t", "x"), ("s", None, "1")], keys + ", ORDER_D_NO string"
    )
    lines = spark.createDataFrame([("s", "t", 1, "b"), ("s", "t", 1, "c"), ("s", "u", 1, "d")], keys + ", Item_Seq_Number int, Barcode string")
    matched = joins.cancel_match(header, lines, ["Barcode"]).select("Transaction_Nbr", "ORDER_D_NO", "Barcode")
    assert tuples(matched) == [
        ("t", "01", "b"), ("t", "01", "c"), ("t", "1", "b"), ("t", "1", "c"), ("t", "x", None), (None, "1", None),
    ]


def test_null_key_counts_as_new(spark, strategy):
    batch = spark.createDataFrame([("a", "1"), ("b", None), ("c", "3")], "k string, d string")
    history = spark.createDataFrame([("a", "1"), ("b", None)], "k string, d string")
    assert tuples(joins.not_in_history(batch, history, ["k", "d"])) == [("b", None), ("c", "3")]


def test_order_total_with_a_hot_and_a_null_key(spark, strategy):
    hot = spark.range(9_000).select(F.lit("hot").alias("k"), F.lit(1.0).alias("v"))
    rest = spark.createDataFrame([("a", 2.0), ("a", 3.0), (None, 4.0), (None, 5.0), ("n", None)], "k string, v double")
    total = relational.order_total(hot.unionByName(rest), "k", F.col("v"), "total")
    assert tuples(total.groupBy("k", "total").count()) == [
        ("a", 5.0, 2), ("hot", 9000.0, 9000), ("n", None, 1), (None, 9.0, 2),
    ]
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_order_total_keeps_the_frame(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    assert relational.order_total(df, "k", F.col("v"), "total").columns == ["k", "v", "total"]


def test_mandatory_check(spark):
    df = spark.createDataFrame([("a", 1.0), ("", 1.0), (None, 1.0), ("a", None)], "s string, n double")
    once = quality.check_mandatory(df, ["s"])
    twice = quality.check_mandatory(once, ["n"])
    assert [r.mandatory_field_check for r in once.collect()] == [True, False, False, True]
    assert [r.mandatory_field_check for r in twice.collect()] == [True, False, False, False]
    valid, invalid = quality.split_valid(twice)
    assert (valid.count(), invalid.count()) == (1, 3)


def test_derive_reads_raw_columns(spark):
    df = spark.createDataFrame([("5", "k")], "TAX string, KEY string")
    out = relational.derive(df, {"Tax": F.col("TAX").cast("int"), "Double": F.col("TAX") * 2})
    assert out.columns == ["KEY", "Tax", "Double"]
    assert tuple(out.first()) == ("k", 5, 10.0)


def test_business_date(spark):
    df = spark.createDataFrame([("2024-05-02 10:00:00",), ("2024-05-01 23:00:00",), (None,)], "t string")
    assert relational.business_date(df, "t") == date(2024, 5, 1)
    none = df.filter("t is null")
    assert relational.business_date(none, "t") is None
    assert relational.business_date(none, "t", F.lit(date(2024, 1, 1))) == date(2024, 1, 1)


def test_explode_range(spark, monkeypatch):
    monkeypatch.setattr(nested, "RANGE_CHUNK", 4)
    df = spark.createDataFrame([("a", 1, 10), ("b", 3, 3), ("c", 1, 0), ("d", None, 3)], "k string, lo int, hi int")
    out = nested.explode_range(df, F.col("lo"), F.col("hi"), "n").select("k", "n")
    assert sorted(map(tuple, out.collect())) == [("a", n) for n in range(1, 11)] + [("b", 3)]


def test_explodes_drop_empty_arrays(spark):
    schema = "orders array<struct<Country: string, Order_Lines: array<struct<n: int>>, Order_Payments: array<struct<p: int>>>>"
    data = [([("CN", [(1,), (2,)], [(7,)]), ("HK", [], None)],), ([],), (None,)]
    orders = nested.explode_orders(spark.createDataFrame(data, schema))
    assert orders.count() == 2
    assert tuples(nested.explode_lines(orders)) == [(1,), (2,)]
    assert tuples(nested.explode_payments(orders)) == [("CN", 7)]


def test_page_audit(spark):
    landed = spark.createDataFrame(
        [
            ("/in/CN-20240501-Sales-1.json", 3, True, 0),
            ("/in/CN-20240501-Sales-3.json", 3, True, 1),
            ("/in/CN-20240501-Sales-3.json", 3, True, 0),
            ("/in/HK-20240501-Cancel-1.json", None, None, 0),
        ],
        f"{SOURCE_FILE} string, pages long, success boolean, code long",
    )
    report = pages.landed_pages(landed)
    assert [(r.region, r.page) for r in pages.missing_pages(report).collect()] == [("CN", 2)]
    audit = {r.region: tuple(r)[2:] for r in pages.audit_pages(report, ok_code=0).collect()}
    assert audit == {"CN": ("Sales", 3, 2, 1, 1), "HK": ("Cancel", 1, 1, 1, 0)}
