"""Whole flows on small feeds with every odd case in them."""

import re

import pytest
from pyspark.sql import functions as F

from kpiloom import contracts
from kpiloom.plans import conformed_flow, envelope_flow, feed_flow, flat_flow
from kpiloom.plans.render import RULES, render
from kpiloom.session import work_folder


@pytest.fixture(scope="module")
def tender(spark):
    return spark.createDataFrame([("4", "Card"), ("5", "Cash")], contracts.TENDER)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([("b1", " st ", "red", "M")], contracts.ITEM)


FEED = [
    "ORDER_DISP_NO=ORDER100&ORDER_DATE=2024%2F05%2F01&CANCEL_DATE=&ORDER_H_ACCESS_BROWSER_KBN=2%3Aphone&MEMBER_ID=m%26m"
    "&SEIKYU=1100&TAX=100&DAIBIKI=0&SORYO=50&SORYO_TAX=5&COUPON_WARIBIKI=10&COUPON_ID=&FREE_ITEM11=20&FREE_ITEM33=7"
    "&SHIRE_SUM=900&TEIKA_SUM=800&TEIKA_SUM_TAX=80&KESSAI_ID=4"
    "&ORDER_D_NO_1=1&ORDER_D_FREE_ITEM31_1=C&ORDER_D_FREE_ITEM32_1=b1&ORDER_D_FREE_ITEM35_1=3&TEIKA_1=400&QUANTITY_1=2&SHIRE_PRICE_1=450"
    "&ORDER_D_NO_2=2&ORDER_D_FREE_ITEM31_2=L&ORDER_D_FREE_ITEM32_2=&TEIKA_2=10&QUANTITY_2=x&SHIRE_PRICE_2=11",
    # Cancelled, item type of a store of its own, unknown tender and barcode.
    "ORDER_DISP_NO=e200&ORDER_DATE=2024%2F05%2F02&CANCEL_DATE=2024%2F05%2F03&ORDER_H_ACCESS_BROWSER_KBN=9&MEMBER_ID=&SEIKYU=500"
    "&TEIKA_SUM=400&TEIKA_SUM_TAX=40&KESSAI_ID=77&ORDER_D_NO_1=1&ORDER_D_FREE_ITEM31_1=L&ORDER_D_FREE_ITEM32_1=zz&TEIKA_1=400&QUANTITY_1=1",
]


@pytest.fixture(scope="module")
def feed(spark):
    # The first record is sent twice: both copies count.
    return spark.createDataFrame([(FEED[0],), (FEED[0],), (FEED[1],), ("",)], "value string")


def as_dicts(df):
    return [row.asDict() for row in df.collect()]


def test_feed_header(feed):
    header = feed_flow.build_header(feed_flow.parse_orders(feed))
    assert header.columns == contracts.HEADER_COLUMNS
    found = as_dicts(header.filter("Transaction_Nbr is not null"))
    assert len(found) == 2 and found[0] == found[1]
    order = found[0]
    assert order["eCom_Store_ID"] == "57037"
    assert order["Order_Date"] == "2024-05-01 00:00:00"
    assert order["Device_Type"] == "MOBILE"
    assert order["Customer_ID"] == "m&m"
    assert order["Promotion_Coupons"] == "N"
    assert order["Demand_Net"] == 1100 - 100 - 0 - 50 - 10 - 20
    assert order["Discount_Amount"] == 107
    assert render(header, "feed", "header").filter("Transaction_Nbr = '100'").first().Employee_ID == "NULL"


def test_feed_payment(feed, tender):
    payments = feed_flow.build_payment(feed_flow.parse_orders(feed), tender)
    assert payments.columns == contracts.PAYMENT_COLUMNS
    rows = payments.filter("Transaction_Nbr is not null").select("Tender", "Tender_Amt").collect()
    assert [tuple(r) for r in rows] == [("Card", 1100.0)] * 2


def test_feed_line(feed, items):
    lines = feed_flow.build_line(feed_flow.parse_lines(feed), items)
    assert lines.columns == contracts.LINE_COLUMNS
    first, second = as_dicts(lines.dropDuplicates().orderBy("ItmSeqNum"))
    assert lines.count() == 4
    assert (first["AX_Style_ID"], first["Demand_Net"], first["DiscountAmt"], first["GiftTax"]) == (" st ", 800.0, 106.0, 2.0)
    assert (second["AX_Style_ID"], second["Demand_Sales_Unit"], second["Demand_Net"], second["DiscountAmt"]) == (None, None, None, None)
    printed = render(lines, "feed", "line").filter("ItmSeqNum = 2").first()
    assert (printed.AX_Style_ID, printed.Shipment_Method, printed.Shipment_ID) == ("NULL", "NULL", 0)


def test_feed_cancel(feed, items):
    cancelled = feed_flow.build_cancel(feed_flow.parse_lines(feed), items)
    assert cancelled.columns == contracts.CANCEL_COLUMNS
    (row,) = as_dicts(render(cancelled, "feed", "cancel"))
    expected = {
        "Order_Total": "500.00", "Store": "56001", "Line": 1, "Status": "X", "Weborder_Id": "200", "Upc": "zz",
        "Status_Date": "2024-05-03 00:00:00", "Order_Demand_Amt": "440.00", "APAC_style": "NULL", "Line_Qty": "1.00",
        "Line_Sub_Total": "400.00", "Disc_Promo": None, "Tender_1": "77", "Tender_2": "NULL", "Jda_Order": -1,
    }
    assert {key: row[key] for key in expected} == expected


def test_feed_facts_land_once(spark, feed, tender, items):
    facts = feed_flow.feed_facts(feed, tender, items, work_folder(spark, "test"))
    assert {fact: df.count() for fact, df in facts.items()} == {"header": 3, "line": 4, "payment": 3, "cancel": 1}


def test_feed_needs_no_shuffle(spark, tmp_path, tender, items):
    (tmp_path / "feed.txt").write_text("\n".join(FEED))
    feed = spark.read.text(str(tmp_path))
    for df in [feed_flow.build_header(feed_flow.parse_orders(feed)), feed_flow.parse_lines(feed)]:
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    line = feed_flow.build_line(feed_flow.parse_lines(feed), items)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"(?:SortMerge|BroadcastHash)Join", line)) == 1
    # Routing tests the parsed record; it does not parse it a second time.
    assert line.count("regexp_replace(concat(&, value") == 2


FLAT = dict.fromkeys(contracts.FLAT_CANCEL_COLUMNS + contracts.FLAT_SALES_COLUMNS, "") | {
    "ORDER_DISP_NO": "ORDER1", "ORDER_H_ACCESS_BROWSER_KBN": "1", "KESSAI_ID": "5", "SEIKYU": "1100", "SHIRE_SUM": "900",
    "TEIKA_SUM": "800", "TEIKA_SUM_TAX": "80", "TAX": "100", "SORYO": "50", "SORYO_TAX": "5", "DAIBIKI": "30", "DAIBIKI_TAX": "3",
    "ORDER_D_FREE_ITEM31": "C", "ORDER_D_NO": "1", "ORDER_D_FREE_ITEM32": "b1", "ORDER_D_TEIKA": "400", "ORDER_D_SHIRE_PRICE": "450",
    "ORDER_D_QUANTITY": "2", "ORDER_D_FREE_ITEM35": "3", "FREE_ITEM33": "7", "COUPON_WARIBIKI": "15", "COUPON_ID": "c",
}


def flat(spark, schema, *changes):
    return spark.createDataFrame([tuple((FLAT | change)[f.name] for f in schema) for change in changes], schema)


def test_flat_sales(spark, tender, items):
    rows = flat(spark, contracts.FLAT_SALES, {"ORDER_DATE": "2024/05/01 9:5:3"}, {"ORDER_DATE": "bad", "DAIBIKI": ""})
    facts = flat_flow.sales_facts(rows, tender, items, work_folder(spark, "test"))
    header = {r.Order_Date: r for r in facts["header"].collect()}
    assert facts["header"].columns == contracts.HEADER_COLUMNS + contracts.HEADER_CHARGE_COLUMNS
    good, bad = header["2024-05-01 09:05:03"], header[None]
    assert (good.Demand_Net, good.Coupon_Amount, good.Discount_Amount, good.CoD_Charge) == (1000.0, 15.0, 103.0, 30.0)
    assert (bad.Demand_Net, bad.CoD_Charge) == (None, None)
    line = facts["line"].filter("Order_Date is not null").first()
    assert (line.Demand_Net, line.DiscountAmt, line.Gift_IND, line.GiftChrg) == (pytest.approx(495.0), 106.0, None, None)
    assert {r.Tender for r in facts["payment"].collect()} == {"Cash"}


def test_flat_cancel(spark, items):
    cancelled = {"ORDER_DATE": "5/1/2024 9:05", "CANCEL_DATE": "5/3/2024"}
    rows = flat(
        spark,
        contracts.FLAT_CANCEL,
        cancelled,
        cancelled | {"ORDER_D_NO": "2", "ORDER_D_FREE_ITEM32": ""},
        # Not cancelled: counts for the order total only.
        cancelled | {"ORDER_D_NO": "3", "CANCEL_DATE": ""},
        # A line number that is no number finds no line.
        cancelled | {"ORDER_DISP_NO": "e9", "ORDER_D_NO": "x"},
        # The same line twice gives every combination.
        cancelled | {"ORDER_DISP_NO": "e7"},
        cancelled | {"ORDER_DISP_NO": "e7"},
    )
    facts = flat_flow.cancel_facts(rows, items, work_folder(spark, "test"))["cancel"]
    printed = render(facts, "flat", "cancel")
    got = sorted(tuple(r) for r in printed.select(
        "Weborder_Id", F.coalesce("Line", F.lit(-1)), "Upc", "APAC_style", "Order_Demand_Amt", "Line_Qty", "Line_Sub_Total", "Disc_Promo"
    ).collect())
    twice = ("7", 1, "b1", "st", "1760.00", "2.00", "1760.00", "107.00")
    assert got == [
        ("1", 1, "b1", "st", "2640.00", "2.00", "1760.00", "107.00"),
        ("1", 2, "NULL", "NULL", "2640.00", "2.00", "1760.00", "107.00"),
        *[twice] * 4,
        ("9", -1, "NULL", "NULL", "880.00", "NULL", "NULL", "NULL"),
    ]
    unmatched = printed.filter("Weborder_Id = '9'").first()
    assert (unmatched.Status, unmatched.Status_Date, unmatched.Store) == (None, "2024-05-03 00:00:00", "57037")


def test_envelope_cancel(spark):
    values = dict.fromkeys(contracts.CANCEL_TEXT_FIELDS, "") | {
        "Transaction_Nbr": "T1", "Order_Date": "2024-05-01T10:00:00", "Status_Date": "2024-05-02 11:00:00",
        "Order_Total": "10.5", "Tender_1": "a", "Country_Code": "CN",
    }
    orders = spark.createDataFrame([tuple(values[n] for n in contracts.CANCEL_TEXT_FIELDS)], contracts.CANCEL_ENVELOPE["orders"].dataType.elementType)
    tender = spark.createDataFrame([("CN", "a", "Card")], contracts.TENDER_BY_COUNTRY)
    (row,) = as_dicts(render(envelope_flow.build_cancel(orders, tender), "envelope", "cancel"))
    assert (row["Order_Total"], row["Order_Demand_Amt"], row["Type"], row["Tender_1"]) == ("10.50", "NULL", "NULL", "Card")
    assert (row["Jda_Order"], row["Order_Entry_Method"], row["Status_Date"]) == ("-1", "Website", "2024-05-02 11:00:00")


def test_conformed(spark):
    tender = spark.createDataFrame([("CN", "a", "Card"), ("HK", "a", "HKCard")], contracts.TENDER_BY_COUNTRY)
    pay = spark.createDataFrame(
        [("07301", "1", "2024/5/1 9:5", "a", "", "CNY"), ("07308", "2", "2024/05/01 09:05", "a", "1.555", "HKD"), ("x", "3", "", "a", None, "")],
        contracts.CONFORMED_PAYMENT,
    )
    built = render(conformed_flow.build_payment(pay, tender), "conformed", "payment")
    assert sorted(tuple(r)[1:5] for r in built.collect()) == [
        ("1", "2024-05-01 09:05:00", "Card", "0.00"), ("2", "2024-05-01 09:05:00", "HKCard", "1.56"), ("3", None, None, "0.00"),
    ]


def test_rules_name_columns_of_their_fact():
    columns = {
        "header": contracts.HEADER_COLUMNS,
        "line": contracts.LINE_COLUMNS,
        "payment": contracts.PAYMENT_COLUMNS,
        "cancel": contracts.CANCEL_COLUMNS,
    }
    for rules in RULES.values():
        for fact, rule in rules.items():
            assert set(rule.money) | set(rule.null_text) <= set(columns[fact])
