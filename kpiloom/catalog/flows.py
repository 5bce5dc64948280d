"""The jobs: feeds derived from the tables, through the flow, to the four facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.catalog import derive as d
from kpiloom.catalog.registry import query
from kpiloom.operators.nested import explode_orders
from kpiloom.plans import conformed_flow, envelope_flow, feed_flow, flat_flow
from kpiloom.plans.render import render

# ------------------------------------------------------------- form feed

_FEED_TIME = d.sql_time("d")
_CANCEL_TIME = d.sql_time("d + INTERVAL 3 DAY")
_FIRST_TYPE = "LEFT JOIN l AS l1 ON l1.l_orderkey = k AND l1.n = 1"


@query(
    "feed_header",
    f"""
WITH {d.SQL_O}, {d.SQL_L}
SELECT {d.sql_store("l1.item_type")} AS eCom_Store_ID, txn AS Transaction_Nbr, {_FEED_TIME} AS Order_Date,
  'JP' AS Country, {d.SQL_DEVICE_4} AS Device_Type, 'NULL' AS Employee_Purchase, 'Website' AS Order_Channel,
  coalesce(member, 'NULL') AS Customer_ID, 'NULL' AS Ship_To, 'NULL' AS Bill_To,
  coupon_flag AS Promotion_Coupons, soryo_tax AS Freight_Tax,
  seikyu - tax - daibiki - soryo - coupon - free11 AS Demand_Net, 'NULL' AS Employee_ID,
  'JP' AS Bill_To_Country, soryo AS Freight_Amount,
  shire_sum - teika_sum + CASE WHEN l1.item_type = 'C' THEN free33 ELSE 0 END AS Discount_Amount,
  coupon AS Coupon_Amount, tax AS Tax
FROM o {_FIRST_TYPE} WHERE st <> 'P'
""",
)
def feed_header(spark, sf_dir):
    return render(feed_flow.build_header(feed_flow.parse_orders(d.form_feed(spark, sf_dir))), "feed", "header")


@query(
    "feed_payment",
    f"""
WITH {d.SQL_O}, {d.SQL_L}, {d.SQL_TENDER}
SELECT {d.sql_store("l1.item_type")} AS eCom_Store_ID, txn AS Transaction_Nbr, {_FEED_TIME} AS Order_Date,
  tender_type AS Tender, seikyu AS Tender_Amt, 'JPY' AS Demand_Currency
FROM o {_FIRST_TYPE} LEFT JOIN t ON kessai = tender_id WHERE st <> 'P'
""",
)
def feed_payment(spark, sf_dir):
    orders = feed_flow.parse_orders(d.form_feed(spark, sf_dir))
    return feed_flow.build_payment(orders, d.tender_map(spark, sf_dir))


_LINE_DISCOUNT = (
    "(l.price + 5 + CASE WHEN l.item_type = 'C' THEN l.free35 ELSE 0 END - l.price) * l.quantity"
)


@query(
    "feed_line",
    f"""
WITH {d.SQL_O}, {d.SQL_L}, {d.SQL_ITEM}
SELECT {d.sql_store("l1.item_type")} AS eCom_Store_ID, txn AS Transaction_Nbr, {_FEED_TIME} AS Order_Date,
  coalesce(style, 'NULL') AS AX_Style_ID, coalesce(color, 'NULL') AS AX_Color_ID,
  coalesce(size, 'NULL') AS AX_Size_ID, l.price * l.quantity AS Demand_Net, l.quantity AS Demand_Sales_Unit,
  0 AS Shipment_ID, 'NULL' AS Shipment_Method, 'JP' AS Ship_To_Country, 0 AS Gift_IND, 'N' AS Non_Merch_Item,
  free11 AS GiftChrg, free11 * 0.1::DOUBLE AS GiftTax, l.n AS ItmSeqNum, {_LINE_DISCOUNT} AS DiscountAmt
FROM o JOIN l ON l.l_orderkey = k {_FIRST_TYPE} LEFT JOIN i ON l.barcode = bc WHERE st <> 'P'
""",
)
def feed_line(spark, sf_dir):
    lines = feed_flow.parse_lines(d.form_feed(spark, sf_dir))
    return render(feed_flow.build_line(lines, d.item_map(spark, sf_dir)), "feed", "line")


_CANCEL_TAIL = """
  {tender_1} AS Tender_1, 'NULL' AS Tender_2, 'NULL' AS Tender_3, 'NULL' AS Customer_Ip_Add,
  'Website' AS Order_Entry_Method, 'NULL' AS Csr_Associate_Name, 'JP' AS Country_Code,
  {store} AS Demand_Location, 'NULL' AS Fulfilling_Location, -1 AS Original_Jda_Order,
  'NULL' AS Warehouse_Reason_Code, 'NULL' AS Warehouse_Reason, 'NULL' AS Customer_Reason_Code,
  'NULL' AS Customer_Reason, 'JPY' AS Currency, 'JP' AS Webstore
"""


@query(
    "feed_cancel",
    f"""
WITH {d.SQL_O}, {d.SQL_L}, {d.SQL_ITEM}
SELECT {_FEED_TIME} AS Order_Date, printf('%.2f', seikyu) AS Order_Total,
  {d.sql_store("l1.item_type")} AS Store, 'NULL' AS Empl_Id, -1 AS Jda_Order, l.n AS Line, 'X' AS Status,
  'Cancelled' AS Status_Text, 'NULL' AS Type, txn AS Weborder_Id, {_CANCEL_TIME} AS Status_Date,
  printf('%.2f', teika_sum + teika_sum_tax) AS Order_Demand_Amt, l.barcode AS Upc,
  coalesce(style, 'NULL') AS APAC_style, coalesce(color, 'NULL') AS APAC_colour,
  coalesce(size, 'NULL') AS APAC_size, printf('%.2f', l.quantity) AS Line_Qty,
  printf('%.2f', l.price * l.quantity) AS Line_Sub_Total, {_LINE_DISCOUNT} AS Disc_Promo,
  {_CANCEL_TAIL.format(tender_1="kessai", store=d.sql_store("l1.item_type"))}
FROM o JOIN l ON l.l_orderkey = k {_FIRST_TYPE} LEFT JOIN i ON l.barcode = bc WHERE st = 'P'
""",
)
def feed_cancel(spark, sf_dir):
    lines = feed_flow.parse_lines(d.form_feed(spark, sf_dir))
    return render(feed_flow.build_cancel(lines, d.item_map(spark, sf_dir)), "feed", "cancel")


# -------------------------------------------------- form vendor, recovery

_SALES_TIME = d.sql_time("d + to_hours(k % 24) + to_minutes(k % 60) + to_seconds(k % 50)")
_CANCELLED_ORDER_TIME = d.sql_time("d + to_hours(k % 24) + to_minutes(k % 60)")
_FLAT_KEYS = f"{d.sql_store('l.item_type')} AS eCom_Store_ID, txn AS Transaction_Nbr, {_SALES_TIME} AS Order_Date"


@query(
    "rec2_header",
    f"""
WITH {d.SQL_O}, {d.SQL_L}
SELECT {_FLAT_KEYS}, 'JP' AS Country, {d.SQL_DEVICE_4} AS Device_Type, NULL::VARCHAR AS Employee_Purchase,
  'Website' AS Order_Channel, member AS Customer_ID, NULL::VARCHAR AS Ship_To, NULL::VARCHAR AS Bill_To,
  coupon_flag AS Promotion_Coupons, soryo_tax AS Freight_Tax, seikyu - tax - daibiki + daibiki AS Demand_Net,
  NULL::VARCHAR AS Employee_ID, 'JP' AS Bill_To_Country, soryo AS Freight_Amount,
  shire_sum - teika_sum + CASE WHEN l.item_type = 'C' THEN l.free35 ELSE 0 END AS Discount_Amount,
  coupon AS Coupon_Amount, tax AS Tax, daibiki AS CoD_Charge, daibiki_tax AS CoD_Charge_Tax,
  soryo AS Shipping_Fee, soryo_tax AS Shipping_Fee_Tax, seikyu AS Line_Total
FROM o JOIN l ON l_orderkey = k
""",
)
def rec2_header(spark, sf_dir):
    return render(flat_flow.build_header(d.flat_rows(spark, sf_dir, cancel=False)), "flat", "header")


@query(
    "rec2_payment",
    f"""
WITH {d.SQL_O}, {d.SQL_L}, {d.SQL_TENDER}
SELECT {_FLAT_KEYS}, tender_type AS Tender, seikyu AS Tender_Amt, 'JPY' AS Demand_Currency
FROM o JOIN l ON l_orderkey = k LEFT JOIN t ON kessai = tender_id
""",
)
def rec2_payment(spark, sf_dir):
    return flat_flow.build_payment(d.flat_rows(spark, sf_dir, cancel=False), d.tender_map(spark, sf_dir))


@query(
    "rec2_line",
    f"""
WITH {d.SQL_O}, {d.SQL_L}, {d.SQL_ITEM}
SELECT {_FLAT_KEYS}, style AS AX_Style_ID, color AS AX_Color_ID, size AS AX_Size_ID,
  (price + 5) * 1.1::DOUBLE AS Demand_Net, CAST(quantity AS INTEGER) AS Demand_Sales_Unit, slip AS Shipment_ID,
  NULL::VARCHAR AS Shipment_Method, 'JP' AS Ship_To_Country, NULL::VARCHAR AS Gift_IND, 'N' AS Non_Merch_Item,
  NULL::DOUBLE AS GiftChrg, NULL::DOUBLE AS GiftTax, n AS ItmSeqNum, {_LINE_DISCOUNT} AS DiscountAmt
FROM o JOIN l ON l_orderkey = k LEFT JOIN i ON barcode = bc
""",
)
def rec2_line(spark, sf_dir):
    return render(
        flat_flow.build_line(d.flat_rows(spark, sf_dir, cancel=False), d.item_map(spark, sf_dir)), "flat", "line"
    )


@query(
    "rec2_cancel",
    f"""
WITH {d.SQL_O}, {d.SQL_L}, {d.SQL_ITEM},
w AS (SELECT l_orderkey, count(*) AS rows_of_order FROM l GROUP BY l_orderkey)
SELECT {_CANCELLED_ORDER_TIME} AS Order_Date, printf('%.2f', seikyu) AS Order_Total,
  {d.sql_store("l.item_type")} AS Store, 'NULL' AS Empl_Id, -1 AS Jda_Order, l.n AS Line, 'X' AS Status,
  'Cancelled' AS Status_Text, 'NULL' AS Type, txn AS Weborder_Id, {_CANCEL_TIME} AS Status_Date,
  printf('%.2f', (teika_sum + teika_sum_tax) * rows_of_order) AS Order_Demand_Amt,
  coalesce(l.barcode, 'NULL') AS Upc, coalesce(style, 'NULL') AS APAC_style,
  coalesce(color, 'NULL') AS APAC_colour, coalesce(size, 'NULL') AS APAC_size,
  printf('%.2f', floor(l.quantity)) AS Line_Qty,
  printf('%.2f', (teika_sum + teika_sum_tax) * floor(l.quantity)) AS Line_Sub_Total,
  printf('%.2f', shire_sum + CASE WHEN l.item_type = 'C' THEN free33 ELSE 0 END - teika_sum) AS Disc_Promo,
  {_CANCEL_TAIL.format(tender_1="kessai", store=d.sql_store("l.item_type"))}
FROM o JOIN l ON l.l_orderkey = k JOIN w ON w.l_orderkey = k LEFT JOIN i ON l.barcode = bc WHERE st = 'P'
""",
)
def rec2_cancel(spark, sf_dir):
    rows = d.flat_rows(spark, sf_dir, cancel=True)
    return render(flat_flow.build_cancel(rows, d.item_map(spark, sf_dir)), "flat", "cancel")


# --------------------------------------------------------- JSON envelopes

_E = """
e AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderdate AS d, o_totalprice AS total,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS device, '0730' || (1 + o_custkey % 8) AS store,
    'T' || o_orderkey AS txn, CASE WHEN o_custkey % 2 = 0 THEN 'CN' ELSE 'HK' END AS country
  FROM orders)
"""
_T3 = """
t AS (SELECT CASE WHEN n_regionkey % 2 = 0 THEN 'CN' ELSE 'HK' END AS tender_country,
        CAST(n_nationkey AS VARCHAR) AS tender_id, n_name AS tender_type FROM nation)
"""


@query(
    "json_header",
    f"""
WITH {_E}
SELECT store AS eCom_Store_ID, txn AS Transaction_Nbr, {d.sql_time("d")} AS Order_Date, country AS Country,
  CASE WHEN k % 13 = 0 THEN NULL WHEN device = 1 THEN 'Desktop' WHEN device = 2 THEN 'Mobile Phone'
    ELSE CAST(device AS VARCHAR) END AS Device_Type,
  CASE WHEN c % 5 = 0 THEN 'Y' ELSE 'N' END AS Employee_Purchase, 'Website' AS Order_Channel, -1 AS Customer_ID,
  'S' || c AS Ship_To, 'B' || c AS Bill_To, 'NULL' AS Promotion_Coupons,
  printf('%.2f', (k % 70)::DOUBLE) AS Freight_Tax, printf('%.2f', total) AS Demand_Net,
  CASE WHEN c % 5 = 0 THEN 'E' || c ELSE 'NULL' END AS Employee_ID, country AS Bill_To_Country,
  printf('%.2f', (k % 700)::DOUBLE) AS Freight_Amount, printf('%.2f', floor(total / 20)) AS Discount_Amount,
  CASE WHEN c % 30 = 0 THEN 'NULL' ELSE printf('%.2f', (c % 30)::DOUBLE) END AS Coupon_Amount,
  printf('%.2f', floor(total / 10)) AS Tax
FROM e
""",
)
def json_header(spark, sf_dir):
    orders = explode_orders(d.sales_envelopes(spark, sf_dir))
    return render(envelope_flow.build_header(orders), "envelope", "header")


@query(
    "json_line",
    f"""
WITH {_E}, {d.SQL_L}
SELECT store AS eCom_Store_ID, txn AS Transaction_Nbr, {d.sql_time("d")} AS Order_Date,
  'BC' || partkey AS AX_Style_ID, 'c' || (partkey % 7) AS AX_Color_ID, 's' || (partkey % 5) AS AX_Size_ID,
  price AS Demand_Net, CAST(floor(quantity) AS INTEGER) AS Demand_Sales_Unit, 'SH' || k AS Shipment_ID,
  'NULL' AS Shipment_Method, country AS Ship_To_Country, CASE WHEN returnflag = 'N' THEN 0 ELSE 1 END AS Gift_IND,
  'N' AS Non_Merch_Item, '0' AS GiftChrg, '0' AS GiftTax, CAST(n AS VARCHAR) AS ItmSeqNum,
  printf('%.2f', floor(price / 50)) AS DiscountAmt
FROM e JOIN l ON l_orderkey = k
""",
)
def json_line(spark, sf_dir):
    orders = explode_orders(d.sales_envelopes(spark, sf_dir))
    return render(envelope_flow.build_line(orders), "envelope", "line")


@query(
    "json_payment",
    f"""
WITH {_E}, {_T3},
p AS (
  SELECT store, txn, d, country, CAST(c % 30 AS VARCHAR) AS tender, CASE WHEN k % 7 = 0 THEN 0 ELSE total END AS amt FROM e
  UNION ALL
  SELECT store, txn, d, country, CAST(k % 30 AS VARCHAR), 5 FROM e WHERE c % 3 = 0)
SELECT store AS eCom_Store_ID, txn AS Transaction_Nbr, {d.sql_time("d")} AS Order_Date,
  coalesce(tender_type, 'OTHER') AS Tender, amt AS Tender_Amt, 'CNY' AS Demand_Currency
FROM p LEFT JOIN t ON country = tender_country AND tender = tender_id
""",
)
def json_payment(spark, sf_dir):
    orders = explode_orders(d.sales_envelopes(spark, sf_dir))
    return envelope_flow.build_payment(orders, d.tender_map_by_country(spark, sf_dir))


@query(
    "json_cancel",
    f"""
WITH {_E}, {_T3}, {d.SQL_L}
SELECT {d.sql_time("d")} AS Order_Date, printf('%.2f', total) AS Order_Total, store AS Store, 'NULL' AS Empl_Id,
  '-1' AS Jda_Order, CAST(n AS VARCHAR) AS Line, 'X' AS Status, 'Cancelled' AS Status_Text,
  CASE WHEN returnflag = 'R' THEN 'ret' ELSE 'NULL' END AS Type, txn AS Weborder_Id,
  {d.sql_time("d + INTERVAL 3 DAY")} AS Status_Date, printf('%.2f', floor(total / 2)) AS Order_Demand_Amt,
  CASE WHEN partkey % 17 = 0 THEN 'NULL' ELSE 'BC' || partkey END AS Upc, 'st' || (partkey % 11) AS APAC_style,
  'c' || (partkey % 7) AS APAC_colour, 's' || (partkey % 5) AS APAC_size, printf('%.2f', quantity) AS Line_Qty,
  printf('%.2f', price) AS Line_Sub_Total, '0' AS Disc_Promo, coalesce(tender_type, 'OTHER') AS Tender_1,
  'NULL' AS Tender_2, 'NULL' AS Tender_3, 'NULL' AS Customer_Ip_Add, 'Website' AS Order_Entry_Method,
  'NULL' AS Csr_Associate_Name, country AS Country_Code, store AS Demand_Location, 'NULL' AS Fulfilling_Location,
  '-1' AS Original_Jda_Order, CASE WHEN partkey % 2 = 0 THEN 'NULL' ELSE 'W1' END AS Warehouse_Reason_Code,
  CASE WHEN partkey % 2 = 0 THEN 'NULL' ELSE 'stock' END AS Warehouse_Reason,
  CASE WHEN partkey % 2 = 0 THEN 'C1' ELSE 'NULL' END AS Customer_Reason_Code,
  CASE WHEN partkey % 2 = 0 THEN 'size' ELSE 'NULL' END AS Customer_Reason,
  CASE WHEN c % 2 = 0 THEN 'CNY' ELSE 'NULL' END AS Currency, 'web' AS Webstore
FROM e JOIN l ON l_orderkey = k LEFT JOIN t ON country = tender_country AND CAST(c % 30 AS VARCHAR) = tender_id
WHERE st = 'P'
""",
)
def json_cancel(spark, sf_dir):
    orders = explode_orders(d.cancel_envelopes(spark, sf_dir))
    cancelled = envelope_flow.build_cancel(orders, d.tender_map_by_country(spark, sf_dir))
    return render(cancelled, "envelope", "cancel")


@query(
    "envelope_day",
    "SELECT CAST(min(o_orderdate) AS DATE) AS sales_day, "
    "CAST(min(CASE WHEN o_orderstatus = 'P' AND o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN o_orderdate END) "
    "+ INTERVAL 3 DAY AS DATE) AS cancel_day, DATE '2024-05-01' AS file_day FROM orders",
)
def envelope_day(spark, sf_dir):
    sales = d.sales_envelopes(spark, sf_dir)
    days = {
        "sales_day": envelope_flow.business_days(sales),
        "cancel_day": envelope_flow.business_days(d.cancel_envelopes(spark, sf_dir), "Status_Date"),
        "file_day": envelope_flow.business_days(sales.withColumn("orders", F.filter("orders", lambda _: F.lit(False)))),
    }
    each = [df.select(F.lit(name).alias("name"), "d") for name, df in days.items()]
    rows = each[0].unionByName(each[1]).unionByName(each[2])
    return rows.agg(*[F.max(F.when(F.col("name") == name, F.col("d"))).alias(name) for name in days])


# ---------------------------------------------- envelope vendor, recovery


@query(
    "rec1_header",
    f"""
WITH {_E}
SELECT store AS eCom_Store_ID, txn AS Transaction_Nbr, {d.SQL_CONFORMED_TIME} AS Order_Date, country AS Country,
  CASE device WHEN 1 THEN 'Desktop' WHEN 2 THEN 'Mobile Phone' END AS Device_Type,
  CASE WHEN c % 5 = 0 THEN 'Y' ELSE 'N' END AS Employee_Purchase, 'Website' AS Order_Channel, -1 AS Customer_ID,
  'S' || c AS Ship_To, 'B' || c AS Bill_To, 'NULL' AS Promotion_Coupons, (k % 70) || '.00' AS Freight_Tax,
  CAST(CAST(total AS DECIMAL(38,2)) AS VARCHAR) AS Demand_Net, 'NULL' AS Employee_ID, country AS Bill_To_Country,
  (k % 700) || '.00' AS Freight_Amount, CAST(floor(total / 20) AS BIGINT) || '.00' AS Discount_Amount,
  (c % 30) || '.00' AS Coupon_Amount, CAST(floor(total / 10) AS BIGINT) || '.00' AS Tax
FROM e
""",
)
def rec1_header(spark, sf_dir):
    return render(conformed_flow.build_header(d.conformed_header(spark, sf_dir)), "conformed", "header")


@query(
    "rec1_line",
    f"""
WITH {_E}, {d.SQL_L}
SELECT store AS eCom_Store_ID, txn AS Transaction_Nbr, {d.SQL_CONFORMED_TIME} AS Order_Date,
  'BC' || partkey AS AX_Style_ID, 'c' || (partkey % 7) AS AX_Color_ID, 's' || (partkey % 5) AS AX_Size_ID,
  CAST(price AS DECIMAL(38,2))::DOUBLE AS Demand_Net, CAST(CAST(floor(quantity) AS INTEGER) AS VARCHAR) AS Demand_Sales_Unit,
  '0' AS Shipment_ID, 'air' AS Shipment_Method, country AS Ship_To_Country, '0' AS Gift_IND, 'N' AS Non_Merch_Item,
  '0' AS GiftChrg, '0' AS GiftTax, CAST(n AS VARCHAR) AS ItmSeqNum,
  CAST(floor(price / 50) AS BIGINT) || '.00' AS DiscountAmt
FROM e JOIN l ON l_orderkey = k
""",
)
def rec1_line(spark, sf_dir):
    built = render(conformed_flow.build_line(d.conformed_line(spark, sf_dir)), "conformed", "line")
    # The net amount is text here and printed differently by each engine: compare its value.
    return built.withColumn("Demand_Net", built["Demand_Net"].cast("double"))


@query(
    "rec1_payment",
    f"""
WITH {_E}, {_T3}
SELECT store AS eCom_Store_ID, txn AS Transaction_Nbr, {d.SQL_CONFORMED_TIME} AS Order_Date, tender_type AS Tender,
  CASE WHEN k % 7 < 2 THEN '0.00' ELSE CAST(CAST(total AS DECIMAL(38,2)) AS VARCHAR) END AS Tender_Amt,
  'CNY' AS Demand_Currency
FROM e LEFT JOIN t
  ON CASE WHEN store IN ('07301', '07302', '07304') THEN 'CN' WHEN store = '07308' THEN 'HK' END = tender_country
  AND CAST(c % 30 AS VARCHAR) = tender_id
""",
)
def rec1_payment(spark, sf_dir):
    rows = d.conformed_payment(spark, sf_dir)
    return render(
        conformed_flow.build_payment(rows, d.tender_map_by_country(spark, sf_dir)), "conformed", "payment"
    )


@query(
    "rec1_cancel",
    f"""
WITH {_E}, {_T3}, {d.SQL_L}
SELECT {d.SQL_CONFORMED_TIME} AS Order_Date, CAST(CAST(total AS DECIMAL(38,2)) AS VARCHAR) AS Order_Total,
  store AS Store, 'NULL' AS Empl_Id, -1 AS Jda_Order, CAST(n AS VARCHAR) AS Line, 'X' AS Status,
  'Cancelled' AS Status_Text, 'NULL' AS Type, txn AS Weborder_Id, {d.sql_time("d + INTERVAL 3 DAY")} AS Status_Date,
  CAST(floor(total / 2) AS BIGINT) || '.00' AS Order_Demand_Amt, 'NULL' AS Upc, 'st' || (partkey % 11) AS APAC_style,
  'c' || (partkey % 7) AS APAC_colour, 's' || (partkey % 5) AS APAC_size,
  CAST(CAST(floor(quantity) AS INTEGER) AS VARCHAR) AS Line_Qty,
  CAST(CAST(price AS DECIMAL(38,2)) AS VARCHAR) AS Line_Sub_Total, '0' AS Disc_Promo, tender_type AS Tender_1,
  'NULL' AS Tender_2, 'NULL' AS Tender_3, 'NULL' AS Customer_Ip_Add, 'Website' AS Order_Entry_Method,
  'NULL' AS Csr_Associate_Name, country AS Country_Code, store AS Demand_Location, 'NULL' AS Fulfilling_Location,
  -1 AS Original_Jda_Order, CASE WHEN partkey % 2 = 0 THEN 'NULL' ELSE 'W1' END AS Warehouse_Reason_Code,
  CASE WHEN partkey % 2 = 0 THEN '' ELSE 'stock' END AS Warehouse_Reason,
  CASE WHEN partkey % 2 = 0 THEN 'C1' ELSE '' END AS Customer_Reason_Code,
  CASE WHEN partkey % 2 = 0 THEN 'size' ELSE '' END AS Customer_Reason,
  CASE WHEN c % 2 = 0 THEN 'CNY' ELSE 'NULL' END AS Currency, 'web' AS Webstore
FROM e JOIN l ON l_orderkey = k LEFT JOIN t ON country = tender_country AND CAST(c % 30 AS VARCHAR) = tender_id
WHERE st = 'P'
""",
)
def rec1_cancel(spark, sf_dir):
    rows = d.conformed_cancel(spark, sf_dir)
    return render(conformed_flow.build_cancel(rows, d.tender_map_by_country(spark, sf_dir)), "conformed", "cancel")
