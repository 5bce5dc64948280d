"""Explodes, pivots, joins, aggregates, routing and quality over whole tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from kpiloom import contracts
from kpiloom.catalog import derive as d
from kpiloom.catalog.registry import query, table
from kpiloom.functions import codes, dates, text
from kpiloom.operators import entries, joins, nested, quality, relational
from kpiloom.plans import feed_flow
from kpiloom.plans.wide import FEED, wide_header
from kpiloom.sources import pages
from kpiloom.sources.readers import SOURCE_FILE, has_rows

# -------------------------------------------------------------- explodes


@query("explode_orders", "SELECT 'T' || o_orderkey AS txn, o_custkey::VARCHAR AS customer FROM orders")
def explode_orders(spark, sf_dir):
    orders = nested.explode_orders(d.sales_envelopes(spark, sf_dir))
    return orders.select(F.col("Transaction_Nbr").alias("txn"), F.col("Customer_ID").alias("customer"))


@query(
    "explode_lines",
    f"WITH {d.SQL_L} SELECT 'T' || l_orderkey AS txn, n::VARCHAR AS line, 'BC' || partkey AS style "
    "FROM l JOIN orders ON o_orderkey = l_orderkey",
)
def explode_lines(spark, sf_dir):
    lines = nested.explode_lines(nested.explode_orders(d.sales_envelopes(spark, sf_dir)))
    return lines.select(
        F.col("Transaction_Nbr").alias("txn"), F.col("Item_Seq_Number").alias("line"), F.col("AX_Style_ID").alias("style")
    )


@query(
    "explode_payments",
    """
SELECT CASE WHEN o_custkey % 2 = 0 THEN 'CN' ELSE 'HK' END AS country, 'T' || o_orderkey AS txn,
  (o_custkey % 30)::VARCHAR AS tender FROM orders
UNION ALL
SELECT CASE WHEN o_custkey % 2 = 0 THEN 'CN' ELSE 'HK' END, 'T' || o_orderkey, (o_orderkey % 30)::VARCHAR
FROM orders WHERE o_custkey % 3 = 0
""",
)
def explode_payments(spark, sf_dir):
    payments = nested.explode_payments(nested.explode_orders(d.sales_envelopes(spark, sf_dir)))
    return payments.select(
        F.col("Country").alias("country"), F.col("Transaction_Nbr").alias("txn"), F.col("Tender").alias("tender")
    )


# ---------------------------------------------------------------- pivots


def _record_entries(spark, sf_dir):
    records = d.form_feed(spark, sf_dir).withColumnRenamed("o_orderkey", entries.RECORD_ID)
    return entries.record_entries(records)


_HEADER_SQL = f"""
WITH {d.SQL_O}
SELECT k AS record_id, CASE WHEN k % 2 = 0 THEN 'ORDER' ELSE 'e' END || k AS ORDER_DISP_NO, kessai AS KESSAI_ID,
  strftime(d, '%Y/%m/%d') AS ORDER_DATE, CASE WHEN st = 'P' THEN strftime(d + INTERVAL 3 DAY, '%Y/%m/%d') ELSE '' END AS CANCEL_DATE,
  CASE WHEN coupon = 0 THEN '' ELSE 'CP&' || CAST(coupon AS INTEGER) END AS COUPON_ID,
  coalesce(slip, '') AS SHIP_SLIP_NO, 'no line' AS FREE_ITEM1, NULL::VARCHAR AS ZIP
FROM o
"""
_HEADER_OUT = [
    "ORDER_DISP_NO", "KESSAI_ID", "ORDER_DATE", "CANCEL_DATE", "COUPON_ID", "SHIP_SLIP_NO", "FREE_ITEM1", "ZIP",
]


@query("header_pivot", _HEADER_SQL)
def header_pivot(spark, sf_dir):
    wide = entries.pivot_header(_record_entries(spark, sf_dir), contracts.FEED_HEADER_NAMES)
    return wide.select("record_id", *_HEADER_OUT)


@query("header_in_place", _HEADER_SQL)
def header_in_place(spark, sf_dir):
    fields = entries.with_fields(d.form_feed(spark, sf_dir))
    return fields.select(F.col("o_orderkey").alias("record_id"), *[entries.field(n).alias(n) for n in _HEADER_OUT])


_LINES_SQL = f"""
WITH {d.SQL_L}
SELECT l_orderkey AS record_id, n::VARCHAR AS sequence, n::VARCHAR AS ORDER_D_NO, coalesce(item_type, '') AS ORDER_D_FREE_ITEM31,
  coalesce(barcode, '') AS ORDER_D_FREE_ITEM32, (n * 10)::VARCHAR AS ORDER_D_FREE_ITEM35, NULL::VARCHAR AS ITEM_NAME,
  quantity AS QUANTITY, price AS TEIKA
FROM l JOIN orders ON o_orderkey = l_orderkey
"""
_LINES_OUT = ["ORDER_D_NO", "ORDER_D_FREE_ITEM31", "ORDER_D_FREE_ITEM32", "ORDER_D_FREE_ITEM35", "ITEM_NAME"]


def _line_columns(column):
    return [
        *[column(n).alias(n) for n in _LINES_OUT],
        *[text.to_double(column(n)).alias(n) for n in ["QUANTITY", "TEIKA"]],
    ]


@query("line_pivot", _LINES_SQL)
def line_pivot(spark, sf_dir):
    wide = entries.pivot_lines(_record_entries(spark, sf_dir), contracts.FEED_LINE_NAMES)
    return wide.select("record_id", "sequence", *_line_columns(F.col))


@query("line_cond_agg", _LINES_SQL)
def line_cond_agg(spark, sf_dir):
    wide = entries.pivot_lines_conditional(_record_entries(spark, sf_dir), contracts.FEED_LINE_NAMES)
    return wide.select("record_id", "sequence", *_line_columns(F.col))


@query("line_in_place", _LINES_SQL)
def line_in_place(spark, sf_dir):
    fields = entries.with_fields(d.form_feed(spark, sf_dir), items=True).withColumnRenamed("o_orderkey", "record_id")
    return entries.explode_items(fields, ["record_id"]).select(
        "record_id", "sequence", *_line_columns(entries.item_field)
    )


@query(
    "record_id",
    "SELECT count(*) AS records, count(DISTINCT o_custkey) AS contents FROM orders",
)
def record_id(spark, sf_dir):
    """Lines repeated once per order of a customer get as many ids, all different."""
    feed = table(spark, sf_dir, "orders").select(F.concat(F.lit("MEMBER_ID="), F.col("o_custkey")).alias("value"))
    ids = entries.with_record_id(feed)
    # Dealt by id first: combining ids where they are read would sort a whole split of the file, and finds no two alike.
    per_id = ids.repartition(entries.RECORD_ID).groupBy(entries.RECORD_ID).agg(F.first("value").alias("value"))
    per_content = per_id.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return per_content.agg(F.sum("n").alias("records"), F.count(F.lit(1)).alias("contents"))


# ----------------------------------------------------------------- joins


@query(
    "tender_join1",
    f"WITH {d.SQL_O}, {d.SQL_TENDER} SELECT k AS o_orderkey, kessai AS tender, tender_type AS label "
    "FROM o LEFT JOIN t ON kessai = tender_id",
)
def tender_join1(spark, sf_dir):
    joined = joins.join_tender(d.raw_orders(spark, sf_dir), d.tender_map(spark, sf_dir), {"KESSAI_ID": "TenderID"})
    return joined.select("o_orderkey", F.col("KESSAI_ID").alias("tender"), F.col("TenderType").alias("label"))


_T3 = (
    "t AS (SELECT CASE WHEN n_regionkey % 2 = 0 THEN 'CN' ELSE 'HK' END AS tender_country, "
    "CAST(n_nationkey AS VARCHAR) AS tender_id, n_name AS tender_type FROM nation)"
)


def _by_country(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("if(o_custkey % 2 = 0, 'CN', 'HK')").alias("country"),
        F.expr("cast(o_custkey % 30 as string)").alias("tender"),
    )


_JOIN2_SQL = f"""
WITH {_T3}, f AS (SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 'CN' ELSE 'HK' END AS country,
  (o_custkey % 30)::VARCHAR AS tender FROM orders)
SELECT o_orderkey, country, tender, {{label}} AS label
FROM f LEFT JOIN t ON country = tender_country AND tender = tender_id
"""


@query("tender_join2", _JOIN2_SQL.format(label="tender_type"))
def tender_join2(spark, sf_dir):
    on = {"country": "Country", "tender": "TenderID"}
    joined = joins.join_tender(_by_country(spark, sf_dir), d.tender_map_by_country(spark, sf_dir), on)
    return joined.withColumnRenamed("TenderType", "label")


@query("tender_policy", _JOIN2_SQL.format(label="coalesce(tender_type, 'OTHER')"))
def tender_policy(spark, sf_dir):
    on = {"country": "Country", "tender": "TenderID"}
    joined = joins.join_tender(_by_country(spark, sf_dir), d.tender_map_by_country(spark, sf_dir), on, policy="other")
    return joined.withColumnRenamed("TenderType", "label")


def _line_frames(spark, sf_dir):
    lines = d.raw_lines(spark, sf_dir).withColumnRenamed("l_orderkey", "record")
    header = d.raw_orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("record"),
        F.col("o_orderstatus").alias("status"),
        F.col("KESSAI_ID").alias("tender"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")).alias("Cancel_Date"),
    )
    return lines, header


_INNER_SQL = f"""
WITH {d.SQL_O}, {d.SQL_L}
SELECT k AS record, n AS l_linenumber, st AS status, kessai AS tender FROM o JOIN l ON l_orderkey = k WHERE st {{test}} 'P'
"""


@query("line_header_inner", _INNER_SQL.format(test="<>"))
def line_header_inner(spark, sf_dir):
    lines, header = _line_frames(spark, sf_dir)
    demand = relational.split_cancelled(header)[0]
    joined = joins.lines_with_header(lines, demand, "record", ["status", "tender"])
    return joined.select("record", "l_linenumber", "status", "tender")


@query("cancel_line_inner", _INNER_SQL.format(test="="))
def cancel_line_inner(spark, sf_dir):
    lines, header = _line_frames(spark, sf_dir)
    cancelled = relational.split_cancelled(header)[1]
    joined = joins.lines_with_header(lines, cancelled, "record", ["status", "tender"])
    return joined.select("record", "l_linenumber", "status", "tender")


@query(
    "item_left",
    f"WITH {d.SQL_L}, {d.SQL_ITEM} SELECT l_orderkey, n AS line, barcode, trim(style) AS style, color, size "
    "FROM l LEFT JOIN i ON barcode = bc",
)
def item_left(spark, sf_dir):
    lines = d.raw_lines(spark, sf_dir).select(
        "l_orderkey",
        F.col("l_linenumber").alias("line"),
        text.blank_to_null(F.col("ORDER_D_FREE_ITEM32")).alias("Barcode"),
    )
    padded = d.item_map(spark, sf_dir).withColumn("Style", F.concat(F.col("Style"), F.lit("  ")))
    joined = joins.with_item(lines, padded, trim=True)
    return joined.withColumnsRenamed({"Barcode": "barcode", "Style": "style", "Color": "color", "Size": "size"})


@query(
    "cancel_line_left3",
    f"""
WITH {d.SQL_O}, {d.SQL_L},
h AS (SELECT txn, {d.sql_store("item_type")} AS store, CASE WHEN n = 7 THEN NULL ELSE n END AS line_no FROM o JOIN l ON l_orderkey = k),
m AS (SELECT txn, {d.sql_store("item_type")} AS store, n, barcode FROM o JOIN l ON l_orderkey = k)
SELECT h.txn, h.store, line_no, m.barcode FROM h LEFT JOIN m ON h.txn = m.txn AND h.store = m.store AND line_no = m.n
""",
)
def cancel_line_left3(spark, sf_dir):
    rows = d.flat_rows(spark, sf_dir, cancel=False).select(
        text.strip_order_prefix(F.col("ORDER_DISP_NO")).alias("Transaction_Nbr"),
        codes.store_from_type(F.col("ORDER_D_FREE_ITEM31")).alias("eCom_Store_ID"),
        "ORDER_D_NO",
        text.blank_to_null(F.col("ORDER_D_FREE_ITEM32")).alias("Barcode"),
    )
    lines = rows.withColumn("Item_Seq_Number", text.to_int(F.col("ORDER_D_NO")))
    # A line number that is no number matches nothing.
    header = rows.drop("Barcode").withColumn("ORDER_D_NO", F.regexp_replace("ORDER_D_NO", "7", "seven"))
    matched = joins.cancel_match(header, lines, ["Barcode"])
    return matched.select(
        F.col("Transaction_Nbr").alias("txn"),
        F.col("eCom_Store_ID").alias("store"),
        text.to_int(F.col("ORDER_D_NO")).alias("line_no"),
        F.col("Barcode").alias("barcode"),
    )


@query(
    "anti_new",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderkey END AS key FROM orders "
    "WHERE o_orderstatus = 'F' OR o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)",
)
def anti_new(spark, sf_dir):
    key = F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("key")
    batch = table(spark, sf_dir, "orders").select("o_orderkey", key)
    history = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"))
    return joins.not_in_history(batch, history, ["key"]).select("o_orderkey", "key")


# ------------------------------------------------- aggregates and filters


@query(
    "order_total_window",
    f"""
WITH {d.SQL_L}
SELECT l_orderkey, n AS line, round(sum(price * quantity) OVER (PARTITION BY l_orderkey), 2) AS order_total FROM l
""",
)
def order_total_window(spark, sf_dir):
    lines = d.lines(spark, sf_dir)
    amount = F.col("price") * F.col("quantity")
    totalled = relational.order_total(lines, "l_orderkey", amount, "order_total")
    return totalled.select(
        "l_orderkey", F.col("l_linenumber").alias("line"), F.round("order_total", 2).alias("order_total")
    )


@query(
    "business_date",
    "SELECT o_orderstatus, CAST(min(o_orderdate) AS DATE) AS business_date FROM orders GROUP BY o_orderstatus",
)
def business_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("t", F.date_format("o_orderdate", dates.OUTPUT_TIME))
    return orders.groupBy("o_orderstatus").agg(relational.earliest_date("t").alias("business_date"))


_ROUTE = f"WITH {d.SQL_O} SELECT k AS o_orderkey, {{date}} AS cancel_date FROM o WHERE st {{test}} 'P'"


def _routed(spark, sf_dir, side):
    orders = feed_flow.parse_orders(d.form_feed(spark, sf_dir))
    rows = relational.split_cancelled(orders)[side]
    return rows.select(
        F.col("Transaction_Nbr").cast("long").alias("o_orderkey"), F.col("Cancel_Date").alias("cancel_date")
    )


@query("route_demand", _ROUTE.format(date="NULL::VARCHAR", test="<>"))
def route_demand(spark, sf_dir):
    return _routed(spark, sf_dir, 0)


@query("route_cancel", _ROUTE.format(date=d.sql_time("d + INTERVAL 3 DAY"), test="="))
def route_cancel(spark, sf_dir):
    return _routed(spark, sf_dir, 1)


@query(
    "order_window",
    "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-05-01' AND o_orderdate < TIMESTAMP '1997-02-03 12:00:00'",
)
def order_window(spark, sf_dir):
    lo, hi = dates.request_window("1996-05-01 00:00:00", "1997-02-03 12:00:00")
    return table(spark, sf_dir, "orders").filter(dates.in_window(F.col("o_orderdate"), lo, hi)).select("o_orderkey")


@query(
    "order_window_default",
    "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-09' AND ts < TIMESTAMP '2024-01-10'",
)
def order_window_default(spark, sf_dir):
    lo, hi = dates.request_window("not a time", " ", now=datetime(2024, 1, 10, 15, 30))
    return table(spark, sf_dir, "events").filter(dates.in_window(F.col("ts"), lo, hi)).select("event_id")


@query(
    "in_between",
    "SELECT o_orderkey, o_totalprice BETWEEN 1000 AND 200000 AS in_range, o_orderstatus IN ('O', 'P') AS listed FROM orders",
)
def in_between(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").between(1000, 200000).alias("in_range"),
        F.col("o_orderstatus").isin("O", "P").alias("listed"),
    )


@query("schema_only", "SELECT count(*) AS rows_kept, false AS any_row, count(*) > 0 AS any_order FROM orders")
def schema_only(spark, sf_dir):
    """The empty frame of a table's schema adds no row to the table."""
    orders = table(spark, sf_dir, "orders")
    none = relational.empty_like(orders)
    counted = none.unionByName(orders).agg(F.count(F.lit(1)).alias("rows_kept"))
    return counted.withColumn("any_row", F.lit(has_rows(none))).withColumn("any_order", F.lit(has_rows(orders)))


@query(
    "rename_derive",
    f"WITH {d.SQL_O} SELECT k AS order_id, tax AS Tax, tax * 2 AS Tax_Twice FROM o",
)
def rename_derive(spark, sf_dir):
    """A derived column that differs from a raw one by case only leaves the raw one to the others."""
    raw = d.raw_orders(spark, sf_dir).select("o_orderkey", "TAX")
    tax = text.to_double(F.col("TAX"))
    derived = relational.derive(raw, {"Tax": tax, "Tax_Twice": text.to_double(F.col("TAX")) * 2})
    return relational.rename(derived, {"o_orderkey": "order_id"})


@query(
    "wide_header",
    f"""
WITH {d.SQL_O}, {d.SQL_L}
SELECT {d.sql_store("l1.item_type")} AS eCom_Store_ID, txn AS Transaction_Nbr, l1.item_type AS Item_Type,
  teika_sum + teika_sum_tax AS Demand_Gross, kessai AS Tender_ID, slip AS Shipment_ID, -1 AS Jda_Order, free11 AS Gift_Charge
FROM o LEFT JOIN l AS l1 ON l1.l_orderkey = k AND l1.n = 1
""",
)
def wide(spark, sf_dir):
    fields = entries.with_fields(d.form_feed(spark, sf_dir))
    columns = wide_header(FEED, entries.field)
    shown = [
        "eCom_Store_ID", "Transaction_Nbr", "Item_Type", "Demand_Gross", "Tender_ID", "Shipment_ID", "Jda_Order", "Gift_Charge",
    ]
    return fields.select(*[columns[name].alias(name) for name in shown])


@query(
    "named_frames",
    "SELECT o_orderstatus, count(*) AS orders, count(n_nationkey) AS with_tender FROM orders "
    "LEFT JOIN nation ON o_custkey % 30 = n_nationkey GROUP BY o_orderstatus",
)
def named_frames(spark, sf_dir):
    """SQL text over frames handed in by name, without global views."""
    return spark.sql(
        """
        WITH labelled AS (
          SELECT status, t.TenderType AS label FROM {orders} AS o LEFT JOIN {tender} AS t ON o.tender = t.TenderID)
        SELECT status AS o_orderstatus, count(*) AS orders, count(label) AS with_tender FROM labelled GROUP BY status
        """,
        orders=d.raw_orders(spark, sf_dir).selectExpr("o_orderstatus AS status", "KESSAI_ID AS tender"),
        tender=d.tender_map(spark, sf_dir),
    )


# --------------------------------------------------------------- quality

_QUALITY_SQL = """
WITH q AS (SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN '' WHEN 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END AS seg,
  CASE WHEN c_nationkey = 3 THEN NULL ELSE c_acctbal END AS bal FROM customer),
f AS (SELECT c_custkey, coalesce(seg, '') <> '' AND bal IS NOT NULL AS mandatory_field_check FROM q)
"""


def _quality_rows(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.expr("case c_mktsegment when 'MACHINERY' then '' when 'HOUSEHOLD' then null else c_mktsegment end").alias("seg"),
        F.expr("if(c_nationkey = 3, null, c_acctbal)").alias("bal"),
    )


@query("mandatory_flag", _QUALITY_SQL + "SELECT c_custkey, mandatory_field_check FROM f")
def mandatory_flag(spark, sf_dir):
    once = quality.check_mandatory(_quality_rows(spark, sf_dir), ["seg"])
    return quality.check_mandatory(once, ["bal"]).select("c_custkey", quality.FLAG)


@query(
    "valid_split",
    _QUALITY_SQL + "SELECT CASE WHEN mandatory_field_check THEN 'valid' ELSE 'invalid' END AS side, c_custkey FROM f",
)
def valid_split(spark, sf_dir):
    valid, invalid = quality.split_valid(quality.check_mandatory(_quality_rows(spark, sf_dir), ["seg", "bal"]))
    return valid.select(F.lit("valid").alias("side"), "c_custkey").unionByName(
        invalid.select(F.lit("invalid").alias("side"), "c_custkey")
    )


# ------------------------------------------------------------ page audit


def _event_pages(spark, sf_dir):
    """Every event as a landed page: its hour is the download's size, its minute the page number."""
    region = F.expr("case event_type when 'click' then 'CN' else 'HK' end")
    name = F.concat(
        F.lit("/in/"), region, F.lit("-"), F.date_format("ts", "yyyyMMdd"), F.lit("-Sales-"),
        F.minute("ts") + 1, F.lit(".json"),
    )
    envelopes = table(spark, sf_dir, "events").select(
        name.alias(SOURCE_FILE),
        (F.hour("ts") + 1).cast("long").alias("pages"),
        (F.col("value") < 50).alias("success"),
        F.lit(0).cast("long").alias("code"),
    )
    return pages.landed_pages(envelopes)


_PAGES_SQL = """
WITH p AS (SELECT CASE WHEN event_type = 'click' THEN 'CN' ELSE 'HK' END AS region, CAST(ts AS DATE) AS business_date,
  CAST(minute(ts) + 1 AS BIGINT) AS page, CAST(hour(ts) + 1 AS BIGINT) AS pages, coalesce(value < 50, false) AS success FROM events),
x AS (SELECT region, business_date, max(pages) AS expected FROM p GROUP BY ALL),
m AS (SELECT region, business_date, unnest(range(1, expected + 1)) AS page FROM x),
miss AS (SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.region = m.region AND p.business_date = m.business_date AND p.page = m.page))
"""


@query("page_missing", _PAGES_SQL + "SELECT region, business_date, 'Sales' AS flow, page FROM miss")
def page_missing(spark, sf_dir):
    return pages.missing_pages(_event_pages(spark, sf_dir))


@query(
    "page_audit",
    _PAGES_SQL
    + """,
bad AS (SELECT region, business_date, count(DISTINCT page) AS landed,
  count(DISTINCT CASE WHEN NOT success THEN page END) AS failed FROM p GROUP BY ALL)
SELECT region, business_date, 'Sales' AS flow, expected AS expected_pages, landed AS landed_pages, failed AS failed_pages,
  (SELECT count(*) FROM miss WHERE miss.region = x.region AND miss.business_date = x.business_date) AS missing_pages
FROM x JOIN bad USING (region, business_date)
""",
)
def page_audit(spark, sf_dir):
    return pages.audit_pages(_event_pages(spark, sf_dir), ok_code=0)


