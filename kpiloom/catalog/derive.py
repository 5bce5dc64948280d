"""Vendor-shaped inputs derived from the star-schema tables.

The raw fields of every feed are computed from `orders` and `lineitem`, whole
tables; `nation` serves as tender map and `part` as item dimension. The SQL
fragments give the same values straight from the tables, as numbers, so that an
oracle never goes through an encoding.

`lineitem` repeats (order, line number) pairs; `lines` keeps one row per pair, by
the smallest value of each column. Line numbers run from 1 to 7, so the array of an
order's lines is short.

Only the tables' own columns are shuffled, once, by order (or page); the much wider
texts are made of them where the rows have met.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom import contracts
from kpiloom.catalog.registry import table
from kpiloom.sources.readers import SOURCE_FILE

ORDERS_PER_PAGE = 200
#: Rows of the tables that a task groups to pages. Their texts are many times as wide, and adaptive
#: execution would size the tasks by the narrow rows that are shuffled.
ROWS_PER_TASK = 200_000


def _text(e: str) -> Column:
    return F.expr(e).cast("string")


def _texts(fields: dict[str, str]) -> list[Column]:
    return [_text(e).alias(name) for name, e in fields.items()]


# ------------------------------------------------------------ form vendor

# Fields that hold more than letters, digits and points, and so need encoding.
_ENCODED = {"ORDER_H_ACCESS_BROWSER_KBN", "COUPON_ID", "SHIP_SLIP_NO", "ORDER_DATE"}

# Raw field -> Spark expression over `orders`.
_RAW_ORDER = {
    "ORDER_DISP_NO": "concat(if(o_orderkey % 2 = 0, 'ORDER', 'e'), o_orderkey)",
    "ORDER_H_ACCESS_BROWSER_KBN": "o_orderpriority",
    "KESSAI_ID": "o_custkey % 30",
    "MEMBER_ID": "if(o_custkey % 4 = 0, '', cast(o_custkey as string))",
    "SEIKYU": "o_totalprice",
    "SHIRE_SUM": "o_totalprice + 12",
    "TEIKA_SUM": "floor(o_totalprice)",
    "TEIKA_SUM_TAX": "floor(o_totalprice / 13)",
    "TAX": "floor(o_totalprice / 10)",
    "SORYO": "o_orderkey % 700",
    "SORYO_TAX": "o_orderkey % 70",
    "DAIBIKI": "o_custkey % 500",
    "DAIBIKI_TAX": "o_custkey % 50",
    "FREE_ITEM11": "if(o_orderkey % 11 = 0, 'x', cast(o_orderkey % 5 as string))",
    "FREE_ITEM33": "o_custkey % 11",
    "COUPON_WARIBIKI": "o_custkey % 30",
    "COUPON_ID": "if(o_custkey % 30 = 0, '', concat('CP&', o_custkey % 30))",
    "SHIP_SLIP_NO": "if(o_orderkey % 3 = 0, '', concat('S=', o_orderkey))",
}

_RAW_LINE = {
    "ORDER_D_NO": "l_linenumber",
    "ORDER_D_FREE_ITEM31": "case returnflag when 'R' then 'C' when 'A' then 'L' else '' end",
    "ORDER_D_FREE_ITEM32": "case when partkey % 17 = 0 then '' when partkey % 13 = 0 then 'ZZ' "
    "else concat('BC', partkey) end",
    "ORDER_D_FREE_ITEM35": "l_linenumber * 10",
    "TEIKA": "price",
    "QUANTITY": "quantity",
    "SHIRE_PRICE": "price + 5",
}

# The same values for the oracle.
SQL_O = """
o AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderdate AS d,
    CAST(o_orderkey AS VARCHAR) AS txn,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS device,
    CAST(o_custkey % 30 AS VARCHAR) AS kessai,
    CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS member,
    o_totalprice AS seikyu, o_totalprice + 12 AS shire_sum, floor(o_totalprice) AS teika_sum,
    floor(o_totalprice / 13) AS teika_sum_tax, floor(o_totalprice / 10) AS tax,
    CAST(o_orderkey % 700 AS DOUBLE) AS soryo, CAST(o_orderkey % 70 AS DOUBLE) AS soryo_tax,
    CAST(o_custkey % 500 AS DOUBLE) AS daibiki, CAST(o_custkey % 50 AS DOUBLE) AS daibiki_tax,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 5 AS DOUBLE) END AS free11,
    CAST(o_custkey % 11 AS DOUBLE) AS free33, CAST(o_custkey % 30 AS DOUBLE) AS coupon,
    CASE WHEN o_custkey % 30 = 0 THEN 'N' ELSE 'Y' END AS coupon_flag,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'S=' || o_orderkey END AS slip,
    CASE o_orderstatus WHEN 'O' THEN 'C' WHEN 'F' THEN 'L' END AS status_type
  FROM orders)
"""

SQL_L = """
l AS (
  SELECT l_orderkey, l_linenumber AS n, min(l_quantity) AS quantity, min(l_extendedprice) AS price,
    min(l_partkey) AS partkey, CASE min(l_returnflag) WHEN 'R' THEN 'C' WHEN 'A' THEN 'L' END AS item_type,
    min(l_returnflag) AS returnflag,
    CASE WHEN min(l_partkey) % 17 = 0 THEN NULL WHEN min(l_partkey) % 13 = 0 THEN 'ZZ'
      ELSE 'BC' || min(l_partkey) END AS barcode,
    CAST(l_linenumber * 10 AS DOUBLE) AS free35
  FROM lineitem GROUP BY l_orderkey, l_linenumber)
"""

SQL_TENDER = "t AS (SELECT CAST(n_nationkey AS VARCHAR) AS tender_id, n_name AS tender_type FROM nation)"
SQL_ITEM = (
    "i AS (SELECT 'BC' || p_partkey AS bc, p_brand AS style, p_type AS color, "
    "CAST(p_size AS VARCHAR) AS size FROM part)"
)

SQL_DEVICE_4 = "CASE device WHEN 1 THEN 'DESKTOP' WHEN 2 THEN 'MOBILE' WHEN 3 THEN 'MOBILE PHONE' WHEN 4 THEN 'TABLET' ELSE 'OTHER' END"


def sql_store(item_type: str) -> str:
    return f"CASE {item_type} WHEN 'C' THEN '57037' WHEN 'L' THEN '56001' ELSE '57036' END"


def sql_time(timestamp: str) -> str:
    return f"strftime({timestamp}, '%Y-%m-%d %H:%M:%S')"


def _join_facts(orders: DataFrame, per_order: DataFrame, how: str = "inner") -> DataFrame:
    """Both sides grow with the data, so neither is ever broadcast on an estimate."""
    return orders.join(per_order.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), how)


def _line_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of `lineitem` that feeds have.

    The one-letter flag is compared by its code: with numbers only, Spark aggregates
    by hash instead of sorting the table.
    """
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.ascii("l_returnflag").alias("flag_code"),
        F.col("l_partkey").alias("partkey"),
    )


_LINE_MINIMA = {
    "quantity": "min(quantity)",
    "price": "min(price)",
    "returnflag": "char(min(flag_code))",
    "partkey": "min(partkey)",
}


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (order, line number), dealt by order: what follows per order needs no further shuffle."""
    rows = _line_columns(spark, sf_dir).repartition("l_orderkey")
    return rows.groupBy("l_orderkey", "l_linenumber").agg(*[F.expr(e).alias(name) for name, e in _LINE_MINIMA.items()])


def _orders_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").repartition("o_orderkey")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw order fields of the form vendor as text, with the order's key, date and status.

    ORDER_D_FREE_ITEM31 is the order's own item type, by status.
    """
    return _raw_orders(table(spark, sf_dir, "orders"))


def _raw_orders(orders: DataFrame, *kept: str) -> DataFrame:
    return orders.select(
        *kept,
        "o_orderkey",
        "o_orderdate",
        "o_orderstatus",
        *_texts(_RAW_ORDER),
        _text("case o_orderstatus when 'O' then 'C' when 'F' then 'L' else '' end").alias("ORDER_D_FREE_ITEM31"),
        _text("o_custkey % 40").alias("ORDER_D_FREE_ITEM35"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "partkey", *_texts(_RAW_LINE))


def items_per_order(items: DataFrame) -> DataFrame:
    """The encoded items of an order, as `items`."""
    item = F.concat_ws(
        "&",
        *[F.concat(F.lit(name + "_"), F.col("l_linenumber"), F.lit("="), F.col(name)) for name in _RAW_LINE],
    )
    return items.select("l_orderkey", item.alias("item")).groupBy("l_orderkey").agg(F.collect_list("item").alias("items"))


def feed_texts(orders: DataFrame) -> DataFrame:
    """URL-encoded records, one per order with its `items`, as `value`."""

    def pair(name: Column, value: Column, encode: bool) -> Column:
        return F.concat(name, F.lit("="), F.url_encode(value) if encode else value)

    dates = {
        "ORDER_DATE": F.date_format("o_orderdate", "yyyy/MM/dd"),
        "CANCEL_DATE": F.when(
            F.col("o_orderstatus") == "P", F.date_format(F.expr("o_orderdate + interval 3 days"), "yyyy/MM/dd")
        ).otherwise(F.lit("")),
    }
    head = F.concat_ws(
        "&",
        *[pair(F.lit(name), F.col(name), name in _ENCODED) for name in _RAW_ORDER],
        *[pair(F.lit(name), value, name in _ENCODED) for name, value in dates.items()],
        F.lit("FREE_ITEM1=no line"),
    )
    return orders.select("o_orderkey", F.concat_ws("&", head, F.col("items")).alias("value"))


def form_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The join sorts the tables' few columns; an order's texts are made behind it.
    joined = _join_facts(_orders_by_key(spark, sf_dir), items_per_order(raw_lines(spark, sf_dir)), "left")
    return feed_texts(_raw_orders(joined, "items"))


def flat_rows(spark: SparkSession, sf_dir: str, cancel: bool) -> DataFrame:
    """Recovery rows of the form vendor, one per order and line, in file layout."""
    o, l = _raw_orders(_orders_by_key(spark, sf_dir)), raw_lines(spark, sf_dir)  # noqa: E741
    joined = _join_facts(o.drop("ORDER_D_FREE_ITEM31", "ORDER_D_FREE_ITEM35"), l)
    at = F.expr("o_orderdate + make_dt_interval(0, o_orderkey % 24, o_orderkey % 60, o_orderkey % 50)")
    at_minute = F.expr("o_orderdate + make_dt_interval(0, o_orderkey % 24, o_orderkey % 60, 0)")
    cancelled = F.when(
        F.col("o_orderstatus") == "P", F.date_format(F.expr("o_orderdate + interval 3 days"), "M/d/yyyy")
    ).otherwise(F.lit(""))
    derived = {
        "ORDER_DATE": F.date_format(at_minute, "M/d/yyyy H:m") if cancel else F.date_format(at, "yyyy/MM/dd H:m:s"),
        "ORDER_D_FREE_ITEM41": F.lit(""),
        "ORDER_D_TEIKA": F.col("TEIKA"),
        "ORDER_D_SHIRE_PRICE": F.col("SHIRE_PRICE"),
        "ORDER_D_QUANTITY": F.col("QUANTITY").cast("double").cast("int").cast("string"),
        "FREE_ITEM_11": F.lit(""),
        "CANCEL_DATE": cancelled,
        "SEND_DATE": F.lit(""),
    }
    columns = contracts.FLAT_CANCEL_COLUMNS if cancel else contracts.FLAT_SALES_COLUMNS
    return joined.select(*[derived.get(name, F.col(name)).alias(name) for name in columns])


def tender_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.select(F.col("n_nationkey").cast("string").alias("TenderID"), F.col("n_name").alias("TenderType"))


def tender_map_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    country = F.expr("if(n_regionkey % 2 = 0, 'CN', 'HK')").alias("Country")
    nation = table(spark, sf_dir, "nation")
    return nation.select(
        country, F.col("n_nationkey").cast("string").alias("TenderID"), F.col("n_name").alias("TenderType")
    )


def item_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.expr("concat('BC', p_partkey)").alias("Barcode"),
        F.col("p_brand").alias("Style"),
        F.col("p_type").alias("Color"),
        F.col("p_size").cast("string").alias("Size"),
    )


# -------------------------------------------------------- envelope vendor

_COUNTRY = "if(o_custkey % 2 = 0, 'CN', 'HK')"
_STORE = "concat('0730', 1 + o_custkey % 8)"
_ISO = "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\")"

_ENVELOPE_ORDER = {
    "Bill_To": "concat('B', o_custkey)",
    "Bill_To_Country": _COUNTRY,
    "CoD_Charge": "'0'",
    "CoD_Charge_Tax": "'0'",
    "Country": _COUNTRY,
    "Coupon_Amount": "if(o_custkey % 30 = 0, '', cast(o_custkey % 30 as string))",
    "Customer_ID": "o_custkey",
    "Demand_Net": "o_totalprice",
    "Device_Type": "if(o_orderkey % 13 = 0, '', left(o_orderpriority, 1))",
    "Discount_Amount": "floor(o_totalprice / 20)",
    "Employee_ID": "if(o_custkey % 5 = 0, concat('E', o_custkey), '')",
    "Employee_Purchase": "if(o_custkey % 5 = 0, 'Y', 'N')",
    "Freight_Amount": "o_orderkey % 700",
    "Freight_Tax": "o_orderkey % 70",
    "Line_Total": "o_totalprice",
    "Order_Channel": "'app'",
    "Order_Date": _ISO,
    "Promotion_Coupons": "'P'",
    "Ship_To": "concat('S', o_custkey)",
    "Shipping_Fee": "'0'",
    "Shipping_Fee_Tax": "'0'",
    "Tax": "floor(o_totalprice / 10)",
    "Transaction_Nbr": "concat('T', o_orderkey)",
    "eCom_Store_ID": _STORE,
}

_ENVELOPE_LINE = {
    "AX_Color_ID": "concat('c', partkey % 7)",
    "AX_Size_ID": "concat('s', partkey % 5)",
    "AX_Style_ID": "concat('BC', partkey)",
    "Demand_Net": "price",
    "Demand_Sales_Unit": "cast(quantity as int)",
    "Discount_Amount": "floor(price / 50)",
    "Gift_Charge": "'0'",
    "Gift_IND": "case returnflag when 'N' then '' when 'A' then 'Y' end",
    "Gift_Tax": "'0'",
    "Item_Seq_Number": "l_linenumber",
    "Non_Merch_Item": "'N'",
    "Order_Date": _ISO,
    "Ship_To_Country": _COUNTRY,
    "Shipment_ID": "concat('SH', o_orderkey)",
    "Shipment_Method": "'air'",
    "Transaction_Nbr": "concat('T', o_orderkey)",
    "eCom_Store_ID": _STORE,
}

_CANCEL_ITEM = {
    "Order_Date": _ISO,
    "Order_Total": "o_totalprice",
    "Store": _STORE,
    "Line": "l_linenumber",
    "Type": "case returnflag when 'R' then 'ret' else '' end",
    "Transaction_Nbr": "concat('T', o_orderkey)",
    "Status_Date": "date_format(o_orderdate + interval 3 days, \"yyyy-MM-dd'T'HH:mm:ss\")",
    "Order_Demand_Amt": "floor(o_totalprice / 2)",
    "Upc": "if(partkey % 17 = 0, '', concat('BC', partkey))",
    "APAC_style": "concat('st', partkey % 11)",
    "APAC_colour": "concat('c', partkey % 7)",
    "APAC_size": "concat('s', partkey % 5)",
    "Line_Qty": "quantity",
    "Line_Sub_Total": "price",
    "Disc_Promo": "'0'",
    "Tender_1": "o_custkey % 30",
    "Tender_2": "''",
    "Tender_3": "''",
    "Country_Code": _COUNTRY,
    "Demand_Location": _STORE,
    "Warehouse_Reason_Code": "if(partkey % 2 = 0, '', 'W1')",
    "Warehouse_Reason": "if(partkey % 2 = 0, '', 'stock')",
    "Customer_Reason_Code": "if(partkey % 2 = 0, 'C1', '')",
    "Customer_Reason": "if(partkey % 2 = 0, 'size', '')",
    "Currency": "if(o_custkey % 2 = 0, 'CNY', '')",
    "Webstore": "'web'",
}


def _struct(fields: dict[str, str], order: list[str]) -> Column:
    return F.struct(*[_text(fields[name]).alias(name) for name in order])


def _order_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _join_facts(table(spark, sf_dir, "orders"), lines(spark, sf_dir))


def _page(orders: DataFrame, flow: str) -> DataFrame:
    """Orders as `o` with a page number, to envelopes of at most ORDERS_PER_PAGE orders."""
    pages = orders.groupBy("page").agg(F.collect_list("o").alias("orders"))
    size = F.size("orders").cast("long")
    return pages.select(
        F.lit(0).cast("long").alias("code"),
        F.lit("ok").alias("message"),
        "orders",
        F.lit(ORDERS_PER_PAGE).cast("long").alias("pageSize"),
        F.col("page").alias("pages"),
        F.lit(True).alias("success"),
        size.alias("total"),
        F.concat(F.lit(f"CN-20240501-{flow}-"), F.col("page"), F.lit(".json")).alias(SOURCE_FILE),
    )


def _of_line(e: str) -> str:
    """The expression over the columns of a line, as one over the fields of its struct `x`."""
    return re.sub(rf"\b(l_linenumber|{'|'.join(_LINE_MINIMA)})\b", r"x.\1", e)


def _paged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: its page, its columns, and its lines as an array of structs (empty for an order without).

    Orders and lines go through one shuffle together, by page, so that an order meets its
    lines and a page its orders without a join.
    """
    orders, items = table(spark, sf_dir, "orders"), _line_columns(spark, sf_dir).filter("l_orderkey IS NOT NULL")
    # Both counts come from the files' footers.
    rows = orders.count() + table(spark, sf_dir, "lineitem").count()
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_TASK))

    def page(key: str) -> Column:
        return F.expr(f"1 + {key} div {ORDERS_PER_PAGE}").alias("page")

    heads = orders.select(page("o_orderkey"), F.col("o_orderkey").alias("l_orderkey"), F.struct(*orders.columns).alias("o"))
    both = items.select(page("l_orderkey"), F.lit(True).alias("is_line"), "*").unionByName(heads, allowMissingColumns=True)
    minima = [F.expr(e).alias(name) for name, e in _LINE_MINIMA.items()]
    each = both.repartition(tasks, "page").groupBy("page", "l_orderkey", "is_line", "l_linenumber")
    each = each.agg(*minima, F.collect_list("o").alias("heads"))
    line = F.when(F.col("is_line"), F.struct("l_linenumber", *_LINE_MINIMA))
    per_order = each.groupBy("page", "l_orderkey").agg(
        F.flatten(F.collect_list("heads")).alias("heads"), F.collect_list(line).alias("lines")
    )
    return per_order.select("page", "lines", F.explode("heads").alias("o")).select("page", "lines", "o.*")


def sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: `o`, the nested order of the envelope, `o_orderkey` and its `page`."""
    fields = ", ".join(f"cast({_of_line(_ENVELOPE_LINE[name])} as string) as {name}" for name in contracts.ORDER_LINE_FIELDS)
    lines_of_order = F.expr(f"if(size(lines) > 0, transform(lines, x -> struct({fields})), null)")
    shared = {"Order_Date": _ISO, "Transaction_Nbr": "concat('T', o_orderkey)", "eCom_Store_ID": _STORE}
    first = {
        "Demand_Currency": "'CNY'",
        "Tender": "o_custkey % 30",
        "Tender_Amt": "if(o_orderkey % 7 = 0, '', cast(o_totalprice as string))",
        **shared,
    }
    second = {"Demand_Currency": "'CNY'", "Tender": "o_orderkey % 30", "Tender_Amt": "5", **shared}
    payments = F.when(
        F.col("o_custkey") % 3 == 0,
        F.array(_struct(first, contracts.ORDER_PAYMENT_FIELDS), _struct(second, contracts.ORDER_PAYMENT_FIELDS)),
    ).otherwise(F.array(_struct(first, contracts.ORDER_PAYMENT_FIELDS)))
    order = F.struct(
        *[_text(_ENVELOPE_ORDER[name]).alias(name) for name in contracts.ORDER_TEXT_FIELDS],
        lines_of_order.alias("Order_Lines"),
        payments.alias("Order_Payments"),
    )
    return _paged_orders(spark, sf_dir).select("o_orderkey", "page", order.alias("o"))


def sales_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page(sales_orders(spark, sf_dir).select("page", "o"), "Sales")


def cancel_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per cancelled order, with its items."""
    item = _struct(_CANCEL_ITEM, contracts.CANCEL_TEXT_FIELDS)
    cancelled = _order_with_lines(spark, sf_dir).filter("o_orderstatus = 'P'")
    return _page(cancelled.select(F.col("o_orderkey").alias("page"), item.alias("o")), "Cancel")


# ------------------------------------------- conformed recovery files

_CONFORMED_TIME = "date_format(o_orderdate + make_dt_interval(0, o_orderkey % 24, o_orderkey % 60, 0), 'yyyy/M/d H:m')"
SQL_CONFORMED_TIME = "strftime(d + to_hours(k % 24) + to_minutes(k % 60), '%Y-%m-%d %H:%M:%S')"


def _conform(rows: DataFrame, schema, expressions: dict[str, str]) -> DataFrame:
    return rows.select(*[F.expr(expressions[f.name]).cast(f.dataType).alias(f.name) for f in schema])


def conformed_header(spark: SparkSession, sf_dir: str, which: str = "true") -> DataFrame:
    """Headers of the orders that meet `which`."""
    own = {"Order_Date": _CONFORMED_TIME, "Device_Type": "cast(left(o_orderpriority, 1) as int)", "Coupon_Amount": "o_custkey % 30"}
    return _conform(table(spark, sf_dir, "orders").filter(which), contracts.CONFORMED_HEADER, _ENVELOPE_ORDER | own)


def conformed_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = {"Order_Date": _CONFORMED_TIME}
    return _conform(_order_with_lines(spark, sf_dir), contracts.CONFORMED_LINE, _ENVELOPE_LINE | own)


def conformed_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conform(
        table(spark, sf_dir, "orders"),
        contracts.CONFORMED_PAYMENT,
        {
            "eCom_Store_ID": _STORE,
            "Transaction_Nbr": "concat('T', o_orderkey)",
            "Order_Date": _CONFORMED_TIME,
            "Tender": "o_custkey % 30",
            "Tender_Amt": "case when o_orderkey % 7 = 0 then '' when o_orderkey % 7 = 1 then null "
            "else cast(o_totalprice as string) end",
            "Demand_Currency": "'CNY'",
        },
    )


def conformed_cancel(spark: SparkSession, sf_dir: str) -> DataFrame:
    constant = dict.fromkeys(contracts.CANCEL_COLUMNS, "'(NULL)'")
    own = {
        "Order_Date": _CONFORMED_TIME,
        "Status_Date": "date_format(o_orderdate + interval 3 days, 'M/d/yyyy H:m')",
        "Line_Qty": "cast(quantity as int)",
        "Warehouse_Reason_Code": "if(partkey % 2 = 0, '(NULL)', 'W1')",
        "Tender_2": "if(partkey % 3 = 0, '(NULL)', null)",
        "Currency": "if(o_custkey % 2 = 0, 'CNY', '(NULL)')",
    }
    cancelled = _order_with_lines(spark, sf_dir).filter("o_orderstatus = 'P'")
    return _conform(cancelled, contracts.CONFORMED_CANCEL, constant | _CANCEL_ITEM | own)
