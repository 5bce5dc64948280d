"""URL-encoded form records -> header, payment, line, cancel.

A record is parsed in place (see operators/entries.py), so its header and its
items come from the same row: no shuffle, no join of lines with headers. The
only joins are the ones with the tender and item dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom import contracts
from kpiloom.functions import measures, text
from kpiloom.operators import entries
from kpiloom.operators.joins import with_item
from kpiloom.operators.relational import earliest_date, split_cancelled
from kpiloom.plans.facts import to_cancel, to_header, to_line, to_payment
from kpiloom.plans.wide import FEED, wide_header
from kpiloom.session import land_observed

# Order columns that lines and cancelled lines carry.
_CARRIED = [
    "eCom_Store_ID", "Transaction_Nbr", "Order_Date", "Cancel_Date", "Country", "Shipment_Method", "Ship_To_Country",
    "Gift_Charge", "Gift_Tax", "Line_Total", "Jda_Order", "Demand_Gross", "Tender_ID", "Demand_Currency",
]


def _fields_and_header(feed: DataFrame, text_column: str, decode_first: bool, items: bool) -> DataFrame:
    fields = entries.with_fields(feed.select(text_column), text_column, decode_first, items)
    header = wide_header(FEED, lambda name: entries.field(name, decode_first))
    return fields.select("*", *[c.alias(name) for name, c in header.items()])


def parse_orders(feed: DataFrame, text_column: str = "value", decode_first: bool = False) -> DataFrame:
    """One row per record: the wide header."""
    return _fields_and_header(feed, text_column, decode_first, False).drop("names", "values")


def _item_columns(decode_first: bool) -> list[Column]:
    def raw(name: str):
        return entries.item_field(name, decode_first)

    item_type = text.blank_to_null(raw("ORDER_D_FREE_ITEM31"))
    quantity = measures.number("QUANTITY", raw)
    return [
        text.to_int(raw("ORDER_D_NO")).alias("Item_Seq_Number"),
        item_type.alias("Item_Type"),
        text.blank_to_null(raw("ORDER_D_FREE_ITEM32")).alias("Barcode"),
        quantity.alias("Demand_Sales_Unit"),
        measures.line_net_normal(raw).alias("Demand_Net"),
        measures.line_discount(
            item_type,
            measures.number("SHIRE_PRICE", raw),
            measures.number("TEIKA", raw),
            quantity,
            measures.number("ORDER_D_FREE_ITEM35", raw),
        ).alias("Discount_Amount"),
    ]


def parse_lines(feed: DataFrame, text_column: str = "value", decode_first: bool = False) -> DataFrame:
    """One row per item of a record, with the order's columns."""
    records = _fields_and_header(feed, text_column, decode_first, True)
    return entries.explode_items(records, _CARRIED).select(*_CARRIED, *_item_columns(decode_first))


def parse_records(feed: DataFrame, text_column: str = "value", decode_first: bool = False) -> DataFrame:
    """Orders and items in one pass: a row per item with the order's columns, the item as `line`.

    `place` counts an order's rows from 0; an order without items has one row, which is no `is_item`
    and whose line is empty. The line is made without a condition: in a branch no field that several
    columns share is looked up once only, and the generated code gets too long to be compiled.
    """
    records = _fields_and_header(feed, text_column, decode_first, True)
    header = [c for c in records.columns if c not in ("names", "values", "sequences")]
    items = entries.explode_items(records, header, outer=True)
    line = F.struct(*_item_columns(decode_first)).alias("line")
    return items.select(*header, "place", F.col("sequence").isNotNull().alias("is_item"), line)


def build_header(orders: DataFrame) -> DataFrame:
    return to_header(split_cancelled(orders)[0])


def build_payment(orders: DataFrame, tender_map: DataFrame) -> DataFrame:
    return to_payment(split_cancelled(orders)[0], tender_map, {"Tender_ID": "TenderID"})


def build_line(lines: DataFrame, items: DataFrame) -> DataFrame:
    return to_line(
        with_item(split_cancelled(lines)[0], items),
        AX_Style_ID=F.col("Style"),
        AX_Color_ID=F.col("Color"),
        AX_Size_ID=F.col("Size"),
        Shipment_ID=F.lit(0),
        Gift_IND=F.lit(0),
        Non_Merch_Item=F.lit("N"),
        GiftChrg=F.col("Gift_Charge"),
        GiftTax=F.col("Gift_Tax"),
        ItmSeqNum=F.col("Item_Seq_Number"),
        DiscountAmt=F.col("Discount_Amount"),
    )


def build_cancel(lines: DataFrame, items: DataFrame) -> DataFrame:
    return to_cancel(
        with_item(split_cancelled(lines)[1], items),
        Order_Date=F.col("Order_Date"),
        Order_Total=F.col("Line_Total"),
        Store=F.col("eCom_Store_ID"),
        Jda_Order=F.col("Jda_Order"),
        Line=F.col("Item_Seq_Number"),
        Weborder_Id=F.col("Transaction_Nbr"),
        Status_Date=F.col("Cancel_Date"),
        Order_Demand_Amt=F.col("Demand_Gross"),
        Upc=F.col("Barcode"),
        APAC_style=F.col("Style"),
        APAC_colour=F.col("Color"),
        APAC_size=F.col("Size"),
        Line_Qty=F.col("Demand_Sales_Unit"),
        Line_Sub_Total=F.col("Demand_Net"),
        Disc_Promo=F.col("Discount_Amount"),
        Tender_1=F.col("Tender_ID"),
        Country_Code=F.col("Country"),
        Demand_Location=F.col("eCom_Store_ID"),
        Original_Jda_Order=F.col("Jda_Order"),
        Currency=F.col("Demand_Currency"),
        Webstore=F.col("Country"),
    )


def landed_feed(feed: DataFrame, folder: str) -> tuple[DataFrame, DataFrame, dict]:
    """Orders and lines from one scan of the feed, landed in `folder`, with the earliest order date seen on the way.

    The order's columns repeat on its items' rows, which the file format keeps short; each
    fact reads its columns only.
    """
    records, seen = land_observed(parse_records(feed), folder, rows=F.count(F.lit(1)), day=earliest_date("Order_Date"))
    orders = records.filter("place = 0").drop("place", "is_item", "line")
    lines = records.filter("is_item").select(*_CARRIED, "line.*")
    return orders, lines, seen


def feed_facts(feed: DataFrame, tender_map: DataFrame, items: DataFrame, folder: str) -> dict[str, DataFrame]:
    """All four facts from one pass over the feed."""
    orders, lines, _ = landed_feed(feed, folder)
    return {
        "header": build_header(orders),
        "line": build_line(lines, items),
        "payment": build_payment(orders, tender_map),
        "cancel": build_cancel(lines, items),
    }


def fact_schemas(spark: SparkSession) -> dict[str, T.StructType]:
    """Columns and types of the four facts, as the history tables hold them."""
    feed = spark.createDataFrame([], "value string")
    orders, lines = parse_orders(feed), parse_lines(feed)
    items = spark.createDataFrame([], contracts.ITEM)
    return {
        "header": build_header(orders).schema,
        "line": build_line(lines, items).schema,
        "payment": build_payment(orders, spark.createDataFrame([], contracts.TENDER)).schema,
        "cancel": build_cancel(lines, items).schema,
    }
