"""Flat recovery files of the form vendor, one row per order and item -> the four facts.

Every row carries its order's header and payment. `build_header` and `build_payment` give
one per row; the facts of the flow have one header per order and one payment per order
and tender, from the row of the smallest item number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import measures, text
from kpiloom.operators.joins import cancel_match, with_item
from kpiloom.operators.relational import order_total, split_cancelled
from kpiloom.plans.facts import to_cancel, to_header, to_line, to_payment
from kpiloom.plans.wide import FLAT_CANCEL, FLAT_SALES, Profile, wide_header
from kpiloom.session import land

_LINE_OF_CANCEL = [
    "Item_Seq_Number", "Barcode", "Demand_Sales_Unit", "Cancel_Line_Total", "Cancel_Discount_Amount",
]


def parse_header(rows: DataFrame, profile: Profile = FLAT_SALES) -> DataFrame:
    """Wide header per row, with the raw line number for the match of cancellations."""
    columns = wide_header(profile)
    return rows.select(
        *[c.alias(name) for name, c in columns.items()],
        F.col("ORDER_D_NO"),
        measures.header_cancel_discount(columns["Item_Type"]).alias("Cancel_Discount_Amount"),
    )


def parse_line(rows: DataFrame, profile: Profile = FLAT_SALES) -> DataFrame:
    header = wide_header(profile)
    shared = [
        "Item_Type", "eCom_Store_ID", "Transaction_Nbr", "Order_Date", "Cancel_Date", "Shipment_ID", "Shipment_Method",
        "Ship_To_Country", "Gift_Charge", "Gift_Tax",
    ]
    quantity = text.to_int(F.col("ORDER_D_QUANTITY"))
    item_type = header["Item_Type"]
    own: dict[str, Column] = {
        "Item_Seq_Number": text.to_int(F.col("ORDER_D_NO")),
        "Barcode": text.blank_to_null(F.col("ORDER_D_FREE_ITEM32")),
        "Demand_Sales_Unit": quantity,
        "Demand_Net": measures.line_net_recovery(),
        "Discount_Amount": measures.line_discount(
            item_type,
            measures.number("ORDER_D_SHIRE_PRICE"),
            measures.number("ORDER_D_TEIKA"),
            quantity,
            measures.number("ORDER_D_FREE_ITEM35"),
        ),
        "Cancel_Line_Total": measures.line_cancel_total(quantity),
        "Cancel_Discount_Amount": measures.line_cancel_discount(item_type),
    }
    return rows.select(
        *[header[name].alias(name) for name in shared],
        *[c.alias(name) for name, c in own.items()],
    )


def build_header(rows: DataFrame) -> DataFrame:
    return to_header(parse_header(rows), charges=True)


def build_payment(rows: DataFrame, tender_map: DataFrame) -> DataFrame:
    return to_payment(parse_header(rows), tender_map, {"Tender_ID": "TenderID"})


def build_line(rows: DataFrame, items: DataFrame) -> DataFrame:
    return to_line(
        with_item(parse_line(rows), items),
        AX_Style_ID=F.col("Style"),
        AX_Color_ID=F.col("Color"),
        AX_Size_ID=F.col("Size"),
        Gift_IND=text.const(None, "string"),
        Non_Merch_Item=F.lit("N"),
        GiftChrg=F.col("Gift_Charge"),
        GiftTax=F.col("Gift_Tax"),
        ItmSeqNum=F.col("Item_Seq_Number"),
        DiscountAmt=F.col("Discount_Amount"),
    )


def build_cancel(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Cancelled items. The order total counts all rows of the order, cancelled or not."""
    totalled = order_total(
        parse_header(rows, FLAT_CANCEL), "Transaction_Nbr", F.col("Demand_Gross"), "Order_Demand_Total"
    )
    cancelled = split_cancelled(totalled)[1].drop("Cancel_Discount_Amount")
    cancelled_lines = split_cancelled(parse_line(rows, FLAT_CANCEL))[1]
    matched = with_item(cancel_match(cancelled, cancelled_lines, _LINE_OF_CANCEL), items, trim=True)
    has_line = F.col("Item_Seq_Number").isNotNull()
    return to_cancel(
        matched,
        Order_Date=F.col("Order_Date"),
        Order_Total=F.col("Line_Total"),
        Store=F.col("eCom_Store_ID"),
        Jda_Order=F.col("Jda_Order"),
        Line=F.col("Item_Seq_Number"),
        # The status comes from the matched line.
        Status=F.when(has_line, F.lit("X")),
        Status_Text=F.when(has_line, F.lit("Cancelled")),
        Weborder_Id=F.col("Transaction_Nbr"),
        Status_Date=F.col("Cancel_Date"),
        Order_Demand_Amt=F.col("Order_Demand_Total"),
        Upc=F.col("Barcode"),
        APAC_style=F.col("Style"),
        APAC_colour=F.col("Color"),
        APAC_size=F.col("Size"),
        Line_Qty=F.col("Demand_Sales_Unit").cast("double"),
        Line_Sub_Total=F.col("Cancel_Line_Total"),
        Disc_Promo=F.col("Cancel_Discount_Amount"),
        Tender_1=F.col("Tender_ID"),
        Country_Code=F.col("Country"),
        Demand_Location=F.col("eCom_Store_ID"),
        Original_Jda_Order=F.col("Jda_Order"),
        Currency=F.col("Demand_Currency"),
        Webstore=F.col("Country"),
    )


def first_rows(rows: DataFrame, *key: str) -> DataFrame:
    """Per key the row with the smallest item number. Rows without an order number stay.

    A minimum per key, so an order's rows are combined before the shuffle.
    """
    number = text.to_int(F.col("ORDER_D_NO"))
    rest = [c for c in rows.columns if c not in key]
    first = F.min(F.struct(number.isNull().alias("__none"), number.alias("__number"), *rest)).alias("__first")
    nameless = text.is_blank(F.col("ORDER_DISP_NO"))
    firsts = rows.filter(~nameless).groupBy(*key).agg(first)
    firsts = firsts.select(*[F.col(c) if c in key else F.col(f"__first.{c}").alias(c) for c in rows.columns])
    return firsts.unionByName(rows.filter(nameless))


def sales_facts(rows: DataFrame, tender_map: DataFrame, items: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Header, line and payment from one read of the files, landed in `folder`."""
    landed = land(rows, folder)
    return {
        "header": build_header(first_rows(landed, "ORDER_DISP_NO", "ORDER_DATE")),
        "line": build_line(landed, items),
        "payment": build_payment(first_rows(landed, "ORDER_DISP_NO", "ORDER_DATE", "KESSAI_ID"), tender_map),
    }


def cancel_facts(rows: DataFrame, items: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Cancellations from one read of the files; the plan uses the landed rows three times."""
    return {"cancel": build_cancel(land(rows, folder), items)}
