"""Paged JSON envelopes -> header, line, payment, cancel."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom import contracts
from kpiloom.functions import codes, dates, measures, text
from kpiloom.operators import nested
from kpiloom.operators.joins import join_tender
from kpiloom.operators.relational import derive, earliest_date
from kpiloom.plans.facts import to_cancel, to_header, to_line, to_payment
from kpiloom.session import land
from kpiloom.sources.readers import SOURCE_FILE

_HEADER_AMOUNTS = ["Freight_Tax", "Demand_Net", "Freight_Amount", "Discount_Amount", "Coupon_Amount", "Tax"]


def build_header(orders: DataFrame) -> DataFrame:
    code = text.to_int(F.col("Device_Type"))
    typed = derive(
        orders,
        {
            "Order_Date": dates.norm_iso(F.col("Order_Date")),
            "Device_Type": codes.device_label(code, contracts.DEVICE_LABELS_2, default=code),
            "Order_Channel": F.lit(contracts.CHANNEL),
            "Customer_ID": F.lit(-1),
            "Promotion_Coupons": text.const(None, "string"),
            "Employee_ID": text.blank_to_null(F.col("Employee_ID")),
            **{name: text.to_double(F.col(name)) for name in _HEADER_AMOUNTS},
        },
    )
    return to_header(typed)


def build_line(orders: DataFrame) -> DataFrame:
    return to_line(
        nested.explode_lines(orders),
        Order_Date=dates.norm_iso(F.col("Order_Date")),
        Demand_Net=text.to_double(F.col("Demand_Net")),
        Demand_Sales_Unit=text.to_int(F.col("Demand_Sales_Unit")),
        Shipment_Method=text.const(None, "string"),
        Gift_IND=codes.gift_flag(F.col("Gift_IND")),
        GiftChrg=F.col("Gift_Charge"),
        GiftTax=F.col("Gift_Tax"),
        ItmSeqNum=F.col("Item_Seq_Number"),
        DiscountAmt=text.to_double(F.col("Discount_Amount")),
    )


def build_payment(orders: DataFrame, tender_map: DataFrame) -> DataFrame:
    payments = derive(
        nested.explode_payments(orders),
        {
            "Order_Date": dates.norm_iso(F.col("Order_Date")),
            "Tender_Amt": measures.amount_or_zero(F.col("Tender_Amt")),
        },
    )
    return to_payment(payments, tender_map, {"Country": "Country", "Tender": "TenderID"}, policy="other")


def build_cancel(orders: DataFrame, tender_map: DataFrame) -> DataFrame:
    """Cancelled items, one envelope order each."""
    labelled = join_tender(orders, tender_map, {"Country_Code": "Country", "Tender_1": "TenderID"}, policy="other")
    as_is = ["Store", "Line", "APAC_style", "APAC_colour", "APAC_size", "Disc_Promo", "Country_Code", "Demand_Location", "Webstore"]
    optional = [
        "Type", "Upc", "Tender_2", "Tender_3", "Warehouse_Reason_Code", "Warehouse_Reason", "Customer_Reason_Code",
        "Customer_Reason", "Currency",
    ]
    amounts = ["Order_Total", "Order_Demand_Amt", "Line_Qty", "Line_Sub_Total"]
    no_order = text.const(-1, "string")
    columns: dict[str, Column] = {
        **{name: F.col(name) for name in as_is},
        **{name: text.blank_to_null(F.col(name)) for name in optional},
        **{name: text.to_double(F.col(name)) for name in amounts},
        **{name: dates.norm_iso(F.col(name)) for name in ["Order_Date", "Status_Date"]},
        "Jda_Order": no_order,
        "Original_Jda_Order": no_order,
        "Weborder_Id": F.col("Transaction_Nbr"),
        "Tender_1": F.col("TenderType"),
    }
    return to_cancel(labelled, **columns)


def business_days(envelopes: DataFrame, column: str = "Order_Date") -> DataFrame:
    """One row `d`: the earliest date in the pages (`Status_Date` for cancellations), else that of their file names."""
    earliest = F.array_min(F.transform("orders", lambda order: dates.norm_iso(order[column])))
    pages = envelopes.select(earliest.alias("earliest"), SOURCE_FILE)
    return pages.agg(earliest_date("earliest", dates.file_date(F.col(SOURCE_FILE))).alias("d"))


def business_day(envelopes: DataFrame, column: str = "Order_Date") -> date | None:
    """`business_days` as a value for file names."""
    return business_days(envelopes, column).first().d


def sales_facts(envelopes: DataFrame, tender_map: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Header, line and payment from one parse of the pages, landed in `folder`."""
    orders = land(nested.explode_orders(envelopes), folder)
    return {
        "header": build_header(orders),
        "line": build_line(orders),
        "payment": build_payment(orders, tender_map),
    }


def cancel_facts(envelopes: DataFrame, tender_map: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Cancellations from one parse of the pages, landed in `folder`."""
    return {"cancel": build_cancel(land(nested.explode_orders(envelopes), folder), tender_map)}
