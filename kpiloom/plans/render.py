"""Typed facts to the text form of the outbound files.

Facts stay typed, with real NULLs, until here: the mandatory-field check and the
history tables see those. The rules name, per feed and fact, the columns printed
with two decimals and the columns whose NULL is printed as the text `NULL`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions.text import fmt2, null_text


@dataclass(frozen=True)
class Rule:
    money: list[str] = field(default_factory=list)
    null_text: list[str] = field(default_factory=list)


_NEVER_FILLED = ["Empl_Id", "Type", "Tender_2", "Tender_3", "Customer_Ip_Add", "Csr_Associate_Name", "Fulfilling_Location"]
_REASONS = ["Warehouse_Reason_Code", "Warehouse_Reason", "Customer_Reason_Code", "Customer_Reason"]
_HEADER_MONEY = ["Freight_Tax", "Demand_Net", "Freight_Amount", "Discount_Amount", "Coupon_Amount", "Tax"]
_CANCEL_MONEY = ["Order_Total", "Order_Demand_Amt", "Line_Qty", "Line_Sub_Total"]
_APAC = ["APAC_style", "APAC_colour", "APAC_size"]

RULES = {
    "envelope": {
        "header": Rule(_HEADER_MONEY, ["Promotion_Coupons", "Employee_ID"]),
        "line": Rule(["DiscountAmt"], ["Shipment_Method"]),
        "payment": Rule(),
        "cancel": Rule(_CANCEL_MONEY, [*_NEVER_FILLED, *_REASONS, "Upc", "Currency"]),
    },
    "conformed": {
        "header": Rule(_HEADER_MONEY, ["Promotion_Coupons", "Employee_ID"]),
        "line": Rule(["DiscountAmt"], []),
        "payment": Rule(["Tender_Amt"], []),
        "cancel": Rule(_CANCEL_MONEY, [*_NEVER_FILLED, *_REASONS, "Upc", "Currency"]),
    },
    "feed": {
        "header": Rule([], ["Employee_Purchase", "Customer_ID", "Ship_To", "Bill_To", "Employee_ID"]),
        "line": Rule([], ["AX_Style_ID", "AX_Color_ID", "AX_Size_ID", "Shipment_Method"]),
        "payment": Rule(),
        "cancel": Rule(_CANCEL_MONEY, [*_NEVER_FILLED, *_REASONS, *_APAC]),
    },
    "flat": {
        "header": Rule(),
        "line": Rule(),
        "payment": Rule(),
        "cancel": Rule([*_CANCEL_MONEY, "Disc_Promo"], [*_NEVER_FILLED, *_REASONS, *_APAC, "Upc"]),
    },
}


def render(df: DataFrame, feed: str, fact: str) -> DataFrame:
    """The fact as it is printed. Decimals print as they are, doubles with two decimals."""
    rule = RULES[feed][fact]

    def printed(column: T.StructField) -> Column:
        c = F.col(column.name)
        if column.name in rule.money:
            is_decimal = isinstance(column.dataType, T.DecimalType)
            return c.cast("string") if is_decimal else null_text(fmt2(c))
        if column.name in rule.null_text:
            return null_text(c)
        return c

    return df.select(*[printed(column).alias(column.name) for column in df.schema])
