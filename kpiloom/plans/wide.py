"""Wide header: every KPI column of an order, from the raw fields of the form vendor.

Normal form records and recovery files carry the same raw fields and differ in
date layout, net formula, surcharge field and gift charge; a `Profile` holds the
difference. Facts select what they need and Catalyst drops the rest.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom import contracts
from kpiloom.functions import codes, dates, measures, text


@dataclass(frozen=True)
class Profile:
    item_type: str
    order_time: str
    cancel_time: str | None
    net: Callable[[measures.Fields], Column]
    surcharge: str
    gift_charge: str | None


FEED = Profile(
    "ORDER_D_FREE_ITEM31_1", dates.FEED_DATE, dates.FEED_DATE, measures.demand_net_normal, "FREE_ITEM33", "FREE_ITEM11"
)
FLAT_SALES = Profile(
    "ORDER_D_FREE_ITEM31",
    dates.FLAT_SALES_TIME,
    None,
    measures.demand_net_recovery,
    "ORDER_D_FREE_ITEM35",
    None,
)
FLAT_CANCEL = Profile(
    "ORDER_D_FREE_ITEM31",
    dates.FLAT_CANCEL_TIME,
    dates.FLAT_CANCEL_DATE,
    measures.demand_net_recovery,
    "ORDER_D_FREE_ITEM35",
    None,
)

# Raw amount fields that reach an output unchanged.
DIRECT_AMOUNTS = {
    "Freight_Tax": "SORYO_TAX",
    "Freight_Amount": "SORYO",
    "Coupon_Amount": "COUPON_WARIBIKI",
    "Tax": "TAX",
    "CoD_Charge": "DAIBIKI",
    "CoD_Charge_Tax": "DAIBIKI_TAX",
    "Shipping_Fee": "SORYO",
    "Shipping_Fee_Tax": "SORYO_TAX",
    "Line_Total": "SEIKYU",
    "Tender_Amt": "SEIKYU",
}


def direct_amounts(col: measures.Fields = F.col) -> dict[str, Column]:
    return {name: measures.number(raw, col) for name, raw in DIRECT_AMOUNTS.items()}


def wide_header(
    profile: Profile, col: measures.Fields = F.col, country: str = "JP", currency: str = "JPY"
) -> dict[str, Column]:
    """Output name -> expression over raw fields."""
    item_type = text.blank_to_null(col(profile.item_type))
    no_text = text.const(None, "string")
    if profile.gift_charge:
        gift_charge = measures.number(profile.gift_charge, col)
    else:
        gift_charge = text.const(None, "double")
    if profile.cancel_time:
        cancel_date = dates.norm_ts(col("CANCEL_DATE"), profile.cancel_time)
    else:
        cancel_date = no_text
    return {
        "Item_Type": item_type,
        "eCom_Store_ID": codes.store_from_type(item_type),
        "Transaction_Nbr": text.strip_order_prefix(col("ORDER_DISP_NO")),
        "Order_Date": dates.norm_ts(col("ORDER_DATE"), profile.order_time),
        "Cancel_Date": cancel_date,
        "Country": F.lit(country),
        "Device_Type": codes.device_label(text.lead_code(col("ORDER_H_ACCESS_BROWSER_KBN"))),
        "Employee_Purchase": no_text,
        "Order_Channel": F.lit(contracts.CHANNEL),
        "Customer_ID": text.blank_to_null(col("MEMBER_ID")),
        "Shipment_ID": text.blank_to_null(col("SHIP_SLIP_NO")),
        "Shipment_Method": no_text,
        "Ship_To_Country": F.lit(country),
        "Ship_To": no_text,
        "Bill_To": no_text,
        "Promotion_Coupons": codes.coupon_flag(col("COUPON_ID")),
        "Demand_Gross": measures.demand_gross(col),
        "Demand_Net": profile.net(col),
        "Employee_ID": no_text,
        "Bill_To_Country": F.lit(country),
        "Demand_Currency": F.lit(currency),
        "Discount_Amount": measures.header_discount(item_type, profile.surcharge, col),
        **direct_amounts(col),
        "Tender_ID": col("KESSAI_ID"),
        "Gift_Charge": gift_charge,
        "Gift_Tax": measures.gift_tax(gift_charge),
        "Jda_Order": F.lit(-1),
    }
