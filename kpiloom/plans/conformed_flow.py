"""Recovery files of the envelope vendor, already in fact layout -> the four facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom import contracts
from kpiloom.functions import codes, dates, text
from kpiloom.operators.joins import join_tender
from kpiloom.operators.relational import derive
from kpiloom.plans.facts import to_cancel, to_header, to_line, to_payment
from kpiloom.sources import readers


def _order_time():
    return dates.norm_ts(F.col("Order_Date"), dates.CONFORMED_TIME)


def build_header(rows: DataFrame) -> DataFrame:
    no_text = text.const(None, "string")
    device = codes.device_label(F.col("Device_Type"), contracts.DEVICE_LABELS_2, default=no_text)
    return to_header(
        derive(
            rows,
            {
                "Order_Date": _order_time(),
                "Device_Type": device,
                "Order_Channel": F.lit(contracts.CHANNEL),
                "Customer_ID": F.lit(-1),
                "Promotion_Coupons": no_text,
                "Employee_ID": no_text,
            },
        )
    )


def build_line(rows: DataFrame) -> DataFrame:
    zero = F.lit("0")
    return to_line(
        rows,
        Order_Date=_order_time(),
        Shipment_ID=zero,
        Gift_IND=zero,
        Non_Merch_Item=F.lit("N"),
        GiftChrg=zero,
        GiftTax=zero,
        ItmSeqNum=F.col("Item_Seq_Number"),
        DiscountAmt=F.col("Discount_Amount"),
    )


def build_payment(rows: DataFrame, tender_map: DataFrame) -> DataFrame:
    amount = F.when(text.is_blank(F.col("Tender_Amt")), F.lit("0")).otherwise(F.col("Tender_Amt"))
    payments = derive(
        rows,
        {
            "Country": codes.country_from_store(F.col("eCom_Store_ID")),
            "Order_Date": _order_time(),
            "Tender_Amt": text.to_dec2(amount),
        },
    )
    return to_payment(payments, tender_map, {"Country": "Country", "Tender": "TenderID"})


def build_cancel(rows: DataFrame, tender_map: DataFrame) -> DataFrame:
    labelled = join_tender(rows, tender_map, {"Country_Code": "Country", "Tender_1": "TenderID"})
    as_is = [
        "Order_Total", "Store", "Line", "Order_Demand_Amt", "APAC_style", "APAC_colour", "APAC_size", "Line_Qty",
        "Line_Sub_Total", "Disc_Promo", "Country_Code", "Demand_Location", "Webstore",
    ]
    sentinel = [
        "Tender_2", "Warehouse_Reason_Code", "Warehouse_Reason", "Customer_Reason_Code", "Customer_Reason", "Currency",
    ]
    return to_cancel(
        labelled,
        **{name: F.col(name) for name in as_is},
        **{name: F.nullif(F.col(name), F.lit(text.SOURCE_NULL_TEXT)) for name in sentinel},
        Order_Date=_order_time(),
        Status_Date=dates.norm_ts(F.col("Status_Date"), dates.FLAT_CANCEL_TIME),
        Jda_Order=F.lit(-1),
        Original_Jda_Order=F.lit(-1),
        Weborder_Id=F.col("Transaction_Nbr"),
        Tender_1=F.col("TenderType"),
    )


def read_files(spark: SparkSession, inbound: str) -> dict[str, DataFrame]:
    """The recovery files of the four facts; one that is missing is an empty frame."""
    schemas = {
        "header": contracts.CONFORMED_HEADER,
        "line": contracts.CONFORMED_LINE,
        "payment": contracts.CONFORMED_PAYMENT,
        "cancel": contracts.CONFORMED_CANCEL,
    }

    def read(fact: str, schema) -> DataFrame:
        path = readers.inbound_glob(inbound, f"conformed_{fact}")
        return readers.read_or_empty(spark, lambda: readers.read_csv(spark, path, schema), schema)

    return {fact: read(fact, schema) for fact, schema in schemas.items()}


def build(fact: str, rows: DataFrame, tender_map: DataFrame) -> DataFrame:
    """The fact of a recovery file."""
    if fact in ("payment", "cancel"):
        return {"payment": build_payment, "cancel": build_cancel}[fact](rows, tender_map)
    return {"header": build_header, "line": build_line}[fact](rows)
