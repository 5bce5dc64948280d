"""Input schemas, output column orders, keys and code maps."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Output columns of the four facts, in file order.
# ---------------------------------------------------------------------------

HEADER_COLUMNS = [
    "eCom_Store_ID",
    "Transaction_Nbr",
    "Order_Date",
    "Country",
    "Device_Type",
    "Employee_Purchase",
    "Order_Channel",
    "Customer_ID",
    "Ship_To",
    "Bill_To",
    "Promotion_Coupons",
    "Freight_Tax",
    "Demand_Net",
    "Employee_ID",
    "Bill_To_Country",
    "Freight_Amount",
    "Discount_Amount",
    "Coupon_Amount",
    "Tax",
]

HEADER_CHARGE_COLUMNS = [
    "CoD_Charge",
    "CoD_Charge_Tax",
    "Shipping_Fee",
    "Shipping_Fee_Tax",
    "Line_Total",
]

LINE_COLUMNS = [
    "eCom_Store_ID",
    "Transaction_Nbr",
    "Order_Date",
    "AX_Style_ID",
    "AX_Color_ID",
    "AX_Size_ID",
    "Demand_Net",
    "Demand_Sales_Unit",
    "Shipment_ID",
    "Shipment_Method",
    "Ship_To_Country",
    "Gift_IND",
    "Non_Merch_Item",
    "GiftChrg",
    "GiftTax",
    "ItmSeqNum",
    "DiscountAmt",
]

PAYMENT_COLUMNS = [
    "eCom_Store_ID",
    "Transaction_Nbr",
    "Order_Date",
    "Tender",
    "Tender_Amt",
    "Demand_Currency",
]

CANCEL_COLUMNS = [
    "Order_Date",
    "Order_Total",
    "Store",
    "Empl_Id",
    "Jda_Order",
    "Line",
    "Status",
    "Status_Text",
    "Type",
    "Weborder_Id",
    "Status_Date",
    "Order_Demand_Amt",
    "Upc",
    "APAC_style",
    "APAC_colour",
    "APAC_size",
    "Line_Qty",
    "Line_Sub_Total",
    "Disc_Promo",
    "Tender_1",
    "Tender_2",
    "Tender_3",
    "Customer_Ip_Add",
    "Order_Entry_Method",
    "Csr_Associate_Name",
    "Country_Code",
    "Demand_Location",
    "Fulfilling_Location",
    "Original_Jda_Order",
    "Warehouse_Reason_Code",
    "Warehouse_Reason",
    "Customer_Reason_Code",
    "Customer_Reason",
    "Currency",
    "Webstore",
]

# ---------------------------------------------------------------------------
# Names carried by the form feed.
# ---------------------------------------------------------------------------

FEED_HEADER_NAMES = """
ADDR1 ADDR2 ADDR3 ADD_POINT_SUM AUTO_CANCEL_MAIL_DATE BIKO CANCEL_DATE CANCEL_MAIL_DATE COUPON_ID
COUPON_WARIBIKI CREDIT_COUNT CREDIT_KIND CREDIT_LIMIT CREDIT_NAME CREDIT_NO DAIBIKI DAIBIKI_TAX DEL_DATE
DOWNLOAD_DATE FREE_ITEM1 FREE_ITEM2 FREE_ITEM3 FREE_ITEM4 FREE_ITEM5 FREE_ITEM6 FREE_ITEM7 FREE_ITEM8
FREE_ITEM9 FREE_ITEM10 FREE_ITEM11 FREE_ITEM12 FREE_ITEM13 FREE_ITEM14 FREE_ITEM15 FREE_ITEM33 FREE_ITEM34
FREE_ITEM35 FREE_ITEM36 F_KANA F_NAME HAISO_ID HARAIKOMI_URL ITEM_CD KESSAI_ID L_KANA L_NAME MEMBER_ID
MEMBER_WARIBIKI_SUM MOBILE_MAIL NETMILE_ADD_POINT_ALL ORDER_DATE ORDER_DISP_NO ORDER_D_FREE_ITEM31_1
ORDER_H_ACCESS_BROWSER_KBN ORDER_MAIL_DATE ORDER_NO PAYMENT_DATE PAYMENT_MONEY PAY_LIMIT PC_MAIL PC_MOBILE_KBN
POINT_USE POINT_WARIBIKI RECEIPT_NO REMINDER_MAIL_DATE SEIKYU SEND_ADDR1 SEND_ADDR2 SEND_ADDR3 SEND_DATE
SEND_F_KANA SEND_F_NAME SEND_HOPE_DATE SEND_HOPE_TIME SEND_L_KANA SEND_L_NAME SEND_MAIL SEND_MAIL_DATE SEND_TEL
SEND_ZIP SESSION_ID SHIP_SLIP_NO SHIRE_SUM SORYO SORYO_TAX SYOUKAI_NO TAX TEIKA_SUM TEIKA_SUM_TAX TEL USER_AGENT
VERI_TORIHIKI_ID ZIP
""".split()

FEED_LINE_NAMES = """
ORDER_D_NO ITEM_NAME ITEM_ITEMPROPERTY_CD ORDER_D_FREE_ITEM1 ORDER_D_FREE_ITEM2 ORDER_D_FREE_ITEM3
ORDER_D_FREE_ITEM4 ORDER_D_FREE_ITEM5 ORDER_D_FREE_ITEM31 ORDER_D_FREE_ITEM32 ORDER_D_FREE_ITEM35
ORDER_D_FREE_ITEM36 ORDER_D_FREE_ITEM37 ORDER_D_FREE_ITEM38 OUTPUT_FLG QUANTITY SHIRE_PRICE TEIKA MEMBER_WARIBIKI
ADD_POINT
""".split()

# Names the KPI columns are computed from.
FEED_HEADER_USED = """
ORDER_DISP_NO ORDER_DATE CANCEL_DATE ORDER_D_FREE_ITEM31_1 ORDER_H_ACCESS_BROWSER_KBN MEMBER_ID SHIP_SLIP_NO
COUPON_ID COUPON_WARIBIKI SORYO SORYO_TAX TEIKA_SUM TEIKA_SUM_TAX SEIKYU TAX DAIBIKI DAIBIKI_TAX FREE_ITEM11
FREE_ITEM33 SHIRE_SUM KESSAI_ID
""".split()

# ---------------------------------------------------------------------------
# File columns of the inputs, in file order.
# ---------------------------------------------------------------------------

FLAT_SALES_COLUMNS = """
ORDER_DISP_NO ORDER_H_ACCESS_BROWSER_KBN ORDER_DATE KESSAI_ID MEMBER_ID SEIKYU SHIRE_SUM TEIKA_SUM TEIKA_SUM_TAX
TAX SORYO SORYO_TAX DAIBIKI DAIBIKI_TAX ORDER_D_FREE_ITEM31 ORDER_D_NO ORDER_D_FREE_ITEM41 ORDER_D_FREE_ITEM32
ORDER_D_TEIKA ORDER_D_SHIRE_PRICE ORDER_D_QUANTITY ORDER_D_FREE_ITEM35 FREE_ITEM33 COUPON_WARIBIKI COUPON_ID
SHIP_SLIP_NO FREE_ITEM_11
""".split()

FLAT_CANCEL_COLUMNS = FLAT_SALES_COLUMNS[:26] + ["CANCEL_DATE", "SEND_DATE"]

ORDER_TEXT_FIELDS = """
Bill_To Bill_To_Country CoD_Charge CoD_Charge_Tax Country Coupon_Amount Customer_ID Demand_Net Device_Type
Discount_Amount Employee_ID Employee_Purchase Freight_Amount Freight_Tax Line_Total Order_Channel Order_Date
Promotion_Coupons Ship_To Shipping_Fee Shipping_Fee_Tax Tax Transaction_Nbr eCom_Store_ID
""".split()

ORDER_LINE_FIELDS = """
AX_Color_ID AX_Size_ID AX_Style_ID Demand_Net Demand_Sales_Unit Discount_Amount Gift_Charge Gift_IND Gift_Tax
Item_Seq_Number Non_Merch_Item Order_Date Ship_To_Country Shipment_ID Shipment_Method Transaction_Nbr eCom_Store_ID
""".split()

ORDER_PAYMENT_FIELDS = """
Demand_Currency Order_Date Tender Tender_Amt Transaction_Nbr eCom_Store_ID
""".split()

CANCEL_TEXT_FIELDS = """
Order_Date Order_Total Store Line Type Transaction_Nbr Status_Date Order_Demand_Amt Upc APAC_style APAC_colour
APAC_size Line_Qty Line_Sub_Total Disc_Promo Tender_1 Tender_2 Tender_3 Country_Code Demand_Location
Warehouse_Reason_Code Warehouse_Reason Customer_Reason_Code Customer_Reason Currency Webstore
""".split()


def text_struct(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _typed(schema: T.StructType, names: set[str], data_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField(f.name, data_type if f.name in names else f.dataType) for f in schema
    ])


def _envelope(order: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("code", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("orders", T.ArrayType(order)),
        T.StructField("pageSize", T.LongType()),
        T.StructField("pages", T.LongType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("total", T.LongType()),
    ])


SALES_ENVELOPE = _envelope(
    T.StructType(
        text_struct(ORDER_TEXT_FIELDS).fields
        + [
            T.StructField("Order_Lines", T.ArrayType(text_struct(ORDER_LINE_FIELDS))),
            T.StructField("Order_Payments", T.ArrayType(text_struct(ORDER_PAYMENT_FIELDS))),
        ]
    )
)
CANCEL_ENVELOPE = _envelope(text_struct(CANCEL_TEXT_FIELDS))

FLAT_SALES = text_struct(FLAT_SALES_COLUMNS)
FLAT_CANCEL = text_struct(FLAT_CANCEL_COLUMNS)

_MONEY = T.DecimalType(38, 2)

# Recovery files of the envelope vendor arrive already in fact layout.
CONFORMED_HEADER = _typed(
    _typed(
        text_struct(HEADER_COLUMNS + HEADER_CHARGE_COLUMNS),
        {"Device_Type"},
        T.IntegerType(),
    ),
    {"Freight_Tax", "Demand_Net", "Freight_Amount", "Discount_Amount", "Coupon_Amount", "Tax", *HEADER_CHARGE_COLUMNS},
    _MONEY,
)
CONFORMED_LINE = _typed(
    text_struct([
        {"GiftChrg": "Gift_Charge", "GiftTax": "Gift_Tax", "ItmSeqNum": "Item_Seq_Number", "DiscountAmt": "Discount_Amount"}
        .get(name, name)
        for name in LINE_COLUMNS
    ]),
    {"Discount_Amount"},
    _MONEY,
)
CONFORMED_PAYMENT = text_struct(PAYMENT_COLUMNS)
CONFORMED_CANCEL = _typed(
    _typed(
        text_struct(["Transaction_Nbr" if name == "Weborder_Id" else name for name in CANCEL_COLUMNS]),
        {"Order_Total", "Order_Demand_Amt", "Line_Sub_Total"},
        _MONEY,
    ),
    {"Line_Qty"},
    T.DecimalType(38, 0),
)

# History tables: one declared schema per fact, whichever flow fills it. Amounts and
# quantities are doubles, numbers that are names (item, shipment) are text.
FACT_TABLES = {
    "header": _typed(
        text_struct(HEADER_COLUMNS + HEADER_CHARGE_COLUMNS),
        {"Freight_Tax", "Demand_Net", "Freight_Amount", "Discount_Amount", "Coupon_Amount", "Tax", *HEADER_CHARGE_COLUMNS},
        T.DoubleType(),
    ),
    "line": _typed(
        text_struct(LINE_COLUMNS), {"Demand_Net", "Demand_Sales_Unit", "GiftChrg", "GiftTax", "DiscountAmt"}, T.DoubleType()
    ),
    "payment": _typed(text_struct(PAYMENT_COLUMNS), {"Tender_Amt"}, T.DoubleType()),
    "cancel": _typed(
        _typed(
            text_struct(CANCEL_COLUMNS),
            {"Order_Total", "Order_Demand_Amt", "Line_Qty", "Line_Sub_Total", "Disc_Promo"},
            T.DoubleType(),
        ),
        {"Jda_Order", "Original_Jda_Order"},
        T.IntegerType(),
    ),
}

TENDER_BY_COUNTRY = text_struct(["Country", "TenderID", "TenderType"])
TENDER = text_struct(["TenderID", "TenderType"])
ITEM = text_struct(["Barcode", "Style", "Color", "Size"])

# ---------------------------------------------------------------------------
# Code maps, defaults of the functions that take them.
# ---------------------------------------------------------------------------

DEVICE_LABELS_2 = ["Desktop", "Mobile Phone"]
DEVICE_LABELS_4 = ["DESKTOP", "MOBILE", "MOBILE PHONE", "TABLET"]
STORE_BY_ITEM_TYPE = {"C": "57037", "L": "56001"}
STORE_OTHERWISE = "57036"
COUNTRY_BY_STORE = {"07301": "CN", "07302": "CN", "07304": "CN", "07308": "HK"}
CHANNEL = "Website"
CANCEL_STATUS = "X"
CANCEL_STATUS_TEXT = "Cancelled"

# ---------------------------------------------------------------------------
# Primary keys, mandatory fields and file words per fact.
# ---------------------------------------------------------------------------

MANDATORY = {
    "header": ["eCom_Store_ID", "Transaction_Nbr", "Order_Date", "Country", "Device_Type", "Demand_Net"],
    "payment": ["eCom_Store_ID", "Transaction_Nbr", "Order_Date"],
    "line": [
        "eCom_Store_ID",
        "Transaction_Nbr",
        "Order_Date",
        "AX_Style_ID",
        "AX_Color_ID",
        "AX_Size_ID",
        "Demand_Net",
        "Demand_Sales_Unit",
        "ItmSeqNum",
    ],
    "cancel": [
        "Order_Date",
        "Store",
        "Weborder_Id",
        "Status_Date",
        "Order_Demand_Amt",
        "APAC_style",
        "APAC_colour",
        "APAC_size",
        "Line_Qty",
        "Line_Sub_Total",
        "Country_Code",
    ],
}

# Keys of the order. A line (or a cancelled line) of a re-sent order counts as
# known as soon as any line of that order is.
ORDER_KEYS = {
    "header": ["eCom_Store_ID", "Transaction_Nbr", "Order_Date"],
    "payment": ["eCom_Store_ID", "Transaction_Nbr", "Order_Date"],
    "line": ["eCom_Store_ID", "Transaction_Nbr", "Order_Date"],
    "cancel": ["Store", "Weborder_Id", "Order_Date"],
}

# Default keys: as above, and the item number where a fact has one row per item, so that
# a late line of a known order is still added, and the tender of a payment, so that the
# tenders of an order may come in several loads.
PRIMARY_KEYS = {
    **ORDER_KEYS,
    "line": ORDER_KEYS["line"] + ["ItmSeqNum"],
    "payment": ORDER_KEYS["payment"] + ["Tender"],
    "cancel": ORDER_KEYS["cancel"] + ["Line"],
}

FILE_WORD = {"header": "Transaction", "line": "Line", "payment": "Payment", "cancel": "Cancel"}
FILE_SEPARATOR = {"header": ",", "line": ",", "payment": ",", "cancel": "|"}
BUSINESS_DATE_COLUMN = {
    "header": "Order_Date",
    "line": "Order_Date",
    "payment": "Order_Date",
    "cancel": "Status_Date",
}

FLOW_GLOBS = {
    "sales_envelope": "*-Sales-*.json",
    "cancel_envelope": "*-Cancel-*.json",
    "form_feed": "*.txt",
    "flat_sales": "FY*.csv",
    "flat_cancel": "JP_cancellation*.csv",
    "conformed_header": "demand_transaction_recovery_file*.csv",
    "conformed_line": "demand_line_recovery_file*.csv",
    "conformed_payment": "demand_payment_recovery_file*.csv",
    "conformed_cancel": "cancel_recovery_file*.csv",
}
