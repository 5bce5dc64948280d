"""Projections of the four facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom import contracts
from kpiloom.functions.text import const
from kpiloom.operators.joins import join_tender


def to_header(df: DataFrame, charges: bool = False) -> DataFrame:
    """Header fact, 19 columns, or 24 with CoD, shipping and line total."""
    return df.select(*contracts.HEADER_COLUMNS, *(contracts.HEADER_CHARGE_COLUMNS if charges else []))


def to_line(df: DataFrame, **columns: Column) -> DataFrame:
    """Line fact, 17 columns: each from `columns` or else from the frame."""
    return df.select(*[columns.get(name, F.col(name)).alias(name) for name in contracts.LINE_COLUMNS])


def to_payment(df: DataFrame, tender_map: DataFrame, on: dict[str, str], policy: str = "null") -> DataFrame:
    """Payment fact, 6 columns, with the tender's label in place of its id."""
    labelled = join_tender(df, tender_map, on, policy)
    return labelled.select(
        *[F.col("TenderType" if name == "Tender" else name).alias(name) for name in contracts.PAYMENT_COLUMNS]
    )


def to_cancel(df: DataFrame, **columns: Column) -> DataFrame:
    """Cancel fact, 35 columns: each from `columns`, else a constant of the fact."""
    defaults = {
        "Status": F.lit(contracts.CANCEL_STATUS),
        "Status_Text": F.lit(contracts.CANCEL_STATUS_TEXT),
        "Order_Entry_Method": F.lit(contracts.CHANNEL),
    }
    available = defaults | columns
    return df.select(
        *[available.get(name, const(None, "string")).alias(name) for name in contracts.CANCEL_COLUMNS]
    )
