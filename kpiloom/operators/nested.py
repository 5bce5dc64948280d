"""Explodes of nested envelopes. All are map-only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.sources.readers import SOURCE_FILE

# Elements made by one row before the range is spread further; see explode_range.
RANGE_CHUNK = 100_000


def expand(df: DataFrame, struct_col: str, *carried: str) -> DataFrame:
    """Struct fields as columns, with the named other columns in front."""
    return df.select(*carried, f"{struct_col}.*")


def explode_orders(envelopes: DataFrame) -> DataFrame:
    """One row per order. A page with an empty or missing array gives none."""
    carried = [c for c in [SOURCE_FILE] if c in envelopes.columns]
    orders = envelopes.select(*carried, F.explode("orders").alias("o"))
    return expand(orders, "o", *carried)


def explode_lines(orders: DataFrame) -> DataFrame:
    return expand(orders.select(F.explode("Order_Lines").alias("l")), "l")


def explode_payments(orders: DataFrame) -> DataFrame:
    """One row per payment, with the country of its order."""
    return expand(orders.select("Country", F.explode("Order_Payments").alias("p")), "p", "Country")


def explode_range(df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """One row per number in [first, last].

    In two steps, so that a wide range is never one array in memory.
    """
    bounds = df.select("*", first.cast("long").alias("__lo"), last.cast("long").alias("__hi"))
    chunks = bounds.filter(F.col("__lo") <= F.col("__hi")).withColumn(
        "__chunk", F.explode(F.sequence(F.col("__lo"), F.col("__hi"), F.lit(RANGE_CHUNK)))
    )
    chunk_end = F.least(F.col("__hi"), F.col("__chunk") + F.lit(RANGE_CHUNK - 1))
    return chunks.withColumn(name, F.explode(F.sequence(F.col("__chunk"), chunk_end))).drop("__lo", "__hi", "__chunk")
