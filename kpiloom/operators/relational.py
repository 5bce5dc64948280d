"""Small relational operators: routing, renaming, totals, business date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.dates import parse_output_time


def split_cancelled(df: DataFrame, column: str = "Cancel_Date") -> tuple[DataFrame, DataFrame]:
    """(demand, cancelled) rows."""
    return df.filter(F.col(column).isNull()), df.filter(F.col(column).isNotNull())


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns; the plan reads nothing."""
    return df.filter(F.lit(False))


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def derive(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """Derived columns next to the kept ones, in a single projection.

    Every expression sees the raw columns: a derived `Tax` does not replace the
    raw `TAX` for the expressions after it, although names ignore case.
    """
    kept = df.columns if keep is None else keep
    taken = {name.lower() for name in columns}
    return df.select(
        *[F.col(name) for name in kept if name.lower() not in taken],
        *[expression.alias(name) for name, expression in columns.items()],
    )


def order_total(df: DataFrame, key: str, amount: Column, name: str) -> DataFrame:
    """Adds the sum of `amount` over all rows of the same key.

    The sum is taken per key before any row moves and joined back, so no task
    ever holds all rows of a key: the join splits a hot key. NULL keys form one group.
    """
    totals = df.groupBy(F.col(key).alias("__key")).agg(F.sum(amount).alias(name))
    return df.join(totals, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")


def earliest_date(column: str, fallback: Column | None = None) -> Column:
    """Aggregate: the earliest date of an output; else the earliest `fallback` (say, the file's date)."""
    earliest = F.min(parse_output_time(F.col(column))).cast("date")
    return earliest if fallback is None else F.coalesce(earliest, F.min(fallback))


def business_date(df: DataFrame, column: str, fallback: Column | None = None) -> date | None:
    """`earliest_date` of all rows, as a value for file names."""
    return df.agg(earliest_date(column, fallback).alias("d")).first().d
