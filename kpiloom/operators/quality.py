"""Checks on the way into the tables: declared types, and mandatory fields before NULLs are rendered as text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions.text import is_blank

FLAG = "mandatory_field_check"


def assign(df: DataFrame, schema: T.StructType, on_bad_value: str = "refuse", flag: str = FLAG) -> DataFrame:
    """The frame in the columns and types of a table.

    A column that the frame lacks is NULL. Refused, with a ValueError, are columns that the
    table lacks and types that have no cast, such as lists. A text that is no value of a
    number's type stops the load when the batch is landed ("refuse"), or marks its row
    invalid, the value being NULL then ("quarantine"). Blank texts are NULL.
    """
    if on_bad_value not in ("refuse", "quarantine"):
        raise ValueError(f"unknown policy for bad values: {on_bad_value}")
    have = {f.name: f.dataType for f in df.schema}
    if extra := sorted(set(have) - {f.name for f in schema} - {flag}):
        raise ValueError(f"columns that the table lacks: {extra}")
    columns: list[Column] = []
    bad: list[Column] = []
    for f in schema:
        source = have.get(f.name)
        if source is None or isinstance(source, T.NullType):
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        if not isinstance(source, T.AtomicType):
            raise ValueError(f"{f.name} is {source.simpleString()}, the table has {f.dataType.simpleString()}")
        value = F.col(f.name)
        cast = value if source == f.dataType else value.try_cast(f.dataType)
        if isinstance(source, T.StringType) and source != f.dataType:
            wrong = cast.isNull() & ~is_blank(F.trim(value))
            if on_bad_value == "refuse":
                told = F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), value)
                cast = F.when(wrong, F.raise_error(told).cast(f.dataType)).otherwise(cast)
            else:
                bad.append(wrong)
        columns.append(cast.alias(f.name))
    if bad or flag in have:
        before = F.coalesce(F.col(flag), F.lit(True)) if flag in have else F.lit(True)
        columns.append((before & ~reduce(or_, bad, F.lit(False))).alias(flag))
    return df.select(*columns)


def check_mandatory(df: DataFrame, fields: Sequence[str], flag: str = FLAG) -> DataFrame:
    """Sets the flag to false where a field is NULL or ''; a row once false stays false."""
    faults = [is_blank(F.col(name).cast("string")) for name in fields]
    if flag in df.columns:
        faults.append(~F.coalesce(F.col(flag), F.lit(True)))
    return df.withColumn(flag, ~reduce(or_, faults, F.lit(False)))


def split_valid(df: DataFrame, flag: str = FLAG) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows."""
    return df.filter(F.col(flag)), df.filter(~F.col(flag))
