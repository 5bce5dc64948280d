"""Text and cast expressions (Column -> Column), safe under ANSI mode."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and sentinels of the feeds.
ORDER_PREFIX = r"^(?:ORDER|e)"
SEQUENCE_SUFFIX = r"_(\d+)$"
SEQUENCED_NAME = r"^(.+?)_(?:\d+)$"
NULL_TEXT = "NULL"
SOURCE_NULL_TEXT = "(NULL)"


def form_decode(c: Column) -> Column:
    """Form-URL decoding; malformed text gives NULL."""
    return F.try_url_decode(c)


def split_on(c: Column, literal: str) -> Column:
    """Split at a literal separator."""
    return F.split(c, re.escape(literal))


def before_first(c: Column, literal: str) -> Column:
    return F.substring_index(c, literal, 1)


def after_first(c: Column, literal: str) -> Column:
    """Everything behind the first separator; '' when there is none."""
    cut = F.instr(c, literal)
    return F.when(cut > 0, F.substr(c, cut + F.lit(len(literal)))).when(c.isNotNull(), F.lit(""))


def seq_suffix(name: Column) -> Column:
    """`TEIKA_2` -> `2`, as text; NULL for a name without number suffix."""
    return F.nullif(F.regexp_extract(name, SEQUENCE_SUFFIX, 1), F.lit(""))


def base_name(name: Column) -> Column:
    """`TEIKA_2` -> `TEIKA`; NULL for a name without number suffix."""
    return F.nullif(F.regexp_extract(name, SEQUENCED_NAME, 1), F.lit(""))


def strip_order_prefix(c: Column) -> Column:
    return F.regexp_replace(c, ORDER_PREFIX, "")


def lead_code(c: Column) -> Column:
    """First character as integer, NULL when it is no digit."""
    return F.left(c, F.lit(1)).try_cast("int")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def is_blank(c: Column) -> Column:
    """True for NULL and ''."""
    return F.coalesce(c, F.lit("")) == F.lit("")


def null_text(c: Column) -> Column:
    """NULL -> the text `NULL`."""
    return F.coalesce(c.cast("string"), F.lit(NULL_TEXT))


def sentinel_text(c: Column) -> Column:
    """NULL and the source's `(NULL)` -> the text `NULL`."""
    return null_text(F.nullif(c, F.lit(SOURCE_NULL_TEXT)))


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_int(c: Column) -> Column:
    return c.try_cast("int")


def to_dec2(c: Column) -> Column:
    return c.try_cast("decimal(38,2)")


def fmt2(c: Column) -> Column:
    """Two-decimal text of a number; NULL stays NULL."""
    number = c.cast("double")
    return F.when(number.isNotNull(), F.format_string("%.2f", number))


def dec2_text(c: Column) -> Column:
    """Two-decimal text of a decimal; NULL stays NULL."""
    return to_dec2(c).cast("string")


def const(value: object, data_type: str) -> Column:
    """Typed constant, typed NULL included."""
    return F.lit(value).cast(data_type)
