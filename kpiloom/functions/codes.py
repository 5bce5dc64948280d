"""Code to label expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom import contracts
from kpiloom.functions.text import is_blank


def code_label(code: Column, labels: Sequence[str], default: Column) -> Column:
    """Label number `code` (from 1) of `labels`, `default` outside of the range."""
    label = F.element_at(F.array(*map(F.lit, labels)), code)
    return F.when(code.between(1, len(labels)), label).otherwise(default.cast("string"))


def device_label(
    code: Column,
    labels: Sequence[str] = contracts.DEVICE_LABELS_4,
    default: Column | None = None,
) -> Column:
    return code_label(code, labels, F.lit("OTHER") if default is None else default)


def by_value(c: Column, mapping: Mapping[str, str], default: Column) -> Column:
    """Value map as one CASE expression, kept in the code-generated path."""
    chain = F
    for value, label in mapping.items():
        chain = chain.when(c == F.lit(value), F.lit(label))
    return chain.otherwise(default)


def store_from_type(
    item_type: Column,
    mapping: Mapping[str, str] = contracts.STORE_BY_ITEM_TYPE,
    default: str = contracts.STORE_OTHERWISE,
) -> Column:
    return by_value(item_type, mapping, F.lit(default))


def country_from_store(store: Column, mapping: Mapping[str, str] = contracts.COUNTRY_BY_STORE) -> Column:
    return by_value(store, mapping, F.lit(None).cast("string"))


def coupon_flag(coupon: Column) -> Column:
    return F.when(is_blank(coupon), F.lit("N")).otherwise(F.lit("Y"))


def gift_flag(c: Column) -> Column:
    """0 for '', 1 for everything else. NULL counts as a gift, as the feed's owner defines it."""
    return F.when(c == F.lit(""), F.lit(0)).otherwise(F.lit(1))


def tender_label(tender_type: Column, policy: str = "null") -> Column:
    """Label of a tender that may have found no match: `null` keeps NULL, `other` says OTHER."""
    if policy == "other":
        return F.coalesce(tender_type, F.lit("OTHER"))
    if policy == "null":
        return tender_type
    raise ValueError(f"unknown tender policy: {policy}")
