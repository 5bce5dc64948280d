"""KPI measures. Each takes the feed's raw text columns and gives a double.

`col` in the signatures maps a raw field name to its Column, so that the same
formulas serve flat files (a column per field) and parsed form records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.functions.text import is_blank, to_double

Fields = Callable[[str], Column]

GIFT_TAX_RATE = 0.1
RECOVERY_TAX_RATE = 1.1
SURCHARGED_TYPE = "C"


def _less(first: Column, *rest: Column) -> Column:
    for term in rest:
        first = first - term
    return first


def _only_surcharged(item_type: Column, amount: Column) -> Column:
    """The amount on surcharged items, 0 on all others."""
    return F.when(item_type == F.lit(SURCHARGED_TYPE), amount).otherwise(F.lit(0.0))


def number(field: str, col: Fields = F.col) -> Column:
    """A raw amount: freight, CoD, shipping, tax, coupon, line total, tender amount."""
    return to_double(col(field))


def demand_gross(col: Fields = F.col) -> Column:
    return number("TEIKA_SUM", col) + number("TEIKA_SUM_TAX", col)


def demand_net_normal(col: Fields = F.col) -> Column:
    deductions = ["TAX", "DAIBIKI", "SORYO", "COUPON_WARIBIKI", "FREE_ITEM11"]
    return _less(number("SEIKYU", col), *(number(field, col) for field in deductions))


def demand_net_recovery(col: Fields = F.col) -> Column:
    """Charged total without tax; NULL when the CoD charge is NULL, although it cancels out."""
    cod = number("DAIBIKI", col)
    return _less(number("SEIKYU", col), number("TAX", col), cod) + cod


def header_discount(item_type: Column, surcharge: str, col: Fields = F.col) -> Column:
    return _less(number("SHIRE_SUM", col), number("TEIKA_SUM", col)) + _only_surcharged(
        item_type, number(surcharge, col)
    )


def header_cancel_discount(item_type: Column, col: Fields = F.col) -> Column:
    listed = number("SHIRE_SUM", col) + number("FREE_ITEM33", col)
    return listed - _only_surcharged(item_type, number("TEIKA_SUM", col))


def gift_tax(gift_charge: Column) -> Column:
    return gift_charge * F.lit(GIFT_TAX_RATE)


def line_net_normal(col: Fields = F.col) -> Column:
    return number("TEIKA", col) * number("QUANTITY", col)


def line_net_recovery(col: Fields = F.col, rate: float = RECOVERY_TAX_RATE) -> Column:
    return number("ORDER_D_SHIRE_PRICE", col) * F.lit(rate)


def line_discount(item_type: Column, list_price: Column, price: Column, quantity: Column, surcharge: Column) -> Column:
    return (list_price + _only_surcharged(item_type, surcharge) - price) * quantity


def line_cancel_total(quantity: Column, col: Fields = F.col) -> Column:
    return demand_gross(col) * quantity


def line_cancel_discount(item_type: Column, col: Fields = F.col) -> Column:
    surcharge = _only_surcharged(item_type, number("FREE_ITEM33", col))
    return number("SHIRE_SUM", col) + surcharge - number("TEIKA_SUM", col)


def amount_or_zero(c: Column, null_is_zero: bool = False) -> Column:
    """'' -> 0, and NULL too when asked; malformed text -> NULL."""
    empty = is_blank(c) if null_is_zero else c == F.lit("")
    return F.when(empty, F.lit(0.0)).otherwise(to_double(c))
