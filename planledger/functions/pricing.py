"""Fixed charges, net revenue and stacked promotions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from planledger.functions.text import parse_amount, parse_number


def _or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def to_whole(col: Column) -> Column:
    """Truncated toward zero, as bigint."""
    return col.try_cast("bigint")


def total_fixed(
    charge_data: Column,
    charge_voice: Column,
    discount_data: Column,
    discount_voice: Column,
    null_as_zero: bool = True,
) -> Column:
    """Both charges less both discounts. A missing term counts as 0 or voids the total."""
    terms = [charge_data, charge_voice, discount_data, discount_voice]
    if null_as_zero:
        terms = [_or_zero(term) for term in terms]
    return terms[0] + terms[1] - terms[2] - terms[3]


def net_service(
    charge: Column, discount: Column, amount: Column, kind: Column, truncate: bool = False
) -> Column:
    """Charge less multi-product discount, less the additional discount.

    A ``Fixed`` (or untyped) amount is subtracted, any other type is a
    percentage. No amount means no reduction; an amount that is present but not
    a number makes a fixed price unknown and leaves a percentage price as it is.
    """
    base = charge - discount
    value = F.when(amount.isNull(), F.lit(0.0)).otherwise(parse_number(amount))
    percent = F.when(
        _or_zero(parse_amount(amount)) != 0, base * (F.lit(100) - value) / F.lit(100)
    ).otherwise(base)
    net = F.when(F.coalesce(kind, F.lit("Fixed")) == "Fixed", base - value).otherwise(percent)
    return to_whole(net) if truncate else net


def visible_type(amount: Column, kind: Column) -> Column:
    """The discount type, shown only next to an amount."""
    return F.when(amount.isNotNull(), kind)


def stacked_total(base: Column, slots: list[Column]) -> Column:
    """``base`` after each percentage in turn, truncated toward zero; empty slots are 0 %."""
    kept = [(F.lit(100) - _or_zero(slot)) / F.lit(100) for slot in slots]
    return to_whole(reduce(lambda total, share: total * share, kept, base))


def floored(total: Column) -> Column:
    """Negative totals become 0; an unknown total stays unknown."""
    return F.when(total < 0, F.lit(0)).otherwise(total)
