"""Grouping, ranking and spreading, all safe for keys that hold a large share of the rows.

Best-row choices are ``max(struct(...))`` aggregates and slot numbering is a
``row_number`` with an upper limit; both reduce every key inside the map tasks
before the shuffle, so no task ever sees all rows of a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from planledger import config as C
from planledger.functions.calendar import in_period

_BEST = "__best"


def best_row(
    df: DataFrame, key: str | list[str], order: list[str], tie_break: list[str] | None = None
) -> DataFrame:
    """One row per key: the largest by ``order``, all descending with nulls last.

    ``tie_break`` columns decide equal rows; by default every other column, so
    the choice never depends on the order or partitioning of the input.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranked = list(order) + list(tie_break or [])
    ranked += [name for name in df.columns if name not in ranked and name not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(*ranked)).alias(_BEST))
        .select(*[
            F.col(name) if name in keys else F.col(_BEST)[name].alias(name)
            for name in df.columns
        ])
    )


def latest_per(
    df: DataFrame, key: str | list[str], order: str, tie_break: list[str] | None = None
) -> DataFrame:
    """The row with the latest ``order`` per key."""
    return best_row(df, key, [order], tie_break)


def number_slots(
    df: DataFrame,
    key: str | list[str],
    order: list[str],
    tie_break: list[str] | None = None,
    slot: str = "slot",
    n: int = C.PROMO_SLOTS,
) -> DataFrame:
    """Number the first ``n`` rows of each key, ascending with nulls first.

    The report has ``n`` slots; Spark applies the limit before the shuffle too,
    so each map task passes on at most ``n`` rows of a key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranked = list(order) + list(tie_break or [])
    ranked += [name for name in df.columns if name not in ranked and name not in keys]
    window = Window.partitionBy(*keys).orderBy(*[F.col(name).asc() for name in ranked])
    return df.withColumn(slot, F.row_number().over(window)).filter(F.col(slot) <= n)


def spread_by_slot(
    df: DataFrame, key: str | list[str], slot: str, values: list[str], n: int = C.PROMO_SLOTS
) -> DataFrame:
    """One row per key with columns ``value_1 .. value_n`` for each of ``values``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*[
        F.max(F.when(F.col(slot) == k, F.col(value))).alias(f"{value}_{k}")
        for k in range(1, n + 1)
        for value in values
    ])


def spread_by_kind(
    df: DataFrame,
    keys: str | list[str],
    kind_rules: dict[str, Column],
    value: Column | dict[str, Column],
    fill: object = None,
) -> DataFrame:
    """One row per key with one column per kind: the largest value among rows of that kind.

    A row may be of several kinds. ``value`` is shared or given per kind.
    ``fill`` stands in for a value that is null and for a kind without rows.
    """
    names = [keys] if isinstance(keys, str) else list(keys)

    def column(kind: str, rule: Column) -> Column:
        source = value[kind] if isinstance(value, dict) else value
        if fill is None:
            return F.max(F.when(rule, source)).alias(kind)
        largest = F.max(F.when(rule, F.coalesce(source, F.lit(fill))))
        return F.coalesce(largest, F.lit(fill)).alias(kind)

    return df.groupBy(*names).agg(*[column(kind, rule) for kind, rule in kind_rules.items()])


def top_pair(amount: str, kind: str) -> Column:
    """Aggregate: the largest non-null amount together with its type, as a struct."""
    return F.max(F.when(F.col(amount).isNotNull(), F.struct(amount, kind)))


def best_pair(
    df: DataFrame, key: str, pair_key: str, amount: str, kind: str
) -> DataFrame:
    """Per key the largest amount with the type that belongs to the same ``pair_key``.

    Rows may carry either of the two. An amount without type gives (amount,
    null); a type without amount gives nothing, so the key keeps two nulls.
    """
    pairs = df.groupBy(key, pair_key).agg(F.max(amount).alias(amount), F.max(kind).alias(kind))
    best = pairs.groupBy(key).agg(top_pair(amount, kind).alias(_BEST))
    return best.select(
        key, F.col(_BEST)[amount].alias(amount), F.col(_BEST)[kind].alias(kind)
    )


def billed_month(
    detail: DataFrame,
    period: str,
    segments: tuple | None = C.BILLING_SEGMENTS,
    categories: tuple | None = C.PAYMENT_CATEGORIES,
    codes: tuple = C.CHARGE_CODES,
    key: str = "subscriber_key",
    billed: str = "bill_date",
    amount: str = "charge_amount",
    segment: str = "customer_sub_type_desc",
    category: str = "payment_category_desc",
    code: str = "charge_code_id",
    total: str = "arpu",
) -> DataFrame:
    """Billed recurring charges per subscriber in a ``yyyyMM`` period."""
    rows = recurring_charges(detail, segments, categories, codes, segment, category, code)
    return rows.filter(in_period(F.col(billed), period)).groupBy(key).agg(F.sum(amount).alias(total))


def recurring_charges(
    detail: DataFrame,
    segments: tuple | None = C.BILLING_SEGMENTS,
    categories: tuple | None = C.PAYMENT_CATEGORIES,
    codes: tuple = C.CHARGE_CODES,
    segment: str = "customer_sub_type_desc",
    category: str = "payment_category_desc",
    code: str = "charge_code_id",
) -> DataFrame:
    """Billing lines of recurring charges to business customers."""
    condition = F.col(code).isin(*codes)
    if segments is not None:
        condition = condition & F.col(segment).isin(*segments)
    if categories is not None:
        condition = condition & F.col(category).isin(*categories)
    return detail.filter(condition)
