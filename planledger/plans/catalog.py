"""Everything known per product, gathered in one row per product key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from planledger import config as C
from planledger.functions.text import contains_in_order, parse_amount, parse_number
from planledger.operators.filters import products

KEY = "product_key"


def word_rules(col: Column, words: dict[str, tuple[str, ...]]) -> dict[str, Column]:
    """One predicate per kind: its words occur in order, in any case."""
    return {kind: contains_in_order(col, *parts) for kind, parts in words.items()}


def name_rules(col: Column, names: dict[str, str]) -> dict[str, Column]:
    """One predicate per kind: the trimmed text equals the kind's name."""
    return {kind: F.trim(col) == name for kind, name in names.items()}


def gather(*parts: DataFrame, key: str = KEY) -> DataFrame:
    """One row per key from frames that each know some of its columns.

    The frames are stacked and grouped once, which takes one shuffle however
    many there are, keeps keys that only some of them have, and reduces
    repeated keys to their largest values.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = [name for name in stacked.columns if name != key]
    return stacked.groupBy(key).agg(*[F.max(name).alias(name) for name in values])


def plan_catalog(
    tables: dict[str, DataFrame],
    charges: DataFrame,
    kind_rules: dict[str, Column],
    value: Column,
) -> DataFrame:
    """Description, creation date, charges of four kinds and list flags per plan.

    A charge kind without rows stays null. ``known`` is set for the keys that have a
    product row. ``charges`` are the billing
    parameters in force and ``value`` reads the amount of one of them. The
    end-of-cycle list may be missing from ``tables``.
    """
    parts = [
        products(tables["product"], (KEY, "product_desc")).withColumn("known", F.lit(True)),
        tables["product_catalog"].select(KEY, "product_valid_from_date"),
        charges.select(KEY, *[F.when(rule, value).alias(kind) for kind, rule in kind_rules.items()]),
        tables["plan_list"].select(
            KEY,
            F.lit(True).alias("in_ppu"),
            F.col("descripcion").isNotNull().alias("in_ppu_named"),
        ),
    ]
    if "cycle_discounts" in tables:
        parts.append(tables["cycle_discounts"].select(
            KEY,
            F.col("product_desc").alias("cycle_desc"),
            F.col("product_desc").isNotNull().alias("in_cycle"),
        ))
    catalog = gather(*parts).filter(F.col(KEY).isNotNull())
    if "cycle_discounts" in tables:
        return catalog
    return catalog.withColumns({
        "cycle_desc": F.lit(None).cast("string"), "in_cycle": F.lit(None).cast("boolean"),
    })


def promo_catalog_v2(tables: dict[str, DataFrame], params: DataFrame) -> DataFrame:
    """Per product its numeric promo value, its non-numeric one, and the promo's length."""
    raw = F.col("billing_attribute_default_val")
    numeric = parse_amount(raw).isNotNull()
    return gather(
        products(tables["product"], (
            KEY, "price_plan_promotion_interval", "price_plan_promotion_duration",
        )),
        params.select(
            KEY,
            F.when(numeric, parse_number(raw)).alias("value"),
            F.when(~numeric, raw).alias("kind"),
        ),
    ).filter(F.col(KEY).isNotNull())


def first_of_kinds(kinds: tuple[str, ...] = C.CHARGE_KINDS) -> list[Column]:
    """The charge columns with absent charges as 0."""
    return [F.coalesce(kind, F.lit(0)).alias(kind) for kind in kinds]
