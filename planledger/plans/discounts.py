"""Additional (parametrised) discounts and punctual promotions per subscriber."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from planledger import config as C
from planledger.functions.text import blank_zeros, parse_amount, parse_number
from planledger.operators.filters import promo_dates
from planledger.operators.joins import split_join
from planledger.operators.reduce import (
    number_slots, spread_by_kind, spread_by_slot, top_pair,
)

SUBSCRIBER = "subscriber_key"
PRODUCT_ID = "assigned_product_id"
PRODUCT = "assigned_product_key"
RAW = "parameter_value"
PROMO_RAW = "billing_attribute_default_val"
AMOUNTS = ("amount_data", "amount_voice")
TYPES = ("type_data", "type_voice")
_PAIR = [SUBSCRIBER, PRODUCT_ID]


def _ranked(raw: Column) -> Column:
    """An amount that compares by its number first and keeps its text."""
    return F.when(raw.isNotNull(), F.struct(parse_number(raw).alias("number"), raw.alias("text")))


def parameter_kinds(
    params: DataFrame, rules: dict[str, Column], amounts: dict[str, Column] | None = None
) -> DataFrame:
    """Per assigned product its two discount amounts and two discount types."""
    raw = F.col(RAW)
    values = {kind: _ranked(raw) for kind in AMOUNTS}
    values.update({kind: _ranked(col) for kind, col in (amounts or {}).items()})
    values.update({kind: raw for kind in TYPES})
    return spread_by_kind(params, PRODUCT, rules, values)


def _texts(df: DataFrame) -> DataFrame:
    return df.withColumns({kind: F.col(kind)["text"] for kind in AMOUNTS})


def discounts_by_kind(
    products: DataFrame, params: DataFrame, rules: dict[str, Column]
) -> DataFrame:
    """Daily v1: the largest amount and the largest type of each service, chosen apart.

    Zero amounts are blank. The type is shown only next to an amount, later on.
    """
    raw = blank_zeros(F.col(RAW))
    kinds = parameter_kinds(params, rules, {kind: raw for kind in AMOUNTS})
    joined = split_join(products.select(PRODUCT, SUBSCRIBER), kinds, PRODUCT, "inner")
    best = [F.max(kind).alias(kind) for kind in (*AMOUNTS, *TYPES)]
    return _texts(joined.groupBy(SUBSCRIBER).agg(*best))


def discounts_by_pair(
    products: DataFrame, params: DataFrame, rules: dict[str, Column]
) -> DataFrame:
    """Monthly: the largest amount of each service with the type of the same assigned product.

    Data amounts must be numbers other than 0; voice amounts any text but "0".
    """
    raw = F.col(RAW)
    kinds = parameter_kinds(params, rules, {
        "amount_data": F.when(parse_amount(raw) != 0, raw),
        "amount_voice": F.when(raw != "0", raw),
    })
    joined = split_join(products.select(PRODUCT, SUBSCRIBER), kinds, PRODUCT, "inner")
    best = joined.groupBy(SUBSCRIBER).agg(
        top_pair("amount_data", "type_data").alias("data"),
        top_pair("amount_voice", "type_voice").alias("voice"),
    )
    return _texts(best.select(SUBSCRIBER, "data.*", "voice.*"))


def discounts_of_latest(
    latest: DataFrame, params: DataFrame, rules: dict[str, Column]
) -> DataFrame:
    """Daily v2: all four values of the subscriber's latest parametrised product."""
    kinds = parameter_kinds(params, rules)
    joined = latest.select(PRODUCT, SUBSCRIBER).join(kinds, PRODUCT)
    return _texts(joined.drop(PRODUCT))


def promo_lines(
    products: DataFrame, offers: DataFrame, values: DataFrame, unique: bool
) -> DataFrame:
    """The first promo lines of each subscriber, numbered by product key.

    A line is a live promo offer of a live promo product with one of the
    product's promo values. With ``unique`` equal lines count once (monthly),
    otherwise every repetition takes a slot (daily): assigned products are then
    counted rather than joined row by row, and repetitions beyond the number of
    slots are left out, which cannot show in the result.
    """
    order = ["product_key", PROMO_RAW, "inicio", "fin"]
    lines = promo_dates(
        split_join(
            offers.select(*_PAIR, "product_key", "provision_date"), values, "product_key", "inner"
        )
    ).select(*_PAIR, *order)
    if unique:
        matched = lines.join(products.select(*_PAIR), _PAIR, "left_semi")
        return number_slots(matched.select(SUBSCRIBER, *order).distinct(), SUBSCRIBER, order)
    first = number_slots(lines, _PAIR, order).drop("slot")
    copies = products.groupBy(*_PAIR).agg(F.count("*").alias("copies"))
    repeated = first.join(copies, _PAIR).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(C.PROMO_SLOTS)).cast("int")))
    )
    return number_slots(repeated.select(SUBSCRIBER, *order), SUBSCRIBER, order)


def promo_slots(lines: DataFrame) -> DataFrame:
    """Promo lines spread over the slots; the type of a v1 promo is always Percent."""
    valued = lines.withColumn("value", parse_amount(F.col(PROMO_RAW), zero_as_null=True))
    typed = valued.withColumn("kind", F.when(F.col("value").isNotNull(), "Percent"))
    spread = spread_by_slot(typed, SUBSCRIBER, "slot", ["value", "kind", "inicio", "fin"])
    return spread.withColumn("has_slot", F.lit(True))


def promo_slots_v2(offers: DataFrame, values: DataFrame) -> DataFrame:
    """Daily v2: the first five offers by provision date, valued afterwards.

    An offer without a promo value still takes its slot. The dates are shown
    only next to a number.
    """
    columns = [SUBSCRIBER, PRODUCT_ID, "product_key", "provision_date"]
    numbered = number_slots(
        offers.select(*columns), SUBSCRIBER, ["provision_date"], ["product_key", PRODUCT_ID]
    )
    lines = promo_dates(split_join(numbered, values, "product_key", "left"))
    known = F.col("value").isNotNull()
    dated = lines.withColumns({name: F.when(known, F.col(name)) for name in ("inicio", "fin")})
    return spread_by_slot(dated, SUBSCRIBER, "slot", ["value", "kind", "inicio", "fin"])
