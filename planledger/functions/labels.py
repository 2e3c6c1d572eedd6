"""Discount-mix label, usability flag, product kind and plan description."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from planledger.functions.text import contains_in_order

# The label parts and flags written to the report.
BASE_LABEL = "MULTIPRODUCTO"
PARAMETER_LABEL = "PARAMETRIZABLE"
CYCLE_LABEL = "FIN DE CICLO"
PROMO_LABEL = "PUNTUAL"
PRICE_CAP = 30000
CAP_FROM_YEAR = 2020


def mix_label(has_param: Column, in_cycle: Column, has_promo: Column) -> Column:
    """The kinds of discount a subscriber has, joined by ``+``: one of eight labels."""
    return F.concat_ws(
        "+",
        F.lit(BASE_LABEL),
        F.when(has_param, PARAMETER_LABEL),
        F.when(in_cycle, CYCLE_LABEL),
        F.when(has_promo, PROMO_LABEL),
    )


def mix_label_v2_legacy(
    has_data: Column, has_voice: Column, in_cycle: Column, has_promo: Column
) -> Column:
    """The label as the second daily job wrote it.

    It differs only where an end-of-cycle plan meets a promo: there "no voice
    discount" counted as parametrised, and a voice-only discount as none at all.
    """
    both = in_cycle & has_promo
    return F.when(
        both, F.when(has_data | ~has_voice, mix_label(F.lit(True), F.lit(True), F.lit(True)))
        .otherwise(BASE_LABEL)
    ).otherwise(mix_label(has_data | has_voice, in_cycle, has_promo))


def usable_flag(
    label: Column, total: Column, created: Column, in_list: Column, cap_rule: bool = True
) -> Column:
    """NO for end-of-cycle plans, negative totals, dear recent plans and unlisted free ones.

    An unknown total fails none of the price tests, so such a row stays usable.
    """
    bad = contains_in_order(label, "FIN", "CICLO", fold=False) | (total < 0)
    if cap_rule:
        bad = bad | ((total > PRICE_CAP) & (F.year(created) >= CAP_FROM_YEAR))
    bad = bad | (~in_list & (total == 0))
    return F.when(bad, "NO").otherwise("SI")


def product_kind(known: Column, desc: Column) -> Column:
    """The kind the parc system knows, else one read from the plan description."""
    guessed = (
        F.when(contains_in_order(desc, "GPS") | contains_in_order(desc, "M2M"), "M2M")
        .when(contains_in_order(desc, "BAM") | contains_in_order(desc, "WIFI", "MOVIL"), "BAM")
        .otherwise("VOZ")
    )
    return F.coalesce(known, guessed)


def plan_desc(offer_key: Column, offer_desc: Column, assigned_desc: Column,
              plan_product: str = "2053") -> Column:
    """The offered product's own text when it is the plan product, else the assigned one's."""
    return F.when(offer_key == plan_product, offer_desc).otherwise(assigned_desc)
