"""The list of plans that end their discount with the billing cycle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from planledger.functions.text import clean_offer_code
from planledger.operators.joins import enrich


def ingest_cycle_discounts(
    offers: DataFrame, product: DataFrame, code: str = "applied_to_ind",
    key: str = "product_key", desc: str = "product_desc",
) -> DataFrame:
    """Distinct (product key, description) of the products that discount offers name.

    The key is what remains of the offer code without its delimiters. Offers are
    reduced to their distinct keys first; keys of unknown or nameless products
    drop out.
    """
    keys = offers.select(F.trim(clean_offer_code(F.col(code))).alias(key)).distinct()
    named = product.select(key, desc).filter(F.col(desc).isNotNull())
    return enrich(named, keys, key, "left_semi").distinct()
