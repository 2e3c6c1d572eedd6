"""Who is reported, on which plan, and the wide charges view."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from planledger import config as C
from planledger.functions.labels import plan_desc
from planledger.functions.text import contains_in_order
from planledger.operators.filters import (
    business_customers, current_billing_params, eligible_subscribers, live_offers, live_products,
    parameters, plan_dates, products, sub_types,
)
from planledger.operators.joins import enrich, role_join, split_join
from planledger.operators.reduce import best_row
from planledger.plans.catalog import first_of_kinds

SUBSCRIBER = "subscriber_key"
PRODUCT_ID = "assigned_product_id"
PLAN_FIELDS = ("product_key", "product_desc", "product_valid_from_date", "in_cycle", "in_ppu")


def _held(tables: dict[str, DataFrame], as_of: date) -> DataFrame:
    return live_products(
        tables["assigned_product"], (C.PLAN_PRODUCT, C.PARAMETER_PRODUCT), as_of
    ).select("product_key", SUBSCRIBER, "assigned_product_key", PRODUCT_ID, "start_date")


def _offered(tables: dict[str, DataFrame], as_of: date) -> DataFrame:
    return live_offers(tables["assigned_billing_offer"], (C.PLAN_PRODUCT,), as_of).select(
        SUBSCRIBER, PRODUCT_ID, F.col("product_key").alias("cod_plan_amdocs")
    )


def _plan_view(
    tables: dict[str, DataFrame], assigned: DataFrame, offers: DataFrame, cfg: C.JobConfig
) -> DataFrame:
    """Products with their subscribers, customers, offered plans and descriptions."""
    people = eligible_subscribers(tables["subscribers"]).select(
        SUBSCRIBER, "primary_resource_value", "customer_key", "original_activation_date"
    )
    customers = business_customers(tables["customer"], cfg.sub_type_keys).select(
        "customer_key", "rut_id", "customer_legal_name", "customer_sub_type_key",
        "billing_cycle_key",
    )
    names = products(tables["product"], ("product_key", "product_desc"))
    view = enrich(enrich(assigned, people, SUBSCRIBER, "inner"), customers, "customer_key", "inner")
    view = role_join(view, names, "product_key", "product_key", "held_")
    view = enrich(view, sub_types(tables["customer_sub_type"]), "customer_sub_type_key")
    view = enrich(view, offers, [SUBSCRIBER, PRODUCT_ID])
    view = role_join(view, names, "cod_plan_amdocs", "product_key", "offered_")
    view = role_join(
        view, plan_dates(tables["product_catalog"]), "offered_product_key", "product_key", "dated_"
    )
    return view.withColumns({
        "msisdn": F.col("primary_resource_value"),
        "sub_type": F.col("customer_sub_type_desc"),
        "product_desc": plan_desc(
            F.col("offered_product_key"), F.col("offered_product_desc"), F.col("held_product_desc"),
            C.PLAN_PRODUCT,
        ),
        "product_valid_from_date": F.col("dated_product_valid_from_date"),
    })


def charges_view(tables: dict[str, DataFrame], as_of: date, cfg: C.JobConfig = C.DAILY) -> DataFrame:
    """Every combination of live product, parameter, offered plan and billing parameter.

    17 columns. Its rows multiply by design: n products and m offers of one
    (subscriber, product id) give n * m rows, times their parameters and charges.
    The snapshots do not go through it, they aggregate each list before joining it;
    ``base_view`` has its distinct plan columns.
    """
    values = parameters(tables["assigned_product_parameter"]).select(
        "assigned_product_key", "assigned_product_parameter_id", "parameter_value"
    )
    charges = current_billing_params(
        tables["product_billing_parameters"], C.CHARGE_ATTRIBUTES
    ).select(
        F.col("product_key").alias("cod_plan_amdocs"),
        F.col("item_name").alias("prit"),
        F.col("billing_attribute_default_val").alias("charge_val"),
    )
    view = _plan_view(tables, _held(tables, as_of), _offered(tables, as_of), cfg)
    view = enrich(enrich(view, values, "assigned_product_key"), charges, "cod_plan_amdocs")
    return view.select(
        "rut_id", "customer_legal_name", "billing_cycle_key", SUBSCRIBER, "msisdn", "customer_key",
        "sub_type", "cod_plan_amdocs",
        F.when(F.col("product_key") != C.PLAN_PRODUCT, F.col("product_key")).alias("cod_dto_tipo"),
        "product_desc", "prit", "charge_val", "assigned_product_parameter_id", "parameter_value",
        "start_date", "original_activation_date", "product_valid_from_date",
    )


def base_view(tables: dict[str, DataFrame], as_of: date, cfg: C.JobConfig = C.DAILY) -> DataFrame:
    """What ``base_rows`` needs of the charges view, without its repetitions: products and
    offers are made distinct per (subscriber, product id) before they meet."""
    assigned = _held(tables, as_of).drop("assigned_product_key").distinct()
    return _plan_view(tables, assigned, _offered(tables, as_of).distinct(), cfg)


def reportable(tables: dict[str, DataFrame], cfg: C.JobConfig, v2: bool = False) -> DataFrame:
    """Subscribers that the report shows, with the customers they belong to."""
    subs = eligible_subscribers(tables["subscribers"], numeric_phone=v2).select(
        SUBSCRIBER, "customer_key", "primary_resource_value", "original_activation_date"
    )
    segments = (
        sub_types(tables["customer_sub_type"], cfg.sub_type_keys, C.SUB_TYPE_RELABEL)
        if v2 else sub_types(tables["customer_sub_type"])
    )
    customers = enrich(
        business_customers(tables["customer"], cfg.sub_type_keys).select(
            "customer_key", "rut_id", "customer_legal_name", "billing_cycle_key",
            "customer_sub_type_key",
        ),
        segments, "customer_sub_type_key", "inner" if v2 else "left",
    )
    return enrich(subs, customers, "customer_key", "inner")


def people(tables: dict[str, DataFrame], cfg: C.JobConfig, v2: bool = False) -> DataFrame:
    """One row per reportable subscriber with the customer it belongs to."""
    return best_row(
        reportable(tables, cfg, v2).select(
            SUBSCRIBER,
            F.col("rut_id").alias("rut"),
            F.col("customer_legal_name").alias("razon_social"),
            F.col("billing_cycle_key").alias("ciclo"),
            F.col("primary_resource_value").alias("msisdn"),
            "customer_key",
            F.date_format("original_activation_date", "yyyyMMdd").alias("fecha_activacion"),
            F.col("customer_sub_type_desc").alias("segmento"),
        ),
        SUBSCRIBER, ["rut"],
    )


def best_plans(
    assigned: DataFrame, offers: DataFrame, catalog: DataFrame, product: DataFrame
) -> DataFrame:
    """Per subscriber the live plan with the largest charges (data, voice, then discounts).

    ``assigned`` are the live products of the two charge families, ``offers``
    the live plan offers. Offers meet products by (subscriber, assigned product
    id); both sides are reduced to one row per pair first. An offered product
    that is the plan product itself brings its own description and may be hidden
    on its own, so the best such offer is kept beside the best other one. The
    creation date and the own description belong to the product row: an offered
    key without one has no date, and the assigned product's description.
    """
    pair = [SUBSCRIBER, PRODUCT_ID]
    fields = F.struct(*first_of_kinds(), *PLAN_FIELDS, "offered_key")
    own = F.col("product_key").eqNullSafe(C.PLAN_PRODUCT)
    valued = split_join(
        offers.select(*pair, "product_key"), catalog, "product_key", "left"
    ).withColumns({
        "product_valid_from_date": F.when(F.col("known"), F.col("product_valid_from_date")),
        "offered_key": F.when(F.col("known"), F.col("product_key")),
    })
    offered = valued.groupBy(*pair).agg(
        F.max(F.when(own, fields)).alias("own"), F.max(F.when(~own, fields)).alias("other")
    )
    # At most the two product keys that ``assigned`` was filtered by.
    held = assigned.groupBy(*pair).agg(F.collect_set("product_key").alias("assigned_keys"))
    candidates = (
        held.join(offered, pair, "left")
        .withColumn("plan", F.explode_outer(F.array_compact(F.array("own", "other"))))
        .select(SUBSCRIBER, "plan.*", F.explode("assigned_keys").alias("assigned_key"))
    )
    # One row per key of a fixed two-element list, hence safe to broadcast.
    names = (
        product.filter(F.col("product_key").isin(C.PLAN_PRODUCT, C.PARAMETER_PRODUCT))
        .groupBy(F.col("product_key").alias("assigned_key"))
        .agg(F.max("product_desc").alias("assigned_desc"))
    )
    described = candidates.join(F.broadcast(names), "assigned_key", "left").select(
        SUBSCRIBER, *first_of_kinds(), "product_key",
        plan_desc(
            F.col("offered_key"), F.col("product_desc"), F.col("assigned_desc"), C.PLAN_PRODUCT
        ).alias("plan"),
        "product_valid_from_date", "in_cycle", "in_ppu",
    )
    visible = described.filter(~contains_in_order(F.col("plan"), *C.HIDDEN_PLAN_WORDS))
    return best_row(visible, SUBSCRIBER, list(C.CHARGE_KINDS), ["product_key", "plan"])
