"""The three period reports: one row of 49 columns per subscriber.

All of them have one shape. Each list (plans, additional discounts, promotions,
revenue, accounts, kinds) is reduced to one row per subscriber before it is
joined. The lists do not depend on each other, so joining the largest entries
gives the same row as joining everything and ranking afterwards, without the
rows multiplying. All joins on the subscriber key are therefore one to one and
share one partitioning.

Few of the subscribers in the lists are reported. ``reduced_lists`` writes a bitmap of the
reported ones' keys, of a fixed size, which drops the others' rows where the lists are read,
before anything of them is grouped or shuffled.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from planledger import config as C
from planledger.functions.calendar import period_bounds, period_of, stamps
from planledger.functions.labels import (
    mix_label, mix_label_v2_legacy, product_kind, usable_flag,
)
from planledger.functions.pricing import (
    floored, net_service, stacked_total, to_whole, total_fixed, visible_type,
)
from planledger.functions.text import clean_name, parse_amount, parse_number
from planledger.operators.filters import (
    code_in, current_billing_params, dated_billing_params, eligible_accounts, live_offers, live_products,
    parameters, parc_base, products, promo_values,
)
from planledger.operators.joins import enrich, key_filter, only_keys, split_join
from planledger.operators.reduce import best_row, billed_month, latest_per
from planledger.plans.catalog import name_rules, plan_catalog, promo_catalog_v2, word_rules
from planledger.plans.charges import SUBSCRIBER, best_plans, people, reportable
from planledger.plans.discounts import (
    PRODUCT, discounts_by_kind, discounts_by_pair, discounts_of_latest, promo_lines, promo_slots,
    promo_slots_v2,
)
from planledger.session import stored

SLOTS = range(1, C.PROMO_SLOTS + 1)

# The report's columns in their order.
REPORT_COLUMNS = (
    "RUT", "RAZON_SOCIAL", "CICLO", "SUBSCRIBER_KEY", "FINANCIAL_ACCOUNT_KEY", "MSISDN",
    "CUSTOMER_KEY", "FECHA_ACTIVACION", "SEGMENTO", "CODIGO_PLAN", "PLAN", "ARPU", "CF_DATOS",
    "CF_VOZ", "DSC_CF_DATOS", "DSC_CF_VOZ", "TOTAL_CF", "DSC_ADICIONAL_DATOS",
    "TIPO_DSC_ADI_DATOS", "DSC_ADICIONAL_VOZ", "TIPO_DSC_ADI_VOZ", "ARPU_DATOS", "ARPU_VOZ",
    *[
        f"{name}_{k}" for k in SLOTS
        for name in ("DSC_PUNTUAL", "TIPO_DSC_PUNTUAL", "DSC_FECHA_INICIO", "DSC_FECHA_FIN")
    ],
    "ARPU_T", "FECHA_PROC", "PERIODO", "TIPO_PRODUCTO", "TIPO_DSC", "MARCA_USABLE",
)


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


#: The lists that a report joins by subscriber; the parcs name it in their own ways.
_LISTS = {
    "assigned_product": SUBSCRIBER, "assigned_billing_offer": SUBSCRIBER, "billing_detail": SUBSCRIBER,
    "parc_kfactor": SUBSCRIBER, "parc_sist": "subcriptor",
}


def reduced_lists(
    tables: dict[str, DataFrame], job: str, cfg: C.JobConfig | None = None
) -> dict[str, DataFrame]:
    """``tables`` with the lists reduced to the subscribers that report ``job`` shows.

    A few others stay, which the report drops, so the report is the same with or without.
    Runs two jobs: the bitmap of the reported subscribers' keys is written to the shared folder
    and read by all lists, and so is that of their parametrised products' keys for the parameters.
    """
    if job == "monthly":
        reported = parc_base(tables["parc_coliving"])
    else:
        default = C.DAILY if job == "daily" else C.DAILY_V2
        reported = reportable(tables, cfg or default, v2=job == "daily-v2")
    mask = stored(key_filter(reported.select(SUBSCRIBER), SUBSCRIBER), "keys")
    lists = {name: only_keys(tables[name], mask, on) for name, on in _LISTS.items() if name in tables}
    held = lists["assigned_product"]
    held = held.filter(code_in(held, "product_key", (C.PLAN_PRODUCT, C.PARAMETER_PRODUCT)))
    products_mask = stored(key_filter(held.select(PRODUCT), PRODUCT), "keys")
    values = only_keys(tables["assigned_product_parameter"], products_mask, PRODUCT)
    return tables | lists | {"assigned_product_parameter": values}


def _report(
    wide: DataFrame,
    cfg: C.JobConfig,
    in_cycle: Column,
    label: Column | None = None,
    in_list: str = "in_ppu",
    truncate: bool = True,
    null_as_zero: bool = True,
) -> DataFrame:
    """Price and label the wide rows and give the columns their report names.

    ``wide`` has one row per subscriber with the plan's charges, both additional
    discounts and the promo slots.
    """
    total_cf = total_fixed(*[F.col(kind) for kind in C.CHARGE_KINDS], null_as_zero=null_as_zero)
    priced = wide.withColumns({
        "total_cf": total_cf if null_as_zero else to_whole(total_cf),
        "arpu_datos": net_service(
            F.col("cf_datos"), F.col("dsc_cf_datos"), F.col("amount_data"), F.col("type_data"),
            truncate,
        ),
        "arpu_voz": net_service(
            F.col("cf_voz"), F.col("dsc_cf_voz"), F.col("amount_voice"), F.col("type_voice"),
            truncate,
        ),
    })
    has_data, has_voice = F.col("amount_data").isNotNull(), F.col("amount_voice").isNotNull()
    has_promo = F.col("value_1").isNotNull()
    labelled = priced.withColumns({
        "total": stacked_total(
            F.col("arpu_datos") + F.col("arpu_voz"), [F.col(f"value_{k}") for k in SLOTS]
        ),
        "tipo_dsc": mix_label(has_data | has_voice, in_cycle, has_promo)
        if label is None else label,
    })
    flagged = labelled.withColumns({
        "marca_usable": usable_flag(
            F.col("tipo_dsc"), F.col("total"), F.col("product_valid_from_date"), _flag(in_list),
            cfg.cap_rule,
        ),
        "arpu_t": floored(F.col("total")),
        "razon_social": clean_name(F.col("razon_social"), cfg.strip_pipes),
        "plan": clean_name(F.col("plan"), cfg.strip_pipes),
    })
    source = {
        "CODIGO_PLAN": "product_key",
        "DSC_ADICIONAL_DATOS": "amount_data",
        "TIPO_DSC_ADI_DATOS": "type_data",
        "DSC_ADICIONAL_VOZ": "amount_voice",
        "TIPO_DSC_ADI_VOZ": "type_voice",
    }
    for k in SLOTS:
        source[f"DSC_PUNTUAL_{k}"] = f"value_{k}"
        source[f"TIPO_DSC_PUNTUAL_{k}"] = f"kind_{k}"
        source[f"DSC_FECHA_INICIO_{k}"] = f"inicio_{k}"
        source[f"DSC_FECHA_FIN_{k}"] = f"fin_{k}"
    return flagged.selectExpr(*[f"{source.get(name, name)} AS {name}" for name in REPORT_COLUMNS])


def daily_snapshot(
    tables: dict[str, DataFrame], as_of: date, run_ts: datetime, cfg: C.JobConfig = C.DAILY
) -> DataFrame:
    """Daily report from live assigned products."""
    pbp = tables["product_billing_parameters"]
    catalog = plan_catalog(
        tables,
        current_billing_params(pbp, C.CHARGE_ATTRIBUTES),
        word_rules(F.col("item_name"), C.CHARGE_WORDS_DAILY),
        F.coalesce(parse_number(F.col("billing_attribute_default_val")), F.lit(0.0)),
    )
    assigned = live_products(
        tables["assigned_product"], (C.PLAN_PRODUCT, C.PARAMETER_PRODUCT), as_of
    )
    abo = tables["assigned_billing_offer"]
    plans = best_plans(assigned, live_offers(abo, (C.PLAN_PRODUCT,), as_of), catalog, tables["product"])
    discounts = discounts_by_kind(
        assigned,
        parameters(tables["assigned_product_parameter"]),
        word_rules(F.col("assigned_product_parameter_id"), C.PARAMETER_WORDS_DAILY),
    )
    promos = promo_slots(promo_lines(
        live_products(tables["assigned_product"], C.PROMO_PRODUCTS, as_of),
        live_offers(abo, C.PROMO_PRODUCTS, as_of),
        promo_values(products(tables["product"]), current_billing_params(pbp, C.PROMO_ATTRIBUTES)),
        unique=False,
    ))
    accounts = eligible_accounts(tables["parc_kfactor"]).groupBy(SUBSCRIBER).agg(
        F.max("financial_account_key").alias("financial_account_key")
    )
    kinds = tables["parc_sist"].groupBy(F.col("subcriptor").alias(SUBSCRIBER)).agg(
        F.max("tipo_plan").alias("known_kind")
    )
    wide = enrich(people(tables, cfg), plans, SUBSCRIBER, "inner")
    for part in (
        discounts, promos, billed_month(tables["billing_detail"], period_of(as_of)), accounts, kinds
    ):
        wide = enrich(wide, part, SUBSCRIBER)
    wide = wide.withColumns({
        "arpu": F.coalesce("arpu", F.lit(0)),
        "type_data": visible_type(F.col("amount_data"), F.col("type_data")),
        "type_voice": visible_type(F.col("amount_voice"), F.col("type_voice")),
        "tipo_producto": product_kind(F.col("known_kind"), F.col("plan")),
    })
    in_cycle = _flag("has_slot" if cfg.cycle_source == "slot1" else "in_cycle")
    return _report(stamps(wide, as_of, run_ts), cfg, in_cycle, truncate=False)


def monthly_close(
    tables: dict[str, DataFrame], period: str, run_ts: datetime, cfg: C.JobConfig = C.MONTHLY
) -> DataFrame:
    """Close of a ``yyyyMM`` period from that month's parc."""
    last = period_bounds(period)[1]
    pbp = tables["product_billing_parameters"]
    catalog = plan_catalog(
        tables,
        dated_billing_params(pbp, C.CHARGE_ATTRIBUTES, last, run_ts.date()),
        word_rules(F.col("item_name"), C.CHARGE_WORDS_MONTHLY),
        F.coalesce(parse_amount(F.col("billing_attribute_default_val")), F.lit(0)),
    ).drop("product_desc")
    lines = parc_base(tables["parc_coliving"]).select(
        SUBSCRIBER,
        "product_key",
        F.col("product_desc").alias("plan"),
        F.col("rut_id").alias("rut"),
        F.col("customer_name").alias("razon_social"),
        F.col("billing_cycle_key").alias("ciclo"),
        "financial_account_key",
        F.col("primary_resource_value").alias("msisdn"),
        "customer_key",
        F.col("original_activation_date").alias("fecha_activacion"),
        F.col("customer_sub_type_desc").alias("segmento"),
        F.col("product").alias("tipo_producto"),
    )
    shown = [name for name in lines.columns if name != SUBSCRIBER]
    shown += ["product_valid_from_date", "in_cycle", "in_ppu"]
    # Lines without a subscriber form one row that no list matches.
    known = F.col(SUBSCRIBER).isNotNull()
    base = (
        split_join(lines, catalog, "product_key", "left")
        .groupBy(SUBSCRIBER)
        .agg(
            F.max(F.struct(*shown)).alias("line"),
            *[
                F.coalesce(F.max(F.when(known, F.col(kind))), F.lit(0)).alias(kind)
                for kind in C.CHARGE_KINDS
            ],
        )
        .select(SUBSCRIBER, "line.*", *C.CHARGE_KINDS)
    )
    discounts = discounts_by_pair(
        live_products(
            tables["assigned_product"], (C.PARAMETER_PRODUCT,), last, at_period_end=True,
            drop_deleted=True, need_customer=False,
        ),
        parameters(tables["assigned_product_parameter"], drop_deleted=True),
        word_rules(F.col("assigned_product_parameter_id"), C.PARAMETER_WORDS_MONTHLY),
    )
    promos = promo_slots(promo_lines(
        live_products(tables["assigned_product"], C.PROMO_PRODUCTS, last, at_period_end=True),
        live_offers(
            tables["assigned_billing_offer"], C.PROMO_PRODUCTS, last, at_period_end=True
        ),
        promo_values(products(tables["product"]), current_billing_params(pbp, C.PROMO_ATTRIBUTES)),
        unique=True,
    ))
    wide = base
    for part in (discounts, promos, billed_month(tables["billing_detail"], period)):
        wide = enrich(wide, part, SUBSCRIBER)
    wide = wide.withColumn("arpu", to_whole(F.coalesce("arpu", F.lit(0))))
    in_cycle = _flag("has_slot" if cfg.cycle_source == "slot1" else "in_cycle")
    return _report(stamps(wide, last, run_ts, period), cfg, in_cycle)


def daily_snapshot_v2(
    tables: dict[str, DataFrame], as_of: date, cfg: C.JobConfig = C.DAILY_V2
) -> DataFrame:
    """Daily report from subscribers, whether or not they have a plan."""
    pbp = tables["product_billing_parameters"]
    catalog = plan_catalog(
        tables,
        current_billing_params(pbp, C.CHARGE_ATTRIBUTES),
        name_rules(F.col("item_name"), C.CHARGE_NAMES_V2),
        parse_number(F.col("billing_attribute_default_val")),
    )
    abo = tables["assigned_billing_offer"]
    latest_offer = latest_per(
        live_offers(abo, (C.PLAN_PRODUCT,), as_of).select(
            SUBSCRIBER, "start_date", "product_key", "assigned_product_id"
        ),
        SUBSCRIBER, "start_date", ["product_key", "assigned_product_id"],
    )
    plans = split_join(
        latest_offer.select(SUBSCRIBER, "product_key"), catalog, "product_key", "left"
    ).withColumnRenamed("product_desc", "plan")
    latest_product = latest_per(
        live_products(tables["assigned_product"], (C.PARAMETER_PRODUCT,), as_of).select(
            SUBSCRIBER, "start_date", "assigned_product_key"
        ),
        SUBSCRIBER, "start_date", ["assigned_product_key"],
    )
    discounts = discounts_of_latest(
        latest_product,
        parameters(tables["assigned_product_parameter"]),
        name_rules(F.col("assigned_product_parameter_id"), C.PARAMETER_NAMES_V2),
    )
    promos = promo_slots_v2(
        live_offers(abo, C.PROMO_PRODUCTS, as_of),
        promo_catalog_v2(
            tables, current_billing_params(pbp, C.PROMO_ATTRIBUTES, C.PROMO_ITEMS_V2)
        ),
    )
    parc = best_row(
        tables["parc_kfactor"].select(
            SUBSCRIBER, "financial_account_key", F.col("product").alias("known_kind")
        ),
        SUBSCRIBER, ["financial_account_key"], ["known_kind"],
    )
    wide = people(tables, cfg, v2=True)
    for part in (
        plans, discounts, promos, billed_month(tables["billing_detail"], period_of(as_of)), parc
    ):
        wide = enrich(wide, part, SUBSCRIBER)
    kind_text = "cycle_desc" if cfg.v2_kind_from_cycle_list else "plan"
    wide = wide.withColumns({
        "arpu": to_whole(F.col("arpu")),
        "tipo_producto": product_kind(F.col("known_kind"), F.col(kind_text)),
    })
    in_cycle = _flag("in_cycle")
    label = mix_label_v2_legacy(
        F.col("amount_data").isNotNull(), F.col("amount_voice").isNotNull(), in_cycle,
        F.col("value_1").isNotNull(),
    ) if cfg.v2_label_bug else None
    return _report(
        stamps(wide, as_of), cfg, in_cycle, label, in_list="in_ppu_named", null_as_zero=False
    )
