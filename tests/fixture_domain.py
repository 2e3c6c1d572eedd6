"""A small set of source tables: a dozen subscribers, each showing one rule.

Subscribers: 1 plain plan; 2 additional discounts; 3 two promos; 4 dear recent
plan; 5 dear old plan; 6 free plan off the list; 7 free plan on the list; 8 two
plans; 9 wrong status; 10 customer without tax id; 11 negative total; 12 six
promos with a repeated product.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from planledger.contracts import TABLES, ddl

AS_OF = date(2024, 1, 15)
OPEN = date(2030, 1, 1)
START = date(2023, 6, 1)


def frame(spark, name, rows):
    """A typed table from dicts; columns left out are null."""
    data = [tuple(row.get(column) for column in TABLES[name]) for row in rows]
    return spark.createDataFrame(data, ddl(name))


def product(key, subscriber, number, family, **more):
    return {
        "product_key": family, "subscriber_key": subscriber, "assigned_product_key": number,
        "assigned_product_id": key, "customer_key": "c" + subscriber,
        "assigned_product_status_key": "1351", "assigned_product_state_key": "1331",
        "start_date": START, "end_date": OPEN, "dml_ind": "INSERT", **more,
    }


def offer(key, subscriber, plan, parent, provision=START, **more):
    return {
        "subscriber_key": subscriber, "assigned_product_id": key, "product_key": plan,
        "parent_product_key": parent, "asgn_blng_ofr_state_key": "1331",
        "asgn_blng_ofr_status_key": "1359", "provision_date": provision, "start_date": START,
        "end_date": OPEN, **more,
    }


def charge(plan, item, value, attribute="Rate", **more):
    return {
        "product_key": plan, "item_name": item, "billing_attribute_name": attribute,
        "dml_ind": "INSERT", "billing_attribute_default_val": value,
        "billing_offer_effective_date": date(2020, 1, 1), **more,
    }


def parameter(number, name, value):
    return {
        "assigned_product_key": number, "product_parameter_key": "26754",
        "assigned_product_parameter_id": name, "parameter_value": value, "dml_ind": "INSERT",
    }


PLAN_OF = {
    "1": "P1", "2": "P1", "3": "P1", "4": "P2", "5": "P3", "6": "P4", "7": "P5", "8": "P1",
    "9": "P1", "10": "P1", "11": "P4", "12": "P1",
}
PROMOS_OF = {"3": ["D10", "D20"], "12": ["D10", "D10", "D20", "D20", "D30", "D40"]}


def tables(spark):
    assigned, offers = [], []
    for subscriber, plan in PLAN_OF.items():
        assigned.append(product("A" + subscriber, subscriber, "n" + subscriber, "2053"))
        offers.append(offer("A" + subscriber, subscriber, plan, "2053"))
    offers.append(offer("A8", "8", "P2", "2053", start_date=date(2022, 1, 1)))
    offers.append(offer("A1", "1", "P2", "2053", end_date=AS_OF))  # ended: not on the day itself
    for subscriber in ("2", "11"):
        assigned.append(product("B" + subscriber, subscriber, "m" + subscriber, "2448119"))
    for subscriber, promos in PROMOS_OF.items():
        assigned.append(product("C" + subscriber, subscriber, "k" + subscriber, "2713"))
        offers += [
            offer("C" + subscriber, subscriber, promo, "2713", date(2023, 1, 31 - i))
            for i, promo in enumerate(promos)
        ]
    charges = [
        charge("P1", "Cargo Fijo Datos", "20000"), charge("P1", "Cargo Fijo Voz", "10000"),
        charge("P1", "Descuento Multiproducto Datos", "2000", "Discount value"),
        charge("P1", "Descuento Multiproducto Voz", "1000", "Discount value"),
        charge("P1", "Cargo Fijo Datos", "99999", dml_ind="DELETE"),
        charge("P1", "Cargo Fijo Datos", "88888", package_expiration_date=OPEN),
    ]
    for plan, fee in (("P2", "40000"), ("P3", "40000"), ("P4", "0"), ("P5", "0")):
        charges += [
            charge(plan, "Cargo Fijo Datos", fee), charge(plan, "Cargo Fijo Voz", "0"),
            charge(plan, "Descuento Multiproducto Datos", "0", "Discount value"),
            charge(plan, "Descuento Multiproducto Voz", "0", "Discount value"),
        ]
    for promo in ("D10", "D20", "D30", "D40"):
        item = "Descuento Promocional Datos"
        charges += [
            charge(promo, item, promo[1:], "Discount value"),
            charge(promo, item, "Percent", "Discount type"),
        ]
    names = {
        "2053": "Plan Movil BAM", "2448119": "RC Configurable Discount", "P1": "Plan Uno",
        "P2": "Plan Dos M2M", "P3": "Plan Tres", "P4": "Plan Cuatro", "P5": "Plan Cinco",
        "D10": "10% dcto", "D20": "20% dcto", "D30": "30% dcto", "D40": "40% dcto",
    }
    lines = {
        "1": [(date(2024, 1, 1), 1000), (date(2024, 1, 31), 500), (date(2024, 2, 1), 7)],
        "2": [(date(2023, 12, 31), 9)],
    }
    subscribers = [
        {
            "subscriber_key": key, "customer_key": "c" + key,
            "subscriber_status_key": "1377" if key == "9" else "1376",
            "calculated_payment_category_ke": "1402", "primary_resource_value": "569" + key,
            "original_activation_date": date(2019, 5, 6),
        }
        for key in PLAN_OF
    ]
    return {
        "assigned_product": frame(spark, "assigned_product", assigned),
        "assigned_billing_offer": frame(spark, "assigned_billing_offer", offers),
        "product_billing_parameters": frame(spark, "product_billing_parameters", charges),
        "subscribers": frame(spark, "subscribers", subscribers),
        "customer": frame(spark, "customer", [
            {
                "customer_key": "c" + key, "customer_sub_type_key": "3042", "billing_cycle_key": "5",
                "rut_id": "#" if key == "10" else "r" + key, "customer_legal_name": f"E|{key}",
                "customer_type_ind": "C", "dml_ind": "INSERT",
            }
            for key in PLAN_OF
        ]),
        "customer_sub_type": frame(spark, "customer_sub_type", [
            {"customer_sub_type_key": "3042", "customer_sub_type_desc": "Mediana"},
        ]),
        "assigned_product_parameter": frame(spark, "assigned_product_parameter", [
            parameter("m2", "DiscountaAmountDataRC", "10"), parameter("m2", "DiscountTypeData", "Percent"),
            parameter("m2", "DiscountAmountVoiceRC", "500"), parameter("m2", "DiscountTypeVoice", "Fixed"),
            parameter("m11", "DiscountaAmountDataRC", "100"), parameter("m11", "DiscountAmountVoiceRC", "0"),
            parameter("m11", "DiscountTypeVoice", "Percent"),
        ]),
        "product": frame(spark, "product", [
            {
                "product_key": key, "product_desc": name, "price_plan_promotion_interval": "M",
                "price_plan_promotion_duration": 1,
            }
            for key, name in names.items()
        ]),
        "product_catalog": frame(spark, "product_catalog", [
            {"product_key": key, "product_valid_from_date": date(2019 if key == "P3" else 2021, 1, 1)}
            for key in ("P1", "P2", "P3", "P4", "P5")
        ]),
        "billing_detail": frame(spark, "billing_detail", [
            {
                "subscriber_key": key, "customer_sub_type_desc": "Mediana",
                "payment_category_desc": "Postpaid Payment", "charge_code_id": "RM_VOZ_PL_POS",
                "bill_date": day, "close_date": day, "charge_amount": Decimal(amount),
            }
            for key, bills in lines.items() for day, amount in bills
        ]),
        "parc_kfactor": frame(spark, "parc_kfactor", [
            {
                "subscriber_key": "1", "financial_account_key": account,
                "subscriber_status_id": status, "customer_type_ind": "C", "product": "KF",
            }
            for account, status in (("F1", "A"), ("F2", "A"), ("F9", "T"))
        ]),
        "parc_sist": frame(spark, "parc_sist", [{"subcriptor": "1", "tipo_plan": "VOZ+"}]),
        "cycle_discounts": frame(spark, "cycle_discounts", [
            {"product_key": "P3", "product_desc": "Plan Tres"},
        ]),
        "plan_list": frame(spark, "plan_list", [
            {"product_key": "P5", "descripcion": "ppu"}, {"product_key": "P5", "descripcion": "ppu"},
        ]),
        "parc_coliving": frame(spark, "parc_coliving", [
            {
                "subscriber_key": f" {key} ", "product_key": plan, "customer_key": "c" + key,
                "financial_account_key": "F" + key, "billing_cycle_key": "5", "rut_id": "r" + key,
                "customer_name": f"E|{key}", "primary_resource_value": "569" + key,
                "customer_sub_type_desc": " Mediana Empresa",
                "payment_category_desc": "Postpaid Payment ", "product_desc": "Plan de parque",
                "product": "VOZ", "sistema_origen": "OTRO" if key == "10" else "AMD",
                "valid_ind": 0 if key == "9" else 1, "close_date": date(2024, 1, 31),
                "gain_date_access_mngctr": date(2018, 3, 4),
            }
            for key, plan in [*PLAN_OF.items(), ("8", "P2"), (None, "P1")] if key
        ]),
    }
