"""Code lists and job settings. The values are business codes of the source systems."""

from __future__ import annotations

from dataclasses import dataclass

# Codes, labels and patterns that must equal the source systems'.
LIVE_STATUS_KEYS = ("1351", "1359")
LIVE_STATE_KEY = "1331"
SUBSCRIBER_STATUS_KEYS = ("1376", "1378", "1379")
PAYMENT_CATEGORY_KEYS = ("1402", "1403")
PAYMENT_CATEGORIES = ("Postpaid Payment", "Hybrid Payment")
EXCLUDED_ACCOUNT_STATUS = ("T", "C", "L")
SUB_TYPE_KEYS = (
    "3042", "3043", "3044", "3048", "3053", "3054", "3055", "3059", "3060", "3081", "3084",
)
SUB_TYPE_KEYS_V2 = ("3042", "3043", "3048", "3053", "3055", "3059", "3060", "3081", "3084")
SUB_TYPE_RELABEL = {
    "Mediana Estándar": "Mediana Empresa",
    "Mediana": "Mediana Empresa",
    "Pequeña Estándar": "Pequeña Empresa",
    "Pequeña": "Pequeña Empresa",
}
BILLING_SEGMENTS = (
    "Corporaciones", "Gran Empresa", "Mediana", "Pequeña", "Micro", "Empresa Nueva",
    "Empresa Relacionada",
)
PARC_SEGMENTS = (
    "Corporaciones", "Gran Empresa", "Mediana Empresa", "Pequeña Empresa", "Micro",
    "Empresa Nueva", "Empresa Relacionada",
)
PARC_ORIGIN = "AMD"
CHARGE_CODES = (
    "RM_VOZ_PL_POS", "RM_DAT_PL_POS", "RM_VOZ_PL_HIB", "RM_DAT_PL_HIB", "RM_M2M_PL1",
    "RM_BAM_PL_POS", "RM_GPS_PL1", "OM_EQU_SUBS",
)
PLAN_PRODUCT = "2053"
PARAMETER_PRODUCT = "2448119"
PROMO_PRODUCTS = ("2713", "3133", "18865")
PARAMETER_KEYS = ("26754", "27217", "27180", "27183", "27178")
CHARGE_ATTRIBUTES = ("Rate", "Discount value")
PROMO_ATTRIBUTES = ("Discount value", "Discount type")
PROMO_ITEMS_V2 = ("Descuento Promocional Datos", "Descuento Promocional Voz")
HIDDEN_PLAN_WORDS = ("RC", "CONFIGURABLE", "DISCOUNT")

# How an item name, or a parameter id, tells its kind. Words must
# follow each other in this order; under "exact" the trimmed name must be equal.
CHARGE_KINDS = ("cf_datos", "cf_voz", "dsc_cf_datos", "dsc_cf_voz")
CHARGE_WORDS_DAILY = {
    "cf_datos": ("CARGO", "DATOS"),
    "cf_voz": ("CARGO", "VOZ"),
    "dsc_cf_datos": ("DESCUENTO", "DATOS"),
    "dsc_cf_voz": ("DESCUENTO", "VOZ"),
}
CHARGE_WORDS_MONTHLY = {
    "cf_datos": ("CARGO", "DATOS"),
    "cf_voz": ("CARGO", "VOZ"),
    "dsc_cf_datos": ("DESC", "DATOS"),
    "dsc_cf_voz": ("DESC", "VOZ"),
}
CHARGE_NAMES_V2 = {
    "cf_datos": "Cargo Fijo Datos",
    "cf_voz": "Cargo Fijo Voz",
    "dsc_cf_datos": "Descuento Multiproducto Datos",
    "dsc_cf_voz": "Descuento Multiproducto Voz",
}
PARAMETER_WORDS_DAILY = {
    "amount_data": ("DISCOUNTAAMOUNTDATARC",),
    "amount_voice": ("DISCOUNTAMOUNTVOICERC",),
    "type_data": ("DISCOUNTTYPEDATA",),
    "type_voice": ("DISCOUNTTYPEVOICE",),
}
PARAMETER_WORDS_MONTHLY = {
    "amount_data": ("AMOUNTDATA",),
    "amount_voice": ("AMOUNTVOICE",),
    "type_data": ("TYPEDATA",),
    "type_voice": ("TYPEVOICE",),
}
PARAMETER_NAMES_V2 = {
    "amount_data": "DiscountaAmountDataRC",
    "amount_voice": "DiscountAmountVoiceRC",
    "type_data": "DiscountTypeData",
    "type_voice": "DiscountTypeVoice",
}

PROMO_SLOTS = 5


@dataclass(frozen=True)
class JobConfig:
    """What differs between the three snapshots; see README for the choices.

    cycle_source: ``"slot1"`` labels a subscriber as end-of-cycle when promo
        slot 1 is filled, ``"list"`` when the plan is in the end-of-cycle list.
    cap_rule: whether plans created from 2020 on are unusable above 30000.
    v2_label_bug: reproduce the label rule of the second daily job, which tests
        "no voice discount" where "has a voice discount" is meant.
    v2_kind_from_cycle_list: derive the product kind from the description in
        the end-of-cycle list instead of the plan's own.
    strip_pipes: remove ``|`` from the names (the sources keep them).
    """

    cycle_source: str = "list"
    cap_rule: bool = False
    v2_label_bug: bool = False
    v2_kind_from_cycle_list: bool = False
    strip_pipes: bool = False
    sub_type_keys: tuple[str, ...] = SUB_TYPE_KEYS


DAILY = JobConfig(cycle_source="slot1", cap_rule=True)
MONTHLY = JobConfig()
DAILY_V2 = JobConfig(sub_type_keys=SUB_TYPE_KEYS_V2)
