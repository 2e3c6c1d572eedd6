"""The three reports as plain SQL: join every list, then rank and keep one row.

Deliberately the long form (one join per charge kind, parameter kind and promo
slot, rows multiplying, ``row_number`` at the end), to check that the
aggregate-first Spark form gives the same rows.
"""

from __future__ import annotations

from checks.domain import AS_OF, CLOSE_TS, PERIOD, RUN_TS, domain_ctes

SLOTS = range(1, 6)
TODAY = f"DATE '{AS_OF}'"
LAST = "DATE '2024-01-31'"
STATUS = "IN ('1351', '1359')"
PROMO = "IN ('2713', '3133', '18865')"
PARAMETER = "IN ('26754', '27217', '27180', '27183', '27178')"
SUB_TYPES = "'3042', '3043', '3048', '3053', '3055', '3059', '3060', '3081', '3084'"
CODES = (
    "('RM_VOZ_PL_POS', 'RM_DAT_PL_POS', 'RM_VOZ_PL_HIB', 'RM_DAT_PL_HIB', 'RM_M2M_PL1', "
    "'RM_BAM_PL_POS', 'RM_GPS_PL1', 'OM_EQU_SUBS')"
)
BILLED = f"""billed AS (
  SELECT subscriber_key, sum(charge_amount) AS arpu FROM src_billing_detail
  WHERE bill_date BETWEEN DATE '2024-01-01' AND {LAST}
    AND customer_sub_type_desc IN ('Corporaciones', 'Gran Empresa', 'Mediana', 'Pequeña', 'Micro',
                                   'Empresa Nueva', 'Empresa Relacionada')
    AND payment_category_desc IN ('Postpaid Payment', 'Hybrid Payment')
    AND charge_code_id IN {CODES}
  GROUP BY subscriber_key)"""
CURRENT = ("b.billing_offer_expiration_date IS NULL AND b.package_expiration_date IS NULL "
           "AND b.dml_ind <> 'DELETE'")
CUSTOMERS = ("customer_type_ind = 'C' AND rut_id <> '#' AND dml_ind <> 'DELETE' "
             "AND customer_sub_type_key IN ({keys})")


def live(alias: str, state: str, status: str, end: str = TODAY) -> str:
    return f"{alias}.{state} = '1331' AND {alias}.{status} {STATUS} AND {alias}.end_date > {end}"


AP = ("assigned_product_state_key", "assigned_product_status_key")
ABO = ("asgn_blng_ofr_state_key", "asgn_blng_ofr_status_key")
FIN = """CASE price_plan_promotion_interval
    WHEN 'M' THEN CAST(provision_date + price_plan_promotion_duration * INTERVAL 1 MONTH AS DATE)
    WHEN 'D' THEN provision_date + price_plan_promotion_duration END"""


#: Plain decimal notation; other spellings that a cast would take are words.
NUMBER = "'^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+) *$'"


def number(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, {NUMBER}) THEN TRY_CAST({text} AS DOUBLE) END"


def whole(value: str) -> str:
    return f"CAST(trunc({value}) AS BIGINT)"


def net(service: str, truncate: bool) -> str:
    base = f"(cf_{service} - dsc_cf_{service})"
    # A word is no amount, and makes a fixed price unknown.
    amount = f"(CASE WHEN adi_{service} IS NULL THEN 0 ELSE {number(f'adi_{service}')} END)"
    price = (
        f"CASE WHEN coalesce(tipo_{service}, 'Fixed') = 'Fixed' THEN {base} - {amount} "
        f"WHEN trunc(coalesce({amount}, 0)) <> 0 THEN {base} * (100 - {amount}) / 100 ELSE {base} END"
    )
    return whole(price) if truncate else price


STACKED = whole("(arpu_datos + arpu_voz) * " + " * ".join(
    f"((100 - coalesce(v_{k}, 0)) / 100)" for k in SLOTS
))


def label(param: str, cycle: str, promo: str) -> str:
    return (
        f"'MULTIPRODUCTO' || CASE WHEN {param} THEN '+PARAMETRIZABLE' ELSE '' END"
        f" || CASE WHEN {cycle} THEN '+FIN DE CICLO' ELSE '' END"
        f" || CASE WHEN {promo} THEN '+PUNTUAL' ELSE '' END"
    )


def legacy_label(data: str, voice: str, cycle: str, promo: str) -> str:
    """As above, but with cycle and promo "no voice discount" is asked for where "voice discount" is
    meant, and neither discount with both others has no label of its own."""
    both = f"({cycle}) AND ({promo})"
    return (
        f"CASE WHEN {both} AND ({data} OR NOT {voice}) THEN {label('true', 'true', 'true')}"
        f" WHEN {both} THEN 'MULTIPRODUCTO' ELSE {label(f'({data} OR {voice})', cycle, promo)} END"
    )


RANK = ", ".join(
    f"{name} DESC NULLS LAST" for name in (
        "cf_datos", "cf_voz", "dsc_cf_datos", "dsc_cf_voz", number("adi_datos"), "adi_datos",
        "tipo_datos", number("adi_voz"), "adi_voz", "tipo_voz", *[f"v_{k}" for k in SLOTS],
    )
)


def finish(
    wide: str, truncate: bool, cap: bool, tie: str, stamp: str, total_cf: str,
    labelled: str = label('adi', 'fin', 'pun'),
) -> str:
    """Prices, label, flag, rank and the 49 report columns over a CTE named ``wide``."""
    cap_rule = "OR (total > 30000 AND year(created) >= 2020)" if cap else ""
    slots = ",\n".join(
        f"  v_{k} AS \"DSC_PUNTUAL_{k}\", t_{k} AS \"TIPO_DSC_PUNTUAL_{k}\", "
        f"i_{k} AS \"DSC_FECHA_INICIO_{k}\", f_{k} AS \"DSC_FECHA_FIN_{k}\"" for k in SLOTS
    )
    names = {
        "rut": "RUT", "razon_social": "RAZON_SOCIAL", "ciclo": "CICLO",
        "subscriber_key": "SUBSCRIBER_KEY", "account": "FINANCIAL_ACCOUNT_KEY",
        "msisdn": "MSISDN", "customer_key": "CUSTOMER_KEY", "activada": "FECHA_ACTIVACION",
        "segmento": "SEGMENTO", "plan_key": "CODIGO_PLAN", "plan_text": "PLAN",
        "CAST(arpu AS DOUBLE)": "ARPU",
        "CAST(cf_datos AS DOUBLE)": "CF_DATOS", "CAST(cf_voz AS DOUBLE)": "CF_VOZ",
        "CAST(dsc_cf_datos AS DOUBLE)": "DSC_CF_DATOS", "CAST(dsc_cf_voz AS DOUBLE)": "DSC_CF_VOZ",
        "CAST(total_cf AS DOUBLE)": "TOTAL_CF",
        "adi_datos": "DSC_ADICIONAL_DATOS", "tipo_datos": "TIPO_DSC_ADI_DATOS",
        "adi_voz": "DSC_ADICIONAL_VOZ", "tipo_voz": "TIPO_DSC_ADI_VOZ",
        "CAST(arpu_datos AS DOUBLE)": "ARPU_DATOS", "CAST(arpu_voz AS DOUBLE)": "ARPU_VOZ",
    }
    shown = ",\n".join(f'  {column} AS "{name}"' for column, name in names.items())
    return f"""priced AS (
  SELECT *, {total_cf} AS total_cf, {net('datos', truncate)} AS arpu_datos,
         {net('voz', truncate)} AS arpu_voz,
         adi_datos IS NOT NULL OR adi_voz IS NOT NULL AS adi, v_1 IS NOT NULL AS pun
  FROM {wide}),
totalled AS (SELECT *, {STACKED} AS total, {labelled} AS label FROM priced),
ranked AS (
  SELECT *, CASE WHEN label LIKE '%FIN%CICLO%' OR total < 0 {cap_rule}
                   OR (NOT listed AND total = 0) THEN 'NO' ELSE 'SI' END AS usable,
         CASE WHEN total < 0 THEN 0 ELSE total END AS arpu_t,
         row_number() OVER (PARTITION BY subscriber_key ORDER BY {RANK}, {tie}) AS orden
  FROM totalled)
SELECT
{shown},
{slots},
  arpu_t AS "ARPU_T", {stamp} AS "FECHA_PROC", '{PERIOD}' AS "PERIODO", kind AS "TIPO_PRODUCTO",
  label AS "TIPO_DSC", usable AS "MARCA_USABLE"
FROM ranked WHERE orden = 1"""


def kind_of(known: str, text: str) -> str:
    return f"""coalesce({known}, CASE
    WHEN upper({text}) LIKE '%GPS%' OR upper({text}) LIKE '%M2M%' THEN 'M2M'
    WHEN upper({text}) LIKE '%BAM%' OR upper({text}) LIKE '%WIFI%MOVIL%' THEN 'BAM'
    ELSE 'VOZ' END)"""


def promo_ctes(source: str, unique: str) -> str:
    """Promo lines from a CTE ``source``, numbered per subscriber, one CTE per slot."""
    slots = ",\n".join(
        f"slot_{k} AS (SELECT subscriber_key, value AS v_{k}, "
        f"CASE WHEN value IS NOT NULL THEN 'Percent' END AS t_{k}, provision_date AS i_{k}, "
        f"fin AS f_{k}, product_desc AS d_{k} FROM numbered WHERE pos = {k})" for k in SLOTS
    )
    return f"""lines AS (
  SELECT {unique} subscriber_key, product_key, product_desc, raw, provision_date, {FIN} AS fin
  FROM {source}
  WHERE product_desc LIKE '%!%%' ESCAPE '!' AND lower(product_desc) NOT LIKE '%sms%'
    AND lower(product_desc) NOT LIKE '%bolsa%dato%' AND lower(raw) <> 'percent'),
numbered AS (
  SELECT *, CASE WHEN raw <> '0' THEN {whole(number('raw'))} END AS value,
         row_number() OVER (PARTITION BY subscriber_key
                            ORDER BY product_key, raw, provision_date, fin NULLS FIRST) AS pos
  FROM lines),
{slots}"""


SLOT_COLUMNS = ", ".join(f"v_{k}, t_{k}, i_{k}, f_{k}" for k in SLOTS)


def slot_joins(base: str) -> str:
    return "\n".join(
        f"  LEFT JOIN slot_{k} ON slot_{k}.subscriber_key = {base}.subscriber_key" for k in SLOTS
    )


def daily_snapshot(cycle: str = "d_1 IS NOT NULL") -> str:
    keys = SUB_TYPES + ", '3044', '3054'"
    return f"""WITH {domain_ctes(
        'assigned_product', 'customer', 'subscribers', 'assigned_product_parameter', 'product',
        'customer_sub_type', 'assigned_billing_offer', 'product_catalog',
        'product_billing_parameters', 'billing_detail', 'parc_kfactor', 'parc_sist', 'plan_list',
        'cycle_discounts')},
cust AS (SELECT * FROM src_customer WHERE {CUSTOMERS.format(keys=keys)}),
view AS (
  SELECT c.rut_id, c.customer_legal_name, c.billing_cycle_key, s.subscriber_key,
         s.primary_resource_value AS msisdn, c.customer_key, t.customer_sub_type_desc AS sub_type,
         o.product_key AS plan_key,
         CASE WHEN p2.product_key = '2053' THEN p2.product_desc ELSE p1.product_desc END AS plan_text,
         b.item_name, b.billing_attribute_default_val AS charge_val, m.assigned_product_parameter_id,
         m.parameter_value, s.original_activation_date, g.product_valid_from_date AS created
  FROM src_assigned_product a
  JOIN src_subscribers s ON s.subscriber_key = a.subscriber_key
    AND s.subscriber_status_key IN ('1376', '1378', '1379')
    AND s.calculated_payment_category_ke IN ('1402', '1403')
  JOIN cust c ON c.customer_key = s.customer_key
  LEFT JOIN src_assigned_product_parameter m ON m.assigned_product_key = a.assigned_product_key
    AND m.product_parameter_key {PARAMETER}
  LEFT JOIN src_product p1 ON p1.product_key = a.product_key
  LEFT JOIN src_customer_sub_type t ON t.customer_sub_type_key = c.customer_sub_type_key
  LEFT JOIN src_assigned_billing_offer o ON o.subscriber_key = a.subscriber_key
    AND o.assigned_product_id = a.assigned_product_id AND o.parent_product_key = '2053'
    AND {live('o', *ABO)}
  LEFT JOIN src_product p2 ON p2.product_key = o.product_key
  LEFT JOIN src_product_catalog g ON g.product_key = p2.product_key
  LEFT JOIN src_product_billing_parameters b ON b.product_key = o.product_key
    AND b.billing_attribute_name IN ('Rate', 'Discount value') AND {CURRENT}
  WHERE a.product_key IN ('2053', '2448119') AND {live('a', *AP)} AND a.customer_key IS NOT NULL),
base AS (
  SELECT DISTINCT rut_id, customer_legal_name, billing_cycle_key, subscriber_key, msisdn,
         customer_key, sub_type, plan_key, plan_text, original_activation_date, created
  FROM view WHERE NOT upper(plan_text) LIKE '%RC%CONFIGURABLE%DISCOUNT%'),
{", ".join(
    f"{name} AS (SELECT DISTINCT subscriber_key, plan_key, {number('charge_val')} AS v FROM view "
    f"WHERE trim(upper(item_name)) LIKE '{pattern}')" for name, pattern in (
        ("c_datos", "%CARGO%DATOS%"), ("c_voz", "%CARGO%VOZ%"),
        ("d_datos", "%DESCUENTO%DATOS%"), ("d_voz", "%DESCUENTO%VOZ%")))},
{", ".join(
    f"{name} AS (SELECT DISTINCT subscriber_key, "
    f"CASE WHEN parameter_value NOT IN ('0', '00') THEN parameter_value END AS v FROM view "
    f"WHERE upper(assigned_product_parameter_id) LIKE '{pattern}')" for name, pattern in (
        ("a_datos", "%DISCOUNTAAMOUNTDATARC%"), ("a_voz", "%DISCOUNTAMOUNTVOICERC%")))},
{", ".join(
    f"{name} AS (SELECT DISTINCT subscriber_key, parameter_value AS v FROM view "
    f"WHERE upper(assigned_product_parameter_id) LIKE '{pattern}')" for name, pattern in (
        ("k_datos", "%DISCOUNTTYPEDATA%"), ("k_voz", "%DISCOUNTTYPEVOICE%")))},
promo AS (
  SELECT s.subscriber_key, o.product_key, p.product_desc, b.billing_attribute_default_val AS raw,
         o.provision_date, p.price_plan_promotion_interval, p.price_plan_promotion_duration
  FROM src_assigned_product a
  LEFT JOIN src_subscribers s ON s.subscriber_key = a.subscriber_key
    AND s.subscriber_status_key IN ('1376', '1378', '1379')
  JOIN cust c ON c.customer_key = s.customer_key
  LEFT JOIN src_assigned_billing_offer o ON o.subscriber_key = a.subscriber_key
    AND o.assigned_product_id = a.assigned_product_id AND o.parent_product_key {PROMO}
    AND {live('o', *ABO)}
  LEFT JOIN src_product p ON p.product_key = o.product_key
  LEFT JOIN src_product_billing_parameters b ON b.product_key = o.product_key
    AND b.billing_attribute_name IN ('Discount value', 'Discount type') AND {CURRENT}
  WHERE a.product_key {PROMO} AND {live('a', *AP)} AND a.customer_key IS NOT NULL),
{promo_ctes('promo', '')},
{BILLED},
accounts AS (
  SELECT DISTINCT financial_account_key, subscriber_key FROM src_parc_kfactor
  WHERE subscriber_status_id NOT IN ('T', 'C', 'L') AND customer_type_ind = 'C'
    AND financial_account_key IS NOT NULL AND subscriber_key IS NOT NULL),
wide AS (
  SELECT base.rut_id AS rut, base.customer_legal_name AS razon_social,
         base.billing_cycle_key AS ciclo, base.subscriber_key, accounts.financial_account_key AS account,
         base.msisdn, base.customer_key, strftime(base.original_activation_date, '%Y%m%d') AS activada,
         base.sub_type AS segmento, base.plan_key, base.plan_text, coalesce(billed.arpu, 0) AS arpu,
         coalesce(c_datos.v, 0) AS cf_datos, coalesce(c_voz.v, 0) AS cf_voz,
         coalesce(d_datos.v, 0) AS dsc_cf_datos, coalesce(d_voz.v, 0) AS dsc_cf_voz,
         a_datos.v AS adi_datos, CASE WHEN a_datos.v IS NOT NULL THEN k_datos.v END AS tipo_datos,
         a_voz.v AS adi_voz, CASE WHEN a_voz.v IS NOT NULL THEN k_voz.v END AS tipo_voz,
         {SLOT_COLUMNS}, {cycle} AS fin, base.created,
         l.product_key IS NOT NULL AS listed, {kind_of('x.tipo_plan', 'base.plan_text')} AS kind
  FROM base
  {" ".join(
      f"LEFT JOIN {name} ON {name}.subscriber_key = base.subscriber_key "
      f"AND {name}.plan_key = base.plan_key" for name in ("c_datos", "c_voz", "d_datos", "d_voz"))}
  {" ".join(
      f"LEFT JOIN {name} ON {name}.subscriber_key = base.subscriber_key"
      for name in ("a_datos", "a_voz", "k_datos", "k_voz", "accounts", "billed"))}
  LEFT JOIN src_parc_sist x ON x.subcriptor = base.subscriber_key
  LEFT JOIN src_plan_list l ON l.product_key = base.plan_key
  LEFT JOIN src_cycle_discounts e ON e.product_key = base.plan_key
{slot_joins('base')}),
{finish('wide', False, True,
        'plan_key DESC NULLS LAST, plan_text DESC, account DESC NULLS LAST, kind DESC',
        f"'{RUN_TS:%Y%m%d %H:%M:%S}'", 'cf_datos + cf_voz - dsc_cf_datos - dsc_cf_voz')}"""


def monthly_close() -> str:
    at_end = "{0}.start_date <= " + LAST + " AND {0}.end_date > " + LAST
    shown = ("plan_key", "plan_text", "rut", "razon_social", "ciclo", "account", "msisdn",
             "customer_key", "activada", "segmento", "kind")
    return f"""WITH {domain_ctes(
        'assigned_product', 'assigned_product_parameter', 'product', 'assigned_billing_offer',
        'product_catalog', 'product_billing_parameters', 'billing_detail', 'parc_coliving',
        'cycle_discounts', 'plan_list')},
parc AS (
  SELECT * FROM src_parc_coliving
  WHERE trim(customer_sub_type_desc) IN ('Corporaciones', 'Gran Empresa', 'Mediana Empresa',
        'Pequeña Empresa', 'Micro', 'Empresa Nueva', 'Empresa Relacionada')
    AND trim(payment_category_desc) IN ('Postpaid Payment', 'Hybrid Payment')
    AND valid_ind = 1 AND sistema_origen = 'AMD'),
charges AS (
  SELECT DISTINCT parc.subscriber_key, lower(b.item_name) AS item,
         {whole(number('b.billing_attribute_default_val'))} AS v
  FROM parc JOIN src_product_billing_parameters b ON b.product_key = parc.product_key
    AND b.billing_attribute_name IN ('Rate', 'Discount value') AND b.dml_ind <> 'DELETE'
    AND b.billing_offer_effective_date <= {LAST}
    AND coalesce(b.billing_offer_expiration_date, DATE '{CLOSE_TS:%Y-%m-%d}') > {LAST}),
values_ AS (
  SELECT DISTINCT parc.subscriber_key, a.assigned_product_key AS k, m.parameter_value AS v,
         lower(m.assigned_product_parameter_id) AS id
  FROM src_assigned_product a
  JOIN parc ON parc.subscriber_key = a.subscriber_key
  LEFT JOIN src_assigned_product_parameter m ON m.assigned_product_key = a.assigned_product_key
    AND m.product_parameter_key {PARAMETER} AND m.dml_ind <> 'DELETE'
  WHERE a.product_key = '2448119' AND {live('a', *AP, LAST)} AND {at_end.format('a')}
    AND a.dml_ind <> 'DELETE'),
promo AS (
  SELECT a.subscriber_key, o.product_key, p.product_desc, b.billing_attribute_default_val AS raw,
         o.provision_date, p.price_plan_promotion_interval, p.price_plan_promotion_duration
  FROM src_assigned_product a
  JOIN parc ON parc.subscriber_key = a.subscriber_key
  LEFT JOIN src_assigned_billing_offer o ON o.subscriber_key = a.subscriber_key
    AND o.assigned_product_id = a.assigned_product_id AND o.parent_product_key {PROMO}
    AND {live('o', *ABO, LAST)} AND {at_end.format('o')}
  LEFT JOIN src_product p ON p.product_key = o.product_key
  LEFT JOIN src_product_billing_parameters b ON b.product_key = o.product_key
    AND b.billing_attribute_name IN ('Discount value', 'Discount type') AND {CURRENT}
  WHERE a.product_key {PROMO} AND {live('a', *AP, LAST)} AND {at_end.format('a')}
    AND a.customer_key IS NOT NULL AND o.product_key IS NOT NULL),
{promo_ctes('promo', 'DISTINCT')},
{BILLED},
wide AS (
  SELECT DISTINCT parc.rut_id AS rut, parc.customer_name AS razon_social, parc.billing_cycle_key AS ciclo,
         parc.subscriber_key, parc.financial_account_key AS account,
         parc.primary_resource_value AS msisdn, parc.customer_key,
         strftime(parc.gain_date_access_mngctr, '%Y%m%d') AS activada,
         parc.customer_sub_type_desc AS segmento, parc.product_key AS plan_key,
         parc.product_desc AS plan_text, {whole('coalesce(billed.arpu, 0)')} AS arpu,
         coalesce(c_datos.v, 0) AS cf_datos, coalesce(c_voz.v, 0) AS cf_voz,
         coalesce(d_datos.v, 0) AS dsc_cf_datos, coalesce(d_voz.v, 0) AS dsc_cf_voz,
         a_datos.v AS adi_datos, k_datos.v AS tipo_datos, a_voz.v AS adi_voz, k_voz.v AS tipo_voz,
         {SLOT_COLUMNS}, e.product_desc IS NOT NULL AS fin,
         g.product_valid_from_date AS created, l.product_key IS NOT NULL AS listed,
         parc.product AS kind
  FROM parc
  LEFT JOIN src_product_catalog g ON g.product_key = parc.product_key
  {" ".join(
      f"LEFT JOIN charges {name} ON {name}.subscriber_key = parc.subscriber_key "
      f"AND {name}.item LIKE '{pattern}'" for name, pattern in (
          ("c_datos", "%cargo%datos%"), ("c_voz", "%cargo%voz%"),
          ("d_datos", "%desc%datos%"), ("d_voz", "%desc%voz%")))}
  LEFT JOIN values_ a_datos ON a_datos.subscriber_key = parc.subscriber_key
    AND a_datos.id LIKE '%amountdata%' AND trunc({number('a_datos.v')}) <> 0
  LEFT JOIN values_ k_datos ON k_datos.subscriber_key = parc.subscriber_key
    AND k_datos.id LIKE '%typedata%' AND k_datos.k = a_datos.k
  LEFT JOIN values_ a_voz ON a_voz.subscriber_key = parc.subscriber_key
    AND a_voz.id LIKE '%amountvoice%' AND a_voz.v <> '0'
  LEFT JOIN values_ k_voz ON k_voz.subscriber_key = parc.subscriber_key
    AND k_voz.id LIKE '%typevoice%' AND k_voz.k = a_voz.k
{slot_joins('parc')}
  LEFT JOIN src_cycle_discounts e ON e.product_key = parc.product_key
  LEFT JOIN billed ON billed.subscriber_key = parc.subscriber_key
  LEFT JOIN src_plan_list l ON l.product_key = parc.product_key),
{finish('wide', True, False, ', '.join(f'{name} DESC NULLS LAST' for name in shown),
        f"'{CLOSE_TS:%Y%m%d %H:%M:%S}'", 'cf_datos + cf_voz - dsc_cf_datos - dsc_cf_voz')}"""


def daily_snapshot_v2(legacy: bool = False) -> str:
    numeric = f"{number('raw')} IS NOT NULL"
    slots = ",\n".join(
        f"n_{k} AS (SELECT subscriber_key, {number('raw')} AS v_{k}, provision_date AS i_{k}, "
        f"fin AS f_{k} FROM promo WHERE pos = {k} AND {numeric}),\n"
        f"w_{k} AS (SELECT subscriber_key, raw AS t_{k} FROM promo "
        f"WHERE pos = {k} AND NOT ({numeric}))" for k in SLOTS
    )
    joins = "\n".join(
        f"  LEFT JOIN n_{k} ON n_{k}.subscriber_key = s.subscriber_key "
        f"LEFT JOIN w_{k} ON w_{k}.subscriber_key = s.subscriber_key" for k in SLOTS
    )
    rule = (
        {"labelled": legacy_label("(adi_datos IS NOT NULL)", "(adi_voz IS NOT NULL)", "fin", "pun")}
        if legacy else {}
    )
    kind_text = "e.product_desc" if legacy else "p.product_desc"
    return f"""WITH {domain_ctes(
        'assigned_product', 'customer', 'subscribers', 'assigned_product_parameter', 'product',
        'customer_sub_type', 'assigned_billing_offer', 'product_billing_parameters',
        'billing_detail', 'parc_kfactor', 'cycle_discounts', 'plan_list')},
plan AS (
  SELECT subscriber_key, product_key, row_number() OVER (
           PARTITION BY subscriber_key
           ORDER BY start_date DESC NULLS LAST, product_key DESC, assigned_product_id DESC) AS pos
  FROM src_assigned_billing_offer o WHERE parent_product_key = '2053' AND {live('o', *ABO)}),
charges AS (
  SELECT product_key, trim(item_name) AS item, {number('billing_attribute_default_val')} AS v
  FROM src_product_billing_parameters b
  WHERE billing_attribute_name IN ('Rate', 'Discount value') AND {CURRENT}),
held AS (
  SELECT subscriber_key, assigned_product_key, row_number() OVER (
           PARTITION BY subscriber_key
           ORDER BY start_date DESC NULLS LAST, assigned_product_key DESC) AS pos
  FROM src_assigned_product a
  WHERE product_key = '2448119' AND {live('a', *AP)} AND customer_key IS NOT NULL),
values_ AS (
  SELECT DISTINCT held.subscriber_key, trim(m.assigned_product_parameter_id) AS id,
         m.parameter_value AS v
  FROM held LEFT JOIN src_assigned_product_parameter m
    ON m.assigned_product_key = held.assigned_product_key AND m.product_parameter_key {PARAMETER}
  WHERE held.pos = 1),
offers AS (
  SELECT *, row_number() OVER (
           PARTITION BY subscriber_key
           ORDER BY provision_date NULLS FIRST, product_key, assigned_product_id) AS pos
  FROM src_assigned_billing_offer o WHERE parent_product_key {PROMO} AND {live('o', *ABO)}),
promo AS (
  SELECT DISTINCT offers.subscriber_key, provision_date, {FIN} AS fin,
         b.billing_attribute_default_val AS raw, pos
  FROM offers
  LEFT JOIN src_product_billing_parameters b ON b.product_key = offers.product_key
    AND b.billing_attribute_name IN ('Discount type', 'Discount value') AND {CURRENT}
    AND trim(b.item_name) IN ('Descuento Promocional Datos', 'Descuento Promocional Voz')
  LEFT JOIN src_product p ON p.product_key = offers.product_key),
{slots},
{BILLED},
wide AS (
  SELECT c.rut_id AS rut, c.customer_legal_name AS razon_social, c.billing_cycle_key AS ciclo,
         s.subscriber_key, x.financial_account_key AS account,
         s.primary_resource_value AS msisdn, s.customer_key,
         strftime(s.original_activation_date, '%Y%m%d') AS activada,
         CASE WHEN t.customer_sub_type_desc IN ('Mediana Estándar', 'Mediana') THEN 'Mediana Empresa'
              WHEN t.customer_sub_type_desc IN ('Pequeña Estándar', 'Pequeña') THEN 'Pequeña Empresa'
              ELSE t.customer_sub_type_desc END AS segmento,
         plan.product_key AS plan_key, p.product_desc AS plan_text, {whole('billed.arpu')} AS arpu,
         c_datos.v AS cf_datos, c_voz.v AS cf_voz, d_datos.v AS dsc_cf_datos, d_voz.v AS dsc_cf_voz,
         a_datos.v AS adi_datos, k_datos.v AS tipo_datos, a_voz.v AS adi_voz, k_voz.v AS tipo_voz,
         {SLOT_COLUMNS}, e.product_desc IS NOT NULL AS fin, NULL AS created,
         l.descripcion IS NOT NULL AS listed, {kind_of('x.product', kind_text)} AS kind,
         x.product AS known
  FROM (SELECT * FROM src_customer WHERE {CUSTOMERS.format(keys=SUB_TYPES)}) c
  JOIN src_customer_sub_type t ON t.customer_sub_type_key = c.customer_sub_type_key
    AND t.customer_sub_type_key IN ({SUB_TYPES})
  JOIN src_subscribers s ON s.customer_key = c.customer_key
    AND s.subscriber_status_key IN ('1376', '1378', '1379')
    AND s.calculated_payment_category_ke IN ('1402', '1403')
    AND TRY_CAST(s.primary_resource_value AS BIGINT) IS NOT NULL
  LEFT JOIN plan ON plan.subscriber_key = s.subscriber_key AND plan.pos = 1
  LEFT JOIN src_product p ON p.product_key = plan.product_key
  {" ".join(
      f"LEFT JOIN charges {name} ON {name}.product_key = plan.product_key AND {name}.item = '{item}'"
      for name, item in (
          ("c_datos", "Cargo Fijo Datos"), ("c_voz", "Cargo Fijo Voz"),
          ("d_datos", "Descuento Multiproducto Datos"), ("d_voz", "Descuento Multiproducto Voz")))}
  {" ".join(
      f"LEFT JOIN values_ {name} ON {name}.subscriber_key = s.subscriber_key AND {name}.id = '{item}'"
      for name, item in (
          ("a_datos", "DiscountaAmountDataRC"), ("k_datos", "DiscountTypeData"),
          ("a_voz", "DiscountAmountVoiceRC"), ("k_voz", "DiscountTypeVoice")))}
{joins}
  LEFT JOIN src_cycle_discounts e ON e.product_key = plan.product_key
  LEFT JOIN src_plan_list l ON l.product_key = plan.product_key
  LEFT JOIN src_parc_kfactor x ON x.subscriber_key = s.subscriber_key
  LEFT JOIN billed ON billed.subscriber_key = s.subscriber_key),
{finish('wide', True, False,
        ', '.join(f't_{k} DESC NULLS LAST' for k in SLOTS)
        + ', account DESC NULLS LAST, known DESC NULLS LAST',
        f"DATE '{AS_OF}'", whole('cf_datos + cf_voz - dsc_cf_datos - dsc_cf_voz'), **rule)}"""
