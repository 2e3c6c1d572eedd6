"""Row selection and projection of the source tables (all narrow, no shuffle but distinct).

Every function takes a normalised frame and returns a frame. Comparisons follow
SQL's three-valued logic, so a null status, flag or date drops the row.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from planledger import config as C
from planledger.contracts import digits_before_point, is_number, normalise_keys
from planledger.functions.calendar import promo_end
from planledger.functions.text import contains_in_order


def code_in(df: DataFrame, name: str, codes: tuple) -> Column:
    """Whether a code column holds one of ``codes``, compared in the column's own type."""
    kind = dict(df.dtypes).get(name, "string")
    if not is_number(kind):
        return F.col(name).isin(*codes)
    room = digits_before_point(kind)
    fitting = [int(code) for code in codes if room is None or len(code) <= room]
    return F.col(name).isin(*[F.lit(code).cast(kind) for code in fitting])


def valid_at(
    df: DataFrame, start: str | None, end: str, d: date, open_end: date | None = None
) -> DataFrame:
    """Rows whose half-open interval ``[start, end)`` holds ``d``.

    Without ``start`` only ``end > d`` counts. ``open_end`` stands in for a null
    end; without it a null end drops the row.
    """
    until = F.col(end) if open_end is None else F.coalesce(F.col(end), F.lit(open_end))
    condition = until > F.lit(d)
    if start is not None:
        condition = (F.col(start) <= F.lit(d)) & condition
    return df.filter(condition)


def eligible_accounts(
    parc: DataFrame,
    excluded_status: tuple = C.EXCLUDED_ACCOUNT_STATUS,
    type_ind: str = "C",
    status: str = "subscriber_status_id",
    kind: str = "customer_type_ind",
    account: str = "financial_account_key",
    subscriber: str = "subscriber_key",
) -> DataFrame:
    """Distinct (account, subscriber) pairs of active business lines."""
    return (
        parc.filter(
            ~F.col(status).isin(*excluded_status)
            & (F.col(kind) == type_ind)
            & F.col(account).isNotNull()
            & F.col(subscriber).isNotNull()
        )
        .select(account, subscriber)
        .distinct()
    )


def eligible_subscribers(
    subs: DataFrame,
    statuses: tuple = C.SUBSCRIBER_STATUS_KEYS,
    categories: tuple = C.PAYMENT_CATEGORY_KEYS,
    numeric_phone: bool = False,
    status: str = "subscriber_status_key",
    category: str = "calculated_payment_category_ke",
    phone: str = "primary_resource_value",
) -> DataFrame:
    """Active subscribers who pay by bill; optionally only those with a number as phone."""
    condition = code_in(subs, status, statuses) & code_in(subs, category, categories)
    if numeric_phone:
        condition = condition & F.col(phone).try_cast("bigint").isNotNull()
    return subs.filter(condition)


def business_customers(
    cust: DataFrame,
    sub_type_keys: tuple = C.SUB_TYPE_KEYS,
    kind: str = "customer_type_ind",
    rut: str = "rut_id",
    dml: str = "dml_ind",
    sub_type: str = "customer_sub_type_key",
) -> DataFrame:
    """Business customers with a tax id, not deleted, of the listed sub-types."""
    return cust.filter(
        (F.col(kind) == "C")
        & (F.col(rut) != "#")
        & (F.col(dml) != "DELETE")
        & F.col(sub_type).isin(*sub_type_keys)
    )


def sub_types(
    dim: DataFrame,
    keys: tuple | None = None,
    relabel: dict[str, str] | None = None,
    key: str = "customer_sub_type_key",
    desc: str = "customer_sub_type_desc",
) -> DataFrame:
    """The segment dimension, optionally restricted and with labels merged."""
    label = F.col(desc)
    for old, new in (relabel or {}).items():
        label = F.when(F.col(desc) == old, new).otherwise(label)
    rows = dim if keys is None else dim.filter(F.col(key).isin(*keys))
    return rows.select(key, label.alias(desc))


def live_products(
    ap: DataFrame,
    product_keys: tuple,
    as_of: date,
    at_period_end: bool = False,
    drop_deleted: bool = False,
    need_customer: bool = True,
    product: str = "product_key",
    status: str = "assigned_product_status_key",
    state: str = "assigned_product_state_key",
    customer: str = "customer_key",
    statuses: tuple = C.LIVE_STATUS_KEYS,
    live_state: str = C.LIVE_STATE_KEY,
    start: str = "start_date",
    end: str = "end_date",
    dml: str = "dml_ind",
) -> DataFrame:
    """Assigned products of ``product_keys`` that run at ``as_of``.

    ``at_period_end`` also asks that they have started by then.
    """
    condition = (
        code_in(ap, product, product_keys)
        & code_in(ap, status, statuses)
        & code_in(ap, state, (live_state,))
    )
    if need_customer:
        condition = condition & F.col(customer).isNotNull()
    if drop_deleted:
        condition = condition & (F.col(dml) != "DELETE")
    live = valid_at(ap.filter(condition), start if at_period_end else None, end, as_of)
    # From here on the product is a key to join by.
    return normalise_keys(live, [product]) if is_number(dict(ap.dtypes)[product]) else live


def live_offers(
    abo: DataFrame,
    parent_keys: tuple,
    as_of: date,
    at_period_end: bool = False,
    parent: str = "parent_product_key",
    status: str = "asgn_blng_ofr_status_key",
    state: str = "asgn_blng_ofr_state_key",
    statuses: tuple = C.LIVE_STATUS_KEYS,
    live_state: str = C.LIVE_STATE_KEY,
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """Billing offers under ``parent_keys`` that run at ``as_of``."""
    rows = abo.filter(
        code_in(abo, state, (live_state,))
        & code_in(abo, status, statuses)
        & code_in(abo, parent, parent_keys)
    )
    return valid_at(rows, start if at_period_end else None, end, as_of)


def parameters(
    app: DataFrame,
    parameter_keys: tuple = C.PARAMETER_KEYS,
    drop_deleted: bool = False,
    key: str = "product_parameter_key",
    dml: str = "dml_ind",
) -> DataFrame:
    """Parameter values of the discount parameters."""
    rows = app.filter(code_in(app, key, parameter_keys))
    return rows.filter(F.col(dml) != "DELETE") if drop_deleted else rows


def current_billing_params(
    pbp: DataFrame, attributes: tuple, item_names: tuple | None = None
) -> DataFrame:
    """Product attributes without any expiry, optionally only of some (trimmed) item names."""
    condition = (
        F.col("billing_offer_expiration_date").isNull()
        & F.col("package_expiration_date").isNull()
        & (F.col("dml_ind") != "DELETE")
        & F.col("billing_attribute_name").isin(*attributes)
    )
    if item_names:
        condition = condition & F.trim("item_name").isin(*item_names)
    return pbp.filter(condition)


def dated_billing_params(
    pbp: DataFrame, attributes: tuple, d: date, open_end: date
) -> DataFrame:
    """Product attributes in force on ``d``; an open offer counts as ending on ``open_end``."""
    rows = pbp.filter(
        F.col("billing_attribute_name").isin(*attributes) & (F.col("dml_ind") != "DELETE")
    )
    return valid_at(
        rows, "billing_offer_effective_date", "billing_offer_expiration_date", d, open_end
    )


def parc_base(
    parc: DataFrame,
    segments: tuple = C.PARC_SEGMENTS,
    categories: tuple = C.PAYMENT_CATEGORIES,
    origin: str = C.PARC_ORIGIN,
    segment: str = "customer_sub_type_desc",
    category: str = "payment_category_desc",
    valid: str = "valid_ind",
    source: str = "sistema_origen",
    activated: str = "gain_date_access_mngctr",
) -> DataFrame:
    """Valid business lines of the monthly parc, with the activation date as ``yyyyMMdd``."""
    return parc.filter(
        F.trim(segment).isin(*segments)
        & F.trim(category).isin(*categories)
        & (F.col(valid) == 1)
        & (F.col(source) == origin)
    ).withColumn("original_activation_date", F.date_format(activated, "yyyyMMdd"))


def plan_dates(
    catalog: DataFrame,
    key: str = "product_key",
    created: str = "product_valid_from_date",
    fmt: str | None = None,
) -> DataFrame:
    """Creation date per plan, as date or formatted."""
    value = F.col(created) if fmt is None else F.date_format(created, fmt)
    return catalog.select(key, value.alias(created))


def products(
    product: DataFrame, columns: tuple = (
        "product_key", "product_desc", "price_plan_promotion_interval",
        "price_plan_promotion_duration",
    )
) -> DataFrame:
    """The product dimension."""
    return product.select(*columns)


def promo_text(desc: Column) -> Column:
    """Whether a description is that of a percentage promotion on charges."""
    return (
        contains_in_order(desc, "%")
        & ~contains_in_order(desc, "SMS")
        & ~contains_in_order(desc, "BOLSA", "DATO")
    )


def promo_values(
    product: DataFrame,
    params: DataFrame,
    key: str = "product_key",
    desc: str = "product_desc",
    value: str = "billing_attribute_default_val",
) -> DataFrame:
    """The promotion values each product carries: the product-level half of the promo lines.

    Rows whose value is the word Percent (or null) and products that are no
    percentage promotion drop out, so both joins are inner. Both inputs are
    catalog-sized and keep one row per (product, value) as they come.
    """
    return product.filter(promo_text(F.col(desc))).join(
        params.filter(F.lower(value) != "percent").select(key, value), key
    )


def promo_dates(
    df: DataFrame,
    start: str = "provision_date",
    interval: str = "price_plan_promotion_interval",
    duration: str = "price_plan_promotion_duration",
) -> DataFrame:
    """Name the promo's first day and compute its last one."""
    return df.withColumns({
        "inicio": F.col(start),
        "fin": promo_end(F.col(start), F.col(interval), F.col(duration)),
    }).drop(interval, duration)


def base_rows(
    view: DataFrame,
    columns: tuple = (
        "rut_id", "customer_legal_name", "billing_cycle_key", "subscriber_key", "msisdn",
        "customer_key", "sub_type", "cod_plan_amdocs", "product_desc", "start_date",
        "original_activation_date", "product_valid_from_date",
    ),
    desc: str = "product_desc",
    hidden: tuple = C.HIDDEN_PLAN_WORDS,
) -> DataFrame:
    """Distinct plan rows of the charges (or base) view whose description is not the hidden one (nor null)."""
    return view.filter(~contains_in_order(F.col(desc), *hidden)).select(*columns).distinct()
