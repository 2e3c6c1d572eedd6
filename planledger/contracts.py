"""Column contracts of the source tables, and the normalisation done on read.

Keys arrive as numbers of any type or as padded strings depending on the source, so every
key is read as a trimmed string, and a number that is whole as its digits: 2053 as an int,
as decimal(38,10) and as a double are one key. Dates are read as dates and money as
decimal. All columns are nullable. ``KEY`` marks the columns that are joined by and
therefore strings. ``CODE`` marks the columns that only code lists are compared with:
numbers stay what they are, so that such a filter reaches the parquet reader in the
column's own type, and texts are trimmed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

KEY = "key"
CODE = "code"
MONEY = "decimal(18,2)"
#: The types of numbers, as ``DataFrame.dtypes`` names them.
WHOLE = ("tinyint", "smallint", "int", "bigint")
FRACTIONAL = ("float", "double")


def is_number(kind: str) -> bool:
    return kind in WHOLE or kind in FRACTIONAL or kind.startswith("decimal")


def digits_before_point(kind: str) -> int | None:
    """How many digits a decimal type has in front of its point; null for other types."""
    if not kind.startswith("decimal("):
        return None
    precision, scale = kind.removeprefix("decimal(").rstrip(")").split(",")
    return int(precision) - int(scale)


def key_text(name: str, kind: str) -> str:
    """SQL for a key column as text: trimmed, and the digits alone where a number is whole."""
    text = f"trim(cast({name} AS string))"
    if kind.startswith("decimal") and not kind.endswith(",0)"):
        plain = f"trim(TRAILING '.' FROM trim(TRAILING '0' FROM cast({name} AS string)))"
        return f"if({name} = 0, '0', {plain})"
    if kind in FRACTIONAL:
        # Beyond 2**53 a double no longer tells whole numbers apart; such a key stays as it is written.
        whole = f"abs({name}) < 9007199254740992 AND {name} = floor({name})"
        return f"if({whole}, cast(try_cast({name} AS bigint) AS string), {text})"
    return text

TABLES: dict[str, dict[str, str]] = {
    "assigned_product": {
        "product_key": CODE, "subscriber_key": KEY, "assigned_product_key": KEY,
        "assigned_product_id": KEY, "customer_key": KEY,
        "assigned_product_status_key": CODE, "assigned_product_state_key": CODE,
        "start_date": "date", "end_date": "date", "dml_ind": "string",
    },
    "customer": {
        "customer_key": KEY, "customer_sub_type_key": KEY, "billing_cycle_key": KEY,
        "rut_id": "string", "customer_legal_name": "string",
        "customer_type_ind": "string", "dml_ind": "string",
    },
    "subscribers": {
        "subscriber_key": KEY, "customer_key": KEY, "subscriber_status_key": CODE,
        "calculated_payment_category_ke": CODE, "primary_resource_value": "string",
        "original_activation_date": "date",
    },
    "assigned_product_parameter": {
        "assigned_product_key": KEY, "product_parameter_key": CODE,
        "assigned_product_parameter_id": "string", "parameter_value": "string",
        "dml_ind": "string",
    },
    "product": {
        "product_key": KEY, "product_desc": "string",
        "price_plan_promotion_interval": "string", "price_plan_promotion_duration": "int",
    },
    "customer_sub_type": {"customer_sub_type_key": KEY, "customer_sub_type_desc": "string"},
    "assigned_billing_offer": {
        "subscriber_key": KEY, "assigned_product_id": KEY, "product_key": KEY,
        "parent_product_key": CODE, "asgn_blng_ofr_state_key": CODE,
        "asgn_blng_ofr_status_key": CODE, "provision_date": "date",
        "start_date": "date", "end_date": "date",
    },
    "product_catalog": {"product_key": KEY, "product_valid_from_date": "date"},
    "product_billing_parameters": {
        "product_key": KEY, "item_name": "string", "billing_attribute_name": "string",
        "dml_ind": "string", "billing_attribute_default_val": "string",
        "billing_offer_effective_date": "date", "billing_offer_expiration_date": "date",
        "package_expiration_date": "date",
    },
    "billing_detail": {
        "subscriber_key": KEY, "customer_sub_type_desc": "string",
        "payment_category_desc": "string", "charge_code_id": "string",
        "bill_date": "date", "close_date": "date", "charge_amount": MONEY,
    },
    "parc_kfactor": {
        "subscriber_key": KEY, "financial_account_key": KEY,
        "subscriber_status_id": "string", "customer_type_ind": "string", "product": "string",
    },
    "parc_sist": {"subcriptor": KEY, "tipo_plan": "string"},
    "parc_coliving": {
        "subscriber_key": KEY, "product_key": KEY, "customer_key": KEY,
        "financial_account_key": KEY, "billing_cycle_key": KEY, "rut_id": "string",
        "customer_name": "string", "primary_resource_value": "string",
        "customer_sub_type_desc": "string", "payment_category_desc": "string",
        "product_desc": "string", "product": "string", "sistema_origen": "string",
        "valid_ind": "int", "close_date": "date", "gain_date_access_mngctr": "date",
    },
    "cycle_discounts": {"product_key": KEY, "product_desc": "string"},
    "discount_offers": {"applied_to_ind": "string"},
    "plan_list": {"product_key": KEY, "descripcion": "string"},
}


def ddl(table: str) -> str:
    """The contract of ``table`` as a DDL string, for building typed frames."""
    return ", ".join(
        f"{name} {'string' if kind in (KEY, CODE) else kind}" for name, kind in TABLES[table].items()
    )


def normalise_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Cast ``keys`` to string, without padding and without the zeros behind a whole number."""
    kinds = dict(df.dtypes)
    return df.withColumns({key: F.expr(key_text(f"`{key}`", kinds[key])) for key in keys})


class CastLosses:
    """Counts, as the tables are read for a report, of values that a cast lost and of keys that are null.

    The counts come with the first action that reads a table; no job runs for them. To see every
    row they are taken before any filter, which then isn't pushed to the files, so they cost
    reading. Rows that one action reads again (a global sort, a stage recomputed after a lost
    executor) count again.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, table: str, casts: dict[str, str], keys: list[str]) -> DataFrame:
        """``df`` with its counts taken: of each of ``casts`` (column: type), and of null ``keys``."""
        counts = [
            F.count_if(F.col(name).isNotNull() & F.expr(f"try_cast(`{name}` AS {kind}) IS NULL")).alias(f"{name} lost")
            for name, kind in casts.items()
        ]
        counts += [F.count_if(F.col(name).isNull()).alias(f"{name} null") for name in keys]
        if not counts:
            return df
        self._seen[table] = Observation()
        return df.observe(self._seen[table], F.count(F.lit(1)).alias("rows"), *counts)

    def counts(self) -> dict[str, dict[str, int]]:
        """Per table its rows and its losses, once an action has read it."""
        return {table: dict(seen.get) for table, seen in self._seen.items()}


def normalise(df: DataFrame, table: str, losses: CastLosses | None = None) -> DataFrame:
    """Select the contract's columns in its types; ``losses`` counts what that loses.

    A column that already has its type passes through untouched, so that
    filters on it still reach the parquet reader.
    """
    actual = {name.lower(): kind for name, kind in df.dtypes}
    contract = TABLES[table]
    if losses is not None:
        casts = {name: kind for name, kind in contract.items() if kind not in (KEY, CODE) and actual[name] != kind}
        df = losses.watch(df, table, casts, [name for name, kind in contract.items() if kind == KEY])

    def column(name: str, kind: str) -> str:
        if kind == CODE and is_number(actual[name]):
            return f"{name} AS {name}"
        if kind in (KEY, CODE):
            return f"{key_text(name, actual[name])} AS {name}"
        if actual[name] == kind:
            return f"{name} AS {name}"
        return f"try_cast({name} AS {kind}) AS {name}"

    return df.selectExpr(*[column(name, kind) for name, kind in contract.items()])
