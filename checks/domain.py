"""The driver's tables dressed as the report's source tables.

Each entry is one SELECT over whole driver tables in SQL that Spark and DuckDB
both run, with ``{table}`` in place of the inputs, so the Spark queries and the
SQL they are compared with see the same source rows. Orders stand for assigned
products, their lines for billing offers and parameter values, parts for
products, events for billing lines.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from planledger.contracts import TABLES, normalise

AS_OF = date(2024, 1, 15)
RUN_TS = datetime(2024, 1, 15, 6, 30, 0)
PERIOD = "202401"
CLOSE_TS = datetime(2024, 2, 5, 6, 30, 0)

_PBP = """SELECT concat('P', cast(p_partkey AS string)) AS product_key,
       {item} AS item_name, '{attribute}' AS billing_attribute_name,
       CASE WHEN p_partkey % 41 = 0 THEN 'DELETE' ELSE 'INSERT' END AS dml_ind,
       {value} AS billing_attribute_default_val,
       cast('2020-01-01' AS date) AS billing_offer_effective_date,
       CASE WHEN p_partkey % 37 = 0 THEN cast('2030-01-01' AS date) END AS billing_offer_expiration_date,
       CASE WHEN p_partkey % 43 = 0 THEN cast('2030-01-01' AS date) END AS package_expiration_date
FROM {{part}} WHERE {where}"""


def _pbp(item: str, attribute: str, value: str, where: str) -> str:
    return _PBP.format(item=item, attribute=attribute, value=value, where=where)


SOURCES: dict[str, str] = {
    "assigned_product": """
SELECT CASE o_orderkey % 4 WHEN 0 THEN '2053' WHEN 1 THEN '2448119' WHEN 2 THEN '2713'
            ELSE '3133' END AS product_key,
       cast(o_custkey AS string) AS subscriber_key,
       cast(o_orderkey AS string) AS assigned_product_key,
       concat('A', cast(o_orderkey % 3 AS string)) AS assigned_product_id,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE cast(o_custkey AS string) END AS customer_key,
       CASE o_orderstatus WHEN 'O' THEN '1351' WHEN 'F' THEN ' 1359 ' ELSE '1360' END
           AS assigned_product_status_key,
       '1331' AS assigned_product_state_key,
       cast(o_orderdate AS date) AS start_date,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE cast(o_orderdate AS date) + 10000 END AS end_date,
       CASE WHEN o_orderkey % 23 = 0 THEN 'DELETE' ELSE 'UPDATE' END AS dml_ind
FROM {orders}""",
    "customer": """
SELECT cast(c_custkey AS string) AS customer_key,
       CASE c_nationkey % 5 WHEN 0 THEN '3042' WHEN 1 THEN '3044' WHEN 2 THEN '3053'
            WHEN 3 THEN '3081' ELSE '3055' END AS customer_sub_type_key,
       cast(c_nationkey AS string) AS billing_cycle_key,
       CASE WHEN c_custkey % 50 = 7 THEN '#' ELSE concat('R', cast(c_custkey AS string)) END AS rut_id,
       concat(c_name, ' | SA') AS customer_legal_name,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'R' ELSE 'C' END AS customer_type_ind,
       CASE WHEN c_custkey % 47 = 3 THEN 'DELETE' ELSE 'INSERT' END AS dml_ind
FROM {customer}""",
    "subscribers": """
SELECT concat(' ', cast(c_custkey AS string)) AS subscriber_key,
       cast(c_custkey - c_custkey % 2 AS string) AS customer_key,
       CASE c_custkey % 7 WHEN 0 THEN '1376' WHEN 1 THEN '1377' WHEN 2 THEN '1378' ELSE '1379' END
           AS subscriber_status_key,
       CASE c_custkey % 5 WHEN 4 THEN '1401' WHEN 3 THEN '1403' ELSE '1402' END
           AS calculated_payment_category_ke,
       CASE WHEN c_custkey % 11 = 5 THEN concat('x', c_name)
            ELSE cast(56900000000 + c_custkey AS string) END AS primary_resource_value,
       cast('2015-03-01' AS date) + cast(c_custkey % 2000 AS int) AS original_activation_date
FROM {customer}""",
    "assigned_product_parameter": """
SELECT cast(l_orderkey AS string) AS assigned_product_key,
       CASE WHEN l_linenumber = 7 THEN '1' ELSE '26754' END AS product_parameter_key,
       CASE l_linenumber WHEN 1 THEN ' DiscountaAmountDataRC' WHEN 2 THEN 'DiscountTypeData'
            WHEN 3 THEN 'DiscountAmountVoiceRC' WHEN 4 THEN 'DiscountTypeVoice'
            ELSE 'Other' END AS assigned_product_parameter_id,
       CASE WHEN l_linenumber IN (2, 4)
                THEN CASE WHEN l_suppkey % 2 = 0 THEN 'Fixed' ELSE 'Percent' END
            WHEN l_quantity = 50 THEN 'NaN'
            WHEN l_quantity = 49 THEN 'Infinity'
            WHEN l_quantity = 48 THEN '1d'
            WHEN l_quantity = 47 THEN '2e1'
            WHEN l_quantity < 6 THEN '0'
            WHEN l_quantity < 11 THEN '00'
            ELSE cast(cast(l_quantity AS int) AS string) END AS parameter_value,
       CASE WHEN l_returnflag = 'R' AND l_tax = 0 THEN 'DELETE' ELSE 'INSERT' END AS dml_ind
FROM {lineitem}""",
    "product": """
SELECT concat('P', cast(p_partkey AS string)) AS product_key,
       CASE p_partkey % 5 WHEN 0 THEN concat(p_name, ' BAM') WHEN 1 THEN concat(p_name, ' 10% dcto')
            WHEN 2 THEN concat(p_name, ' 20% promo') WHEN 3 THEN concat(p_name, ' 5% SMS')
            ELSE p_name END AS product_desc,
       CASE p_type WHEN 'PROMO' THEN 'M' WHEN 'SMALL' THEN 'M' WHEN 'LARGE' THEN 'X' ELSE 'D' END
           AS price_plan_promotion_interval,
       p_size AS price_plan_promotion_duration
FROM {part} WHERE p_partkey % 23 <> 0
UNION ALL SELECT '2053', 'Plan Empresa GPS', 'M', 1
UNION ALL SELECT '2448119', 'Descuento Parametrico', 'M', 1""",
    "customer_sub_type": """
SELECT CASE n_nationkey WHEN 0 THEN '3042' WHEN 1 THEN '3044' WHEN 2 THEN '3053'
            WHEN 3 THEN '3081' ELSE cast(n_nationkey AS string) END AS customer_sub_type_key,
       CASE n_nationkey WHEN 0 THEN 'Mediana' WHEN 1 THEN 'Pequeña Estándar' ELSE n_name END
           AS customer_sub_type_desc
FROM {nation}""",
    "assigned_billing_offer": """
SELECT cast(o_custkey AS string) AS subscriber_key,
       concat('A', cast(l_orderkey % 3 AS string)) AS assigned_product_id,
       CASE WHEN l_partkey % 53 = 0 THEN '2053'
            ELSE concat('P', cast(l_partkey AS string)) END AS product_key,
       CASE l_linenumber WHEN 1 THEN '2053' WHEN 2 THEN '2053' WHEN 3 THEN '2713' WHEN 4 THEN '3133'
            WHEN 5 THEN '18865' WHEN 6 THEN '2713' ELSE '9' END AS parent_product_key,
       '1331' AS asgn_blng_ofr_state_key,
       CASE WHEN l_returnflag = 'R' THEN '1351' ELSE '1359' END AS asgn_blng_ofr_status_key,
       cast(l_shipdate AS date) AS provision_date,
       cast(o_orderdate AS date) AS start_date,
       cast(l_shipdate AS date) + 10200 AS end_date
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey""",
    "product_catalog": """
SELECT concat('P', cast(p_partkey AS string)) AS product_key,
       cast('2018-01-01' AS date) + cast(p_partkey % 1500 AS int) AS product_valid_from_date
FROM {part}""",
    "product_billing_parameters": "\nUNION ALL\n".join([
        _pbp("'Cargo Fijo Datos'", "Rate",
             "CASE WHEN p_partkey % 61 = 5 THEN 'NaN' WHEN p_partkey % 61 = 6 THEN 'Infinity' "
             "ELSE cast(cast(floor(p_retailprice) AS int) * p_size AS string) END", "p_type <> 'ECONOMY'"),
        _pbp("' Cargo Fijo Voz '", "Rate",
             "cast(cast(floor(p_retailprice) AS int) + p_size AS string)",
             "p_type IN ('PROMO', 'SMALL', 'STANDARD', 'MEDIUM')"),
        _pbp("'Descuento Multiproducto Datos'", "Discount value",
             "cast(p_size * 3 AS string)", "p_type IN ('PROMO', 'SMALL', 'LARGE')"),
        _pbp("'Descuento Multiproducto Voz'", "Discount value",
             "cast(p_size * 25 AS string)", "p_type NOT IN ('LARGE', 'MEDIUM')"),
        _pbp("'Descuento Promocional Datos'", "Discount value",
             "CASE WHEN p_size % 10 = 0 THEN '0' WHEN p_size % 17 = 3 THEN '1d' "
             "ELSE cast(p_size * 2 AS string) END",
             "p_type <> 'STANDARD'"),
        _pbp("'Descuento Promocional Datos'", "Discount type", "'Percent'", "p_size > 10"),
    ]),
    "billing_detail": """
SELECT cast(user_id AS string) AS subscriber_key,
       CASE WHEN user_id % 10 = 9 THEN 'Personas' ELSE 'Gran Empresa' END AS customer_sub_type_desc,
       CASE WHEN user_id % 2 = 0 THEN 'Postpaid Payment' ELSE 'Hybrid Payment' END
           AS payment_category_desc,
       CASE event_type WHEN 'view' THEN 'RM_VOZ_PL_POS' WHEN 'click' THEN 'RM_DAT_PL_POS'
            WHEN 'purchase' THEN 'OM_EQU_SUBS' ELSE 'OTHER' END AS charge_code_id,
       cast(ts AS date) AS bill_date, cast(ts AS date) AS close_date,
       cast(value AS decimal(18,2)) AS charge_amount
FROM {events}""",
    "parc_kfactor": """
SELECT cast(o_custkey AS string) AS subscriber_key,
       concat('F', cast(o_orderkey % 1000 AS string)) AS financial_account_key,
       CASE o_orderstatus WHEN 'P' THEN 'T' ELSE 'A' END AS subscriber_status_id,
       CASE WHEN o_orderkey % 3 = 0 THEN 'R' ELSE 'C' END AS customer_type_ind,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS product
FROM {orders}""",
    "parc_sist": """
SELECT cast(c_custkey AS string) AS subcriptor,
       CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END AS tipo_plan
FROM {customer} WHERE c_acctbal > 2000""",
    "parc_coliving": """
SELECT concat(cast(o_custkey AS string), ' ') AS subscriber_key,
       concat('P', cast(l_partkey AS string)) AS product_key,
       cast(o_custkey AS string) AS customer_key,
       concat('F', cast(o_orderkey AS string)) AS financial_account_key,
       cast(o_orderkey % 28 AS string) AS billing_cycle_key,
       concat('R', cast(o_custkey AS string)) AS rut_id,
       concat('Empresa|', cast(o_custkey AS string)) AS customer_name,
       cast(o_orderkey AS string) AS primary_resource_value,
       CASE o_orderpriority WHEN '1-URGENT' THEN ' Mediana Empresa' WHEN '2-HIGH' THEN 'Micro '
            WHEN '3-MEDIUM' THEN 'Corporaciones' ELSE 'Personas' END AS customer_sub_type_desc,
       CASE WHEN o_orderstatus = 'P' THEN 'Prepaid' ELSE 'Postpaid Payment ' END
           AS payment_category_desc,
       concat('Plan ', cast(l_partkey AS string)) AS product_desc,
       CASE WHEN l_linenumber = 1 THEN 'VOZ' ELSE 'BAM' END AS product,
       'AMD' AS sistema_origen,
       CASE WHEN l_returnflag <> 'A' AND l_linenumber IN (1, 7) THEN 1 ELSE 0 END AS valid_ind,
       cast('2024-01-31' AS date) AS close_date,
       cast(o_orderdate AS date) AS gain_date_access_mngctr
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey""",
    "cycle_discounts": """
SELECT concat('P', cast(p_partkey AS string)) AS product_key, p_name AS product_desc
FROM {part} WHERE p_type = 'PROMO'""",
    "plan_list": """
SELECT concat('P', cast(p_partkey AS string)) AS product_key,
       CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS descripcion
FROM {part} WHERE p_type IN ('SMALL', 'MEDIUM')""",
}

#: Columns that the Spark side reads as numbers, as warehouse tables fed from other databases
#: carry them; the SQL compares the texts.
NUMBERS = {
    "assigned_product": {
        "product_key": "decimal(38,10)", "assigned_product_key": "decimal(38,0)",
        "assigned_product_status_key": "double", "assigned_product_state_key": "decimal(38,10)",
    },
    "subscribers": {
        "subscriber_key": "decimal(38,10)", "customer_key": "double",
        "subscriber_status_key": "decimal(38,0)", "calculated_payment_category_ke": "decimal(6,2)",
    },
    "customer": {"customer_key": "decimal(20,4)", "customer_sub_type_key": "double"},
    "assigned_product_parameter": {"assigned_product_key": "double", "product_parameter_key": "decimal(38,10)"},
    "assigned_billing_offer": {"subscriber_key": "double", "asgn_blng_ofr_status_key": "decimal(38,10)"},
    "parc_coliving": {"subscriber_key": "decimal(38,10)"},
}

VIEW_TABLES = (
    "assigned_product", "customer", "subscribers", "assigned_product_parameter", "product",
    "customer_sub_type", "assigned_billing_offer", "product_catalog",
    "product_billing_parameters",
)
INPUTS = ("nation", "customer", "part", "orders", "lineitem", "events")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def domain_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named source tables (all by default), normalised as on read."""
    wanted = names or tuple(SOURCES)
    raw = {
        key: read(spark, sf_dir, key) for key in INPUTS
        if any("{" + key + "}" in SOURCES[name] for name in wanted)
    }

    def table(name: str) -> DataFrame:
        used = {key: df for key, df in raw.items() if "{" + key + "}" in SOURCES[name]}
        rows = spark.sql(SOURCES[name], **used)
        numbers = {column: F.trim(column).cast(kind) for column, kind in NUMBERS.get(name, {}).items()}
        return normalise(rows.withColumns(numbers) if numbers else rows, name)

    return {name: table(name) for name in wanted}


def domain_ctes(*names: str) -> str:
    """The same tables as SQL common table expressions, keys trimmed."""
    same = {name: name for name in INPUTS}

    def cte(name: str) -> str:
        columns = ", ".join(
            f"trim({column}) AS {column}" if kind in ("key", "code") else column
            for column, kind in TABLES[name].items()
        )
        return f"src_{name} AS (SELECT {columns} FROM ({SOURCES[name].format(**same)}) AS s)"

    return ",\n".join(cte(name) for name in names or SOURCES)
