"""SQL for the queries in ``checks.queries``, written independently of the library."""

from __future__ import annotations

from checks import snapshot_oracles
from checks.domain import AS_OF, domain_ctes
from checks.snapshot_oracles import label, legacy_label

DAY = "DATE '1998-06-30'"

_FLAGS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
    l_returnflag = 'R' AS has_param, l_linestatus = 'O' AS has_promo,
    CAST(trunc(l_extendedprice - 2000) AS INTEGER) AS total,
    l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') AS in_cycle
  FROM lineitem"""


def _numbered(columns: str) -> str:
    return f"""SELECT l_orderkey, {columns}, row_number() OVER (
        PARTITION BY l_orderkey
        ORDER BY l_partkey, l_linenumber, l_suppkey, l_quantity, l_shipdate) AS slot FROM lineitem"""


_VIEW = f"""WITH {domain_ctes(
    'assigned_product', 'customer', 'subscribers', 'assigned_product_parameter', 'product',
    'customer_sub_type', 'assigned_billing_offer', 'product_catalog',
    'product_billing_parameters')}
SELECT {{columns}} FROM (
  SELECT c.rut_id, c.customer_legal_name, c.billing_cycle_key, s.subscriber_key,
         s.primary_resource_value AS msisdn, c.customer_key, t.customer_sub_type_desc AS sub_type,
         o.product_key AS cod_plan_amdocs,
         CASE WHEN a.product_key <> '2053' THEN a.product_key END AS cod_dto_tipo,
         CASE WHEN p2.product_key = '2053' THEN p2.product_desc ELSE p1.product_desc END AS product_desc,
         b.item_name AS prit, b.billing_attribute_default_val AS charge_val,
         m.assigned_product_parameter_id, m.parameter_value, a.start_date,
         s.original_activation_date, g.product_valid_from_date
  FROM src_assigned_product a
  JOIN src_subscribers s ON s.subscriber_key = a.subscriber_key
    AND s.subscriber_status_key IN ('1376', '1378', '1379')
    AND s.calculated_payment_category_ke IN ('1402', '1403')
  JOIN src_customer c ON c.customer_key = s.customer_key AND c.customer_type_ind = 'C'
    AND c.rut_id <> '#' AND c.dml_ind <> 'DELETE' AND c.customer_sub_type_key IN (
      '3042', '3043', '3044', '3048', '3053', '3054', '3055', '3059', '3060', '3081', '3084')
  LEFT JOIN src_assigned_product_parameter m ON m.assigned_product_key = a.assigned_product_key
    AND m.product_parameter_key IN ('26754', '27217', '27180', '27183', '27178')
  LEFT JOIN src_product p1 ON p1.product_key = a.product_key
  LEFT JOIN src_customer_sub_type t ON t.customer_sub_type_key = c.customer_sub_type_key
  LEFT JOIN src_assigned_billing_offer o ON o.subscriber_key = a.subscriber_key
    AND o.assigned_product_id = a.assigned_product_id AND o.parent_product_key = '2053'
    AND o.asgn_blng_ofr_state_key = '1331' AND o.asgn_blng_ofr_status_key IN ('1351', '1359')
    AND o.end_date > DATE '{AS_OF}'
  LEFT JOIN src_product p2 ON p2.product_key = o.product_key
  LEFT JOIN src_product_catalog g ON g.product_key = p2.product_key
  LEFT JOIN src_product_billing_parameters b ON b.product_key = o.product_key
    AND b.billing_offer_expiration_date IS NULL AND b.package_expiration_date IS NULL
    AND b.dml_ind <> 'DELETE' AND b.billing_attribute_name IN ('Rate', 'Discount value')
  WHERE a.product_key IN ('2053', '2448119') AND a.assigned_product_status_key IN ('1351', '1359')
    AND a.assigned_product_state_key = '1331' AND a.end_date > DATE '{AS_OF}'
    AND a.customer_key IS NOT NULL) v"""

ORACLES: dict[str, str] = {
    "billed_month": """
SELECT c_custkey, c_name, CAST(coalesce(arpu, 0) AS DOUBLE) AS arpu
FROM customer LEFT JOIN (
  SELECT user_id, sum(CAST(value AS DECIMAL(18,2))) AS arpu FROM events
  WHERE strftime(ts, '%Y%m') = '202401' AND event_type IN ('view', 'purchase', 'signup')
  GROUP BY user_id) ON user_id = c_custkey""",
    "eligible_accounts": """
SELECT DISTINCT c_nationkey, c_custkey FROM customer JOIN orders ON o_custkey = c_custkey
WHERE o_orderstatus NOT IN ('P') AND c_mktsegment = 'BUILDING' AND c_nationkey IS NOT NULL""",
    "business_customers": """
SELECT c_custkey, c_name, n_name, r_name,
       CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Hogar' ELSE c_mktsegment END AS segment
FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey
WHERE c_acctbal > 0 AND c_acctbal <= 9000 AND c_nationkey NOT IN (4, 5, 6)
  AND c_mktsegment IN ('HOUSEHOLD', 'FURNITURE', 'BUILDING') AND c_nationkey < 18""",
    "live_products": f"""
SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') AND o_orderstatus IN ('O', 'F')
  AND o_orderdate > {DAY}""",
    "param_filter": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS dml FROM lineitem
WHERE l_linenumber IN (1, 3, 5) AND l_returnflag <> 'R'""",
    "promo_lines": f"""
SELECT DISTINCT o_custkey, p_partkey AS product_key,
  p_name || ' 20%' AS product_desc, CAST(p_size AS VARCHAR) AS value,
  CAST(l_shipdate AS DATE) AS inicio,
  CASE WHEN p_type = 'PROMO' THEN CAST(CAST(l_shipdate AS DATE) + p_size * INTERVAL 1 MONTH AS DATE)
       ELSE CAST(l_shipdate AS DATE) + p_size END AS fin
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
WHERE l_linenumber IN (1, 2, 3) AND l_returnflag IN ('A', 'N') AND l_shipdate > {DAY}
  AND o_orderdate > {DAY} AND p_size > 20 AND p_type <> 'SMALL'""",
    "parc_base": """
SELECT o_custkey, o_orderkey, p_partkey, p_name,
       strftime(DATE '2018-01-01' + p_size, '%Y%m%d') AS created,
       strftime(o_orderdate, '%Y%m%d') AS original_activation_date
FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey
WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM') AND o_orderstatus IN ('O', 'F')
  AND l_returnflag = 'A' AND l_linestatus = 'O'""",
    "latest_offer": """
SELECT o_custkey, o_orderkey, day, o_orderpriority FROM (
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS pos
  FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderstatus IN ('O', 'F')
    AND o_orderdate > DATE '1996-01-01')
WHERE pos = 1""",
    "valid_at": f"""
SELECT * FROM (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 90 END AS end_date
  FROM orders)
WHERE start_date <= {DAY} AND coalesce(end_date, DATE '1998-12-31') > {DAY}""",
    "latest_partition": """
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS VARCHAR) AS year,
       CAST(month(o_orderdate) AS VARCHAR) AS month, CAST(day(o_orderdate) AS VARCHAR) AS day
FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""",
    "period_filter": """
SELECT o_orderkey, DATE '1998-02-01' AS first_day, DATE '1998-02-28' AS last_day
FROM orders WHERE strftime(o_orderdate, '%Y%m') = '199802'""",
    "charges_view": _VIEW.format(columns="*"),
    "base_rows": _VIEW.format(columns=(
        "DISTINCT rut_id, customer_legal_name, billing_cycle_key, subscriber_key, msisdn, "
        "customer_key, sub_type, cod_plan_amdocs, product_desc, start_date, "
        "original_activation_date, product_valid_from_date"
    )) + " WHERE NOT upper(product_desc) LIKE '%D%PARA%'",
    "null_rejecting_left": """
SELECT o_orderkey, o_custkey, l_linenumber, l_partkey, l_returnflag
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'""",
    "filtered_left": """
SELECT c_custkey, c_nationkey, o_orderkey, o_orderstatus, o_orderpriority,
       n_nationkey AS home_n_nationkey, n_name AS home_n_name
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'O'
  AND o_orderpriority = '1-URGENT'
LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "charge_pivot": """
SELECT l_orderkey,
  coalesce(max(l_extendedprice) FILTER (l_returnflag = 'N' AND l_linestatus = 'O'), 0) AS cf_datos,
  coalesce(max(l_extendedprice) FILTER (l_returnflag = 'A' AND l_linestatus = 'F'), 0) AS cf_voz,
  coalesce(max(l_extendedprice) FILTER (l_returnflag = 'R' AND l_linestatus = 'O'), 0) AS dsc_cf_datos,
  coalesce(max(l_extendedprice) FILTER (l_returnflag = 'R' AND l_linestatus = 'F'), 0) AS dsc_cf_voz
FROM lineitem GROUP BY l_orderkey""",
    "param_pairs": """
WITH amounts AS (SELECT o_custkey, o_orderkey, l_quantity AS amount
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber < 3 AND l_quantity > 25),
kinds AS (SELECT l_orderkey, l_returnflag AS kind FROM lineitem WHERE l_linenumber = 3),
ranked AS (
  SELECT amounts.o_custkey, amount, kind, row_number() OVER (
    PARTITION BY amounts.o_custkey ORDER BY amount DESC, kind DESC NULLS LAST) AS pos
  FROM amounts LEFT JOIN kinds ON l_orderkey = o_orderkey)
SELECT k.o_custkey, amount, kind
FROM (SELECT DISTINCT o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey) k
LEFT JOIN ranked ON ranked.o_custkey = k.o_custkey AND pos = 1""",
    "promo_slots": f"""
WITH n AS ({_numbered("l_partkey, l_quantity, CAST(l_shipdate AS DATE) AS ship")})
SELECT n1.l_orderkey, {", ".join(
    f"n{k}.l_partkey AS l_partkey_{k}, n{k}.l_quantity AS l_quantity_{k}, n{k}.ship AS ship_{k}"
    for k in range(1, 6))}
FROM (SELECT * FROM n WHERE slot = 1) n1 {" ".join(
    f"LEFT JOIN (SELECT * FROM n WHERE slot = {k}) n{k} ON n{k}.l_orderkey = n1.l_orderkey"
    for k in range(2, 6))}""",
    "promo_end": """
SELECT l_orderkey, l_linenumber, p_partkey, CAST(l_shipdate AS DATE) AS start,
  CASE WHEN p_type IN ('PROMO', 'LARGE')
         THEN CAST(CAST(l_shipdate AS DATE) + p_size * INTERVAL 1 MONTH AS DATE)
       WHEN p_type = 'SMALL' THEN CAST(l_shipdate AS DATE) + p_size END AS fin
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "net_service": """
WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS charge,
         l_quantity AS discount,
         CASE WHEN l_returnflag <> 'A' THEN CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) END AS amount,
         CASE WHEN l_linestatus = 'F' THEN 'Fixed' WHEN l_returnflag = 'N' THEN 'Percent' END AS kind
  FROM lineitem),
priced AS (
  SELECT *, CASE WHEN kind = 'Percent' AND amount IS NOT NULL
                   THEN (charge - discount) * (100 - CAST(amount AS DOUBLE)) / 100
                 ELSE charge - discount - coalesce(CAST(amount AS DOUBLE), 0) END AS net
  FROM lines)
SELECT *, CAST(trunc(net) AS BIGINT) AS net_int,
  charge + discount - coalesce(CAST(amount AS DOUBLE), 0) AS total,
  CASE WHEN amount IS NOT NULL THEN kind END AS shown_kind
FROM priced""",
    "stacked_total": f"""
WITH n AS (SELECT *, row_number() OVER (
             PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber, percent) AS slot
           FROM (SELECT l_orderkey, l_partkey, l_linenumber,
                        CAST(round(l_discount * 100) AS INTEGER) AS percent FROM lineitem)),
wide AS (SELECT o_orderkey AS l_orderkey, o_totalprice - 200000 AS base, {", ".join(
    f"n{k}.percent AS percent_{k}" for k in range(1, 6))}
  FROM orders {" ".join(
    f"LEFT JOIN n n{k} ON n{k}.l_orderkey = o_orderkey AND n{k}.slot = {k}" for k in range(1, 6))})
SELECT *, CAST(trunc(base * {" * ".join(
    f"((100 - coalesce(percent_{k}, 0)) / 100)" for k in range(1, 6))}) AS BIGINT) AS total
FROM wide""",
    "mix_label": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {label('has_param', 'in_cycle', 'has_promo')} AS label,
  {legacy_label('has_param', '(l_linenumber > 3)', 'in_cycle', 'has_promo')} AS legacy_label
FROM ({_FLAGS})""",
    "usable_flag": f"""
WITH f AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, in_cycle,
    {label('has_param', '(in_cycle AND l_linenumber = 1)', 'has_promo')} AS label,
    CASE WHEN l_linenumber = 7 THEN 0 WHEN l_linenumber < 7 THEN total END AS total,
    year(l_shipdate) + 20 AS created
  FROM ({_FLAGS}))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN label LIKE '%FIN%CICLO%' OR total < 0 OR (total > 30000 AND created >= 2020)
         OR (NOT in_cycle AND total = 0) THEN 'NO' ELSE 'SI' END AS usable,
  CASE WHEN label LIKE '%FIN%CICLO%' OR total < 0 OR (NOT in_cycle AND total = 0)
       THEN 'NO' ELSE 'SI' END AS usable_uncapped,
  CASE WHEN total < 0 THEN 0 ELSE total END AS arpu_t
FROM f""",
    "product_kind": """
WITH p AS (SELECT *, p_name || CASE p_size % 5 WHEN 0 THEN ' Gps' WHEN 1 THEN ' m2m'
             WHEN 2 THEN ' bam' WHEN 3 THEN ' wifi x Movil' ELSE '' END AS descr FROM part)
SELECT p_partkey, descr AS "desc",
  CASE WHEN p_type = 'LARGE' THEN p_brand WHEN p_size % 5 IN (0, 1) THEN 'M2M'
       WHEN p_size % 5 IN (2, 3) THEN 'BAM' ELSE 'VOZ' END AS kind,
  CASE WHEN p_size = 10 THEN descr ELSE p_name END AS plan,
  upper(p_name) LIKE '%L%G%' AS has_l_then_g
FROM p""",
    "text_clean": """
SELECT p_partkey, p_type || '|' || p_brand AS same, p_type || p_brand AS stripped,
  regexp_replace('*;RC;' || p_type || 'R' || p_partkey, '[*;RC]', '', 'g') AS code
FROM part""",
    "amount_parse": """
WITH o AS (SELECT o_orderkey, trim(CASE
    WHEN o_orderkey % 3 = 0 THEN split_part(o_orderpriority, '-', 1)
    WHEN o_orderkey % 3 = 1 THEN split_part(o_orderpriority, '-', 2)
    WHEN o_custkey % 40 = 2 THEN 'NaN' WHEN o_custkey % 40 = 3 THEN 'Infinity'
    WHEN o_custkey % 40 = 6 THEN '1d' WHEN o_custkey % 40 = 7 THEN '1e3'
    WHEN o_custkey % 40 = 10 THEN '-.5' WHEN o_custkey % 40 = 11 THEN '+7.'
    WHEN o_custkey % 4 = 0 THEN '0' WHEN o_custkey % 4 = 1 THEN '00'
    ELSE o_custkey || '.75' END) AS raw FROM orders),
n AS (SELECT *, CASE WHEN regexp_matches(raw, '^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+) *$')
                     THEN TRY_CAST(raw AS DOUBLE) END AS number FROM o)
SELECT o_orderkey, raw, CAST(trunc(number) AS BIGINT) AS amount,
  CASE WHEN raw <> '0' THEN CAST(trunc(number) AS BIGINT) END AS promo, number,
  CASE WHEN raw NOT IN ('0', '00') THEN raw END AS unblanked
FROM n""",
    "best_row": """
SELECT * EXCLUDE (pos) FROM (
  SELECT l_suppkey, l_quantity, l_linenumber, l_tax, l_returnflag, l_linestatus, discount,
         l_extendedprice, ship, l_orderkey, l_partkey, row_number() OVER (
           PARTITION BY l_suppkey
           ORDER BY l_quantity DESC NULLS LAST, discount DESC NULLS LAST, l_linenumber DESC,
             l_returnflag DESC, l_extendedprice DESC, l_orderkey DESC, l_tax DESC,
             l_linestatus DESC, ship DESC, l_partkey DESC) AS pos
  FROM (SELECT *, CASE WHEN l_tax > 0.02 THEN l_discount + 0.0 END AS discount,
               CAST(l_shipdate AS DATE) AS ship FROM lineitem))
WHERE pos = 1""",
    "ingest_list": """
SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS product_key, p_name AS product_desc
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size <> 7""",
    "stamps": """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS activated,
       '19980630 04:05:06' AS "FECHA_PROC", '199806' AS "PERIODO" FROM orders""",
    "plan_list_csv": """
SELECT CAST(p_partkey AS VARCHAR) AS product_key, p_name AS descripcion FROM part""",
    "snapshot_roundtrip": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
    "daily_snapshot": snapshot_oracles.daily_snapshot(),
    "monthly_close": snapshot_oracles.monthly_close(),
    "daily_snapshot_v2": snapshot_oracles.daily_snapshot_v2(),
    "daily_snapshot_list": snapshot_oracles.daily_snapshot(cycle="e.product_desc IS NOT NULL"),
    "daily_snapshot_v2_legacy": snapshot_oracles.daily_snapshot_v2(legacy=True),
    "dated_folders": """
SELECT o_custkey AS subscriber_key, o_orderstatus AS subscriber_status_id, chosen FROM (
  SELECT *, month(o_orderdate) AS m, CAST('latest' AS VARCHAR) AS chosen FROM orders
  UNION ALL SELECT *, month(o_orderdate), 'period' FROM orders)
WHERE m = CASE chosen WHEN 'latest' THEN 12 ELSE 2 END""",
}
