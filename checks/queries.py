"""The operators run over the driver's tables, one query per operator group.

The library functions take column names, so the code that serves the domain
tables serves these. Every query reads its whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import planledger
from checks.domain import (
    AS_OF, CLOSE_TS, PERIOD, RUN_TS, VIEW_TABLES, domain_tables, read,
)
from planledger.config import DAILY, DAILY_V2
from planledger.contracts import normalise_keys
from planledger.functions import calendar, labels, pricing, text
from planledger.operators import filters, joins, reduce
from planledger.plans import charges, ingest
from planledger.session import shared_folder
from planledger.sources import sinks, tables as sources

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

DAY = date(1998, 6, 30)
SEGMENTS = {"HOUSEHOLD": "Hogar", "FURNITURE": "Hogar", "MACHINERY": "Industria"}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _day(name: str) -> Column:
    return F.col(name).cast("date")


def _key(name: str) -> Column:
    return F.col(name).cast("string")


def _money(col: Column) -> Column:
    return F.sum(col.cast("decimal(18,2)")).cast("double")


@query
def billed_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    billed = reduce.billed_month(
        read(spark, sf_dir, "events").withColumn("amount", F.col("value").cast("decimal(18,2)")),
        "202401", segments=None, categories=None, codes=("view", "purchase", "signup"),
        key="user_id", billed="ts", amount="amount", code="event_type",
    )
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    totals = billed.withColumnRenamed("user_id", "c_custkey")
    return joins.attach_total(customers, totals, "c_custkey", "arpu", 0).withColumn(
        "arpu", F.col("arpu").cast("double")
    )


@query
def eligible_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").join(
        read(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey")
    )
    return filters.eligible_accounts(
        rows, ("P",), "BUILDING", status="o_orderstatus", kind="c_mktsegment",
        account="c_nationkey", subscriber="c_custkey",
    )


@query
def business_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read(spark, sf_dir, "customer").withColumns({
        "kind": F.when(F.col("c_acctbal") > 0, "C").otherwise("R"),
        "rut": F.when(F.col("c_acctbal") > 9000, "#").otherwise(F.col("c_name")),
        "dml": F.when(F.col("c_nationkey") == 4, "DELETE").when(
            F.col("c_nationkey") == 5, None).otherwise("UPDATE"),
        "phone": F.when(F.col("c_nationkey") == 6, F.col("c_name")).otherwise(_key("c_custkey")),
        "status": _key("c_nationkey"),
    })
    kept = filters.business_customers(
        cust, ("HOUSEHOLD", "FURNITURE", "BUILDING"), kind="kind", rut="rut", dml="dml",
        sub_type="c_mktsegment",
    )
    active = filters.eligible_subscribers(
        kept, tuple(str(n) for n in range(18)), ("HOUSEHOLD", "FURNITURE", "BUILDING"),
        numeric_phone=True, status="status", category="c_mktsegment", phone="phone",
    )
    segment = filters.sub_types(
        active.select("c_mktsegment").distinct().withColumn("segment", F.col("c_mktsegment")),
        keys=("HOUSEHOLD", "FURNITURE", "BUILDING"), relabel=SEGMENTS, key="c_mktsegment",
        desc="segment",
    )
    nation = read(spark, sf_dir, "nation").join(
        read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    joined = joins.enrich(joins.enrich(active, segment, "c_mktsegment", "inner"), nation, "c_nationkey")
    return joined.select("c_custkey", "c_name", "segment", "n_name", "r_name")


@query
def live_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filters.live_products(
        read(spark, sf_dir, "orders").withColumn("state", F.lit("1331")),
        ("1-URGENT", "2-HIGH", "5-LOW"), DAY, product="o_orderpriority", status="o_orderstatus",
        statuses=("O", "F"), state="state", customer="o_custkey", end="o_orderdate",
    )
    return rows.select("o_orderkey", "o_custkey", "o_orderpriority", _day("o_orderdate").alias("day"))


@query
def param_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filters.parameters(
        read(spark, sf_dir, "lineitem").withColumn(
            "dml", F.when(F.col("l_returnflag") == "R", "DELETE").otherwise(F.col("l_returnflag"))
        ), (1, 3, 5), drop_deleted=True, key="l_linenumber", dml="dml",
    )
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "dml")


@query
def promo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    offers = filters.live_offers(
        read(spark, sf_dir, "lineitem").withColumn("state", F.lit("1331")), (1, 2, 3), DAY,
        parent="l_linenumber", status="l_returnflag", statuses=("A", "N"), state="state",
        end="l_shipdate",
    ).select("l_orderkey", F.col("l_partkey").alias("product_key"), _day("l_shipdate").alias("start"))
    part = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_key"),
        F.concat("p_name", F.when(F.col("p_size") < 10, " 10% SMS")
                 .when(F.col("p_size") > 20, " 20%").otherwise("")).alias("product_desc"),
        F.when(F.col("p_type") == "SMALL", "Percent").otherwise(_key("p_size")).alias("value"),
        F.when(F.col("p_type") == "PROMO", "M").otherwise("D").alias("interval"),
        F.col("p_size").alias("duration"),
    )
    values = filters.promo_values(part.drop("value"), part, value="value")
    products = filters.valid_at(
        read(spark, sf_dir, "orders"), None, "o_orderdate", DAY
    ).select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = joins.split_join(
        joins.enrich(offers, products, "l_orderkey", "inner"), values, "product_key", "inner"
    )
    return filters.promo_dates(
        lines, start="start", interval="interval", duration="duration"
    ).select("o_custkey", "product_key", "product_desc", "value", "inicio", "fin").distinct()


@query
def parc_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").join(
        read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).withColumns({
        "segment": F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")),
        "valid": F.when(F.col("l_returnflag") == "A", 1).otherwise(0),
    })
    base = filters.parc_base(
        lines, ("1-URGENT", "3-MEDIUM"), ("O", "F"), "O", segment="segment",
        category="o_orderstatus", valid="valid", source="l_linestatus", activated="o_orderdate",
    ).withColumnsRenamed({"l_partkey": "p_partkey"})
    dated = filters.plan_dates(
        read(spark, sf_dir, "part").withColumn(
            "created", F.date_add(F.lit(date(2018, 1, 1)), F.col("p_size"))
        ), key="p_partkey", created="created", fmt="yyyyMMdd",
    )
    named = filters.products(read(spark, sf_dir, "part"), ("p_partkey", "p_name"))
    return joins.enrich(joins.enrich(base, dated, "p_partkey"), named, "p_partkey").select(
        "o_custkey", "o_orderkey", "p_partkey", "p_name", "created", "original_activation_date"
    )


@query
def latest_offer(spark: SparkSession, sf_dir: str) -> DataFrame:
    offers = filters.live_offers(
        read(spark, sf_dir, "orders").withColumn("state", F.lit("1331")),
        ("1-URGENT", "2-HIGH", "3-MEDIUM"), date(1996, 1, 1), parent="o_orderpriority",
        status="o_orderstatus", statuses=("O", "F"), state="state", end="o_orderdate",
    ).select("o_custkey", "o_orderkey", _day("o_orderdate").alias("day"), "o_orderpriority")
    return reduce.latest_per(offers, "o_custkey", "day", ["o_orderkey"])


@query
def valid_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey", _day("o_orderdate").alias("start_date"),
        F.when(F.col("o_orderstatus") != "P", F.date_add(_day("o_orderdate"), 90)).alias("end_date"),
    )
    return filters.valid_at(rows, "start_date", "end_date", DAY, open_end=date(1998, 12, 31))


@query
def latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy").alias("year"),
        F.month("o_orderdate").cast("string").alias("month"),
        F.dayofmonth("o_orderdate").cast("string").alias("day"),
    )
    return sources.latest_partition(rows)


@query
def period_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"), F.lit(1).alias("day"),
    )
    first, last = calendar.period_bounds("199802")
    return sources.period_partition(rows, "199802").filter(
        calendar.in_period(F.col("o_orderdate"), "199802")
    ).select("o_orderkey", F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))


@query
def charges_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charges.charges_view(domain_tables(spark, sf_dir, *VIEW_TABLES), AS_OF)


@query
def base_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = charges.base_view(domain_tables(spark, sf_dir, *VIEW_TABLES), AS_OF)
    return filters.base_rows(view, hidden=("D", "PARA"))


@query
def null_rejecting_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_returnflag"
    )
    return joins.inner_filtered(orders, lines, "o_orderkey", F.col("l_returnflag") != "R")


@query
def filtered_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus", "o_orderpriority"
    )
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    kept = joins.left_filtered(
        customers, orders, "c_custkey",
        (F.col("o_orderstatus") == "O") & F.col("o_orderpriority").isin("1-URGENT"),
    )
    return joins.role_join(kept, nations, "c_nationkey", "n_nationkey", "home_")


@query
def charge_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return reduce.spread_by_kind(lines, "l_orderkey", {
        "cf_datos": (flag == "N") & (status == "O"),
        "cf_voz": (flag == "A") & (status == "F"),
        "dsc_cf_datos": (flag == "R") & (status == "O"),
        "dsc_cf_voz": (flag == "R") & (status == "F"),
    }, F.col("l_extendedprice"), fill=0.0)


@query
def param_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").join(
        read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        "o_custkey", "o_orderkey",
        F.when((F.col("l_linenumber") < 3) & (F.col("l_quantity") > 25), F.col("l_quantity"))
        .alias("amount"),
        F.when(F.col("l_linenumber") == 3, F.col("l_returnflag")).alias("kind"),
    )
    return reduce.best_pair(lines, "o_custkey", "o_orderkey", "amount", "kind")


@query
def promo_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity",
        _day("l_shipdate").alias("ship"),
    )
    numbered = reduce.number_slots(lines, "l_orderkey", ["l_partkey", "l_linenumber"])
    return reduce.spread_by_slot(numbered, "l_orderkey", "slot", ["l_partkey", "l_quantity", "ship"])


@query
def promo_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"),
        _day("l_shipdate").alias("start"),
    )
    part = read(spark, sf_dir, "part").select(
        "p_partkey", "p_size",
        F.when(F.col("p_type").isin("PROMO", "LARGE"), "M").when(F.col("p_type") == "SMALL", "D")
        .otherwise("X").alias("interval"),
    )
    return joins.split_join(lines, part, "p_partkey").select(
        "l_orderkey", "l_linenumber", "p_partkey", "start",
        calendar.promo_end(F.col("start"), F.col("interval"), F.col("p_size")).alias("fin"),
    )


@query
def net_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_extendedprice").alias("charge"), F.col("l_quantity").alias("discount"),
        F.when(F.col("l_returnflag") != "A", F.floor("l_quantity").cast("string")).alias("amount"),
        F.when(F.col("l_linestatus") == "F", "Fixed").when(F.col("l_returnflag") == "N", "Percent")
        .alias("kind"),
    )
    col = F.col
    return lines.withColumns({
        "net": pricing.net_service(col("charge"), col("discount"), col("amount"), col("kind")),
        "net_int": pricing.net_service(
            col("charge"), col("discount"), col("amount"), col("kind"), truncate=True
        ),
        "total": pricing.total_fixed(
            col("charge"), col("discount"), col("amount").try_cast("double"), F.lit(None), True
        ),
        "shown_kind": pricing.visible_type(col("amount"), col("kind")),
    })


@query
def stacked_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = reduce.spread_by_slot(
        reduce.number_slots(
            read(spark, sf_dir, "lineitem").select(
                "l_orderkey", "l_partkey", "l_linenumber",
                F.round(F.col("l_discount") * 100).cast("int").alias("percent"),
            ), "l_orderkey", ["l_partkey", "l_linenumber"],
        ), "l_orderkey", "slot", ["percent"],
    )
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), (F.col("o_totalprice") - 200000).alias("base")
    )
    return joins.enrich(orders, slots, "l_orderkey").withColumn(
        "total",
        pricing.stacked_total(F.col("base"), [F.col(f"percent_{k}") for k in range(1, 6)]),
    )


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    cycle = read(spark, sf_dir, "part").filter(F.col("p_type") == "PROMO").select("p_partkey")
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        (F.col("l_returnflag") == "R").alias("has_param"),
        (F.col("l_linestatus") == "O").alias("has_promo"),
        (F.col("l_extendedprice") - 2000).cast("int").alias("total"),
    )
    return joins.in_list(lines, cycle, "l_partkey", "in_cycle", list_key="p_partkey")


@query
def mix_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    col = F.col
    return _flags(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        labels.mix_label(col("has_param"), col("in_cycle"), col("has_promo")).alias("label"),
        labels.mix_label_v2_legacy(
            col("has_param"), col("l_linenumber") > 3, col("in_cycle"), col("has_promo")
        ).alias("legacy_label"),
    )


@query
def usable_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    col = F.col
    label = labels.mix_label(
        col("has_param"), col("in_cycle") & (col("l_linenumber") == 1), col("has_promo")
    )
    total = F.when(col("l_linenumber") == 7, 0).when(col("l_linenumber") < 7, col("total"))
    created = F.add_months(_day("l_shipdate"), 240)
    return _flags(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        labels.usable_flag(label, total, created, col("in_cycle")).alias("usable"),
        labels.usable_flag(label, total, created, col("in_cycle"), cap_rule=False).alias("usable_uncapped"),
        pricing.floored(total).alias("arpu_t"),
    )


@query
def product_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").withColumn("desc", F.concat(
        "p_name", F.when(F.col("p_size") % 5 == 0, " Gps").when(F.col("p_size") % 5 == 1, " m2m")
        .when(F.col("p_size") % 5 == 2, " bam").when(F.col("p_size") % 5 == 3, " wifi x Movil")
        .otherwise(""),
    ))
    return part.select(
        "p_partkey", "desc",
        labels.product_kind(F.when(F.col("p_type") == "LARGE", F.col("p_brand")), F.col("desc"))
        .alias("kind"),
        labels.plan_desc(_key("p_size"), F.col("desc"), F.col("p_name"), "10").alias("plan"),
        text.contains_in_order(F.col("p_name"), "l", "g").alias("has_l_then_g"),
    )


@query
def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    piped = F.concat_ws("|", "p_type", "p_brand")
    return read(spark, sf_dir, "part").select(
        "p_partkey", text.clean_name(piped).alias("same"),
        text.clean_name(piped, strip_pipes=True).alias("stripped"),
        text.clean_offer_code(F.concat(F.lit("*;RC;"), "p_type", F.lit("R"), _key("p_partkey")))
        .alias("code"),
    )


@query
def amount_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").withColumn("raw", F.concat(
        F.lit(" "), F.when(F.col("o_orderkey") % 3 == 0, F.split("o_orderpriority", "-")[0])
        .when(F.col("o_orderkey") % 3 == 1, F.split("o_orderpriority", "-")[1])
        .when(F.col("o_custkey") % 40 == 2, "NaN").when(F.col("o_custkey") % 40 == 3, "Infinity")
        .when(F.col("o_custkey") % 40 == 6, "1d").when(F.col("o_custkey") % 40 == 7, "1e3")
        .when(F.col("o_custkey") % 40 == 10, "-.5").when(F.col("o_custkey") % 40 == 11, "+7.")
        .when(F.col("o_custkey") % 4 == 0, "0").when(F.col("o_custkey") % 4 == 1, "00")
        .otherwise(F.concat(_key("o_custkey"), F.lit(".75"))), F.lit(" "),
    ))
    raw = F.col("raw")
    return normalise_keys(orders, ["raw"]).select(
        "o_orderkey", "raw", text.parse_amount(raw).alias("amount"),
        text.parse_amount(raw, zero_as_null=True).alias("promo"),
        text.parse_number(raw).alias("number"), text.blank_zeros(raw).alias("unblanked"),
    )


@query
def best_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_linenumber", "l_tax", "l_returnflag", "l_linestatus",
        F.when(F.col("l_tax") > 0.02, F.col("l_discount") + 0.0).alias("discount"),
        "l_extendedprice", _day("l_shipdate").alias("ship"), "l_orderkey", "l_partkey",
    )
    return reduce.best_row(
        lines, "l_suppkey", ["l_quantity", "discount", "l_linenumber", "l_returnflag"],
        ["l_extendedprice", "l_orderkey"],
    )


@query
def ingest_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    offers = read(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("*;RC"), _key("l_partkey"), F.lit(";*")).alias("applied_to_ind")
    )
    product = read(spark, sf_dir, "part").select(
        _key("p_partkey").alias("product_key"),
        F.when(F.col("p_size") != 7, F.col("p_name")).alias("product_desc"),
    )
    return ingest.ingest_cycle_discounts(offers, product)


@query
def stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("activated")
    )
    return calendar.stamps(rows, DAY, datetime(1998, 6, 30, 4, 5, 6))


def _run_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query
def plan_list_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _run_folder(spark, "plan-list")
    read(spark, sf_dir, "part").select(
        _key("p_partkey").alias("code"), F.col("p_name").alias("text")
    ).write.option("header", True).csv(folder)
    return sources.read_plan_list(spark, folder)


@query
def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    orc, parquet = _run_folder(spark, "snapshot"), _run_folder(spark, "extract")
    table = "planledger_" + uuid.uuid4().hex
    sinks.write_snapshot(rows, orc, table)
    sinks.write_snapshot(spark.table(table), parquet, fmt="parquet")
    spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(parquet)


def _double(df: DataFrame) -> DataFrame:
    names = ("ARPU", "CF_DATOS", "CF_VOZ", "DSC_CF_DATOS", "DSC_CF_VOZ", "TOTAL_CF", "ARPU_DATOS",
             "ARPU_VOZ")
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def _report_tables(spark: SparkSession, sf_dir: str, job: str) -> dict[str, DataFrame]:
    """The tables of a report, its lists reduced as a run from the command line does."""
    return planledger.reduced_lists(domain_tables(spark, sf_dir, *sources.JOB_TABLES[job]), job)


@query
def daily_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _report_tables(spark, sf_dir, "daily")
    return _double(planledger.daily_snapshot(tables, AS_OF, RUN_TS))


@query
def monthly_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _report_tables(spark, sf_dir, "monthly")
    return _double(planledger.monthly_close(tables, PERIOD, CLOSE_TS))


@query
def daily_snapshot_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _report_tables(spark, sf_dir, "daily-v2")
    return _double(planledger.daily_snapshot_v2(tables, AS_OF))


@query
def daily_snapshot_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _report_tables(spark, sf_dir, "daily")
    cfg = replace(DAILY, cycle_source="list", strip_pipes=True)
    report = _double(planledger.daily_snapshot(tables, AS_OF, RUN_TS, cfg))
    # The SQL keeps the pipes, which only the names have.
    return report.withColumn("RAZON_SOCIAL", F.regexp_replace("RAZON_SOCIAL", "  SA$", " | SA"))


@query
def daily_snapshot_v2_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _report_tables(spark, sf_dir, "daily-v2")
    cfg = replace(DAILY_V2, v2_label_bug=True, v2_kind_from_cycle_list=True)
    return _double(planledger.daily_snapshot_v2(tables, AS_OF, cfg))


@query
def dated_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reader that the jobs use, over a folder per month: the latest, and one by its period."""
    root = _run_folder(spark, "dated")
    lines = read(spark, sf_dir, "orders").select(
        _key("o_custkey").alias("subscriber_key"), F.lit(None).cast("string").alias("financial_account_key"),
        F.col("o_orderstatus").alias("subscriber_status_id"), F.lit("C").alias("customer_type_ind"),
        F.lit("x").alias("product"), F.lit(2024).alias("year"), F.month("o_orderdate").alias("month"), F.lit(1).alias("day"),
    )
    lines.write.partitionBy("year", "month", "day").parquet(f"{root}/parc_kfactor")
    latest = sources.read_dated(spark, root, "parc_kfactor").withColumn("chosen", F.lit("latest"))
    february = sources.read_dated(spark, root, "parc_kfactor", "202402").withColumn("chosen", F.lit("period"))
    return latest.union(february).select(F.col("subscriber_key").cast("long").alias("subscriber_key"), "subscriber_status_id", "chosen")
