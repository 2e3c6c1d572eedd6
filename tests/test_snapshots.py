"""The three reports on a hand-worked fixture, and their general properties."""

from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import planledger as P
from conftest import SF, physical_plan, values
from checks.domain import CLOSE_TS, PERIOD, RUN_TS, domain_tables
from checks.domain import AS_OF as DRIVER_DAY
from fixture_domain import AS_OF, product, offer, frame, tables
from planledger.__main__ import lasting_catalog, parse_args, run, session_settings
from planledger.contracts import TABLES, normalise
from planledger.operators.filters import base_rows, live_products
from planledger.plans.charges import SUBSCRIBER, base_view, charges_view
from planledger.plans.snapshots import REPORT_COLUMNS
from planledger.sources.tables import JOB_TABLES, read_table

RUN = datetime(2024, 1, 15, 6, 0, 0)
CLOSE = datetime(2024, 2, 3, 6, 0, 0)


@pytest.fixture(scope="module")
def domain(spark):
    made = {name: normalise(df, name) for name, df in tables(spark).items()}
    for df in made.values():
        df.cache()
    return made


def by_subscriber(df):
    assert tuple(df.columns) == REPORT_COLUMNS
    rows = {row["SUBSCRIBER_KEY"]: row.asDict() for row in df.collect()}
    assert len(rows) == df.count()
    return rows


def columns(rows, *names):
    return {key: tuple(row[name] for name in names) for key, row in rows.items()}


def test_daily(spark, domain):
    rows = by_subscriber(P.daily_snapshot(domain, AS_OF, RUN))
    base = "MULTIPRODUCTO"
    assert columns(rows, "CODIGO_PLAN", "TOTAL_CF", "ARPU_DATOS", "ARPU_VOZ", "ARPU_T", "TIPO_DSC",
                   "MARCA_USABLE") == {
        "1": ("P1", 27000, 18000, 9000, 27000, base, "SI"),
        "2": ("P1", 27000, 16200, 8500, 24700, base + "+PARAMETRIZABLE", "SI"),
        "3": ("P1", 27000, 18000, 9000, 19440, base + "+FIN DE CICLO+PUNTUAL", "NO"),
        "4": ("P2", 40000, 40000, 0, 40000, base, "NO"),
        "5": ("P3", 40000, 40000, 0, 40000, base, "SI"),
        "6": ("P4", 0, 0, 0, 0, base, "NO"),
        "7": ("P5", 0, 0, 0, 0, base, "SI"),
        "8": ("P2", 40000, 40000, 0, 40000, base, "NO"),
        "11": ("P4", 0, -100, 0, 0, base + "+PARAMETRIZABLE", "NO"),
        "12": ("P1", 27000, 18000, 9000, 27000 * 0.9 * 0.9 * 0.8 * 0.8 * 0.7 // 1,
               base + "+FIN DE CICLO+PUNTUAL", "NO"),
    }
    one = rows["1"]
    assert (one["RUT"], one["RAZON_SOCIAL"], one["CICLO"], one["MSISDN"], one["CUSTOMER_KEY"]) == (
        "r1", "E|1", "5", "5691", "c1")
    assert (one["FINANCIAL_ACCOUNT_KEY"], one["ARPU"], one["SEGMENTO"]) == ("F2", Decimal(1500), "Mediana")
    assert (one["FECHA_ACTIVACION"], one["FECHA_PROC"], one["PERIODO"]) == (
        "20190506", "20240115 06:00:00", "202401")
    assert (one["PLAN"], one["TIPO_PRODUCTO"], rows["4"]["TIPO_PRODUCTO"]) == (
        "Plan Movil BAM", "VOZ+", "BAM")
    assert columns(rows, "DSC_ADICIONAL_DATOS", "TIPO_DSC_ADI_DATOS", "DSC_ADICIONAL_VOZ",
                   "TIPO_DSC_ADI_VOZ")["2"] == ("10", "Percent", "500", "Fixed")
    assert columns(rows, "DSC_ADICIONAL_DATOS", "DSC_ADICIONAL_VOZ", "TIPO_DSC_ADI_VOZ")["11"] == (
        "100", None, None)
    assert [rows["12"][f"DSC_PUNTUAL_{k}"] for k in range(1, 6)] == [10, 10, 20, 20, 30]
    assert rows["3"]["DSC_FECHA_INICIO_1"] == date(2023, 1, 31)
    assert rows["3"]["DSC_FECHA_FIN_1"] == date(2023, 2, 28)
    assert [rows["3"][f"TIPO_DSC_PUNTUAL_{k}"] for k in (1, 2, 3)] == ["Percent", "Percent", None]


def test_daily_with_the_cycle_list(spark, domain):
    rows = by_subscriber(P.daily_snapshot(domain, AS_OF, RUN, replace(P.DAILY, cycle_source="list")))
    assert rows["3"]["TIPO_DSC"] == "MULTIPRODUCTO+PUNTUAL"
    assert rows["5"]["TIPO_DSC"] == "MULTIPRODUCTO+FIN DE CICLO"
    assert (rows["3"]["MARCA_USABLE"], rows["5"]["MARCA_USABLE"]) == ("SI", "NO")


def test_daily_repeated_products_take_slots(spark, domain):
    """The same assigned product twice doubles its promo lines daily, not monthly."""
    twice = dict(domain)
    extra = normalise(frame(spark, "assigned_product", [product("C3", "3", "k3b", "2713")]),
                      "assigned_product")
    twice["assigned_product"] = domain["assigned_product"].union(extra)
    daily = by_subscriber(P.daily_snapshot(twice, AS_OF, RUN))["3"]
    assert [daily[f"DSC_PUNTUAL_{k}"] for k in range(1, 6)] == [10, 10, 20, 20, None]
    monthly = by_subscriber(P.monthly_close(twice, "202401", CLOSE))["3"]
    assert [monthly[f"DSC_PUNTUAL_{k}"] for k in range(1, 4)] == [10, 20, None]


def test_own_plan_product_shows_its_own_text(spark, domain):
    """Offers of the plan product itself keep their text where the held one is hidden."""
    changed = dict(domain)
    extra = normalise(frame(spark, "assigned_billing_offer", [
        offer("B2", "2", "2053", "2053"), offer("B2", "2", "P2", "2053"),
    ]), "assigned_billing_offer")
    changed["assigned_billing_offer"] = domain["assigned_billing_offer"].filter(
        (F.col("subscriber_key") != "2") | (F.col("parent_product_key") != "2053")).union(extra)
    changed["assigned_product"] = domain["assigned_product"].filter("assigned_product_id <> 'A2'")
    row = by_subscriber(P.daily_snapshot(changed, AS_OF, RUN))["2"]
    assert (row["CODIGO_PLAN"], row["PLAN"]) == ("2053", "Plan Movil BAM")


def test_monthly(spark, domain):
    rows = by_subscriber(P.monthly_close(domain, "202401", CLOSE))
    assert set(rows) == {"1", "2", "3", "4", "5", "6", "7", "8", "11", "12"}
    base = "MULTIPRODUCTO"
    # Charges with a package expiry still count here, so P1 costs 88888.
    assert columns(rows, "CODIGO_PLAN", "CF_DATOS", "TOTAL_CF", "ARPU_T", "TIPO_DSC", "MARCA_USABLE") == {
        "1": ("P1", 88888, 95888, 95888, base, "SI"),
        "2": ("P1", 88888, 95888, 78199 + 8500, base + "+PARAMETRIZABLE", "SI"),
        "3": ("P1", 88888, 95888, 69039, base + "+PUNTUAL", "SI"),
        "4": ("P2", 40000, 40000, 40000, base, "SI"),
        "5": ("P3", 40000, 40000, 40000, base + "+FIN DE CICLO", "NO"),
        "6": ("P4", 0, 0, 0, base, "NO"),
        "7": ("P5", 0, 0, 0, base, "SI"),
        "8": ("P2", 88888, 95888, 95888, base, "SI"),
        "11": ("P4", 0, 0, 0, base + "+PARAMETRIZABLE", "NO"),
        "12": ("P1", 88888, 95888, 95888 * 0.9 * 0.9 * 0.8 * 0.8 * 0.7 // 1, base + "+PUNTUAL", "SI"),
    }
    one = rows["1"]
    assert (one["ARPU"], one["PERIODO"], one["FECHA_PROC"]) == (1500, "202401", "20240203 06:00:00")
    assert (one["FECHA_ACTIVACION"], one["SEGMENTO"], one["PLAN"]) == (
        "20180304", " Mediana Empresa", "Plan de parque")


def test_closing_the_current_month_drops_open_offers(spark, domain):
    rows = by_subscriber(P.monthly_close(domain, "202401", datetime(2024, 1, 31, 23, 0, 0)))
    assert {row["TOTAL_CF"] for row in rows.values()} == {0}


def test_daily_v2(spark, domain):
    rows = by_subscriber(P.daily_snapshot_v2(domain, AS_OF))
    base = "MULTIPRODUCTO"
    assert columns(rows, "CODIGO_PLAN", "TOTAL_CF", "ARPU_T", "TIPO_DSC", "MARCA_USABLE") == {
        "1": ("P1", 27000, 27000, base, "SI"),
        "2": ("P1", 27000, 24700, base + "+PARAMETRIZABLE", "SI"),
        "3": ("P1", 27000, 19440, base + "+PUNTUAL", "SI"),
        "4": ("P2", 40000, 40000, base, "SI"),
        "5": ("P3", 40000, 40000, base + "+FIN DE CICLO", "NO"),
        "6": ("P4", 0, 0, base, "NO"),
        "7": ("P5", 0, 0, base, "SI"),
        "8": ("P1", 27000, 27000, base, "SI"),
        "11": ("P4", 0, 0, base + "+PARAMETRIZABLE", "NO"),
        "12": ("P1", 27000, 27000 * 0.6 * 0.7 * 0.8 * 0.8 * 0.9 // 1, base + "+PUNTUAL", "SI"),
    }
    one = rows["1"]
    assert (one["ARPU"], one["FECHA_PROC"], one["SEGMENTO"]) == (1500, AS_OF, "Mediana Empresa")
    assert (one["TIPO_PRODUCTO"], one["FINANCIAL_ACCOUNT_KEY"]) == ("KF", "F9")
    assert (rows["4"]["TIPO_PRODUCTO"], rows["4"]["ARPU"]) == ("M2M", None)
    # By provision date the last offer comes first; the sixth has no slot.
    assert [rows["12"][f"DSC_PUNTUAL_{k}"] for k in range(1, 6)] == [40, 30, 20, 20, 10]
    legacy = replace(P.DAILY_V2, v2_label_bug=True, v2_kind_from_cycle_list=True)
    assert by_subscriber(P.daily_snapshot_v2(domain, AS_OF, legacy))["4"]["TIPO_PRODUCTO"] == "VOZ"


def test_v2_without_a_plan(spark, domain):
    bare = dict(domain)
    bare["assigned_billing_offer"] = domain["assigned_billing_offer"].filter(F.lit(False))
    rows = by_subscriber(P.daily_snapshot_v2(bare, AS_OF))
    assert columns(rows, "CODIGO_PLAN", "TOTAL_CF", "ARPU_T", "MARCA_USABLE")["1"] == (
        None, None, None, "SI")
    daily = by_subscriber(P.daily_snapshot(bare, AS_OF, RUN))
    assert columns(daily, "CODIGO_PLAN", "PLAN", "TOTAL_CF", "ARPU_T")["1"] == (
        None, "Plan Movil BAM", 0, 0)


def test_names_may_lose_their_pipes(spark, domain):
    rows = by_subscriber(P.daily_snapshot_v2(domain, AS_OF, replace(P.DAILY_V2, strip_pipes=True)))
    assert rows["1"]["RAZON_SOCIAL"] == "E1"


def test_charges_view_has_17_columns_and_multiplies(spark, domain):
    view = charges_view(domain, AS_OF)
    assert len(view.columns) == 17
    assert view.filter("subscriber_key = '1'").count() == 4
    # Four parameters of the hidden product, no plan of its own; one plan with four charges.
    assert view.filter("subscriber_key = '2'").count() == 4 + 4


REPORTS = {
    "daily": (P.daily_snapshot, (DRIVER_DAY, RUN_TS), P.DAILY),
    "monthly": (P.monthly_close, (PERIOD, CLOSE_TS), P.MONTHLY),
    "daily-v2": (P.daily_snapshot_v2, (DRIVER_DAY,), P.DAILY_V2),
}


@pytest.fixture(scope="module")
def driver_domain(spark):
    return {name: df.cache() for name, df in domain_tables(spark, SF).items()}


@pytest.mark.parametrize("job", REPORTS)
def test_report_properties(spark, driver_domain, conf, job):
    """One row per subscriber; same rows whatever the input order, partitioning or join strategy."""
    report, args, cfg = REPORTS[job]
    df = report(driver_domain, *args)
    rows = values(df, "SUBSCRIBER_KEY")
    assert len({row.SUBSCRIBER_KEY for row in df.collect()}) == len(rows) > 20
    bad = df.filter(
        "ARPU_T < 0 OR NOT TIPO_DSC LIKE 'MULTIPRODUCTO%' OR MARCA_USABLE NOT IN ('SI', 'NO')"
    )
    assert bad.count() == 0
    if job != "daily-v2":
        assert df.filter("TOTAL_CF <> CF_DATOS + CF_VOZ - DSC_CF_DATOS - DSC_CF_VOZ").count() == 0
    mixed = {
        name: table.orderBy(F.xxhash64(*table.columns)).repartition(7)
        for name, table in driver_domain.items()
    }
    assert values(report(mixed, *args), "SUBSCRIBER_KEY") == rows
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    assert values(report(driver_domain, *args), "SUBSCRIBER_KEY") == rows


@pytest.mark.parametrize("job", REPORTS)
def test_building_a_report_runs_no_job(spark, driver_domain, job):
    report, args, _ = REPORTS[job]
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{job}", "building")
    report(driver_domain, *args)
    started = sc.statusTracker().getJobIdsForGroup(f"build-{job}")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert list(started) == []


def without(domain, *keys):
    return domain | {"product": domain["product"].filter(~F.col("product_key").isin(*keys))}


def test_daily_offer_without_product_row(spark, domain):
    """The creation date belongs to the product row, and so does the plan product's own text."""
    rows = by_subscriber(P.daily_snapshot(without(domain, "P2"), AS_OF, RUN))
    for key in ("4", "8"):
        assert (rows[key]["CODIGO_PLAN"], rows[key]["MARCA_USABLE"], rows[key]["ARPU_T"]) == ("P2", "SI", 40000)
    assert values(charges_view(without(domain, "P2"), AS_OF).filter("cod_plan_amdocs = 'P2'").select(
        "product_valid_from_date").distinct()) == [(None,)]
    offers = [offer("B2", "2", "2053", "2053")]
    renamed = domain["product"].withColumn("product_desc", F.when(
        F.col("product_key") == "2448119", "Texto llano").otherwise(F.col("product_desc")))
    changed = domain | {
        "product": renamed.filter("product_key <> '2053'"),
        "assigned_billing_offer": normalise(frame(spark, "assigned_billing_offer", offers), "assigned_billing_offer"),
    }
    assert by_subscriber(P.daily_snapshot(changed, AS_OF, RUN))["2"]["PLAN"] == "Texto llano"


def test_amounts_beyond_int(spark, domain):
    """Neither billed sums nor amounts in texts are cut at the int range."""
    bill = domain["billing_detail"].limit(1).withColumns({
        "subscriber_key": F.lit("4"), "charge_amount": F.lit(Decimal("3000000000.00")),
        "bill_date": F.lit(date(2024, 1, 2)), "close_date": F.lit(date(2024, 1, 2)),
    })
    charges = domain["product_billing_parameters"].withColumn(
        "billing_attribute_default_val",
        F.when((F.col("product_key") == "P2") & (F.col("item_name") == "Cargo Fijo Datos"), "3000000000")
        .otherwise(F.col("billing_attribute_default_val")))
    large = domain | {
        "billing_detail": domain["billing_detail"].union(bill.select(domain["billing_detail"].columns)),
        "product_billing_parameters": charges,
    }
    for job, args in (("daily", (AS_OF, RUN)), ("monthly", ("202401", CLOSE)), ("daily-v2", (AS_OF,))):
        row = by_subscriber(REPORTS[job][0](large, *args))["4"]
        assert (int(row["ARPU"]), int(row["CF_DATOS"]), int(row["TOTAL_CF"]), int(row["ARPU_T"])) == (3 * 10**9,) * 4, job


def test_base_rows_do_not_multiply(spark, domain):
    """300 equal products meet 300 equal offers on one key as one row each."""
    many = domain | {
        "assigned_product": domain["assigned_product"].crossJoin(spark.range(300)).drop("id"),
        "assigned_billing_offer": domain["assigned_billing_offer"].crossJoin(spark.range(300)).drop("id"),
    }
    assert base_view(many, AS_OF).count() == base_view(domain, AS_OF).count() < 50
    assert values(base_rows(base_view(many, AS_OF))) == values(base_rows(charges_view(domain, AS_OF)))


@pytest.mark.parametrize("job", REPORTS)
def test_report_plans(spark, domain, conf, job):
    """No cartesian product, no Python, and a bounded number of shuffles with all joins shuffled."""
    conf(autoBroadcastJoinThreshold="-1")
    report, args, _ = REPORTS[job]
    plan = physical_plan(report(domain, *args))
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan
    limit = {"daily": 26, "monthly": 17, "daily-v2": 21}[job]
    assert plan.count("Exchange hashpartitioning") <= limit


#: Columns of the fixture whose keys and codes are all numbers.
NUMERIC = {
    "assigned_product": ("product_key", SUBSCRIBER, "assigned_product_status_key", "assigned_product_state_key"),
    "assigned_billing_offer": (SUBSCRIBER, "parent_product_key", "asgn_blng_ofr_state_key", "asgn_blng_ofr_status_key"),
    "assigned_product_parameter": ("product_parameter_key",),
    "subscribers": (SUBSCRIBER, "subscriber_status_key", "calculated_payment_category_ke"),
    "customer": ("customer_sub_type_key", "billing_cycle_key"), "customer_sub_type": ("customer_sub_type_key",),
    "billing_detail": (SUBSCRIBER,), "parc_kfactor": (SUBSCRIBER,), "parc_sist": ("subcriptor",),
    "parc_coliving": (SUBSCRIBER, "billing_cycle_key"),
}


@pytest.mark.parametrize("kind", ["int", "decimal(38,0)", "decimal(38,10)", "double"])
def test_keys_and_codes_of_any_number_type_give_the_same_reports(spark, domain, tmp_path, kind):
    typed = dict(domain)
    for name, columns in NUMERIC.items():
        rows = domain[name].withColumns({c: F.col(c).cast(kind) for c in columns})
        rows.write.parquet(f"{tmp_path}/{name}")
        typed[name] = read_table(spark, str(tmp_path), name)
        assert all(dict(typed[name].dtypes)[c] == (kind if TABLES[name][c] == "code" else "string") for c in columns)
    jobs = [("daily", (AS_OF, RUN)), ("monthly", ("202401", CLOSE)), ("daily-v2", (AS_OF,))]
    for job, args in jobs if kind == "decimal(38,10)" else jobs[:1]:
        report = REPORTS[job][0]
        got = values(report(P.reduced_lists(typed, job), *args), "SUBSCRIBER_KEY")
        assert got == values(report(domain, *args), "SUBSCRIBER_KEY"), job
    plan = physical_plan(live_products(typed["assigned_product"], ("2053", "2448119"), AS_OF))
    assert "In(product_key, [2053" in plan[plan.index("PushedFilters"):]


@pytest.mark.parametrize("job", REPORTS)
def test_lists_are_reduced_where_they_are_read(spark, domain, conf, job):
    """The same report, with the rows of subscribers that it doesn't show gone before any shuffle."""
    report, args, _ = REPORTS[job]
    crowd = spark.range(500).select(F.concat(F.lit("x"), "id").alias("other"))
    lists = {"assigned_product": SUBSCRIBER, "assigned_billing_offer": SUBSCRIBER, "billing_detail": SUBSCRIBER,
             "parc_kfactor": SUBSCRIBER, "parc_sist": "subcriptor"}
    crowded = dict(domain)
    for name, key in lists.items():
        others = domain[name].limit(1).crossJoin(crowd).withColumn(key, F.col("other")).drop("other")
        crowded[name] = domain[name].unionByName(others)
    reduced = P.reduced_lists(crowded, job)
    for name, key in lists.items():
        kept = {r[0] for r in reduced[name].select(key).collect()}
        assert len([k for k in kept if k.startswith("x")]) < 5, name
    assert values(report(reduced, *args), "SUBSCRIBER_KEY") == values(report(domain, *args), "SUBSCRIBER_KEY")
    held = reduced["assigned_product"].groupBy(SUBSCRIBER).count()
    plan = physical_plan(held).split("\n")
    joined = next(k for k, line in enumerate(plan) if "BroadcastHashJoin" in line)
    shuffled = next(k for k, line in enumerate(plan) if "Exchange hashpartitioning" in line)
    assert shuffled < joined  # the exchange is above the join: rows go before they are moved


@pytest.mark.parametrize("job", REPORTS)
def test_reports_by_command_line(spark, domain, tmp_path, job):
    root = str(tmp_path)
    for name in JOB_TABLES[job]:
        df = domain[name]
        if name == "plan_list":
            df.withColumnRenamed("product_key", "cod_plan").coalesce(1).write.option(
                "header", True).csv(f"{root}/plan_list.csv")
            continue
        if name in ("parc_kfactor", "parc_coliving"):
            dated = {"year": F.lit(2024), "month": F.lit(1), "day": F.lit(1)}
            old = {"year": F.lit(2023), "month": F.lit(12), "day": F.lit(1)}
            both = df.withColumns(dated).union(df.limit(1).withColumns(old))
            both.write.partitionBy("year", "month", "day").parquet(f"{root}/{name}")
            continue
        df.write.parquet(f"{root}/{name}")
    report, _, _ = REPORTS[job]
    args = {"daily": (AS_OF, RUN), "monthly": ("202401", CLOSE), "daily-v2": (AS_OF,)}[job]
    command = [job] + (["202401"] if job == "monthly" else ["--as-of", str(AS_OF)])
    command += ["--run-ts", (CLOSE if job == "monthly" else RUN).isoformat()]
    out = f"{root}/report"
    run(spark, parse_args([*command, "--root", root, "--out", out, "--table", "report_table"]))
    written = spark.table("report_table")
    assert tuple(written.columns) == REPORT_COLUMNS
    assert values(written, "SUBSCRIBER_KEY") == values(report(domain, *args), "SUBSCRIBER_KEY")
    spark.sql("DROP TABLE report_table")


def test_command_line_arguments():
    report = ["--root", "R", "--out", "O"]
    ingest = ["ingest", "--url", "u", "--offers", "a", "--product", "b", "--out", "O"]
    for wrong in (
        ["monthly", "20240115", *report], ["monthly", "202413", *report],
        ["monthly", "202401", *report, "--as-of", "2024-01-15"],
        [*ingest, "--partition-column", "id"],
    ):
        with pytest.raises(SystemExit):
            parse_args(wrong)
    bounds = ["--partition-column", "id", "--lower", "1", "--upper", "9", "--partitions", "4"]
    assert parse_args([*ingest, *bounds]).bounds == ("id", "1", "9", 4)
    assert parse_args(ingest).bounds is None
    assert session_settings(parse_args(["daily", *report, "--table", "d.t"])) == {
        "spark.sql.catalogImplementation": "hive"}
    assert session_settings(parse_args(["daily", *report])) == {}


def test_a_table_of_this_session_does_not_last(spark):
    assert not lasting_catalog(spark)
