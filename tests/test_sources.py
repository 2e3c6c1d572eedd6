"""Reading and writing."""

import random
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import fixture_domain
from conftest import physical_plan, values
from fixture_domain import frame
from planledger import contracts
from planledger.__main__ import parse_args, run
from planledger.operators.reduce import billed_month
from planledger.plans import revenue
from planledger.plans.ingest import ingest_cycle_discounts
from planledger.plans.snapshots import daily_snapshot
from planledger.session import build_session, shared_folder
from planledger.sources import sinks, tables


@pytest.mark.parametrize("folders", [
    [(2023, 12, 31), (2024, 1, 2), (2024, 1, 10)],
    [(2023, 12, 31), (2024, 9, 28), (2024, 10, 1)],
])
def test_latest_partition_compares_numbers(spark, tmp_path, folders):
    root = str(tmp_path / "parc")
    spark.createDataFrame(
        [(f"{y}-{m}-{d}", y, m, d) for y, m, d in folders], "v string, year int, month int, day int"
    ).write.partitionBy("year", "month", "day").parquet(root)
    latest = tables.latest_partition(spark.read.parquet(root))
    assert values(latest.select("v")) == [("-".join(str(n) for n in folders[-1]),)]
    scan = [line for line in physical_plan(latest).splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [(struct(" in scan and "ReadSchema: struct<v:string>" in scan


def test_padded_folder_names(spark, tmp_path):
    root = tmp_path / "parc"
    for month, value in (("09", "old"), ("10", "new")):
        spark.createDataFrame([(value,)], "v string").write.parquet(
            str(root / "year=2024" / f"month={month}" / "day=01"))
    df = spark.read.parquet(str(root))
    assert values(tables.latest_partition(df).select("v")) == [("new",)]
    september = tables.period_partition(df, "202409")
    assert values(september.select("v")) == [("old",)]
    scan = physical_plan(september)
    assert "PartitionFilters: [isnotnull(year" in scan


def test_dated_folders_list_one_date(spark, tmp_path):
    root = tmp_path / "parc_kfactor"
    rows = {("2023", "12", "31"): "a", ("2024", "9", "28"): "b", ("2024", "10", "1"): "c",
            ("2024", "10", "01"): "d"}
    for (year, month, day), value in rows.items():
        frame(spark, "parc_kfactor", [{"subscriber_key": value}]).write.parquet(
            str(root / f"year={year}" / f"month={month}" / f"day={day}"))
    (root / "year=2024" / "_SUCCESS").touch()
    latest = tables.read_dated(spark, str(tmp_path), "parc_kfactor")
    assert [row[0] for row in values(latest)] == ["c", "d"]
    older = tables.read_dated(spark, str(tmp_path), "parc_kfactor", "202409", day=28)
    assert [row[0] for row in values(older)] == ["b"]
    with pytest.raises(FileNotFoundError):
        tables.read_dated(spark, str(tmp_path), "parc_kfactor", "202408")


def test_read_table_prunes_columns_and_pushes_filters(spark, tmp_path):
    spark.createDataFrame(
        [(" 1", "x", "M", 2, "unused")],
        "product_key string, product_desc string, price_plan_promotion_interval string, "
        "price_plan_promotion_duration int, other string",
    ).write.parquet(str(tmp_path / "product"))
    df = tables.read_table(spark, str(tmp_path), "product").filter(F.col("product_desc") == "x")
    scan = physical_plan(df.select("product_key"))
    assert "EqualTo(product_desc,x)" in scan
    assert "ReadSchema: struct<product_key:string,product_desc:string>" in scan
    assert values(df.select("product_key")) == [("1",)]


def test_plan_list_binds_by_position(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text("codigo,texto\n 7 ,Plan\n8,\n")
    assert values(tables.read_plan_list(spark, str(path))) == [("7", "Plan"), ("8", None)]
    raw = tables.read_csv_list(spark, str(path))
    assert raw.columns == ["product_key", "descripcion"]


def test_orc_table_and_parquet_are_overwritten(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_snapshot(spark.range(10), path, "snapshot_table")
    sinks.write_snapshot(spark.range(3), path, "snapshot_table", files=1)
    assert spark.table("snapshot_table").count() == 3
    assert spark.read.orc(path).count() == 3
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    spark.sql("DROP TABLE snapshot_table")
    extract = str(tmp_path / "extract")
    sinks.write_snapshot(spark.range(5), extract, fmt="parquet")
    assert spark.read.parquet(extract).count() == 5


def test_a_report_survives_its_own_failed_rerun(spark, tmp_path):
    """Readers by path and by table see yesterday's rows, and nothing is left beside them."""
    path = str(tmp_path / "out")
    sinks.write_snapshot(spark.range(5), path, "lasting_table")
    broken = spark.range(10).selectExpr("if(id = 7, cast(raise_error('stop') AS bigint), id) AS id")
    with pytest.raises(Exception, match="stop"):
        sinks.write_snapshot(broken, path, "lasting_table")
    assert spark.read.orc(path).count() == spark.table("lasting_table").count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    # Also where the new report is computed from the old one, and where the columns change.
    sinks.write_snapshot(spark.read.orc(path).filter("id > 1"), path, "lasting_table")
    assert spark.table("lasting_table").count() == 3
    sinks.write_snapshot(spark.range(2).withColumn("x", F.lit("new")), path, "lasting_table")
    assert spark.table("lasting_table").columns == ["id", "x"] and spark.table("lasting_table").count() == 2
    spark.sql("DROP TABLE lasting_table")


def test_publishing_rolls_back_and_recovers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    sinks.write_snapshot(spark.range(5), path, fmt="parquet")
    rename = sinks.Folder.rename

    def failing(self, old, new):
        if old == self.next:
            raise OSError("no")
        rename(self, old, new)

    monkeypatch.setattr(sinks.Folder, "rename", failing)
    with pytest.raises(OSError, match="no"):
        sinks.write_snapshot(spark.range(7), path, fmt="parquet")
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["out"]
    monkeypatch.undo()
    (tmp_path / "out").rename(tmp_path / "out.previous")  # a run ended between the renames
    broken = spark.range(3).selectExpr("cast(raise_error('stop') AS bigint) AS id")
    with pytest.raises(Exception, match="stop"):
        sinks.write_snapshot(broken, path, fmt="parquet")
    assert spark.read.parquet(path).count() == 5
    sinks.write_snapshot(spark.range(7), path, fmt="parquet")
    assert spark.read.parquet(path).count() == 7 and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_plan_list_header_and_short_rows(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text("descripcion,cod_plan\nPlan,7\n")
    with pytest.raises(ValueError, match="descripcion, cod_plan"):
        tables.read_plan_list(spark, str(path))
    path.write_text("cod_plan\n7\n")
    with pytest.raises(ValueError, match="cod_plan"):
        tables.read_plan_list(spark, str(path))
    path.write_text('cod_plan,descripcion\n7,Plan\n8\n9,a,b\n10,"x, y"\n11,\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        tables.read_plan_list(spark, str(path)).select("product_key").collect()
    assert values(tables.rejected_rows(spark, str(path))) == [("8",), ("9,a,b",)]
    kept = values(tables.read_plan_list(spark, str(path), bad_rows="keep"))
    assert kept == [("10", "x, y"), ("11", None), ("7", "Plan"), ("8", None), ("9", "a")]
    path.write_text('cod_plan,descripcion\n7,Plan\n10,"x, y"\n')
    assert tables.rejected_rows(spark, str(path)).count() == 0
    assert values(tables.read_plan_list(spark, str(path))) == [("10", "x, y"), ("7", "Plan")]


def test_losses_are_counted_with_the_report(spark, tmp_path):
    rows = [(" 1", "x", "2024-01-02", "5.5"), (None, "y", "soon", "much"), ("3", None, None, "7")]
    raw = spark.createDataFrame(rows, "subscriber_key string, charge_code_id string, bill_date string, charge_amount string")
    raw = raw.withColumns({n: F.lit("x") for n in ("customer_sub_type_desc", "payment_category_desc")})
    raw.withColumn("close_date", F.lit(date(2024, 1, 31))).write.parquet(str(tmp_path / "billing_detail"))
    losses = contracts.CastLosses()
    df = tables.read_table(spark, str(tmp_path), "billing_detail", losses)
    assert [tuple(r) for r in df.filter("bill_date is not null").select("subscriber_key").collect()] == [("1",)]
    assert losses.counts() == {"billing_detail": {
        "rows": 3, "bill_date lost": 1, "charge_amount lost": 1, "subscriber_key null": 1}}
    plain = tables.read_table(spark, str(tmp_path), "billing_detail")
    assert plain.columns == df.columns and values(plain) == values(df)


DERBY = "jdbc:derby:memory:planledger;create=true"
DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_jdbc_read_and_ingest(spark, tmp_path):
    """Against a database inside this JVM; it opens no port and vanishes with it."""
    offers = [("*;RC;1RC",), ("*1*",), ("RC2",), ("RC9",), ("RC3",)]
    spark.createDataFrame(offers, "applied_to_ind string").write.jdbc(
        DERBY, "OFFERS", mode="overwrite", properties=DRIVER)
    product = [(1, "Uno"), (2, "Dos"), (3, None), (4, "Cuatro")]
    spark.createDataFrame(product, "product_key int, product_desc string").write.jdbc(
        DERBY, "PRODUCT", mode="overwrite", properties=DRIVER)
    whole = tables.read_jdbc(spark, DERBY, "PRODUCT", DRIVER)
    split = tables.read_jdbc(spark, DERBY, "PRODUCT", DRIVER, ("product_key", 1, 4, 3))
    assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() == 3
    assert values(whole) == values(split)
    out = str(tmp_path / "cycle")
    run(spark, parse_args([
        "ingest", "--url", DERBY, "--offers", "OFFERS", "--product", "PRODUCT", "--out", out,
        "--property", f"driver={DRIVER['driver']}",
    ]))
    assert values(spark.read.parquet(out)) == [("1", "Uno"), ("2", "Dos")]


def test_the_database_is_asked_for_bounds(spark, tmp_path):
    """Rows without a value come with the first split; a table without values needs no bounds."""
    rows = [(k if k % 5 else None, f"p{k}") for k in range(40)]
    spark.createDataFrame(rows, "product_key int, product_desc string").write.jdbc(DERBY, "PRODUCTS", mode="overwrite", properties=DRIVER)
    assert tables.jdbc_bounds(spark, DERBY, "PRODUCTS", "product_key", DRIVER) == (1, 39)
    split = tables.read_jdbc(spark, DERBY, "PRODUCTS", DRIVER, ("product_key", None, None, 4))
    assert split.rdd.getNumPartitions() == 4
    found = split.withColumn("part", F.spark_partition_id()).collect()
    assert Counter((r[0], r[1]) for r in found) == Counter(rows) and {r["part"] for r in found} == {0, 1, 2, 3}
    nothing = spark.createDataFrame([(None, "x")], "product_key int, product_desc string")
    nothing.write.jdbc(DERBY, "NOTHING", mode="overwrite", properties=DRIVER)
    assert values(tables.read_jdbc(spark, DERBY, "NOTHING", DRIVER, ("product_key", None, None, 4))) == [(None, "x")]
    spark.createDataFrame([("*;RC;7RC",), ("*1*",)], "applied_to_ind string").write.jdbc(DERBY, "OFFERED", mode="overwrite", properties=DRIVER)
    out = str(tmp_path / "cycle")
    run(spark, parse_args([
        "ingest", "--url", DERBY, "--offers", "OFFERED", "--product", "PRODUCTS", "--out", out,
        "--product-partition-column", "product_key", "--partitions", "3", "--property", f"driver={DRIVER['driver']}",
    ]))
    assert values(spark.read.parquet(out)) == [("1", "p1"), ("7", "p7")]


def test_months_add_up_from_stored_days(spark, tmp_path):
    """Random billing with late rows: the stored days give what the whole detail gives."""
    rng = random.Random(9)
    folder = str(tmp_path / "days")

    def lines(n):
        return spark.createDataFrame([(
            rng.choice(["1", "2", "3", None]), rng.choice(["Mediana", "Personas"]), rng.choice(["Postpaid Payment", None]),
            rng.choice(["RM_VOZ_PL_POS", "OTHER"]), rng.choice([None, date(2024, 1, rng.randint(1, 31)), date(2023, 12, 31)]),
            None, Decimal(rng.randint(-500, 5000)) / 100,
        ) for _ in range(n)], contracts.ddl("billing_detail"))

    detail = lines(400)
    revenue.store_days(detail, folder)
    late = lines(30)
    whole = detail.union(late)
    revenue.store_days(whole, folder, revenue.days_of(late))
    for period in ("202401", "202312"):
        full = billed_month(whole, period).filter("arpu is not null")
        assert values(revenue.billed_month_of_days(spark, folder, period)) == values(full)
    # A day whose rows were all taken back is cleared, the others stay.
    gone = date(2024, 1, 7)
    left = whole.filter(F.coalesce(F.col("bill_date") != gone, F.lit(True)))
    revenue.store_days(left, folder, spark.createDataFrame([(gone,)], "bill_date date"))
    full = billed_month(left, "202401").filter("arpu is not null")
    assert values(revenue.billed_month_of_days(spark, folder, "202401")) == values(full)


def test_bucketed_tables_are_grouped_without_a_shuffle(spark, tmp_path):
    """The same report from bucketed tables, with fewer exchanges; other tables stay as they are."""
    domain = {name: contracts.normalise(df, name) for name, df in fixture_domain.tables(spark).items()}
    big = ("assigned_product", "assigned_billing_offer", "billing_detail", "parc_kfactor", "parc_sist")
    for name in big:
        sinks.write_bucketed(domain[name], name, f"bucketed_{name}", 4, str(tmp_path / name))
    stored = domain | tables.read_bucketed(spark, {name: f"bucketed_{name}" for name in big})
    run_ts = datetime(2024, 1, 15, 6)
    plain, bucketed = (daily_snapshot(t, fixture_domain.AS_OF, run_ts) for t in (domain, stored))
    assert values(bucketed, "SUBSCRIBER_KEY") == values(plain, "SUBSCRIBER_KEY")
    exchanges = [physical_plan(df).count("Exchange hashpartitioning") for df in (plain, bucketed)]
    assert exchanges[1] <= exchanges[0] - 4, exchanges
    one = physical_plan(billed_month(stored["billing_detail"], "202401"))
    assert "Exchange" not in one and "Bucketed: true" in one
    for name in big:
        spark.sql(f"DROP TABLE bucketed_{name}")


def test_ingest_drops_unknown_and_nameless(spark):
    offers = spark.createDataFrame([("*;RC;123RC",), ("RC5",), ("RC6",), ("*123*",)], "applied_to_ind string")
    product = spark.createDataFrame([("123", "x"), ("6", None)], "product_key string, product_desc string")
    assert values(ingest_cycle_discounts(offers, product)) == [("123", "x")]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_cluster_settings_win(spark):
    """The session's own settings are not replaced by the defaults."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    again = build_session("again", shuffle_partitions=64)
    assert again.conf.get("spark.sql.shuffle.partitions") == before
    assert again.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "64"
    again.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
