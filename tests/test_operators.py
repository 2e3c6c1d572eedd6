"""Filters, joins and reductions on small frames."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, physical_plan, values
from planledger.contracts import TABLES, ddl, normalise, normalise_keys
from planledger.operators import filters, joins, reduce
from planledger.plans.catalog import gather

D = date(2024, 1, 31)


def test_key_trim_makes_keys_match(spark):
    left = normalise_keys(spark.createDataFrame([(" 7 ",)], "k string"), ["k"])
    right = normalise_keys(spark.createDataFrame([(7,)], "k int"), ["k"])
    assert values(left.join(right, "k")) == [("7",)]


@pytest.mark.parametrize(("kind", "texts"), [
    ("decimal(38,10)", {"2053": "2053", "0": "0", "100": "100", "-7": "-7", "12.50": "12.5"}),
    ("decimal(38,0)", {"2053": "2053", "0": "0", "12345678901234567890": "12345678901234567890"}),
    ("double", {"1351": "1351", "0": "0", "100000000000": "100000000000", "-3": "-3", "1.5": "1.5", "NaN": "NaN"}),
    ("float", {"1351": "1351"}),
])
def test_whole_numbers_are_keys_by_their_digits(spark, kind, texts):
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "raw string").selectExpr("raw", f"cast(raw AS {kind}) AS k")
    assert {r["raw"]: r["k"] for r in normalise_keys(rows, ["k"]).collect()} == {**texts, None: None}


def test_codes_that_a_type_cannot_hold_match_nothing(spark):
    rows = spark.createDataFrame([("1351",), ("7",), (None,)], "raw string").selectExpr("cast(raw AS decimal(6,2)) AS k")
    assert values(rows.filter(filters.code_in(rows, "k", ("1351", "2448119")))) == [(Decimal("1351.00"),)]


def test_normalise_follows_the_contract(spark):
    raw = spark.createDataFrame(
        [(7, " 9", "2024-01-02")],
        "PRODUCT_KEY int, product_desc string, price_plan_promotion_interval string",
    ).withColumn("price_plan_promotion_duration", F.lit("3"))
    got = normalise(raw, "product")
    assert got.columns == list(TABLES["product"])
    assert values(got) == [("7", " 9", "2024-01-02", 3)]


def test_valid_at(spark):
    rows = spark.createDataFrame([
        ("starts_that_day", D, date(2024, 2, 1)), ("ends_that_day", date(2024, 1, 1), D),
        ("ends_next_day", date(2024, 1, 1), date(2024, 2, 1)), ("open", date(2024, 1, 1), None),
        ("not_started", date(2024, 2, 1), date(2024, 3, 1)),
    ], "id string, s date, e date")

    def ids(**kwargs):
        return {row[0] for row in values(filters.valid_at(rows, d=D, **kwargs).select("id"))}

    assert ids(start="s", end="e") == {"starts_that_day", "ends_next_day"}
    assert ids(start="s", end="e", open_end=date(2024, 2, 9)) == {
        "starts_that_day", "ends_next_day", "open"}
    assert ids(start="s", end="e", open_end=D) == {"starts_that_day", "ends_next_day"}
    assert ids(start=None, end="e") == {"starts_that_day", "ends_next_day", "not_started"}


def test_null_flags_drop_rows(spark):
    parc = spark.createDataFrame([
        ("1", "A", "A", "C", "p"), ("2", "B", None, "C", "p"), ("3", "C", "T", "C", "p"),
        ("4", None, "A", "C", "p"), ("1", "A", "A", "C", "q"), ("5", "E", "A", "R", "p"),
    ], ddl("parc_kfactor"))
    assert values(filters.eligible_accounts(parc)) == [("A", "1")]
    cust = spark.createDataFrame([
        ("1", "3042", None, "r", "n", "C", "INSERT"), ("2", "3042", None, "r", "n", "C", None),
        ("3", "3042", None, "r", "n", "C", "DELETE"), ("4", "3042", None, "#", "n", "C", "INSERT"),
        ("5", "3044", None, "r", "n", "C", "INSERT"), ("6", "1", None, "r", "n", "C", "INSERT"),
        ("7", "3042", None, None, "n", "C", "INSERT"),
    ], ddl("customer"))
    assert [r[0] for r in values(filters.business_customers(cust))] == ["1", "5"]
    assert [r[0] for r in values(filters.business_customers(cust, ("3042",)))] == ["1"]


def test_eligible_subscribers(spark):
    subs = spark.createDataFrame([
        ("1", "c", "1376", "1402", "569", None), ("2", "c", "1377", "1402", "569", None),
        ("3", "c", "1378", "1400", "569", None), ("4", "c", "1379", "1403", "x9", None),
    ], ddl("subscribers"))
    assert [r[0] for r in values(filters.eligible_subscribers(subs))] == ["1", "4"]
    assert [r[0] for r in values(filters.eligible_subscribers(subs, numeric_phone=True))] == ["1"]


def test_sub_types(spark):
    dim = spark.createDataFrame([("1", "Mediana"), ("2", "Micro"), ("3", None)], ddl("customer_sub_type"))
    got = filters.sub_types(dim, ("1", "3"), {"Mediana": "Mediana Empresa"})
    assert values(got) == [("1", "Mediana Empresa"), ("3", None)]


@pytest.mark.parametrize("desc, value, kept", [
    ("10% x", "10", True), ("10 x", "10", False), ("10% SMS", "10", False),
    ("10% bolsa de datos", "10", False), ("10% x", "Percent", False), ("10% x", None, False),
    (None, "10", False), ("10% x", "word", True),
])
def test_promo_values(spark, desc, value, kept):
    product = spark.createDataFrame([("1", desc, "M", 1)], ddl("product"))
    params = spark.createDataFrame(
        [("1", value)], "product_key string, billing_attribute_default_val string")
    assert filters.promo_values(product, params).count() == int(kept)


def test_base_rows_hide_configurable_discounts(spark):
    view = spark.createDataFrame(
        [("1", "Plan"), ("1", "Plan"), ("2", "RC x Configurable y discount"), ("3", None)],
        "k string, d string")
    assert values(filters.base_rows(view, ("k", "d"), desc="d")) == [("1", "Plan")]


def test_best_row_orders_nulls_last_and_breaks_ties(spark):
    rows = spark.createDataFrame([
        ("a", 1, None, "x"), ("a", 1, 5, "y"), ("a", None, 9, "z"), ("b", 2, 2, "p"),
        ("b", 2, 2, "q"), (None, None, None, "n"),
    ], "k string, o1 int, o2 int, t string")
    assert values(reduce.best_row(rows, "k", ["o1", "o2"])) == [
        (None, None, None, "n"), ("a", 1, 5, "y"), ("b", 2, 2, "q")]


def test_slots_take_the_first_five(spark):
    rows = spark.createDataFrame(
        [("a", n) for n in (6, 3, 1, 2, 5, 4)] + [("b", 2), ("b", 2)], "k string, v int")
    numbered = reduce.number_slots(rows, "k", ["v"])
    spread = reduce.spread_by_slot(numbered, "k", "slot", ["v"])
    assert values(spread) == [("a", 1, 2, 3, 4, 5), ("b", 2, 2, None, None, None)]


def test_spread_by_kind_fill(spark):
    rows = spark.createDataFrame(
        [("a", "x", -5), ("a", "y", None), ("b", "y", 3)], "k string, t string, v int")
    rules = {"x": F.col("t") == "x", "y": F.col("t") == "y"}
    assert values(reduce.spread_by_kind(rows, "k", rules, F.col("v"))) == [
        ("a", -5, None), ("b", None, 3)]
    assert values(reduce.spread_by_kind(rows, "k", rules, F.col("v"), fill=0)) == [
        ("a", -5, 0), ("b", 0, 3)]


def test_best_pair_keeps_amount_and_type_together(spark):
    rows = spark.createDataFrame([
        ("a", "1", 10, None), ("a", "1", None, "Percent"), ("a", "2", 20, None),
        ("a", "3", None, "Zzz"), ("b", "4", None, "Fixed"), ("c", "5", 7, "Fixed"),
    ], "k string, p string, amount int, kind string")
    assert values(reduce.best_pair(rows, "k", "p", "amount", "kind")) == [
        ("a", 20, None), ("b", None, None), ("c", 7, "Fixed")]


def test_billed_month(spark):
    base = ("Micro", "Postpaid Payment", "RM_VOZ_PL_POS")
    rows = [
        ("1", *base, date(2024, 1, 1), date(2024, 1, 5), 10),
        ("1", *base, date(2024, 1, 31), date(2024, 1, 31), 5),
        ("1", *base, date(2024, 2, 1), None, 100), ("1", *base, date(2023, 12, 31), None, 100),
        ("2", "Personas", *base[1:], date(2024, 1, 2), None, 1),
        ("3", base[0], "Prepaid", base[2], date(2024, 1, 2), None, 1),
        ("4", *base[:2], "OTHER", date(2024, 1, 2), None, 1),
    ]
    from decimal import Decimal
    detail = spark.createDataFrame(
        [(*row[:-1], Decimal(row[-1])) for row in rows], ddl("billing_detail"))
    assert [(k, int(v)) for k, v in values(reduce.billed_month(detail, "202401"))] == [("1", 15)]


def test_join_shapes(spark):
    base = spark.createDataFrame([("1", "a"), ("2", "b"), (None, "c")], "k string, v string")
    right = spark.createDataFrame([("1", "x"), ("1", "DELETE"), ("2", None)], "k string, f string")
    ok = F.col("f") != "DELETE"
    assert values(joins.left_filtered(base, right, "k", ok)) == [
        (None, "c", None), ("1", "a", "x"), ("2", "b", None)]
    assert values(joins.inner_filtered(base, right, "k", ok)) == [("1", "a", "x")]
    listed = joins.in_list(base, right, "k", "listed")
    assert values(listed) == [(None, "c", False), ("1", "a", True), ("2", "b", True)]
    totals = spark.createDataFrame([("1", 5)], "k string, t int")
    assert values(joins.attach_total(base, totals, "k", "t", 0))[1:] == [("1", "a", 5), ("2", "b", 0)]
    assert values(joins.attach_total(base, totals, "k", "t"))[2] == ("2", "b", None)
    roles = joins.role_join(joins.role_join(base, right, "k", "k", "one_"), totals, "one_k", "k", "two_")
    assert "two_t" in roles.columns and roles.count() == 4


def test_small_lookups_are_broadcast_by_size(spark, conf):
    df = spark.createDataFrame([("1", 1), ("2", 2), (None, 3)], "k string, v int")
    dim = spark.createDataFrame([("1", "x")], "k string, d string")
    small = joins.split_join(df, dim, "k")
    assert "BroadcastHashJoin" in final_plan(small)
    rows = values(small)
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    large = joins.split_join(df, dim, "k")
    assert "BroadcastHashJoin" not in final_plan(large)
    assert values(large) == rows


def test_code_filters_reach_the_parquet_reader(spark, conf, tmp_path):
    """Codes that are numbers in the file are compared as numbers; padded texts still match."""
    rest = [
        "id AS subscriber_key", "id AS assigned_product_key", "'A' AS assigned_product_id", "id AS customer_key",
        "date'2020-01-01' AS start_date", "date'2030-01-01' AS end_date", "'I' AS dml_ind",
    ]
    names = ("product_key", "assigned_product_status_key", "assigned_product_state_key")
    codes = [f"{value} AS {name}" for value, name in zip((2053, 1351, 1331), names)]
    path = str(tmp_path / "numbers")
    spark.range(3).selectExpr(*codes, *rest).write.parquet(path)
    rows = normalise(spark.read.parquet(path), "assigned_product")
    live = filters.live_products(rows, ("2053", "2448119"), date(2024, 1, 1))
    conf(maxMetadataStringLength="2000")
    pushed = physical_plan(live).split("PushedFilters: [")[1].split("ReadSchema")[0]
    for name in names:
        assert f"In({name}," in pushed or f"EqualTo({name}," in pushed, pushed
    assert {row.product_key for row in live.collect()} == {"2053"} and live.count() == 3
    texts = [f"'{value}' AS {name}" for value, name in zip((" 2053 ", "1351 ", " 1331"), names)]
    text = spark.range(1).selectExpr(*texts, *rest)
    padded = filters.live_products(normalise(text, "assigned_product"), ("2053",), date(2024, 1, 1))
    assert [row.product_key for row in padded.collect()] == ["2053"]


def test_gather_keeps_keys_known_to_some(spark):
    a = spark.createDataFrame([("1", "x"), ("1", "y"), ("2", "z")], "k string, a string")
    b = spark.createDataFrame([("3", 5), ("1", 6)], "k string, b int")
    assert values(gather(a, b, key="k")) == [("1", "y", 6), ("2", "z", None), ("3", None, 5)]


HOT = 3  # one row in three belongs to key 0


def hot_rows(spark, n=60000):
    return spark.range(0, n, 1, 16).select(
        F.when(F.col("id") % HOT == 0, 0).otherwise(F.col("id") % 500).cast("string").alias("k"),
        F.xxhash64("id").alias("v"),
    )


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    rows = hot_rows(spark)
    slots = physical_plan(reduce.number_slots(rows, "k", ["v"]))
    assert slots.count("WindowGroupLimit") == 2
    assert slots.rindex("WindowGroupLimit") > slots.index("Exchange hashpartitioning")
    best = physical_plan(reduce.best_row(rows, "k", ["v"]))
    assert best.index("partial_max") > best.index("Exchange hashpartitioning")
    top = rows.toPandas().sort_values("v")
    got = reduce.number_slots(rows, "k", ["v"]).toPandas().sort_values(["k", "v"])
    want = top.groupby("k").head(5).sort_values(["k", "v"])
    assert got[["k", "v"]].values.tolist() == want.values.tolist()


def test_hot_partitions_of_a_split_join_are_divided(spark, conf, tmp_path):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    path = str(tmp_path / "right")
    spark.range(0, 2000).select(
        (F.col("id") % 500).cast("string").alias("k"), F.col("id").alias("w")
    ).write.parquet(path)
    right = spark.read.parquet(path).groupBy("k").agg(F.max("w").alias("w"))
    left = hot_rows(spark)
    joined = joins.split_join(left, right, "k").groupBy("w").count()
    assert "skew=true" in final_plan(joined)
    in_place = left.join(right, "k", "left").groupBy("w").count()
    assert "skew=true" not in final_plan(in_place)
    assert values(joined) == values(in_place)
