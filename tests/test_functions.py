"""Column functions on the edge cases of their rules."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import values
from planledger.functions import calendar, labels, pricing, text


def one(spark, column, schema, *rows):
    """The column's value for each row, in input order."""
    df = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], "row_no int, " + schema)
    return [row[0] for row in df.orderBy("row_no").select(column).collect()]


def test_parse_amount(spark):
    raw = [("0",), ("00",), ("12.5",), (" 7 ",), ("Percent",), (None,), ("-3.9",), ("99999999999",)]
    col = F.col("raw")
    assert one(spark, text.parse_amount(col), "raw string", *raw) == [
        0, 0, 12, 7, None, None, -3, 99_999_999_999]
    assert one(spark, text.parse_amount(col, zero_as_null=True), "raw string", *raw)[:3] == [
        None, 0, 12]
    assert one(spark, text.blank_zeros(col), "raw string", *raw)[:3] == [None, None, "12.5"]


def test_only_plain_decimal_notation_is_a_number(spark):
    words = ["NaN", "Infinity", "-inf", "1d", "1f", "1e3", "0x1", "1 2", "", " ", ".", "+", "1,5", "٣"]
    numbers = {"1": 1.0, "-.5": -0.5, "+7.": 7.0, " 12.25 ": 12.25, "007": 7.0}
    raw = [(t,) for t in [*words, *numbers]]
    assert one(spark, text.parse_number(F.col("raw")), "raw string", *raw) == [None] * len(words) + list(numbers.values())


def test_contains_in_order(spark):
    rows = [("Cargo Fijo DATOS",), ("datos cargo",), (None,), ("10% x",), ("10 x",), ("a_b",)]
    col = F.col("t")
    assert one(spark, text.contains_in_order(col, "cargo", "datos"), "t string", *rows)[:3] == [
        True, False, None]
    assert one(spark, text.contains_in_order(col, "%"), "t string", *rows)[3:5] == [True, False]
    assert one(spark, text.contains_in_order(col, "a", "_", "b"), "t string", *rows)[4:] == [
        False, True]
    assert one(spark, text.contains_in_order(col, "cargo", fold=False), "t string", *rows)[0] is False


def test_names_and_codes(spark):
    assert one(spark, text.clean_name(F.col("t")), "t string", ("a|b",)) == ["a|b"]
    assert one(spark, text.clean_name(F.col("t"), True), "t string", ("a|b|",)) == ["ab"]
    assert one(spark, text.clean_offer_code(F.col("t")), "t string", ("*;RC;123RC",), ("ARC-CAR",)) == [
        "123", "A-A"]


def test_period():
    assert calendar.period_bounds("202402") == (date(2024, 2, 1), date(2024, 2, 29))
    assert calendar.period_bounds("202312") == (date(2023, 12, 1), date(2023, 12, 31))
    assert calendar.period_of(date(2024, 1, 15)) == "202401"


def test_in_period_takes_the_whole_last_day(spark):
    rows = [(datetime(2024, 1, 1),), (datetime(2024, 1, 31, 5),), (datetime(2024, 2, 1),), (None,)]
    got = one(spark, calendar.in_period(F.col("t"), "202401"), "t timestamp", *rows)
    assert got == [True, True, False, None]


def test_promo_end(spark):
    rows = [
        (date(2023, 1, 31), "M", 1), (date(2024, 1, 31), "M", 1), (date(2024, 1, 1), "D", 3),
        (date(2024, 1, 1), "Y", 3), (date(2024, 1, 1), "M", None), (None, "M", 1),
    ]
    column = calendar.promo_end(F.col("s"), F.col("i"), F.col("n"))
    assert one(spark, column, "s date, i string, n int", *rows) == [
        date(2023, 2, 28), date(2024, 2, 29), date(2024, 1, 4), None, None, None]


def test_stamps(spark):
    df = calendar.stamps(spark.range(1), date(2024, 1, 15), datetime(2024, 1, 15, 6, 7, 8))
    assert values(df) == [(0, "20240115 06:07:08", "202401")]
    df = calendar.stamps(spark.range(1), date(2024, 1, 15), period="202312")
    assert values(df) == [(0, date(2024, 1, 15), "202312")]


def test_net_service(spark):
    rows = [
        (1000.0, 100.0, None, None), (1000.0, 100.0, "10", "Fixed"),
        (1000.0, 100.0, "10", "Percent"), (1000.0, 100.0, "10", None),
        (1000.0, 100.0, "0", "Percent"), (1000.0, 100.0, None, "Percent"),
        (1000.0, 100.0, "x", "Fixed"), (1000.0, 100.0, "x", "Percent"), (None, 1.0, "10", "Fixed"),
    ]
    column = pricing.net_service(F.col("c"), F.col("d"), F.col("a"), F.col("k"))
    assert one(spark, column, "c double, d double, a string, k string", *rows) == [
        900, 890, 810, 890, 900, 900, None, 900, None]
    cut = pricing.net_service(F.lit(0), F.lit(0), F.col("a"), F.lit("Fixed"), truncate=True)
    assert one(spark, cut, "a string", ("12.9",)) == [-12]


def test_totals(spark):
    four = [F.col(name) for name in "abcd"]
    rows = [(10, 20, 1, 2), (10, None, 1, 2)]
    schema = "a int, b int, c int, d int"
    assert one(spark, pricing.total_fixed(*four), schema, *rows) == [27, 7]
    assert one(spark, pricing.total_fixed(*four, null_as_zero=False), schema, *rows) == [27, None]
    stacked = pricing.stacked_total(F.col("base"), [F.col("x"), F.col("y")])
    rows = [(1000.0, 10, 20), (1000.0, None, 20), (-12.9, None, None), (None, 1, 1), (1e12, 0, 0)]
    assert one(spark, stacked, "base double, x int, y int", *rows) == [
        720, 800, -12, None, 10**12]
    assert one(spark, pricing.floored(F.col("t")), "t int", (-1,), (0,), (5,), (None,)) == [
        0, 0, 5, None]
    shown = pricing.visible_type(F.col("a"), F.col("k"))
    assert one(spark, shown, "a string, k string", (None, "Fixed"), ("1", "Fixed")) == [None, "Fixed"]


LABELS = {
    (0, 0, 0): "MULTIPRODUCTO",
    (0, 0, 1): "MULTIPRODUCTO+PUNTUAL",
    (0, 1, 0): "MULTIPRODUCTO+FIN DE CICLO",
    (0, 1, 1): "MULTIPRODUCTO+FIN DE CICLO+PUNTUAL",
    (1, 0, 0): "MULTIPRODUCTO+PARAMETRIZABLE",
    (1, 0, 1): "MULTIPRODUCTO+PARAMETRIZABLE+PUNTUAL",
    (1, 1, 0): "MULTIPRODUCTO+PARAMETRIZABLE+FIN DE CICLO",
    (1, 1, 1): "MULTIPRODUCTO+PARAMETRIZABLE+FIN DE CICLO+PUNTUAL",
}


def test_mix_label(spark):
    flags = [tuple(bool(f) for f in key) for key in LABELS]
    column = labels.mix_label(F.col("p"), F.col("c"), F.col("u"))
    got = one(spark, column, "p boolean, c boolean, u boolean", *flags)
    assert got == list(LABELS.values())


@pytest.mark.parametrize("data, voice, cycle, promo, expected", [
    (False, False, True, True, "MULTIPRODUCTO+PARAMETRIZABLE+FIN DE CICLO+PUNTUAL"),
    (False, True, True, True, "MULTIPRODUCTO"),
    (True, True, True, True, "MULTIPRODUCTO+PARAMETRIZABLE+FIN DE CICLO+PUNTUAL"),
    (False, True, True, False, "MULTIPRODUCTO+PARAMETRIZABLE+FIN DE CICLO"),
    (False, False, False, True, "MULTIPRODUCTO+PUNTUAL"),
])
def test_legacy_label(spark, data, voice, cycle, promo, expected):
    column = labels.mix_label_v2_legacy(*[F.lit(flag) for flag in (data, voice, cycle, promo)])
    assert one(spark, column, "x int", (1,)) == [expected]


def test_usable_flag(spark):
    rows = [
        ("MULTIPRODUCTO", -1, 2019, True, "NO"), ("MULTIPRODUCTO", 0, 2019, True, "SI"),
        ("MULTIPRODUCTO", 0, 2019, False, "NO"), ("MULTIPRODUCTO", 30000, 2020, False, "SI"),
        ("MULTIPRODUCTO", 30001, 2020, False, "NO"), ("MULTIPRODUCTO", 30001, 2019, False, "SI"),
        ("MULTIPRODUCTO", None, 2020, False, "SI"), ("X+FIN DE CICLO", None, 2020, True, "NO"),
        ("MULTIPRODUCTO", 30001, None, False, "SI"),
    ]
    made = F.when(F.col("y").isNotNull(), F.make_date(F.col("y"), F.lit(6), F.lit(1)))
    schema = "l string, t int, y int, p boolean, e string"
    column = labels.usable_flag(F.col("l"), F.col("t"), made, F.col("p"))
    assert one(spark, column, schema, *rows) == [row[-1] for row in rows]
    uncapped = labels.usable_flag(F.col("l"), F.col("t"), made, F.col("p"), cap_rule=False)
    assert one(spark, uncapped, schema, *rows)[4] == "SI"


def test_product_kind(spark):
    rows = [
        ("KIND", "gps", "KIND"), (None, "Plan GPS", "M2M"), (None, "m2m x", "M2M"),
        (None, "bam", "BAM"), (None, "wifi y movil", "BAM"), (None, "movil wifi", "VOZ"),
        (None, None, "VOZ"),
    ]
    column = labels.product_kind(F.col("k"), F.col("d"))
    assert one(spark, column, "k string, d string, e string", *rows) == [row[-1] for row in rows]
    desc = labels.plan_desc(F.col("o"), F.lit("own"), F.lit("held"))
    assert one(spark, desc, "o string", ("2053",), ("7",), (None,)) == ["own", "held", "held"]
