"""Golden cases for the scalar operators."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import dates, money, text
from ledgerline.functions.describe import parse_charge_description

P1_CASES = [
    ("Port-Circuit ID: AB1 Customer Reference ID: R9-x-y", "R9 AB1", "Port x y"),
    ("Port-Circuit ID: AB1 Customer Reference ID: R9", "R9 AB1", "Port "),
    ("Port Customer Reference ID: R9-x", "R9", "Port x"),
    ("A- Circuit ID: C1 Customer Reference ID: R1", "R1", "A- Circuit ID: C1 "),
    ("Port-Circuit ID: AB1 more words", "AB1", "Port more words"),
    ("A-Circuit ID: X-Circuit ID: Y", "X", "A "),
    ("Port- Circuit ID: AB1", "AB1", "Port "),
    ("Line- Toll Free: 8005550100-Usage-Day", "8005550100", "Line Usage Day"),
    ("Line-Toll Free: 8005550100", "8005550100", "Line "),
    ("TN Fee - 8005550100", " 8005550100", "TN Fee "),
    ("Business White Pages Listing - Page 4", " Page 4", "Business White Pages Listing "),
    ("Plain Port", "", "Plain Port"),
]
P1_ERRORS = ["Business White Pages Listing none", "A Customer Reference ID: R1-Circuit ID: C9", None]


def test_p1_golden(spark):
    df = spark.createDataFrame([(d,) for d, _, _ in P1_CASES], "charge_description string")
    got = {r.charge_description: (r.toll_free_number, r.product_name, r.description_error)
           for r in parse_charge_description(df).collect()}
    for desc, ident, name in P1_CASES:
        assert got[desc] == (ident, name, None), desc


def test_p1_errors(spark):
    df = spark.createDataFrame([(d,) for d in P1_ERRORS], "charge_description string")
    rows = parse_charge_description(df).collect()
    assert all(r.description_error is not None and r.toll_free_number is None for r in rows)


COST_CASES = [  # charge, discount, units, unit cost, quantity
    ("$1,234.50", "(34.50)", "2", 600.0, 2),
    ("10", "0", "0.5", 10.0, 1),
    ("10", "0", None, 0.0, 1),
    ("10", "0", "", 10.0, 1),  # units column absent: default ''
    ("10", "0", "1,000", 0.01, 1000),
    ("10", "0", "2.5", 4.0, 2),
    ("10", "0", "-3", 10.0, 1),
    ("10", "0", "abc", 0.0, 1),
    ("10", None, "2", 0.0, 2),
]


def test_cost_and_quantity_golden(spark):
    df = spark.createDataFrame(COST_CASES, "c string, d string, u string, cost double, qty long")
    charge, _ = money.clean_money(F.col("c"))
    disc, _ = money.clean_money(F.col("d"))
    units = money.units_number(money.floor_units(F.col("u")))
    out = df.select("cost", "qty", money.round3(money.unit_cost(charge, disc, units)).alias("got_cost"),
                    money.service_quantity(units).alias("got_qty")).collect()
    for r in out:
        assert r.got_cost == pytest.approx(r.cost) and r.got_qty == r.qty, r


def test_money_error(spark):
    df = spark.createDataFrame([("x",), ("1d",), ("$ 1,0.5",), (None,)], "c string")
    got = [r.bad for r in df.select(money.clean_money(F.col("c"))[1].alias("bad")).collect()]
    assert got == [True, True, False, False]


def test_round3_half_even_on_scaled_float(spark):
    df = spark.createDataFrame([(2.0005, 2.001), (0.0025, 0.002), (1.0005, 1.0), (2.6745, 2.674)], "x double, want double")
    for r in df.select("want", money.round3(F.col("x")).alias("got")).collect():
        assert r.got == r.want


def test_units_floor_is_string_comparison(spark):
    df = spark.createDataFrame([("",), ("0",), ("0.5",), ("-3",), (".5",), ("(5)",), ("$5",), ("nan",), ("abc",),
                                (None,), ("007",), (" 5",), ("+5",)], "u string")
    got = [r.f for r in df.select(money.floor_units(F.col("u")).alias("f")).collect()]
    assert got == ["1.00"] * 7 + ["nan", "abc", "nan", "7", "5", "5"]


FREQ_CASES = [
    ("2023-01-01", "2023-01-31", 1.0),
    ("2023-01-01", "2023-02-15", 2.0),
    ("2023-01-01", "2023-03-17", 2.0),
    ("2023-01-01", "2023-01-10", 1.0),
    ("2023-01-31", "2023-01-01", 1.0),
    (None, "2023-01-31", None),
    ("2023-01-01 06:00:00", "2023-01-01 00:00:00", 1.0),
]


def test_frequency_golden(spark):
    df = spark.createDataFrame(FREQ_CASES, "f string, t string, want double")
    to_, from_ = dates.parse_timestamp(F.col("t")), dates.parse_timestamp(F.col("f"))
    for r in df.select("want", dates.clamp_frequency(dates.billing_frequency(to_, from_)).alias("got")).collect():
        assert r.got == r.want


def test_whole_days_floor(spark):
    df = spark.createDataFrame([("2023-01-01 06:00:00", "2023-01-01 00:00:00")], "f string, t string")
    r = df.select(dates.whole_days(dates.parse_timestamp(F.col("t")), dates.parse_timestamp(F.col("f"))).alias("d")).first()
    assert r.d == -1


def test_days_do_not_depend_on_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2023-03-01", "2023-04-01")], "f string, t string")
        r = df.select(dates.whole_days(dates.parse_timestamp(F.col("t")), dates.parse_timestamp(F.col("f"))).alias("d")).first()
        assert r.d == 31
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


LOC_CASES = [
    (("1 Main", "Rome", "NY", "US"), "1 Main Rome NY US", "1 Main Rome NY US"),
    (("1 Main", "Rome", None, "US"), "1 Main Rome  US", "1 Main Rome nan US"),
    ((None, "Rome", "NY", "US"), None, "nan Rome NY US"),
    ((None, None, None, None), None, ""),
    (("", "", "", ""), "   ", "   "),
]


def test_locations_golden(spark):
    df = spark.createDataFrame([parts for parts, _, _ in LOC_CASES], "a string, c string, s string, k string")
    cols = [F.col(x) for x in "acsk"]
    got = df.select(text.location_a(*cols).alias("la"), text.location_b(*cols).alias("lb")).collect()
    assert [(r.la, r.lb) for r in got] == [(a, b) for _, a, b in LOC_CASES]


def test_doc_label_and_paths(spark):
    df = spark.createDataFrame([("s3://b/in/DOC-899-0898-x (Y).csv",), ("DOC-12-aaaa-Vendor_1.csv",)], "p string")
    got = df.select(text.doc_label(F.col("p")).alias("l"), text.swap_ext(text.base_name(F.col("p"))).alias("o")).collect()
    assert [(r.l, r.o) for r in got] == [("DOC-899", "DOC-899-0898-x (Y).xlsx"), ("DOC-12", "DOC-12-aaaa-Vendor_1.xlsx")]


def test_flatten_and_decode(spark):
    df = spark.createDataFrame([("a\nb\rc\\nd\\re",)], "e string")
    assert df.select(text.flatten_error(F.col("e")).alias("x")).first().x == "abcde"
    df = spark.createDataFrame([("a%20b+c",), ("bad%zz",)], "k string")
    assert [r.x for r in df.select(text.decode_key(F.col("k")).alias("x")).collect()] == ["a b+c", "bad%zz"]
