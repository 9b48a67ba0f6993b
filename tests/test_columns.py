"""C-series expressions on small dirty fixtures (FIXTURES §4)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions import columns as C
from ledgerlens.plans import domain


def test_parse_currency_cases(spark):
    rows = [(" 17,50,000 ",), (" - ",), ("500000",), ("",), ("12,3,456",), ("nan",), ("abc",), (None,), ("NaN",)]
    df = spark.createDataFrame(rows, "v string")
    got = [r[0] for r in df.select(C.parse_currency("v")).collect()]
    assert got == [1750000.0, None, 500000.0, None, 123456.0, None, None, None, None]


def test_number_or_zero(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,), ("nan",)], "v string")
    assert [r[0] for r in df.select(C.to_number_or_zero("v")).collect()] == [12.0, 0.0, 0.0, 0.0]


def test_future_dates_and_flag(spark):
    df = spark.createDataFrame([("2914-01-01",), ("1636-09-08",), ("junk",), ("2010-05-01",), (None,)], "d string")
    out = df.select(C.null_future_date("d", 2025).alias("x"), C.flag_before_year("d", 1900).alias("f")).collect()
    assert [r.x for r in out] == [None, dt.date(1636, 9, 8), None, dt.date(2010, 5, 1), None]
    assert [r.f for r in out] == [False, True, False, False, False]


def test_first_item_and_count(spark):
    cats = [("|Ent|Pol|News|",), ("Ent",), ("|",), ("",), (None,), ("||A||",)]
    df = spark.createDataFrame(cats, "c string")
    out = df.select(C.first_item("c").alias("f"), C.item_count("c").alias("n")).collect()
    assert [r.f for r in out] == ["Ent", "Ent", None, None, None, "A"]
    assert [r.n for r in out] == [3, 1, 0, 0, None, 1]


def test_argmax_column_ties_and_none(spark):
    cols = ["seed", "venture", "debt_financing", "undisclosed", "private_equity"]
    rows = [(0.0, 0.0, 0.0, 0.0, 0.0), (None, None, None, None, None), (0.0, 5.0, 0.0, 0.0, 0.0),
            (0.0, 3.0, 4.0, 0.0, 0.0), (0.0, 0.0, 0.0, 7.0, 0.0), (1.0, 1.0, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    out = [r[0] for r in df.select(C.argmax_column(cols, domain.round_rank())).collect()]
    # venture and debt_financing share rank 2: the earlier column wins
    assert out == [None, None, "venture", "venture", "undisclosed", "private_equity"]
    n = [r[0] for r in df.select(C.count_positive(cols)).collect()]
    assert n == [0, 0, 1, 2, 1, 3]


def test_flags_and_ratio(spark):
    df = spark.createDataFrame([(None, 0), (2, 0), (3, 2)], "r int, d int")
    out = df.select(C.gt_flag("r", 1).alias("m"), C.safe_ratio("r", "d").alias("q")).collect()
    assert [r.m for r in out] == [False, True, True]
    assert [r.q for r in out] == [None, None, 1.5]


def test_age_and_days(spark):
    df = spark.createDataFrame([(dt.date(1990, 1, 1), dt.date(1991, 1, 1)), (dt.date(1998, 1, 1), None)],
                               "f date, g date")
    out = df.select(C.age_years("f", "1997-01-01").alias("a"), C.days_between("f", "g").alias("d")).collect()
    assert out[0].a == 7.0 and out[0].d == 365
    assert out[1].a is None and out[1].d is None


def test_labels_and_tiers(spark):
    df = spark.createDataFrame([(1.5e9,), (2.25e6,), (3400.0,), (12.0,), (None,)], "x double")
    out = [r[0] for r in df.select(C.money_label("x", 1)).collect()]
    assert out == ["$1.5B", "$2.3M", "$3.4K", "$12", "-"]
    t = [r[0] for r in df.select(C.tier("x", [1e9, 1e6], ["big", "mid"], default="small")).collect()]
    assert t == ["big", "mid", "small", "small", "small"]
    b = [r[0] for r in spark.createDataFrame([(1,), (2,), (3,), (9,)], "n int")
         .select(C.tier("n", [0, 1, 2, 3, 100], ["1", "2", "3", "4+"], closed="right")).collect()]
    assert b == ["1", "2", "3", "4+"]


def test_search_contains_is_literal(spark):
    df = spark.createDataFrame([("a.b",), ("axb",), (None,)], "s string")
    assert [r[0] for r in df.select(C.search_contains("s", "A.B")).collect()] == [True, False, False]


def test_clip_and_bucket(spark):
    df = spark.createDataFrame([(5.0, 1993), (None, 1999), (50.0, 2000)], "x double, y int")
    out = df.select(C.clip("x", 10, 20).alias("c"), C.bucket_floor("y", 5).alias("b")).collect()
    assert [r.c for r in out] == [10.0, None, 20.0]
    assert [r.b for r in out] == [1990, 1995, 2000]
