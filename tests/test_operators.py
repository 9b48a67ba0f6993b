"""Joins, reshaping, aggregation and windows on tiny fixtures with nulls and ties."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import aggregate as A
from ledgerlens.operators import joins as J
from ledgerlens.operators import quality as D
from ledgerlens.operators import reshape as U
from ledgerlens.operators import windows as W


def test_enrich_left_null_safe(spark):
    base = spark.createDataFrame([("a", "x"), (None, "y"), ("b", "z")], "k string, s string")
    extra = spark.createDataFrame([("a", "X"), (None, "NULLKEY")], "k string, s string")
    out = {r.s for r in J.enrich_left(base, extra, "k", overwrite=["s"]).collect()}
    assert out == {"X", "NULLKEY", "z"}


def test_append_missing_keeps_null_keys(spark):
    base = spark.createDataFrame([("a", 1)], "k string, v int")
    other = spark.createDataFrame([("a", "n1"), ("c", "n2"), (None, "n3")], "k string, name string")
    out = J.append_missing(base, other, "k")
    assert out.count() == 3
    assert {r.k for r in out.where(F.col("v").isNull()).collect()} == {"c", None}


def test_lookup_key_composite_nullable(spark):
    fact = spark.createDataFrame([(None, "x"), ("x", None), (None, None), ("x", "y")], "a string, b string")
    dim = U.build_dimension(fact, ["a", "b"], "id")
    ids = J.lookup_key(fact, dim, ["a", "b"], "id")
    assert ids.where(F.col("id").isNull()).count() == 0
    assert sorted(r.id for r in dim.collect()) == [1, 2, 3, 4]


def test_match_entities_guard(spark):
    fact = spark.createDataFrame([("bolt", "US"), ("bolt", "EE"), ("x", None)], "n string, c string")
    ref = spark.createDataFrame([("bolt", "US", 1, 5.0), ("bolt", "US", 2, 6.0), ("x", None, 3, 1.0)],
                                "n string, c string, o int, val double")
    out = J.match_entities(fact, ref, ["n", "c"], ["o"], ["val"], flag="hit")
    got = {(r.n, r.c): (r.val, r.hit) for r in out.collect()}
    assert got == {("bolt", "US"): (5.0, True), ("bolt", "EE"): (None, False), ("x", None): (1.0, True)}
    with pytest.raises(D.RowCountChanged):
        D.assert_same_rows(fact, fact.join(ref.select("n"), "n"))


def test_dedupe_keep_first(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (None, 5, "z"), (None, 3, "y")], "k int, o int, v string")
    out = {(r.k, r.v) for r in U.dedupe_keep_first(df, ["k"], ["o"]).collect()}
    assert out == {(1, "a"), (None, "y")}


def test_unpivot_then_group_equals_wide_sum(spark):
    wide = spark.createDataFrame([(1, 10.0, 0.0, None), (2, 5.0, 7.0, -1.0)], "id int, a double, b double, c double")
    long = U.unpivot_positive(wide, ["id"], ["a", "b", "c"])
    assert long.count() == 3
    tot = {r.id: float(r.s) for r in long.groupBy("id").agg(F.sum("amount").alias("s")).collect()}
    assert tot == {1: 10.0, 2: 12.0}


def test_top_n_keeps_ties_and_row_number_does_not(spark):
    df = spark.createDataFrame([("g", "a", 10.0), ("g", "b", 9.0), ("g", "c", 9.0), ("g", "d", 1.0)],
                               "g string, name string, v double")
    ranked = W.top_n_per_group(df, "g", "v", 2, salts=3)
    assert sorted(r.name for r in ranked.collect()) == ["a", "b", "c"]
    first = W.top_n_per_group(df, "g", "v", 2, ties=False, tie_break=["name"], salts=3)
    assert sorted(r.name for r in first.collect()) == ["a", "b"]


def test_pareto_ties_share_cumulative(spark):
    df = spark.createDataFrame([("a", 50.0), ("b", 25.0), ("c", 25.0)], "k string, v double")
    out = {r.k: r for r in W.pareto(df, "k", "v").collect()}
    assert out["b"].cumulative_pct == out["c"].cumulative_pct == 100.0
    assert out["b"].rank == out["c"].rank == 2
    row = {r.k: r.cumulative_pct for r in W.pareto_rowwise(df, "k", "v").collect()}
    assert row == {"a": 50.0, "b": 75.0, "c": 100.0}


def test_quantile_bins_equal_values_share_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 1, 1, 1, 1, 2, 3, 4, 5, 6]], "v double")
    bins = W.quantile_bins(df, "v", 4)
    per = {r.v: r.bin for r in bins.distinct().collect()}
    assert per[1.0] == 1 and per[6.0] == max(per.values())


def test_same_period_last_year_with_gaps(spark):
    import datetime as dt
    rows = [(dt.date(2000, 1, 15), 10.0), (dt.date(2001, 1, 3), 15.0), (dt.date(2001, 2, 3), 4.0),
            (dt.date(2003, 2, 1), 8.0)]
    df = spark.createDataFrame(rows, "d date, v double")
    m = W.month_series(df, "d", "v")
    out = {r.month_start: r.prior_year for r in W.same_period_last_year(m).collect()}
    assert out[dt.date(2001, 1, 1)] == 10.0
    assert out[dt.date(2001, 2, 1)] is None and out[dt.date(2003, 2, 1)] is None
    roll = {r.month_start: r.rolling_12m for r in W.rolling_months(m).collect()}
    assert roll[dt.date(2001, 2, 1)] == 19.0 and roll[dt.date(2001, 1, 1)] == 15.0  # Feb 2000..Jan 2001


def test_mode_smallest_on_ties(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", "a"), ("h", None)], "g string, v string")
    assert {r.g: r.mode for r in A.mode_by(df, "g", "v").collect()} == {"g": "a"}


def test_skewness_matches_adjusted_formula(spark):
    import numpy as np
    xs = [1.0, 2.0, 2.0, 3.0, 10.0, 4.0, 5.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = A.skewness(df, "x").first()[0]
    a = np.array(xs)
    n = len(a)
    m2, m3 = ((a - a.mean()) ** 2).mean(), ((a - a.mean()) ** 3).mean()
    assert abs(got - (m3 / m2 ** 1.5) * np.sqrt(n * (n - 1)) / (n - 2)) < 1e-9


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "x double")
    h = {r.bin: r["count"] for r in A.histogram(df, "x", 5).collect()}
    assert sum(h.values()) == 11 and h[4] == 3


def test_check_constraints(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id int, name string")
    fact = spark.createDataFrame([(1,), (7,), (None,)], "id int")
    spec = {"dim": {"primary_key": ["id"], "max_length": {"name": 0}},
            "fact": {"foreign_keys": [(["id"], "dim", ["id"])]}}
    out = {(r.table, r.check): r.violations for r in D.check_constraints({"dim": dim, "fact": fact}, spec).collect()}
    assert out[("dim", "primary_key_duplicates")] == 1
    assert out[("dim", "primary_key_nulls")] == 1
    assert out[("fact", "foreign_key_orphans:dim")] == 1
    assert out[("dim", "max_length:0")] == 3


def test_skewness_stable_under_large_offset(spark):
    """Money-sized values (1e9 + small spread): raw power sums cancel, central moments do not."""
    import numpy as np
    base = [1.0, 2.0, 2.0, 3.0, 10.0, 4.0, 5.0]
    df = spark.createDataFrame([(1e9 + x,) for x in base], "x double")
    a = np.array(base)
    n = len(a)
    m2, m3 = ((a - a.mean()) ** 2).mean(), ((a - a.mean()) ** 3).mean()
    want = (m3 / m2 ** 1.5) * np.sqrt(n * (n - 1)) / (n - 2)
    assert abs(A.skewness(df, "x").first()[0] - want) < 1e-6


def test_append_missing_has_the_columns_of_the_base(spark):
    base = spark.createDataFrame([(1, "a")], "k int, v string")
    other = spark.createDataFrame([(1, 9), (2, 9), (None, 9)], "k int, extra int")
    out = J.append_missing(base, other, "k")
    assert out.columns == ["k", "v"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, "a"), (2, None), (None, None)], key=repr)


def test_match_rate_is_a_share_of_the_reference(spark):
    from ledgerlens.operators import quality as Q
    rows = spark.createDataFrame([(True,), (False,), (True,), (None,)], "m boolean")
    r = Q.match_rate(rows, "m", spark.range(8)).first()
    assert (r.matched, r.reference_rows, r.match_pct) == (2, 8, 25.0)
    assert Q.match_rate(rows, "m", spark.range(0)).first().match_pct is None


def test_percent_below(spark):
    from ledgerlens.operators.windows import percent_below
    known = spark.createDataFrame([(float(v),) for v in [1, 2, 2, 3]] + [(None,)], "a double")
    asked = spark.createDataFrame([(0.5,), (2.0,), (2.5,), (9.0,), (None,)], "p double")
    got = {r.p: r.percentile for r in percent_below(asked, "p", known, "a").collect()}
    assert got == {0.5: 0.0, 2.0: 25.0, 2.5: 75.0, 9.0: 100.0, None: None}


def test_quantile_names_do_not_collide(spark):
    from ledgerlens.operators import aggregate as AG
    out = AG.quantiles(spark.range(1, 1002).selectExpr("CAST(id AS DOUBLE) AS x"), "x", [0.05, 0.5, 0.99, 0.991])
    assert out.columns == ["p05", "p50", "p99", "p99_1"] and tuple(out.first()) == (51.0, 501.0, 991.0, 992.0)


def test_top_n_spreads_equal_rows_of_a_hot_group(spark):
    from ledgerlens.operators.windows import top_n_per_group
    df = spark.range(500).selectExpr("'hot' AS g", "7 AS v")
    assert top_n_per_group(df, "g", "v", 20, salts=4, ties=False).count() == 20
