"""Distributed global order helpers: exact, consistent, skew-safe."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.operators.ordering import (global_row_number, group_quantiles, ntile_of_position,
                                           running_totals)


def _skewed(spark, n=3000):
    # one key holds a third of all rows (hot group)
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 17).cast("string")))
        .alias("g"), ((F.col("id") * 7919) % 1013).cast("double").alias("v"), "id")


def test_row_number_unique_and_ordered(spark):
    df = _skewed(spark)
    n = global_row_number(df, ["v", "id"], "rn", num_partitions=7)
    r = n.agg(F.count("*").alias("c"), F.count_distinct("rn").alias("d"), F.min("rn").alias("lo"),
              F.max("rn").alias("hi")).first()
    assert (r.c, r.d, r.lo, r.hi) == (3000, 3000, 1, 3000)
    ref = df.withColumn("rn2", F.row_number().over(Window.orderBy("v", "id")))
    assert n.join(ref, "id").where(F.col("rn") != F.col("rn2")).count() == 0


def test_group_quantiles_match_percentile_on_hot_group(spark):
    df = _skewed(spark)
    q = group_quantiles(df, ["g"], "v", {"p25": 0.25, "med": 0.5, "p90": 0.9}, num_partitions=6)
    ref = df.groupBy("g").agg(F.percentile("v", 0.25).alias("a"), F.median("v").alias("b"),
                              F.percentile("v", 0.9).alias("c"))
    j = q.join(ref, "g").collect()
    assert len(j) == 18
    for r in j:
        assert abs(r.p25 - r.a) < 1e-9 and abs(r.med - r.b) < 1e-9 and abs(r.p90 - r.c) < 1e-9


def test_running_totals(spark):
    df = spark.range(1, 501).select(F.col("id").alias("k"), (F.col("id") % 3).alias("x"))
    out = running_totals(df, ["k"], ["x"], num_partitions=5)
    ref = df.withColumn("c", F.sum("x").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))
    assert out.join(ref, "k").where(F.col("cum_x") != F.col("c")).count() == 0


def test_ntile_formula_matches_sql(spark):
    for n in [1, 9, 10, 11, 23, 100, 101]:
        df = spark.range(1, n + 1).select(F.col("id").alias("pos"))
        got = df.select("pos", ntile_of_position(F.col("pos"), F.lit(n), 10).alias("b"))
        ref = df.select("pos", F.ntile(10).over(Window.orderBy("pos")).alias("b2"))
        assert got.join(ref, "pos").where(F.col("b") != F.col("b2")).count() == 0


def test_equal_values_are_counted_before_the_shuffle(spark):
    """A third of all values are equal: exact quantiles, and the hot value is one row after map-side counting."""
    df = spark.range(3000).select(F.lit("g").alias("g"), F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id").cast("double")).alias("v"))
    got = group_quantiles(df, ["g"], "v", {"p33": 0.33, "m": 0.5}, num_partitions=6).first()
    ref = df.agg(F.percentile("v", 0.33), F.median("v")).first()
    assert abs(got.p33 - ref[0]) < 1e-9 and abs(got.m - ref[1]) < 1e-9


def test_running_totals_types_and_nulls(spark):
    from decimal import Decimal
    rows = [(i, None if i < 3 or i % 7 == 0 else Decimal(i) / 4, None if i % 5 == 0 else i, i / 3) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, d decimal(18,2), n long, f double")
    out = running_totals(df, ["k"], ["d", "n", "f"], num_partitions=5)
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("k", *[F.sum(c).over(w).alias("r_" + c) for c in "dnf"])
    assert [out.schema["cum_" + c].dataType for c in "dnf"] == [ref.schema["r_" + c].dataType for c in "dnf"]
    for r in out.join(ref, "k").collect():
        assert (r.cum_d, r.cum_n) == (r.r_d, r.r_n) and abs(r.cum_f - r.r_f) < 1e-6


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert group_quantiles(df, ["g"], "v", {"m": 0.5}).count() == 0
    assert group_quantiles(df, [], "v", {"m": 0.5}).collect()[0].m is None
    assert global_row_number(df, ["v"]).count() == 0 and running_totals(df, ["v"], ["v"]).count() == 0


@pytest.mark.parametrize("dense", [False, True])
def test_global_ranks_distributed_matches_sql_rank(spark, dense):
    """Ties, a hot value holding a third of the
    rows, and nulls (ranked last) agree with Spark's single-window rank."""
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from ledgerlens.operators.windows import global_ranks
    rnd = random.Random(3)
    rows = [(i, 5 if i % 3 == 0 else (None if i % 17 == 0 else rnd.randint(0, 40)), rnd.randint(0, 3))
            for i in range(900)]
    df = spark.createDataFrame(rows, "k int, v int, w int")
    got = {r.k: (r.rv, r.rw) for r in global_ranks(df, {"rv": "v", "rw": "w"}, dense=dense).collect()}
    fn = F.dense_rank if dense else F.rank
    ref = df.select("k", fn().over(Window.orderBy(F.col("v").desc())).alias("rv"),
                    fn().over(Window.orderBy(F.col("w").desc())).alias("rw"))
    assert got == {r.k: (r.rv, r.rw) for r in ref.collect()}


def test_top_n_share_ties_and_head(spark):
    from ledgerlens.operators.windows import top_n_share
    rows = [("a", 10.0), ("b", 7.0), ("c", 7.0), ("c", 0.0), ("d", 7.0), ("e", 1.0), ("f", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    grand = 10 + 7 + 7 + 7 + 1
    # TOPN(2): a (rank 1) and the three-way tie at rank 2
    assert abs(top_n_share(df, "k", "v", 2).first()[0] - 31 / grand) < 1e-12
    # head(2) with key tie-break: a, b
    assert abs(top_n_share(df, "k", "v", 2, ties=False).first()[0] - 17 / grand) < 1e-12
    assert abs(top_n_share(df, "k", "v", 50).first()[0] - 1.0) < 1e-12


@pytest.mark.parametrize("num_partitions", [None, 1, 13])
def test_global_rank_and_shared_running_sum_with_hot_values(spark, num_partitions):
    """A third of all values are equal, others tie, some are null: rank, dense rank and the
    cumulative sum agree with one window over all rows."""
    from ledgerlens.operators.ordering import global_rank
    rows = [(i, None if i % 19 == 0 else 5.0 if i % 3 == 0 else float((i * 7919) % 41)) for i in range(1500)]
    df = spark.createDataFrame(rows, "k int, v double").selectExpr("k", "cast(v as decimal(18,2)) AS v").repartition(6)
    w = Window.orderBy(F.col("v").desc_nulls_last())
    ref = df.select("k", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"), F.sum("v").over(w).alias("c"))
    want = {x.k: (x.r, x.d, x.c) for x in ref.collect()}
    plain = global_rank(df, "v", "r", cumulative="c", num_partitions=num_partitions)
    assert plain.columns == ["k", "v", "r", "c"]
    assert {x.k: (x.r, x.c) for x in plain.collect()} == {k: (r, c) for k, (r, _, c) in want.items()}
    dense = global_rank(df, "v", "d", dense=True, num_partitions=num_partitions)
    assert {x.k: x.d for x in dense.collect()} == {k: d for k, (_, d, _) in want.items()}


def test_global_rank_of_one_value_and_of_nothing(spark):
    from ledgerlens.operators.ordering import global_rank
    same = spark.range(400).select("id", F.lit(2).alias("v"))
    got = global_rank(same, "v", "r", cumulative="c", num_partitions=9).select("r", "c").distinct().collect()
    assert [tuple(r) for r in got] == [(1, 800)]
    nulls = same.withColumn("v", F.lit(None).cast("int"))
    assert [tuple(r) for r in global_rank(nulls, "v", "r", cumulative="c").select("r", "c").distinct().collect()] == [(1, None)]
    assert global_rank(same.limit(0), "v", "r").count() == 0


def test_rows_of_a_hot_value_stay_apart(spark):
    """No range partition of the ranked rows is above twice its fair share although a third of the values are equal."""
    from ledgerlens.operators import ordering
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"))
    placed = ordering._windowed(df.withColumn("s", F.xxhash64("id")), [F.col("v").desc(), "s"], lambda w: {}, 6)
    sizes = [r["count"] for r in placed.groupBy("__pid").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * 9000 / 6


def test_labels_send_each_partition_to_a_task_of_its_own(spark):
    from ledgerlens.operators.ordering import _labels
    for tasks in (1, 4, 37):
        labels = _labels(spark, 2 * tasks, tasks)
        assert len(set(labels)) == 2 * tasks
        at = [r[0] for r in spark.createDataFrame([(x,) for x in labels[:tasks]], "x int").select(
            F.pmod(F.hash("x"), F.lit(tasks))).collect()]
        assert sorted(at) == list(range(tasks))


def test_lag_and_cumulative_over_callers_order_use_no_single_task(spark):
    from ledgerlens.operators.windows import cumulative, pct_change
    rows = [(i, None if i % 11 == 5 else float(i % 7)) for i in range(700)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(5)
    w = Window.orderBy("k")
    lag = df.select("k", F.lag("v").over(w).alias("p"), F.sum("v").over(w).alias("c"))
    want = {r.k: (r.p, r.c) for r in lag.collect()}
    vs = dict(rows)
    got = {r.k: r.pct_change for r in pct_change(df, "k", "v").collect()}
    for k, (p, _) in want.items():
        assert got[k] == (None if p in (None, 0.0) or vs[k] is None else pytest.approx((vs[k] - p) / p))
    run = cumulative(df, "k", "v")
    assert {r.k: r.cumulative for r in run.collect()} == {k: c for k, (_, c) in want.items()}
    for out in (pct_change(df, "k", "v"), run):
        leaf = out._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in leaf or "__pid" in leaf  # only the offsets, one row per partition, are ordered in one task
