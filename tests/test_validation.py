"""Folds, searches, out-of-fold comparison, silhouette, bootstrap and split drift."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from ledgerlens.operators import cleaning as CL
from ledgerlens.operators import features as M
from ledgerlens.operators import models as ML
from ledgerlens.operators import stats as H
from ledgerlens.operators.evaluate import roc_auc
from ledgerlens.sources.files import read_csv, write_csv, write_raw_csv


def _rows(spark, n=300, seed=4):
    rng = random.Random(seed)
    rows = [(i, rng.gauss(0, 1), rng.choice("ab"), rng.randint(0, 5)) for i in range(n)]
    return spark.createDataFrame([(i, x, c, 2.0 * x + k + rng.gauss(0, 0.3), int(x + rng.gauss(0, 1) > 0.8))
                                  for i, x, c, k in rows], "id long, x double, c string, label double, cls int")


def test_stratified_folds_spread_every_class(spark):
    df = spark.createDataFrame([(i, None if i % 23 == 0 else "hot" if i % 3 else f"c{i % 4}") for i in range(700)], "id long, cls string")
    folds = M.stratified_folds(df, "cls", "id", 5)
    per = folds.groupBy("cls", "fold").count().groupBy("cls").agg(
        F.max("count").alias("hi"), F.min("count").alias("lo"), F.count("*").alias("n")).collect()
    assert all(r.hi - r.lo <= 1 and r.n == 5 for r in per)
    again = M.stratified_folds(df.repartition(9), "cls", "id", 5)
    assert sorted(map(tuple, folds.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)
    assert M.stratified_folds(df.limit(0), "cls", "id").count() == 0


def test_cross_validation_takes_stratified_folds(spark):
    df = _rows(spark).withColumn("label", F.col("cls").cast("double"))
    pipe = ML.pipeline([], ["x"], ML.weighted_classifier("logistic", weight="w"))
    _, mean, sd = ML.cross_validate(pipe, df.withColumn("w", F.lit(1.0)), "id", ML.auc_evaluator("label"), k=5, stratify="label")
    assert 0.6 < mean[0] < 1 and sd[0] < 0.2


def test_draw_of_a_grid_is_seeded_distinct_and_unbuilt():
    grid = {"a": [1, 2, 3], "b": list("wxyz"), "c": [0.1, 0.2, 0.3], "d": [1, 2, 3], "e": [4, 5, 6]}
    drawn = ML.draw_candidates(grid, 10, 7)
    assert len(drawn) == 10 == len({tuple(d.items()) for d in drawn})
    assert drawn == ML.draw_candidates(grid, 10, 7) != ML.draw_candidates(grid, 10, 8)
    assert all(d[k] in grid[k] for d in drawn for k in grid)
    every = ML.draw_candidates({"a": [1, 2], "b": "xy"}, 10)
    assert {tuple(d.values()) for d in every} == {(1, "x"), (1, "y"), (2, "x"), (2, "y")}
    assert len(ML.draw_candidates({k: range(10**6) for k in "abcdef"}, 3)) == 3  # 10^36 combinations


def test_random_search_judges_within_training_rows(spark):
    train, test = M.split(_rows(spark), "id", 0.25)

    def build(alpha, columns):
        return ML.pipeline([], columns, ML.linear_regressor("lasso", alpha))

    table, best = ML.random_search(build, {"alpha": [0.001, 5.0], "columns": [["x"]]}, train, "id", n=10, k=4)
    found = {r.parameters: r for r in table.collect()}
    assert len(found) == 2 and sum(r.is_best for r in found.values()) == 1
    assert [r.is_best for p, r in found.items() if "0.001" in p] == [True]
    assert all(r.folds == 4 for r in found.values()) and best.transform(test).count() == test.count()


def test_stages_that_candidates_share_are_fitted_once_per_fold(spark, monkeypatch):
    train = _rows(spark).withColumn("c", F.expr("CASE WHEN id = 7 THEN 'only one' WHEN id % 11 = 0 THEN NULL ELSE c END"))
    grid, shared = {"rounds": [1, 2], "rows": [0.8, 1.0]}, Pipeline(stages=M.encoder_stages(["c"], ["x"]))

    def boosted(rounds, rows):
        return ML.tree_regressor("gbt", maxIter=rounds, maxDepth=2, subsamplingRate=rows, featureSubsetStrategy="0.8")

    whole, own_best = ML.random_search(lambda **kw: ML.pipeline(["c"], ["x"], boosted(**kw)), grid, train, "id", k=3)
    fits, fit = [], StringIndexer._fit
    monkeypatch.setattr(StringIndexer, "_fit", lambda self, df: fits.append(1) or fit(self, df))
    table, best = ML.random_search(boosted, grid, train, "id", k=3, prepare=shared)
    assert len(fits) == 3 + 1  # not 4 candidates x 3 folds + 1
    for a, b in zip(table.orderBy("candidate").collect(), whole.orderBy("candidate").collect(), strict=True):
        assert (a.parameters, a.folds, a.is_best) == (b.parameters, b.folds, b.is_best)
        assert (a.cv_r2_mean, a.cv_r2_sd) == pytest.approx((b.cv_r2_mean, b.cv_r2_sd), rel=1e-12)
    found = [dict(m.transform(train).select("id", "prediction").collect()) for m in (best, own_best)]
    assert found[0] == pytest.approx(found[1], rel=1e-12) and len(found[0]) == 300


def test_out_of_fold_metrics_agree_with_sql(spark):
    df = _rows(spark).withColumn("fold", F.col("id") % 4)
    pipes = {"one": ML.pipeline([], ["x"], ML.linear_regressor("linear")), "two": ML.pipeline(["c"], ["x"], ML.linear_regressor("linear"))}
    oof = ML.out_of_fold(pipes, df, "id")
    assert oof.columns == ["id", "model", "fold", "label", "prediction"] and oof.count() == 600
    own = pipes["one"].fit(df.where("fold <> 2")).transform(df.where("fold = 2")).select("id", "prediction")
    same = oof.where("model = 'one' AND fold = 2").select("id", "prediction")
    assert dict(map(tuple, own.collect())) == pytest.approx(dict(map(tuple, same.collect())))
    table = oof.toPandas()  # noqa: F841 - read by the query below
    want = duckdb.sql("""
        WITH f AS (SELECT model, fold, 1 - sum((label - prediction)^2) / (count(*) * var_pop(label)) AS r2 FROM "table" GROUP BY ALL)
        SELECT model, avg(abs(label - prediction)), sqrt(avg((label - prediction)^2)), 1 - sum((label - prediction)^2) / (count(*) * var_pop(label)),
          (SELECT avg(r2) FROM f WHERE f.model = t.model), (SELECT stddev_pop(r2) FROM f WHERE f.model = t.model), 4
        FROM "table" t GROUP BY model ORDER BY model""").fetchall()
    got = sorted(map(tuple, ML.cv_regression_metrics(oof).collect()))
    for a, b in zip(got, want):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:])


def test_cv_auc_equals_the_curve_of_each_fold(spark):
    rng = random.Random(1)
    oof = spark.createDataFrame([(i, "m" if i % 2 else "k", i % 3, float(rng.random() < 0.4), rng.choice([0.1, 0.2, 0.5, 0.9]))
                                 for i in range(400)], "id long, model string, fold int, label double, score double")
    for r in ML.cv_auc(oof).collect():
        each = [roc_auc(oof.where((F.col("model") == r.model) & (F.col("fold") == f)), "label", "score").first()["auc"] for f in range(3)]
        assert r.cv_auc_mean == pytest.approx(np.mean(each)) and r.cv_auc_sd == pytest.approx(np.std(each)) and r.folds == 3


def test_silhouette_equals_brute_force_on_its_sample(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 1, (60, 2)), rng.normal(3, 1, (40, 2)), [[50.0, 50.0]]])
    c = [0] * 60 + [1] * 40 + [7]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame([(float(p), float(q), k) for (p, q), k in zip(x, c)], "a double, b double, prediction int"))
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    widths = []
    for i, k in enumerate(c):
        mine = [j for j in range(len(c)) if c[j] == k and j != i]
        other = min(np.mean([far[i, j] for j in range(len(c)) if c[j] == o]) for o in {0, 1, 7} - {k})
        inside = np.mean([far[i, j] for j in mine]) if mine else None
        widths.append(0 if inside is None else (other - inside) / max(other, inside))
    got = ML.silhouette(df).first()
    assert got.rows == 101 and got.silhouette == pytest.approx(np.mean(widths))
    assert ML.silhouette(df, rows=30).first().rows == 30
    assert ML.silhouette(df.where("prediction = 1")).first().silhouette is None


def _widths(x, c):
    """Silhouette of every row by brute force: all distances, cluster by cluster."""
    far = np.zeros((c.max() + 1, len(x)))
    for i in range(0, len(x), 500):
        apart = np.sqrt(((x[i:i + 500, None] - x[None]) ** 2).sum(axis=2))
        for k in range(len(far)):
            far[k, i:i + 500] = apart[:, c == k].sum(axis=1)
    size, row = np.bincount(c), np.arange(len(x))
    inside, means = far[c, row] / (size[c] - 1), far / size[:, None]
    means[c, row] = np.inf
    return (means.min(axis=0) - inside) / np.maximum(means.min(axis=0), inside)


def test_silhouette_meets_every_row(spark):
    """More than 8,000 rows, in several blocks: every row counts and meets every other."""
    rng = np.random.default_rng(3)
    c = rng.integers(0, 3, 11_000)
    x = rng.normal(0, 1, (11_000, 2)) + c[:, None] * [2.0, 0.5]
    rows = [(float(p), float(q), int(k)) for (p, q), k in zip(x, c)] + [(99.0, 99.0, None)]  # in no cluster
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, prediction int"))
    got = ML.silhouette(df).first()
    assert got.rows == 11_000 and got.silhouette == pytest.approx(_widths(x, c).mean(), rel=1e-12)


def test_choose_k_takes_the_silhouette_of_all_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (9_000, 2)) + rng.integers(0, 3, (9_000, 1)) * [3.0, 1.0]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame([(float(p), float(q)) for p, q in x], "a double, b double"))
    for r in ML.choose_k(df, [2, 3, 5], starts=1):
        placed = r["model"].transform(df).select("a", "b", "prediction").toPandas()
        widths = _widths(placed[["a", "b"]].to_numpy(), placed["prediction"].to_numpy())
        assert r["silhouette"] == pytest.approx(widths.mean(), rel=1e-12)


def test_bootstrap_of_the_median_follows_resampling(spark):
    rng = np.random.default_rng(0)
    for values in (np.exp(rng.normal(0, 1, 401)), np.round(rng.normal(0, 2, 400)), np.array([1.0, 2.0])):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
        got = H.bootstrap_median_ci(df, "v", replicates=4000)
        plain = np.median(rng.choice(values, (4000, len(values))), axis=1)
        spread = np.std(plain)
        assert got["n"] == len(values) and got["median"] == pytest.approx(np.median(values))
        for end, p in (("lo", 2.5), ("hi", 97.5)):
            assert abs(got[end] - np.percentile(plain, p)) <= 0.35 * spread + 1e-9
    assert H.bootstrap_median_ci(df.limit(0), "v")["lo"] is None
    assert H.bootstrap_median_ci(df, "v", seed=3) == H.bootstrap_median_ci(df, "v", seed=3)


def test_split_drift(spark):
    df = _rows(spark, 500)
    parts = M.stratified_split(df, "cls", "id", 0.2)
    assert max(r.drift for r in M.class_drift(parts, "cls").collect()) < 1 / 99
    loose = df.withColumn("is_test", F.col("x") > 1)
    gap = {r.feature: r.distance for r in M.numeric_drift(loose, ["x", "label"]).collect()}
    assert gap["x"] == 1.0 and 0.3 < gap["label"] < 1
    alone = M.class_drift(df.withColumn("is_test", F.col("cls") == 1), "cls").collect()
    assert all(r.drift == 1.0 for r in alone)


def test_code_table_in_both_directions(spark):
    lookup = spark.createDataFrame([("Austria", "AUT"), ("Chile", "CHL"), ("Korea", "KOR"), (None, "XXX")], "name string, code string")
    table = CL.code_table(lookup, "name", "code", {"Korea": "PRK", "Peru": "PER"})
    df = spark.createDataFrame([("Austria",), ("Korea",), ("Peru",), ("Atlantis",), ("Atlantis",), (None,)], "name string")
    coded = CL.map_by_table(df, "name", "code", table)
    assert sorted([tuple(r) for r in coded.collect()], key=repr) == sorted(
        [("Austria", "AUT"), ("Korea", "PRK"), ("Peru", "PER"), ("Atlantis", None), ("Atlantis", None), (None, None)], key=repr)
    assert [tuple(r) for r in CL.unmapped_codes(coded, "name", "code").collect()] == [("Atlantis", 2)]
    back = CL.map_by_table(coded.select("code"), "code", "name", table, reverse=True)
    assert {tuple(r) for r in back.where("code is not null").collect()} == {("AUT", "Austria"), ("PRK", "Korea"), ("PER", "Peru")}
    twice = CL.code_table(lookup, "name", "code", {"Chile": "AUT"})
    assert [tuple(r) for r in CL.code_conflicts(twice).collect()] == [("value", "AUT", 2)]
    with pytest.raises(ValueError, match="one to one"):
        CL.map_by_table(coded, "code", "name", twice, reverse=True)


def test_raw_csv_with_mark_in_every_file(spark, tmp_path):
    lines = spark.createDataFrame([(f'{i},"say ""{i}""\nnext"',) for i in range(50)], "line string").repartition(4)
    path = str(tmp_path / "raw")
    write_raw_csv(lines, path, " id ,note", mark=True)
    back = read_csv(spark, path, multi_line=True)
    assert back.columns == ["id", "note"]
    assert {tuple(r) for r in back.collect()} == {(str(i), f'say "{i}"\nnext') for i in range(50)}
    write_csv(back, str(tmp_path / "again"))
    assert {tuple(r) for r in read_csv(spark, str(tmp_path / "again"), multi_line=True).collect()} == {tuple(r) for r in back.collect()}


def test_collinear_and_perfect_fits(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float(i * i % 7), 3.0 + i) for i in range(40)], "a double, b double, c double, y double")
    with pytest.raises(ValueError, match=r"collinear columns: \['a', 'b'\]"):
        H.ols(df, "y", ["a", "b", "c"])
    with pytest.raises(ValueError, match="collinear"):
        H.vif(df, ["a", "b", "c"])
    with pytest.raises(ValueError, match="constant"):
        H.ols(df.withColumn("c", F.lit(1.0)), "y", ["a", "c"])
    fit = H.ols(df, "y", ["a"])
    assert fit["coef"] == pytest.approx([3, 1]) and all(t is None or math.isfinite(t) for t in fit["t"])
