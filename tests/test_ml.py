"""Models, splits and explanations: properties rather than exact values."""

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.operators import explain as X
from ledgerlens.operators import features as M
from ledgerlens.operators import models as ML


def _data(spark, n=400):
    rng = np.random.default_rng(3)
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    cat = rng.choice(["u", "v"], size=n)
    y = 2 * x1 - x2 + (cat == "v") * 0.5 + rng.normal(0, 0.1, n)
    return spark.createDataFrame([(i, float(a), float(b), str(c), float(t)) for i, (a, b, c, t)
                                  in enumerate(zip(x1, x2, cat, y))], "id long, x1 double, x2 double, c string, label double")


def test_hash_split_is_stable(spark):
    df = _data(spark)
    tr1, te1 = M.split(df, "id", 0.2)
    tr2, te2 = M.split(df.repartition(7), "id", 0.2)
    assert sorted(r.id for r in te1.collect()) == sorted(r.id for r in te2.collect())
    assert tr1.count() + te1.count() == 400


def test_stratified_split_exact(spark):
    df = _data(spark).withColumn("cls", (F.col("id") % 5 == 0).cast("int"))
    s = M.stratified_split(df, "cls", "id", 0.25)
    got = {(r.cls, r.is_test): r.n for r in M.split_sizes(s, "is_test", "cls").collect()}
    assert got[(1, True)] == 20 and got[(0, True)] == 80


def test_unseen_category_encodes_to_zeros(spark):
    from pyspark.ml import Pipeline
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, x double")
    test = spark.createDataFrame([("z", 3.0)], "c string, x double")
    m = Pipeline(stages=M.encoder_stages(["c"], ["x"])).fit(train)
    v = m.transform(test).first().features.toArray()
    assert list(v[1:]) == [0.0] * (len(v) - 1)


def test_linear_fit_and_shapley_additivity(spark):
    df = _data(spark)
    m = ML.pipeline(["c"], ["x1", "x2"], ML.linear_regressor("linear")).fit(df)
    coef = m.stages[-1].coefficients.toArray()
    assert abs(coef[0] - 2) < 0.05 and abs(coef[1] + 1) < 0.05
    explain = df.where(F.col("id") < 5)
    phi = X.sampled_shapley(m, explain, df, ["x1", "x2"], "id", samples=64)
    base = X.expected_output(m, df.select("x1", "x2", "c", "id"))
    # efficiency: Σφ telescopes to f(x) − mean f(sampled backgrounds); against the
    # global base the gap is the sampling error of that mean, ~ sd(f) / sqrt(M)
    sd = m.transform(df).agg(F.stddev_pop("prediction")).first()[0]
    sums = {r.id: r.s for r in phi.groupBy("id").agg(F.sum("phi").alias("s")).collect()}
    preds = {r.id: r.prediction for r in m.transform(explain).collect()}
    for k in preds:
        assert abs(base + sums[k] - preds[k]) < 4 * sd / 8
    top = X.global_attribution(phi, 1).first()
    assert top.feature == "x1"


def test_permutation_importance_and_pd(spark):
    df = _data(spark)
    m = ML.pipeline(["c"], ["x1", "x2"], ML.linear_regressor("linear")).fit(df)
    imp = {r.feature: r.importance_mean for r in
           X.permutation_importance(m, df, ["x1", "x2"], "id", repeats=2).collect()}
    assert imp["x1"] > imp["x2"] > 0
    pd_ = X.partial_dependence(m, df, "x1", [0.0, 1.0]).orderBy("grid_value").collect()
    assert abs((pd_[1].average_output - pd_[0].average_output) - 2.0) < 0.05


def test_kmeans_choose_k(spark):
    df = ML.cluster_features(_data(spark), ["x1", "x2"])
    res = ML.choose_k(df, [2, 3], starts=2)
    assert [r["k"] for r in res] == [2, 3] and res[1]["inertia"] <= res[0]["inertia"]


def test_shapley_uses_all_of_a_large_background(spark):
    """More than 10,000 background rows: each can be drawn, and a bound is the caller's."""
    df = spark.range(12_000).selectExpr("id", "CAST(id AS DOUBLE) AS x1", "CAST(0 AS DOUBLE) AS x2", "'a' AS c",
                                        "CAST(id AS DOUBLE) AS label")
    m = ML.pipeline([], ["x1", "x2"], ML.linear_regressor("linear")).fit(df.where("id < 200"))
    explain = df.where("id >= 11000 and id < 11400")
    whole = X.sampled_shapley(m, explain, df, ["x1", "x2"], "id", samples=16)
    mean = whole.where("feature = 'x1'").agg(F.avg("phi")).first()[0]
    assert abs(mean - (11_200 - 6_000)) < 300  # against the mean of all 12,000 rows
    few = X.sampled_shapley(m, explain, df, ["x1", "x2"], "id", samples=4, background_rows=10)
    assert few.count() == 800


def _broadcast_after_explode(df):
    """Whether the plan broadcasts rows that an explode has multiplied."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = next((j for j in range(i + 1, len(lines)) if depth(lines[j]) <= depth(line)), len(lines))
            if any("Generate " in x for x in lines[i + 1:below]):
                return True
    return False


def test_shapley_does_not_broadcast_its_samples(spark, tmpdir_unique):
    df = _data(spark)
    df.where("id < 40").write.parquet(f"{tmpdir_unique}/explain")
    m = ML.pipeline(["c"], ["x1", "x2"], ML.linear_regressor("linear")).fit(df)
    phi = X.sampled_shapley(m, spark.read.parquet(f"{tmpdir_unique}/explain"), df, ["x1", "x2"], "id", samples=4)
    assert not _broadcast_after_explode(phi)
    assert phi.columns == ["id", "feature", "phi"] and phi.count() == 80


def test_shapley_of_a_line_is_coefficient_times_distance(spark):
    """For a line every order of the features gives a·(x − b), so φ is that over the one background row."""
    df = _data(spark)
    m = ML.pipeline([], ["x1", "x2"], ML.linear_regressor("linear")).fit(df)
    a = dict(zip(["x1", "x2"], m.stages[-1].coefficients))
    b = df.where("id = 0").first()
    explain = df.where("id < 5")
    rows = {r.id: r for r in explain.collect()}
    for r in X.sampled_shapley(m, explain, df.where("id = 0"), ["x1", "x2"], "id", samples=3).collect():
        assert abs(r.phi - a[r.feature] * (rows[r.id][r.feature] - b[r.feature])) < 1e-9


def test_forest_keeps_its_nodes_and_stays_the_same_forest(spark):
    df = _data(spark)
    est = ML.tree_regressor("forest", numTrees=7, maxDepth=6)
    assert est.getCacheNodeIds() and ML.weighted_classifier("forest").getCacheNodeIds()
    kept, walked = (ML.pipeline(["c"], ["x1", "x2"], ML.tree_regressor("forest", numTrees=7, maxDepth=6, cacheNodeIds=keep)).fit(df)
                    for keep in (True, False))
    assert kept.stages[-1].toDebugString.split("\n")[1:] == walked.stages[-1].toDebugString.split("\n")[1:]


def test_kmeans_holds_its_vectors_itself(spark, monkeypatch):
    """Spark's K-means keeps its vectors in memory only for a table that is not cached."""
    seen, fit = [], ML.KMeans.fit
    monkeypatch.setattr(ML.KMeans, "fit", lambda self, df, *a: (seen.append(df.storageLevel), fit(self, df, *a))[1])
    res = ML.choose_k(ML.cluster_features(_data(spark), ["x1", "x2"]), [2, 3], starts=2)
    assert len(seen) == 4 and not any(level.useMemory or level.useDisk for level in seen)
    assert all(0 < r["silhouette"] < 1 for r in res)
