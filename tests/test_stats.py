"""H-series against textbook values and closed forms (stat_small fixture)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import dist
from ledgerlens.operators import stats as H

# 3 groups, 12 rows, tied values, unequal sizes
STAT_SMALL = [("a", 1.0, True), ("a", 2.0, False), ("a", 2.0, True), ("a", 3.0, False),
              ("b", 2.0, True), ("b", 4.0, True), ("b", 4.0, False), ("b", 5.0, True), ("b", 6.0, False),
              ("c", 7.0, False), ("c", 8.0, True), ("c", 8.0, False)]


@pytest.fixture()
def small(spark):
    return spark.createDataFrame(STAT_SMALL, "g string, x double, f boolean")


def test_dist_table_values():
    assert abs(dist.norm_ppf(0.975) - 1.959964) < 1e-6
    assert abs(dist.t_ppf(0.975, 10) - 2.228139) < 1e-5
    assert abs(dist.t_two_sided(2.228139, 10) - 0.05) < 1e-5
    assert abs(dist.f_sf(3.354131, 2, 27) - 0.05) < 1e-5
    assert abs(dist.chi2_sf(3.841459, 1) - 0.05) < 1e-6
    assert abs(dist.chi2_sf(11.0705, 5) - 0.05) < 1e-5
    # studentized range upper 5% points (published tables)
    assert abs(dist.ptukey(3.877, 3, 10) - 0.95) < 2e-3
    assert abs(dist.ptukey(3.314, 3, math.inf) - 0.95) < 2e-3
    assert abs(dist.ptukey(4.232, 5, 20) - 0.95) < 2e-3


def test_welch_and_cohens_d(small):
    s = H.welch_t(small, "x", "f")
    x1 = np.array([r[1] for r in STAT_SMALL if r[2]])
    x0 = np.array([r[1] for r in STAT_SMALL if not r[2]])
    t = (x1.mean() - x0.mean()) / math.sqrt(x1.var(ddof=1) / len(x1) + x0.var(ddof=1) / len(x0))
    assert abs(s["t"] - t) < 1e-9
    pooled = math.sqrt(((len(x1) - 1) * x1.var(ddof=1) + (len(x0) - 1) * x0.var(ddof=1)) / (len(x1) + len(x0) - 2))
    assert abs(s["cohens_d"] - (x1.mean() - x0.mean()) / pooled) < 1e-9
    assert 0 < s["p"] <= 1


def test_anova_eta_and_f(small):
    s = H.anova(small, "g", "x", min_n=0)
    groups = {g: np.array([r[1] for r in STAT_SMALL if r[0] == g]) for g in "abc"}
    allx = np.concatenate(list(groups.values()))
    ssb = sum(len(v) * (v.mean() - allx.mean()) ** 2 for v in groups.values())
    ssw = sum(((v - v.mean()) ** 2).sum() for v in groups.values())
    f = (ssb / 2) / (ssw / 9)
    assert abs(s["f"] - f) < 1e-9 and abs(s["eta_squared"] - ssb / (ssb + ssw)) < 1e-9
    assert abs(s["p"] - dist.f_sf(f, 2, 9)) < 1e-12


def _avg_ranks(xs):
    order = sorted(xs)
    return {v: np.mean([i + 1 for i, w in enumerate(order) if w == v]) for v in set(xs)}


def test_kruskal_wallis_tie_corrected(small):
    s = H.kruskal_wallis(small, "g", "x")
    xs = [r[1] for r in STAT_SMALL]
    rk = _avg_ranks(xs)
    n = len(xs)
    h = 12 / (n * (n + 1)) * sum(
        sum(rk[r[1]] for r in STAT_SMALL if r[0] == g) ** 2 / sum(1 for r in STAT_SMALL if r[0] == g)
        for g in "abc") - 3 * (n + 1)
    ties = sum(xs.count(v) ** 3 - xs.count(v) for v in set(xs))
    assert abs(s["h"] - h / (1 - ties / (n ** 3 - n))) < 1e-9


def test_mann_whitney_u_equals_auc(small, spark):
    s = H.mann_whitney(small, "x", "f")
    x1 = [r[1] for r in STAT_SMALL if r[2]]
    x0 = [r[1] for r in STAT_SMALL if not r[2]]
    u = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in x1 for b in x0)
    assert abs(s["u"] - u) < 1e-9
    from ledgerlens.operators.evaluate import roc_auc
    auc = roc_auc(small.withColumn("y", F.col("f").cast("int")), "y", "x").first()["auc"]
    assert abs(auc - u / (len(x1) * len(x0))) < 1e-12


def test_chi_square_matches_full_table(small):
    s = H.chi_square(small, "g", "f")
    tab = {}
    for g, _, f in STAT_SMALL:
        tab[(g, f)] = tab.get((g, f), 0) + 1
    n = len(STAT_SMALL)
    rows = {g: sum(v for (a, _), v in tab.items() if a == g) for g in "abc"}
    cols = {f: sum(v for (_, b), v in tab.items() if b == f) for f in (True, False)}
    chi = sum((tab.get((g, f), 0) - rows[g] * cols[f] / n) ** 2 / (rows[g] * cols[f] / n) for g in rows for f in cols)
    assert abs(s["chi2"] - chi) < 1e-9 and s["dof"] == 2
    assert abs(s["cramers_v"] - math.sqrt(chi / n)) < 1e-9


def test_tukey_and_bonferroni(small):
    rows = H.tukey_hsd(small, "g", "x")
    assert len(rows) == 3
    ac = [r for r in rows if r["group_a"] == "a" and r["group_b"] == "c"][0]
    assert ac["reject"] and ac["diff"] > 0
    pw = H.pairwise_welch_bonferroni(small, "g", "x")
    assert all(r["p_bonferroni"] >= r["p"] for r in pw)


def test_ols_matches_numpy(spark):
    rng = np.random.default_rng(0)
    n = 200
    x1 = rng.normal(size=n)
    cat = rng.choice(["p", "q", "r"], size=n)
    y = 1.5 + 2.0 * x1 + np.where(cat == "q", 0.7, 0.0) + np.where(cat == "r", -0.4, 0.0) + rng.normal(0, 0.3, n)
    df = spark.createDataFrame([(float(a), str(c), float(b)) for a, c, b in zip(x1, cat, y)], "x1 double, c string, y double")
    fit = H.ols(df, "y", ["x1"], ["c"])
    X = np.column_stack([np.ones(n), x1, cat == "q", cat == "r"]).astype(float)
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    assert np.allclose(fit["coef"], beta, atol=1e-8)
    resid = y - X @ beta
    sigma2 = resid @ resid / (n - 4)
    se = np.sqrt(np.diag(np.linalg.inv(X.T @ X)) * sigma2)
    assert np.allclose(fit["se"], se, atol=1e-8)
    ml = H.ols_spark_ml(df, "y", ["x1"], ["c"]).stages[-1]
    assert abs(ml.summary.r2 - fit["r2"]) < 1e-8


def test_vif_identity_for_uncorrelated(spark):
    df = spark.createDataFrame([(1.0, 1.0), (-1.0, 1.0), (1.0, -1.0), (-1.0, -1.0)], "a double, b double")
    v = H.vif(df, ["a", "b"])
    assert abs(v["a"] - 1.0) < 1e-12 and abs(v["b"] - 1.0) < 1e-12


def test_jarque_bera_and_median_ci(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(size=2000)], "x double")
    r = H.normality(df, "x")
    assert r["jb_p"] > 0.001 and r["ks_p"] > 0.001
    m = H.median_ci(df, "x")
    assert m["lo"] < m["median"] < m["hi"]


def test_ols_stable_under_large_offsets(spark):
    """Money-sized y and x (offsets 1e9 / 1e6): slopes and R² equal the fit on
    centred data, which raw normal-equation sums would lose."""
    rng = np.random.default_rng(1)
    n = 300
    x1 = rng.normal(size=n)
    x2 = rng.normal(size=n)
    e = rng.normal(0, 0.5, n)
    y = 3.0 * x1 - 1.0 * x2 + e
    df = spark.createDataFrame([(float(a + 1e6), float(b + 1e6), float(c + 1e9)) for a, b, c in zip(x1, x2, y)],
                               "x1 double, x2 double, y double")
    fit = H.ols(df, "y", ["x1", "x2"])
    X = np.column_stack([np.ones(n), x1, x2])
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    r2 = 1 - resid @ resid / ((y - y.mean()) @ (y - y.mean()))
    assert np.allclose(fit["coef"][1:], beta[1:], atol=1e-6)
    assert abs(fit["r2"] - r2) < 1e-8


def test_tails_converge_at_any_size():
    import math

    from ledgerlens.operators import dist
    assert abs(dist.chi2_sf(1e6, 1e6) - 0.499812) < 1e-5 and abs(dist.chi2_sf(1e7, 1e7) - 0.499941) < 1e-5
    assert abs(dist.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-12
    assert abs(dist.t_two_sided(1.96, 1e13) - 2 * dist.norm_sf(1.96)) < 1e-9
    for t in (0.3, 1.96, 5.0):  # the series takes over from the beta without a step
        assert abs(dist.t_two_sided(t, 1000.0) - dist.t_two_sided(t, 1000.0001)) < 1e-9
    assert abs(dist.t_ppf(0.975, 10) - 2.228138851964939) < 1e-9 and abs(dist.t_ppf(0.975, 1) - 12.706204736432095) < 1e-7
    assert abs(dist.tukey_sf(3.5, 5, 4999) - dist.tukey_sf(3.5, 5, 5001)) < 1e-6
    assert abs(dist.tukey_sf(3.5, 5, 1e9) - dist.tukey_sf(3.5, 5, math.inf)) < 1e-6
    assert abs(dist.tukey_sf(3.877, 3, 10) - 0.05) < 1e-3  # table value
    assert abs(dist.f_sf(1.0, 1e6, 1e6) - 0.5) < 1e-9


def test_pairwise_tests_bound_their_groups(spark):
    import pytest
    df = spark.range(60).selectExpr("CAST(id % 6 AS STRING) AS g", "CAST(id * id % 17 AS DOUBLE) AS x")
    assert len(H.tukey_hsd(df, "g", "x")) == 15 and len(H.pairwise_welch_bonferroni(df, "g", "x")) == 15
    with pytest.raises(ValueError):
        H.tukey_hsd(df, "g", "x", max_groups=5)
    with pytest.raises(ValueError):
        H.design_levels(df, ["g"], max_levels=5)


def test_residuals_use_the_levels_of_the_fit(spark):
    rows = [(float(i), "abc"[i % 3], 2.0 * i + {"a": 0.0, "b": 5.0, "c": 9.0}["abc"[i % 3]]) for i in range(30)]
    df = spark.createDataFrame(rows, "x double, g string, y double")
    fit = H.ols(df, "y", ["x"], ["g"])
    part = H.residual_table(df.where("g <> 'a'"), "y", fit)  # lacks the reference level
    assert max(abs(r.residual) for r in part.collect()) < 1e-9
    new = spark.createDataFrame([(1.0, "z", 3.0)], df.schema)
    assert H.residual_table(new, "y", fit).first().fitted is None
