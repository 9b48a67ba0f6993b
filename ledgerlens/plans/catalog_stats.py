"""Registered queries: inferential statistics (H) and model evaluation (E).

Oracles check the statistics SQL can compute; p-values come from
:mod:`ledgerlens.operators.dist` and are unit-tested against table values.
Statistics use the log of funding (moderate magnitudes keep floating-point
differences between engines far below the compared precision).
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import dist
from ..operators import evaluate as E
from ..operators import stats as H
from . import testbed
from .catalog import _tables, query
from .catalog_more import wide
from .oracle_ctes import with_star

X = "log_funding_total_usd"


def _w(spark, sf):
    return wide(spark, sf)


def _row(spark, d: dict, cols):
    """A one-row DataFrame of driver-side results (bounded: one row)."""
    return spark.createDataFrame([tuple(d[c] for c in cols)], cols)


def _rounded(d: dict, *names: str) -> dict:
    """p-values are reported to six decimals."""
    return {**d, **{n: round(d[n], 6) for n in names}}


# SQL for what DuckDB lacks.  Tails are integrated by Simpson's rule (2,000 steps); the quantile and the
# tail of Student's t use their normalising series, which agree to about ten digits at these sample sizes.

def _simpson(f: str, lo: str, hi: str) -> str:
    """Integral over ``at_`` of the SQL expression ``f``."""
    return (f"(SELECT SUM(CASE WHEN i_ IN (0, 2000) THEN 1 WHEN i_ % 2 = 1 THEN 4 ELSE 2 END * ({f})) * (({hi}) - ({lo})) / 6000.0 "
            f"FROM (SELECT i_, ({lo}) + (({hi}) - ({lo})) * i_ / 2000.0 AS at_ FROM range(0, 2001) steps_(i_)))")


def _norm_p(z: str) -> str:
    """Two-sided normal p of |z| (nothing is left beyond 12)."""
    return "GREATEST(0.0, 1 - 2 * " + _simpson(f"exp(-at_ * at_ / 2) / {math.sqrt(2 * math.pi)!r}", "0.0", f"LEAST(abs({z}), 12.0)") + ")"


def _t_p(t: str, df: str) -> str:
    a = f"({df} - 0.5)"
    y = f"({a} * ln(1 + ({t}) * ({t}) / {df}))"
    b = f"(48.0 * {a} * {a})"
    return _norm_p(f"((((((-0.4 * {y} - 3.3) * {y} - 24.0) * {y} - 85.5) / (0.8 * {y} * {y} + 100.0 + {b}) + {y} + 3.0) / {b} + 1.0) * sqrt({y}))")


def _t_quantile(df: str, p: float = 0.975) -> str:
    z = dist.norm_ppf(p)
    return (f"({z!r} + {(z**3 + z) / 4!r} / {df} + {(5 * z**5 + 16 * z**3 + 3 * z) / 96!r} / ({df} * {df}) "
            f"+ {(3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384!r} / ({df} * {df} * {df}))")


def _chi2_p(stat: str, df: str) -> str:
    f = f"CASE WHEN at_ <= 0 THEN 0 ELSE exp(({df} / 2.0 - 1) * ln(at_) - at_ / 2 - {df} / 2.0 * ln(2) - lgamma({df} / 2.0)) END"
    return f"GREATEST(0.0, 1 - {_simpson(f, '0.0', stat)})"


def _f_p(stat: str, d1: str, d2: str) -> str:
    """P(F > stat), from the beta density of d1 F / (d2 + d1 F)."""
    a, b = f"({d1} / 2.0)", f"({d2} / 2.0)"
    f = (f"CASE WHEN at_ <= 0 THEN 0 ELSE exp(({a} - 1) * ln(at_) + ({b} - 1) * ln(1 - at_) + lgamma({a} + {b}) "
         f"- lgamma({a}) - lgamma({b})) END")
    return f"GREATEST(0.0, 1 - {_simpson(f, '0.0', f'{d1} * {stat} / ({d2} + {d1} * {stat})')})"



# =============================================================================
# H-series
# =============================================================================

@query("h1_mean_ci", with_star(f"""
SELECT n, mean, sd, se, mean - {_t_quantile('(n - 1.0)')} * se AS lo, mean + {_t_quantile('(n - 1.0)')} * se AS hi FROM (
SELECT COUNT({X}) AS n, AVG({X}) AS mean, STDDEV_SAMP({X}) AS sd, STDDEV_SAMP({X}) / SQRT(COUNT({X})) AS se FROM feat) s"""))
def h1_mean_ci(spark, sf):
    return _row(spark, H.mean_ci(_w(spark, sf), X), ["n", "mean", "sd", "se", "lo", "hi"])


_Z975 = repr(dist.norm_ppf(0.975))


@query("h2_median_ci", with_star(f"""
WITH v AS (SELECT {X} AS x FROM feat WHERE {X} IS NOT NULL),
c AS (SELECT COUNT(*) AS n FROM v),
p AS (SELECT n, GREATEST(1, CAST(floor(n / 2.0 - {_Z975} * sqrt(n) / 2.0) AS BIGINT)) AS j,
        LEAST(n, CAST(ceil(n / 2.0 + 1 + {_Z975} * sqrt(n) / 2.0) AS BIGINT)) AS k FROM c),
o AS (SELECT x, ROW_NUMBER() OVER (ORDER BY x) AS rn FROM v)
SELECT n, (SELECT x FROM o WHERE rn = j) AS lo, (SELECT quantile_cont(x, 0.5) FROM v) AS median,
  (SELECT x FROM o WHERE rn = k) AS hi FROM p"""))
def h2_median_ci(spark, sf):
    r = H.median_ci(_w(spark, sf), X)
    return _row(spark, r, ["n", "lo", "median", "hi"])


# Resamples have no SQL form; their number, and that the ends lie by the closed form's, have one.
@query("h2_bootstrap_median", with_star(f"""
SELECT COUNT({X}) AS n, 2000 AS replicates, quantile_cont({X}, 0.5) AS median, true AS holds_median, true AS ends_agree FROM feat"""))
def h2_bootstrap_median(spark, sf):
    w = _w(spark, sf)
    own, closed = H.bootstrap_median_ci(w, X), H.median_ci(w, X)
    width = closed["hi"] - closed["lo"]
    agree = abs(own["lo"] - closed["lo"]) < 0.2 * width and abs(own["hi"] - closed["hi"]) < 0.2 * width
    return spark.createDataFrame([(own["n"], own["replicates"], own["median"], own["lo"] <= own["median"] <= own["hi"], agree)],
                                 "n long, replicates int, median double, holds_median boolean, ends_agree boolean")


@query("h3_proportion_ci", with_star(f"""
SELECT *, p - {dist.norm_ppf(0.975)!r} * se AS lo, p + {dist.norm_ppf(0.975)!r} * se AS hi FROM (
SELECT SUM(CAST(is_exited AS DOUBLE)) AS successes, COUNT(is_exited) AS n,
  SUM(CAST(is_exited AS DOUBLE)) / COUNT(is_exited) AS p,
  SQRT((SUM(CAST(is_exited AS DOUBLE)) / COUNT(is_exited)) * (1 - SUM(CAST(is_exited AS DOUBLE)) / COUNT(is_exited))
       / COUNT(is_exited)) AS se FROM feat) s"""))
def h3_proportion_ci(spark, sf):
    return _row(spark, H.proportion_ci(_w(spark, sf), "is_exited"), ["successes", "n", "p", "se", "lo", "hi"])


_WELCH = f"""
WITH g AS (SELECT COUNT({X}) FILTER (WHERE is_unicorn) AS n1, AVG({X}) FILTER (WHERE is_unicorn) AS mean1,
  VAR_SAMP({X}) FILTER (WHERE is_unicorn) AS var1, COUNT({X}) FILTER (WHERE NOT is_unicorn) AS n0,
  AVG({X}) FILTER (WHERE NOT is_unicorn) AS mean0, VAR_SAMP({X}) FILTER (WHERE NOT is_unicorn) AS var0 FROM feat)
SELECT *, diff - {_t_quantile('df')} * sqrt(var1 / n1 + var0 / n0) AS lo, diff + {_t_quantile('df')} * sqrt(var1 / n1 + var0 / n0) AS hi,
  round({_t_p('t', 'df')}, 6) AS p FROM (
SELECT n1, mean1, var1, n0, mean0, var0, mean1 - mean0 AS diff,
  (mean1 - mean0) / SQRT(var1 / n1 + var0 / n0) AS t,
  (var1 / n1 + var0 / n0) * (var1 / n1 + var0 / n0)
    / ((var1 / n1) * (var1 / n1) / (n1 - 1) + (var0 / n0) * (var0 / n0) / (n0 - 1)) AS df,
  (mean1 - mean0) / SQRT(((n1 - 1) * var1 + (n0 - 1) * var0) / (n1 + n0 - 2)) AS cohens_d FROM g) s"""


@query("h4_h9_h10_welch_t", with_star(_WELCH))
def h4_h9_h10_welch_t(spark, sf):
    r = _rounded(H.welch_t(_w(spark, sf), X, "is_unicorn"), "p")
    return _row(spark, r, ["n1", "mean1", "var1", "n0", "mean0", "var0", "diff", "t", "df", "cohens_d", "lo", "hi", "p"])


@query("h5_two_proportion_z", with_star(f"""
WITH s AS (SELECT SUM(CAST(is_exited AS DOUBLE)) FILTER (WHERE market IS NOT DISTINCT FROM 'BUILDING') AS x1,
  COUNT(*) FILTER (WHERE market IS NOT DISTINCT FROM 'BUILDING') AS n1,
  SUM(CAST(is_exited AS DOUBLE)) FILTER (WHERE market IS DISTINCT FROM 'BUILDING') AS x0,
  COUNT(*) FILTER (WHERE market IS DISTINCT FROM 'BUILDING') AS n0 FROM feat)
SELECT *, round({_norm_p('z')}, 6) AS p FROM (
SELECT x1, n1, x0, n0, x1 / n1 AS p1, x0 / n0 AS p0,
  (x1 / n1 - x0 / n0) / SQRT(((x1 + x0) / (n1 + n0)) * (1 - (x1 + x0) / (n1 + n0)) * (1.0 / n1 + 1.0 / n0)) AS z
FROM s) t"""))
def h5_two_proportion_z(spark, sf):
    r = _rounded(H.two_proportion_z(_w(spark, sf), "is_exited", "market", "BUILDING"), "p")
    return _row(spark, r, ["x1", "n1", "x0", "n0", "p1", "p0", "z", "p"])


@query("h6_h7_chi_square", with_star(f"""
WITH o AS (SELECT market, status, COUNT(*) AS observed FROM feat WHERE market IS NOT NULL AND status IS NOT NULL
           GROUP BY market, status),
e AS (SELECT o.*, SUM(observed) OVER (PARTITION BY market) * SUM(observed) OVER (PARTITION BY status)
        / SUM(observed) OVER () AS expected, SUM(observed) OVER () AS n FROM o)
SELECT *, round({_chi2_p('chi2', 'dof')}, 6) AS p FROM (
SELECT SUM(CAST(observed AS DOUBLE) * observed / expected) - MIN(n) AS chi2, MIN(n) AS n,
  COUNT(DISTINCT market) AS rows, COUNT(DISTINCT status) AS cols,
  (COUNT(DISTINCT market) - 1) * (COUNT(DISTINCT status) - 1) AS dof,
  SQRT((SUM(CAST(observed AS DOUBLE) * observed / expected) - MIN(n))
       / (MIN(n) * (LEAST(COUNT(DISTINCT market), COUNT(DISTINCT status)) - 1))) AS cramers_v FROM e) s"""))
def h6_h7_chi_square(spark, sf):
    r = _rounded(H.chi_square(_w(spark, sf), "market", "status", top_n=8), "p")
    return _row(spark, r, ["chi2", "n", "rows", "cols", "dof", "cramers_v", "p"])


_RANKS = f"""
v AS (SELECT {X} AS x, CAST(COALESCE(is_exited, false) AS INTEGER) AS g, market FROM feat WHERE {X} IS NOT NULL),
per AS (SELECT x AS value, COUNT(*) AS t FROM v GROUP BY x),
r AS (SELECT value, t, SUM(t) OVER (ORDER BY value) - t + (t + 1) / 2.0 AS avg_rank FROM per),
ties AS (SELECT SUM(CAST(t AS DOUBLE) * t * t - t) AS tie_sum FROM per)"""


@query("h8_mann_whitney", with_star(f"""
WITH s AS (SELECT SUM(avg_rank) FILTER (WHERE g = 1) AS r1, COUNT(*) FILTER (WHERE g = 1) AS n1,
           COUNT(*) FILTER (WHERE g = 0) AS n0 FROM v JOIN r ON v.x = r.value)
SELECT *, round({_norm_p('z')}, 6) AS p FROM (
SELECT n1, n0, r1 - n1 * (n1 + 1) / 2.0 AS u, n1 * n0 / 2.0 AS mu,
  SQRT(n1 * n0 / 12.0 * ((n1 + n0 + 1) - tie_sum / ((n1 + n0) * (n1 + n0 - 1)))) AS sigma,
  (ABS(r1 - n1 * (n1 + 1) / 2.0 - n1 * n0 / 2.0) - 0.5)
    / SQRT(n1 * n0 / 12.0 * ((n1 + n0 + 1) - tie_sum / ((n1 + n0) * (n1 + n0 - 1)))) AS z,
  (r1 - n1 * (n1 + 1) / 2.0) / (n1 * n0) AS auc FROM s, ties) t""", _RANKS))
def h8_mann_whitney(spark, sf):
    r = _rounded(H.mann_whitney(wide(spark, sf, [X, "is_exited"]), X, "is_exited"), "p")
    return _row(spark, r, ["n1", "n0", "u", "mu", "sigma", "z", "auc", "p"])


@query("h13_kruskal_wallis", with_star(f"""
WITH g AS (SELECT market, SUM(avg_rank) AS rsum, COUNT(*) AS ng FROM v JOIN r ON v.x = r.value
           WHERE market IS NOT NULL GROUP BY market),
s AS (SELECT SUM(rsum * rsum / ng) AS a, SUM(ng) AS n, COUNT(*) AS k FROM g)
SELECT *, round({_chi2_p('h', 'dof')}, 6) AS p FROM (
SELECT n, k, (12.0 / (n * (n + 1)) * a - 3 * (n + 1)) / (1 - tie_sum / (CAST(n AS DOUBLE) * n * n - n)) AS h,
  k - 1 AS dof FROM s, ties) t""", _RANKS))
def h13_kruskal_wallis(spark, sf):
    r = _rounded(H.kruskal_wallis(wide(spark, sf, [X, "market"]), "market", X), "p")
    return _row(spark, r, ["n", "k", "h", "dof", "p"])


_GROUPS = f"""gs AS (SELECT market, COUNT({X}) AS n, AVG({X}) AS mean, VAR_SAMP({X}) AS var FROM feat
  WHERE market IS NOT NULL AND {X} IS NOT NULL GROUP BY market HAVING COUNT({X}) >= 30)"""


@query("h11_h12_anova", with_star(f"""
WITH t AS (SELECT SUM(n) AS big_n, SUM(n * mean) / SUM(n) AS grand, COUNT(*) AS k FROM gs),
s AS (SELECT SUM(n * (mean - grand) * (mean - grand)) AS ss_between, SUM((n - 1) * COALESCE(var, 0)) AS ss_within,
        MIN(big_n) AS n, MIN(k) AS k FROM gs, t)
SELECT *, round({_f_p('f', 'df_between', 'df_within')}, 6) AS p FROM (
SELECT ss_between, ss_within, n, k, k - 1 AS df_between, n - k AS df_within,
  (ss_between / (k - 1)) / (ss_within / (n - k)) AS f, ss_between / (ss_between + ss_within) AS eta_squared FROM s) r""",
    _GROUPS))
def h11_h12_anova(spark, sf):
    r = _rounded(H.anova(_w(spark, sf), "market", X, 30), "p")
    return _row(spark, r, ["ss_between", "ss_within", "n", "k", "df_between", "df_within", "f", "eta_squared", "p"])


@query("h14_tukey_hsd", with_star("""
WITH p AS (SELECT SUM((n - 1) * var) / (SUM(n) - COUNT(*)) AS msw, SUM(n) - COUNT(*) AS df_within, COUNT(*) AS k FROM gs)
SELECT a.market AS group_a, b.market AS group_b, b.mean - a.mean AS diff,
  ABS(b.mean - a.mean) / SQRT(msw / 2 * (1.0 / a.n + 1.0 / b.n)) AS q, k, df_within
FROM gs a JOIN gs b ON a.market < b.market, p""", _GROUPS))
def h14_tukey_hsd(spark, sf):
    return _tukey(spark, sf).drop("p_adj", "reject")


def _tukey(spark, sf):
    rows = H.tukey_hsd(_w(spark, sf), "market", X, min_n=30)
    return spark.createDataFrame([tuple(r.values()) for r in rows],
                                 "group_a string, group_b string, diff double, q double, k long, df_within long, "
                                 "p_adj double, reject boolean")


@query("h14_tukey_decisions")
def h14_tukey_decisions(spark, sf):
    """The studentized range has no SQL form; its p-values are unit-tested against table values."""
    return _tukey(spark, sf).select("group_a", "group_b", "q", "p_adj", "reject")


@query("h15_pairwise_welch", with_star(f"""
SELECT *, round({_t_p('t', 'df')}, 6) AS p, round(LEAST(1.0, {_t_p('t', 'df')} * COUNT(*) OVER ()), 6) AS p_bonferroni FROM (
SELECT a.market AS group_a, b.market AS group_b, (a.mean - b.mean) / SQRT(a.var / a.n + b.var / b.n) AS t,
  (a.var / a.n + b.var / b.n) * (a.var / a.n + b.var / b.n)
    / ((a.var / a.n) * (a.var / a.n) / (a.n - 1) + (b.var / b.n) * (b.var / b.n) / (b.n - 1)) AS df
FROM gs a JOIN gs b ON a.market < b.market) w""", _GROUPS))
def h15_pairwise_welch(spark, sf):
    rows = [_rounded(r, "p", "p_bonferroni") for r in H.pairwise_welch_bonferroni(_w(spark, sf), "market", X, 30)]
    return spark.createDataFrame([tuple(r.values()) for r in rows],
                                 "group_a string, group_b string, t double, df double, p double, p_bonferroni double")


@query("h16_pearson", with_star(f"""
SELECT *, round({_t_p('t', '(n - 2.0)')}, 6) AS p FROM (
SELECT CORR({X}, years_since_founded) AS r, COUNT(*) AS n,
  CORR({X}, years_since_founded) * SQRT((COUNT(*) - 2) / (1 - CORR({X}, years_since_founded) * CORR({X}, years_since_founded))) AS t
FROM feat WHERE {X} IS NOT NULL AND years_since_founded IS NOT NULL) s"""))
def h16_pearson(spark, sf):
    r = _rounded(H.pearson_test(_w(spark, sf), X, "years_since_founded"), "p")
    return _row(spark, r, ["r", "n", "t", "p"])


@query("h17_simple_regression", with_star(f"""
SELECT REGR_INTERCEPT({X}, CAST(funding_rounds AS DOUBLE)) AS intercept,
  REGR_SLOPE({X}, CAST(funding_rounds AS DOUBLE)) AS slope, REGR_R2({X}, CAST(funding_rounds AS DOUBLE)) AS r2,
  REGR_COUNT({X}, CAST(funding_rounds AS DOUBLE)) AS n
FROM feat WHERE {X} IS NOT NULL AND funding_rounds IS NOT NULL"""))
def h17_simple_regression(spark, sf):
    fit = H.ols(_w(spark, sf), X, ["funding_rounds"])
    d = {"intercept": fit["coef"][0], "slope": fit["coef"][1], "r2": fit["r2"], "n": fit["n"]}
    return spark.createDataFrame([(d["intercept"], d["slope"], d["r2"], d["n"])],
                                 "intercept double, slope double, r2 double, n long")


_TWO = "CAST(funding_rounds AS DOUBLE)", "CAST(num_round_types_used AS DOUBLE)"


# Two regressors: the normal equations in closed form.
@query("h17_ols_table", with_star(f"""
WITH m AS (SELECT COUNT(*) AS n, AVG({_TWO[0]}) AS m1, AVG({_TWO[1]}) AS m2, AVG({X}) AS my,
  COUNT(*) * VAR_POP({_TWO[0]}) AS s11, COUNT(*) * VAR_POP({_TWO[1]}) AS s22, COUNT(*) * COVAR_POP({_TWO[0]}, {_TWO[1]}) AS s12,
  COUNT(*) * COVAR_POP({_TWO[0]}, {X}) AS s1y, COUNT(*) * COVAR_POP({_TWO[1]}, {X}) AS s2y, COUNT(*) * VAR_POP({X}) AS syy
  FROM feat WHERE {X} IS NOT NULL AND funding_rounds IS NOT NULL AND num_round_types_used IS NOT NULL),
b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM m),
v AS (SELECT *, (syy - b1 * s1y - b2 * s2y) / (n - 3) AS s2, s11 * s22 - s12 * s12 AS det FROM b),
r AS (SELECT 'intercept' AS term, my - b1 * m1 - b2 * m2 AS coef, n - 3.0 AS df,
    sqrt(s2 * (1.0 / n + (m1 * m1 * s22 + m2 * m2 * s11 - 2 * m1 * m2 * s12) / det)) AS se FROM v
  UNION ALL SELECT 'funding_rounds', b1, n - 3.0, sqrt(s2 * s22 / det) FROM v
  UNION ALL SELECT 'num_round_types_used', b2, n - 3.0, sqrt(s2 * s11 / det) FROM v)
SELECT term, coef, se, coef / se AS t, round({_t_p('(coef / se)', 'df')}, 6) AS p FROM r"""))
def h17_ols_table(spark, sf):
    fit = H.ols(_w(spark, sf), X, ["funding_rounds", "num_round_types_used"])
    rows = list(zip(fit["names"], fit["coef"], fit["se"], fit["t"], [round(p, 6) for p in fit["p"]]))
    return spark.createDataFrame(rows, "term string, coef double, se double, t double, p double")


@query("h17_ols_categorical")
def h17_ols_categorical(spark, sf):
    """With a column per level of the three most frequent markets."""
    fit = H.ols(_w(spark, sf), X, ["funding_rounds", "years_since_founded", "num_round_types_used"], ["market"], top_n=3)
    rows = list(zip(fit["names"], fit["coef"], fit["se"], fit["t"], fit["p"]))
    return spark.createDataFrame(rows, "term string, coef double, se double, t double, p double")


@query("h18_vif", with_star("""
WITH c AS (SELECT CORR(CAST(funding_rounds AS DOUBLE), CAST(years_since_founded AS DOUBLE)) AS ab,
  CORR(CAST(funding_rounds AS DOUBLE), CAST(num_round_types_used AS DOUBLE)) AS ac,
  CORR(CAST(years_since_founded AS DOUBLE), CAST(num_round_types_used AS DOUBLE)) AS bc
  FROM feat WHERE funding_rounds IS NOT NULL AND years_since_founded IS NOT NULL AND num_round_types_used IS NOT NULL)
SELECT 'funding_rounds' AS feature, 1 / (1 - (ab * ab + ac * ac - 2 * ab * ac * bc) / (1 - bc * bc)) AS vif FROM c
UNION ALL SELECT 'years_since_founded', 1 / (1 - (ab * ab + bc * bc - 2 * ab * ac * bc) / (1 - ac * ac)) FROM c
UNION ALL SELECT 'num_round_types_used', 1 / (1 - (ac * ac + bc * bc - 2 * ab * ac * bc) / (1 - ab * ab)) FROM c"""))
def h18_vif(spark, sf):
    v = H.vif(_w(spark, sf), ["funding_rounds", "years_since_founded", "num_round_types_used"])
    return spark.createDataFrame(list(v.items()), "feature string, vif double")


# One regressor: R² of the squared residuals of the fitted line; with one degree of freedom the
# chi-square tail is that of a normal, and the F tail that of Student's t.
@query("h19_breusch_pagan", with_star(f"""
WITH d AS (SELECT {X} AS y, CAST(funding_rounds AS DOUBLE) AS x FROM feat WHERE {X} IS NOT NULL AND funding_rounds IS NOT NULL),
l AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM d),
e AS (SELECT x, (y - a - b * x) * (y - a - b * x) AS e2 FROM d, l),
q AS (SELECT COUNT(*) AS n, regr_r2(e2, x) AS r2 FROM e),
s AS (SELECT n * r2 AS lm, r2 / ((1 - r2) / (n - 2)) AS f, n - 2.0 AS df FROM q)
SELECT lm, round({_norm_p('sqrt(lm)')}, 6) AS lm_p, f, round({_t_p('sqrt(f)', 'df')}, 6) AS f_p FROM s"""))
def h19_breusch_pagan(spark, sf):
    r = _rounded(H.breusch_pagan(_w(spark, sf), X, ["funding_rounds"]), "lm_p", "f_p")
    return _row(spark, r, ["lm", "lm_p", "f", "f_p"])


@query("h20_jarque_bera", with_star(f"""
WITH m AS (SELECT AVG({X}) AS mu, COUNT({X}) AS n FROM feat),
c AS (SELECT MIN(n) AS n, AVG(POW({X} - mu, 2)) AS m2, AVG(POW({X} - mu, 3)) AS m3, AVG(POW({X} - mu, 4)) AS m4
      FROM feat, m WHERE {X} IS NOT NULL)
SELECT n, m3 / POW(m2, 1.5) AS skew, m4 / (m2 * m2) - 3 AS kurt,
  n / 6.0 * (POW(m3 / POW(m2, 1.5), 2) + POW(m4 / (m2 * m2) - 3, 2) / 4.0) AS jb FROM c"""))
def h20_jarque_bera(spark, sf):
    return H.jarque_bera_stats(_w(spark, sf), X)


@query("h20_normality_ks")
def h20_normality_ks(spark, sf):
    r = H.normality(_w(spark, sf), X)
    return _row(spark, r, ["n", "jb", "jb_p", "ks_stat", "ks_p"])


def _qq_sql():
    ps = [i / 100 for i in range(1, 100)]
    vals = ", ".join(f"({i + 1}, CAST({p!r} AS DOUBLE), CAST({dist.norm_ppf(p)!r} AS DOUBLE))"
                     for i, p in enumerate(ps))
    plist = ", ".join(repr(p) for p in ps)
    return with_star(f"""
WITH q AS (SELECT quantile_cont({X}, [{plist}]) AS qs FROM feat WHERE {X} IS NOT NULL)
SELECT t.p, t.theoretical, qs[t.i] AS sample FROM q, (VALUES {vals}) AS t(i, p, theoretical)""")


@query("h21_qq_points", _qq_sql())
def h21_qq_points(spark, sf):
    return H.qq_points(_w(spark, sf), X, 99)


@query("h21_qq_line", f"""
SELECT regr_slope(sample, theoretical) AS slope, regr_intercept(sample, theoretical) AS intercept FROM ({_qq_sql()}) points""")
def h21_qq_line(spark, sf):
    return H.qq_line(H.qq_points(_w(spark, sf), X, 99))


@query("h22_residual_table", with_star(f"""
WITH r AS (SELECT REGR_INTERCEPT({X}, CAST(funding_rounds AS DOUBLE)) AS b0,
             REGR_SLOPE({X}, CAST(funding_rounds AS DOUBLE)) AS b1
           FROM feat WHERE {X} IS NOT NULL AND funding_rounds IS NOT NULL)
SELECT startup_id, b0 + b1 * funding_rounds AS fitted, {X} - (b0 + b1 * funding_rounds) AS residual
FROM feat, r WHERE {X} IS NOT NULL AND funding_rounds IS NOT NULL"""))
def h22_residual_table(spark, sf):
    w = _w(spark, sf).where(F.col(X).isNotNull() & F.col("funding_rounds").isNotNull())
    fit = H.ols(w, X, ["funding_rounds"])
    return H.residual_table(w, X, fit).select("startup_id", "fitted", "residual")


# =============================================================================
# E-series on T.scored (lineitem as a scored test set)
# =============================================================================

def _scored(spark, sf):
    s = testbed.scored(_tables(spark, sf))
    return s.withColumn("pred", (F.col("score") >= 0.3).cast("int"))


_PRED = "CAST(score >= 0.3 AS INTEGER)"


@query("e1_regression_metrics", with_star("""
SELECT *, 1 - (1 - r2) * (n - 1) / (n - 2) AS adj_r2 FROM (
SELECT COUNT(*) AS n, AVG(ABS(predicted - actual)) AS mae, AVG((predicted - actual) * (predicted - actual)) AS mse,
  SQRT(AVG((predicted - actual) * (predicted - actual))) AS rmse,
  1 - VAR_POP(actual - predicted) / VAR_POP(actual) AS explained_variance,
  1 - SUM((predicted - actual) * (predicted - actual)) / (VAR_POP(actual) * COUNT(*)) AS r2,
  AVG(CASE WHEN actual <> 0 THEN ABS((predicted - actual) / actual) END) AS mape,
  CASE WHEN MIN(LEAST(actual, predicted)) > -1 THEN SQRT(AVG(POW(LN(1 + predicted) - LN(1 + actual), 2))) END AS rmsle,
  quantile_cont(ABS(predicted - actual), 0.5) AS median_ae
FROM scored) s"""))
def e1_regression_metrics(spark, sf):
    return E.regression_metrics(_scored(spark, sf), "actual", "predicted", n_features=1)


@query("e2_classification_metrics", with_star(f"""
WITH c AS (SELECT COUNT(*) FILTER (WHERE label = 1 AND {_PRED} = 1) AS tp,
  COUNT(*) FILTER (WHERE label = 0 AND {_PRED} = 1) AS fp, COUNT(*) FILTER (WHERE label = 0 AND {_PRED} = 0) AS tn,
  COUNT(*) FILTER (WHERE label = 1 AND {_PRED} = 0) AS fn,
  AVG(-(label * LN(LEAST(GREATEST(score, 1e-15), 1 - 1e-15))
        + (1 - label) * LN(1 - LEAST(GREATEST(score, 1e-15), 1 - 1e-15)))) AS log_loss FROM scored),
d AS (SELECT *, CAST(tp AS DOUBLE) AS dtp, CAST(fp AS DOUBLE) AS dfp, CAST(tn AS DOUBLE) AS dtn,
        CAST(fn AS DOUBLE) AS dfn FROM c)
SELECT tp, fp, tn, fn, (dtp + dtn) / (dtp + dfp + dtn + dfn) AS accuracy,
  (dtp / NULLIF(dtp + dfn, 0) + dtn / NULLIF(dtn + dfp, 0)) / 2 AS balanced_accuracy,
  dtp / NULLIF(dtp + dfp, 0) AS precision, dtp / NULLIF(dtp + dfn, 0) AS recall, dtn / NULLIF(dtn + dfp, 0) AS specificity,
  2 * (dtp / NULLIF(dtp + dfp, 0)) * (dtp / NULLIF(dtp + dfn, 0))
    / NULLIF(dtp / NULLIF(dtp + dfp, 0) + dtp / NULLIF(dtp + dfn, 0), 0) AS f1,
  ((dtp + dtn) / (dtp + dfp + dtn + dfn) - ((dtp + dfp) * (dtp + dfn) + (dtn + dfn) * (dtn + dfp))
     / ((dtp + dfp + dtn + dfn) * (dtp + dfp + dtn + dfn)))
  / NULLIF(1 - ((dtp + dfp) * (dtp + dfn) + (dtn + dfn) * (dtn + dfp)) / ((dtp + dfp + dtn + dfn) * (dtp + dfp + dtn + dfn)), 0)
    AS cohen_kappa,
  (dtp * dtn - dfp * dfn) / NULLIF(SQRT((dtp + dfp) * (dtp + dfn) * (dtn + dfp) * (dtn + dfn)), 0) AS mcc, log_loss
FROM d"""))
def e2_classification_metrics(spark, sf):
    return E.classification_metrics(_scored(spark, sf), "label", "pred", "score")


@query("e3_confusion_matrix", with_star(f"""
SELECT label, {_PRED} AS pred, COUNT(*) AS n FROM scored GROUP BY 1, 2"""))
def e3_confusion_matrix(spark, sf):
    return E.confusion_matrix(_scored(spark, sf), "label", "pred")


_CURVE = """per AS (SELECT score, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label <> 1) AS neg
  FROM scored WHERE score IS NOT NULL GROUP BY score),
cum AS (SELECT score, pos, neg, SUM(pos) OVER (ORDER BY score DESC) AS cum_pos, SUM(neg) OVER (ORDER BY score DESC) AS cum_neg,
  SUM(pos) OVER () AS P, SUM(neg) OVER () AS N FROM per)"""


@query("e4_roc_curve", with_star("""
SELECT score AS threshold, CAST(cum_neg AS DOUBLE) / N AS fpr, CAST(cum_pos AS DOUBLE) / P AS tpr FROM cum""", _CURVE))
def e4_roc_curve(spark, sf):
    return E.roc_curve(_scored(spark, sf), "label", "score")


@query("e4_roc_auc", with_star("""
SELECT SUM(neg * (2 * cum_pos - pos) / 2.0) / (SUM(pos) * SUM(neg)) AS auc, SUM(pos) AS positives,
  SUM(neg) AS negatives FROM cum""", _CURVE))
def e4_roc_auc(spark, sf):
    return E.roc_auc(_scored(spark, sf), "label", "score")


@query("e5_pr_curve", with_star("""
SELECT score AS threshold, CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg) AS precision,
  CAST(cum_pos AS DOUBLE) / P AS recall FROM cum""", _CURVE))
def e5_pr_curve(spark, sf):
    return E.pr_curve(_scored(spark, sf), "label", "score")


@query("e5_average_precision", with_star("""
SELECT SUM(pos * CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg)) / SUM(pos) AS average_precision FROM cum""", _CURVE))
def e5_average_precision(spark, sf):
    return E.average_precision(_scored(spark, sf), "label", "score")


@query("e6_calibration", with_star("""
WITH e AS (SELECT quantile_cont(score, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]) AS q FROM scored),
ed AS (SELECT DISTINCT unnest(q) AS x FROM e),
inner_edges AS (SELECT x FROM ed WHERE x > (SELECT MIN(x) FROM ed) AND x < (SELECT MAX(x) FROM ed)),
b AS (SELECT s.score, s.label, CAST(1 + (SELECT COUNT(*) FROM inner_edges WHERE s.score > x) AS BIGINT) AS bin
      FROM scored s WHERE s.score IS NOT NULL)
SELECT bin, AVG(score) AS mean_predicted, AVG(CAST(label AS DOUBLE)) AS fraction_positive, COUNT(*) AS n
FROM b GROUP BY bin"""))
def e6_calibration(spark, sf):
    return E.calibration(_scored(spark, sf), "label", "score", 10)


_TS = [round(0.10 + 0.05 * i, 2) for i in range(17)]


@query("e7_threshold_sweep", with_star(f"""
WITH t AS (SELECT CAST(unnest({_TS}) AS DOUBLE) AS threshold),
c AS (SELECT threshold, COUNT(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp,
        COUNT(*) FILTER (WHERE label <> 1 AND score >= threshold) AS fp,
        (SELECT COUNT(*) FILTER (WHERE label = 1) FROM scored) AS P
      FROM t, scored GROUP BY threshold),
m AS (SELECT threshold, tp, fp, CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0) AS precision, CAST(tp AS DOUBLE) / P AS recall FROM c),
f AS (SELECT *, 2 * precision * recall / NULLIF(precision + recall, 0) AS f1 FROM m)
SELECT threshold, tp, fp, precision, recall, f1, COALESCE(f1 = MAX(f1) OVER (), false) AS is_best FROM f"""))
def e7_threshold_sweep(spark, sf):
    return E.threshold_sweep(_scored(spark, sf), "label", "score", _TS)


@query("e8_worst_predictions", with_star("""
SELECT l_orderkey, l_linenumber, l_partkey, actual, predicted, ABS(predicted - actual) AS abs_error FROM scored
ORDER BY abs_error DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10"""))
def e8_worst_predictions(spark, sf):
    s = _scored(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "actual", "predicted")
    return E.worst_predictions(s, "actual", "predicted", 10, ["l_orderkey", "l_linenumber", "l_partkey"])


@query("e9_error_by_group", with_star("""
SELECT l_returnflag, AVG(ABS(predicted - actual)) AS mae, COUNT(*) AS n FROM scored GROUP BY l_returnflag"""))
def e9_error_by_group(spark, sf):
    return E.error_by(_scored(spark, sf), "actual", "predicted", "l_returnflag")


@query("e9_error_buckets", with_star("""
SELECT CAST((e >= 5000) AS INTEGER) + CAST((e >= 20000) AS INTEGER) + CAST((e >= 50000) AS INTEGER) AS bucket,
  COUNT(*) AS n, AVG(e) AS mae FROM (SELECT ABS(predicted - actual) AS e FROM scored) x GROUP BY 1"""))
def e9_error_buckets(spark, sf):
    return E.error_buckets(_scored(spark, sf), "actual", "predicted", [5000, 20000, 50000])


@query("e10_miss_profile", with_star(f"""
SELECT CASE WHEN {_PRED} = 1 THEN 'true_positive' ELSE 'false_negative' END AS outcome, COUNT(*) AS n,
  AVG(CAST(actual AS DOUBLE)) AS mean_actual, AVG(CAST(predicted AS DOUBLE)) AS mean_predicted,
  quantile_cont(score, 0.5) AS median_score
FROM scored WHERE label = 1 GROUP BY 1"""))
def e10_miss_profile(spark, sf):
    return E.miss_profile(_scored(spark, sf), "label", "pred", "score", ["actual", "predicted"])


@query("e11_residual_distribution", with_star("""
SELECT AVG(actual - predicted) AS mean_residual, STDDEV_SAMP(actual - predicted) AS sd_residual,
  COUNT(actual - predicted) AS n FROM scored"""))
def e11_residual_distribution(spark, sf):
    return E.residual_distribution(_scored(spark, sf), "actual", "predicted")


@query("e11_residual_histogram", with_star("""
WITH r AS (SELECT actual - predicted AS x FROM scored), b AS (SELECT MIN(x) AS low, MAX(x) AS high FROM r),
n AS (SELECT CAST(least(floor((x - low) / ((high - low) / 50)), 49) AS INTEGER) AS bin, COUNT(*) AS count FROM r, b WHERE x IS NOT NULL GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, low + i * ((high - low) / 50) AS lo, low + (i + 1) * ((high - low) / 50) AS hi, COALESCE(count, 0) AS count
FROM range(50) t(i), b LEFT JOIN n ON n.bin = i"""))
def e11_residual_histogram(spark, sf):
    return E.residual_histogram(_scored(spark, sf), "actual", "predicted")


@query("e12_leakage_check", with_star("""
SELECT 'score' AS feature, CORR(score, CAST(label AS DOUBLE)) AS corr, COUNT(*) AS n FROM scored
UNION ALL SELECT 'actual', CORR(actual, CAST(label AS DOUBLE)), COUNT(*) FROM scored"""))
def e12_leakage_check(spark, sf):
    return E.leakage_check(_scored(spark, sf), "label", ["score", "actual"])


@query("e13_classification_report", with_star(f"""
WITH b AS (SELECT label AS y, {_PRED} AS p FROM scored),
t AS (SELECT y AS cls, COUNT(*) AS support, COUNT(*) FILTER (WHERE y = p) AS tp FROM b GROUP BY y),
q AS (SELECT p AS cls, COUNT(*) AS pp FROM b GROUP BY p),
j AS (SELECT COALESCE(t.cls, q.cls) AS cls, COALESCE(support, 0) AS support, COALESCE(tp, 0) AS tp,
        COALESCE(pp, 0) AS pp FROM t FULL JOIN q ON t.cls = q.cls)
SELECT cls, CAST(tp AS DOUBLE) / NULLIF(pp, 0) AS precision, CAST(tp AS DOUBLE) / NULLIF(support, 0) AS recall,
  2 * (CAST(tp AS DOUBLE) / NULLIF(pp, 0)) * (CAST(tp AS DOUBLE) / NULLIF(support, 0))
    / NULLIF(CAST(tp AS DOUBLE) / NULLIF(pp, 0) + CAST(tp AS DOUBLE) / NULLIF(support, 0), 0) AS f1, support FROM j"""))
def e13_classification_report(spark, sf):
    return E.classification_report(_scored(spark, sf), "label", "pred")
