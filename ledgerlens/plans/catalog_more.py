"""Further registered queries: aggregations, windows, top-k, measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import windows as W
from ..operators.joins import join_date_role
from ..operators.ordering import attach_row
from . import measures as B
from . import testbed
from .catalog import _tables, _wh, query
from .oracle_ctes import with_star


def _dbl(c):
    return F.col(c).cast("double").alias(c)


_DIM_COLS = {
    "geography": {"country_name", "region", "city"},
    "industry": {"primary_category", "market"},
    "ff": {"ff_full_date", "ff_year"},
    "fd": {"fd_full_date", "fd_year"},
    "ld": {"ld_full_date", "ld_year"},
}


def wide(spark, sf, cols=None):
    """J6 + J7: fact ⟕ geography ⟕ industry, plus the first-funding,
    founded and last-funding date roles.  With ``cols`` only the dimensions providing
    those columns are joined (Spark cannot drop an outer join by itself)."""
    t = _wh(spark, sf)
    f, g, i, d = t["fact_startup_funding"], t["dim_geography"], t["dim_industry"], t["dim_date"]
    need = set(cols) if cols is not None else None

    def uses(dim):
        return need is None or bool(need & _DIM_COLS[dim])

    j = f  # it carries the attributes of its entity
    if uses("geography"):
        j = j.join(g, "geography_id", "left")
    if uses("industry"):
        j = j.join(i, "industry_id", "left")
    if uses("ff"):
        j = join_date_role(j, d.select("date_id", "full_date", "year"), "first_funding_date_id", "ff_")
    if uses("fd"):
        j = join_date_role(j, d.select("date_id", "full_date", "year"), "founded_date_id", "fd_")
    if uses("ld"):
        j = join_date_role(j, d.select("date_id", "full_date", "year"), "last_funding_date_id", "ld_")
    j = j.withColumn("funding", F.col("funding_total_usd").cast("double"))
    return j if need is None else j.select(*cols)


def trend(spark, sf):
    return testbed.trend(_tables(spark, sf))


# =============================================================================
# A-series
# =============================================================================

@query("a1_scale_kpis", with_star("""
SELECT COUNT(*) AS rows, CAST(SUM(funding_total_usd) AS DOUBLE) AS total, COUNT(funding_total_usd) AS non_null,
  CAST(COUNT(funding_total_usd) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100 AS non_null_pct,
  CAST(SUM(funding_total_usd) AS DOUBLE) / CAST(COUNT(funding_total_usd) AS DOUBLE) AS mean,
  COUNT(DISTINCT country_name) AS distinct_country_name, COUNT(DISTINCT primary_category) AS distinct_primary_category,
  COUNT(*) FILTER (WHERE is_unicorn) AS is_unicorn_total,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.5) AS median
FROM feat"""))
def a1_scale_kpis(spark, sf):
    return A.scale_kpis(wide(spark, sf), "funding", "is_unicorn", ["country_name", "primary_category"])


@query("a2_value_counts", with_star("""
SELECT status, COUNT(*) AS count FROM feat WHERE status IS NOT NULL GROUP BY status
ORDER BY count DESC, status LIMIT 3"""))
def a2_value_counts(spark, sf):
    return A.value_counts(wide(spark, sf), "status", dropna=True, n=3)


_A3 = """
SELECT year, CAST(SUM(amt) AS DOUBLE) AS total, COUNT(*) AS deals,
  quantile_cont(CAST(amt AS DOUBLE), 0.5) AS median,
  (CAST(SUM(amt) AS DOUBLE) - LAG(CAST(SUM(amt) AS DOUBLE)) OVER (ORDER BY year))
    / NULLIF(LAG(CAST(SUM(amt) AS DOUBLE)) OVER (ORDER BY year), 0) * 100 AS change_pct
FROM (SELECT CAST(year(d) AS INTEGER) AS year, amt FROM trend) t
WHERE year >= 1995 AND year <= 2001 GROUP BY year"""


@query("a3_yearly_trend", with_star(_A3))
def a3_yearly_trend(spark, sf):
    t = trend(spark, sf).withColumn("year", F.year("d"))
    return A.yearly_trend(t, "year", "amt", 1995, 2001)


@query("a4_peak", with_star("""
SELECT min_by(year, -total) AS year, max(total) AS total FROM (
  SELECT CAST(year(d) AS INTEGER) AS year, CAST(SUM(amt) AS DOUBLE) AS total FROM trend GROUP BY 1) y"""))
def a4_peak(spark, sf):
    t = trend(spark, sf).withColumn("year", F.year("d"))
    y = t.groupBy("year").agg(F.sum("amt").cast("double").alias("total"))
    return A.peak(y, "year", "total")


@query("a5_group_profile", with_star("""
SELECT primary_category, COUNT(*) AS n, CAST(SUM(funding_total_usd) AS DOUBLE) AS total,
  CAST(SUM(funding_total_usd) AS DOUBLE) / CAST(COUNT(funding_total_usd) AS DOUBLE) AS mean,
  AVG(CAST(is_exited AS DOUBLE)) AS flag_rate, COUNT(*) FILTER (WHERE is_exited) AS flag_count,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.5) AS median
FROM feat GROUP BY primary_category HAVING COUNT(*) >= 30"""))
def a5_group_profile(spark, sf):
    return A.group_profile(wide(spark, sf), "primary_category", "funding", "is_exited", min_n=30)


@query("a6_group_share", with_star("""
SELECT country_name, CAST(SUM(funding_total_usd) AS DOUBLE) AS total, COUNT(*) AS n,
  CAST(SUM(funding_total_usd) AS DOUBLE) * 100 / SUM(CAST(SUM(funding_total_usd) AS DOUBLE)) OVER () AS share_pct
FROM feat GROUP BY country_name"""))
def a6_group_share(spark, sf):
    return A.group_share(wide(spark, sf), "country_name", "funding")


@query("a6_value_share", with_star("""
SELECT CAST(COUNT(*) FILTER (WHERE region = 'ASIA') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS share FROM feat"""))
def a6_value_share(spark, sf):
    return A.value_share(wide(spark, sf), "region", "ASIA")


@query("a8_mean_by", with_star("""
SELECT status, AVG(CAST(funding_total_usd AS DOUBLE)) AS mean FROM feat GROUP BY status"""))
def a8_mean_by(spark, sf):
    return A.mean_by(wide(spark, sf), "status", "funding")


@query("a10_outcome_summary", with_star("""
SELECT COUNT(*) AS n, AVG(CAST(is_exited AS DOUBLE)) AS is_exited_rate, AVG(CAST(is_closed AS DOUBLE)) AS is_closed_rate,
  AVG(CAST(is_unicorn AS DOUBLE)) AS is_unicorn_rate,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.5) FILTER (WHERE is_exited) AS median_exited,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.5) FILTER (WHERE is_closed) AS median_closed
FROM feat"""))
def a10_outcome_summary(spark, sf):
    return A.outcome_summary(wide(spark, sf), ["is_exited", "is_closed", "is_unicorn"], "funding",
                             {"median_exited": "is_exited", "median_closed": "is_closed"})


@query("a11_cohort_profile", with_star("""
SELECT CAST(floor(year(founded_at) / 5) * 5 AS BIGINT) AS cohort, COUNT(*) AS n,
  CAST(SUM(funding_total_usd) AS DOUBLE) / CAST(COUNT(funding_total_usd) AS DOUBLE) AS mean,
  AVG(CAST(is_exited AS DOUBLE)) AS flag_rate,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.5) AS median
FROM feat WHERE founded_at IS NOT NULL GROUP BY 1"""))
def a11_cohort_profile(spark, sf):
    return A.cohort_profile(wide(spark, sf), "fd_year", "funding", "is_exited", 5)


@query("a15_mode_by", with_star("""
SELECT region, market AS mode FROM (
  SELECT region, market, ROW_NUMBER() OVER (PARTITION BY region ORDER BY COUNT(*) DESC, market) AS rn
  FROM feat WHERE market IS NOT NULL GROUP BY region, market) m WHERE rn = 1"""))
def a15_mode_by(spark, sf):
    return A.mode_by(wide(spark, sf), "region", "market")


@query("a16_quantiles", with_star("""
SELECT quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.1) AS p10,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.25) AS p25,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.5) AS p50,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.75) AS p75,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.9) AS p90 FROM feat"""))
def a16_quantiles(spark, sf):
    return A.quantiles(wide(spark, sf), "funding", [0.1, 0.25, 0.5, 0.75, 0.9])


@query("a16_trim_below_quantile", with_star("""
SELECT startup_id, CAST(funding_total_usd AS DOUBLE) AS funding FROM feat
WHERE CAST(funding_total_usd AS DOUBLE) >= (SELECT quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.75) FROM feat)"""))
def a16_trim_below_quantile(spark, sf):
    return A.trim_below_quantile(wide(spark, sf).select("startup_id", "funding"), "funding", 0.75)


@query("a17_skewness", with_star("""
SELECT skewness(CAST(funding_total_usd AS DOUBLE)) AS skewness,
  skewness(ln(1 + CAST(funding_total_usd AS DOUBLE))) AS skewness_log1p FROM feat"""))
def a17_skewness(spark, sf):
    w = wide(spark, sf)
    raw = A.skewness(w, "funding")
    lg = A.skewness(w, "funding", log1p=True, name="skewness_log1p")
    return attach_row(raw, lg)


@query("a18_histogram", with_star("""
WITH b AS (SELECT min(log_funding_total_usd) AS lo, max(log_funding_total_usd) AS hi FROM feat),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(10)),
c AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((log_funding_total_usd - lo) / ((hi - lo) / 10)), 9) END AS INTEGER) AS bin,
             COUNT(*) AS count
      FROM feat, b WHERE log_funding_total_usd IS NOT NULL GROUP BY 1)
SELECT bins.bin, lo + bins.bin * ((hi - lo) / 10) AS lo, lo + (bins.bin + 1) * ((hi - lo) / 10) AS hi,
  COALESCE(c.count, 0) AS count
FROM bins CROSS JOIN b LEFT JOIN c ON c.bin = bins.bin"""))
def a18_histogram(spark, sf):
    return A.histogram(wide(spark, sf), "log_funding_total_usd", 10)


@query("a19_five_number_summary", with_star("""
WITH q AS (SELECT market, min(CAST(funding_total_usd AS DOUBLE)) AS min, max(CAST(funding_total_usd AS DOUBLE)) AS max,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.5) AS median,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.75) AS q3
  FROM feat WHERE funding_total_usd IS NOT NULL GROUP BY market)
SELECT q.market, min, max, q1, median, q3, q3 - q1 AS iqr,
  min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1) THEN x END) AS whisker_lo,
  max(CASE WHEN x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1) THEN x END) AS whisker_hi
FROM q JOIN (SELECT market, CAST(funding_total_usd AS DOUBLE) AS x FROM feat) f ON f.market = q.market
GROUP BY q.market, min, max, q1, median, q3"""))
def a19_five_number_summary(spark, sf):
    return A.five_number_summary(wide(spark, sf).where(F.col("funding").isNotNull()), "funding", ["market"])


@query("a20_drilldown_totals", with_star("""
SELECT CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  CAST(SUM(amt) AS DOUBLE) AS total, COUNT(*) AS deals,
  CAST(GROUPING(year(d), quarter(d), month(d)) AS BIGINT) AS level
FROM trend GROUP BY ROLLUP (year(d), quarter(d), month(d))"""))
def a20_drilldown_totals(spark, sf):
    out = A.drilldown_totals(trend(spark, sf), "d", "amt")
    return out.withColumn("level", F.col("level").cast("long"))


_CORR_COLS = ["funding", "funding_rounds", "years_since_founded", "num_round_types_used"]


@query("a21_correlation_matrix", with_star("""
WITH c AS (SELECT CAST(funding_total_usd AS DOUBLE) AS funding, CAST(funding_rounds AS DOUBLE) AS funding_rounds,
  CAST(years_since_founded AS DOUBLE) AS years_since_founded, CAST(num_round_types_used AS DOUBLE) AS num_round_types_used
  FROM feat WHERE funding_total_usd IS NOT NULL AND funding_rounds IS NOT NULL AND years_since_founded IS NOT NULL
  AND num_round_types_used IS NOT NULL),
p AS (SELECT corr(funding, funding_rounds) AS a, corr(funding, years_since_founded) AS b,
  corr(funding, num_round_types_used) AS c, corr(funding_rounds, years_since_founded) AS d,
  corr(funding_rounds, num_round_types_used) AS e, corr(years_since_founded, num_round_types_used) AS f FROM c)
SELECT x, y, r FROM (
  SELECT 'funding' AS x, 'funding_rounds' AS y, a AS r FROM p UNION ALL SELECT 'funding_rounds', 'funding', a FROM p
  UNION ALL SELECT 'funding', 'years_since_founded', b FROM p UNION ALL SELECT 'years_since_founded', 'funding', b FROM p
  UNION ALL SELECT 'funding', 'num_round_types_used', c FROM p UNION ALL SELECT 'num_round_types_used', 'funding', c FROM p
  UNION ALL SELECT 'funding_rounds', 'years_since_founded', d FROM p UNION ALL SELECT 'years_since_founded', 'funding_rounds', d FROM p
  UNION ALL SELECT 'funding_rounds', 'num_round_types_used', e FROM p UNION ALL SELECT 'num_round_types_used', 'funding_rounds', e FROM p
  UNION ALL SELECT 'years_since_founded', 'num_round_types_used', f FROM p UNION ALL SELECT 'num_round_types_used', 'years_since_founded', f FROM p
  UNION ALL SELECT 'funding', 'funding', 1.0 UNION ALL SELECT 'funding_rounds', 'funding_rounds', 1.0
  UNION ALL SELECT 'years_since_founded', 'years_since_founded', 1.0
  UNION ALL SELECT 'num_round_types_used', 'num_round_types_used', 1.0) m"""))
def a21_correlation_matrix(spark, sf):
    return A.correlation_matrix(wide(spark, sf), _CORR_COLS)


@query("a22_percent_below", with_star("""
SELECT AVG(CAST(CAST(funding_total_usd AS DOUBLE) < 500000 AS DOUBLE)) * 100 AS pct_below
FROM feat WHERE funding_total_usd IS NOT NULL"""))
def a22_percent_below(spark, sf):
    return A.percent_below(wide(spark, sf), "funding", 500000.0)


@query("a23_describe", with_star("""
SELECT 'funding' AS "column", COUNT(funding_total_usd) AS count, AVG(CAST(funding_total_usd AS DOUBLE)) AS mean,
  stddev_samp(CAST(funding_total_usd AS DOUBLE)) AS std FROM feat
UNION ALL SELECT 'years_since_founded', COUNT(years_since_founded), AVG(CAST(years_since_founded AS DOUBLE)),
  stddev_samp(CAST(years_since_founded AS DOUBLE)) FROM feat"""))
def a23_describe(spark, sf):
    return A.describe(wide(spark, sf), ["funding", "years_since_founded"])


@query("a24_filtered_summary", with_star("""
SELECT COUNT(*) FILTER (WHERE is_multi_round) AS n,
  CAST(COUNT(*) FILTER (WHERE is_multi_round) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100 AS pct_of_all,
  CAST(SUM(funding_total_usd) FILTER (WHERE is_multi_round) AS DOUBLE) AS total,
  SUM(CAST(is_exited AS DOUBLE)) FILTER (WHERE is_multi_round) / CAST(COUNT(*) FILTER (WHERE is_multi_round) AS DOUBLE)
    AS flag_rate,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.5) FILTER (WHERE is_multi_round) AS median FROM feat"""))
def a24_filtered_summary(spark, sf):
    return A.filtered_summary(wide(spark, sf), F.col("is_multi_round"), "funding", "is_exited")


# =============================================================================
# W-series (remaining) and T-series
# =============================================================================

@query("w6_quantile_bins", with_star("""
WITH e AS (SELECT quantile_cont(CAST(funding_total_usd AS DOUBLE), [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]) AS q FROM feat),
ed AS (SELECT DISTINCT unnest(q) AS x FROM e),
inner_edges AS (SELECT x FROM ed WHERE x > (SELECT MIN(x) FROM ed) AND x < (SELECT MAX(x) FROM ed))
SELECT f.startup_id, CAST(1 + (SELECT COUNT(*) FROM inner_edges WHERE CAST(f.funding_total_usd AS DOUBLE) > x) AS BIGINT) AS bin
FROM feat f WHERE f.funding_total_usd IS NOT NULL"""))
def w6_quantile_bins(spark, sf):
    w = wide(spark, sf).where(F.col("funding").isNotNull()).select("startup_id", "funding")
    return W.quantile_bins(w, "funding", 10).select("startup_id", "bin")


_YEARLY = "(SELECT CAST(year(d) AS INTEGER) AS year, CAST(SUM(amt) AS DOUBLE) AS total FROM trend GROUP BY 1)"


@query("w9_pct_change", with_star(f"""
SELECT year, total, (total - LAG(total) OVER (ORDER BY year)) / LAG(total) OVER (ORDER BY year) AS pct_change
FROM {_YEARLY} y"""))
def w9_pct_change(spark, sf):
    y = trend(spark, sf).groupBy(F.year("d").alias("year")).agg(F.sum("amt").cast("double").alias("total"))
    return W.pct_change(y, "year", "total")


_MONTHLY = """(SELECT CAST(date_trunc('month', d) AS DATE) AS month_start, CAST(SUM(amt) AS DOUBLE) AS total,
  COUNT(*) AS deals FROM trend GROUP BY 1)"""


def _monthly(spark, sf):
    m = W.month_series(trend(spark, sf), "d", "amt")
    return m.withColumn("total", F.col("total").cast("double"))


@query("w10_ytd", with_star(f"""
SELECT month_start, total, SUM(total) OVER (PARTITION BY year(month_start) ORDER BY month_start) AS ytd
FROM {_MONTHLY} m"""))
def w10_ytd(spark, sf):
    return W.ytd(_monthly(spark, sf)).select("month_start", "total", "ytd")


@query("w11_same_period_last_year", with_star(f"""
SELECT m.month_start, m.total, m.deals, p.total AS prior_year, p.deals AS prior_year_deals,
  (m.total - p.total) / p.total * 100 AS yoy_pct,
  CAST(m.deals - p.deals AS DOUBLE) / CAST(p.deals AS DOUBLE) * 100 AS deals_yoy_pct
FROM {_MONTHLY} m LEFT JOIN {_MONTHLY} p ON p.month_start + INTERVAL 12 MONTH = m.month_start"""))
def w11_same_period_last_year(spark, sf):
    out = W.same_period_last_year(_monthly(spark, sf))
    return out.select("month_start", "total", "deals", "prior_year", "prior_year_deals", "yoy_pct",
                      "deals_yoy_pct")


@query("w12_qoq_growth", with_star("""
WITH q AS (SELECT CAST(date_trunc('quarter', d) AS DATE) AS quarter_start, CAST(SUM(amt) AS DOUBLE) AS total
           FROM trend GROUP BY 1)
SELECT q.quarter_start, q.total, p.total AS prior_quarter, (q.total - p.total) / p.total * 100 AS qoq_pct
FROM q LEFT JOIN q p ON p.quarter_start + INTERVAL 3 MONTH = q.quarter_start"""))
def w12_qoq_growth(spark, sf):
    q = W.quarterly(trend(spark, sf), "d", "amt").withColumn("total", F.col("total").cast("double"))
    return W.qoq_growth(q)


@query("w13_rolling_12_months", with_star(f"""
SELECT month_start, total, SUM(total) OVER (ORDER BY year(month_start) * 12 + month(month_start)
  RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS rolling_12m FROM {_MONTHLY} m"""))
def w13_rolling_12_months(spark, sf):
    return W.rolling_months(_monthly(spark, sf)).select("month_start", "total", "rolling_12m")


@query("w14_cagr", with_star(f"""
SELECT CASE WHEN s > 0 AND e > 0 THEN pow(e / s, 1.0 / 5) - 1 END AS cagr FROM (
  SELECT SUM(CASE WHEN year(month_start) = 1995 THEN total END) AS s,
         SUM(CASE WHEN year(month_start) = 2000 THEN total END) AS e FROM {_MONTHLY} m) t"""))
def w14_cagr(spark, sf):
    return W.cagr(_monthly(spark, sf), 1995, 2000)


@query("w15_cumulative", with_star(f"""
SELECT year, total, SUM(total) OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative,
  SUM(total) OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / SUM(total) OVER () * 100
    AS cumulative_pct FROM {_YEARLY} y"""))
def w15_cumulative(spark, sf):
    y = trend(spark, sf).groupBy(F.year("d").alias("year")).agg(F.sum("amt").cast("double").alias("total"))
    return W.cumulative(y, "year", "total")


@query("w16_rank_members", with_star("""
SELECT country_name, total, n, CAST(RANK() OVER (ORDER BY total DESC) AS BIGINT) AS rank_by_total,
  CAST(RANK() OVER (ORDER BY n DESC) AS BIGINT) AS rank_by_count
FROM (SELECT country_name, CAST(SUM(funding_total_usd) AS DOUBLE) AS total, COUNT(*) AS n FROM feat
      WHERE country_name IS NOT NULL GROUP BY country_name) c"""))
def w16_rank_members(spark, sf):
    w = wide(spark, sf).where(F.col("country_name").isNotNull())
    agg = w.groupBy("country_name").agg(F.sum("funding_total_usd").cast("double").alias("total"),
                                        F.count(F.lit(1)).alias("n"))
    return W.global_ranks(agg, {"rank_by_total": "total", "rank_by_count": "n"})


@query("w17_top_n_share", with_star("""
SELECT CAST(SUM(CASE WHEN r <= 10 THEN t END) AS DOUBLE) / CAST(SUM(t) AS DOUBLE) AS top_share FROM (
  SELECT SUM(funding_total_usd) AS t, RANK() OVER (ORDER BY SUM(funding_total_usd) DESC) AS r
  FROM feat GROUP BY country_name) c"""))
def w17_top_n_share(spark, sf):
    return W.top_n_share(wide(spark, sf), "country_name", "funding_total_usd", 10)


@query("t1_order_limit", with_star("""
SELECT startup_id, name, CAST(funding_total_usd AS DOUBLE) AS funding FROM feat
WHERE funding_total_usd IS NOT NULL ORDER BY funding_total_usd DESC, startup_id LIMIT 10"""))
def t1_order_limit(spark, sf):
    w = wide(spark, sf).where(F.col("funding").isNotNull()).select("startup_id", "name", "funding")
    return W.order_limit(w, [F.col("funding").desc(), "startup_id"], 10)


@query("t2_top_by_metrics", with_star("""
SELECT * FROM (SELECT 'total' AS metric, country_name, CAST(SUM(funding_total_usd) AS DOUBLE) AS value FROM feat
  WHERE country_name IS NOT NULL GROUP BY country_name ORDER BY value DESC, country_name LIMIT 3) a
UNION ALL SELECT * FROM (SELECT 'mean', country_name, AVG(CAST(funding_total_usd AS DOUBLE)) AS value FROM feat
  WHERE country_name IS NOT NULL GROUP BY country_name ORDER BY value DESC, country_name LIMIT 3) b"""))
def t2_top_by_metrics(spark, sf):
    w = wide(spark, sf).where(F.col("country_name").isNotNull())
    prof = w.groupBy("country_name").agg(F.sum("funding_total_usd").cast("double").alias("total"),
                                         F.avg("funding").alias("mean"))
    a = W.order_limit(prof, [F.col("total").desc(), "country_name"], 3) \
         .select(F.lit("total").alias("metric"), "country_name", F.col("total").alias("value"))
    b = W.order_limit(prof, [F.col("mean").desc(), "country_name"], 3) \
         .select(F.lit("mean").alias("metric"), "country_name", F.col("mean").alias("value"))
    return a.unionByName(b)


@query("t3_page", with_star("""
SELECT startup_id, name, CAST(funding_total_usd AS DOUBLE) AS funding FROM feat
ORDER BY funding_total_usd DESC NULLS LAST, startup_id LIMIT 20 OFFSET 40"""))
def t3_page(spark, sf):
    w = wide(spark, sf).select("startup_id", "name", "funding")
    return W.page(w, [F.col("funding").desc_nulls_last(), "startup_id"], 20, 3)


@query("t4_null_ordering", with_star("""
SELECT city, AVG(CASE WHEN city <> 'City7' THEN CAST(years_since_founded AS DOUBLE) END) AS mean_age FROM feat GROUP BY city
ORDER BY mean_age DESC NULLS FIRST, city LIMIT 5"""))
def t4_null_ordering(spark, sf):
    w = wide(spark, sf)
    age = F.when(F.col("city") != "City7", F.col("years_since_founded").cast("double"))  # one city without any age
    agg = w.groupBy("city").agg(F.avg(age).alias("mean_age"))
    return W.order_limit(agg, [F.col("mean_age").desc_nulls_first(), "city"], 5)


@query("t5_first_k_per_group", with_star("""
SELECT country_name, startup_id, CAST(rn AS BIGINT) AS rn FROM (
  SELECT country_name, startup_id, ROW_NUMBER() OVER (PARTITION BY country_name ORDER BY funding_total_usd DESC, startup_id) AS rn
  FROM feat WHERE funding_total_usd IS NOT NULL) r WHERE rn <= 2"""))
def t5_first_k_per_group(spark, sf):
    w = wide(spark, sf).where(F.col("funding").isNotNull()).select("country_name", "startup_id", "funding")
    out = W.top_n_per_group(w, "country_name", "funding", 2, "rn", ties=False, tie_break=["startup_id"])
    return out.select("country_name", "startup_id", "rn")



# =============================================================================
# B-series: measures
# =============================================================================

_CORE = ["total_funding", "average_funding", "median_funding", "avg_funding_rounds", "avg_years_since_founded",
         "total_startups", "active_countries", "total_unicorns", "exit_rate", "closure_rate", "unicorn_rate",
         "multi_round_pct", "late_stage_startups", "funding_per_startup", "multi_round_success_lift"]


@query("b_core_measures", with_star("""
SELECT primary_category,
  CAST(SUM(funding_total_usd) AS DOUBLE) AS total_funding,
  CAST(SUM(funding_total_usd) AS DOUBLE) / CAST(COUNT(funding_total_usd) AS DOUBLE) AS average_funding,
  quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.5) AS median_funding,
  AVG(CAST(funding_rounds AS DOUBLE)) AS avg_funding_rounds,
  AVG(CAST(years_since_founded AS DOUBLE)) AS avg_years_since_founded,
  COUNT(*) AS total_startups, COUNT(DISTINCT country_name) AS active_countries,
  COUNT(*) FILTER (WHERE is_unicorn) AS total_unicorns,
  CAST(COUNT(*) FILTER (WHERE is_exited) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS exit_rate,
  CAST(COUNT(*) FILTER (WHERE is_closed) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS closure_rate,
  CAST(COUNT(*) FILTER (WHERE is_unicorn) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS unicorn_rate,
  CAST(COUNT(*) FILTER (WHERE is_multi_round) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS multi_round_pct,
  COUNT(*) FILTER (WHERE furthest_stage_category = 'Late Stage / Public') AS late_stage_startups,
  CAST(SUM(funding_total_usd) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS funding_per_startup,
  (CAST(COUNT(*) FILTER (WHERE is_exited AND status IS NOT NULL AND is_multi_round) AS DOUBLE)
     / NULLIF(CAST(COUNT(*) FILTER (WHERE status IS NOT NULL AND is_multi_round) AS DOUBLE), 0))
  / NULLIF(CAST(COUNT(*) FILTER (WHERE is_exited AND NOT is_multi_round) AS DOUBLE)
     / NULLIF(CAST(COUNT(*) FILTER (WHERE NOT is_multi_round) AS DOUBLE), 0), 0) AS multi_round_success_lift
FROM feat GROUP BY primary_category"""))
def b_core_measures(spark, sf):
    return B.measure(wide(spark, sf), _CORE, ["primary_category"])


# The star's rounds end before the late stage: an exit to the market stands for it.
@query("b3_late_stage", with_star("""
SELECT market, COUNT(*) FILTER (WHERE status = 'ipo') AS late_stage_startups, COUNT(*) AS total_startups FROM feat GROUP BY market"""))
def b3_late_stage(spark, sf):
    stage = F.when(F.col("status") == "ipo", F.lit("Late Stage / Public")).otherwise(F.col("furthest_stage_category"))
    return B.measure(wide(spark, sf).withColumn("stage_reached", stage), ["late_stage_startups", "total_startups"], ["market"],
                     roles={"stage": "stage_reached"})


@query("b5_date_role_switch", with_star("""
SELECT 'founded' AS role, CAST(year(founded_at) AS INTEGER) AS year, COUNT(*) AS total_startups
FROM feat WHERE founded_at IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'first_funding', CAST(year(first_funding_at) AS INTEGER), COUNT(*) FROM feat
WHERE first_funding_at IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'last_funding', CAST(year(last_funding_at) AS INTEGER), COUNT(*) FROM feat
WHERE last_funding_at IS NOT NULL GROUP BY 2"""))
def b5_date_role_switch(spark, sf):
    w = wide(spark, sf)
    a = B.measure_by_date_role(w, ["total_startups"], "fd_year").select(F.lit("founded").alias("role"), "*")
    b = B.measure_by_date_role(w, ["total_startups"], "ff_year").select(F.lit("first_funding").alias("role"), "*")
    c = B.measure_by_date_role(w, ["total_startups"], "ld_year").select(F.lit("last_funding").alias("role"), "*")
    return a.unionByName(b).unionByName(c)


@query("b2_total_investors", """
SELECT s_nationkey, COUNT(DISTINCT s_suppkey) AS total_investors FROM supplier GROUP BY s_nationkey""")
def b2_total_investors(spark, sf):
    return B.measure(_tables(spark, sf)["supplier"], ["total_investors"], ["s_nationkey"], roles={"investor": "s_suppkey"})


@query("b9_round_type_share", with_star("""
SELECT market, round_type_name, CAST(SUM(amount_usd) AS DOUBLE) AS funding_by_round_type,
  CAST(SUM(amount_usd) AS DOUBLE) / SUM(CAST(SUM(amount_usd) AS DOUBLE)) OVER (PARTITION BY market) AS share
FROM fact_type JOIN feat USING (startup_id) GROUP BY market, round_type_name"""))
def b9_round_type_share(spark, sf):
    t = _wh(spark, sf)
    rounds = (t["fact_funding_by_type"].join(t["dim_round_type"].select("round_type_id", "round_type_name"), "round_type_id")
              .join(wide(spark, sf, ["startup_id", "market"]), "startup_id"))
    return B.share_ignoring(rounds, "funding_by_round_type", ["market", "round_type_name"], "round_type_name")


@query("b7_rank_and_top_flag", with_star("""
SELECT country_name, total_funding, CAST(RANK() OVER (ORDER BY total_funding DESC) AS BIGINT) AS country_rank,
  CASE WHEN RANK() OVER (ORDER BY total_funding DESC) <= 10 THEN 'Top 10' ELSE 'Other' END AS top_flag
FROM (SELECT country_name, CAST(SUM(funding_total_usd) AS DOUBLE) AS total_funding FROM feat
      WHERE country_name IS NOT NULL GROUP BY country_name) c"""))
def b7_rank_and_top_flag(spark, sf):
    m = B.measure(wide(spark, sf).where(F.col("country_name").isNotNull()), ["total_funding"], ["country_name"])
    r = W.global_ranks(m, {"country_rank": "total_funding"})
    return r.withColumn("top_flag", B.top_flag(F.col("country_rank"), 10))


@query("b8_percentile_measure", with_star("""
SELECT market, quantile_cont(CAST(funding_total_usd AS DOUBLE), 0.9) AS funding_p90 FROM feat GROUP BY market"""))
def b8_percentile_measure(spark, sf):
    return B.measure(wide(spark, sf), ["funding_p90"], ["market"])


@query("b9_share_ignoring_dimension", with_star("""
SELECT market, country_name, CAST(SUM(funding_total_usd) AS DOUBLE) AS total_funding,
  CAST(SUM(funding_total_usd) AS DOUBLE) / SUM(CAST(SUM(funding_total_usd) AS DOUBLE)) OVER (PARTITION BY market) AS share
FROM feat GROUP BY market, country_name"""))
def b9_share_ignoring_dimension(spark, sf):
    return B.share_ignoring(wide(spark, sf), "total_funding", ["market", "country_name"], "country_name")


@query("b14_dynamic_measure_and_what_if", with_star("""
SELECT 'selector' AS part, market, CAST(COUNT(*) FILTER (WHERE is_exited) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS value
FROM feat GROUP BY market
UNION ALL
SELECT 'what_if', market, CAST(COUNT(*) AS DOUBLE) FROM feat WHERE year(founded_at) >= 1990 GROUP BY market"""))
def b14_dynamic_measure_and_what_if(spark, sf):
    w = wide(spark, sf)
    a = B.dynamic_measure(w, "Exit Rate %", ["market"]).select(F.lit("selector").alias("part"), "market", "value")
    b = B.measure(w.where(F.col("fd_year") >= 1990), ["total_startups"], ["market"]) \
         .select(F.lit("what_if").alias("part"), "market", F.col("total_startups").cast("double").alias("value"))
    return a.unionByName(b)


@query("b15_kpi_status", with_star("""
SELECT primary_category, exit_rate, CASE WHEN exit_rate >= 0.15 THEN 'Green' WHEN exit_rate >= 0.08 THEN 'Amber'
  ELSE 'Red' END AS kpi_status
FROM (SELECT primary_category, CAST(COUNT(*) FILTER (WHERE is_exited) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS exit_rate
      FROM feat GROUP BY primary_category) r"""))
def b15_kpi_status(spark, sf):
    m = B.measure(wide(spark, sf), ["exit_rate"], ["primary_category"])
    return m.withColumn("kpi_status", B.kpi_status(F.col("exit_rate")))
