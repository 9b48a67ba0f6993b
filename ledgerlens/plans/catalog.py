"""Registered queries: one Spark plan and (where SQL can say it) one DuckDB
oracle per operator of SURVEY §2.

Every query reads the driver's tables or the star Spark derives from them
(``warehouse``), over whole tables.  Column names and types are aligned with
the oracle: integers ``BIGINT``, money and ratios ``DOUBLE``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import windows as W
from ..session import read_tables
from ..sources.warehouse import QueryRegistry
from . import summaries as R
from .oracle_ctes import with_star
from .star import warehouse

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        CATALOG[name] = (fn, sql)
        return fn
    return deco


def _wh(spark, sf):
    return warehouse(spark, sf)


def _tables(spark, sf):
    return read_tables(spark, sf)


def _dbl(c):
    return F.col(c).cast("double").alias(c)


# =============================================================================
# Headline SQL questions (Q1–Q8)
# =============================================================================

def _fact_named(t):
    f, i = t["fact_startup_funding"], t["dim_industry"]
    return (f.where(F.col("funding_total_usd").isNotNull())
             .join(i.where(F.col("primary_category").isNotNull()), "industry_id"))


@query("w1_top_n_per_group", with_star("""
SELECT primary_category, name, funding_total_usd, rank_in_category FROM (
  SELECT primary_category, name, CAST(funding_total_usd AS DOUBLE) AS funding_total_usd,
    CAST(RANK() OVER (PARTITION BY primary_category ORDER BY funding_total_usd DESC) AS BIGINT)
      AS rank_in_category
  FROM feat WHERE funding_total_usd IS NOT NULL AND primary_category IS NOT NULL) r
WHERE rank_in_category <= 10"""))
def w1_top_n_per_group(spark, sf):
    base = _fact_named(_wh(spark, sf)).select("primary_category", "name", "funding_total_usd")
    out = W.top_n_per_group(base, "primary_category", "funding_total_usd", 10, "rank_in_category")
    return out.select("primary_category", "name", _dbl("funding_total_usd"), "rank_in_category")


@query("w2_yoy_growth", with_star("""
SELECT year, CAST(total_funding AS DOUBLE) AS total_funding, deal_count,
  CAST(LAG(total_funding) OVER (ORDER BY year) AS DOUBLE) AS prior_year_funding,
  ROUND(CAST(total_funding - LAG(total_funding) OVER (ORDER BY year) AS DOUBLE)
        / CAST(LAG(total_funding) OVER (ORDER BY year) AS DOUBLE) * 100, 1) AS yoy_growth_pct
FROM (SELECT CAST(year(first_funding_at) AS INTEGER) AS year, SUM(funding_total_usd) AS total_funding,
             COUNT(*) AS deal_count
      FROM feat WHERE funding_total_usd IS NOT NULL AND first_funding_at IS NOT NULL GROUP BY 1) y"""))
def w2_yoy_growth(spark, sf):
    t = _wh(spark, sf)
    f, d = t["fact_startup_funding"], t["dim_date"]
    j = f.where(F.col("funding_total_usd").isNotNull()) \
         .join(d.select("date_id", "year"), f.first_funding_date_id == d.date_id)
    return W.yoy_growth(j, "year", "funding_total_usd")


@query("w3_pareto", with_star("""
SELECT country_name, CAST(total_funding AS DOUBLE) AS total_funding,
  CAST(RANK() OVER (ORDER BY total_funding DESC) AS BIGINT) AS country_rank,
  ROUND(CAST(total_funding AS DOUBLE) / CAST(SUM(total_funding) OVER () AS DOUBLE) * 100, 2)
    AS pct_of_global_funding,
  ROUND(CAST(SUM(total_funding) OVER (ORDER BY total_funding DESC) AS DOUBLE)
        / CAST(SUM(total_funding) OVER () AS DOUBLE) * 100, 2) AS cumulative_pct_of_global_funding
FROM (SELECT country_name, SUM(funding_total_usd) AS total_funding FROM feat
      WHERE funding_total_usd IS NOT NULL AND country_name IS NOT NULL GROUP BY country_name) c"""))
def w3_pareto(spark, sf):
    t = _wh(spark, sf)
    f, g = t["fact_startup_funding"], t["dim_geography"]
    j = f.where(F.col("funding_total_usd").isNotNull()) \
         .join(g.where(F.col("country_name").isNotNull()), "geography_id")
    return W.pareto(j, "country_name", "funding_total_usd", "total_funding", "country_rank",
                    "pct_of_global_funding", "cumulative_pct_of_global_funding")


@query("w4_pareto_rowwise", with_star("""
SELECT country_name, CAST(total_funding AS DOUBLE) AS total_funding, country_rank, pct_of_global_funding,
  ROUND(SUM(pct_of_global_funding) OVER (ORDER BY total_funding DESC, country_name
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS cumulative_pct_of_global_funding
FROM (SELECT country_name, total_funding,
        CAST(RANK() OVER (ORDER BY total_funding DESC) AS BIGINT) AS country_rank,
        ROUND(CAST(total_funding AS DOUBLE) / CAST(SUM(total_funding) OVER () AS DOUBLE) * 100, 2)
          AS pct_of_global_funding
      FROM (SELECT country_name, SUM(funding_total_usd) AS total_funding FROM feat
            WHERE funding_total_usd IS NOT NULL AND country_name IS NOT NULL GROUP BY country_name) c) r"""))
def w4_pareto_rowwise(spark, sf):
    t = _wh(spark, sf)
    f, g = t["fact_startup_funding"], t["dim_geography"]
    j = f.where(F.col("funding_total_usd").isNotNull()) \
         .join(g.where(F.col("country_name").isNotNull()), "geography_id")
    return W.pareto_rowwise(j, "country_name", "funding_total_usd", "total_funding", "country_rank",
                            "pct_of_global_funding", "cumulative_pct_of_global_funding")


@query("a12_outcome_rates_by_group", with_star("""
SELECT primary_category, total_startups, exited_count, closed_count,
  ROUND(CAST(exited_count AS DOUBLE) / CAST(total_startups AS DOUBLE) * 100, 1) AS exit_rate_pct,
  ROUND(CAST(closed_count AS DOUBLE) / CAST(total_startups AS DOUBLE) * 100, 1) AS closure_rate_pct
FROM (SELECT primary_category, COUNT(*) AS total_startups,
        COUNT(*) FILTER (WHERE is_exited) AS exited_count, COUNT(*) FILTER (WHERE is_closed) AS closed_count
      FROM feat WHERE primary_category IS NOT NULL GROUP BY primary_category) o
WHERE total_startups >= 30
ORDER BY exit_rate_pct DESC, primary_category LIMIT 20"""))
def a12_outcome_rates_by_group(spark, sf):
    from ..operators.aggregate import conditional_rates
    t = _wh(spark, sf)
    f, i = t["fact_startup_funding"], t["dim_industry"]
    j = f.join(i.where(F.col("primary_category").isNotNull()), "industry_id")
    out = conditional_rates(j, "primary_category", {"exited": "is_exited", "closed": "is_closed"},
                            total="total_startups", min_n=30, decimals=1,
                            rate_names={"exited": "exit_rate_pct", "closed": "closure_rate_pct"})
    return W.order_limit(out, [F.col("exit_rate_pct").desc(), "primary_category"], 20)


@query("w5_decile_top", with_star("""
SELECT name, funding_total_usd, funding_decile FROM (
  SELECT startup_id, name, CAST(funding_total_usd AS DOUBLE) AS funding_total_usd,
    CAST(NTILE(10) OVER (ORDER BY funding_total_usd, startup_id) AS BIGINT) AS funding_decile
  FROM feat WHERE funding_total_usd IS NOT NULL) d
ORDER BY funding_total_usd DESC, startup_id DESC LIMIT 50"""))
def w5_decile_top(spark, sf):
    base = _wh(spark, sf)["fact_startup_funding"].where(F.col("funding_total_usd").isNotNull())
    out = W.decile_top(base.select("startup_id", "name", "funding_total_usd"), "funding_total_usd",
                       "startup_id", 50, name="funding_decile")
    return out.select("name", _dbl("funding_total_usd"), "funding_decile")


@query("w5_ntile_all_rows", with_star("""
SELECT startup_id, CAST(NTILE(10) OVER (ORDER BY funding_total_usd, startup_id) AS BIGINT) AS funding_decile
FROM feat WHERE funding_total_usd IS NOT NULL"""))
def w5_ntile_all_rows(spark, sf):
    f = _wh(spark, sf)["fact_startup_funding"].where(F.col("funding_total_usd").isNotNull())
    out = W.ntile(f.select("startup_id", "funding_total_usd"), ["funding_total_usd", "startup_id"], 10,
                  "funding_decile")
    return out.select("startup_id", "funding_decile")


_CITY_MIN = 2  # the test star spreads 1,500 entities over 1,000 (city, country) pairs


@query("w7_city_hubs", with_star(f"""
SELECT city, country_name, startup_count, CAST(total_funding AS DOUBLE) AS total_funding,
  ROUND(CAST(total_funding AS DOUBLE) / CAST(startup_count AS DOUBLE), 0) AS avg_funding_per_startup,
  CAST(RANK() OVER (ORDER BY total_funding DESC) AS BIGINT) AS rank_by_total_funding,
  CAST(RANK() OVER (ORDER BY startup_count DESC) AS BIGINT) AS rank_by_startup_count
FROM (SELECT city, country_name, COUNT(*) AS startup_count, SUM(funding_total_usd) AS total_funding
      FROM feat WHERE city IS NOT NULL AND funding_total_usd IS NOT NULL
      GROUP BY city, country_name HAVING COUNT(*) >= {_CITY_MIN}) c
ORDER BY total_funding DESC, city, country_name LIMIT 25"""))
def w7_city_hubs(spark, sf):
    from ..operators.aggregate import city_hubs
    t = _wh(spark, sf)
    f, g = t["fact_startup_funding"], t["dim_geography"]
    j = f.where(F.col("funding_total_usd").isNotNull()).join(g.where(F.col("city").isNotNull()), "geography_id")
    hubs = city_hubs(j, ["city", "country_name"], "funding_total_usd", _CITY_MIN)
    ranked = W.global_ranks(hubs, {"rank_by_total_funding": "total_funding",
                                   "rank_by_startup_count": "startup_count"})
    out = W.order_limit(ranked, [F.col("total_funding").desc(), "city", "country_name"], 25)
    return out.select("city", "country_name", "startup_count", _dbl("total_funding"),
                      "avg_funding_per_startup", "rank_by_total_funding", "rank_by_startup_count")


@query("a14_stage_funnel", with_star("""
SELECT furthest_stage_category, COUNT(*) AS startup_count,
  ROUND(CAST(SUM(funding_total_usd) AS DOUBLE) / CAST(COUNT(funding_total_usd) AS DOUBLE), 0)
    AS avg_total_funding,
  ROUND(CAST(COUNT(*) AS DOUBLE) * 100 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 1) AS pct_of_startups
FROM feat WHERE furthest_stage_category IS NOT NULL GROUP BY furthest_stage_category"""))
def a14_stage_funnel(spark, sf):
    from ..operators.aggregate import share_of_total
    f = _wh(spark, sf)["fact_startup_funding"].where(F.col("furthest_stage_category").isNotNull())
    agg = f.groupBy("furthest_stage_category").agg(
        F.count(F.lit(1)).alias("startup_count"),
        F.round(F.sum("funding_total_usd").cast("double") / F.count("funding_total_usd").cast("double"), 0)
        .alias("avg_total_funding"))
    return share_of_total(agg, "startup_count", "pct_of_startups", decimals=1)


@query("a9_total_by_type", with_star("""
SELECT primary_category, stage_category, CAST(SUM(amount_usd) AS DOUBLE) AS total_amount
FROM fact_type ft JOIN feat f ON ft.startup_id = f.startup_id
JOIN round_type rt ON ft.round_type_name = rt.round_type_name
WHERE primary_category IS NOT NULL GROUP BY primary_category, stage_category"""))
def a9_total_by_type(spark, sf):
    t = _wh(spark, sf)
    fb, f, i, rt = (t["fact_funding_by_type"], t["fact_startup_funding"], t["dim_industry"],
                    t["dim_round_type"])
    j = (fb.join(f.select("startup_id", "industry_id"), "startup_id")
           .join(i.where(F.col("primary_category").isNotNull()), "industry_id")
           .join(F.broadcast(rt.select("round_type_id", "stage_category")), "round_type_id"))
    return j.groupBy("primary_category", "stage_category").agg(
        F.sum("amount_usd").cast("double").alias("total_amount"))


# =============================================================================
# Views and summaries
# =============================================================================

def _view(spark, sf, name):
    """A view of the star, read by SQL as a view is."""
    registry = QueryRegistry({name: f"SELECT * FROM {{{name}}}"})
    return registry.run(spark, name, {name: R.views(_wh(spark, sf))[name]}).withColumn(
        "valuation_billion_usd", F.col("valuation_billion_usd").cast("double"))


@query("r1_startup_overview", with_star("""
SELECT startup_id, name, status, is_unicorn, country_name, city, primary_category, market,
  CAST(funding_total_usd AS DOUBLE) AS funding_total_usd, funding_rounds, years_since_founded,
  furthest_stage_category, valuation_billion_usd FROM feat"""))
def r1_startup_overview(spark, sf):
    v = _view(spark, sf, "startup_overview")
    return v.withColumn("funding_total_usd", F.col("funding_total_usd").cast("double"))


@query("r2_unicorn_scorecard", with_star("""
SELECT name, country_name, primary_category, CAST(funding_total_usd AS DOUBLE) AS funding_total_usd,
  years_since_founded, valuation_billion_usd, valuation_tier FROM feat WHERE is_unicorn"""))
def r2_unicorn_scorecard(spark, sf):
    v = _view(spark, sf, "unicorn_scorecard")
    return v.withColumn("funding_total_usd", F.col("funding_total_usd").cast("double"))


@query("r3_country_year_funding", with_star("""
SELECT country_name, upper(substr(country_name, 1, 3)) AS country_code, CAST(year(first_funding_at) AS INTEGER) AS year,
  CAST(SUM(funding_total_usd) AS DOUBLE) AS total_funding, COUNT(*) AS deal_count,
  COUNT(*) FILTER (WHERE is_unicorn) AS unicorn_count
FROM feat WHERE country_name IS NOT NULL AND first_funding_at IS NOT NULL GROUP BY country_name, 3"""))
def r3_country_year_funding(spark, sf):
    codes = _tables(spark, sf)["nation"].select("n_name", F.upper(F.substring("n_name", 1, 3)).alias("code"))
    s = R.with_country_code(R.country_year_funding(_wh(spark, sf)), codes, "n_name", "code")
    return s.withColumn("total_funding", F.col("total_funding").cast("double"))


_R4_SQL = """
SELECT primary_category, COUNT(*) AS startup_count, CAST(SUM(funding_total_usd) AS DOUBLE) AS total_funding,
  CAST(SUM(funding_total_usd) AS DOUBLE) / CAST(COUNT(funding_total_usd) AS DOUBLE) AS avg_funding,
  COUNT(*) FILTER (WHERE is_exited) AS exited_count, COUNT(*) FILTER (WHERE is_unicorn) AS unicorn_count
FROM feat WHERE primary_category IS NOT NULL GROUP BY primary_category"""


_SUMMARIES: dict[tuple, dict] = {}


def _summaries(spark, sf):
    """The summaries of the star as it is now, refreshed once per session and star."""
    from ..sources.warehouse import warehouse_root
    from .star import star_tag
    key = (spark.sparkContext.applicationId, star_tag(spark, sf))
    if key not in _SUMMARIES:
        _SUMMARIES[key] = R.refresh_summaries(_wh(spark, sf), warehouse_root(spark, "summaries-" + key[1]))
    return _SUMMARIES[key]


@query("r4_industry_summary", with_star(_R4_SQL))
def r4_industry_summary(spark, sf):
    s = _summaries(spark, sf)["industry_summary"]
    return s.withColumn("total_funding", F.col("total_funding").cast("double"))


@query("r4_industry_summary_live", with_star(_R4_SQL))
def r4_industry_summary_live(spark, sf):
    s = R.industry_summary(_wh(spark, sf))
    return s.withColumn("total_funding", F.col("total_funding").cast("double"))


@query("r6_summary_vs_live", with_star("""
SELECT primary_category, CAST(SUM(funding_total_usd) AS DOUBLE) AS live_total_funding,
  CAST(SUM(funding_total_usd) AS DOUBLE) AS summary_total_funding, true AS same_answer
FROM feat WHERE primary_category IS NOT NULL GROUP BY primary_category"""))
def r6_summary_vs_live(spark, sf):
    t = _wh(spark, sf)
    return R.summary_vs_live(t, _summaries(spark, sf)["industry_summary"])


def all_queries() -> dict[str, Query]:
    _load_all()
    return {k: v[0] for k, v in CATALOG.items()}


def all_oracles() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in CATALOG.items() if v[1]}


def _load_all():
    # further registrations live in sibling modules; importing registers them
    from . import catalog_clean, catalog_ml, catalog_more, catalog_stats  # noqa: F401

