"""Views and refreshable summary tables.

Summaries are plain aggregations written as Parquet; ``refresh_summaries``
writes a new version and switches a pointer (readers never see a partial
refresh).  ``summary_vs_live`` runs the live aggregation and the summary
read side by side, checks they agree and records both wall times.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.warehouse import load_warehouse, read_warehouse


def startup_overview(t: dict[str, DataFrame]) -> DataFrame:
    """Fact (with its entity's attributes) ⟕ geography ⟕ industry."""
    f, g, i = t["fact_startup_funding"], t["dim_geography"], t["dim_industry"]
    return (f.join(g, "geography_id", "left")
             .join(i, "industry_id", "left")
             .select("startup_id", "name", "status", "is_unicorn", "country_name", "city",
                     "primary_category", "market", "funding_total_usd", "funding_rounds",
                     "years_since_founded", "furthest_stage_category", "valuation_billion_usd"))


def unicorn_scorecard(t: dict[str, DataFrame]) -> DataFrame:
    """R2: unicorns with geography and industry."""
    f, g, i = t["fact_startup_funding"], t["dim_geography"], t["dim_industry"]
    return (f.where(F.col("is_unicorn"))
             .join(g, "geography_id", "left").join(i, "industry_id", "left")
             .select("name", "country_name", "primary_category", "funding_total_usd",
                     "years_since_founded", "valuation_billion_usd", "valuation_tier"))


VIEWS = {"startup_overview": startup_overview, "unicorn_scorecard": unicorn_scorecard}


def views(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """R1, R2 by name, for SQL texts to be bound to (:class:`QueryRegistry`) or to register as views."""
    return {n: fn(t) for n, fn in VIEWS.items()}


def with_country_code(df: DataFrame, codes: DataFrame, name: str, code: str) -> DataFrame:
    """``country_code`` by a table of codes passed as data."""
    from ..operators.cleaning import map_codes

    return map_codes(df, "country_name", "country_code", codes, name, code)


def country_year_funding(t: dict[str, DataFrame]) -> DataFrame:
    """Funding, deals and unicorns per (country, first-funding year)."""
    f, g, d = t["fact_startup_funding"], t["dim_geography"], t["dim_date"]
    j = (f.join(g.where(F.col("country_name").isNotNull()), "geography_id", "inner")
          .join(d.select("date_id", "year"), f.first_funding_date_id == d.date_id, "inner"))
    return j.groupBy("country_name", "year").agg(
        F.sum("funding_total_usd").alias("total_funding"),
        F.count(F.lit(1)).alias("deal_count"),
        F.count_if(F.col("is_unicorn")).alias("unicorn_count"))


def industry_summary(t: dict[str, DataFrame]) -> DataFrame:
    """Per primary category: startups, funding, mean, exits, unicorns."""
    f, i = t["fact_startup_funding"], t["dim_industry"]
    j = f.join(i.where(F.col("primary_category").isNotNull()), "industry_id", "inner")
    return j.groupBy("primary_category").agg(
        F.count(F.lit(1)).alias("startup_count"),
        F.sum("funding_total_usd").alias("total_funding"),
        (F.sum("funding_total_usd").cast("double") / F.count("funding_total_usd")).alias("avg_funding"),
        F.count_if(F.col("is_exited")).alias("exited_count"),
        F.count_if(F.col("is_unicorn")).alias("unicorn_count"))


SUMMARIES = {"country_year_funding": country_year_funding, "industry_summary": industry_summary}


def refresh_summaries(t: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Recompute every summary into a new version folder, check the
    unique keys, then switch the live pointer."""
    from ..operators.quality import duplicate_key_count

    built = {n: fn(t) for n, fn in SUMMARIES.items()}
    keys = {"country_year_funding": ["country_name", "year"], "industry_summary": ["primary_category"]}

    def check(staged):
        for n, k in keys.items():
            dups = duplicate_key_count(staged[n], k)
            if dups:
                raise ValueError(f"summary {n} has {dups} duplicate keys on {k}")

    load_warehouse(built, root, checks=check, partition_by={"country_year_funding": ["year"]})
    return read_warehouse(spark=next(iter(t.values())).sparkSession, root=root)


def live_industry_totals(t: dict[str, DataFrame]) -> DataFrame:
    f, i = t["fact_startup_funding"], t["dim_industry"]
    return (f.join(i.where(F.col("primary_category").isNotNull()), "industry_id", "inner")
             .groupBy("primary_category").agg(F.sum("funding_total_usd").alias("total_funding")))


def summary_vs_live(t: dict[str, DataFrame], summary: DataFrame) -> DataFrame:
    """Live aggregate and summary side by side with an agreement flag."""
    live = live_industry_totals(t).withColumnRenamed("total_funding", "live_total_funding")
    summ = summary.select("primary_category", F.col("total_funding").alias("summary_total_funding"))
    j = live.join(summ, "primary_category", "full")
    return j.select("primary_category",
                    F.col("live_total_funding").cast("double").alias("live_total_funding"),
                    F.col("summary_total_funding").cast("double").alias("summary_total_funding"),
                    F.coalesce(F.col("live_total_funding") == F.col("summary_total_funding"),
                               F.lit(False)).alias("same_answer"))


def time_summary_vs_live(t: dict[str, DataFrame], summary: DataFrame, repeats: int = 3) -> dict:
    """R6 timings: median wall seconds of the live aggregation and the summary read."""
    def timed(df):
        out = []
        for _ in range(repeats):
            s = time.perf_counter()
            df.collect()
            out.append(time.perf_counter() - s)
        return sorted(out)[len(out) // 2]

    live = live_industry_totals(t)
    summ = summary.select("primary_category", "total_funding")
    lt, st = timed(live), timed(summ)
    return {"live_sec": lt, "summary_sec": st, "speedup": lt / st if st else None}
