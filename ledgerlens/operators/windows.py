"""Ranking, growth and time-intelligence windows.

Rules used throughout:

* windows with ``partitionBy`` are preceded, where a group may be hot, by a
  salted first pass so no group is sorted in a single task;
* global windows (no ``partitionBy``) only run on inputs already aggregated
  to a bounded number of rows (years, months, countries, cities);
* row-grain global order (deciles) uses the distributed helpers in
  :mod:`ledgerlens.operators.ordering`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ordering import (attach_row, global_lag, global_rank, global_row_number, ntile_of_position, running_totals,
                       small_window)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------------------- W1, T5
def top_n_per_group(df: DataFrame, group: str | Sequence[str], order: str, n: int,
                    rank_col: str = "rank", ties: bool = True, tie_break: Sequence[str] = (),
                    salts: int | None = None) -> DataFrame:
    """W1 (``RANK``, ties kept) / T5 (``ROW_NUMBER``, first ``n``) per group, descending ``order``.

    A hot group must not be shuffled whole into one task.  For ``n`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` Spark plans a
    ``WindowGroupLimit`` on the map side of the exchange, so each input task
    ships at most ``n`` (plus ties) rows per group.  Above that threshold
    (or when ``salts`` is given) a salted first pass does the same by hand:
    rows are ranked inside ``(group, salt)`` buckets, as many as there are
    shuffle partitions, and only each bucket's
    top ``n`` survive (a row in the global top ``n`` is in its bucket's top
    ``n``), then the survivors are ranked per group.
    """
    groups = [group] if isinstance(group, str) else list(group)
    ordering = [F.col(order).desc()] + [F.col(t).asc() for t in tie_break]
    fn = F.rank if ties else F.row_number
    if salts is None:
        conf = df.sparkSession.conf
        limit = int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
        salts = 0 if 0 < n <= limit else int(conf.get("spark.sql.shuffle.partitions"))
    if salts and salts > 1:
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts))  # by row, so equal rows spread too
        w1 = Window.partitionBy(*groups, salt).orderBy(*ordering)
        df = df.withColumn("__r1", fn().over(w1)).where(F.col("__r1") <= n).drop("__r1")
    w = Window.partitionBy(*groups).orderBy(*ordering)
    return df.withColumn(rank_col, fn().over(w).cast("long")).where(F.col(rank_col) <= n)


# ----------------------------------------------------------------------------- W2, W9
def yoy_growth(df: DataFrame, period: str, value: str, total: str = "total_funding",
               count: str = "deal_count", prior: str = "prior_year_funding",
               pct: str = "yoy_growth_pct", decimals: int = 1) -> DataFrame:
    """Per-period sum and count, previous present period (``LAG``) and growth %.

    The growth uses PostgreSQL-style ``ROUND`` (half away from zero).
    """
    agg = df.groupBy(period).agg(F.sum(F.col(value).cast("decimal(18,2)")).alias(total),
                                 F.count(F.lit(1)).alias(count))
    w = small_window([period])  # one row per period
    prev = F.lag(total).over(w)
    return agg.select(period, F.col(total).cast("double").alias(total), count,
                      prev.cast("double").alias(prior),
                      F.round(F.try_divide((F.col(total) - prev).cast("double"), prev.cast("double")) * 100,
                              decimals).alias(pct))


def pct_change(df: DataFrame, order: str, value: str, name: str = "pct_change") -> DataFrame:
    """Change from the previous row, ``(x - prev) / prev``, over rows of any number."""
    out = global_lag(df, [order], value, "__prev")
    return out.withColumn(name, F.try_divide(F.col(value) - F.col("__prev"), F.col("__prev").cast("double"))).drop("__prev")


# ----------------------------------------------------------------------------- W3, W4
def pareto(df: DataFrame, key: str, value: str, total: str = "total_funding",
           rank_col: str = "rank", pct: str = "pct_of_total", cum: str = "cumulative_pct",
           decimals: int = 2) -> DataFrame:
    """Totals per key, rank, share and cumulative share of the grand total.

    Keys with equal totals share the cumulative value; rank and running total
    stay with the rows of the keys, however many share a total.
    """
    agg = df.groupBy(key).agg(F.sum(F.col(value).cast("decimal(18,2)")).alias("__t"))
    ranked = attach_row(global_rank(agg, "__t", rank_col, cumulative="__cum"), agg.agg(F.sum("__t").alias("__all")))
    grand = F.col("__all").cast("double")
    return ranked.select(key, F.col("__t").cast("double").alias(total), rank_col,
                         F.round(F.col("__t").cast("double") / grand * 100, decimals).alias(pct),
                         F.round(F.col("__cum").cast("double") / grand * 100, decimals).alias(cum))


def pareto_rowwise(df: DataFrame, key: str, value: str, total: str = "total_funding",
                   rank_col: str = "rank", pct: str = "pct_of_total", cum: str = "cumulative_pct",
                   decimals: int = 2) -> DataFrame:
    """Running sum of already-rounded shares, row by row, ties by key."""
    agg = df.groupBy(key).agg(F.sum(F.col(value).cast("decimal(18,2)")).alias(total))
    with_all = attach_row(agg, agg.agg(F.sum(total).alias("__all")))
    share = F.round(F.col(total).cast("double") / F.col("__all").cast("double") * 100, decimals)
    ranked = global_ranks(with_all.withColumn(pct, share).drop("__all"), {rank_col: total})
    out = running_totals(ranked, [F.col(total).desc(), F.col(key).asc()], [pct], prefix="__cum_")
    return out.select(key, F.col(total).cast("double").alias(total), rank_col, pct,
                      F.round(F.col("__cum_" + pct), decimals).alias(cum))


# ----------------------------------------------------------------------------- W5, W6
def ntile(df: DataFrame, order: Sequence, buckets: int = 10, name: str = "ntile") -> DataFrame:
    """W5 over all rows: SQL ``NTILE`` in ascending ``order`` (a total order).

    Distributed: a global row number from a range-partitioned sort plus the
    row count; no single-partition window.
    """
    numbered = global_row_number(df, order, "__pos")
    n = df.count()
    return numbered.withColumn(name, ntile_of_position(F.col("__pos"), F.lit(n), buckets)).drop("__pos")


def decile_top(df: DataFrame, value: str, key: str, n: int, buckets: int = 10,
               name: str = "decile") -> DataFrame:
    """W5 as queried: the ``n`` largest rows with their ``NTILE`` (ascending
    by value, then key).  Needs only the row count and a top-n — no sort of
    the whole table."""
    total = df.count()
    top = df.orderBy(F.col(value).desc(), F.col(key).desc()).limit(n)
    pos_desc = F.row_number().over(small_window([F.col(value).desc(), F.col(key).desc()]))
    pos = F.lit(total) - pos_desc + 1
    return top.withColumn(name, ntile_of_position(pos, F.lit(total), buckets))


def quantile_bins(df: DataFrame, value: str, q: int = 10, name: str = "bin",
                  reverse: bool = False) -> DataFrame:
    """Bins between the distinct ``i/q`` percentile edges (equal values
    share a bin, duplicate edges merged, like ``qcut(duplicates='drop')``).

    Bin = number of distinct interior edges strictly below the value, plus
    one; edges are the exact percentiles (bounded: ``q + 1`` values).
    """
    from .ordering import group_quantiles
    probs = {f"e{i}": i / q for i in range(q + 1)}
    edges = group_quantiles(df, [], value, probs).collect()
    if not edges:
        return df.withColumn(name, F.lit(None).cast("long"))
    e = sorted({float(edges[0][k]) for k in probs})
    inner = e[1:-1]
    nb = len(e) - 1
    b = sum((F.when(F.col(value) > F.lit(x), 1).otherwise(0) for x in inner), F.lit(1))
    b = F.when(F.col(value).isNotNull(), b)
    if reverse:
        b = F.lit(nb + 1) - b
    return df.withColumn(name, b.cast("long"))


# ----------------------------------------------------------------------------- W7, W16, W17
def global_ranks(df: DataFrame, specs: dict[str, str], dense: bool = False) -> DataFrame:
    """One ``RANK`` (ties skip; ``dense`` for ``DENSE_RANK``) per
    ``{rank_name: value_column}``, descending, nulls last.

    The rows are range-partitioned by the value and keep their rank; a value
    that a third of all rows share is spread like any other (``global_rank``).
    """
    out = df
    for name, value in specs.items():
        out = global_rank(out, value, name, dense)
    return out.select(*df.columns, *specs)


def percent_below(df: DataFrame, value: str, reference: DataFrame, column: str,
                  name: str = "percentile") -> DataFrame:
    """Percentage of the non-null ``column`` values of ``reference`` that are
    strictly below each row's ``value`` (null where the value is null or
    there is nothing to compare with).

    Both sides are counted per distinct value first; one running count over
    the values answers for all rows.
    """
    known = reference.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("__v")).agg(
        F.count(F.lit(1)).alias("__n"))
    asked = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("__v"), F.lit(0).cast("long").alias("__n"))
    per = known.unionByName(asked).groupBy("__v").agg(F.sum("__n").alias("__n"))
    below = running_totals(per, ["__v"], ["__n"], prefix="__to").select(
        "__v", (F.col("__to__n") - F.col("__n")).alias("__below"))
    out = attach_row(df.join(below, F.col(value).cast("double") == F.col("__v"), "left"),
                     known.agg(F.sum("__n").alias("__all")))
    pct = F.try_divide(F.col("__below").cast("double"), F.col("__all").cast("double")) * 100
    return out.withColumn(name, pct).drop("__v", "__below", "__all")


def top_n_share(df: DataFrame, key: str, value: str, n: int, ties: bool = True,
                name: str = "top_share") -> DataFrame:
    """Share of the grand total held by the top ``n`` keys (``TOPN``
    keeps ties; ``ties=False`` is ``head(n)`` with a key tie-break).

    No ranking of all keys: an ordered ``limit`` (per-partition top-n, then
    a merge of at most ``n`` rows per partition) gives the top keys.  With
    ties their smallest total is the threshold (a key ranks within ``n`` iff
    its total reaches the ``n``-th largest), applied in one conditional sum.
    """
    agg = df.groupBy(key).agg(F.sum(F.col(value).cast("decimal(18,2)")).alias("__t"))
    top = agg.orderBy(F.col("__t").desc_nulls_last(), F.col(key).asc()).limit(n)
    if ties:
        cut = attach_row(agg, top.agg(F.min("__t").alias("__cut")))
        share = F.sum(F.when(F.col("__t") >= F.col("__cut"), F.col("__t"))).cast("double") / \
            F.sum("__t").cast("double")
        return cut.agg(share.alias(name))
    top_sum = top.agg(F.sum("__t").alias("__top"))
    with_grand = attach_row(top_sum, agg.agg(F.sum("__t").alias("__all")))
    return with_grand.select((F.col("__top").cast("double") / F.col("__all").cast("double")).alias(name))


# ----------------------------------------------------------------------------- W10–W15
def month_series(df: DataFrame, date_col: str, value: str, total: str = "total",
                 count: str = "deals") -> DataFrame:
    """Monthly totals (the grain of time intelligence): month start, year,
    quarter, sum and count."""
    m = F.trunc(F.col(date_col), "month")
    return (df.groupBy(m.alias("month_start"))
              .agg(F.sum(F.col(value).cast("decimal(18,2)")).alias(total),
                   F.count(F.lit(1)).alias(count))
              .select("month_start", F.year("month_start").alias("year"),
                      F.quarter("month_start").alias("quarter"), total, count))


def ytd(monthly: DataFrame, total: str = "total", name: str = "ytd") -> DataFrame:
    """Year-to-date running total at month grain."""
    w = Window.partitionBy("year").orderBy("month_start").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.withColumn(name, F.sum(total).over(w))


def same_period_last_year(monthly: DataFrame, total: str = "total", count: str = "deals",
                          prior: str = "prior_year", prior_count: str = "prior_year_deals",
                          pct: str = "yoy_pct", count_pct: str = "deals_yoy_pct") -> DataFrame:
    """Calendar-true prior-year value (self-join on month − 12), YoY %.

    Unlike ``LAG`` a missing month or year gives null, never a wrong period.
    """
    prev = monthly.select(F.add_months("month_start", 12).alias("month_start"),
                          F.col(total).alias(prior), F.col(count).alias(prior_count))
    j = monthly.join(prev, "month_start", "left")
    return j.withColumn(pct, F.try_divide((F.col(total) - F.col(prior)).cast("double"),
                                          F.col(prior).cast("double")) * 100) \
            .withColumn(count_pct, F.try_divide((F.col(count) - F.col(prior_count)).cast("double"),
                                                F.col(prior_count).cast("double")) * 100)


def quarterly(df: DataFrame, date_col: str, value: str, total: str = "total") -> DataFrame:
    q = F.trunc(F.col(date_col), "quarter")
    return df.groupBy(q.alias("quarter_start")).agg(F.sum(F.col(value).cast("decimal(18,2)")).alias(total))


def qoq_growth(quarters: DataFrame, total: str = "total", prior: str = "prior_quarter",
               pct: str = "qoq_pct") -> DataFrame:
    """Calendar-true previous quarter (self-join on quarter − 3 months)."""
    prev = quarters.select(F.add_months("quarter_start", 3).alias("quarter_start"),
                           F.col(total).alias(prior))
    return quarters.join(prev, "quarter_start", "left").withColumn(
        pct, F.try_divide((F.col(total) - F.col(prior)).cast("double"), F.col(prior).cast("double")) * 100)


def rolling_months(monthly: DataFrame, months: int = 12, total: str = "total",
                   name: str = "rolling_12m") -> DataFrame:
    """Sum over the trailing ``months`` calendar months (missing months
    count as empty) — a ``RANGE`` frame on a month index."""
    idx = F.year("month_start") * 12 + F.month("month_start")
    w = small_window([idx]).rangeBetween(-(months - 1), 0)
    return monthly.withColumn(name, F.sum(total).over(w))


def cagr(monthly: DataFrame, start_year: int, end_year: int, total: str = "total",
         name: str = "cagr") -> DataFrame:
    """Compound annual growth between two years' totals, guarded
    (null when a total is missing or not positive, or the span is not positive)."""
    s = F.sum(F.when(F.col("year") == start_year, F.col(total))).cast("double")
    e = F.sum(F.when(F.col("year") == end_year, F.col(total))).cast("double")
    n = end_year - start_year
    val = F.when((s > 0) & (e > 0) & F.lit(n > 0), F.pow(e / s, F.lit(1.0 / n if n else 1.0)) - 1)
    return monthly.agg(val.alias(name))


def cumulative(df: DataFrame, order: str, value: str, name: str = "cumulative",
               pct: str = "cumulative_pct") -> DataFrame:
    """Running total in time order (a total order) and its share of the grand total, over rows of any number."""
    run = running_totals(df, [order], [value], prefix="__run_").withColumnRenamed(f"__run_{value}", name)
    out = attach_row(run, df.agg(F.sum(value).alias("__all")))
    return out.withColumn(pct, F.col(name).cast("double") / F.col("__all").cast("double") * 100).drop("__all")


# ----------------------------------------------------------------------------- T1–T4
def order_limit(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """Top-``n`` rows (planned as ``TakeOrderedAndProject``: a
    per-partition top-n, then a merge — never a full sort)."""
    return df.orderBy(*[_c(o) for o in order]).limit(n)


def page(df: DataFrame, order: Sequence, size: int, number: int) -> DataFrame:
    """Page ``number`` (1-based) of ``size`` rows in ``order``."""
    return df.orderBy(*[_c(o) for o in order]).offset((number - 1) * size).limit(size)
