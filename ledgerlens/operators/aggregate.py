"""Aggregations.

All aggregates are algebraic (partial aggregation map-side) except medians
and quantiles, which go through the exact distributed
:func:`ledgerlens.operators.ordering.group_quantiles` instead of Spark's
per-group value maps, so a hot group never has to fit in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import attach_row, group_quantiles, small_window, with_quantiles


def _money(c):
    return F.col(c).cast("decimal(18,2)")


def _rate(num, den):
    return F.col(num).cast("double") / F.col(den).cast("double")


# ----------------------------------------------------------------------------- A1
def scale_kpis(df: DataFrame, value: str, flag: str | None = None,
               distinct: Sequence[str] = (), rows: str = "rows") -> DataFrame:
    """A1: one-row KPI table: rows, sum, non-null count and %, median, mean,
    distinct counts, flag total."""
    aggs = [F.count(F.lit(1)).alias(rows),
            F.sum(_money(value)).cast("double").alias("total"),
            F.count(value).alias("non_null"),
            (F.count(value).cast("double") / F.count(F.lit(1)).cast("double") * 100).alias("non_null_pct"),
            (F.sum(_money(value)).cast("double") / F.count(value).cast("double")).alias("mean")]
    aggs += [F.count_distinct(c).alias(f"distinct_{c}") for c in distinct]
    if flag:
        aggs.append(F.count_if(F.col(flag)).alias(f"{flag}_total"))
    base = df.agg(*aggs)
    return with_quantiles(base, df, [], value, {"median": 0.5})


# ----------------------------------------------------------------------------- A2
def value_counts(df: DataFrame, column: str, dropna: bool = True, n: int | None = None,
                 count: str = "count") -> DataFrame:
    """A2: rows per value, most frequent first (ties by value); ``head(n)``."""
    src = df.where(F.col(column).isNotNull()) if dropna else df
    out = src.groupBy(column).agg(F.count(F.lit(1)).alias(count))
    if n is not None:
        out = out.orderBy(F.col(count).desc(), F.col(column).asc_nulls_first()).limit(n)
    return out


# ----------------------------------------------------------------------------- A3
def yearly_trend(df: DataFrame, year: str, value: str, lo: int | None = None, hi: int | None = None,
                 median: bool = True) -> DataFrame:
    """A3: per year: total, deals, median and % change of the total versus
    the previous present year (bounded: one row per year)."""
    src = df
    if lo is not None:
        src = src.where(F.col(year) >= lo)
    if hi is not None:
        src = src.where(F.col(year) <= hi)
    agg = src.groupBy(year).agg(F.sum(_money(value)).cast("double").alias("total"),
                                F.count(F.lit(1)).alias("deals"))
    if median:
        agg = with_quantiles(agg, src, [year], value, {"median": 0.5})
    prev = F.lag("total").over(small_window([year]))
    return agg.withColumn("change_pct", F.try_divide(F.col("total") - prev, prev) * 100)


# ----------------------------------------------------------------------------- A4
def peak(df: DataFrame, key: str, value: str) -> DataFrame:
    """A4: the key at the maximum value (ties: smallest key)."""
    return df.agg(F.min_by(key, F.struct((-F.col(value)).alias("v"), F.col(key).alias("k")))
                  .alias(key), F.max(value).alias(value))


# ----------------------------------------------------------------------------- A5, A8
def group_profile(df: DataFrame, by: str | Sequence[str], value: str, flag: str | None = None,
                  min_n: int = 0, median: bool = True) -> DataFrame:
    """A5: count, sum, median, mean, flag rate and count per group; groups
    below ``min_n`` rows dropped (HAVING, A13)."""
    by = [by] if isinstance(by, str) else list(by)
    aggs = [F.count(F.lit(1)).alias("n"),
            F.sum(_money(value)).cast("double").alias("total"),
            (F.sum(_money(value)).cast("double") / F.count(value).cast("double")).alias("mean")]
    if flag:
        aggs += [F.avg(F.col(flag).cast("double")).alias("flag_rate"),
                 F.count_if(F.col(flag)).alias("flag_count")]
    agg = df.groupBy(*by).agg(*aggs).where(F.col("n") >= min_n)
    if median:
        agg = with_quantiles(agg, df, by, value, {"median": 0.5})
    return agg


def mean_by(df: DataFrame, by: str, value: str, name: str = "mean") -> DataFrame:
    """Mean per group, highest first."""
    return df.groupBy(by).agg(F.avg(F.col(value).cast("double")).alias(name))


# ----------------------------------------------------------------------------- A6, A14
def share_of_total(agg: DataFrame, column: str, name: str = "share_pct",
                   decimals: int | None = None) -> DataFrame:
    """Each row's share of the column total."""
    with_total = attach_row(agg, agg.agg(F.sum(column).alias("__total")))
    pct = F.col(column).cast("double") * 100 / F.col("__total").cast("double")
    return with_total.withColumn(name, F.round(pct, decimals) if decimals is not None else pct).drop("__total")


def group_share(df: DataFrame, by: str, value: str, total: str = "total",
                name: str = "share_pct") -> DataFrame:
    """Per group total and its share of the grand total."""
    agg = df.groupBy(by).agg(F.sum(_money(value)).cast("double").alias(total),
                             F.count(F.lit(1)).alias("n"))
    return share_of_total(agg, total, name)


def value_share(df: DataFrame, column: str, value, name: str = "share") -> DataFrame:
    """Share of rows whose ``column`` equals ``value``."""
    return df.agg((F.count_if(F.col(column) == F.lit(value)).cast("double") /
                   F.count(F.lit(1)).cast("double")).alias(name))


# ----------------------------------------------------------------------------- A7, A13
def city_hubs(df: DataFrame, keys: Sequence[str], value: str, min_n: int = 20) -> DataFrame:
    """Entity count, total and mean (rounded to units) per place, with
    at least ``min_n`` entities."""
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("startup_count"),
                                F.sum(_money(value)).alias("total_funding"))
    return agg.where(F.col("startup_count") >= min_n).withColumn(
        "avg_funding_per_startup",
        F.round(F.col("total_funding").cast("double") / F.col("startup_count").cast("double"), 0))


# ----------------------------------------------------------------------------- A10
def outcome_summary(df: DataFrame, flags: Sequence[str], value: str,
                    conditions: Mapping[str, str]) -> DataFrame:
    """A10: rate of each flag and the median of ``value`` where each
    condition (a boolean column) holds."""
    aggs = [F.avg(F.col(f).cast("double")).alias(f"{f}_rate") for f in flags]
    base = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    for name, cond in conditions.items():
        base = with_quantiles(base, df.where(F.col(cond)), [], value, {name: 0.5})
    return base


# ----------------------------------------------------------------------------- A11
def cohort_profile(df: DataFrame, year: str, value: str, flag: str | None = None,
                   width: int = 5) -> DataFrame:
    """Per ``width``-year cohort: count, mean, median, flag rate."""
    from ..functions.columns import bucket_floor
    src = df.where(F.col(year).isNotNull()).withColumn("cohort", bucket_floor(year, width))
    aggs = [F.count(F.lit(1)).alias("n"),
            (F.sum(_money(value)).cast("double") / F.count(value).cast("double")).alias("mean")]
    if flag:
        aggs.append(F.avg(F.col(flag).cast("double")).alias("flag_rate"))
    agg = src.groupBy("cohort").agg(*aggs)
    return with_quantiles(agg, src, ["cohort"], value, {"median": 0.5})


# ----------------------------------------------------------------------------- A12
def conditional_rates(df: DataFrame, by: str | Sequence[str], flags: Mapping[str, str],
                      total: str = "total", min_n: int = 0, decimals: int | None = 1,
                      rate_names: Mapping[str, str] | None = None) -> DataFrame:
    """Per group row count, ``count(*) FILTER (WHERE flag)`` per flag and
    their rates in percent (half away from zero), groups below ``min_n`` dropped."""
    by = [by] if isinstance(by, str) else list(by)
    rate_names = rate_names or {k: f"{k}_rate_pct" for k in flags}
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias(total),
                              *[F.count_if(F.col(f)).alias(f"{k}_count") for k, f in flags.items()])
    agg = agg.where(F.col(total) >= min_n)
    for k in flags:
        r = _rate(f"{k}_count", total) * 100
        agg = agg.withColumn(rate_names[k], F.round(r, decimals) if decimals is not None else r)
    return agg


# ----------------------------------------------------------------------------- A15
def mode_by(df: DataFrame, by: str | Sequence[str], column: str, name: str = "mode") -> DataFrame:
    """Most frequent non-null value per group, the smallest on ties.

    Value counts are combined map-side per (group, value); the pick is a
    ``min`` over ``(-count, value)`` — no per-group value map.
    """
    by = [by] if isinstance(by, str) else list(by)
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("__n"))
    best = counts.groupBy(*by).agg(F.min(F.struct((-F.col("__n")).alias("n"), F.col(column).alias("v")))
                                   .alias("__b"))
    return best.select(*by, F.col("__b.v").alias(name))


# ----------------------------------------------------------------------------- A16
def quantiles(df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact linear quantiles (``PERCENTILEX.INC`` / ``quantile_cont``),
    in columns ``p25``, ``p99``, ``p99_1``, ..."""
    def name(p: float) -> str:
        whole, _, rest = f"{p * 100:.6f}".rstrip("0").rstrip(".").partition(".")
        return f"p{int(whole):02d}" + (f"_{rest}" if rest else "")

    return group_quantiles(df, list(by), column, {name(p): p for p in probs})


def trim_below_quantile(df: DataFrame, column: str, p: float) -> DataFrame:
    """Rows whose value is at or above the ``p`` quantile."""
    q = group_quantiles(df, [], column, {"__q": p})
    return attach_row(df, q).where(F.col(column) >= F.col("__q")).drop("__q")


# ----------------------------------------------------------------------------- A17
def skewness(df: DataFrame, column: str, by: Sequence[str] = (), log1p: bool = False,
             name: str = "skewness") -> DataFrame:
    """Bias-adjusted sample skewness (pandas/DuckDB definition),
    ``g1 * sqrt(n(n-1)) / (n-2)``.

    ``g1`` is Spark's ``skewness``: central moments merged pairwise across
    partial aggregates (numerically stable), not raw power sums, whose
    cancellation on large money values grows with the row count.
    """
    x = F.col(column).cast("double")
    if log1p:
        x = F.log1p(x)
    n = F.count(x)
    adj = F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))
    return (df.groupBy(*by) if by else df.groupBy()).agg(adj.alias(name))


# ----------------------------------------------------------------------------- A18
def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between min and max; the last bin is closed.

    Returns ``(bin, lo, hi, count)`` for every bin (empty bins included).
    """
    x = F.col(column).cast("double")
    bounds = df.agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"))
    src = df.select(x.alias("__x")).where(F.col("__x").isNotNull())
    j = attach_row(src, bounds)
    width = (F.col("__hi") - F.col("__lo")) / bins
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("__x") - F.col("__lo")) / width), F.lit(bins - 1))).cast("int")
    counts = j.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    edges = attach_row(all_bins, bounds)
    w = (F.col("__hi") - F.col("__lo")) / bins
    edges = edges.select("bin", (F.col("__lo") + F.col("bin") * w).alias("lo"),
                         (F.col("__lo") + (F.col("bin") + 1) * w).alias("hi"))
    return edges.join(counts, "bin", "left").na.fill(0, ["count"])


# ----------------------------------------------------------------------------- A19
def five_number_summary(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Min, q1, median, q3, max, IQR and Tukey whiskers (the most
    extreme values within 1.5 IQR of the quartiles) per group."""
    by = list(by)
    q = group_quantiles(df, by, column, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    mm = (df.groupBy(*by) if by else df.groupBy()).agg(F.min(F.col(column).cast("double")).alias("min"),
                                                     F.max(F.col(column).cast("double")).alias("max"))
    if by:
        box = mm.join(q, by, "inner")
    else:
        box = attach_row(mm, q)
    box = box.withColumn("iqr", F.col("q3") - F.col("q1"))
    x = F.col(column).cast("double")
    if by:
        j = df.select(*by, x.alias("__x")).join(box.select(*by, "q1", "q3", "iqr"), by, "inner")
    else:
        j = attach_row(df.select(x.alias("__x")), box.select("q1", "q3", "iqr"))
    inside = (F.col("__x") >= F.col("q1") - 1.5 * F.col("iqr")) & (F.col("__x") <= F.col("q3") + 1.5 * F.col("iqr"))
    wh = (j.groupBy(*by) if by else j.groupBy()).agg(
        F.min(F.when(inside, F.col("__x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("__x"))).alias("whisker_hi"))
    if by:
        return box.join(wh, by, "inner")
    return attach_row(box, wh)


# ----------------------------------------------------------------------------- A20
def drilldown_totals(df: DataFrame, date_col: str, value: str) -> DataFrame:
    """Year → quarter → month totals with subtotals (``ROLLUP``)."""
    d = F.col(date_col)
    src = df.select(F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
                    _money(value).alias("__v"))
    return (src.rollup("year", "quarter", "month")
               .agg(F.sum("__v").cast("double").alias("total"), F.count(F.lit(1)).alias("deals"),
                    F.grouping_id().alias("level")))


# ----------------------------------------------------------------------------- A21, A23
def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlations on rows complete in all ``cols``, long form
    ``(x, y, r)`` for every ordered pair."""
    src = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).na.drop(subset=list(cols))
    aggs = [F.corr(a, b).alias(f"{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    row = src.agg(*aggs) if aggs else None
    spark = df.sparkSession
    pairs = [(a, b, f"{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    stack = ", ".join(f"'{a}', '{b}', `{k}`" for a, b, k in pairs)
    long = row.selectExpr(f"stack({len(pairs)}, {stack}) as (x, y, r)") if pairs else None
    sym = long.unionByName(long.select(F.col("y").alias("x"), F.col("x").alias("y"), "r"))
    diag = spark.createDataFrame([(c, c, 1.0) for c in cols], "x string, y string, r double")
    return sym.unionByName(diag)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean and sample standard deviation per column (long form, numeric)."""
    wide = df.agg(*[a for i, c in enumerate(cols) for a in (
        F.count(c).alias(f"n{i}"), F.avg(F.col(c).cast("double")).alias(f"m{i}"),
        F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}"))])
    rows = ", ".join(f"'{c}', n{i}, m{i}, s{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {rows}) AS (column, count, mean, std)")


# ----------------------------------------------------------------------------- A22, A24
def percent_below(df: DataFrame, column: str, value: float, name: str = "pct_below") -> DataFrame:
    """Percent of non-null values strictly below ``value``."""
    x = F.col(column)
    return df.where(x.isNotNull()).agg((F.avg((x < F.lit(value)).cast("double")) * 100).alias(name))


def filtered_summary(df: DataFrame, condition, value: str, flag: str | None = None) -> DataFrame:
    """For the filtered rows: n, % of all rows, total, median, flag rate."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    aggs = [F.count_if(cond).alias("n"),
            (F.count_if(cond).cast("double") / F.count(F.lit(1)).cast("double") * 100).alias("pct_of_all"),
            F.sum(F.when(cond, _money(value))).cast("double").alias("total")]
    if flag:
        aggs.append((F.sum(F.when(cond, F.col(flag).cast("double"))) /
                     F.count_if(cond).cast("double")).alias("flag_rate"))
    base = df.agg(*aggs)
    return with_quantiles(base, df.where(cond), [], value, {"median": 0.5})
