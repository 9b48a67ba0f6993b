"""Inferential statistics.

Pattern: Spark computes sufficient statistics — counts, sums, moments,
rank sums, cross-products — in one or a few aggregations and returns them
as a (small) DataFrame; ``*_test`` helpers collect that bounded result and
turn it into p-values with :mod:`ledgerlens.operators.dist`.

Rank statistics (Mann–Whitney, Kruskal–Wallis) rank *distinct values*: a
per-value count table, then distributed running totals — the average rank
of a value is ``rows before it + (ties + 1) / 2``.  No row-level sort into
one partition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dist
from .joins import semi_join_top_n
from .ordering import attach_row, group_quantiles, running_totals


def _x(c):
    return F.col(c).cast("double")


def _one_row(df: DataFrame) -> dict:
    return df.first().asDict()


# ----------------------------------------------------------------------------- H1, H3
def mean_stats(df: DataFrame, col: str) -> DataFrame:
    """H1 sufficient statistics: n, mean, sample sd, standard error."""
    x = _x(col)
    return df.agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd")) \
             .withColumn("se", F.col("sd") / F.sqrt(F.col("n")))


def mean_ci(df: DataFrame, col: str, conf: float = 0.95) -> dict:
    """H1: Student-t confidence interval of the mean."""
    s = _one_row(mean_stats(df, col))
    t = dist.t_ppf(0.5 + conf / 2, s["n"] - 1)
    return {**s, "lo": s["mean"] - t * s["se"], "hi": s["mean"] + t * s["se"], "t_crit": t}


def proportion_stats(df: DataFrame, flag: str) -> DataFrame:
    """H3 sufficient statistics: successes, n, proportion, standard error."""
    f = F.col(flag).cast("double")
    out = df.agg(F.sum(f).alias("successes"), F.count(f).alias("n"))
    p = F.col("successes") / F.col("n")
    return out.withColumn("p", p).withColumn("se", F.sqrt(p * (1 - p) / F.col("n")))


def proportion_ci(df: DataFrame, flag: str, conf: float = 0.95) -> dict:
    """H3: normal-approximation interval of a proportion."""
    s = _one_row(proportion_stats(df, flag))
    z = dist.norm_ppf(0.5 + conf / 2)
    return {**s, "lo": s["p"] - z * s["se"], "hi": s["p"] + z * s["se"]}


# ----------------------------------------------------------------------------- H2
def median_ci(df: DataFrame, col: str, conf: float = 0.95) -> dict:
    """H2 at scale: distribution-free interval of the median — the order
    statistics at the binomial(n, ½) quantile positions (the limit of the
    percentile bootstrap of the median).  One count, one distributed sort."""
    n = df.where(F.col(col).isNotNull()).count()
    if n < 2:
        return {"n": n, "median": None, "lo": None, "hi": None}
    z = dist.norm_ppf(0.5 + conf / 2)
    j = max(1, int(math.floor(n / 2.0 - z * math.sqrt(n) / 2.0)))
    k = min(n, int(math.ceil(n / 2.0 + 1 + z * math.sqrt(n) / 2.0)))
    probs = {"lo": (j - 1) / (n - 1), "median": 0.5, "hi": (k - 1) / (n - 1)}
    q = _one_row(group_quantiles(df, [], col, probs))
    return {"n": n, **q}


def bootstrap_median_ci(df: DataFrame, col: str, conf: float = 0.95, replicates: int = 2000, seed: int = 42) -> dict:
    """H2: percentile bootstrap of the median, ``replicates`` resamples of all non-null values.

    A resample of n values draws n places of the ordered values; its median
    needs only the middle one or two of those places.  The j-th smallest of n
    uniform places is Beta(j, n + 1 - j) distributed, and the next one takes
    a Beta(1, n - j) share of what is left above it, so each replicate's
    middle places are drawn outright, in distribution as by resampling.  What
    travels is two places per replicate; the values come from one running
    count over the distinct values, cut into slots of places so that a task
    holds few of either.
    """
    base = df.select(_x(col).alias("v")).where(F.col("v").isNotNull())
    spans = running_totals(base.groupBy("v").agg(F.count(F.lit(1)).alias("n")), ["v"], ["n"], prefix="to_")
    spans = spans.select("v", (F.col("to_n") - F.col("n")).alias("lo"), F.col("to_n").alias("hi"))
    n = spans.agg(F.max("hi")).first()[0] or 0
    empty = {"n": n, "replicates": replicates, "median": None, "lo": None, "hi": None}
    if n < 2:
        return empty
    rng = np.random.default_rng(seed)
    j = (n + 1) // 2  # the middle place, or the lower of two
    low = rng.beta(j, n + 1 - j, replicates)
    high = low if n % 2 else low + (1 - low) * rng.beta(1, n - j, replicates)
    places = [(i, int(min(n - 1, p * n))) for side in (low, high) for i, p in enumerate(side)]
    first, last = min(p for _, p in places), max(p for _, p in places)
    slot = (last - first) // replicates + 1
    asked = df.sparkSession.createDataFrame(places, "replicate int, place long").withColumn(
        "slot", F.expr(f"(place - {first}) div {slot}"))
    near = spans.where((F.col("hi") > first) & (F.col("lo") <= last)).withColumn("slot", F.explode(F.sequence(
        F.expr(f"(greatest(lo, {first}L) - {first}) div {slot}"), F.expr(f"(least(hi - 1, {last}L) - {first}) div {slot}"))))
    medians = asked.join(near, "slot").where("place >= lo AND place < hi").groupBy("replicate").agg(F.avg("v").alias("m"))
    tail = (1 - conf) / 2
    ends = _one_row(medians.agg(F.percentile("m", tail).alias("lo"), F.percentile("m", 1 - tail).alias("hi")))
    return {**empty, **_one_row(group_quantiles(base, [], "v", {"median": 0.5})), **ends}


# ----------------------------------------------------------------------------- H4, H9, H10
def two_group_stats(df: DataFrame, col: str, flag: str) -> DataFrame:
    """n, mean, sample variance of ``col`` where ``flag`` is true (1) / not true (0)."""
    x = _x(col)
    g1 = F.coalesce(F.col(flag), F.lit(False))
    return df.agg(F.count(F.when(g1, x)).alias("n1"), F.avg(F.when(g1, x)).alias("mean1"),
                  F.var_samp(F.when(g1, x)).alias("var1"),
                  F.count(F.when(~g1, x)).alias("n0"), F.avg(F.when(~g1, x)).alias("mean0"),
                  F.var_samp(F.when(~g1, x)).alias("var0"))


def welch_stats(df: DataFrame, col: str, flag: str) -> DataFrame:
    """Welch t, its degrees of freedom, Cohen's d (pooled), difference."""
    s = two_group_stats(df, col, flag)
    a, b = F.col("var1") / F.col("n1"), F.col("var0") / F.col("n0")
    pooled = F.sqrt(((F.col("n1") - 1) * F.col("var1") + (F.col("n0") - 1) * F.col("var0"))
                    / (F.col("n1") + F.col("n0") - 2))
    return s.select("*", (F.col("mean1") - F.col("mean0")).alias("diff"),
                    ((F.col("mean1") - F.col("mean0")) / F.sqrt(a + b)).alias("t"),
                    ((a + b) * (a + b) / (a * a / (F.col("n1") - 1) + b * b / (F.col("n0") - 1))).alias("df"),
                    ((F.col("mean1") - F.col("mean0")) / pooled).alias("cohens_d"))


def welch_t(df: DataFrame, col: str, flag: str, conf: float = 0.95) -> dict:
    """The Welch test with its p, and the interval of the difference."""
    s = mean_difference_ci(df, col, flag, conf)
    return {**s, "p": dist.t_two_sided(s["t"], s["df"])}


def mean_difference_ci(df: DataFrame, col: str, flag: str, conf: float = 0.95) -> dict:
    """H4: Welch interval of the difference of means."""
    s = _one_row(welch_stats(df, col, flag))
    se = math.sqrt(s["var1"] / s["n1"] + s["var0"] / s["n0"])
    t = dist.t_ppf(0.5 + conf / 2, s["df"])
    return {**s, "lo": s["diff"] - t * se, "hi": s["diff"] + t * se}


# ----------------------------------------------------------------------------- H5
def two_proportion_stats(df: DataFrame, flag: str, group: str, value) -> DataFrame:
    """H5: pooled two-proportion z; rows whose group is null count as 'not the group'."""
    in_g = F.col(group).eqNullSafe(F.lit(value))
    f = F.coalesce(F.col(flag), F.lit(False)).cast("double")
    s = df.agg(F.sum(F.when(in_g, f)).alias("x1"), F.count_if(in_g).alias("n1"),
               F.sum(F.when(~in_g, f)).alias("x0"), F.count_if(~in_g).alias("n0"))
    p1, p0 = F.col("x1") / F.col("n1"), F.col("x0") / F.col("n0")
    pp = (F.col("x1") + F.col("x0")) / (F.col("n1") + F.col("n0"))
    z = (p1 - p0) / F.sqrt(pp * (1 - pp) * (1 / F.col("n1") + 1 / F.col("n0")))
    return s.select("*", p1.alias("p1"), p0.alias("p0"), z.alias("z"))


def two_proportion_z(df: DataFrame, flag: str, group: str, value) -> dict:
    s = _one_row(two_proportion_stats(df, flag, group, value))
    return {**s, "p": 2 * dist.norm_sf(abs(s["z"]))}


# ----------------------------------------------------------------------------- H6, H7
def contingency(df: DataFrame, a: str, b: str, top_n: int | None = None) -> DataFrame:
    """H6 table: observed counts of present (a, b) pairs and expected counts
    from the margins (row and column totals via aggregates, no pair grid)."""
    src = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    if top_n:
        src = semi_join_top_n(src, a, top_n)
    obs = src.groupBy(a, b).agg(F.count(F.lit(1)).alias("observed"))
    ra = obs.groupBy(a).agg(F.sum("observed").alias("__ra"))
    cb = obs.groupBy(b).agg(F.sum("observed").alias("__cb"))
    tot = obs.agg(F.sum("observed").alias("__n"))
    j = attach_row(obs.join(ra, a).join(cb, b), tot)
    return j.select(a, b, "observed", (F.col("__ra") * F.col("__cb") / F.col("__n")).alias("expected"),
                    F.col("__n").alias("n"))


def chi_square_stats(df: DataFrame, a: str, b: str, top_n: int | None = None) -> DataFrame:
    """H6/H7: chi-square = Σ_observed o²/e − N (zero cells need no row),
    degrees of freedom, Cramér's V."""
    t = contingency(df, a, b, top_n)
    s = t.agg((F.sum(F.col("observed") * F.col("observed") / F.col("expected")) - F.first("n")).alias("chi2"),
              F.first("n").alias("n"), F.count_distinct(a).alias("rows"), F.count_distinct(b).alias("cols"))
    return s.select("*", ((F.col("rows") - 1) * (F.col("cols") - 1)).alias("dof"),
                    F.sqrt(F.col("chi2") / (F.col("n") * (F.least("rows", "cols") - 1))).alias("cramers_v"))


def chi_square(df: DataFrame, a: str, b: str, top_n: int | None = None) -> dict:
    s = _one_row(chi_square_stats(df, a, b, top_n))
    return {**s, "p": dist.chi2_sf(s["chi2"], s["dof"])}


# ----------------------------------------------------------------------------- rank tests
def _ranked_values(df: DataFrame, col: str, by: Sequence[str] = ()):
    """Per-(value, *by) counts, and the per-value table ``(value, t, avg_rank)``."""
    x = _x(col)
    per = df.where(x.isNotNull()).groupBy(x.alias("value"), *by).agg(F.count(F.lit(1)).alias("cnt"))
    vals = per.groupBy("value").agg(F.sum("cnt").alias("t"))
    cum = running_totals(vals, ["value"], ["t"], prefix="cum_")
    ranked = cum.select("value", "t", ((F.col("cum_t") - F.col("t")) + (F.col("t") + 1) / 2.0).alias("avg_rank"))
    return per, ranked


def _tie_sum(ranked: DataFrame) -> DataFrame:
    return ranked.agg(F.sum(F.pow("t", 3) - F.col("t")).alias("tie_sum"))


def value_ranks(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Average rank of every distinct value (ties share the mean rank), with
    per-group counts of that value: ``(value, *by, cnt, t, avg_rank)``."""
    per, ranked = _ranked_values(df, col, by)
    return per.join(ranked, "value")


def mann_whitney_stats(df: DataFrame, col: str, flag: str) -> DataFrame:
    """H8: U of the flagged group, mean/sd of U under H0 with tie
    correction, z with continuity correction and U/(n1·n0) (= AUC)."""
    x, g = _x(col), F.coalesce(F.col(flag), F.lit(False)).cast("boolean")
    per = df.where(x.isNotNull()).groupBy(x.alias("value")).agg(
        F.count_if(g).alias("c1"), F.count_if(~g).alias("c0"), F.count(F.lit(1)).alias("t"))
    ranked = running_totals(per, ["value"], ["t"], prefix="cum_").withColumn(
        "avg_rank", (F.col("cum_t") - F.col("t")) + (F.col("t") + 1) / 2.0)
    s = ranked.agg(F.sum(F.col("c1") * F.col("avg_rank")).alias("r1"), F.sum("c1").alias("n1"),
                   F.sum("c0").alias("n0"), F.sum(F.pow("t", 3) - F.col("t")).alias("tie_sum"))
    n = F.col("n1") + F.col("n0")
    u1 = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2.0
    mu = F.col("n1") * F.col("n0") / 2.0
    sigma = F.sqrt(F.col("n1") * F.col("n0") / 12.0 * ((n + 1) - F.col("tie_sum") / (n * (n - 1))))
    return s.select("n1", "n0", u1.alias("u"), mu.alias("mu"), sigma.alias("sigma"),
                    ((F.abs(u1 - mu) - 0.5) / sigma).alias("z"),
                    (u1 / (F.col("n1") * F.col("n0"))).alias("auc"))


def mann_whitney(df: DataFrame, col: str, flag: str) -> dict:
    s = _one_row(mann_whitney_stats(df, col, flag))
    return {**s, "p": min(1.0, 2 * dist.norm_sf(s["z"]))}


def kruskal_wallis_stats(df: DataFrame, group: str, col: str) -> DataFrame:
    """Tie-corrected Kruskal–Wallis H from per-group rank sums.

    A value travels as one row with its count in each group, so the running
    count over the values brings its rank to all of them and nothing is
    joined back; a value shared by a third of all rows stays one row.
    """
    x = _x(col)
    per = df.where(F.col(group).isNotNull() & x.isNotNull()).groupBy(x.alias("value"), group).agg(F.count(F.lit(1)).alias("cnt"))
    values = per.groupBy("value").agg(F.collect_list(F.struct(F.col(group).alias("g"), "cnt")).alias("held"), F.sum("cnt").alias("t"))
    ranked = running_totals(values, ["value"], ["t"], prefix="cum_").withColumn(
        "avg_rank", (F.col("cum_t") - F.col("t")) + (F.col("t") + 1) / 2.0)
    r = ranked.select("avg_rank", F.explode("held").alias("h")).select(F.col("h.g").alias(group), F.col("h.cnt").alias("cnt"), "avg_rank")
    g = r.groupBy(group).agg(F.sum(F.col("cnt") * F.col("avg_rank")).alias("rsum"), F.sum("cnt").alias("ng"))
    s = g.agg(F.sum(F.col("rsum") * F.col("rsum") / F.col("ng")).alias("__a"), F.sum("ng").alias("n"),
              F.count(F.lit(1)).alias("k"))
    s = attach_row(s, _tie_sum(ranked))
    n = F.col("n")
    h = 12.0 / (n * (n + 1)) * F.col("__a") - 3 * (n + 1)
    c = 1 - F.col("tie_sum") / (n * n * n - n)
    return s.select("n", "k", (h / c).alias("h"), (F.col("k") - 1).alias("dof"))


def kruskal_wallis(df: DataFrame, group: str, col: str) -> dict:
    s = _one_row(kruskal_wallis_stats(df, group, col))
    return {**s, "p": dist.chi2_sf(s["h"], s["dof"])}


# ----------------------------------------------------------------------------- H11, H12, H14, H15
def group_stats(df: DataFrame, group: str, col: str, min_n: int = 0) -> DataFrame:
    """Per group: non-null count, mean, sample variance; groups below ``min_n`` dropped."""
    x = _x(col)
    return (df.where(F.col(group).isNotNull() & x.isNotNull()).groupBy(group)
              .agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_samp(x).alias("var"))
              .where(F.col("n") >= min_n))


def anova_stats(df: DataFrame, group: str, col: str, min_n: int = 30) -> DataFrame:
    """One-way ANOVA F and eta squared from group statistics."""
    g = group_stats(df, group, col, min_n)
    tot = g.agg(F.sum("n").alias("__total"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("__grand"),
                F.count(F.lit(1)).alias("__k"))
    j = attach_row(g, tot)
    s = j.agg(F.sum(F.col("n") * F.pow(F.col("mean") - F.col("__grand"), 2)).alias("ss_between"),
              F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ss_within"),
              F.first("__total").alias("n"), F.first("__k").alias("k"))
    return s.select("*", (F.col("k") - 1).alias("df_between"), (F.col("n") - F.col("k")).alias("df_within"),
                    ((F.col("ss_between") / (F.col("k") - 1)) / (F.col("ss_within") / (F.col("n") - F.col("k"))))
                    .alias("f"),
                    (F.col("ss_between") / (F.col("ss_between") + F.col("ss_within"))).alias("eta_squared"))


def anova(df: DataFrame, group: str, col: str, min_n: int = 30) -> dict:
    s = _one_row(anova_stats(df, group, col, min_n))
    return {**s, "p": dist.f_sf(s["f"], s["df_between"], s["df_within"])}


MAX_GROUPS = 200


def bounded_groups(g: DataFrame, group: str, max_groups: int = MAX_GROUPS) -> list[dict]:
    """Group statistics as driver rows in group order.  Every pair of them is
    compared, so more than ``max_groups`` is an error: name fewer groups, or
    raise the least number of rows a group needs."""
    rows = g.orderBy(group).limit(max_groups + 1).collect()
    if len(rows) > max_groups:
        raise ValueError(f"more than {max_groups} groups of {group} to compare pairwise")
    return [r.asDict() for r in rows]


def tukey_hsd(df: DataFrame, group: str, col: str, alpha: float = 0.05, min_n: int = 0,
              max_groups: int = MAX_GROUPS) -> list[dict]:
    """Tukey–Kramer pairwise differences, studentized range q, adjusted
    p and decision for every pair of groups."""
    gs = bounded_groups(group_stats(df, group, col, min_n), group, max_groups)
    k, total = len(gs), sum(g["n"] for g in gs)
    if k < 2:
        return []
    dof = total - k
    msw = sum((g["n"] - 1) * (g["var"] or 0.0) for g in gs) / dof
    out = []
    for i, a in enumerate(gs):
        for b in gs[i + 1:]:
            diff = b["mean"] - a["mean"]
            q = abs(diff) / math.sqrt(msw / 2 * (1 / a["n"] + 1 / b["n"]))
            p = dist.tukey_sf(q, k, float(dof))
            out.append({"group_a": a[group], "group_b": b[group], "diff": diff, "q": q, "k": k, "df_within": dof,
                        "p_adj": p, "reject": p < alpha})
    return out


def pairwise_welch_bonferroni(df: DataFrame, group: str, col: str, min_n: int = 0,
                              max_groups: int = MAX_GROUPS) -> list[dict]:
    """Welch t, degrees of freedom, p and Bonferroni-adjusted p for every pair of groups."""
    gs = bounded_groups(group_stats(df, group, col, min_n), group, max_groups)
    out = []
    for i, x in enumerate(gs):
        for y in gs[i + 1:]:
            a, b = x["var"] / x["n"], y["var"] / y["n"]
            t = (x["mean"] - y["mean"]) / math.sqrt(a + b)
            dof = (a + b) ** 2 / (a * a / (x["n"] - 1) + b * b / (y["n"] - 1))
            out.append({"group_a": x[group], "group_b": y[group], "t": t, "df": dof, "p": dist.t_two_sided(t, dof)})
    for r in out:
        r["p_bonferroni"] = min(1.0, r["p"] * len(out))
    return out


# ----------------------------------------------------------------------------- H16
def pearson_stats(df: DataFrame, x: str, y: str) -> DataFrame:
    src = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    s = src.agg(F.corr(_x(x), _x(y)).alias("r"), F.count(F.lit(1)).alias("n"))
    return s.withColumn("t", F.col("r") * F.sqrt((F.col("n") - 2) / (1 - F.col("r") * F.col("r"))))


def pearson_test(df: DataFrame, x: str, y: str) -> dict:
    s = _one_row(pearson_stats(df, x, y))
    return {**s, "p": dist.t_two_sided(s["t"], s["n"] - 2)}


# ----------------------------------------------------------------------------- H17–H19, H22
MAX_LEVELS = 500


def design_levels(df: DataFrame, categorical: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list]:
    """Sorted levels of each categorical.  A design matrix needs a column per
    level, so more than ``max_levels`` is an error; group rare levels first
    (A21) or keep the ``top_n`` most frequent."""
    out = {}
    for c in categorical:
        found = df.where(F.col(c).isNotNull()).select(c).distinct().orderBy(c).limit(max_levels + 1).collect()
        if len(found) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels; group the rare ones")
        out[c] = [r[0] for r in found]
    return out


def design_columns(numeric: Sequence[str], levels: dict[str, list]):
    """Numeric columns plus one 0/1 column per non-first level of each
    categorical (the first is the reference)."""
    cols, names = [_x(c) for c in numeric], list(numeric)
    for c, own in levels.items():
        for lv in own[1:]:
            cols.append(F.when(F.col(c) == F.lit(lv), 1.0).otherwise(0.0))
            names.append(f"{c}[{lv}]")
    return cols, names


def ols(df: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str] = (),
        top_n: int | None = None) -> dict:
    """Ordinary least squares with an intercept, on the rows of the
    ``top_n`` most frequent values of each categorical if given.

    One aggregation over complete rows gives the centred cross-products
    (Spark's ``covar_pop`` / ``var_pop``: co-moments merged pairwise across
    partial aggregates, so large values do not cancel as raw ``Σx²`` sums
    would), the means and n (p² + p aggregates, combined map-side).  The
    slopes solve ``Sxx β = Sxy`` on the driver (a p×p system); the intercept
    is ``ȳ − β·x̄`` with variance ``σ²(1/n + x̄' Sxx⁻¹ x̄)``.  Returns
    coefficients (intercept first), standard errors, t, p, R², adjusted R².
    """
    need = [y, *numeric, *categorical]
    src = df.where(_all_not_null(need))
    for c in categorical if top_n else ():
        src = semi_join_top_n(src, c, top_n)
    levels = design_levels(src, categorical)
    cols, names = design_columns(numeric, levels)
    names = ["intercept"] + names
    yy = _x(y)
    k = len(cols)
    aggs = [F.covar_pop(cols[i], cols[j]).alias(f"c_{i}_{j}") for i in range(k) for j in range(i, k)]
    aggs += [F.covar_pop(cols[i], yy).alias(f"cy_{i}") for i in range(k)]
    aggs += [F.avg(cols[i]).alias(f"m_{i}") for i in range(k)]
    aggs += [F.var_pop(yy).alias("vy"), F.avg(yy).alias("my"), F.count(F.lit(1)).alias("n")]
    r = _one_row(src.agg(*aggs))
    n = r["n"]
    p = k + 1
    sxx = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            sxx[i, j] = sxx[j, i] = n * r[f"c_{i}_{j}"]
    sxy = np.array([n * r[f"cy_{i}"] for i in range(k)])
    mx = np.array([r[f"m_{i}"] for i in range(k)])
    syy = n * r["vy"]
    inv = _inverse(sxx, names[1:])
    slopes = inv @ sxy
    beta = np.concatenate([[r["my"] - slopes @ mx], slopes])
    rss = max(float(syy - slopes @ sxy), 0.0)
    tss = float(syy)
    dof = n - p
    sigma2 = rss / dof
    var = np.concatenate([[sigma2 * (1.0 / n + mx @ inv @ mx)], np.diag(inv) * sigma2])
    se = np.sqrt(np.maximum(var, 0))
    t = [float(b / s) if s > 0 else None for b, s in zip(beta, se)]  # a perfect fit has no t and no p
    r2 = 1 - rss / tss
    return {"names": names, "coef": beta.tolist(), "se": se.tolist(), "t": t,
            "p": [None if v is None else dist.t_two_sided(v, dof) for v in t], "r2": r2,
            "adj_r2": 1 - (1 - r2) * (n - 1) / dof, "n": n, "rss": rss, "sigma2": sigma2,
            "numeric": list(numeric), "levels": levels}


def _inverse(products: np.ndarray, names: Sequence[str]) -> np.ndarray:
    """The inverse of centred cross-products; columns that depend on each other raise, by name."""
    size = np.sqrt(np.diag(products))
    constant = [n for n, s in zip(names, size) if s <= 0]
    if constant:
        raise ValueError(f"constant columns cannot stand beside an intercept: {constant}")
    scaled = products / np.outer(size, size)
    values, vectors = np.linalg.eigh(scaled) if len(size) else (np.ones(1), None)
    if values[0] < 1e-12 * len(size):
        tied = [n for n, v in zip(names, vectors[:, 0]) if abs(v) > 1e-6]
        raise ValueError(f"collinear columns: {tied}")
    return np.linalg.inv(scaled) / np.outer(size, size)


def _all_not_null(cols):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def ols_spark_ml(df: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str] = ()):
    """H17 via ``LinearRegression(solver='normal')``: its training summary
    carries coefficient standard errors, t values and p values."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.regression import LinearRegression
    src = df.where(_all_not_null([y, *numeric, *categorical]))
    stages, feats = [], list(numeric)
    for c in categorical:
        stages += [StringIndexer(inputCol=c, outputCol=c + "__i", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCol=c + "__i", outputCol=c + "__v", dropLast=False)]
        feats.append(c + "__v")
    stages += [VectorAssembler(inputCols=feats, outputCol="features"),
               LinearRegression(featuresCol="features", labelCol=y, solver="normal", regParam=0.0)]
    return Pipeline(stages=stages).fit(src.withColumn(y, _x(y)))


def residual_table(df: DataFrame, y: str, fit: dict):
    """Fitted value and residual per row for an :func:`ols` fit, by the
    fit's own levels; a level the fit has not seen gives a null."""
    cols, _ = design_columns(fit["numeric"], fit["levels"])
    fitted = F.lit(fit["coef"][0])
    for b, c in zip(fit["coef"][1:], cols, strict=True):
        fitted = fitted + F.lit(b) * c
    known = F.lit(True)
    for c, own in fit["levels"].items():
        known = known & F.col(c).isin(own)
    return df.withColumn("fitted", F.when(known, fitted)).withColumn("residual", _x(y) - F.col("fitted"))


def vif(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Variance inflation factors = diagonal of the inverse correlation
    matrix (pairwise correlations from one aggregation); columns without a
    finite factor raise, by name."""
    src = df.where(_all_not_null(cols))
    k = len(cols)
    r = _one_row(src.agg(*[F.corr(_x(a), _x(b)).alias(f"c_{i}_{j}") for i, a in enumerate(cols)
                           for j, b in enumerate(cols) if i < j]))
    m = np.eye(k)
    for i in range(k):
        for j in range(i + 1, k):
            m[i, j] = m[j, i] = r[f"c_{i}_{j}"]
    inv = _inverse(m, cols)
    return {c: float(inv[i, i]) for i, c in enumerate(cols)}


def breusch_pagan(df: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str] = ()) -> dict:
    """LM = n·R² of squared residuals on the regressors; F variant."""
    fit = ols(df, y, numeric, categorical)
    res = residual_table(df.where(_all_not_null([y, *numeric, *categorical])), y, fit)
    aux = ols(res.withColumn("__e2", F.col("residual") * F.col("residual")), "__e2", numeric, categorical)
    k = len(aux["names"]) - 1
    n = aux["n"]
    lm = n * aux["r2"]
    fstat = (aux["r2"] / k) / ((1 - aux["r2"]) / (n - k - 1))
    return {"lm": lm, "lm_p": dist.chi2_sf(lm, k), "f": fstat, "f_p": dist.f_sf(fstat, k, n - k - 1)}


# ----------------------------------------------------------------------------- H20, H21
def jarque_bera_stats(df: DataFrame, col: str) -> DataFrame:
    """Jarque–Bera from population skewness and excess kurtosis (all rows)."""
    x = _x(col)
    s = df.agg(F.count(x).alias("n"), F.skewness(x).alias("skew"), F.kurtosis(x).alias("kurt"))
    return s.withColumn("jb", F.col("n") / 6.0 * (F.col("skew") ** 2 + F.col("kurt") ** 2 / 4.0))


def normality(df: DataFrame, col: str) -> dict:
    """Jarque–Bera and Kolmogorov–Smirnov (against a normal with the
    sample mean and sd, distributed ``KolmogorovSmirnovTest``)."""
    from pyspark.ml.stat import KolmogorovSmirnovTest
    jb = _one_row(jarque_bera_stats(df, col))
    m = _one_row(mean_stats(df, col))
    src = df.where(F.col(col).isNotNull()).select(_x(col).alias(col))
    ks = KolmogorovSmirnovTest.test(src, col, "norm", float(m["mean"]), float(m["sd"])).first()
    return {**jb, "jb_p": dist.chi2_sf(jb["jb"], 2), "ks_stat": ks.statistic, "ks_p": ks.pValue}


def qq_points(df: DataFrame, col: str, points: int = 99) -> DataFrame:
    """Sample quantiles at a fixed probability grid with the normal
    theoretical quantiles; the reference line follows from ``regr_slope``
    / ``regr_intercept`` over these points."""
    probs = {f"q{i}": i / (points + 1) for i in range(1, points + 1)}
    q = group_quantiles(df, [], col, probs)
    spark = df.sparkSession
    theo = spark.createDataFrame([(k, p, dist.norm_ppf(p)) for k, p in probs.items()],
                                 "k string, p double, theoretical double")
    pairs = ", ".join(f"'{k}', `{k}`" for k in probs)
    long = q.selectExpr(f"stack({len(probs)}, {pairs}) as (k, sample)")
    return long.join(F.broadcast(theo), "k").select("p", "theoretical", "sample")


def qq_line(points: DataFrame) -> DataFrame:
    return points.agg(F.regr_slope("sample", "theoretical").alias("slope"),
                      F.regr_intercept("sample", "theoretical").alias("intercept"))
