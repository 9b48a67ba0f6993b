"""BI measure registry.

A measure is a named aggregate expression over the denormalised fact
(entity grain: one row per entity id).  ``measure(df, names, by=...)``
evaluates any set of measures in ONE ``groupBy().agg()`` — the DAX filter
context becomes the grouping plus an optional filter; ``date_role`` picks
which date key the ``year``/``quarter``/``month`` columns come from.

At entity grain ``DISTINCTCOUNT(id)`` equals a (conditional) row count, so
the registry uses ``count_if`` — no ``Expand`` per distinct aggregate.  The
grain is a checked constraint of the warehouse (D15 primary key).
Medians and percentiles are exact and distributed (``group_quantiles``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import tier
from ..operators.ordering import with_quantiles


@dataclass(frozen=True)
class Measure:
    name: str
    build: Callable[[Mapping[str, str]], Column] | None
    quantile: float | None = None      # exact quantile of the value column instead of an expression
    doc: str = ""
    fact: str = "entity"               # the fact it is defined over: entity, round (one row per entity and type), investor


def _n(cond=None):
    return F.count(F.lit(1)) if cond is None else F.count_if(cond)


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


# Column roles: value (money), id, rounds, age, country, unicorn, exited, closed,
# multi_round, stage, status.
DEFAULT_ROLES = {
    "value": "funding_total_usd", "id": "startup_id", "rounds": "funding_rounds",
    "age": "years_since_founded", "country": "country_name", "unicorn": "is_unicorn",
    "exited": "is_exited", "closed": "is_closed", "multi_round": "is_multi_round",
    "stage": "furthest_stage_category", "status": "status",
    "amount": "amount_usd", "investor": "investor_id",
}


def _money(r):
    return F.col(r["value"]).cast("decimal(18,2)")


def _total(r):
    return F.sum(_money(r)).cast("double")


def _exit_rate(r, cond=None):
    ex = F.col(r["exited"])
    if cond is None:
        return _ratio(_n(ex), _n())
    return _ratio(_n(ex & cond), _n(cond))


REGISTRY: dict[str, Measure] = {m.name: m for m in [
    # B1
    Measure("total_funding", _total, doc="SUM(value)"),
    Measure("average_funding", lambda r: _ratio(F.sum(_money(r)), F.count(r["value"])), doc="AVERAGE(value)"),
    Measure("median_funding", None, quantile=0.5, doc="MEDIAN(value)"),
    Measure("avg_funding_rounds", lambda r: F.avg(F.col(r["rounds"]).cast("double"))),
    Measure("avg_years_since_founded", lambda r: F.avg(F.col(r["age"]).cast("double"))),
    # B2
    Measure("total_startups", lambda r: _n(), doc="DISTINCTCOUNT(id) at entity grain"),
    Measure("active_countries", lambda r: F.count_distinct(r["country"]), doc="non-null distinct"),
    # B3
    Measure("total_unicorns", lambda r: _n(F.col(r["unicorn"]))),
    Measure("exit_rate", lambda r: _exit_rate(r)),
    Measure("closure_rate", lambda r: _ratio(_n(F.col(r["closed"])), _n())),
    Measure("unicorn_rate", lambda r: _ratio(_n(F.col(r["unicorn"])), _n())),
    Measure("multi_round_pct", lambda r: _ratio(_n(F.col(r["multi_round"])), _n())),
    Measure("late_stage_startups", lambda r: _n(F.col(r["stage"]) == "Late Stage / Public")),
    # B12, B13
    Measure("funding_per_startup", lambda r: _ratio(F.sum(_money(r)), _n())),
    Measure("multi_round_success_lift", lambda r: F.try_divide(
        _exit_rate(r, F.col(r["status"]).isNotNull() & F.col(r["multi_round"])),
        _exit_rate(r, ~F.col(r["multi_round"])))),
    # B2, B9 over their own facts
    Measure("total_investors", lambda r: F.count_distinct(r["investor"]), doc="DISTINCTCOUNT(investor)", fact="investor"),
    Measure("funding_by_round_type", lambda r: F.sum(F.col(r["amount"]).cast("decimal(18,2)")).cast("double"), fact="round"),
    # B8
    Measure("funding_p90", None, quantile=0.9, doc="PERCENTILEX.INC(value, 0.9)"),
]}


def measure(df: DataFrame, names: Sequence[str], by: Sequence[str] = (), filters: Column | str | None = None,
            roles: Mapping[str, str] | None = None) -> DataFrame:
    """Evaluate registered measures per group in one aggregation over ``df``,
    which holds the fact that all of them are defined over."""
    facts = {REGISTRY[n].fact for n in names}
    if len(facts) > 1:
        raise ValueError(f"measures of different facts: {sorted(facts)}")
    r = {**DEFAULT_ROLES, **(roles or {})}
    src = df
    if filters is not None:
        src = src.where(F.expr(filters) if isinstance(filters, str) else filters)
    plain = [REGISTRY[n] for n in names if REGISTRY[n].build is not None]
    quant = {n: REGISTRY[n].quantile for n in names if REGISTRY[n].build is None}
    grouped = src.groupBy(*by) if by else src.groupBy()
    aggs = [m.build(r).alias(m.name) for m in plain] or [F.count(F.lit(1)).alias("__n")]
    out = grouped.agg(*aggs)
    if quant:
        out = with_quantiles(out, src, list(by), F.col(r["value"]), quant)
    if not plain:
        out = out.drop("__n")
    return out.select(*by, *names)


def measure_by_date_role(df: DataFrame, names: Sequence[str], role_year: str,
                         min_year: int | None = None, roles=None) -> DataFrame:
    """The same measures sliced by the year of a chosen date role
    (the role's year column comes from J7), optionally from ``min_year`` on."""
    src = df.where(F.col(role_year).isNotNull())
    if min_year is not None:
        src = src.where(F.col(role_year) >= min_year)
    return measure(src.withColumnRenamed(role_year, "year"), names, ["year"], roles=roles)


def dynamic_measure(df: DataFrame, metric: str | None, by: Sequence[str] = (), roles=None) -> DataFrame:
    """The measure picked by a selector value, defaulting to total funding."""
    pick = {"Total Funding": "total_funding", "Total Startups": "total_startups",
            "Median Funding": "median_funding", "Exit Rate %": "exit_rate"}.get(metric or "", "total_funding")
    return measure(df, [pick], by, roles=roles).withColumnRenamed(pick, "value")


def share_ignoring(df: DataFrame, value_measure: str, by: Sequence[str], ignore: str,
                   name: str = "share", roles=None) -> DataFrame:
    """A measure's share of its total with the ``ignore`` dimension removed
    from the grouping (DAX ``CALCULATE(..., ALL(dim))``).  The totals are a
    map-side-combined aggregate of the measure rows by the remaining keys,
    joined back null-safely (or attached as literals when no key remains),
    rather than a window that sorts each remaining key's rows in one task."""
    from ..operators.ordering import attach_row
    agg = measure(df, [value_measure], by, roles=roles)
    rest = [b for b in by if b != ignore]
    if not rest:
        with_tot = attach_row(agg, agg.agg(F.sum(value_measure).alias("__tot")))
    else:
        tot = agg.groupBy(*[F.col(b).alias(f"__k{i}") for i, b in enumerate(rest)]) \
                 .agg(F.sum(value_measure).alias("__tot"))
        cond = [agg[b].eqNullSafe(tot[f"__k{i}"]) for i, b in enumerate(rest)]
        with_tot = agg.join(tot, cond, "left")
    return with_tot.select(*agg.columns, _ratio(F.col(value_measure), F.col("__tot")).alias(name))


# Thresholds of the status colours and of the top flag.
def kpi_status(rate: Column, green: float = 0.15, amber: float = 0.08) -> Column:
    """Green / Amber / Red by thresholds."""
    return tier(rate, [green, amber], ["Green", "Amber"], default="Red")


def top_flag(rank: Column, n: int = 10) -> Column:
    """``Top 10`` / ``Other``."""
    return F.when(rank <= n, F.lit(f"Top {n}")).otherwise(F.lit("Other"))
