"""Scalar column expressions.

Every function returns a ``Column`` built from native Spark expressions so
it stays inside whole-stage codegen.  Arguments accept a column name or a
``Column``.  Null semantics follow the analysed pandas code unless noted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(mapping: Mapping) -> Column:
    """A literal ``MapType`` column from a small Python dict (fixed size)."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


# ---------------------------------------------------------------- C3, C4, C7
def normalise_key(c) -> Column:
    """Lower-case and trim a text key."""
    return F.lower(F.trim(col(c)))


def _finite(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def parse_currency(c) -> Column:
    """C4: text money to double.

    Trims; ``-``, empty and the literal ``nan`` become null; every comma is
    dropped whatever the digit grouping; anything unparsable is null.  NaN
    and infinities never leak out (Spark would parse ``'NaN'``).
    """
    s = F.trim(col(c).cast("string"))
    bad = s.isNull() | s.isin("-", "") | (F.lower(s) == "nan")
    parsed = F.regexp_replace(s, ",", "").try_cast("double")
    return F.when(~bad, _finite(parsed))


def to_number_or_zero(c) -> Column:
    """Structural zeros — unparsable or missing numbers become 0."""
    v = col(c).cast("string").try_cast("double")
    return F.coalesce(_finite(v), F.lit(0.0))


# ---------------------------------------------------------------- C5, C6
def parse_date(c) -> Column:
    """Lenient ISO date parse: anything unparsable becomes null."""
    x = col(c)
    return F.coalesce(x.cast("string").try_cast("date"),
                      F.try_to_timestamp(x.cast("string")).cast("date"))


def null_future_date(c, max_year: int) -> Column:
    """Parse; dates whose year is above ``max_year`` become null.

    ``max_year`` is explicit: results must not depend on the wall clock.
    """
    d = parse_date(c)
    return F.when(F.year(d) <= F.lit(max_year), d)


def flag_before_year(c, year: int = 1900) -> Column:
    """True when the parsed date is before ``year``; null dates → false."""
    return F.coalesce(F.year(parse_date(c)) < F.lit(year), F.lit(False))


# ---------------------------------------------------------------- C8, C9, C12
def fix_values(key, value, fixes: Mapping[str, str]) -> Column:
    """Replace ``value`` where ``key`` is one of the corrected keys."""
    if not fixes:
        return col(value)
    return F.coalesce(literal_map(fixes)[col(key)], col(value))


def overwrite_if_present(base, other) -> Column:
    """Take ``other`` where present, else keep ``base``."""
    return F.coalesce(col(other), col(base))


# ---------------------------------------------------------------- C10, C11
def _items(c, delimiter: str) -> Column:
    pattern = "[" + "".join("\\" + ch for ch in delimiter) + "]"
    return F.filter(F.split(col(c), pattern), lambda x: x != F.lit(""))


def first_item(c, delimiter: str = "|") -> Column:
    """First non-empty item of a delimited list (leading/trailing delimiters ignored)."""
    return F.try_element_at(_items(c, delimiter), F.lit(1))


def item_count(c, delimiter: str = "|") -> Column:
    """C11: number of non-empty items; null in, null out."""
    return F.when(col(c).isNotNull(), F.size(_items(c, delimiter)))


def split_items(c, delimiter: str = ",") -> Column:
    """Trimmed, non-empty items of a delimited list (used by J9)."""
    parts = F.transform(F.split(col(c), "\\" + delimiter if delimiter in "|.^$*+?()[]{}\\" else delimiter),
                        lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != F.lit(""))


# ---------------------------------------------------------------- C13–C16, C23
def date_key(c) -> Column:
    """C14: nullable int ``YYYYMMDD`` key of a date."""
    return F.date_format(col(c), "yyyyMMdd").cast("int")


def date_attributes(c) -> dict[str, Column]:
    """The date dimension attributes of a date column."""
    d = col(c)
    return {
        "date_id": date_key(d),
        "full_date": d.cast("date"),
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day": F.dayofmonth(d),
        "day_name": F.date_format(d, "EEEE"),
    }


def age_years(c, reference_date: str) -> Column:
    """Whole-day age in years (365.25-day years), 1 decimal half-even; negative → null."""
    yrs = F.bround(F.datediff(F.to_date(F.lit(reference_date)), col(c)) / F.lit(365.25), 1)
    return F.when(yrs >= 0, yrs)


def days_between(start, end) -> Column:
    """``end - start`` in days."""
    return F.datediff(col(end), col(start))


def year_from_key(c) -> Column:
    """Year of an ``YYYYMMDD`` integer key."""
    return F.floor(col(c) / F.lit(10000)).cast("int")


# ---------------------------------------------------------------- C17–C21, C24, C28, C32
def safe_ratio(a, b) -> Column:
    """C17: ``a / b`` with a zero or null denominator giving null."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def gt_flag(c, threshold=1) -> Column:
    """``c > threshold`` with null treated as 0 (pandas ``fillna(0) > t``)."""
    return F.coalesce(col(c), F.lit(0)) > F.lit(threshold)


def in_flag(c, values: Sequence) -> Column:
    """Membership flag, null → false."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def eq_flag(c, value) -> Column:
    """Equality flag, null → false."""
    return F.coalesce(col(c) == F.lit(value), F.lit(False))


def count_positive(cols: Sequence) -> Column:
    """Number of columns holding a value > 0."""
    return sum((F.when(col(c) > 0, 1).otherwise(0) for c in cols), F.lit(0))


def log1p(c) -> Column:
    """C20."""
    return F.log1p(col(c))


def expm1(c) -> Column:
    """C20."""
    return F.expm1(col(c))


def argmax_column(cols: Sequence[str], rank: Mapping[str, int]) -> Column:
    """Name of the used (> 0) column of highest rank.

    Ties go to the earlier column; no used column gives null.  Columns
    missing from ``rank`` count as rank 0.
    """
    cands = [
        F.when(col(c) > 0, F.struct(F.lit(rank.get(c, 0)).alias("r"),
                                     F.lit(-i).alias("p"), F.lit(c).alias("n")))
        for i, c in enumerate(cols)
    ]
    best = F.array_max(F.filter(F.array(*cands), lambda x: x.isNotNull()))
    return best.getField("n")


def map_category(c, mapping: Mapping) -> Column:
    """Literal dictionary lookup; unknown → null."""
    return literal_map(mapping)[col(c)]


def bucket_floor(c, width: int = 5) -> Column:
    """Cohort bucket start, e.g. 5-year cohorts."""
    return (F.floor(col(c) / F.lit(width)) * F.lit(width)).cast("long")


def clip(c, lo=None, hi=None) -> Column:
    """Clamp into [lo, hi]; null stays null."""
    x = col(c)
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(x.isNotNull(), out)


def interaction(a, b) -> dict[str, Column]:
    """Product and safe rate of two columns."""
    return {"product": col(a) * col(b), "rate": safe_ratio(a, b)}


def cast_flag(c) -> Column:
    """Boolean flag to 0/1 int (null stays null)."""
    return col(c).cast("int")


# ---------------------------------------------------------------- C29–C31
def money_label(c, decimals: int = 1, with_k: bool = True) -> Column:
    """``$1.2B`` / ``$3.4M`` / ``$5.6K`` / ``$78``; null → ``-``."""
    x = col(c).cast("double")
    fmt = "%." + str(decimals) + "f"

    def unit(div, suffix):
        return F.concat(F.lit("$"), F.format_string(fmt, x / F.lit(div)), F.lit(suffix))

    out = (F.when(x.isNull(), F.lit("-"))
           .when(F.abs(x) >= 1e9, unit(1e9, "B"))
           .when(F.abs(x) >= 1e6, unit(1e6, "M")))
    if with_k:
        out = out.when(F.abs(x) >= 1e3, unit(1e3, "K"))
    return out.otherwise(F.concat(F.lit("$"), F.format_string("%.0f", x)))


def percent_label(c, decimals: int = 1) -> Column:
    """Fraction to a percent label, e.g. 0.1234 → ``12.3%``."""
    return F.when(col(c).isNotNull(),
                  F.concat(F.format_string("%." + str(decimals) + "f", col(c) * 100), F.lit("%")))


def tier(c, cutoffs: Sequence[float], labels: Sequence[str], closed: str = "left",
         default: str | None = None) -> Column:
    """Label by thresholds.

    ``closed='left'``: the first label whose cutoff satisfies ``x >= cutoff``
    (cutoffs descending, e.g. KPI status).  ``closed='right'``: right-closed
    bins ``(c[i-1], c[i]]`` with ascending cutoffs, ``len(labels) ==
    len(cutoffs) - 1`` (pandas ``cut``).
    """
    x = col(c)
    if closed == "left":
        if len(labels) != len(cutoffs):
            raise ValueError("left-closed tiers need one label per cutoff")
        out = None
        for cut, lab in zip(cutoffs, labels):
            out = (F.when if out is None else out.when)(x >= F.lit(cut), F.lit(lab))
        return out.otherwise(F.lit(default)) if out is not None else F.lit(default)
    if len(labels) != len(cutoffs) - 1:
        raise ValueError("right-closed bins need len(cutoffs) - 1 labels")
    out = None
    for lo, hi, lab in zip(cutoffs[:-1], cutoffs[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        out = (F.when if out is None else out.when)(cond, F.lit(lab))
    return out.otherwise(F.lit(default))


# ---------------------------------------------------------------- C25–C27
def search_contains(c, query: str) -> Column:
    """Case-insensitive literal substring test; null → no match."""
    return F.coalesce(F.contains(F.lower(col(c)), F.lower(F.lit(query))), F.lit(False))


def in_range_keep_null(c, lo, hi) -> Column:
    """``lo <= c <= hi`` or ``c`` is null."""
    return col(c).between(F.lit(lo), F.lit(hi)) | col(c).isNull()
