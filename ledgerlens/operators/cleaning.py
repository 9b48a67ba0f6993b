"""DataFrame-level cleaning operators built on the column
expressions of :mod:`ledgerlens.functions.columns`."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .joins import top_values


def trim_rename_columns(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Strip blanks (and a BOM) from column names, then apply renames."""
    out = df.toDF(*[c.replace("﻿", "").strip() for c in df.columns])
    return out.withColumnsRenamed(dict(renames)) if renames else out


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows where every column is null."""
    return df.na.drop("all")


def normalise_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C3 on several columns."""
    return df.withColumns({c: C.normalise_key(c) for c in cols})


def parse_currency_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C4 on several columns."""
    return df.withColumns({c: C.parse_currency(c) for c in cols})


def null_future_dates(df: DataFrame, cols: Sequence[str], max_year: int) -> DataFrame:
    """Parse date columns; years above ``max_year`` become null."""
    return df.withColumns({c: C.null_future_date(c, max_year) for c in cols})


def flag_before_year(df: DataFrame, col: str, year: int = 1900, name: str | None = None) -> DataFrame:
    """Add a keep-and-flag column for dates before ``year``."""
    return df.withColumn(name or f"is_pre_{year}_{col}", C.flag_before_year(col, year))


def coerce_numeric_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numbers with missing / unparsable values as structural zeros."""
    return df.withColumns({c: C.to_number_or_zero(c) for c in cols})


def fix_values(df: DataFrame, key: str, value: str, fixes: Mapping[str, str]) -> DataFrame:
    """Correct ``value`` for listed ``key`` values."""
    return df.withColumn(value, C.fix_values(key, value, fixes))


def map_codes(df: DataFrame, col: str, out: str, lookup: DataFrame, lookup_key: str,
              lookup_value: str, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Code lookup — manual override first, then the reference table,
    else null.  The table is data: swap key and value for the other
    direction.  A key listed more than once gives its smallest value, so rows
    never multiply; Spark broadcasts the table if it is small."""
    ref = lookup.where(F.col(lookup_key).isNotNull()).groupBy(F.col(lookup_key).alias("__lk")).agg(
        F.min(lookup_value).alias("__lv"))
    j = df.join(ref, df[col] == ref["__lk"], "left")
    ov = C.literal_map(overrides)[F.col(col)] if overrides else F.lit(None).cast("string")
    return j.withColumn(out, F.coalesce(ov, F.col("__lv").cast("string"))).drop("__lk", "__lv")


def code_table(lookup: DataFrame, key: str, value: str, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """The table in force, ``key, value``: ``lookup`` with the keys of ``overrides`` replaced or added.

    The table is a parameter (a DataFrame kept as data); rows without a key
    are left out.
    """
    base = lookup.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))
    if not overrides:
        return base.distinct()
    fixed = lookup.sparkSession.createDataFrame(list(overrides.items()), "key string, value string")
    return base.where(~F.col("key").isin(list(overrides))).unionByName(fixed).distinct()


def code_conflicts(table: DataFrame) -> DataFrame:
    """What keeps a code table from being read in both directions.

    ``side, item, n``: a key with several values, or a value that several
    keys share; no rows if the table is one to one.
    """
    def several(own: str, other: str, side: str) -> DataFrame:
        return table.where(F.col(own).isNotNull()).groupBy(F.col(own).alias("item")).agg(F.count_distinct(other).alias("n")).where(
            "n > 1").select(F.lit(side).alias("side"), "item", "n")

    return several("key", "value", "key").unionByName(several("value", "key", "value"))


def map_by_table(df: DataFrame, col: str, out: str, table: DataFrame, reverse: bool = False) -> DataFrame:
    """``out`` from ``col`` by a code table, or with ``reverse`` back from value to key; null where it has no entry.

    A table that is not one to one cannot be reversed: that raises.
    """
    if reverse and not code_conflicts(table).isEmpty():
        raise ValueError("the code table is not one to one; see code_conflicts")
    source, target = ("value", "key") if reverse else ("key", "value")
    return map_codes(df, col, out, table, source, target)


def unmapped_codes(df: DataFrame, col: str, out: str) -> DataFrame:
    """Every value of ``col`` that got no ``out``, with its number of rows."""
    return df.where(F.col(col).isNotNull() & F.col(out).isNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def filter_rows(df: DataFrame, isin: Mapping[str, Sequence] | None = None, eq: Mapping | None = None,
                at_least: Mapping | None = None, flags: Sequence[str] = ()) -> DataFrame:
    """Combinable filters — membership, equality, minimum, true flags."""
    out = df
    for c, vals in (isin or {}).items():
        out = out.where(F.col(c).isin(list(vals)))
    for c, v in (eq or {}).items():
        out = out.where(F.col(c) == F.lit(v))
    for c, v in (at_least or {}).items():
        out = out.where(F.col(c) >= F.lit(v))
    for c in flags:
        out = out.where(F.col(c))
    return out


def group_top_n(df: DataFrame, col: str, n: int, other: str = "Other", out: str | None = None) -> DataFrame:
    """Keep the ``n`` most frequent values (ties by value), everything
    else — nulls included — becomes ``other``.  The top-n list has ``n``
    rows, so it is broadcast."""
    top = top_values(df, col, n).select(F.col(col).alias("__top"))
    j = df.join(F.broadcast(top), df[col] == top["__top"], "left")
    return j.withColumn(out or col, F.coalesce(F.col("__top"), F.lit(other))).drop("__top")


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """The non-null options of a column, sorted."""
    return df.select(col).na.drop().distinct().orderBy(col)
