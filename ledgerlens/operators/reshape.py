"""Set operations and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_attributes
from .ordering import global_row_number


def union_all(*dfs: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Union by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key (null keys equal), the first by ascending ``order``.

    Written as an aggregation (``min`` of a struct led by the order columns)
    rather than a window: the aggregate combines map-side, so a key holding
    a third of all rows is reduced inside every input task instead of being
    sorted in one.  ``order`` must make rows unique within a key.
    """
    payload = [c for c in df.columns if c not in keys]
    head = [F.col(c).alias(f"__o{i}") for i, c in enumerate(order)]
    picked = (df.groupBy(*keys)
                .agg(F.min(F.struct(*head, *[F.col(c) for c in payload])).alias("__first")))
    return picked.select(*keys, *[F.col("__first")[c].alias(c) for c in payload]).select(*df.columns)


def build_dimension(df: DataFrame, cols: Sequence[str], key: str,
                    drop_all_null: bool = False) -> DataFrame:
    """Distinct attribute combinations with a dense 1-based surrogate key.

    Keys follow the sorted order of the attributes (nulls first), which is
    deterministic; numbering uses the distributed row number, so the
    dimension may be as large as the data.
    """
    d = df.select(*cols).distinct()
    if drop_all_null:
        d = d.na.drop("all")
    numbered = global_row_number(d, [F.col(c).asc_nulls_first() for c in cols], name=key)
    return numbered.select(F.col(key).cast("long").alias(key), *cols)


def build_date_dimension(df: DataFrame, date_cols: Sequence[str]) -> DataFrame:
    """U4: one row per distinct non-null date found in any of ``date_cols``."""
    dates = df.select(F.explode(F.array(*[F.col(c).cast("date") for c in date_cols])).alias("d"))
    distinct = dates.where(F.col("d").isNotNull()).distinct()
    attrs = date_attributes("d")
    return distinct.select(*[v.alias(k) for k, v in attrs.items()])


def unpivot_positive(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str],
                     name_col: str = "type_name", value_col: str = "amount",
                     types: DataFrame | None = None, type_key: str | None = None) -> DataFrame:
    """Long form of ``value_cols``, dropping null and non-positive values.

    ``types`` (a literal table, bounded by the number of value columns) maps
    the column name to its id; it is broadcast.
    """
    common = [F.col(c).cast("decimal(18,2)").alias(c) for c in value_cols]
    long = (df.select(*ids, *common)
              .unpivot(list(ids), list(value_cols), name_col, value_col)
              .where(F.col(value_col) > 0))
    if types is not None:
        long = long.join(F.broadcast(types), name_col, "left")
        if type_key:
            long = long.select(*ids, type_key, name_col, value_col)
    return long


def crosstab(df: DataFrame, row: str, column: str, values: Sequence | None = None) -> DataFrame:
    """Zero-filled contingency table (``values`` fixes the column order)."""
    g = df.groupBy(row)
    p = g.pivot(column, list(values)) if values is not None else g.pivot(column)
    return p.count().na.fill(0)


def compare_keys(a: DataFrame, b: DataFrame, key: str, b_key: str | None = None) -> DataFrame:
    """Every distinct non-null key with the side(s) holding it."""
    b_key = b_key or key
    ka = a.select(F.col(key).alias("key")).where(F.col("key").isNotNull()).distinct() \
          .withColumn("in_a", F.lit(True))
    kb = b.select(F.col(b_key).alias("key")).where(F.col("key").isNotNull()).distinct() \
          .withColumn("in_b", F.lit(True))
    j = ka.join(kb, "key", "full")
    side = (F.when(F.col("in_a") & F.col("in_b"), "both")
             .when(F.col("in_a").isNotNull(), "left_only").otherwise("right_only"))
    return j.select("key", side.alias("side"))


def reindex_categories(df: DataFrame, column: str, order: Sequence[str],
                       position: str = "position") -> DataFrame:
    """U8: keep only listed categories and attach their display position."""
    spark = df.sparkSession
    ordered = spark.createDataFrame([(v, i + 1) for i, v in enumerate(order)],
                                    f"{column} string, {position} int")
    return df.join(F.broadcast(ordered), column, "inner")


def literal_table(spark, rows: Sequence, schema: str) -> DataFrame:
    """A small static table (size fixed by the caller's literal)."""
    return spark.createDataFrame(list(rows), schema)
