"""Further inputs derived by Spark from the driver's tables (FIXTURES §3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trend(t: dict[str, DataFrame]) -> DataFrame:
    """``T.trend``: every order as a dated deal, no date cut."""
    return t["orders"].select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"),
                              F.col("o_totalprice").cast("decimal(18,2)").alias("amt"))


def scored(t: dict[str, DataFrame]) -> DataFrame:
    """``T.scored``: lineitem as a scored test set (binary and regression)."""
    li = t["lineitem"]
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
                     (F.col("l_returnflag") == "R").cast("int").alias("label"),
                     (F.col("l_discount") * 5 + F.col("l_tax")).alias("score"),
                     F.col("l_extendedprice").alias("actual"),
                     (F.col("l_quantity") * 1500).alias("predicted"))


def investor_lists(t: dict[str, DataFrame]) -> DataFrame:
    """Supplier (investor) → comma-separated brand (company) list, the shape
    of a multi-valued source column.  A supplier has at most one entry per
    distinct brand, so each list is bounded by the brand count."""
    li = t["lineitem"].select("l_suppkey", "l_partkey")
    part = t["part"].select("p_partkey", "p_brand")
    pairs = li.join(part, li.l_partkey == part.p_partkey, "inner").select("l_suppkey", "p_brand").distinct()
    return pairs.groupBy("l_suppkey").agg(
        F.concat_ws(", ", F.array_sort(F.collect_set("p_brand"))).alias("brands"))
