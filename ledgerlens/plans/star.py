"""The star schema, derived by Spark from the driver's tables.

``startup_entities`` produces the wide, entity-grain table (one row per
customer standing in for one startup, FIXTURES §3).  ``StarSchema`` turns any
such table into dimensions and two facts with the generic operators, exactly
as the analysed application's transform step does, and can publish it as a
Parquet warehouse (S4) so later queries read the loaded star.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.joins import lookup_key
from ..operators.reshape import build_date_dimension, build_dimension, unpivot_positive
from ..session import read_tables, scratch_table
from . import domain


def startup_entities(tables: dict[str, DataFrame],
                     cutoff: str = domain.STAR_FUNDING_CUTOFF) -> DataFrame:
    """FIXTURES §3 ``T.star``: one row per customer with funding aggregates."""
    o = tables["orders"].select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus",
                                "o_orderdate", "o_totalprice")
    # Compare the raw timestamp so the predicate is pushed into the Parquet scan.
    o = o.where(F.col("o_orderdate") < F.lit(cutoff).cast("timestamp_ntz"))
    amt = F.col("o_totalprice").cast("decimal(18,2)")
    d = F.col("o_orderdate").cast("date")
    per_round = [F.sum(F.when(F.col("o_orderpriority") == p, amt).otherwise(F.lit(0).cast("decimal(18,2)")))
                 .alias(r) for p, r in domain.STAR_PRIORITY_ROUNDS]
    a = (o.groupBy("o_custkey")
          .agg(F.sum(amt).alias("funding_total_usd"),
               F.count(F.lit(1)).alias("funding_rounds"),
               F.min(d).alias("first_funding_at"), F.max(d).alias("last_funding_at"),
               F.max_by("o_orderstatus", "o_orderkey").alias("last_status"),
               *per_round))
    # nation / region are fixed-size reference tables (25 and 5 rows).
    nation = F.broadcast(tables["nation"].select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(tables["region"].select("r_regionkey", "r_name"))
    c = tables["customer"].select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    j = (c.join(a, c.c_custkey == a.o_custkey, "left")
          .join(nation, c.c_nationkey == nation.n_nationkey, "left")
          .join(region, F.col("n_regionkey") == region.r_regionkey, "left"))
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    cats = F.concat(F.lit("|"), seg, F.lit("|"),
                    F.concat_ws("|", F.when(F.col("seed") > 0, F.lit("Seed")),
                                F.when(F.col("venture") > 0, F.lit("Venture")),
                                F.when(F.col("debt_financing") > 0, F.lit("Debt"))),
                    F.lit("|"))
    ls = F.col("last_status")
    status = (F.when(k % 50 == 0, F.lit("ipo"))
               .when(ls.isNull() & (k % 7 == 0), F.lit(None).cast("string"))
               .when((ls == "P") & (k % 3 == 0), F.lit("acquired"))
               .when((ls == "F") & (k % 4 == 0), F.lit("closed"))
               .otherwise(F.lit("operating")))
    founded = F.when(k % 9 == 0, F.lit(None).cast("date")).otherwise(
        F.date_sub(F.col("first_funding_at"), ((k * 37) % 3000).cast("int")))
    return j.select(
        k.alias("startup_id"), F.col("c_name").alias("name"),
        F.when(k % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("country_name"),
        F.when(k % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("region"),
        F.concat(F.lit("City"), (k % 40).cast("string")).alias("city"),
        seg.alias("market"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(cats).alias("category_list"),
        status.alias("status"),
        founded.alias("founded_at"),
        "first_funding_at", "last_funding_at", "funding_total_usd", "funding_rounds",
        *domain.STAR_ROUND_COLUMNS,
        (F.col("c_acctbal") >= 9000).alias("is_unicorn"),
        F.when(F.col("c_acctbal") >= 9000, F.floor(F.col("c_acctbal") / 10) / 100).cast("decimal(10,2)")
        .alias("valuation_billion_usd"),
    )


def engineer_features(df: DataFrame, round_cols, reference_date: str) -> DataFrame:
    """Derived entity columns (C10–C22) of the analysed transform step."""
    rank, cat = domain.round_rank(), domain.round_category()
    furthest = C.argmax_column(round_cols, rank)
    return df.select(
        "*",
        C.first_item("category_list").alias("primary_category"),
        C.item_count("category_list").alias("category_count"),
        C.age_years("founded_at", reference_date).alias("years_since_founded"),
        C.days_between("founded_at", "first_funding_at").alias("days_to_first_funding"),
        C.days_between("first_funding_at", "last_funding_at").alias("funding_span_days"),
        C.safe_ratio("funding_total_usd", "funding_rounds").alias("avg_funding_per_round"),
        C.gt_flag("funding_rounds", 1).alias("is_multi_round"),
        C.count_positive(round_cols).alias("num_round_types_used"),
        C.gt_flag("debt_financing", 0).alias("has_debt_financing"),
        C.log1p(F.col("funding_total_usd").cast("double")).alias("log_funding_total_usd"),
        furthest.alias("furthest_round_type"),
        C.map_category(furthest, cat).alias("furthest_stage_category"),
        C.in_flag("status", domain.EXIT_STATUSES).alias("is_exited"),
        C.eq_flag("status", domain.CLOSED_STATUS).alias("is_closed"),
        F.when(F.col("is_unicorn"), C.tier("valuation_billion_usd", [9.8, 9.4], ["High", "Middle"], default="Low"))
        .alias("valuation_tier"),
    )


# Attributes of the entity.  One fact row belongs to one entity, so the fact carries them too and no
# query has to shuffle two entity-size tables to read a name or a flag.
ENTITY_COLUMNS = ["name", "status", "is_exited", "is_closed", "is_unicorn", "category_count", "valuation_billion_usd",
                  "valuation_tier"]


@dataclass
class StarSchema:
    """Five dimensions and two facts built lazily from an entity table.

    ``engineered``: the entity table with its derived columns, where the
    caller has already written it (every table is derived from it)."""

    entities: DataFrame
    engineered: DataFrame | None = None
    round_cols: list = field(default_factory=lambda: list(domain.STAR_ROUND_COLUMNS))
    reference_date: str = domain.STAR_REFERENCE_DATE

    @cached_property
    def wide(self) -> DataFrame:
        if self.engineered is not None:
            return self.engineered
        return engineer_features(self.entities, self.round_cols, self.reference_date)

    @cached_property
    def dim_geography(self) -> DataFrame:
        return build_dimension(self.wide, ["country_name", "region", "city"], "geography_id")

    @cached_property
    def dim_industry(self) -> DataFrame:
        return build_dimension(self.wide, ["primary_category", "market"], "industry_id")

    @cached_property
    def dim_date(self) -> DataFrame:
        return build_date_dimension(self.wide, ["founded_at", "first_funding_at", "last_funding_at"])

    @cached_property
    def dim_round_type(self) -> DataFrame:
        spark = self.entities.sparkSession
        return spark.createDataFrame(
            domain.round_type_rows(self.round_cols),
            "round_type_id int, round_type_name string, stage_category string, stage_rank int")

    @cached_property
    def dim_startup(self) -> DataFrame:
        return self.wide.select("startup_id", *ENTITY_COLUMNS)

    @cached_property
    def fact_startup_funding(self) -> DataFrame:
        f = lookup_key(self.wide, self.dim_geography, ["country_name", "region", "city"], "geography_id")
        f = lookup_key(f, self.dim_industry, ["primary_category", "market"], "industry_id")
        return f.select(
            "startup_id", "geography_id", "industry_id",
            C.date_key("founded_at").alias("founded_date_id"),
            C.date_key("first_funding_at").alias("first_funding_date_id"),
            C.date_key("last_funding_at").alias("last_funding_date_id"),
            F.col("funding_total_usd").cast("decimal(18,2)").alias("funding_total_usd"),
            "funding_rounds", "years_since_founded", "days_to_first_funding", "funding_span_days",
            "avg_funding_per_round", "is_multi_round", "num_round_types_used", "has_debt_financing",
            "log_funding_total_usd", "furthest_round_type", "furthest_stage_category", *ENTITY_COLUMNS)

    @cached_property
    def fact_funding_by_type(self) -> DataFrame:
        types = self.dim_round_type.select("round_type_id", F.col("round_type_name"))
        return unpivot_positive(self.wide, ["startup_id"], self.round_cols,
                                name_col="round_type_name", value_col="amount_usd",
                                types=types, type_key="round_type_id") \
            .select("startup_id", "round_type_id", "amount_usd")

    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in TABLE_ORDER}


# Bumped whenever the star's definition changes: a published star is reused
# only by code that builds the same tables.
STAR_VERSION = "7"

# Dimensions before facts (load order of S4).
TABLE_ORDER = ["dim_date", "dim_geography", "dim_industry", "dim_round_type", "dim_startup",
               "fact_startup_funding", "fact_funding_by_type"]

# What must hold before a star is published.
CONSTRAINTS = {
    "fact_startup_funding": {"primary_key": ["startup_id"], "not_null": ["startup_id"],
                             "foreign_keys": [(["geography_id"], "dim_geography", ["geography_id"]),
                                              (["industry_id"], "dim_industry", ["industry_id"]),
                                              (["first_funding_date_id"], "dim_date", ["date_id"]),
                                              (["startup_id"], "dim_startup", ["startup_id"])]},
    "dim_startup": {"primary_key": ["startup_id"]},
    "dim_geography": {"primary_key": ["geography_id"], "unique": [["country_name", "region", "city"]]},
    "dim_date": {"primary_key": ["date_id"]},
    "fact_funding_by_type": {"primary_key": ["startup_id", "round_type_id"],
                             "foreign_keys": [(["round_type_id"], "dim_round_type", ["round_type_id"])]},
}

SOURCES = ("customer", "nation", "orders", "region")


def star_from_tables(spark: SparkSession, sf_dir: str, fresh: bool = False) -> StarSchema:
    """The star's plan over the given tables; ``fresh`` lists their files anew."""
    tables = {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in SOURCES} if fresh \
        else read_tables(spark, sf_dir)
    return StarSchema(startup_entities(tables))


def publish_star(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Build the star, check its constraints (D15), and publish it below ``root``."""
    from ..operators.quality import require_constraints
    from ..sources.warehouse import load_warehouse

    plan = star_from_tables(spark, sf_dir, fresh=True)
    star = StarSchema(plan.entities, scratch_table(plan.wide, "star-entities"))  # the hub of all tables: written once
    return load_warehouse(star.tables(), root, order=TABLE_ORDER,
                          checks=lambda staged: require_constraints(staged, CONSTRAINTS))


_WAREHOUSES: dict[tuple, dict[str, DataFrame]] = {}


def star_tag(spark: SparkSession, sf_dir: str) -> str:
    """Names the star of ``sf_dir`` as it is now: its source files and the star's definition."""
    from ..sources.warehouse import source_fingerprint

    base = sf_dir.rstrip("/")
    found = source_fingerprint(spark, [f"{base}/{n}.parquet" for n in SOURCES])
    return hashlib.sha1(f"{base}|{found}|{STAR_VERSION}".encode()).hexdigest()[:12]


def warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The published star for ``sf_dir``.

    Its folder is named after the source files' names, sizes and modification
    times and the star's definition, so a changed source builds a new star.
    """
    from ..sources.warehouse import read_warehouse, warehouse_root

    tag = star_tag(spark, sf_dir)
    key = (spark.sparkContext.applicationId, tag)
    if key not in _WAREHOUSES:
        root = warehouse_root(spark, "star-" + tag)
        try:
            tables = read_warehouse(spark, root)
        except FileNotFoundError:
            publish_star(spark, sf_dir, root)
            tables = read_warehouse(spark, root)
        _WAREHOUSES[key] = tables
    return _WAREHOUSES[key]
