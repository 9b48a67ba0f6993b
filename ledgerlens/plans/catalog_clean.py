"""Registered queries: cleaning (C), joins (J), reshaping (U), data quality
(D), text (K) and sources (S).  Dirty text inputs are derived by Spark from
the driver's tables (every row kept; key arithmetic only chooses which kind
of dirt a row gets)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import cleaning as CL
from ..operators import joins as J
from ..operators import quality as D
from ..operators import reshape as U
from ..operators import text as K
from ..sources.files import text_lines
from . import domain, testbed
from .catalog import CATALOG, _tables, _wh, query
from .catalog_more import wide
from .oracle_ctes import with_star
from .star import star_from_tables, startup_entities

_DIRTY_MONEY_SQL = """dirty AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN ' - ' WHEN o_orderkey % 17 = 0 THEN 'nan'
    WHEN o_orderkey % 19 = 0 THEN '' WHEN o_orderkey % 23 = 0 THEN 'abc'
    ELSE CONCAT(' ', format('{:,.2f}', o_totalprice), ' ') END AS money_text,
    CASE WHEN o_orderkey % 29 = 0 THEN 'junk' WHEN o_orderkey % 31 = 0 THEN '2914-01-01'
    WHEN o_orderkey % 37 = 0 THEN '1636-09-08' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date_text
  FROM orders)"""


def dirty(t):
    """Orders as dirty text: money with thousands separators and padding,
    ``-`` / ``nan`` / empty / junk values, impossible and pre-1900 dates."""
    o = t["orders"]
    k = F.col("o_orderkey")
    money = (F.when(k % 13 == 0, F.lit(" - ")).when(k % 17 == 0, F.lit("nan")).when(k % 19 == 0, F.lit(""))
              .when(k % 23 == 0, F.lit("abc"))
              .otherwise(F.concat(F.lit(" "), F.format_number("o_totalprice", 2), F.lit(" "))))
    date = (F.when(k % 29 == 0, F.lit("junk")).when(k % 31 == 0, F.lit("2914-01-01"))
             .when(k % 37 == 0, F.lit("1636-09-08")).otherwise(F.col("o_orderdate").cast("date").cast("string")))
    return o.select("o_orderkey", money.alias("money_text"), date.alias("date_text"))


def entities(spark, sf):
    return startup_entities(_tables(spark, sf))


# =============================================================================
# C-series
# =============================================================================

@query("c4_c7_parse_money", with_star(f"""
SELECT o_orderkey,
  CASE WHEN trim(money_text) IN ('-', '') OR lower(trim(money_text)) = 'nan' THEN NULL
       ELSE TRY_CAST(replace(trim(money_text), ',', '') AS DOUBLE) END AS amount,
  COALESCE(CASE WHEN isfinite(TRY_CAST(money_text AS DOUBLE)) THEN TRY_CAST(money_text AS DOUBLE) END, 0.0)
    AS amount_or_zero
FROM dirty""", _DIRTY_MONEY_SQL))
def c4_c7_parse_money(spark, sf):
    d = dirty(_tables(spark, sf))
    return d.select("o_orderkey", C.parse_currency("money_text").alias("amount"),
                    C.to_number_or_zero("money_text").alias("amount_or_zero"))


@query("c5_c6_dates", with_star("""
SELECT o_orderkey, CASE WHEN year(TRY_CAST(date_text AS DATE)) <= 2025 THEN TRY_CAST(date_text AS DATE) END AS d,
  COALESCE(year(TRY_CAST(date_text AS DATE)) < 1900, false) AS is_pre_1900
FROM dirty""", _DIRTY_MONEY_SQL))
def c5_c6_dates(spark, sf):
    d = dirty(_tables(spark, sf))
    out = CL.null_future_dates(d.withColumn("d", F.col("date_text")), ["d"], 2025)
    out = out.withColumn("is_pre_1900", C.flag_before_year("date_text", 1900))
    return out.select("o_orderkey", "d", "is_pre_1900")


@query("c3_c8_c12_keys_and_fixes", with_star("""
SELECT c_custkey, lower(trim(c_name)) AS name_key,
  CASE c_name WHEN 'Customer#000000003' THEN 'AUTOMOBILE' WHEN 'Customer#000000007' THEN 'MACHINERY'
       ELSE c_mktsegment END AS segment,
  COALESCE(CASE WHEN c_acctbal > 9000 THEN 'VIP' END, CASE c_name WHEN 'Customer#000000003' THEN 'AUTOMOBILE'
    WHEN 'Customer#000000007' THEN 'MACHINERY' ELSE c_mktsegment END) AS tagged
FROM customer"""))
def c3_c8_c12_keys_and_fixes(spark, sf):
    c = _tables(spark, sf)["customer"]
    fixes = {"Customer#000000003": "AUTOMOBILE", "Customer#000000007": "MACHINERY"}
    out = CL.fix_values(c, "c_name", "c_mktsegment", fixes)
    return out.select("c_custkey", C.normalise_key("c_name").alias("name_key"),
                      F.col("c_mktsegment").alias("segment"),
                      C.overwrite_if_present("c_mktsegment", F.when(F.col("c_acctbal") > 9000, F.lit("VIP")))
                      .alias("tagged"))


@query("c9_map_codes", with_star("""
SELECT c.c_custkey, n.n_name AS country,
  COALESCE(CASE n.n_name WHEN 'GERMANY' THEN 'DEU' WHEN 'FRANCE' THEN 'FRA' END, CAST(n.n_nationkey AS VARCHAR)) AS code
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""))
def c9_map_codes(spark, sf):
    t = _tables(spark, sf)
    c = t["customer"].join(F.broadcast(t["nation"].select("n_nationkey", F.col("n_name").alias("country"))),
                           F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "country")
    return CL.map_codes(c, "country", "code", t["nation"], "n_name", "n_nationkey",
                        {"GERMANY": "DEU", "FRANCE": "FRA"})


# Three-letter codes of the nations kept as a table; two by hand, and every eleventh nation has none.
_CODES_SQL = """codes AS (
  SELECT n_name AS name, CASE n_name WHEN 'NATION_3' THEN 'THR' WHEN 'NATION_11' THEN 'ELV'
    ELSE concat('N', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) END AS code
  FROM nation WHERE n_nationkey % 11 <> 0 OR n_name = 'NATION_11'),
named AS (SELECT c_custkey, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _code_table(spark, sf):
    n = _tables(spark, sf)["nation"]
    coded = n.where(F.col("n_nationkey") % 11 != 0).select("n_name", F.concat(
        F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("code"))
    return CL.code_table(coded, "n_name", "code", {"NATION_3": "THR", "NATION_11": "ELV"})


def _named(spark, sf):
    t = _tables(spark, sf)
    return t["customer"].join(t["nation"].select("n_nationkey", F.col("n_name").alias("country")),
                              F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "country")


@query("c9_name_to_code", f"""WITH {_CODES_SQL}
SELECT c_custkey, country, code FROM named LEFT JOIN codes ON country = name""")
def c9_name_to_code(spark, sf):
    return CL.map_by_table(_named(spark, sf), "country", "code", _code_table(spark, sf))


@query("c9_code_to_name", f"""WITH {_CODES_SQL}
SELECT c_custkey, codes.code, name AS country FROM named LEFT JOIN codes ON country = name""")
def c9_code_to_name(spark, sf):
    codes = _code_table(spark, sf)
    coded = CL.map_by_table(_named(spark, sf), "country", "code", codes).drop("country")
    return CL.map_by_table(coded, "code", "country", codes, reverse=True)


@query("c9_unmapped_codes", f"""WITH {_CODES_SQL}
SELECT country, COUNT(*) AS n FROM named LEFT JOIN codes ON country = name WHERE code IS NULL GROUP BY country""")
def c9_unmapped_codes(spark, sf):
    return CL.unmapped_codes(CL.map_by_table(_named(spark, sf), "country", "code", _code_table(spark, sf)), "country", "code")


# Regions as "codes" of nations: each is shared by several.
@query("c9_code_conflicts", """
SELECT 'value' AS side, r_name AS item, COUNT(DISTINCT n_name) AS n FROM nation JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name HAVING COUNT(DISTINCT n_name) > 1""")
def c9_code_conflicts(spark, sf):
    t = _tables(spark, sf)
    regions = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return CL.code_conflicts(CL.code_table(regions, "n_name", "r_name"))


@query("c10_c11_delimited_items", with_star("""
SELECT startup_id, category_list, primary_category, category_count FROM feat"""))
def c10_c11_delimited_items(spark, sf):
    e = entities(spark, sf)
    return e.select("startup_id", "category_list", C.first_item("category_list").alias("primary_category"),
                    C.item_count("category_list").alias("category_count"))


@query("c13_u4_date_dimension", with_star("""
SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
  CAST(day(d) AS INTEGER) AS day, strftime(d, '%A') AS day_name
FROM (SELECT founded_at AS d FROM star UNION SELECT first_funding_at FROM star UNION SELECT last_funding_at FROM star) x
WHERE d IS NOT NULL"""))
def c13_u4_date_dimension(spark, sf):
    return star_from_tables(spark, sf).dim_date


@query("c14_c23_date_keys", with_star("""
SELECT startup_id, CAST(strftime(first_funding_at, '%Y%m%d') AS INTEGER) AS first_funding_date_id,
  CAST(floor(CAST(strftime(first_funding_at, '%Y%m%d') AS INTEGER) / 10000) AS INTEGER) AS first_funding_year
FROM star"""))
def c14_c23_date_keys(spark, sf):
    f = _wh(spark, sf)["fact_startup_funding"]
    return f.select("startup_id", "first_funding_date_id",
                    C.year_from_key("first_funding_date_id").alias("first_funding_year"))


@query("c15_c22_engineered_features", with_star("""
SELECT startup_id, years_since_founded, days_to_first_funding, funding_span_days, avg_funding_per_round,
  is_multi_round, num_round_types_used, has_debt_financing, log_funding_total_usd, furthest_round_type,
  furthest_stage_category, is_exited, is_closed FROM feat"""))
def c15_c22_engineered_features(spark, sf):
    return star_from_tables(spark, sf).wide.select(
        "startup_id", "years_since_founded", "days_to_first_funding", "funding_span_days", "avg_funding_per_round",
        "is_multi_round", "num_round_types_used", "has_debt_financing", "log_funding_total_usd",
        "furthest_round_type", "furthest_stage_category", "is_exited", "is_closed")


@query("c25_c28_filters_and_clip", with_star("""
SELECT startup_id, name, LEAST(GREATEST(CAST(funding_total_usd AS DOUBLE), 100000.0), 400000.0) AS funding_clipped
FROM feat WHERE market IN ('BUILDING', 'MACHINERY') AND funding_rounds >= 2 AND is_multi_round
  AND ((years_since_founded BETWEEN 0 AND 5) OR years_since_founded IS NULL)
  AND COALESCE(contains(lower(name), lower('000000')), false)"""))
def c25_c28_filters_and_clip(spark, sf):
    w = wide(spark, sf)
    out = CL.filter_rows(w, isin={"market": ["BUILDING", "MACHINERY"]}, at_least={"funding_rounds": 2},
                         flags=["is_multi_round"])
    out = out.where(C.in_range_keep_null("years_since_founded", 0, 5)).where(C.search_contains("name", "000000"))
    return out.select("startup_id", "name", C.clip("funding", 100000.0, 400000.0).alias("funding_clipped"))


@query("c29_c31_labels", with_star("""
SELECT startup_id,
  CASE WHEN f IS NULL THEN '-' WHEN abs(f) >= 1e9 THEN '$' || format('{:.1f}', f / 1e9) || 'B'
       WHEN abs(f) >= 1e6 THEN '$' || format('{:.1f}', f / 1e6) || 'M'
       WHEN abs(f) >= 1e3 THEN '$' || format('{:.1f}', f / 1e3) || 'K' ELSE '$' || format('{:.0f}', f) END AS money,
  CASE WHEN r IS NULL THEN NULL ELSE format('{:.1f}', r * 100) || '%' END AS pct,
  CASE WHEN f >= 1000000 THEN 'High' WHEN f >= 300000 THEN 'Medium' ELSE 'Low' END AS tier,
  CASE WHEN funding_rounds > 0 AND funding_rounds <= 1 THEN '1' WHEN funding_rounds > 1 AND funding_rounds <= 2 THEN '2'
       WHEN funding_rounds > 2 AND funding_rounds <= 3 THEN '3' WHEN funding_rounds > 3 AND funding_rounds <= 1000 THEN '4+'
  END AS rounds_bin
FROM (SELECT startup_id, funding_rounds, CAST(funding_total_usd AS DOUBLE) AS f,
        CAST(num_round_types_used AS DOUBLE) / 5 AS r FROM feat) x"""))
def c29_c31_labels(spark, sf):
    w = wide(spark, sf).withColumn("r", F.col("num_round_types_used").cast("double") / 5)
    return w.select("startup_id", C.money_label("funding", 1).alias("money"),
                    C.percent_label("r", 1).alias("pct"),
                    C.tier("funding", [1000000, 300000], ["High", "Medium"], default="Low").alias("tier"),
                    C.tier("funding_rounds", [0, 1, 2, 3, 1000], ["1", "2", "3", "4+"], closed="right")
                    .alias("rounds_bin"))


@query("c32_c33_interaction_and_casts", with_star("""
SELECT startup_id, funding_rounds * num_round_types_used AS product,
  CAST(funding_rounds AS DOUBLE) / NULLIF(CAST(num_round_types_used AS DOUBLE), 0) AS rate,
  CAST(is_multi_round AS INTEGER) AS is_multi_round, CAST(has_debt_financing AS INTEGER) AS has_debt_financing
FROM feat"""))
def c32_c33_interaction_and_casts(spark, sf):
    f = _wh(spark, sf)["fact_startup_funding"]
    ia = C.interaction("funding_rounds", "num_round_types_used")
    return f.select("startup_id", ia["product"].alias("product"), ia["rate"].alias("rate"),
                    C.cast_flag("is_multi_round").alias("is_multi_round"),
                    C.cast_flag("has_debt_financing").alias("has_debt_financing"))


@query("c34_group_top_n", with_star("""
WITH top AS (SELECT country_name FROM feat WHERE country_name IS NOT NULL GROUP BY country_name
             ORDER BY COUNT(*) DESC, country_name LIMIT 5)
SELECT startup_id, COALESCE(t.country_name, 'Other') AS country_grouped
FROM feat f LEFT JOIN top t ON f.country_name = t.country_name"""))
def c34_group_top_n(spark, sf):
    w = wide(spark, sf).select("startup_id", "country_name")
    return CL.group_top_n(w, "country_name", 5, out="country_grouped").select("startup_id", "country_grouped")


@query("c35_distinct_sorted", with_star("""
SELECT DISTINCT region FROM feat WHERE region IS NOT NULL"""))
def c35_distinct_sorted(spark, sf):
    return CL.distinct_sorted(wide(spark, sf), "region")


_LINES_SQL = """lines AS (
  SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INTEGER) AS line_no,
         unnest(string_split(text, chr(10))) AS line FROM documents)"""


# Every document's lines as an insights report: by line number, headings, numbered bold items and plain lines.
_REPORT_SQL = _LINES_SQL + r""",
report AS (
  SELECT doc_id, line_no, CASE WHEN line_no % 4 = 2 THEN '## Part ' || CAST((doc_id + line_no) % 5 AS VARCHAR)
    WHEN line_no % 4 IN (3, 0) THEN CAST(line_no AS VARCHAR) || '. **' || line || '**' ELSE line END AS line FROM lines),
heads AS (SELECT doc_id, line_no, line,
    CASE WHEN regexp_matches(line, '^\s*##\s+(.+?)\s*$') THEN regexp_extract(line, '^\s*##\s+(.+?)\s*$', 1) END AS h
  FROM report),
sections AS (SELECT *, coalesce(last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'General') AS section FROM heads),
found AS (SELECT doc_id, line_no, section, CAST(regexp_extract(line, '^\s*(\d+)\.\s+(.*\S)\s*$', 1) AS INTEGER) AS number,
        trim(replace(regexp_extract(line, '^\s*(\d+)\.\s+(.*\S)\s*$', 2), '**', '')) AS item
      FROM sections WHERE regexp_matches(line, '^\s*(\d+)\.\s+(.*\S)\s*$')),
items AS (SELECT doc_id, number, section, item FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id, number ORDER BY line_no) AS rn FROM found) x WHERE rn = 1)"""


def _report_items(spark, sf):
    def line(text, i):
        no = i + 1
        return (F.when(no % 4 == 2, F.concat(F.lit("## Part "), ((F.col("doc_id") + no) % 5).cast("string")))
                 .when((no % 4 == 3) | (no % 4 == 0), F.concat(no.cast("string"), F.lit(". **"), text, F.lit("**")))
                 .otherwise(text))
    docs = _tables(spark, sf)["documents"].select(
        "doc_id", F.array_join(F.transform(F.split("text", "\n"), line), "\n").alias("text"))
    return K.extract_numbered_items(docs, "doc_id")


@query("c36_k2_numbered_items", with_star("SELECT doc_id, number, section, item FROM items", _REPORT_SQL))
def c36_k2_numbered_items(spark, sf):
    return _report_items(spark, sf)


@query("k2_search_insights", with_star("""
SELECT doc_id, number, section, item FROM items WHERE section = 'Part 2' AND contains(lower(item), 'th')""", _REPORT_SQL))
def k2_search_insights(spark, sf):
    return K.search_insights(_report_items(spark, sf), "th", "Part 2")


# =============================================================================
# text
# =============================================================================

@query("s8_text_lines", with_star("""
SELECT doc_id, COUNT(*) AS lines, COUNT(*) FILTER (WHERE trim(line) = '') AS blank_lines,
  CAST(MAX(line_no) AS INTEGER) AS last_line FROM lines GROUP BY doc_id""", _LINES_SQL))
def s8_text_lines(spark, sf):
    ln = text_lines(_tables(spark, sf)["documents"], "doc_id")
    return ln.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"),
                                    F.count_if(F.trim("line") == "").alias("blank_lines"),
                                    F.max("line_no").cast("int").alias("last_line"))


@query("k1_search_documents", with_star("""
SELECT doc_id, line_no, line, CAST(hit_no AS INTEGER) AS hit_no, matches FROM (
  SELECT doc_id, line_no, line, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY line_no) AS hit_no,
    COUNT(*) OVER (PARTITION BY doc_id) AS matches
  FROM lines WHERE trim(line) <> '' AND contains(lower(line), 'the')) h WHERE hit_no <= 3""", _LINES_SQL))
def k1_search_documents(spark, sf):
    out = K.search_documents(_tables(spark, sf)["documents"], "doc_id", "The", 3)
    return out.withColumn("hit_no", F.col("hit_no").cast("int"))


# =============================================================================
# J-series
# =============================================================================

@query("j1_enrich_left", with_star("""
WITH extra AS (SELECT o_custkey, max_by(o_orderpriority, o_orderkey) AS latest_priority FROM orders
               WHERE o_orderstatus = 'P' GROUP BY o_custkey)
SELECT c_custkey, COALESCE(e.latest_priority, c.c_mktsegment) AS c_mktsegment, e.latest_priority
FROM customer c LEFT JOIN extra e ON c.c_custkey IS NOT DISTINCT FROM e.o_custkey"""))
def j1_enrich_left(spark, sf):
    t = _tables(spark, sf)
    extra = (t["orders"].where(F.col("o_orderstatus") == "P").groupBy("o_custkey")
             .agg(F.max_by("o_orderpriority", "o_orderkey").alias("latest_priority"))
             .select(F.col("o_custkey").alias("c_custkey"), F.col("latest_priority").alias("c_mktsegment"),
                     "latest_priority"))
    base = t["customer"].select("c_custkey", "c_mktsegment")
    return J.enrich_left(base, extra, "c_custkey", overwrite=["c_mktsegment"], add=["latest_priority"])


@query("j2_u1_append_missing", with_star("""
SELECT startup_id, CAST(funding_total_usd AS DOUBLE) AS funding FROM star
  WHERE funding_total_usd IS NOT NULL
UNION ALL
SELECT c_custkey, NULL FROM customer WHERE c_custkey NOT IN
  (SELECT startup_id FROM star WHERE funding_total_usd IS NOT NULL)"""))
def j2_u1_append_missing(spark, sf):
    e = entities(spark, sf).where(F.col("funding_total_usd").isNotNull()) \
        .select("startup_id", F.col("funding_total_usd").cast("double").alias("funding"))
    other = _tables(spark, sf)["customer"].select(F.col("c_custkey").alias("startup_id"),
                                                 F.col("c_name").alias("name"))
    return J.append_missing(e, other, "startup_id")


@query("j3_u3_dimension_keys", with_star("""
SELECT startup_id, CAST(DENSE_RANK() OVER (ORDER BY country_name NULLS FIRST, region NULLS FIRST, city NULLS FIRST)
  AS BIGINT) AS geography_id,
  CAST(DENSE_RANK() OVER (ORDER BY primary_category NULLS FIRST, market NULLS FIRST) AS BIGINT) AS industry_id
FROM feat"""))
def j3_u3_dimension_keys(spark, sf):
    return star_from_tables(spark, sf).fact_startup_funding.select("startup_id", "geography_id", "industry_id")


_MATCH_REF_SQL = """ref AS (
  SELECT lower(trim(c.c_name)) AS name_key, n.n_name AS country_name, o.o_orderkey,
    CAST(o.o_totalprice AS DOUBLE) AS valuation
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE o.o_orderstatus = 'F' AND o.o_orderpriority = '1-URGENT'),
ref1 AS (SELECT name_key, country_name, min_by(valuation, o_orderkey) AS valuation FROM ref
         GROUP BY name_key, country_name)"""


def _match_ref(t):
    o, c, n = t["orders"], t["customer"], t["nation"]
    return (o.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
             .join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
             .select(C.normalise_key("c_name").alias("name_key"), F.col("n_name").alias("country_name"),
                     "o_orderkey", F.col("o_totalprice").cast("double").alias("valuation")))


@query("j4_match_entities", with_star("""
SELECT s.startup_id, r.valuation, r.valuation IS NOT NULL AS is_matched
FROM star s LEFT JOIN ref1 r ON lower(trim(s.name)) IS NOT DISTINCT FROM r.name_key
  AND s.country_name IS NOT DISTINCT FROM r.country_name""", _MATCH_REF_SQL))
def j4_match_entities(spark, sf):
    t = _tables(spark, sf)
    e = entities(spark, sf).select("startup_id", C.normalise_key("name").alias("name_key"), "country_name")
    out = J.match_entities(e, _match_ref(t), ["name_key", "country_name"], ["o_orderkey"], ["valuation"],
                           flag="is_matched")
    return out.select("startup_id", "valuation", "is_matched")


@query("d13_match_rate", with_star("""
SELECT COUNT(*) FILTER (WHERE r.valuation IS NOT NULL) AS matched, (SELECT COUNT(*) FROM ref) AS reference_rows,
  CAST(COUNT(*) FILTER (WHERE r.valuation IS NOT NULL) AS DOUBLE) * 100 / (SELECT COUNT(*) FROM ref) AS match_pct
FROM star s LEFT JOIN ref1 r ON lower(trim(s.name)) IS NOT DISTINCT FROM r.name_key
  AND s.country_name IS NOT DISTINCT FROM r.country_name""", _MATCH_REF_SQL))
def d13_match_rate(spark, sf):
    t = _tables(spark, sf)
    e = entities(spark, sf).select("startup_id", C.normalise_key("name").alias("name_key"), "country_name")
    out = J.match_entities(e, _match_ref(t), ["name_key", "country_name"], ["o_orderkey"], ["valuation"],
                           flag="is_matched", check_rows=False)
    return D.match_rate(out, "is_matched", _match_ref(t))


@query("j7_date_roles", with_star("""
SELECT startup_id, CAST(year(founded_at) AS INTEGER) AS founded_year, CAST(year(first_funding_at) AS INTEGER)
  AS first_funding_year FROM feat"""))
def j7_date_roles(spark, sf):
    return wide(spark, sf).select("startup_id", F.col("fd_year").alias("founded_year"),
                                  F.col("ff_year").alias("first_funding_year"))


_BRIDGE_SQL = """pairs AS (
  SELECT DISTINCT l.l_suppkey, p.p_brand AS member FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
members AS (SELECT member, CAST(ROW_NUMBER() OVER (ORDER BY member) AS BIGINT) AS member_id
            FROM (SELECT DISTINCT member FROM pairs) m)"""


@query("j9_b11_bridge_portfolio", with_star("""
SELECT m.member_id, m.member, COUNT(DISTINCT p.l_suppkey) AS portfolio_count,
  CAST(RANK() OVER (ORDER BY COUNT(DISTINCT p.l_suppkey) DESC) AS BIGINT) AS member_rank
FROM pairs p JOIN members m ON p.member = m.member GROUP BY m.member_id, m.member""", _BRIDGE_SQL))
def j9_b11_bridge_portfolio(spark, sf):
    from ..operators.windows import global_ranks
    lists = testbed.investor_lists(_tables(spark, sf))
    dim, bridge = J.build_bridge(lists, "l_suppkey", "brands", ",", member="member", member_key="member_id")
    counts = bridge.groupBy("member_id").agg(F.count_distinct("l_suppkey").alias("portfolio_count"))
    out = dim.join(counts, "member_id")
    return global_ranks(out, {"member_rank": "portfolio_count"})


@query("j10_left_join_fill", with_star("""
SELECT c.c_custkey, COALESCE(o.n_orders, 0) AS n_orders FROM customer c
LEFT JOIN (SELECT o_custkey, COUNT(*) AS n_orders FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) o
  ON c.c_custkey = o.o_custkey"""))
def j10_left_join_fill(spark, sf):
    t = _tables(spark, sf)
    o = t["orders"].where(F.col("o_orderpriority") == "1-URGENT").groupBy(F.col("o_custkey").alias("c_custkey")) \
        .agg(F.count(F.lit(1)).alias("n_orders"))
    return J.left_join_fill(t["customer"].select("c_custkey"), o, "c_custkey", 0)


@query("j11_semi_join_top_n", with_star("""
WITH top AS (SELECT l_suppkey FROM lineitem GROUP BY l_suppkey ORDER BY COUNT(*) DESC, l_suppkey LIMIT 5)
SELECT l_suppkey, COUNT(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM top) GROUP BY l_suppkey"""))
def j11_semi_join_top_n(spark, sf):
    li = _tables(spark, sf)["lineitem"].select("l_suppkey")
    return J.semi_join_top_n(li, "l_suppkey", 5).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


# =============================================================================
# U-series
# =============================================================================

_LI_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("u2_w8_dedupe_keep_first", with_star(f"""
SELECT {', '.join(_LI_COLS)} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag,
             l_linestatus) AS rn
  FROM lineitem) x WHERE rn = 1"""))
def u2_w8_dedupe_keep_first(spark, sf):
    li = _tables(spark, sf)["lineitem"].select(*_LI_COLS)
    return U.dedupe_keep_first(li, ["l_orderkey", "l_linenumber"],
                               ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
                                "l_discount", "l_tax", "l_returnflag", "l_linestatus"])


@query("u3_build_dimension", with_star("""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY country_name NULLS FIRST, region NULLS FIRST, city NULLS FIRST) AS BIGINT)
  AS geography_id, country_name, region, city
FROM (SELECT DISTINCT country_name, region, city FROM feat) d"""))
def u3_build_dimension(spark, sf):
    return star_from_tables(spark, sf).dim_geography


@query("u5_unpivot_positive", with_star("""
SELECT startup_id, rt.round_type_id, CAST(amount_usd AS DOUBLE) AS amount_usd
FROM fact_type ft JOIN round_type rt ON ft.round_type_name = rt.round_type_name"""))
def u5_unpivot_positive(spark, sf):
    fb = star_from_tables(spark, sf).fact_funding_by_type
    return fb.select("startup_id", "round_type_id", F.col("amount_usd").cast("double").alias("amount_usd"))


@query("u6_crosstab", with_star("""
SELECT market, COUNT(*) FILTER (WHERE status = 'operating') AS operating,
  COUNT(*) FILTER (WHERE status = 'acquired') AS acquired, COUNT(*) FILTER (WHERE status = 'closed') AS closed,
  COUNT(*) FILTER (WHERE status = 'ipo') AS ipo FROM feat GROUP BY market"""))
def u6_crosstab(spark, sf):
    return U.crosstab(wide(spark, sf), "market", "status", ["operating", "acquired", "closed", "ipo"])


@query("u7_compare_keys", with_star("""
WITH ka AS (SELECT DISTINCT c_custkey AS key FROM customer),
kb AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1996-07-01')
SELECT COALESCE(ka.key, kb.key) AS key,
  CASE WHEN ka.key IS NOT NULL AND kb.key IS NOT NULL THEN 'both' WHEN ka.key IS NOT NULL THEN 'left_only'
       ELSE 'right_only' END AS side
FROM ka FULL JOIN kb ON ka.key = kb.key"""))
def u7_compare_keys(spark, sf):
    t = _tables(spark, sf)
    o = t["orders"].where(F.col("o_orderdate") < F.lit(domain.STAR_FUNDING_CUTOFF).cast("timestamp_ntz"))
    return U.compare_keys(t["customer"], o, "c_custkey", "o_custkey")


@query("u8_reindex_categories", with_star("""
SELECT furthest_stage_category, COUNT(*) AS n, CAST(p.position AS INTEGER) AS position FROM feat f
JOIN (VALUES ('Early Stage', 1), ('Venture', 2), ('Growth', 3), ('Late Stage / Public', 4), ('Debt', 5))
  AS p(cat, position) ON f.furthest_stage_category = p.cat GROUP BY furthest_stage_category, p.position"""))
def u8_reindex_categories(spark, sf):
    agg = wide(spark, sf).groupBy("furthest_stage_category").agg(F.count(F.lit(1)).alias("n"))
    return U.reindex_categories(agg, "furthest_stage_category",
                                ["Early Stage", "Venture", "Growth", "Late Stage / Public", "Debt"])


# =============================================================================
# D-series
# =============================================================================

@query("d1_row_reconciliation", with_star("""
SELECT 'orders' AS source, COUNT(*) AS raw_rows, CAST(0 AS BIGINT) AS blank_rows,
  (SELECT COUNT(*) FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1996-07-01') AS kept_rows FROM orders"""))
def d1_row_reconciliation(spark, sf):
    o = _tables(spark, sf)["orders"]
    kept = o.where(F.col("o_orderdate") < F.lit(domain.STAR_FUNDING_CUTOFF).cast("timestamp_ntz"))
    return D.row_reconciliation({"orders": o}, {"orders": kept})


_ENT_COLS = ["startup_id", "name", "country_name", "region", "city", "market", "category_list", "status",
             "founded_at", "funding_total_usd"]


@query("d2_null_profile", with_star(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", AVG(CAST({c} IS NULL AS DOUBLE)) * 100 AS null_pct FROM star" for c in _ENT_COLS)))
def d2_null_profile(spark, sf):
    return D.null_profile(entities(spark, sf).select(*_ENT_COLS))


@query("d3_validity", with_star("""
SELECT 'funding_total_usd' AS "column", COUNT(funding_total_usd) AS non_null, MIN(CAST(funding_total_usd AS DOUBLE)) AS min,
  MAX(CAST(funding_total_usd AS DOUBLE)) AS max, COUNT(*) FILTER (WHERE funding_total_usd <= 0) AS non_positive
FROM star"""))
def d3_validity(spark, sf):
    return D.validity(entities(spark, sf), "funding_total_usd")


@query("d4_duplicate_keys", with_star("""
SELECT COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL"""))
def d4_duplicate_keys(spark, sf):
    return D.duplicate_keys(_tables(spark, sf)["lineitem"], ["l_orderkey", "l_linenumber"])


@query("d5_source_overview", with_star("""
SELECT 'lineitem' AS source, COUNT(*) AS rows, CAST(11 AS BIGINT) AS columns, CAST(0 AS BIGINT) AS blank_rows,
  COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lineitem) d) AS duplicate_rows FROM lineitem"""))
def d5_source_overview(spark, sf):
    return D.source_overview(_tables(spark, sf)["lineitem"], "lineitem")


@query("d7_cardinality", with_star("""
SELECT "column", distinct_count, CAST(distinct_count AS DOUBLE) / CAST(n AS DOUBLE) * 100 AS distinct_pct FROM (
  SELECT 'c_nationkey' AS "column", COUNT(DISTINCT c_nationkey) AS distinct_count, COUNT(*) AS n FROM customer
  UNION ALL SELECT 'c_mktsegment', COUNT(DISTINCT c_mktsegment), COUNT(*) FROM customer
  UNION ALL SELECT 'c_name', COUNT(DISTINCT c_name), COUNT(*) FROM customer) x"""))
def d7_cardinality(spark, sf):
    return D.cardinality(_tables(spark, sf)["customer"], ["c_nationkey", "c_mktsegment", "c_name"])


@query("d9_key_overlap", with_star("""
SELECT 'raw' AS stage, (SELECT COUNT(*) FROM (SELECT DISTINCT c_name AS k FROM customer) a
  JOIN (SELECT DISTINCT upper(c_name) || ' ' AS k FROM customer) b ON a.k = b.k) AS shared_keys
UNION ALL SELECT 'normalised', (SELECT COUNT(*) FROM (SELECT DISTINCT lower(trim(c_name)) AS k FROM customer) a
  JOIN (SELECT DISTINCT lower(trim(upper(c_name) || ' ')) AS k FROM customer) b ON a.k = b.k)"""))
def d9_key_overlap(spark, sf):
    c = _tables(spark, sf)["customer"]
    b = c.select(F.concat(F.upper("c_name"), F.lit(" ")).alias("c_name"))
    return D.key_overlap(c, b, "c_name")


@query("d10_delimiter_audit", with_star("""
SELECT CAST(COUNT(*) FILTER (WHERE starts_with(category_list, '|')) AS DOUBLE) / CAST(COUNT(category_list) AS DOUBLE) * 100
    AS leading_pct,
  CAST(COUNT(*) FILTER (WHERE ends_with(category_list, '|')) AS DOUBLE) / CAST(COUNT(category_list) AS DOUBLE) * 100
    AS trailing_pct,
  CAST(COUNT(*) FILTER (WHERE split_part(category_list, '|', 1) = '') AS DOUBLE) / CAST(COUNT(category_list) AS DOUBLE)
    * 100 AS naive_empty_pct,
  CAST(COUNT(*) FILTER (WHERE category_list IS NOT NULL AND primary_category IS NULL) AS DOUBLE)
    / CAST(COUNT(category_list) AS DOUBLE) * 100 AS fixed_missing_pct
FROM feat"""))
def d10_delimiter_audit(spark, sf):
    return D.delimiter_audit(entities(spark, sf), "category_list", "|")


@query("d11_before_after", with_star("""
SELECT 'before' AS stage, COUNT(*) AS rows, COUNT(*) FILTER (WHERE date_text IS NULL) AS nulls,
  COUNT(DISTINCT date_text) AS distinct_values FROM dirty
UNION ALL SELECT 'after', COUNT(*), COUNT(*) FILTER (WHERE d IS NULL), COUNT(DISTINCT d) FROM (
  SELECT CASE WHEN year(TRY_CAST(date_text AS DATE)) <= 2025 THEN TRY_CAST(date_text AS DATE) END AS d FROM dirty) x""",
    _DIRTY_MONEY_SQL))
def d11_before_after(spark, sf):
    d = dirty(_tables(spark, sf)).select(F.col("date_text").alias("d"))
    after = CL.null_future_dates(d, ["d"], 2025)
    return D.before_after(d, after, "d")


@query("d12_name_collision_audit", with_star("""
SELECT p_type, COUNT(DISTINCT p_brand) AS groups FROM part WHERE p_type IS NOT NULL GROUP BY p_type
HAVING COUNT(DISTINCT p_brand) > 1"""))
def d12_name_collision_audit(spark, sf):
    return D.name_collision_audit(_tables(spark, sf)["part"], "p_type", "p_brand")


def _star_spec():
    from .star import CONSTRAINTS
    return {**CONSTRAINTS, "dim_startup": {**CONSTRAINTS["dim_startup"], "max_length": {"name": 18}}}


@query("d15_check_constraints", with_star("""
SELECT * FROM (VALUES
 ('fact_startup_funding', 'primary_key_duplicates', 'startup_id', 0::BIGINT),
 ('fact_startup_funding', 'primary_key_nulls', 'startup_id', 0::BIGINT),
 ('fact_startup_funding', 'not_null', 'startup_id', 0::BIGINT),
 ('fact_startup_funding', 'foreign_key_orphans:dim_geography', 'geography_id', 0::BIGINT),
 ('fact_startup_funding', 'foreign_key_orphans:dim_industry', 'industry_id', 0::BIGINT),
 ('fact_startup_funding', 'foreign_key_orphans:dim_date', 'first_funding_date_id', 0::BIGINT),
 ('fact_startup_funding', 'foreign_key_orphans:dim_startup', 'startup_id', 0::BIGINT),
 ('dim_startup', 'primary_key_duplicates', 'startup_id', 0::BIGINT),
 ('dim_startup', 'primary_key_nulls', 'startup_id', 0::BIGINT),
 ('dim_geography', 'primary_key_duplicates', 'geography_id', 0::BIGINT),
 ('dim_geography', 'primary_key_nulls', 'geography_id', 0::BIGINT),
 ('dim_date', 'primary_key_duplicates', 'date_id', 0::BIGINT),
 ('dim_date', 'primary_key_nulls', 'date_id', 0::BIGINT),
 ('fact_funding_by_type', 'primary_key_duplicates', 'startup_id,round_type_id', 0::BIGINT),
 ('fact_funding_by_type', 'primary_key_nulls', 'startup_id,round_type_id', 0::BIGINT),
 ('fact_funding_by_type', 'foreign_key_orphans:dim_round_type', 'round_type_id', 0::BIGINT))
 AS v("table", "check", columns, violations)
UNION ALL SELECT 'dim_startup', 'max_length:18', 'name', COUNT(*) FILTER (WHERE length(name) > 18) FROM star
UNION ALL SELECT 'dim_geography', 'unique_duplicates', 'country_name,region,city', CAST(0 AS BIGINT)"""))
def d15_check_constraints(spark, sf):
    return D.check_constraints(_wh(spark, sf), _star_spec())


@query("d16_warehouse_inventory", with_star("""
SELECT 'fact_startup_funding' AS "table", COUNT(*) AS rows, CAST(26 AS BIGINT) AS columns FROM star
UNION ALL SELECT 'fact_funding_by_type', COUNT(*), CAST(3 AS BIGINT) FROM fact_type
UNION ALL SELECT 'dim_round_type', CAST(5 AS BIGINT), CAST(4 AS BIGINT)"""))
def d16_warehouse_inventory(spark, sf):
    t = _wh(spark, sf)
    return D.warehouse_inventory({n: t[n] for n in ["fact_startup_funding", "fact_funding_by_type", "dim_round_type"]})


# Section -> (query, label columns, value columns); the report and its SQL twin are the union of these.
_SECTIONS = {
    "rows": ("d1_row_reconciliation", ["source"], ["raw_rows", "blank_rows", "kept_rows"]),
    "nulls": ("d2_null_profile", ["column"], ["null_pct"]),
    "validity": ("d3_validity", ["column"], ["non_null", "min", "max", "non_positive"]),
    "duplicates": ("d4_duplicate_keys", [], ["duplicate_rows"]),
    "overview": ("d5_source_overview", ["source"], ["rows", "columns", "blank_rows", "duplicate_rows"]),
    "cardinality": ("d7_cardinality", ["column"], ["distinct_count", "distinct_pct"]),
    "overlap": ("d9_key_overlap", ["stage"], ["shared_keys"]),
    "delimiters": ("d10_delimiter_audit", [], ["leading_pct", "trailing_pct", "naive_empty_pct", "fixed_missing_pct"]),
    "before_after": ("d11_before_after", ["stage"], ["rows", "nulls", "distinct_values"]),
    "collisions": ("d12_name_collision_audit", ["p_type"], ["groups"]),
    "match": ("d13_match_rate", [], ["matched", "reference_rows", "match_pct"]),
}


def _report_sql():
    parts = []
    for section, (name, labels, values) in _SECTIONS.items():
        label = " || '/' || ".join(f'CAST("{c}" AS VARCHAR)' for c in labels)
        for v in values:
            check = f"{label} || ':{v}'" if labels else f"'{v}'"
            parts.append(f"SELECT '{section}' AS section, {check} AS \"check\", CAST(\"{v}\" AS DOUBLE) AS value "
                         f"FROM ({CATALOG[name][1]}) q")
    return " UNION ALL ".join(parts)


@query("d17_quality_report", _report_sql())
def d17_quality_report(spark, sf):
    return D.quality_report({section: CATALOG[name][0](spark, sf) for section, (name, _, _) in _SECTIONS.items()})


@query("d13_unmapped_values", """
SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')""")
def d13_unmapped_values(spark, sf):
    known = spark.createDataFrame([("F", "filled"), ("O", "open")], "code string, name string")
    mapped = CL.map_codes(_tables(spark, sf)["orders"].select("o_orderstatus"), "o_orderstatus", "status", known, "code", "name")
    return D.unmapped_values(mapped, "o_orderstatus", "status")


@query("s5_s6_registered_sql", with_star("""
SELECT primary_category, COUNT(*) AS n FROM feat WHERE primary_category IS NOT NULL GROUP BY primary_category"""))
def s5_s6_registered_sql(spark, sf):
    from ..sources.warehouse import QueryRegistry
    reg = QueryRegistry({"by_industry": """
        SELECT i.primary_category, COUNT(*) AS n FROM {fact_startup_funding} f
        JOIN {dim_industry} i ON f.industry_id = i.industry_id
        WHERE i.primary_category IS NOT NULL GROUP BY i.primary_category"""})
    t = _wh(spark, sf)  # S5: the live version's tables, bound to the text
    return reg.run(spark, "by_industry", {n: t[n] for n in ("fact_startup_funding", "dim_industry")})


@query("s7_lookup_table", with_star("""
SELECT rt.stage_category, COUNT(*) AS n FROM fact_type ft JOIN round_type rt ON ft.round_type_name = rt.round_type_name
GROUP BY rt.stage_category"""))
def s7_lookup_table(spark, sf):
    rt = U.literal_table(spark, [(n, c) for n, c, _ in domain.ROUND_TYPES], "round_type_name string, stage_category string")
    fb = _wh(spark, sf)["fact_funding_by_type"].join(F.broadcast(_wh(spark, sf)["dim_round_type"]
                                                                 .select("round_type_id", "round_type_name")),
                                                     "round_type_id")
    return fb.join(F.broadcast(rt), "round_type_name").groupBy("stage_category").agg(F.count(F.lit(1)).alias("n"))


# =============================================================================
# Files and the published warehouse
# =============================================================================

def _scratch(spark, name: str) -> str:
    import hashlib
    import time
    from ..sources.warehouse import warehouse_root
    return warehouse_root(spark, f"{name}-{hashlib.sha1(str(time.time_ns()).encode()).hexdigest()[:10]}")


@query("s1_s3_c1_c2_csv_roundtrip", with_star("""
SELECT o_orderstatus, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY o_orderstatus"""))
def s1_s3_c1_c2_csv_roundtrip(spark, sf):
    """Export orders as CSV with padded header names and blank rows, read it
    back as all-text, trim the names, drop blank rows, parse money."""
    from ..sources.files import read_csv, write_csv
    o = _tables(spark, sf)["orders"]
    padded = o.select(*[F.col(c).cast("string").alias(f" {c} ") for c in o.columns])
    blank = spark.range(3).select(*[F.lit(None).cast("string").alias(f" {c} ") for c in o.columns])
    path = _scratch(spark, "csv-roundtrip")
    write_csv(padded.unionByName(blank), path)
    back = CL.drop_all_null_rows(CL.trim_rename_columns(read_csv(spark, path)))
    return back.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(C.parse_currency("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


# Texts that only raw lines can hold: a mark before the header, letters beyond ASCII, a break inside quotes.
_RAW_SQL = """
SELECT c_mktsegment, COUNT(*) AS n, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total,
  {columns} FROM customer GROUP BY c_mktsegment"""


def _raw_lines(spark, sf, note):
    """Customers as CSV lines with one column of ``note``: (line) per row."""
    c = _tables(spark, sf)["customer"]
    quoted = F.concat(F.lit('"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('"'))
    return c.select(F.concat_ws(",", "c_custkey", "c_mktsegment", F.col("c_acctbal").cast("string"), quoted).alias("line"))


@query("s2_byte_order_mark", _RAW_SQL.format(columns="MIN(concat('Süd — ', c_name)) AS first_note, 0 AS marked"))
def s2_byte_order_mark(spark, sf):
    """Every file starts with U+FEFF before its header, as spreadsheet programs write it."""
    from ..sources.files import read_csv, write_raw_csv
    path = _scratch(spark, "csv-bom")
    lines = _raw_lines(spark, sf, F.concat(F.lit("Süd — "), "c_name"))
    write_raw_csv(lines, path, " c_custkey ,c_mktsegment, c_acctbal,note", mark=True)
    back = read_csv(spark, path)
    named = back.select("c_custkey", "c_mktsegment", "c_acctbal", "note")
    return named.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(C.parse_currency("c_acctbal").cast("decimal(18,2)")).cast("double").alias("total"),
        F.min("note").alias("first_note"), F.count_if(F.col("c_custkey").contains("\ufeff")).cast("int").alias("marked"))


@query("s1_latin1", _RAW_SQL.format(columns="MIN(concat('Großkunde è ', c_name)) AS first_note"))
def s1_latin1(spark, sf):
    """Bytes beyond ASCII stand for one letter each, as in old extracts."""
    from ..sources.files import read_csv
    path = _scratch(spark, "csv-latin1")
    c = _tables(spark, sf)["customer"].select("c_custkey", "c_mktsegment", "c_acctbal", F.concat(F.lit("Großkunde è "), "c_name").alias("note"))
    c.write.option("encoding", "ISO-8859-1").option("header", True).csv(path)
    back = read_csv(spark, path, encoding="ISO-8859-1")
    return back.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(C.parse_currency("c_acctbal").cast("decimal(18,2)")).cast("double").alias("total"),
        F.min("note").alias("first_note"))


@query("s1_quoted_line_breaks", _RAW_SQL.format(columns="MIN(concat('two', chr(10), 'lines \"', c_name, '\"')) AS first_note"))
def s1_quoted_line_breaks(spark, sf):
    from ..sources.files import read_csv, write_raw_csv
    path = _scratch(spark, "csv-breaks")
    lines = _raw_lines(spark, sf, F.concat(F.lit('two\nlines "'), "c_name", F.lit('"')))
    write_raw_csv(lines, path, "c_custkey,c_mktsegment,c_acctbal,note", mark=True)
    back = read_csv(spark, path, multi_line=True)
    return back.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(C.parse_currency("c_acctbal").cast("decimal(18,2)")).cast("double").alias("total"),
        F.min("note").alias("first_note"))


@query("s4_s5_published_warehouse", with_star("""
SELECT 'dim_date' AS "table", COUNT(*) AS rows FROM (SELECT founded_at AS d FROM star UNION SELECT first_funding_at FROM star
  UNION SELECT last_funding_at FROM star) x WHERE d IS NOT NULL
UNION ALL SELECT 'dim_geography', COUNT(*) FROM (SELECT DISTINCT country_name, region, city FROM feat) g
UNION ALL SELECT 'dim_industry', COUNT(*) FROM (SELECT DISTINCT primary_category, market FROM feat) i
UNION ALL SELECT 'dim_round_type', CAST(5 AS BIGINT)
UNION ALL SELECT 'dim_startup', COUNT(*) FROM star
UNION ALL SELECT 'fact_startup_funding', COUNT(*) FROM star
UNION ALL SELECT 'fact_funding_by_type', COUNT(*) FROM fact_type"""))
def s4_s5_published_warehouse(spark, sf):
    t = _wh(spark, sf)
    return D.warehouse_inventory(t).select("table", "rows")


@query("s9_model_save_load", with_star("SELECT startup_id, true AS same FROM feat WHERE log_funding_total_usd IS NOT NULL"))
def s9_model_save_load(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from ..sources.files import load_model, save_model
    w = wide(spark, sf).where(F.col("log_funding_total_usd").isNotNull())
    m = Pipeline(stages=[VectorAssembler(inputCols=["funding_rounds"], outputCol="features"),
                         LinearRegression(featuresCol="features", labelCol="log_funding_total_usd")]).fit(w)
    path = _scratch(spark, "model")
    save_model(m, path)
    back = load_model(path)
    a = m.transform(w).select("startup_id", F.col("prediction").alias("before"))
    b = back.transform(w).select("startup_id", F.col("prediction").alias("after"))
    return a.join(b, "startup_id").select("startup_id", (F.col("before") == F.col("after")).alias("same"))
