"""SQL text of the test star for the DuckDB oracle (FIXTURES §3).

``with_star(body)`` prefixes a query with CTEs ``star`` (entity grain) and
``feat`` (entity grain plus the derived columns of the transform step),
``fact_type`` (unpivoted round amounts), ``trend`` (all orders), ``scored``
(lineitem as a scored test set) and ``lines`` (document lines).
"""

STAR_SQL = """
w AS (
  SELECT o_custkey, o_orderkey, o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS d,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amt
  FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1996-07-01'),
a AS (
  SELECT o_custkey, SUM(amt) AS funding_total_usd, COUNT(*) AS funding_rounds, MIN(d) AS first_funding_at,
    MAX(d) AS last_funding_at, MAX_BY(o_orderstatus, o_orderkey) AS last_status,
    SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN amt ELSE 0 END) AS seed,
    SUM(CASE WHEN o_orderpriority = '2-HIGH' THEN amt ELSE 0 END) AS venture,
    SUM(CASE WHEN o_orderpriority = '3-MEDIUM' THEN amt ELSE 0 END) AS debt_financing,
    SUM(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN amt ELSE 0 END) AS undisclosed,
    SUM(CASE WHEN o_orderpriority = '5-LOW' THEN amt ELSE 0 END) AS private_equity
  FROM w GROUP BY o_custkey),
star AS (
SELECT c.c_custkey AS startup_id, c.c_name AS name,
  CASE WHEN c.c_custkey % 10 = 0 THEN NULL ELSE n.n_name END AS country_name,
  CASE WHEN c.c_custkey % 10 = 0 THEN NULL ELSE r.r_name END AS region,
  CONCAT('City', CAST(c.c_custkey % 40 AS VARCHAR)) AS city,
  c.c_mktsegment AS market,
  CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE CONCAT('|', c.c_mktsegment, '|', CONCAT_WS('|',
    CASE WHEN a.seed > 0 THEN 'Seed' END, CASE WHEN a.venture > 0 THEN 'Venture' END,
    CASE WHEN a.debt_financing > 0 THEN 'Debt' END), '|') END AS category_list,
  CASE WHEN c.c_custkey % 50 = 0 THEN 'ipo' WHEN a.last_status IS NULL AND c.c_custkey % 7 = 0 THEN NULL
       WHEN a.last_status = 'P' AND c.c_custkey % 3 = 0 THEN 'acquired'
       WHEN a.last_status = 'F' AND c.c_custkey % 4 = 0 THEN 'closed' ELSE 'operating' END AS status,
  CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE a.first_funding_at - CAST((c.c_custkey * 37) % 3000 AS INT) END
    AS founded_at,
  a.first_funding_at, a.last_funding_at, a.funding_total_usd, a.funding_rounds,
  a.seed, a.venture, a.debt_financing, a.undisclosed, a.private_equity,
  c.c_acctbal >= 9000 AS is_unicorn,
  CASE WHEN c.c_acctbal >= 9000 THEN floor(c.c_acctbal / 10) / 100 END AS valuation_billion_usd
FROM customer c LEFT JOIN a ON a.o_custkey = c.c_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey),
feat0 AS (
SELECT star.*,
  NULLIF(split_part(trim(category_list, '|'), '|', 1), '') AS primary_category,
  CAST(len(regexp_extract_all(category_list, '[^|]+')) AS INTEGER) AS category_count,
  CASE WHEN round_even((DATE '1997-01-01' - founded_at) / 365.25, 1) >= 0
       THEN round_even((DATE '1997-01-01' - founded_at) / 365.25, 1) END AS years_since_founded,
  CAST(first_funding_at - founded_at AS INTEGER) AS days_to_first_funding,
  CAST(last_funding_at - first_funding_at AS INTEGER) AS funding_span_days,
  CAST(funding_total_usd AS DOUBLE) / NULLIF(CAST(funding_rounds AS DOUBLE), 0) AS avg_funding_per_round,
  COALESCE(funding_rounds, 0) > 1 AS is_multi_round,
  (CASE WHEN seed > 0 THEN 1 ELSE 0 END) + (CASE WHEN venture > 0 THEN 1 ELSE 0 END)
    + (CASE WHEN debt_financing > 0 THEN 1 ELSE 0 END) + (CASE WHEN undisclosed > 0 THEN 1 ELSE 0 END)
    + (CASE WHEN private_equity > 0 THEN 1 ELSE 0 END) AS num_round_types_used,
  COALESCE(debt_financing, 0) > 0 AS has_debt_financing,
  ln(1 + CAST(funding_total_usd AS DOUBLE)) AS log_funding_total_usd,
  CASE WHEN private_equity > 0 THEN 'private_equity' WHEN venture > 0 THEN 'venture'
       WHEN debt_financing > 0 THEN 'debt_financing' WHEN seed > 0 THEN 'seed'
       WHEN undisclosed > 0 THEN 'undisclosed' END AS furthest_round_type,
  COALESCE(status IN ('ipo', 'acquired'), false) AS is_exited,
  COALESCE(status = 'closed', false) AS is_closed,
  CASE WHEN valuation_billion_usd >= 9.8 THEN 'High' WHEN valuation_billion_usd >= 9.4 THEN 'Middle'
       WHEN is_unicorn THEN 'Low' END AS valuation_tier
FROM star),
feat AS (
SELECT feat0.*,
  CASE furthest_round_type WHEN 'private_equity' THEN 'Growth' WHEN 'venture' THEN 'Venture'
       WHEN 'debt_financing' THEN 'Debt' WHEN 'seed' THEN 'Early Stage' WHEN 'undisclosed' THEN 'Undisclosed'
  END AS furthest_stage_category
FROM feat0),
round_type AS (
  SELECT * FROM (VALUES (1, 'seed', 'Early Stage', 1), (2, 'venture', 'Venture', 2),
    (3, 'debt_financing', 'Debt', 2), (4, 'undisclosed', 'Undisclosed', 0), (5, 'private_equity', 'Growth', 9))
    AS t(round_type_id, round_type_name, stage_category, stage_rank)),
fact_type AS (
  SELECT startup_id, round_type_name, amount_usd FROM (
    SELECT startup_id, 'seed' AS round_type_name, seed AS amount_usd FROM star
    UNION ALL SELECT startup_id, 'venture', venture FROM star
    UNION ALL SELECT startup_id, 'debt_financing', debt_financing FROM star
    UNION ALL SELECT startup_id, 'undisclosed', undisclosed FROM star
    UNION ALL SELECT startup_id, 'private_equity', private_equity FROM star) u
  WHERE amount_usd > 0),
trend AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS amt
  FROM orders),
scored AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
         l_discount * 5 + l_tax AS score, l_extendedprice AS actual, l_quantity * 1500 AS predicted
  FROM lineitem)
"""


def with_star(body: str, extra: str = "") -> str:
    """``WITH <star ctes>[, extra] body``."""
    ctes = STAR_SQL.strip()
    if extra:
        ctes = ctes + ",\n" + extra.strip()
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ctes + ",\n" + body[5:]
    return "WITH " + ctes + "\n" + body
