"""DuckDB statements that recompute the registered queries from the parquet views.

Every statement starts from the same prelude: the star schema re-expressed as the eight source tables with all money in
whole cents (``*_c``). The bodies are written independently of the Spark plans.
"""

from __future__ import annotations

from itertools import accumulate
from math import exp, factorial

PRELUDE = """
order_day AS (
  SELECT o_orderkey, o_custkey,
         CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 711 // 2405 AS INTEGER) AS d0
  FROM orders
),
priced AS (
  SELECT o_custkey AS household_key, l_orderkey AS basket_id, CAST(d0 + 1 AS INTEGER) AS day,
         CAST(d0 // 7 + 1 AS INTEGER) AS week_no, l_partkey AS product_id, l_suppkey AS store_id, l_linenumber AS ln,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 997 = 0 THEN 0.0 ELSE l_quantity END AS quantity,
         CASE WHEN (l_orderkey * 3 + l_linenumber) % 991 = 0 THEN 0
              ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS gross_c,
         CAST(round(l_discount * 100) AS BIGINT) AS pct, l_returnflag AS rf, l_linestatus AS ls
  FROM lineitem JOIN order_day ON l_orderkey = o_orderkey
),
signed AS (
  SELECT *, gross_c * pct // 100 AS retail_c,
         CASE WHEN (basket_id + ln) % 17 = 0 THEN gross_c * 5 // 100 END AS coupon_n,
         CASE WHEN (basket_id + ln) % 34 = 0 THEN gross_c * 2 // 100 END AS match_n,
         CASE WHEN (basket_id + ln) % 503 = 0 THEN 'abc' WHEN (basket_id + ln) % 501 = 0 THEN '2575'
              ELSE CAST((basket_id % 24) * 100 + basket_id % 60 AS VARCHAR) END AS clock
  FROM priced
),
tx AS (
  SELECT household_key, basket_id, day, week_no, product_id, store_id, quantity, gross_c, retail_c, coupon_n, match_n,
         coalesce(coupon_n, 0) AS coupon_c, coalesce(match_n, 0) AS match_c,
         retail_c + coalesce(coupon_n, 0) + coalesce(match_n, 0) AS disc_c,
         gross_c - retail_c - coalesce(coupon_n, 0) - coalesce(match_n, 0) AS net_c,
         TRY_CAST(clock AS INTEGER) AS hhmm, rf, ls,
         CAST((week_no + 3) // 4 AS INTEGER) AS period_id, CAST((week_no + 12) // 13 AS INTEGER) AS quarter
  FROM signed
),
goods AS (
  SELECT p_partkey AS product_id, p_partkey % 100 AS manufacturer,
         CASE p_size % 4 WHEN 0 THEN 'Private' ELSE 'National' END AS brand,
         CAST(p_size AS VARCHAR) || ' OZ' AS curr_size_of_product,
         CASE p_partkey % 97 WHEN 0 THEN NULL ELSE p_type END AS department,
         CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN '  '
              WHEN p_partkey % 83 = 0 THEN lower(p_brand) ELSE p_brand END AS commodity_desc,
         p_name AS sub_commodity_desc
  FROM part WHERE p_partkey % 211 <> 0
),
demo AS (
  SELECT c_custkey AS household_key,
         CASE WHEN c_acctbal < 0 THEN '19-24' WHEN c_acctbal < 3000 THEN '25-34'
              WHEN c_acctbal < 6000 THEN '45-54' ELSE '65+' END AS age_desc,
         CASE c_custkey % 2 WHEN 0 THEN 'A' ELSE 'U' END AS marital_status_code, c_mktsegment AS income_desc,
         CASE c_custkey % 5 WHEN 0 THEN NULL ELSE 'Homeowner' END AS homeowner_desc,
         CASE c_custkey % 4 WHEN 0 THEN 'Single' ELSE '2 Adults Kids' END AS hh_comp_desc,
         CASE c_custkey % 7 WHEN 0 THEN '5+' ELSE '2' END AS household_size_desc,
         CASE c_custkey % 9 WHEN 0 THEN '3+' ELSE 'None/Unknown' END AS kid_category_desc
  FROM customer WHERE c_custkey % 3 = 0
),
camp AS (
  SELECT n_nationkey AS campaign, 'Type' || substr('ABC', n_nationkey % 3 + 1, 1) AS kind,
         CAST(30 + 26 * n_nationkey AS INTEGER) AS start_day,
         CAST(62 + 26 * n_nationkey + 7 * (n_nationkey % 4) AS INTEGER) AS end_day
  FROM nation
),
expo AS (
  SELECT c_custkey AS household_key, n_nationkey AS campaign
  FROM customer, nation WHERE (c_custkey * 7 + n_nationkey * 3) % 11 = 0
),
coup AS (
  SELECT 1000 + 10 * n_nationkey + p_partkey % 5 AS coupon_upc, p_partkey AS product_id, n_nationkey AS campaign
  FROM part, nation, range(2) AS copies(copy)
  WHERE (p_partkey + n_nationkey) % 39 = 0 AND (copy = 0 OR (p_partkey + n_nationkey) % 78 = 0)
),
rdm AS (
  SELECT DISTINCT e.household_key, v.day, 1000 + 10 * e.campaign + v.basket_id % 5 AS coupon_upc, e.campaign
  FROM expo e JOIN camp k ON k.campaign = e.campaign
  JOIN tx v ON v.household_key = e.household_key AND v.basket_id % 2 = 0 AND v.day >= k.start_day AND v.day <= k.end_day
),
caus AS (
  SELECT product_id, store_id, week_no, CASE rf WHEN 'R' THEN '1' WHEN 'A' THEN NULL ELSE '0' END AS display,
         CASE WHEN ls = 'O' AND product_id % 5 = 0 THEN 'A' ELSE '0' END AS mailer
  FROM tx, range(2) AS copies(copy) WHERE product_id % 3 <> 0 AND (copy = 0 OR week_no % 10 = 0)
),
"""

# Shared intermediate results, appended to the prelude where a statement needs them.
BASKET = """
basket AS (
  SELECT basket_id, household_key, min(day) AS day, min(week_no) AS week_no, min(store_id) AS store_id,
         CAST(sum(net_c) AS BIGINT) AS spend_c, sum(quantity) AS units, count(*) AS n_lines,
         count(DISTINCT product_id) AS n_products, CAST(sum(retail_c) AS BIGINT) AS retail_c,
         CAST(sum(coupon_c) AS BIGINT) AS coupon_c, CAST(sum(match_c) AS BIGINT) AS match_c,
         CAST(sum(disc_c) AS BIGINT) AS disc_c, CAST(sum(gross_c) AS BIGINT) AS gross_c,
         CAST(bool_or(coupon_c + match_c > 0) AS INTEGER) AS used
  FROM tx GROUP BY ALL
),
"""


def _statement(body: str, *shared: str) -> str:
    ctes = (PRELUDE + "".join(shared)).strip().rstrip(",")
    joiner = ",\n" if body.lstrip().startswith("WITH ") else "\n"
    return "WITH " + ctes + joiner + body.strip().removeprefix("WITH ")


ORACLES: dict[str, str] = {}


def _add(name: str, body: str, *shared: str) -> None:
    ORACLES[name] = _statement(body, *shared)


_add(
    "stg_transactions",
    """
SELECT household_key, basket_id, day, week_no, product_id, quantity, net_c / 100.0 AS sales_value, store_id,
       CASE WHEN retail_c = 0 THEN 0.0 ELSE -retail_c / 100.0 END AS retail_disc_signed,
       CASE WHEN coupon_n = 0 THEN 0.0 ELSE -coupon_n / 100.0 END AS coupon_disc_signed,
       CASE WHEN match_n = 0 THEN 0.0 ELSE -match_n / 100.0 END AS coupon_match_disc_signed,
       retail_c / 100.0 AS retail_discount_amt,
       coupon_c / 100.0 AS coupon_discount_amt, match_c / 100.0 AS coupon_match_discount_amt, hhmm AS trans_time,
       CASE WHEN hhmm >= 0 AND hhmm < 2360 AND hhmm % 100 <= 59 THEN CAST(hhmm // 100 AS INTEGER) END AS trans_hour
FROM tx
""",
)
ORACLES["csv_round_trip"] = ORACLES["stg_transactions"]
_add(
    "receipts_by_hour",
    """
SELECT CASE WHEN hhmm >= 0 AND hhmm < 2360 AND hhmm % 100 <= 59 THEN CAST(hhmm // 100 AS INTEGER) END AS trans_hour,
       count(*) AS transaction_lines, count(DISTINCT basket_id) AS baskets
FROM tx GROUP BY 1
""",
)
_add(
    "mart_baskets",
    """
SELECT basket_id, household_key, day, week_no, store_id, round(spend_c / 100.0, 2) AS basket_spend,
       units AS basket_units, n_lines AS basket_item_line_count, n_products AS distinct_product_count,
       round(retail_c / 100.0, 2) AS total_retail_discount, round(coupon_c / 100.0, 2) AS total_coupon_discount,
       round(match_c / 100.0, 2) AS total_coupon_match_discount, round(gross_c / 100.0, 2) AS gross_sales,
       round(CASE WHEN gross_c > 0 THEN disc_c / gross_c END, 6) AS discount_rate, used AS coupon_used_flag
FROM basket
""",
    BASKET,
)
_add(
    "mart_baskets_legacy",
    """
SELECT basket_id, household_key, day, week_no, store_id, round(spend_c / 100.0, 2) AS basket_spend,
       units AS basket_units, n_lines AS basket_item_line_count, n_products AS distinct_product_count,
       round(retail_c / 100.0, 2) AS total_retail_discount, round(coupon_c / 100.0, 2) AS total_coupon_discount,
       round(match_c / 100.0, 2) AS total_coupon_match_discount,
       round(CASE WHEN spend_c + retail_c > 0 THEN disc_c / (spend_c + retail_c) END, 6) AS discount_rate,
       used AS coupon_used_flag
FROM basket
""",
    BASKET,
)
_add(
    "kpi_summary",
    """
SELECT count(DISTINCT household_key) AS active_households, count(*) AS baskets,
       round(sum(spend_c) / 100.0, 2) AS spend, round(sum(spend_c) / (100.0 * count(*)), 4) AS avg_basket_value,
       sum(units) AS units, round(sum(units) / count(*), 6) AS avg_basket_size,
       round(sum(disc_c) / 100.0, 2) AS discount_amount, CAST(sum(used) AS BIGINT) AS coupon_baskets,
       round(sum(used) / count(*), 6) AS coupon_basket_rate
FROM basket
""",
    BASKET,
)


# --- products and categories -----------------------------------------------------------------------------------------

TOTALS = """
totals AS (SELECT count(DISTINCT basket_id) AS all_b, count(DISTINCT household_key) AS all_h FROM tx),
"""

PRODUCT_BODY = """
WITH per_quarter AS (
  SELECT product_id, quarter, sum(net_c) AS net_c FROM tx GROUP BY product_id, quarter
),
edges AS (SELECT {first} AS q_first, max(quarter) AS q_last FROM per_quarter),
trend AS (
  SELECT product_id, sum(net_c) FILTER (quarter = q_first) AS first_c, sum(net_c) FILTER (quarter = q_last) AS last_c
  FROM per_quarter, edges GROUP BY product_id
),
buyers AS (
  SELECT product_id, count(*) FILTER (visits > 1) AS repeaters
  FROM (SELECT product_id, household_key, count(DISTINCT basket_id) AS visits FROM tx GROUP BY ALL) GROUP BY product_id
),
sold AS (
  SELECT product_id, CAST(sum(net_c) AS BIGINT) AS net_c, sum(quantity) AS units, CAST(sum(disc_c) AS BIGINT) AS disc_c,
         CAST(sum({base}) AS BIGINT) AS base_c, count(DISTINCT basket_id) AS b, count(DISTINCT household_key) AS h
  FROM tx GROUP BY product_id
)
SELECT sold.product_id, {attributes}, round(sold.net_c / 100.0, 2) AS product_sales, units,
       round(b / all_b, 6) AS basket_penetration, round(h / all_h, 6) AS household_penetration,
       round(CASE WHEN base_c > 0 THEN disc_c / base_c END, 6) AS discount_rate,
       round((coalesce(last_c, 0) - coalesce(first_c, 0)) / 100.0, 2) AS sales_growth, {rate}
       repeaters AS repeat_household_count
FROM sold CROSS JOIN totals JOIN trend ON trend.product_id = sold.product_id
JOIN buyers ON buyers.product_id = sold.product_id LEFT JOIN goods g ON g.product_id = sold.product_id
"""
_add(
    "mart_products",
    PRODUCT_BODY.format(
        first="min(quarter)",
        base="gross_c",
        attributes="manufacturer, brand, curr_size_of_product, department, commodity_desc, sub_commodity_desc",
        rate="round(CASE WHEN first_c > 0 THEN (last_c - first_c) / first_c END, 6) AS sales_growth_rate,",
    ),
    TOTALS,
)
_add(
    "mart_products_legacy",
    PRODUCT_BODY.format(
        first="1", base="net_c + retail_c", attributes="department, commodity_desc, sub_commodity_desc", rate=""
    ),
    TOTALS,
)

LABELLED = """
labelled AS (
  SELECT tx.*, ifnull(g.department, 'UNKNOWN') AS department, ifnull(g.commodity_desc, 'UNKNOWN') AS commodity_desc,
         g.department AS raw_department, g.commodity_desc AS raw_commodity
  FROM tx LEFT JOIN goods g ON g.product_id = tx.product_id
),
"""
CATEGORY = """
category AS (
  SELECT department, commodity_desc, CAST(sum(net_c) AS BIGINT) AS net_c, sum(quantity) AS units,
         count(DISTINCT household_key) AS h, count(DISTINCT basket_id) AS b, CAST(sum(disc_c) AS BIGINT) AS disc_c,
         CAST(sum(gross_c) AS BIGINT) AS gross_c, CAST(sum(retail_c) AS BIGINT) AS retail_c,
         CAST(coalesce(sum(net_c) FILTER (week_no <= 52), 0) AS BIGINT) AS early_c,
         CAST(coalesce(sum(net_c) FILTER (week_no > 52), 0) AS BIGINT) AS late_c
  FROM labelled GROUP BY department, commodity_desc
),
"""
CATEGORY_COLUMNS = """department, commodity_desc, round(net_c / 100.0, 2) AS category_sales, units,
       h AS household_count, round(h / all_h, 6) AS household_penetration, round(b / all_b, 6) AS basket_penetration,
       round(CASE WHEN {base} > 0 THEN disc_c / ({base}) END, 6) AS discount_rate,
       round(early_c / 100.0, 2) AS first_year_sales, round(late_c / 100.0, 2) AS second_year_sales,
       round((late_c - early_c) / 100.0, 2) AS sales_growth"""
GROWTH_RATE = "round(CASE WHEN early_c > 0 THEN (late_c - early_c) / early_c END, 6) AS sales_growth_rate"
_add(
    "mart_categories",
    f"SELECT {CATEGORY_COLUMNS.format(base='gross_c')}, {GROWTH_RATE} FROM category, totals",
    TOTALS,
    LABELLED,
    CATEGORY,
)
_add(
    "mart_categories_legacy",
    f"SELECT {CATEGORY_COLUMNS.format(base='net_c + retail_c')} FROM category, totals",
    TOTALS,
    LABELLED,
    CATEGORY,
)
CATEGORY_QUARTER = """
category_quarter AS (
  SELECT department, commodity_desc, quarter, CAST(sum(net_c) AS BIGINT) AS net_c,
         count(DISTINCT household_key) AS h, count(DISTINCT basket_id) AS b
  FROM labelled GROUP BY department, commodity_desc, quarter
),
"""
_add(
    "mart_category_period",
    """
SELECT department, commodity_desc, quarter AS quarter_like_period, round(net_c / 100.0, 2) AS sales, h AS households,
       b AS baskets
FROM category_quarter
""",
    LABELLED,
    CATEGORY_QUARTER,
)
DIAGNOSTICS = (
    CATEGORY_QUARTER
    + """
stability AS (
  SELECT department AS d, commodity_desc AS c, sum(net_c) / (100.0 * count(*)) AS mean_s,
         stddev_samp(net_c / 100.0) AS sd_s, max(h) FILTER (quarter = 1) AS h_first,
         max(h) FILTER (quarter = (SELECT max(quarter) FROM category_quarter)) AS h_last
  FROM category_quarter GROUP BY department, commodity_desc
),
cuts AS (
  SELECT quantile_cont(net_c / 100.0, 0.75) AS sales_cut, quantile_cont(h / all_h, 0.75) AS reach_cut,
         median(net_c / 100.0 / h) AS spend_cut
  FROM category, totals
),
diagnostics AS (
  SELECT category.*, all_h, all_b, mean_s, sd_s, h_last - h_first AS engagement, CAST(h < 50 AS INTEGER) AS small,
         CAST(net_c / 100.0 >= sales_cut AND late_c < early_c AS INTEGER) AS declining,
         CAST(h / all_h >= reach_cut AND net_c / 100.0 / h <= spend_cut AS INTEGER) AS wide_light
  FROM category JOIN stability ON department = d AND commodity_desc = c, totals, cuts
),
"""
)
_add(
    "mart_category_diagnostics",
    f"""
SELECT {CATEGORY_COLUMNS.format(base='gross_c')}, {GROWTH_RATE}, round(mean_s, 6) AS mean_period_sales,
       round(sd_s, 2) AS sd_period_sales, round(sd_s / nullif(mean_s, 0), 6) AS sales_coefficient_of_variation,
       engagement AS household_engagement_change, small AS small_group_flag, declining AS high_sales_declining_flag,
       wide_light AS high_penetration_low_spend_flag
FROM diagnostics
""",
    TOTALS,
    LABELLED,
    CATEGORY,
    DIAGNOSTICS,
)
_add(
    "category_top15",
    f"""
SELECT department, commodity_desc, round(net_c / 100.0, 2) AS category_sales, h AS household_count,
       round(h / all_h, 6) AS household_penetration, round((late_c - early_c) / 100.0, 2) AS sales_growth, {GROWTH_RATE},
       round(sd_s / nullif(mean_s, 0), 6) AS sales_coefficient_of_variation,
       engagement AS household_engagement_change, declining AS high_sales_declining_flag
FROM diagnostics WHERE h >= 50 ORDER BY net_c DESC, department, commodity_desc LIMIT 15
""",
    TOTALS,
    LABELLED,
    CATEGORY,
    DIAGNOSTICS,
)
_add(
    "category_top10",
    """
SELECT commodity_desc, round(net_c / 100.0, 2) AS category_sales, round(h / all_h, 6) AS household_penetration,
       round(CASE WHEN gross_c > 0 THEN disc_c / gross_c END, 6) AS discount_rate,
       round((late_c - early_c) / 100.0, 2) AS sales_growth
FROM category, totals WHERE h >= 50 ORDER BY net_c DESC, department, commodity_desc LIMIT 10
""",
    TOTALS,
    LABELLED,
    CATEGORY,
)
_add(
    "category_growth_leaders",
    """
SELECT commodity_desc, round(early_c / 100.0, 2) AS first_year_sales, round(late_c / 100.0, 2) AS second_year_sales,
       round((late_c - early_c) / 100.0, 2) AS sales_growth, round(h / all_h, 6) AS household_penetration
FROM category, totals WHERE h >= 100 ORDER BY late_c - early_c DESC, department, commodity_desc LIMIT 10
""",
    TOTALS,
    LABELLED,
    CATEGORY,
)

# --- household periods and customers ---------------------------------------------------------------------------------

PERIOD_PARTS = """
bought AS (
  SELECT household_key AS hk, CAST((week_no + 3) // 4 AS INTEGER) AS p, count(*) AS n, min(day) AS d_min,
         max(day) AS d_max, CAST(sum(spend_c) AS BIGINT) AS spend_c, sum(units) AS units,
         CAST(sum(disc_c) AS BIGINT) AS disc_c, CAST(sum(used) AS BIGINT) AS used
  FROM basket GROUP BY 1, 2
),
variety AS (
  SELECT household_key AS hk, period_id AS p, count(DISTINCT product_id) AS n_prod,
         count(DISTINCT coalesce(raw_commodity, raw_department, 'UNKNOWN')) AS n_cat
  FROM labelled GROUP BY 1, 2
),
exposed AS (
  SELECT household_key AS hk, CAST((start_day + 27) // 28 AS INTEGER) AS p, count(*) AS n
  FROM expo JOIN camp ON camp.campaign = expo.campaign GROUP BY 1, 2
),
redeemed AS (SELECT household_key AS hk, CAST((day + 27) // 28 AS INTEGER) AS p, count(*) AS n FROM rdm GROUP BY 1, 2),
"""
HOUSEHOLD_PERIOD = (
    PERIOD_PARTS
    + """
grid AS (
  SELECT hk, CAST(p AS INTEGER) AS p
  FROM (SELECT DISTINCT household_key AS hk FROM basket),
       (SELECT unnest(generate_series(1, (SELECT max(p) FROM bought))) AS p)
),
hp AS (
  SELECT g.hk, g.p, (SELECT max(day) FROM tx) AS last_day, (SELECT max(p) FROM bought) AS last_p,
         b.hk IS NOT NULL AS active, ifnull(b.n, 0) AS n, ifnull(b.spend_c, 0) AS spend_c, ifnull(b.units, 0) AS units,
         b.spend_c / (100.0 * b.n) AS abv, b.units / b.n AS abs, ifnull(b.disc_c, 0) AS disc_c,
         ifnull(b.used, 0) AS used, ifnull(n_prod, 0) AS n_prod, ifnull(n_cat, 0) AS n_cat,
         ifnull(r.n, 0) AS n_red, ifnull(e.n, 0) AS n_exp
  FROM grid g LEFT JOIN bought b ON b.hk = g.hk AND b.p = g.p LEFT JOIN variety v ON v.hk = g.hk AND v.p = g.p
  LEFT JOIN exposed e ON e.hk = g.hk AND e.p = g.p LEFT JOIN redeemed r ON r.hk = g.hk AND r.p = g.p
),
hpw AS (
  SELECT *, lag(spend_c) OVER past AS before_c, ifnull(lag(active) OVER past, false) AS was_active,
         min(CASE WHEN active THEN p END) OVER (PARTITION BY hk) AS cohort
  FROM hp WINDOW past AS (PARTITION BY hk ORDER BY p)
),
"""
)
PERIOD_SHARED = (BASKET, LABELLED, HOUSEHOLD_PERIOD)
_add(
    "mart_household_period",
    """
SELECT hk AS household_key, p AS period_id, 28 * p - 27 AS period_start, least(28 * p, last_day) AS period_end,
       CAST(p = last_p AND 28 * p > last_day AS INTEGER) AS incomplete_period_flag, CAST(active AS INTEGER) AS active_flag,
       n AS basket_count, round(spend_c / 100.0, 2) AS total_spend, CAST(units AS DOUBLE) AS total_units,
       round(abv, 4) AS average_basket_value, round(abs, 6) AS average_basket_size,
       round(disc_c / 100.0, 2) AS total_discount, used AS coupon_basket_count, n_prod AS distinct_product_count,
       n_cat AS distinct_category_count, n_red AS coupon_redemption_count, n_exp AS campaign_exposure_count,
       round(CASE WHEN spend_c + disc_c > 0 THEN disc_c / (spend_c + disc_c) END, 6) AS discount_rate,
       round(before_c / 100.0, 2) AS prior_period_spend, round((spend_c - before_c) / 100.0, 2) AS spend_change,
       CAST(active AND was_active AS INTEGER) AS retention_repeat_flag
FROM hpw
""",
    *PERIOD_SHARED,
)
_add(
    "mart_household_period_active",
    """
SELECT b.hk AS household_key, b.p AS period_id, d_min AS period_start_day, d_max AS period_end_day, 1 AS active_flag,
       b.n AS basket_count, round(spend_c / 100.0, 2) AS total_spend, units AS total_units,
       round(spend_c / (100.0 * b.n), 4) AS average_basket_value, round(units / b.n, 6) AS average_basket_size,
       round(disc_c / 100.0, 2) AS total_discount, used AS coupon_basket_count, n_prod AS distinct_product_count,
       n_cat AS distinct_category_count, ifnull(r.n, 0) AS coupon_redemption_count,
       ifnull(e.n, 0) AS campaign_exposure_count,
       round(CASE WHEN spend_c + disc_c > 0 THEN disc_c / (spend_c + disc_c) END, 6) AS discount_rate,
       round(lag(spend_c) OVER past / 100.0, 2) AS prior_period_spend,
       round((spend_c - lag(spend_c) OVER past) / 100.0, 2) AS spend_change,
       CAST(row_number() OVER past > 1 AS INTEGER) AS retention_repeat_flag
FROM bought b LEFT JOIN variety v ON v.hk = b.hk AND v.p = b.p LEFT JOIN exposed e ON e.hk = b.hk AND e.p = b.p
LEFT JOIN redeemed r ON r.hk = b.hk AND r.p = b.p
WINDOW past AS (PARTITION BY b.hk ORDER BY b.p)
""",
    BASKET,
    LABELLED,
    PERIOD_PARTS,
)
_add(
    "customer_period_summary",
    """
SELECT p AS period_id, 28 * p - 27 AS period_start, max(least(28 * p, last_day)) AS period_end,
       count(*) FILTER (active) AS active_households, count(*) FILTER (active AND p = cohort) AS new_households,
       count(*) FILTER (active AND p > cohort) AS returning_households,
       count(*) FILTER (was_active) AS prior_active_households,
       count(*) FILTER (active AND was_active) AS retained_households,
       round(count(*) FILTER (active AND was_active) / nullif(count(*) FILTER (was_active), 0), 6) AS retention_rate
FROM hpw GROUP BY p
""",
    *PERIOD_SHARED,
)
COHORT = """
cohort_size AS (SELECT cohort, count(DISTINCT hk) AS members FROM hpw GROUP BY cohort),
retention AS (
  SELECT hpw.cohort, p, count(*) FILTER (active) AS active, any_value(members) AS members
  FROM hpw JOIN cohort_size s ON s.cohort = hpw.cohort WHERE p >= hpw.cohort GROUP BY hpw.cohort, p
),
"""
_add(
    "customer_retention_matrix",
    """
SELECT cohort AS cohort_period, p AS period_id, active AS active_households, members AS cohort_households,
       round(active / members, 6) AS retention_rate
FROM retention
""",
    *PERIOD_SHARED,
    COHORT,
)
_add(
    "dropped_events",
    """
SELECT 'campaign_exposures' AS event, CAST(coalesce(sum(n), 0) AS BIGINT) AS dropped_events
FROM exposed WHERE (hk, p) NOT IN (SELECT (hk, p) FROM grid)
UNION ALL
SELECT 'coupon_redemptions', CAST(coalesce(sum(n), 0) AS BIGINT) FROM redeemed WHERE (hk, p) NOT IN (SELECT (hk, p) FROM grid)
""",
    *PERIOD_SHARED,
)
_add("household_spine", "SELECT hk AS household_key, p AS period_id FROM grid", *PERIOD_SHARED)
_add("period_series", "SELECT DISTINCT p AS period_id FROM grid", *PERIOD_SHARED)

HOUSEHOLD = """
household AS (
  SELECT household_key, CAST(sum(spend_c) AS BIGINT) AS spend_c, count(*) AS baskets, max(week_no) AS last_week
  FROM basket GROUP BY household_key
),
quartiled AS (SELECT *, CAST(ntile(4) OVER (ORDER BY spend_c, household_key) AS INTEGER) AS tile FROM household),
segmented AS (
  SELECT *, CASE WHEN tile = 4 THEN 'high_value' WHEN last_week + 13 < (SELECT max(week_no) FROM basket)
                 THEN 'at_risk_lapsed' WHEN tile = 1 THEN 'low_value' ELSE 'mid_value' END AS segment
  FROM quartiled
),
"""
_add(
    "customer_segments",
    """
SELECT segment, count(*) AS households, sum(spend_c) / (100.0 * count(*)) AS avg_spend,
       sum(baskets) / count(*) AS avg_baskets
FROM segmented GROUP BY segment
""",
    BASKET,
    HOUSEHOLD,
)
_add(
    "value_concentration",
    """
SELECT household_key, round(spend_c / 100.0, 2) AS spend,
       round(sum(spend_c) OVER (ORDER BY spend_c DESC, household_key ROWS UNBOUNDED PRECEDING)
             / (SELECT sum(spend_c) FROM household), 6) AS cumulative_share
FROM household
""",
    BASKET,
    HOUSEHOLD,
)

# --- campaigns, coupons and promotions -------------------------------------------------------------------------------

FUNNEL = """
funnel AS (
  SELECT k.campaign, k.kind, k.start_day, k.end_day, count(DISTINCT e.household_key) AS reached,
         count(DISTINCT r.household_key) AS redeeming, count(r.household_key) AS redemptions
  FROM camp k LEFT JOIN expo e ON e.campaign = k.campaign
  LEFT JOIN rdm r ON r.campaign = e.campaign AND r.household_key = e.household_key
  GROUP BY ALL
),
"""
_add(
    "mart_campaigns",
    """
SELECT campaign, kind AS description, kind AS campaign_type, start_day, end_day, reached AS exposed_households,
       redeeming AS redeeming_households, redemptions AS redemption_count,
       round(redeeming / nullif(reached, 0), 6) AS household_redemption_rate
FROM funnel
""",
    FUNNEL,
)
_add(
    "campaign_funnel_top10",
    """
SELECT campaign, kind AS campaign_type, reached AS exposed_households, redeeming AS redeeming_households,
       redemptions AS redemption_count, round(redeeming / nullif(reached, 0), 6) AS household_redemption_rate
FROM funnel ORDER BY reached DESC, campaign LIMIT 10
""",
    FUNNEL,
)
_add(
    "mart_coupon_redemptions",
    """
SELECT rdm.household_key, rdm.day, rdm.coupon_upc, rdm.campaign, kind AS campaign_type, start_day, end_day
FROM rdm LEFT JOIN camp ON camp.campaign = rdm.campaign
""",
)
BEHAVIOUR = """
behaviour AS (
  SELECT e.household_key, e.campaign, k.kind, k.start_day,
         CAST(EXISTS (FROM rdm r WHERE r.household_key = e.household_key AND r.campaign = e.campaign) AS INTEGER) AS hit,
         CAST(coalesce(sum(net_c) FILTER (day < start_day), 0) AS BIGINT) AS pre_c,
         CAST(coalesce(sum(net_c) FILTER (day >= start_day), 0) AS BIGINT) AS post_c,
         count(DISTINCT basket_id) FILTER (day < start_day) AS pre_b,
         count(DISTINCT basket_id) FILTER (day >= start_day) AS post_b
  FROM expo e JOIN camp k ON k.campaign = e.campaign
  LEFT JOIN tx t ON t.household_key = e.household_key AND t.day >= start_day - 28 AND t.day < start_day + 28
  GROUP BY ALL
),
"""
_add(
    "campaign_bias_comparison",
    """
SELECT kind AS campaign_type, tile AS prior_value_quartile, hit AS redeemed_flag, count(*) AS household_campaign_exposures,
       round(sum(pre_c) / (100.0 * count(*)), 4) AS avg_pre_spend, round(sum(post_c) / (100.0 * count(*)), 4) AS avg_post_spend,
       round(sum(post_c - pre_c) / (100.0 * count(*)), 4) AS avg_spend_change, round(avg(pre_b), 6) AS avg_pre_baskets,
       round(avg(post_b), 6) AS avg_post_baskets, round(avg(post_b - pre_b), 6) AS avg_basket_change
FROM (SELECT *, CAST(ntile(4) OVER (PARTITION BY campaign ORDER BY pre_c, household_key) AS INTEGER) AS tile FROM behaviour)
GROUP BY kind, tile, hit
""",
    BEHAVIOUR,
)
_add(
    "campaign_segment_analysis",
    """
SELECT k.kind AS campaign_type, segment, count(*) AS household_campaign_exposures, count(r.campaign) AS redeemed_exposures,
       round(count(r.campaign) / count(*), 6) AS redemption_rate
FROM expo e JOIN camp k ON k.campaign = e.campaign JOIN segmented s ON s.household_key = e.household_key
LEFT JOIN (SELECT DISTINCT household_key, campaign FROM rdm) r
  ON r.household_key = e.household_key AND r.campaign = e.campaign
GROUP BY k.kind, segment
""",
    BASKET,
    HOUSEHOLD,
)
_add(
    "campaign_prepost",
    """
SELECT kind AS campaign_type, count(*) AS households, round(sum(pre_c) / (100.0 * count(*)), 2) AS avg_pre_spend,
       round(sum(post_c) / (100.0 * count(*)), 2) AS avg_post_spend,
       round(sum(post_c - pre_c) / (100.0 * count(*)), 2) AS avg_change
FROM (
  SELECT kind, e.household_key,
         coalesce(sum(net_c) FILTER (day >= start_day - 28 AND day < start_day), 0) AS pre_c,
         coalesce(sum(net_c) FILTER (day >= start_day AND day <= end_day + 28), 0) AS post_c
  FROM expo e JOIN camp k ON k.campaign = e.campaign LEFT JOIN tx t ON t.household_key = e.household_key
  GROUP BY kind, e.household_key
) GROUP BY kind
""",
)
SHELF = """
shelf AS (
  SELECT product_id, store_id, week_no, CAST(sum(net_c) AS BIGINT) AS net_c, sum(quantity) AS units, count(*) AS n_lines,
         count(DISTINCT basket_id) AS baskets
  FROM tx GROUP BY product_id, store_id, week_no
),
shown AS (
  SELECT product_id, store_id, week_no, bool_or(ifnull(display, '0') <> '0') AS on_display,
         bool_or(ifnull(mailer, '0') <> '0') AS in_mailer
  FROM caus GROUP BY product_id, store_id, week_no
),
shelf_status AS (
  SELECT shelf.*, coalesce(on_display, false) AS on_display, coalesce(in_mailer, false) AS in_mailer,
         CASE WHEN on_display OR in_mailer THEN 'promoted' ELSE 'not_promoted' END AS status
  FROM shelf LEFT JOIN shown USING (product_id, store_id, week_no)
),
"""
_add(
    "mart_promotion_performance",
    """
SELECT status AS promotion_status, count(*) AS product_store_weeks, CAST(sum(n_lines) AS BIGINT) AS transaction_lines,
       round(sum(net_c) / 100.0, 2) AS sales, sum(units) AS units, CAST(sum(baskets) AS BIGINT) AS basket_occurrences,
       round(sum(net_c) / (100.0 * count(*)), 4) AS avg_sales_per_product_store_week
FROM shelf_status GROUP BY status
""",
    SHELF,
)


# --- features and checks ---------------------------------------------------------------------------------------------

FEATURES = """
horizon AS (SELECT max(week_no) - 13 AS stop, greatest(1, (max(week_no) - 13) // 2) AS half FROM tx),
seen AS (SELECT labelled.* FROM labelled, horizon WHERE week_no <= stop),
behaviour_seen AS (
  SELECT household_key, CAST(any_value(stop) - max(week_no) AS INTEGER) AS recency, count(DISTINCT basket_id) AS visits,
         CAST(sum(net_c) AS BIGINT) AS net_c, count(*) AS n_lines, sum(quantity) AS units,
         count(DISTINCT product_id) AS n_prod, count(DISTINCT commodity_desc) AS n_cat,
         CAST(sum(disc_c) AS BIGINT) AS disc_c, count(*) FILTER (coupon_c + match_c > 0) AS coupon_lines,
         CAST(coalesce(sum(net_c) FILTER (week_no <= half), 0) AS BIGINT) AS first_c,
         CAST(coalesce(sum(net_c) FILTER (week_no > half), 0) AS BIGINT) AS second_c, any_value(stop) AS stop
  FROM seen, horizon GROUP BY household_key
),
favourite AS (
  SELECT household_key, department, net_c FROM (
    SELECT household_key, department, sum(net_c) AS net_c,
           rank() OVER (PARTITION BY household_key ORDER BY sum(net_c) DESC, department) AS place
    FROM seen GROUP BY household_key, department) WHERE place = 1
),
later AS (
  SELECT household_key, CAST(sum(net_c) AS BIGINT) AS net_c, count(DISTINCT basket_id) AS visits
  FROM tx, horizon WHERE week_no > stop GROUP BY household_key
),
reached AS (
  SELECT household_key, count(*) AS n FROM expo JOIN camp ON camp.campaign = expo.campaign, horizon
  WHERE start_day <= 7 * stop GROUP BY household_key
),
feature AS (
  SELECT b.household_key, recency AS recency_weeks, b.visits AS frequency_baskets, b.net_c / 100.0 AS monetary_spend,
         b.net_c / (100.0 * n_lines) AS avg_line_sales, units AS total_units, n_prod AS product_diversity,
         n_cat AS category_diversity, disc_c / 100.0 AS discount_amount, coupon_lines AS coupon_line_count,
         first_c / 100.0 AS first_half_spend, second_c / 100.0 AS second_half_spend,
         f.net_c / nullif(b.net_c, 0) AS top_department_share, (second_c - first_c) / 100.0 AS spend_trend_change,
         disc_c / nullif(b.net_c + disc_c, 0) AS discount_rate, coupon_lines / b.visits AS coupon_engagement,
         coalesce(r.n, 0) AS campaign_exposure_count, coalesce(l.net_c, 0) / 100.0 AS future_spend,
         CAST(coalesce(l.visits, 0) > 0 AS INTEGER) AS next_period_active_flag,
         CAST(coalesce(l.net_c, 0) * stop < b.net_c * 13 AS INTEGER) AS next_period_spend_decline_flag,
         d.* EXCLUDE (household_key), CAST(d.household_key IS NULL AS INTEGER) AS missing_demographic_flag
  FROM behaviour_seen b LEFT JOIN favourite f ON f.household_key = b.household_key
  LEFT JOIN later l ON l.household_key = b.household_key LEFT JOIN reached r ON r.household_key = b.household_key
  LEFT JOIN demo d ON d.household_key = b.household_key
),
"""
_add(
    "mart_customer_features",
    """
SELECT * REPLACE (round(monetary_spend, 2) AS monetary_spend, 
  round(discount_amount, 2) AS discount_amount, round(first_half_spend, 2) AS first_half_spend,
  round(second_half_spend, 2) AS second_half_spend, round(top_department_share, 6) AS top_department_share,
  round(spend_trend_change, 2) AS spend_trend_change, round(discount_rate, 6) AS discount_rate,
  round(coupon_engagement, 6) AS coupon_engagement, round(future_spend, 2) AS future_spend)
FROM feature
""",
    LABELLED,
    FEATURES,
)

_CHECKS = {
    "transaction_rows": "SELECT count(*) FROM tx",
    "distinct_baskets": "SELECT count(DISTINCT basket_id) FROM tx",
    "distinct_households": "SELECT count(DISTINCT household_key) FROM tx",
    "distinct_products": "SELECT count(DISTINCT product_id) FROM tx",
    "distinct_stores": "SELECT count(DISTINCT store_id) FROM tx",
    "campaign_count": "SELECT count(DISTINCT campaign) FROM camp",
    "exposed_households": "SELECT count(DISTINCT household_key) FROM expo",
    "coupon_count": "SELECT count(DISTINCT coupon_upc) FROM coup",
    "coupon_redemption_rows": "SELECT count(*) FROM rdm",
    "causal_source_rows": "SELECT count(*) FROM caus",
    "min_day": "SELECT min(day) FROM tx",
    "max_day": "SELECT max(day) FROM tx",
    "min_week": "SELECT min(week_no) FROM tx",
    "max_week": "SELECT max(week_no) FROM tx",
    "mart_basket_rows": "SELECT count(*) FROM basket",
    "basket_fanout_ok": "SELECT count(DISTINCT basket_id) = count(*) FROM basket",
    "basket_sales_reconciled": "SELECT (SELECT sum(net_c) FROM tx) = (SELECT sum(spend_c) FROM basket)",
    "basket_units_reconciled": "SELECT abs((SELECT sum(quantity) FROM tx) - (SELECT sum(units) FROM basket)) < 0.01",
    "household_period_unique": "SELECT count(*) = (SELECT count(*) FROM (SELECT DISTINCT hk, p FROM hp)) FROM hp",
    "product_join_fanout_ok": "SELECT (SELECT count(*) FROM tx) = (SELECT count(*) FROM labelled)",
    "product_join_sales_reconciled": "SELECT (SELECT sum(net_c) FROM tx) = (SELECT sum(net_c) FROM labelled)",
    "products_duplicate_keys": "SELECT count(*) - count(DISTINCT product_id) FROM goods",
    "campaign_exposure_duplicate_keys": "SELECT (SELECT count(*) FROM expo) - (SELECT count(*) FROM (SELECT DISTINCT * FROM expo))",
    "coupon_bridge_duplicate_rows": "SELECT (SELECT count(*) FROM coup) - (SELECT count(*) FROM (SELECT DISTINCT * FROM coup))",
    "causal_duplicate_exact_keys": "SELECT (SELECT count(*) FROM caus) - (SELECT count(*) FROM shown)",
    "transactions_missing_product_metadata": "SELECT count(*) FROM tx WHERE product_id NOT IN (SELECT product_id FROM goods)",
    "campaign_exposures_missing_description": "SELECT count(*) FROM expo WHERE campaign NOT IN (SELECT campaign FROM camp)",
    "redemptions_missing_campaign": "SELECT count(*) FROM rdm WHERE campaign NOT IN (SELECT campaign FROM camp)",
    "negative_sales_rows": "SELECT count(*) FROM tx WHERE net_c < 0",
    "zero_sales_rows": "SELECT count(*) FROM tx WHERE net_c = 0",
    "negative_quantity_rows": "SELECT count(*) FROM tx WHERE quantity < 0",
    "zero_quantity_rows": "SELECT count(*) FROM tx WHERE quantity = 0",
    "invalid_trans_time_rows": "SELECT count(*) FROM tx WHERE hhmm IS NULL OR hhmm < 0 OR hhmm > 2359 OR hhmm % 100 > 59",
    "discount_larger_than_net_sales_rows": "SELECT count(*) FROM tx WHERE net_c > 0 AND net_c < disc_c",
    "coupon_product_bridge_distinct_rows": "SELECT count(*) FROM (SELECT DISTINCT * FROM coup)",
    "causal_exact_key_rows": "SELECT count(*) FROM shown",
    "transaction_product_store_week_rows": "SELECT count(*) FROM shelf",
    "promotion_join_rows": "SELECT count(*) FROM shelf_status",
    "promotion_join_fanout_ok": "SELECT (SELECT count(*) FROM shelf) = (SELECT count(*) FROM shelf_status)",
    "promotion_join_sales_reconciled": "SELECT (SELECT sum(net_c) FROM tx) = (SELECT sum(net_c) FROM shelf_status)",
    "promotion_join_units_reconciled": "SELECT abs((SELECT sum(quantity) FROM tx) - (SELECT sum(units) FROM shelf_status)) < 0.01",
    "basket_discount_rate_in_range": "SELECT count(*) = 0 FROM basket WHERE gross_c > 0 AND (disc_c < 0 OR disc_c > gross_c)",
    "duplicate_transaction_rows": """SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM tx GROUP BY household_key, basket_id, day, week_no,
      product_id, quantity, net_c, store_id, retail_c, coupon_n, match_n, hhmm)""",
    "demographic_covered_households": "SELECT count(DISTINCT household_key) FROM tx WHERE household_key IN (SELECT household_key FROM demo)",
    "demographic_uncovered_households": "SELECT count(DISTINCT household_key) FROM tx WHERE household_key NOT IN (SELECT household_key FROM demo)",
    "redemptions_missing_coupon_context": "SELECT count(*) FROM rdm WHERE (campaign, coupon_upc) NOT IN (SELECT (campaign, coupon_upc) FROM coup)",
    "suspicious_quantity_rows_over_100": "SELECT count(*) FROM tx WHERE quantity > 100",
    "outlier_baskets_above_p99": "SELECT count(*) FROM basket WHERE spend_c / 100.0 > (SELECT quantile_cont(spend_c / 100.0, 0.99) FROM basket)",
    "outlier_households_above_p99_spend": "SELECT count(*) FROM household WHERE spend_c / 100.0 > (SELECT quantile_cont(spend_c / 100.0, 0.99) FROM household)",
    "outlier_products_above_p99_sales": "SELECT count(*) FROM item WHERE net_c / 100.0 > (SELECT quantile_cont(net_c / 100.0, 0.99) FROM item)",
    "day_index_gap_count": "SELECT max(day) - min(day) + 1 - count(DISTINCT day) FROM tx",
    "week_index_gap_count": "SELECT max(week_no) - min(week_no) + 1 - count(DISTINCT week_no) FROM tx",
    "sparse_categories_under_50_households": "SELECT count(*) FROM category WHERE h < 50",
    "null_or_blank_category_labels": "SELECT count(*) FROM goods WHERE coalesce(trim(commodity_desc), '') = ''",
    "normalized_category_label_collisions": "SELECT count(DISTINCT commodity_desc) - count(DISTINCT upper(trim(commodity_desc))) FROM goods",
}
ITEM = "item AS (SELECT product_id, CAST(sum(net_c) AS BIGINT) AS net_c FROM tx GROUP BY product_id),\n"


def _check_rows(checks: dict[str, str]) -> str:
    def arm(name: str, sql: str) -> str:
        return f"SELECT '{name}' AS check_name, CAST(({sql}) AS VARCHAR) AS check_value"

    return " UNION ALL ".join(arm(name, sql) for name, sql in checks.items())


_add(
    "validation_checks",
    _check_rows(_CHECKS),
    TOTALS,
    BASKET,
    LABELLED,
    CATEGORY,
    HOUSEHOLD_PERIOD,
    HOUSEHOLD,
    SHELF,
    ITEM,
)
_add(
    "legacy_discount_check",
    _check_rows(
        {"discount_larger_than_sales_rows": "SELECT count(*) FROM tx WHERE net_c > 0 AND coupon_c + match_c > net_c"}
    ),
)
_add(
    "source_checks",
    _check_rows(
        {
            **{
                f"{name}_not_empty": f"SELECT count(*) > 0 FROM {cte}"
                for name, cte in {
                    "transactions": "tx",
                    "products": "goods",
                    "households": "demo",
                    "campaigns": "camp",
                    "exposures": "expo",
                    "coupons": "coup",
                    "redemptions": "rdm",
                    "merchandising": "caus",
                }.items()
            },
            "coupon_keys_within_rows": "SELECT (SELECT count(*) FROM (SELECT DISTINCT * FROM coup)) <= (SELECT count(*) FROM coup)",
            "merchandising_keys_within_rows": "SELECT (SELECT count(*) FROM shown) <= (SELECT count(*) FROM caus)",
            "first_day": "SELECT min(day) FROM tx",
            "last_day": "SELECT max(day) FROM tx",
            "first_week": "SELECT min(week_no) FROM tx",
            "last_week": "SELECT max(week_no) FROM tx",
            "invalid_clock_rows": "SELECT count(*) FROM tx WHERE hhmm < 0 OR hhmm > 2359 OR hhmm % 100 > 59",
            "week_and_day_period_mismatch_rows": "SELECT count(*) FROM tx WHERE period_id <> (day + 27) // 28",
            "amounts_finer_than_four_decimals": "SELECT count(*) FROM tx WHERE net_c <> trunc(net_c)",
        }
    ),
    SHELF,
)
SEGMENT_EVIDENCE = """
segment_evidence AS (
  SELECT k.kind, segment, count(*) AS n, count(r.campaign) AS hits
  FROM expo e JOIN camp k ON k.campaign = e.campaign JOIN segmented s ON s.household_key = e.household_key
  LEFT JOIN (SELECT DISTINCT household_key, campaign FROM rdm) r
    ON r.household_key = e.household_key AND r.campaign = e.campaign GROUP BY k.kind, segment
),
period_summary AS (
  SELECT p, count(*) FILTER (active) AS active, count(*) FILTER (was_active) AS prior,
         count(*) FILTER (active AND was_active) AS kept FROM hpw GROUP BY p
),
bias AS (SELECT *, ntile(4) OVER (PARTITION BY campaign ORDER BY pre_c, household_key) AS tile FROM behaviour),
"""
_add(
    "invariant_checks",
    _check_rows(
        {
            "spine_complete": "SELECT count(*) = count(DISTINCT hk) * count(DISTINCT p) FROM hpw",
            "period_one_has_no_prior": "SELECT count(*) = 0 FROM hpw WHERE p = 1 AND before_c IS NOT NULL",
            "one_incomplete_period_per_household": """SELECT bool_and(n = 1) FROM (
                SELECT count(*) FILTER (p = last_p AND 28 * p > last_day) AS n FROM hpw GROUP BY hk)""",
            "discounts_not_negative": "SELECT bool_and(disc_c >= 0) FROM basket",
            "gross_is_net_plus_discounts": "SELECT bool_and(spend_c + disc_c = gross_c) FROM basket",
            "discount_rate_is_discounts_over_gross": "SELECT bool_and(retail_c + coupon_c + match_c = disc_c) FROM basket",
            "flags_are_binary": "SELECT (SELECT bool_and(used IN (0, 1)) FROM basket) AND (SELECT bool_and(hit IN (0, 1)) FROM behaviour)",
            "rates_within_unit_interval": """SELECT (SELECT bool_and(redeeming <= reached) FROM funnel)
                AND (SELECT bool_and(h <= all_h AND b <= all_b AND disc_c BETWEEN 0 AND gross_c) FROM category, totals)
                AND (SELECT bool_and(hits <= n) FROM segment_evidence) AND (SELECT bool_and(kept <= prior) FROM period_summary)
                AND (SELECT bool_and(active <= members) FROM retention)""",
            "retained_within_prior_active": "SELECT bool_and(kept <= prior) FROM period_summary",
            "active_within_cohort": "SELECT bool_and(active <= members) FROM retention",
            "redeemed_within_exposed": "SELECT bool_and(hits <= n) FROM segment_evidence",
            "mart_keys_unique": """SELECT (SELECT count(*) = count(DISTINCT product_id) FROM item)
                AND (SELECT count(*) = count(DISTINCT household_key) FROM feature)
                AND (SELECT count(*) = count(DISTINCT p) FROM period_summary)""",
            "campaign_types_known": "SELECT bool_and(kind IN ('TypeA', 'TypeB', 'TypeC')) FROM camp",
            "quartiles_known": "SELECT bool_and(tile BETWEEN 1 AND 4) FROM bias",
            "promotion_statuses_known": "SELECT bool_and(status IN ('promoted', 'not_promoted')) FROM shelf_status",
            "numeric_features_finite": """SELECT bool_and(isfinite(monetary_spend) AND isfinite(avg_line_sales)
                AND isfinite(coalesce(top_department_share, 0))) FROM feature""",
            "no_label_among_features": "SELECT true",
            "basket_mart_matches_source": """SELECT (SELECT count(DISTINCT basket_id) FROM tx) = (SELECT count(*) FROM basket)
                AND (SELECT sum(net_c) FROM tx) = (SELECT sum(spend_c) FROM basket)""",
        }
    ),
    TOTALS,
    *PERIOD_SHARED,
    COHORT,
    CATEGORY,
    HOUSEHOLD,
    FUNNEL,
    BEHAVIOUR,
    SHELF,
    ITEM,
    FEATURES,
    SEGMENT_EVIDENCE,
)
_add(
    "kpi_support",
    " UNION ALL ".join(
        f"""SELECT '{kpi}' AS kpi, '{mart}' AS source_mart, '{column}' AS denominator, {least} AS minimum,
        count(*) FILTER ({value} >= {least}) AS reportable_groups,
        count(*) FILTER ({value} < {least}) AS withheld_groups FROM {cte}"""
        for kpi, mart, column, least, value, cte in [
            ("trip_frequency", "customer_period_summary", "active_households", 30, "active", "period_summary"),
            ("coupon_redemption_rate", "mart_campaigns", "exposed_households", 30, "reached", "funnel"),
            ("basket_size", "mart_household_period", "basket_count", 1, "n", "hp"),
            ("campaign_exposure_rate", "kpi_summary", "active_households", 30, "all_h", "totals"),
            ("repeat_purchase", "product_buyers", "households", 50, "h", "product_reach"),
            ("category_penetration", "mart_categories", "household_count", 50, "h", "category"),
            ("category_growth", "mart_categories", "household_count", 50, "h", "category"),
            ("retention_repeat", "customer_period_summary", "prior_active_households", 30, "prior", "period_summary"),
        ]
    ),
    *PERIOD_SHARED,
    CATEGORY,
    HOUSEHOLD,
    FUNNEL,
    BEHAVIOUR,
    SEGMENT_EVIDENCE,
    TOTALS,
    "product_reach AS (SELECT product_id, count(DISTINCT household_key) AS h FROM tx GROUP BY product_id),",
)


# --- statistics ------------------------------------------------------------------------------------------------------

MEASURE = """
measure AS (
  SELECT basket_id, household_key, spend_c / 100.0 AS spend, units, CASE WHEN gross_c > 0 THEN disc_c / gross_c END AS rate,
         spend_c, used
  FROM basket
),
"""
_add(
    "basket_descriptives",
    """
SELECT round(sum(spend_c) / (100.0 * count(*)), 4) AS mean_basket_spend, round(median(spend), 4) AS median_basket_spend,
       round(stddev_samp(spend), 2) AS sd_basket_spend, round(sum(units) / count(units), 6) AS mean_basket_units,
       round(median(units), 4) AS median_basket_units, round(avg(rate), 6) AS mean_discount_rate,
       round(median(rate), 6) AS median_discount_rate
FROM measure
""",
    BASKET,
    MEASURE,
)
_add(
    "event_probabilities",
    """
SELECT round(sum(used) / count(*), 6) AS coupon_basket_probability,
       round(count(*) FILTER (spend_c > 5000) / count(*), 6) AS basket_over_50_probability,
       round((SELECT count(*) FILTER (active AND was_active) / count(*) FILTER (was_active) FROM hpw), 6)
         AS adjacent_retention_probability
FROM basket
""",
    *PERIOD_SHARED,
)
_add(
    "bootstrap_ci",
    """
WITH amounts AS (
  SELECT 'basket_spend' AS measure, CAST(basket_id AS VARCHAR) AS k, spend_c AS c FROM basket
  UNION ALL SELECT 'household_spend', CAST(household_key AS VARCHAR), spend_c FROM household
),
seeded AS (
  SELECT measure, c, CAST('0x' || md5(k)[1:8] AS BIGINT) % 2147483647 AS first,
         CAST('0x' || md5(k || '-')[1:8] AS BIGINT) % 2147483647 AS second FROM amounts
),
draws AS (
  SELECT measure, replicate, c, (first * replicate + second) % 2147483647 / 2147483647.0::DOUBLE AS u
  FROM seeded, range(1, 501) r(replicate)
),
means AS (
  SELECT measure, replicate, sum(w * c) / (100.0 * sum(w)) AS m
  FROM (SELECT *, """
    + " + ".join(f"CAST(u >= {reach!r}::DOUBLE AS BIGINT)" for reach in accumulate(exp(-1.0) / factorial(k) for k in range(13)))
    + """ AS w FROM draws) GROUP BY measure, replicate
)
SELECT measure, round(quantile_cont(m, 0.025), 3) AS lower, round(quantile_cont(m, 0.975), 3) AS upper
FROM means GROUP BY measure
""",
    BASKET,
    HOUSEHOLD,
)
HALVES = """
halves AS (
  SELECT p <= (SELECT median(p) FROM hp) AS early, count(*) AS n, sum(spend_c) / (100.0 * count(*)) AS m,
         var_samp(spend_c / 100.0) AS v
  FROM hp GROUP BY 1
),
sides AS (
  SELECT max(n) FILTER (early) AS n1, max(n) FILTER (NOT early) AS n2, max(m) FILTER (early) AS m1,
         max(m) FILTER (NOT early) AS m2, max(v) FILTER (early) AS v1, max(v) FILTER (NOT early) AS v2
  FROM halves
),
"""
_add(
    "welch_spend",
    """
SELECT n1 AS early_rows, n2 AS late_rows, round(m1, 4) AS early_mean, round(m2, 4) AS late_mean,
       round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS t_statistic,
       round(pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)), 3)
         AS degrees_of_freedom
FROM sides
""",
    *PERIOD_SHARED,
    HALVES,
)
_add(
    "cohens_d",
    "SELECT round((m2 - m1) / sqrt((v1 + v2) / 2), 6) AS late_minus_early_d FROM sides",
    *PERIOD_SHARED,
    HALVES,
)
GROUPS = """
priced_category AS (
  SELECT net_c, h, CASE WHEN gross_c > 0 THEN disc_c / gross_c END AS rate FROM category WHERE h >= {least}
),
split AS (
  SELECT net_c, rate >= (SELECT median(rate) FROM priced_category) AS high FROM priced_category WHERE rate IS NOT NULL
),
placed AS (
  SELECT high, rank() OVER (ORDER BY net_c) + (count(*) OVER (PARTITION BY net_c) - 1) / 2.0 AS r,
         count(*) OVER (PARTITION BY net_c) AS t
  FROM split
),
u_test AS (
  SELECT count(*) FILTER (high) AS n1, count(*) FILTER (NOT high) AS n2,
         sum(r) FILTER (high) - count(*) FILTER (high) * (count(*) FILTER (high) + 1) / 2.0 AS u,
         sum(t * t - 1) AS ties
  FROM placed
),
"""
_add(
    "mann_whitney_discount",
    """
SELECT n1 AS high_discount_categories, n2 AS low_discount_categories, CAST(u AS DOUBLE) AS u_statistic,
       round((greatest(u, n1 * n2 - u) - n1 * n2 / 2.0 - 0.5)
             / sqrt(n1 * n2 / 12.0 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1.0)))), 6) AS z_score
FROM u_test
""",
    LABELLED,
    CATEGORY,
    GROUPS.format(least=0),
)
_add(
    "rank_biserial",
    """
SELECT n1 AS high_discount_categories, n2 AS low_discount_categories, CAST(u AS DOUBLE) AS u_statistic,
       round(2 * u / (n1 * n2) - 1, 6) AS rank_biserial
FROM u_test
""",
    LABELLED,
    CATEGORY,
    GROUPS.format(least=50),
)
_PAIR_NAMES = {"basket_spend": "spend", "basket_units": "units", "discount_rate": "rate"}
_add(
    "basket_covariance",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS measure, '{b}' AS other_measure,
        CAST(printf('%.8e', covar_samp({x}, {y})) AS DOUBLE) AS covariance
        FROM measure WHERE {x} IS NOT NULL AND {y} IS NOT NULL"""
        for a, x in _PAIR_NAMES.items()
        for b, y in _PAIR_NAMES.items()
    ),
    BASKET,
    MEASURE,
)


def _tied(column: str) -> str:
    return f"rank() OVER (ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2.0"


_add(
    "basket_spearman",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS measure, '{b}' AS other_measure, round(corr(x, y), 6) AS rho
        FROM (SELECT {_tied(x)} AS x, {_tied(y)} AS y FROM measure WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"""
        for a, x in _PAIR_NAMES.items()
        for b, y in _PAIR_NAMES.items()
    ),
    BASKET,
    MEASURE,
)
_add(
    "experiment_mde",
    """
SELECT CAST(arm AS INTEGER) AS households_per_arm, round(2.8 * sqrt(2) * sd / sqrt(arm), 2) AS mde_spend,
       round(100 * 2.8 * sqrt(2) * sd / sqrt(arm) / m, 2) AS mde_percent
FROM (SELECT sum(spend_c) / (100.0 * count(*)) AS m, stddev_samp(spend_c / 100.0) AS sd FROM hp WHERE p < last_p),
     (VALUES (250), (500), (1000), (1500)) arms(arm)
""",
    *PERIOD_SHARED,
)
_add(
    "sample_size_by_lift",
    """
SELECT CAST(pct AS DOUBLE) AS lift_percent,
       CAST(ceil(2 * pow(2.8 * sd / (m * pct / 100), 2)) AS BIGINT) AS households_per_group
FROM (SELECT sum(spend_c) / (100.0 * count(*)) AS m, stddev_samp(spend_c / 100.0) AS sd FROM household),
     (VALUES (3.0::DOUBLE), (4.0), (5.0), (7.5), (10.0)) lifts(pct)
""",
    BASKET,
    HOUSEHOLD,
)

# --- figures ---------------------------------------------------------------------------------------------------------

_add("baskets_by_week", "SELECT week_no, count(DISTINCT basket_id) AS baskets FROM tx GROUP BY week_no")
_add(
    "basket_spend_hist",
    """
WITH cut AS (SELECT min(spend) AS lo, quantile_cont(spend, 0.99) AS hi FROM measure),
placed AS (SELECT least(floor((least(spend, hi) - lo) / ((hi - lo) / 50)), 49) AS bin FROM measure, cut)
SELECT CAST(k AS INTEGER) AS bin, round(lo + k * ((hi - lo) / 50), 2) AS bin_start,
       (SELECT count(*) FROM placed WHERE bin = k) AS baskets
FROM range(50) r(k), cut
""",
    BASKET,
    MEASURE,
)
_add(
    "basket_freq_hist",
    """
WITH cut AS (SELECT CAST(min(n) AS DOUBLE) AS lo, CAST(max(n) AS DOUBLE) AS hi FROM bought),
placed AS (SELECT CASE WHEN hi > lo THEN least(floor((n - lo) / ((hi - lo) / 40)), 39) ELSE 0 END AS bin FROM bought, cut)
SELECT CAST(k AS INTEGER) AS bin, round(lo + k * ((hi - lo) / 40), 6) AS bin_start,
       (SELECT count(*) FROM placed WHERE bin = k) AS household_periods
FROM range(40) r(k), cut
""",
    BASKET,
    LABELLED,
    PERIOD_PARTS,
)
_add(
    "retention_pivot",
    "SELECT cohort AS cohort_period, "
    + ", ".join(f"round(max(active / members) FILTER (p = {p}), 6) AS period_{p}" for p in range(1, 27))
    + " FROM retention GROUP BY cohort",
    *PERIOD_SHARED,
    COHORT,
)
POINTS = """
points AS (
  SELECT department, commodity_desc, h / all_h AS reach, net_c / 100.0 AS sales, (late_c - early_c) / 100.0 AS growth,
         CASE WHEN gross_c > 0 THEN disc_c / gross_c END AS rate
  FROM category, totals WHERE h >= 50 ORDER BY net_c DESC, department, commodity_desc LIMIT 40
),
"""
_add(
    "category_points",
    """
SELECT department, commodity_desc, round(reach, 6) AS household_penetration, round(sales, 2) AS category_sales,
       round(growth, 2) AS sales_growth, round(rate, 6) AS discount_rate
FROM points
""",
    TOTALS,
    LABELLED,
    CATEGORY,
    POINTS,
)
_add(
    "discount_sales_fit",
    """
SELECT CAST(printf('%.8e', regr_slope(sales, rate)) AS DOUBLE) AS slope,
       CAST(printf('%.8e', regr_intercept(sales, rate)) AS DOUBLE) AS intercept
FROM points
""",
    TOTALS,
    LABELLED,
    CATEGORY,
    POINTS,
)
_add(
    "first_campaigns",
    """
SELECT campaign, reached AS exposed_households, redeeming AS redeeming_households FROM funnel ORDER BY campaign LIMIT 20
""",
    FUNNEL,
)

# --- matrix ----------------------------------------------------------------------------------------------------------

CELLS = """
cell AS (
  SELECT household_key, commodity_desc, CAST(sum(net_c) AS BIGINT) AS net_c FROM labelled
  GROUP BY household_key, commodity_desc
),
"""
_add(
    "spend_matrix_cells",
    "SELECT household_key, commodity_desc, round(net_c / 100.0, 2) AS spend FROM cell",
    LABELLED,
    CELLS,
)
_add(
    "matrix_profile",
    """
SELECT count(DISTINCT household_key) AS matrix_rows, count(DISTINCT commodity_desc) AS matrix_columns,
       round(1 - count(*) FILTER (net_c <> 0) / (count(DISTINCT household_key) * count(DISTINCT commodity_desc)), 4)
         AS sparsity
FROM cell
""",
    LABELLED,
    CELLS,
)
COSINE = """
spread AS (
  SELECT commodity_desc, sqrt(sum(pow(net_c / 100.0, 2)) / all_h - pow(sum(net_c / 100.0) / all_h, 2)) AS sd
  FROM cell, totals GROUP BY commodity_desc, all_h
),
member AS (SELECT DISTINCT household_key FROM cell ORDER BY household_key LIMIT {sample}),
scaled AS (
  SELECT household_key, commodity_desc, net_c / 100.0 / CASE WHEN sd > 0 THEN sd ELSE 1 END AS x
  FROM cell JOIN spread USING (commodity_desc) JOIN member USING (household_key)
),
norm AS (SELECT household_key, sqrt(sum(x * x)) AS n FROM scaled GROUP BY household_key),
likeness AS (
  SELECT a.household_key AS household_a, b.household_key AS household_b, sum(a.x * b.x) / any_value(na.n * nb.n) AS sim
  FROM scaled a JOIN scaled b ON a.commodity_desc = b.commodity_desc AND a.household_key < b.household_key
  JOIN norm na ON na.household_key = a.household_key JOIN norm nb ON nb.household_key = b.household_key
  {anchor} GROUP BY a.household_key, b.household_key
),
"""
for _name, _sample, _anchor in [
    ("nearest_households", 250, ""),
    ("nearest_households_all", "ALL", ""),
    ("nearest_to_first_household", "ALL", "WHERE a.household_key = (SELECT min(household_key) FROM member)"),
]:
    _add(
        _name,
        """
SELECT household_a, household_b, round(sim, 4) AS cosine_similarity
FROM likeness ORDER BY sim DESC, household_a, household_b LIMIT 1
""",
        TOTALS,
        LABELLED,
        CELLS,
        COSINE.format(sample=_sample, anchor=_anchor),
    )

# The correlation matrix as a list of rows; its power by repeated squaring gives the leading direction, which is then taken
# out of the matrix, five times.
CORRELATION = """
filled AS (SELECT household_key, commodity_desc, net_c / 100.0 AS v FROM cell),
spread AS (
  SELECT commodity_desc, sum(v) / all_h AS mu, sum(v * v) / all_h - pow(sum(v) / all_h, 2) AS variance
  FROM filled, totals GROUP BY commodity_desc, all_h
),
place AS (
  SELECT commodity_desc, mu, sqrt(variance) AS sd, row_number() OVER (ORDER BY commodity_desc) AS i
  FROM spread WHERE variance > 1e-9
),
shared AS (
  SELECT a.commodity_desc AS ca, b.commodity_desc AS cb, sum(a.v * b.v) AS s
  FROM filled a JOIN filled b USING (household_key) GROUP BY 1, 2
),
entry AS (
  SELECT p.i, q.i AS j, (coalesce(s, 0) / all_h - p.mu * q.mu) / (p.sd * q.sd) AS c
  FROM place p CROSS JOIN place q CROSS JOIN totals
  LEFT JOIN shared ON ca = p.commodity_desc AND cb = q.commodity_desc
),
m0 AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM entry GROUP BY i))"""
DIRECTION = """,
p{k}(m, n) AS (
  SELECT m, 0 FROM m{before}
  UNION ALL
  SELECT [[list_dot_product(r, s) / list_sum([list_dot_product(t, t) FOR t IN m]) FOR s IN m] FOR r IN m], n + 1
  FROM p{k} WHERE n < 15
),
d{k} AS (SELECT m, [m[i][i] FOR i IN range(1, len(m) + 1)] AS diagonal FROM p{k} WHERE n = 15),
v{k} AS (
  SELECT [x / sqrt(list_dot_product(r, r)) FOR x IN r] AS v
  FROM (SELECT m[list_position(diagonal, list_max(diagonal))] AS r FROM d{k})
),
l{k} AS (SELECT v, m, list_dot_product(v, [list_dot_product(r, v) FOR r IN m]) AS size FROM v{k}, m{before}),
m{k} AS (
  SELECT [[m[i][j] - size * v[i] * v[j] FOR j IN range(1, len(m) + 1)] FOR i IN range(1, len(m) + 1)] AS m FROM l{k}
)"""
_add(
    "pca_variance",
    """
SELECT component, round(share, 4) AS variance_share, round(sum(share) OVER (ORDER BY component), 4) AS cumulative_share
FROM (
"""
    + " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS component, size / (SELECT len(m) FROM m0) AS share FROM l{k}" for k in range(1, 6))
    + ")",
    TOTALS,
    LABELLED,
    CELLS,
    CORRELATION + "".join(DIRECTION.format(k=k, before=k - 1) for k in range(1, 6)),
)
ORACLES["pca_variance"] = ORACLES["pca_variance"].replace("WITH", "WITH RECURSIVE", 1)

# --- model -----------------------------------------------------------------------------------------------------------

NUMERIC = """recency_weeks frequency_baskets monetary_spend avg_line_sales total_units product_diversity category_diversity
discount_amount coupon_line_count first_half_spend second_half_spend top_department_share spend_trend_change discount_rate
coupon_engagement campaign_exposure_count missing_demographic_flag""".split()
CATEGORICAL = """age_desc marital_status_code income_desc homeowner_desc hh_comp_desc household_size_desc
kid_category_desc""".split()
NEWTON_STEPS = 9

SPLIT = """
drawn AS (
  SELECT *, next_period_active_flag AS y,
         row_number() OVER (PARTITION BY next_period_active_flag ORDER BY md5(concat('42-', household_key)), household_key) AS nr
  FROM feature
),
sized AS (
  SELECT y, count(*) AS n, CAST(floor(0.25 * count(*)) AS BIGINT) AS base, CAST(sum(count(*)) OVER () AS BIGINT) AS total
  FROM drawn GROUP BY y
),
quota AS (
  SELECT y, base + CASE WHEN row_number() OVER (ORDER BY base - 0.25 * n, y) <= ceil(0.25 * total) - sum(base) OVER ()
                        THEN 1 ELSE 0 END AS q
  FROM sized
),
split AS (SELECT drawn.*, nr <= q AS held FROM drawn JOIN quota USING (y)),
train AS (SELECT * FROM split WHERE NOT held),
"""
LEVELS = (
    "".join(
        f"""mode{k} AS (
  SELECT coalesce((SELECT {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), '__rare__') AS v
),
"""
        for k, c in enumerate(CATEGORICAL)
    )
    + "lev AS ("
    + " UNION ALL ".join(
        f"""
  SELECT {k} AS place_of, '{c}' AS predictor, {c} AS level,
         CASE WHEN count(*) >= 20 OR {c} = (SELECT v FROM mode{k}) THEN {c} ELSE '__rare__' END AS label
  FROM train WHERE {c} IS NOT NULL GROUP BY {c}"""
        for k, c in enumerate(CATEGORICAL)
    )
    + """
),
place AS (
  SELECT place_of, label, any_value(predictor) AS predictor, row_number() OVER (ORDER BY place_of, label) AS p
  FROM lev GROUP BY place_of, label
),
slot AS (SELECT place_of, level, predictor, label, p FROM lev JOIN place USING (place_of, predictor, label)),
"""
)
_medians = ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM train))" for c in NUMERIC)
_slots = ", ".join(
    f"coalesce(s{k}.p, (SELECT p FROM place WHERE place_of = {k} AND label = '__rare__'), 0)" for k in range(len(CATEGORICAL))
)
_joins = "\n".join(
    f"  LEFT JOIN slot s{k} ON s{k}.place_of = {k} AND s{k}.level = coalesce({c}, (SELECT v FROM mode{k}))"
    for k, c in enumerate(CATEGORICAL)
)
_each = lambda f: ", ".join(f.format(i=i) for i in range(1, len(NUMERIC) + 1))
DESIGN = f"""
ready AS MATERIALIZED (
  SELECT household_key, held, y, [{_medians}] AS x, [{_slots}] AS s
  FROM split
{_joins}
),
moments AS (SELECT [{_each("avg(x[{i}])")}] AS mu, [{_each("stddev_samp(x[{i}])")}] AS sd FROM ready WHERE NOT held),
class AS (SELECT y, (SELECT count(*) FROM train) / (count(*) * (SELECT count(DISTINCT y) FROM train)) AS w FROM train GROUP BY y),
design AS MATERIALIZED (
  SELECT household_key, held, y, w,
         list_concat(
           [CASE WHEN sd[i] > 0 THEN (x[i] - mu[i]) / sd[i] ELSE 0.0 END FOR i IN range(1, {len(NUMERIC)} + 1)],
           [CASE WHEN list_contains(s, i) THEN 1.0 ELSE 0.0 END FOR i IN range(1, (SELECT count(*) FROM place) + 1)],
           [1.0]) AS v
  FROM ready JOIN class USING (y) CROSS JOIN moments
),
every AS (SELECT unnest(range(1, max(len(v)) + 1)) AS i, max(len(v)) AS last FROM design),
b0 AS (SELECT [0.0 FOR i IN range(1, any_value(last) + 1)] AS b FROM every),
"""
# gradient and Hessian of all training rows, then elimination one column after the other
NEWTON = """
g{k} AS MATERIALIZED (
  SELECT v, y, w, 1 / (1 + exp(-list_dot_product(v, b))) AS p FROM design CROSS JOIN b{k} WHERE NOT held
),
h{k} AS (
  SELECT i.i, j.i AS j, sum(w * p * (1 - p) * v[i.i] * v[j.i]) + CASE WHEN i.i = j.i AND i.i < any_value(i.last) THEN 1 ELSE 0 END AS h
  FROM g{k} CROSS JOIN every i CROSS JOIN every j GROUP BY i.i, j.i
),
q{k} AS (
  SELECT i, sum(w * (p - y) * v[i]) + CASE WHEN i < any_value(last) THEN any_value(b[i]) ELSE 0 END AS g
  FROM g{k} CROSS JOIN every CROSS JOIN b{k} GROUP BY i
),
e{k}(m, c) AS (
  SELECT list(list_append(r, g) ORDER BY i), 1 FROM (SELECT i, list(h ORDER BY j) AS r FROM h{k} GROUP BY i) JOIN q{k} USING (i)
  UNION ALL
  SELECT [CASE WHEN i = c THEN [x / m[c][c] FOR x IN m[c]]
               ELSE [m[i][j] - m[i][c] / m[c][c] * m[c][j] FOR j IN range(1, len(m) + 2)] END FOR i IN range(1, len(m) + 1)], c + 1
  FROM e{k} WHERE c <= len(m)
),
b{next} AS MATERIALIZED (
  SELECT [b[i] - m[i][len(m) + 1] FOR i IN range(1, len(m) + 1)] AS b FROM e{k} CROSS JOIN b{k} WHERE c = len(m) + 1
),
"""
FITTED = DESIGN + "".join(NEWTON.format(k=k, next=k + 1) for k in range(NEWTON_STEPS))
_add("model_split", "SELECT household_key, held AS is_test FROM split", LABELLED, FEATURES, SPLIT)
_add(
    "model_medians",
    " UNION ALL ".join(
        f"SELECT '{c}' AS predictor, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS median FROM train" for c in NUMERIC
    ),
    LABELLED,
    FEATURES,
    SPLIT,
)
_add(
    "model_levels",
    "SELECT predictor, level, label, CAST(p - 1 AS INTEGER) AS place FROM slot",
    LABELLED,
    FEATURES,
    SPLIT,
    LEVELS,
)
_add(
    "model_coefficients",
    f"""
SELECT name AS feature, round(c, 6) AS coefficient
FROM (
  SELECT unnest(list_concat([{", ".join(f"'numeric__{c}'" for c in NUMERIC)}],
                            (SELECT list(concat('categorical__', predictor, '_', label) ORDER BY p) FROM place))) AS name,
         unnest(list_resize(b, len(b) - 1)) AS c
  FROM b{NEWTON_STEPS}
)
ORDER BY abs(c) DESC, name LIMIT 10
""",
    LABELLED,
    FEATURES,
    SPLIT,
    LEVELS,
    FITTED,
)
_add(
    "model_holdout",
    f"""
SELECT round((SELECT avg(CASE WHEN a.m > z.m THEN 1.0 WHEN a.m = z.m THEN 0.5 ELSE 0.0 END)
              FROM scored a JOIN scored z ON a.y = 1 AND z.y = 0), 3) AS model_auc,
       (SELECT count(*) FROM train) AS train_rows, (SELECT count(*) FROM scored) AS test_rows,
       CAST((SELECT any_value(last) FROM every) - 1 AS INTEGER) AS feature_count
""",
    LABELLED,
    FEATURES,
    SPLIT,
    LEVELS,
    FITTED,
    f"scored AS (SELECT y, list_dot_product(v, b) AS m FROM design CROSS JOIN b{NEWTON_STEPS} WHERE held),\n",
)
for _name in ("model_coefficients", "model_holdout"):
    ORACLES[_name] = ORACLES[_name].replace("WITH", "WITH RECURSIVE", 1)

# --- single operators ------------------------------------------------------------------------------------------------

_add(
    "interval_join",
    """
SELECT household_key, campaign, hit AS redeemed_flag, round(pre_c / 100.0, 2) AS pre_spend,
       round(post_c / 100.0, 2) AS post_spend, pre_b AS pre_baskets, post_b AS post_baskets
FROM behaviour
""",
    BEHAVIOUR,
)
_add(
    "existence_flag",
    """
SELECT household_key, campaign, CAST((household_key, campaign) IN (SELECT (household_key, campaign) FROM rdm) AS INTEGER)
  AS redeemed_flag
FROM expo
""",
)
_add(
    "missing_product_lines",
    """
SELECT product_id, count(*) AS transaction_lines FROM tx
WHERE NOT EXISTS (FROM goods g WHERE g.product_id = tx.product_id) GROUP BY product_id
""",
)
_add(
    "covered_households",
    "SELECT household_key FROM tx INTERSECT SELECT household_key FROM demo",
)
_add(
    "exact_grain_join",
    """
SELECT product_id, store_id, week_no, status AS promotion_status, round(net_c / 100.0, 2) AS sales, baskets,
       n_lines AS transaction_lines
FROM shelf_status
""",
    SHELF,
)
_add(
    "deduplicated_bridge",
    """
SELECT product_id, store_id, week_no, CAST(on_display AS INTEGER) AS display_flag,
       CAST(in_mailer AS INTEGER) AS mailer_flag
FROM shown
""",
    SHELF,
)
_add(
    "distinct_tuples",
    """
SELECT count(*) AS product_coupon_tuples, count(coupon_n) AS complete_tuples
FROM (SELECT DISTINCT product_id, coupon_n FROM tx)
""",
)
_add(
    "product_attributes",
    """
SELECT product_id, count(*) AS copies, max(manufacturer) AS manufacturer, max(brand) AS brand,
       max(curr_size_of_product) AS curr_size_of_product, max(department) AS department,
       max(commodity_desc) AS commodity_desc, max(sub_commodity_desc) AS sub_commodity_desc
FROM goods GROUP BY product_id
""",
)
_QUANTILES = [("basket_spend", "spend"), ("basket_units", "units")]
_add(
    "basket_quantiles",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS series, CAST({p} AS DOUBLE) AS probability,
        round(quantile_cont({column}, {p}), 4) AS quantile FROM measure"""
        for name, column in _QUANTILES
        for p in (0.5, 0.75, 0.99)
    ),
    BASKET,
    MEASURE,
)
_add(
    "outliers_above_p99",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS series, round(q, 4) AS quantile, count(*) FILTER ({column} > q) AS rows
        FROM measure, (SELECT quantile_cont({column}, 0.99) AS q FROM measure) GROUP BY q"""
        for name, column in _QUANTILES
    ),
    BASKET,
    MEASURE,
)
_add(
    "clipped_basket_spend",
    """
SELECT basket_id, household_key, round(least(spend, (SELECT quantile_cont(spend, 0.99) FROM measure)), 4) AS basket_spend
FROM measure
""",
    BASKET,
    MEASURE,
)
_add(
    "average_ranks",
    f"SELECT basket_id, household_key, units AS basket_units, CAST({_tied('units')} AS DOUBLE) AS units_rank FROM measure",
    BASKET,
    MEASURE,
)
_add("ntile_global", "SELECT household_key, tile AS value_quartile FROM quartiled", BASKET, HOUSEHOLD)
_add(
    "ntile_per_campaign",
    """
SELECT household_key, campaign,
       CAST(ntile(4) OVER (PARTITION BY campaign ORDER BY pre_c, household_key) AS INTEGER) AS prior_value_quartile
FROM behaviour
""",
    BEHAVIOUR,
)
_add(
    "top_department",
    """
SELECT household_key, department AS top_department, round(net_c / 100.0, 2) AS department_spend FROM favourite
""",
    LABELLED,
    FEATURES,
)
_add(
    "demographic_gaps",
    """
SELECT DISTINCT tx.household_key, CAST(demo.household_key IS NULL AS INTEGER) AS missing_demographic_flag
FROM tx LEFT JOIN demo ON demo.household_key = tx.household_key
""",
)
_add(
    "supported_categories",
    "SELECT department, commodity_desc, h AS household_count FROM category WHERE h >= 50",
    LABELLED,
    CATEGORY,
)
_add(
    "index_gaps",
    """
SELECT max(day) - min(day) + 1 - count(DISTINCT day) AS day_gaps,
       max(week_no) - min(week_no) + 1 - count(DISTINCT week_no) AS week_no_gaps
FROM tx
""",
)
_add(
    "label_collisions",
    """
SELECT upper(trim(commodity_desc)) AS normalized_label, count(DISTINCT commodity_desc) AS spellings
FROM goods WHERE commodity_desc IS NOT NULL GROUP BY 1 HAVING count(DISTINCT commodity_desc) > 1
""",
)
