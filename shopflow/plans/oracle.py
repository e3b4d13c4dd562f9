"""The same results in plain SQL over the test tables, for checking in another engine.

``CTES`` defines the retail model step by step; a query is the CTEs it needs and a SELECT.
Clean rules are written here a second time on purpose, from the rules' definition.
"""

# name -> body, in dependency order.
CTES = {
    "tx": """
SELECT (CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'C' ELSE '' END)
         || CAST(l_orderkey AS VARCHAR) AS invoice_no,
       CASE WHEN l_linenumber = 3 AND l_orderkey % 61 = 0 THEN ' sku' || CAST(l_partkey AS VARCHAR) || ' '
            WHEN l_partkey % 40 = 0 THEN 'SKU' || CAST(l_partkey AS VARCHAR) || '-'
                 || CAST(year(o_orderdate) * 100 + month(o_orderdate) AS VARCHAR)
            ELSE 'SKU' || CAST(l_partkey AS VARCHAR) END AS stock_code, p_name AS description,
       CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN -l_quantity
                 ELSE l_quantity END AS INTEGER) AS quantity,
       CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' AND l_orderkey % 50 = 0
              THEN CAST(make_date(1990, 1, CAST(1 + l_orderkey % 28 AS INTEGER)) AS TIMESTAMP)
            WHEN l_linenumber = 2 AND l_orderkey % 83 = 0 THEN NULL
            ELSE CAST(o_orderdate AS TIMESTAMP) END AS invoice_date,
       CAST(CASE WHEN l_linenumber = 3 AND l_orderkey % 89 = 0 THEN -1
                 WHEN p_type = 'PROMO' AND p_size <= 3 THEN 0 ELSE p_retailprice END
            AS DECIMAL(10,2)) AS unit_price,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL
            ELSE o_custkey END AS customer_id,
       CASE n_name WHEN 'NATION_0' THEN 'United Kingdom' WHEN 'NATION_1' THEN 'Germany'
                   WHEN 'NATION_2' THEN 'France' WHEN 'NATION_3' THEN 'EIRE'
                   WHEN 'NATION_4' THEN 'Australia' WHEN 'NATION_5' THEN 'Japan'
                   WHEN 'NATION_6' THEN 'USA' WHEN 'NATION_7' THEN 'Canada'
                   ELSE n_name END AS country
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "cust1": """
SELECT c_custkey AS customer_id, ' ' || c_name AS full_name,
       CASE WHEN c_acctbal < 0 THEN 'not-an-email'
            WHEN n_name = 'NATION_9' THEN NULL
            WHEN c_mktsegment = 'MACHINERY' THEN 'USER' || CAST(c_custkey AS VARCHAR) || '@EXAMPLE.COM'
            WHEN c_mktsegment = 'FURNITURE' THEN ' user' || CAST(c_custkey AS VARCHAR) || '@example.com '
            ELSE 'user' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
       CASE n_regionkey WHEN 0 THEN 'gold' WHEN 1 THEN 'Silver' WHEN 2 THEN 'BRONZE '
                        WHEN 3 THEN 'Platinum' ELSE 'Diamond' END AS loyalty_tier,
       c_acctbal > 9000 AS is_wholesaler, c_mktsegment = 'AUTOMOBILE' AS marketing_opt_in,
       c_acctbal
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "cust": """
SELECT * EXCLUDE (c_acctbal), TIMESTAMP '2001-08-01 00:00:00' AS ingested_at FROM cust1
UNION ALL
SELECT customer_id, full_name, email,
       CASE WHEN c_acctbal >= 8000 THEN ' platinum' ELSE loyalty_tier END,
       is_wholesaler, marketing_opt_in, TIMESTAMP '2001-08-02 00:00:00' FROM cust1""",
    "prod": """
SELECT 'SKU' || CAST(p_partkey AS VARCHAR) AS stock_code, ' ' || p_name AS description,
       CASE WHEN p_brand = 'Brand#1' THEN NULL WHEN p_brand = 'Brand#2' THEN ' '
            ELSE p_type END AS category,
       CAST(CASE WHEN p_type = 'PROMO' AND p_size <= 3 THEN 0 ELSE p_retailprice END
            AS DECIMAL(10,2)) AS avg_unit_price
FROM part WHERE p_brand <> 'Brand#13'
UNION ALL
SELECT 'SKU-U' || CAST(r_regionkey AS VARCHAR), 'never sold', 'UNSOLD', CAST(1 AS DECIMAL(10,2))
FROM region""",
    "routed": """
SELECT *, CASE WHEN invoice_no LIKE 'C%' THEN 'cancelled'
               WHEN customer_id IS NULL THEN 'quarantine'
               WHEN quantity > 0 AND unit_price >= 0 AND invoice_date IS NOT NULL
                    AND stock_code IS NOT NULL THEN 'valid'
               ELSE 'rejected' END AS route,
       concat_ws(',', CASE WHEN NOT coalesce(quantity > 0, false) THEN 'quantity_positive' END,
                 CASE WHEN NOT coalesce(unit_price >= 0, false) THEN 'unit_price_non_negative' END,
                 CASE WHEN invoice_date IS NULL THEN 'invoice_date_not_null' END) AS failed_rules
FROM tx""",
    "silver": """
SELECT * EXCLUDE (route, failed_rules, rn), CAST(quantity * unit_price AS DECIMAL(12,2)) AS line_total,
       CAST(year(invoice_date) AS INTEGER) AS invoice_year,
       CAST(month(invoice_date) AS INTEGER) AS invoice_month,
       CAST(weekofyear(invoice_date) AS INTEGER) AS invoice_week,
       CAST(invoice_date AS DATE) AS report_date
FROM (SELECT *, row_number() OVER (PARTITION BY invoice_no, stock_code ORDER BY
        invoice_date NULLS FIRST, quantity NULLS FIRST, unit_price NULLS FIRST,
        country NULLS FIRST, customer_id NULLS FIRST, description NULLS FIRST) AS rn
      FROM routed WHERE route = 'valid') WHERE rn = 1""",
    "cancelled": """
SELECT * EXCLUDE (route, failed_rules), substr(invoice_no, 2) AS original_invoice_no
FROM routed WHERE route = 'cancelled'""",
    "good_email": """
SELECT * FROM cust WHERE regexp_matches(trim(email),
  '^[a-zA-Z0-9._%+\\-]+@[a-zA-Z0-9.\\-]+\\.[a-zA-Z]{2,}$')""",
    "standard": """
SELECT customer_id, trim(full_name) AS full_name, lower(trim(email)) AS email,
       upper(left(trim(loyalty_tier), 1)) || lower(substr(trim(loyalty_tier), 2)) AS loyalty_tier,
       is_wholesaler, marketing_opt_in, ingested_at FROM good_email""",
    "customers": """
SELECT * EXCLUDE (rn, ingested_at) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ingested_at DESC) AS rn
  FROM standard WHERE loyalty_tier IN ('Bronze', 'Silver', 'Gold', 'Platinum')) WHERE rn = 1""",
    "products": """
SELECT stock_code, trim(description) AS description,
       CASE WHEN category IS NULL OR trim(category) = '' THEN 'Uncategorized'
            ELSE category END AS category, avg_unit_price
FROM prod WHERE avg_unit_price > 0""",
    "rfm": """
SELECT customer_id,
       CAST(date_diff('day', CAST(max(invoice_date) AS DATE), DATE '2001-08-02') AS INTEGER)
         AS days_since_last_purchase,
       count(DISTINCT invoice_no) AS total_orders,
       CAST(sum(line_total) AS DECIMAL(14,2)) AS total_revenue_lifetime,
       CAST(date_diff('day', CAST(min(invoice_date) AS DATE), DATE '2001-08-02') AS INTEGER)
         AS days_since_first_purchase,
       CAST(CAST((2 * CAST(sum(line_total) * 100 AS BIGINT) + count(DISTINCT invoice_no))
            // (2 * count(DISTINCT invoice_no)) AS DECIMAL(12,0)) / 100 AS DECIMAL(10,2))
         AS avg_order_value
FROM silver GROUP BY customer_id""",
    "scores": """
SELECT *,
  CAST(ntile(5) OVER (ORDER BY days_since_last_purchase DESC, customer_id) AS INTEGER) AS rfm_recency_score,
  CAST(ntile(5) OVER (ORDER BY total_orders, customer_id) AS INTEGER) AS rfm_frequency_score,
  CAST(ntile(5) OVER (ORDER BY total_revenue_lifetime, customer_id) AS INTEGER) AS rfm_monetary_score
FROM rfm""",
    "top_country": """
SELECT customer_id, country FROM (
  SELECT customer_id, country, row_number() OVER (
    PARTITION BY customer_id ORDER BY count(*) DESC, country) AS rn
  FROM silver GROUP BY customer_id, country) WHERE rn = 1""",
    "favourite": """
SELECT customer_id, category AS favourite_category FROM (
  SELECT customer_id, category, row_number() OVER (
    PARTITION BY customer_id ORDER BY sum(line_total) DESC, category) AS rn
  FROM silver JOIN products USING (stock_code) GROUP BY customer_id, category) WHERE rn = 1""",
    "c360": """
SELECT c.customer_id, full_name, loyalty_tier, total_revenue_lifetime, total_orders,
       avg_order_value, days_since_last_purchase, days_since_first_purchase,
       favourite_category, country, rfm_recency_score, rfm_frequency_score, rfm_monetary_score
FROM customers c LEFT JOIN scores s ON s.customer_id = c.customer_id
LEFT JOIN favourite f ON f.customer_id = c.customer_id
LEFT JOIN top_country t ON t.customer_id = c.customer_id""",
    "daily": """
SELECT report_date, CAST(sum(line_total) AS DECIMAL(14,2)) AS total_revenue,
       count(DISTINCT invoice_no) AS total_orders,
       count(DISTINCT customer_id) AS unique_customers,
       CAST(sum(quantity) AS BIGINT) AS total_units_sold,
       CAST(CAST(((CAST(sum(unit_price) * 100 AS HUGEINT) * 20000 + count(*)) // (2 * count(*)) + 5000)
            // 10000 AS DECIMAL(12,0)) / 100 AS DECIMAL(10,2)) AS avg_unit_price,
       CAST(CAST((2 * CAST(sum(line_total) * 100 AS BIGINT) + count(DISTINCT invoice_no))
            // (2 * count(DISTINCT invoice_no)) AS DECIMAL(12,0)) / 100 AS DECIMAL(10,2))
         AS avg_basket_value
FROM silver GROUP BY report_date""",
    "first_purchase": """
SELECT customer_id, min(report_date) AS first_purchase_date FROM silver GROUP BY customer_id""",
    "new_returning": """
SELECT report_date,
       count(DISTINCT CASE WHEN report_date = first_purchase_date THEN s.customer_id END) AS new_customers,
       count(DISTINCT CASE WHEN report_date <> first_purchase_date THEN s.customer_id END) AS returning_customers
FROM silver s LEFT JOIN first_purchase f ON f.customer_id = s.customer_id GROUP BY report_date""",
    "daily_cancelled": """
SELECT CAST(invoice_date AS DATE) AS report_date, count(DISTINCT invoice_no) AS cancelled_orders
FROM cancelled GROUP BY 1""",
    "category_revenue": """
SELECT report_date, category, CAST(sum(line_total) AS DECIMAL(14,2)) AS cat_revenue
FROM silver LEFT JOIN products USING (stock_code) GROUP BY report_date, category""",
    "top_category": """
SELECT report_date, category AS top_category_by_revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY report_date
    ORDER BY cat_revenue DESC, category NULLS LAST) AS rn FROM category_revenue) WHERE rn = 1""",
    "kpis": """
SELECT report_date, total_revenue, total_orders, unique_customers, total_units_sold,
       avg_unit_price, avg_basket_value, new_customers, returning_customers,
       coalesce(cancelled_orders, 0) AS cancelled_orders, top_category_by_revenue,
       CAST(CAST((20000 * coalesce(cancelled_orders, 0) + total_orders) // (2 * total_orders)
            AS DECIMAL(9,0)) / 10000 AS DECIMAL(9,4)) AS cancellation_rate
FROM daily LEFT JOIN new_returning USING (report_date)
LEFT JOIN daily_cancelled USING (report_date) LEFT JOIN top_category USING (report_date)""",
    "product_dimension": """
SELECT stock_code, description, avg_unit_price, first_listed_date FROM (
  SELECT stock_code, CAST(min(invoice_date) AS DATE) AS first_listed_date,
         CAST(CAST(sign(sum(unit_price)) * ((2 * abs(CAST(sum(unit_price) * 100 AS BIGINT)) + count(*))
              // (2 * count(*))) AS DECIMAL(12,0)) / 100 AS DECIMAL(10,2)) AS avg_unit_price
  FROM tx WHERE length(stock_code) <= 10 GROUP BY stock_code)
JOIN (SELECT stock_code, description, row_number() OVER (
        PARTITION BY stock_code ORDER BY count(*) DESC, description) AS rn
      FROM tx GROUP BY stock_code, description) USING (stock_code) WHERE rn = 1""",
    "top_skus": """
SELECT stock_code, count(*) AS tx_count FROM silver GROUP BY stock_code
ORDER BY tx_count DESC, stock_code LIMIT 50""",
    "weekly_all": """
SELECT stock_code, CAST(date_trunc('week', invoice_date) AS DATE) AS week_start,
       CAST(sum(quantity) AS BIGINT) AS units_sold FROM silver GROUP BY 1, 2""",
    "filled_all": """
SELECT c.stock_code, c.week_start, coalesce(units_sold, 0) AS units_sold FROM (
  SELECT stock_code, CAST(unnest(generate_series(min(week_start), max(week_start), INTERVAL 7 DAY)) AS DATE)
    AS week_start FROM weekly_all GROUP BY stock_code) c
LEFT JOIN weekly_all w ON w.stock_code = c.stock_code AND w.week_start = c.week_start""",
    "split_all": """
SELECT f.stock_code, week_start, units_sold,
       CAST(date_diff('day', first_week, week_start) // 7 AS INTEGER) AS week_no,
       week_start <= last_week - 28 AS is_train
FROM filled_all f JOIN (SELECT stock_code, min(week_start) AS first_week, max(week_start) AS last_week
                        FROM filled_all GROUP BY stock_code) b ON b.stock_code = f.stock_code""",
    "train_weeks": """
SELECT stock_code, CAST(sum(CASE WHEN is_train THEN 1 ELSE 0 END) AS BIGINT) AS train_weeks
FROM split_all GROUP BY stock_code""",
    "series_holdout": """
SELECT s.* FROM split_all s JOIN train_weeks USING (stock_code)
WHERE train_weeks >= 8 AND stock_code IN (SELECT stock_code FROM top_skus)""",
    "series_holdall": """
SELECT s.* FROM split_all s JOIN train_weeks USING (stock_code) WHERE train_weeks >= 8""",
    "series_refit": """
SELECT s.stock_code, week_start, units_sold, week_no, true AS is_train
FROM split_all s JOIN train_weeks USING (stock_code) WHERE train_weeks >= 8""",

    "backtest": """
SELECT stock_code, avg(abs(units_sold - yhat)) AS mae,
       avg(abs(units_sold - yhat) / greatest(abs(units_sold + 1e-6), 2.220446049250313e-16)) AS mape
FROM yhat_holdout WHERE NOT is_train GROUP BY stock_code""",
    "backtest_all": """
SELECT stock_code, avg(abs(units_sold - yhat)) AS mae,
       avg(abs(units_sold - yhat) / greatest(abs(units_sold + 1e-6), 2.220446049250313e-16)) AS mape
FROM yhat_holdall WHERE NOT is_train GROUP BY stock_code""",
    "future": """
SELECT stock_code, forecast_date, greatest(point, 0.0) AS predicted_units,
       greatest(point - 1.2815515655446004 * sigma, 0.0) AS lower_bound_80,
       greatest(point + 1.2815515655446004 * sigma, 0.0) AS upper_bound_80
FROM (SELECT a.*, trend * coalesce(ratio, 1.0) / scale AS point FROM (
        SELECT p.*, CAST(last_week + 7 * k AS DATE) AS forecast_date,
               month(CAST(last_week + 7 * k AS DATE)) AS fm,
               greatest(intercept + slope * (last_week_no + k), floor_level) AS trend
        FROM param_refit p, (SELECT CAST(unnest(generate_series(1, 12)) AS INTEGER) AS k)) a
      LEFT JOIN month_refit i ON i.stock_code = a.stock_code AND i.m = a.fm)""",
    "hist": """
SELECT rfm_recency_score AS r, rfm_frequency_score AS f, rfm_monetary_score AS m, count(*) AS n
FROM c360 WHERE rfm_recency_score IS NOT NULL GROUP BY 1, 2, 3""",
    "standard_hist": """
SELECT h.*, (r - ar) / sr AS zr, (f - af) / sf AS zf, (m - am) / sm AS zm FROM hist h, (
  SELECT avg(rfm_recency_score) AS ar, stddev_pop(rfm_recency_score) AS sr,
         avg(rfm_frequency_score) AS af, stddev_pop(rfm_frequency_score) AS sf,
         avg(rfm_monetary_score) AS am, stddev_pop(rfm_monetary_score) AS sm
  FROM c360 WHERE rfm_recency_score IS NOT NULL)""",
    "cells": """
SELECT * EXCLUDE (d0, d1, d2, d3), CASE WHEN d0 <= d1 AND d0 <= d2 AND d0 <= d3 THEN 0
       WHEN d1 <= d2 AND d1 <= d3 THEN 1 WHEN d2 <= d3 THEN 2 ELSE 3 END AS cluster_id
FROM (SELECT *, (zr - 1.1)**2 + (zf - 1.1)**2 + (zm - 1.1)**2 AS d0,
                (zr - 0.3)**2 + (zf - 0.3)**2 + (zm - 0.3)**2 AS d1,
                (zr + 0.4)**2 + (zf + 0.4)**2 + (zm + 0.4)**2 AS d2,
                (zr + 1.2)**2 + (zf + 1.2)**2 + (zm + 1.2)**2 AS d3 FROM standard_hist)""",
    "cell_distance": """
SELECT a.r, a.f, a.m, a.n, a.cluster_id AS own, b.cluster_id AS other,
       sum(b.n * sqrt((a.zr - b.zr)**2 + (a.zf - b.zf)**2 + (a.zm - b.zm)**2)) AS total, sum(b.n) AS size
FROM cells a, cells b GROUP BY a.r, a.f, a.m, a.n, a.cluster_id, b.cluster_id""",
    "silhouette": """
SELECT CAST(sum(n * CASE WHEN size > 1 THEN (b - a) / greatest(a, b) ELSE 0 END) / sum(n) AS DOUBLE) AS silhouette_score
FROM (SELECT n, max(size) FILTER (WHERE own = other) AS size,
             max(total) FILTER (WHERE own = other) / (max(size) FILTER (WHERE own = other) - 1) AS a,
             min(total / size) FILTER (WHERE own <> other) AS b
      FROM cell_distance GROUP BY r, f, m, n)""",
    "labels_fixed": """
SELECT cluster_id, customers, composite_score,
       ['Champions', 'Loyal Customers', 'At Risk', 'Lost Customers']
         [row_number() OVER (ORDER BY composite_score DESC, cluster_id)] AS customer_segment
FROM (SELECT cluster_id, CAST(sum(n) AS BIGINT) AS customers,
             sum(n * (zr + zf + zm)) / sum(n) AS composite_score FROM cells GROUP BY cluster_id)""",
    "lloyd": """
SELECT * FROM (VALUES
  (1, 0, 1.1::DOUBLE, 1.1::DOUBLE, 1.1::DOUBLE, 0.3::DOUBLE, 0.3::DOUBLE, 0.3::DOUBLE,
   -0.4::DOUBLE, -0.4::DOUBLE, -0.4::DOUBLE, -1.2::DOUBLE, -1.2::DOUBLE, -1.2::DOUBLE),
  (2, 0, 1.1, 0.9, 1.0, 0.8, -0.7, -1.05, -0.85, 0.75, 0.95, -1.0, -1.1, -0.9))
  AS v(start_no, step, r0, f0, m0, r1, f1, m1, r2, f2, m2, r3, f3, m3)
UNION ALL
SELECT start_no, any_value(step) + 1, {means}
FROM (SELECT l.*, n, zr, zf, zm, {nearest} AS k FROM lloyd l, standard_hist WHERE step < 50) GROUP BY start_no""",
    "lloyd_cells": """
SELECT start_no, h.*, {nearest} AS cluster_id FROM lloyd l, standard_hist h WHERE step = 50""",
    "lloyd_cost": """
SELECT start_no, sum(squares - (sr * sr + sf * sf + sm * sm) / n) AS cost FROM (
  SELECT start_no, cluster_id, sum(n) AS n, sum(n * zr) AS sr, sum(n * zf) AS sf, sum(n * zm) AS sm,
         sum(n * (zr * zr + zf * zf + zm * zm)) AS squares FROM lloyd_cells GROUP BY start_no, cluster_id)
GROUP BY start_no""",
    "lloyd_best": """
SELECT CASE WHEN max(cost) FILTER (start_no = 2) < max(cost) FILTER (start_no = 1) - 1e-9 THEN 2 ELSE 1 END AS start_no
FROM lloyd_cost""",
    "lloyd_labels": """
SELECT cluster_id, ['Champions', 'Loyal Customers', 'At Risk', 'Lost Customers']
         [row_number() OVER (ORDER BY sum(n * (zr + zf + zm)) / sum(n) DESC, cluster_id)] AS customer_segment
FROM lloyd_cells JOIN lloyd_best USING (start_no) GROUP BY cluster_id""",
    "event_log": """
SELECT ts AS "timestamp",
       CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS level,
       event_type || ' ' || CAST(event_id AS VARCHAR) AS message,
       CASE WHEN value < 5 THEN 'N/A' ELSE 'flow_' || CAST(user_id AS VARCHAR) END AS flow_name,
       CAST(event_id AS VARCHAR) AS batch_id, event_id, user_id, value, props FROM events""",
    "extract": """
SELECT CAST(l_orderkey AS VARCHAR) AS invoice_no,
       CASE WHEN l_linenumber = 5 AND l_returnflag = 'N' THEN NULL
            ELSE 'sku' || CAST(l_partkey AS VARCHAR) END AS stock_code,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS description,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS quantity,
       CASE WHEN l_linenumber = 6 THEN NULL
            ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 506 MINUTE END AS invoice_date,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS price, o_custkey AS customer_id,
       o_orderpriority AS country, o_orderstatus AS status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}


# A fit on a series table, step by step; ``{fit}`` tells the fits apart.
FIT = {
    "line_{fit}": """
SELECT stock_code, n, slope, (sy - slope * st) / n AS intercept, greatest(sy / n * 0.1, 1e-6) AS floor_level
FROM (SELECT *, CASE WHEN n * stt - st * st <> 0
        THEN CAST(n * sty - st * sy AS DOUBLE) / (n * stt - st * st) ELSE 0.0 END AS slope
  FROM (SELECT stock_code, count(*) AS n, CAST(sum(week_no) AS DOUBLE) AS st,
               CAST(sum(units_sold) AS DOUBLE) AS sy, CAST(sum(week_no * units_sold) AS DOUBLE) AS sty,
               CAST(sum(CAST(week_no AS BIGINT) * week_no) AS DOUBLE) AS stt
        FROM series_{fit} WHERE is_train GROUP BY stock_code))""",
    "trend_{fit}": """
SELECT s.*, month(week_start) AS m, greatest(intercept + slope * week_no, floor_level) AS trend
FROM series_{fit} s JOIN line_{fit} l ON l.stock_code = s.stock_code""",
    "month_{fit}": """
SELECT stock_code, m, avg(units_sold / trend) AS ratio FROM trend_{fit} WHERE is_train GROUP BY stock_code, m""",
    "scale_{fit}": """
SELECT stock_code, CASE WHEN mean > 0 THEN mean ELSE 1.0 END AS scale FROM (
  SELECT stock_code, (sum(ratio) + 12 - count(*)) / 12 AS mean FROM month_{fit} GROUP BY stock_code)""",
    "yhat_{fit}": """
SELECT t.*, greatest(trend * coalesce(ratio, 1.0) / scale, 0.0) AS yhat
FROM trend_{fit} t JOIN scale_{fit} c ON c.stock_code = t.stock_code
LEFT JOIN month_{fit} i ON i.stock_code = t.stock_code AND i.m = t.m""",
    "param_{fit}": """
SELECT l.stock_code, n, slope, intercept, floor_level, scale, sigma, last_week, last_week_no
FROM line_{fit} l JOIN scale_{fit} c ON c.stock_code = l.stock_code
JOIN (SELECT stock_code, stddev_pop(units_sold - yhat) FILTER (WHERE is_train) AS sigma,
             max(week_start) AS last_week, max(week_no) AS last_week_no
      FROM yhat_{fit} GROUP BY stock_code) y ON y.stock_code = l.stock_code""",
}


def _with_fits(ctes):
    """The fit's steps for every series, each right after the last table it needs."""
    out = {}
    for name, body in ctes.items():
        out[name] = body
        if name.startswith("series_"):
            fit = name.removeprefix("series_")
            out |= {k.format(fit=fit): v.format(fit=fit) for k, v in FIT.items()}
    return out


CTES = _with_fits(CTES)


def _nearest():
    """Number of the nearest of four centres, the lower one of equally near ones."""
    d = [f"((zr - r{k})**2 + (zf - f{k})**2 + (zm - m{k})**2)" for k in range(4)]
    tests = [f"WHEN {' AND '.join(f'{d[k]} <= {d[j]}' for j in range(k + 1, 4))} THEN {k}" for k in range(3)]
    return f"CASE {' '.join(tests)} ELSE 3 END"


_MEANS = ", ".join(
    f"coalesce(sum(n * z{c}) FILTER (k = {k}) / sum(n) FILTER (k = {k}), any_value({c}{k}))"
    for k in range(4) for c in "rfm")
for _name in ("lloyd", "lloyd_cells"):
    CTES[_name] = CTES[_name].format(nearest=_nearest(), means=_MEANS)

# Read in every step of a recursion: computed once.
MATERIALIZED = {"standard_hist"}


def needed(sql: str) -> list[str]:
    """CTEs a text uses, with those they use in turn, in definition order."""
    import re

    words = set(re.findall(r"[a-z_0-9]+", sql))
    for name in reversed(CTES):
        if name in words:
            words |= set(re.findall(r"[a-z_0-9]+", CTES[name]))
    return [name for name in CTES if name in words]


def query(select: str) -> str:
    names = needed(select)
    ctes = ",\n".join(
        f"{name} AS {'MATERIALIZED ' * (name in MATERIALIZED)}({CTES[name].strip()})" for name in names)
    return f"WITH {'RECURSIVE ' * ('lloyd' in names)}{ctes}\n{select.strip()}"


SELECTS = {
    "silver_transactions": """
SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id,
       country, line_total, invoice_year, invoice_month, invoice_week FROM silver""",
    "cancelled_transactions": """
SELECT invoice_no, original_invoice_no, stock_code, description, quantity, invoice_date,
       unit_price, customer_id, country FROM cancelled""",
    "quarantine_transactions": """
SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id,
       country, 'customer_id IS NULL' AS quarantine_reason FROM routed WHERE route = 'quarantine'""",
    "rejected_transactions": """
SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id,
       country, failed_rules FROM routed WHERE route = 'rejected'""",
    "strict_price_transactions": """
SELECT invoice_no, stock_code, quantity, unit_price, line_total FROM silver WHERE unit_price > 0""",
    "transaction_routes": """
SELECT route, count(*) AS row_count FROM routed GROUP BY route""",
    "expectation_report": """
SELECT rule, sum(CASE WHEN ok THEN 1 ELSE 0 END)::BIGINT AS passed_rows,
       sum(CASE WHEN ok THEN 0 ELSE 1 END)::BIGINT AS failed_rows FROM (
  SELECT 'quantity_positive' AS rule, coalesce(quantity > 0, false) AS ok FROM tx UNION ALL
  SELECT 'unit_price_non_negative', coalesce(unit_price >= 0, false) FROM tx UNION ALL
  SELECT 'invoice_date_not_null', invoice_date IS NOT NULL FROM tx UNION ALL
  SELECT 'invoice_no_not_null', invoice_no IS NOT NULL FROM tx UNION ALL
  SELECT 'stock_code_not_null', stock_code IS NOT NULL FROM tx UNION ALL
  SELECT 'customer_id_not_null', customer_id IS NOT NULL FROM tx) GROUP BY rule""",
    "observed_rules": """
SELECT rule, sum(CASE WHEN ok THEN 1 ELSE 0 END)::BIGINT AS passed_rows,
       sum(CASE WHEN ok THEN 0 ELSE 1 END)::BIGINT AS failed_rows FROM (
  SELECT 'quantity_positive' AS rule, coalesce(quantity > 0, false) AS ok FROM tx UNION ALL
  SELECT 'unit_price_non_negative', coalesce(unit_price >= 0, false) FROM tx UNION ALL
  SELECT 'invoice_date_not_null', invoice_date IS NOT NULL FROM tx UNION ALL
  SELECT 'invoice_no_not_null', invoice_no IS NOT NULL FROM tx UNION ALL
  SELECT 'stock_code_not_null', stock_code IS NOT NULL FROM tx UNION ALL
  SELECT 'customer_id_not_null', customer_id IS NOT NULL FROM tx) GROUP BY rule""",
    "customers_clean": """
SELECT customer_id, full_name, email, loyalty_tier, is_wholesaler, marketing_opt_in
FROM standard WHERE loyalty_tier IN ('Bronze', 'Silver', 'Gold', 'Platinum')""",
    "customers_scd1": """
SELECT customer_id, full_name, email, loyalty_tier, is_wholesaler, marketing_opt_in FROM customers""",
    "quarantine_customers": """
SELECT *, 'invalid_email' AS quarantine_reason
FROM cust WHERE coalesce(NOT regexp_matches(trim(email),
  '^[a-zA-Z0-9._%+\\-]+@[a-zA-Z0-9.\\-]+\\.[a-zA-Z]{2,}$'), true)""",
    "rejected_customers": """
SELECT *, 'loyalty_tier_valid' AS failed_rules
FROM standard WHERE loyalty_tier NOT IN ('Bronze', 'Silver', 'Gold', 'Platinum')""",
    "products_clean": "SELECT stock_code, description, category, avg_unit_price FROM products",
    "rejected_products": """
SELECT stock_code, avg_unit_price, 'avg_unit_price_positive' AS failed_rules
FROM prod WHERE NOT avg_unit_price > 0""",
    "product_flags": """
SELECT p.stock_code, description, category, avg_unit_price,
       p.stock_code NOT IN (SELECT stock_code FROM silver
         WHERE invoice_date >= DATE '2001-08-02' - 90) AS is_slow_mover,
       p.stock_code NOT IN (SELECT stock_code FROM silver) AS is_orphaned_sku FROM products p""",
    "orphan_skus": """
SELECT stock_code, count(*) AS sold_lines FROM silver
WHERE stock_code NOT IN (SELECT stock_code FROM products) GROUP BY stock_code""",
    "rfm": "SELECT * FROM rfm",
    "rfm_scores": """
SELECT customer_id, rfm_recency_score, rfm_frequency_score, rfm_monetary_score FROM scores""",
    "rfm_scores_distributed": """
SELECT customer_id, rfm_recency_score, rfm_frequency_score, rfm_monetary_score FROM scores""",
    "customer_top_country": "SELECT * FROM top_country",
    "customer_favourite_category": "SELECT * FROM favourite",
    "customer_facts": """
SELECT r.*, country, favourite_category FROM rfm r JOIN top_country USING (customer_id)
LEFT JOIN favourite USING (customer_id)""",
    "customer_360": """
SELECT *, CAST(NULL AS VARCHAR) AS customer_segment, CAST(NULL AS FLOAT) AS churn_risk_score FROM c360""",
    "customer_360_bucketed": """
SELECT *, CAST(NULL AS VARCHAR) AS customer_segment, CAST(NULL AS FLOAT) AS churn_risk_score FROM c360""",
    "first_purchase": "SELECT * FROM first_purchase",
    "daily_sales": "SELECT * FROM daily",
    "daily_new_returning": "SELECT * FROM new_returning",
    "daily_cancellations": "SELECT * FROM daily_cancelled",
    "cancel_only_days": """
SELECT * FROM daily_cancelled WHERE report_date NOT IN (SELECT report_date FROM silver)""",
    "daily_category_revenue": "SELECT * FROM category_revenue",
    "daily_top_category": "SELECT * FROM top_category",
    "daily_kpis": "SELECT * FROM kpis",
    "daily_kpis_incremental": "SELECT * FROM kpis",
    "pipeline_kpis": """
SELECT *, 'incremental' AS mode FROM kpis UNION ALL SELECT *, 'full_refresh' FROM kpis""",
    "pipeline_silver": """
SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id,
       country, line_total, invoice_year, invoice_month, invoice_week FROM silver""",
    "top_skus": "SELECT * FROM top_skus",
    "weekly_sales": """
SELECT * FROM weekly_all WHERE stock_code IN (SELECT stock_code FROM top_skus)""",
    "weekly_filled": "SELECT * FROM filled_all",
    "holdout_split": "SELECT * FROM split_all",
    "forecast_skipped": """
SELECT stock_code, train_weeks, 'fewer than 8 training weeks' AS reason
FROM train_weeks WHERE train_weeks < 8""",
    "forecast_params": """
SELECT stock_code, n AS train_weeks, last_week - CAST(7 * last_week_no AS INTEGER) AS first_week,
       last_week, round(slope, 6) AS slope, round(intercept, 6) AS intercept,
       round(sigma, 6) AS sigma FROM param_refit""",
    "forecast_month_index": """
SELECT p.stock_code, CAST(k AS INTEGER) AS month, round(coalesce(ratio, 1.0) / scale, 6) AS month_index
FROM param_refit p CROSS JOIN (SELECT unnest(generate_series(1, 12)) AS k)
LEFT JOIN month_refit i ON i.stock_code = p.stock_code AND i.m = k""",
    "forecast_backtest": """
SELECT stock_code, round(mae, 6) AS mae, round(mape, 4) AS mape FROM backtest""",
    "forecast_backtest_all": """
SELECT stock_code, round(mae, 6) AS mae, round(mape, 4) AS mape FROM backtest_all""",
    "forecast_metrics_all": """
SELECT round(avg(mae), 6) AS mean_mae, round(avg(mape), 4) AS mean_mape, count(*) AS n_skus_trained
FROM backtest_all""",
    "forecast_metrics": """
SELECT round(avg(mae), 6) AS mean_mae, round(avg(mape), 4) AS mean_mape, count(*) AS n_skus_trained
FROM backtest""",
    "demand_forecast": """
SELECT stock_code, forecast_date, round(predicted_units, 6) AS predicted_units,
       round(lower_bound_80, 6) AS lower_bound_80, round(upper_bound_80, 6) AS upper_bound_80,
       '1' AS model_version, 'run' AS run_id, TIMESTAMP '2024-01-31 00:00:00' AS generated_at
FROM future WHERE stock_code IN (SELECT stock_code FROM top_skus)""",
    "demand_forecast_all": """
SELECT stock_code, forecast_date, round(predicted_units, 6) AS predicted_units,
       round(lower_bound_80, 6) AS lower_bound_80, round(upper_bound_80, 6) AS upper_bound_80,
       '1' AS model_version, 'run' AS run_id, TIMESTAMP '2024-01-31 00:00:00' AS generated_at
FROM future""",
    "customer_keys": "SELECT DISTINCT customer_id FROM tx WHERE customer_id IS NOT NULL",
    "modal_country": """
SELECT customer_id, country FROM (
  SELECT customer_id, country, row_number() OVER (
    PARTITION BY customer_id ORDER BY count(*) DESC, country) AS rn
  FROM tx WHERE customer_id IS NOT NULL GROUP BY customer_id, country) WHERE rn = 1""",
    "product_dimension": "SELECT * FROM product_dimension",
    "preferred_store": """
SELECT customer_id, CASE country WHEN 'United Kingdom' THEN 'UK-001' WHEN 'Germany' THEN 'DE-001'
         WHEN 'France' THEN 'FR-001' WHEN 'EIRE' THEN 'IE-001' WHEN 'Australia' THEN 'AU-001'
         WHEN 'Japan' THEN 'JP-001' WHEN 'USA' THEN 'US-001' WHEN 'Canada' THEN 'CA-001'
         ELSE 'XX-001' END AS preferred_store_id FROM (
  SELECT customer_id, country, row_number() OVER (
    PARTITION BY customer_id ORDER BY count(*) DESC, country) AS rn
  FROM tx WHERE customer_id IS NOT NULL GROUP BY customer_id, country) WHERE rn = 1""",
    "store_sales": """
SELECT country || ' Online Store' AS store_name, country,
       CASE WHEN country IN ('Australia') THEN 'APAC' WHEN country = 'Japan' THEN 'APAC'
            WHEN country IN ('USA', 'Canada') THEN 'Americas' ELSE 'EMEA' END AS region,
       CASE country WHEN 'United Kingdom' THEN 'GBP' WHEN 'EIRE' THEN 'GBP' WHEN 'Australia' THEN 'AUD'
            WHEN 'Japan' THEN 'JPY' WHEN 'USA' THEN 'USD' WHEN 'Canada' THEN 'USD' ELSE 'EUR' END AS currency_code,
       CASE country WHEN 'United Kingdom' THEN 'UK-001' WHEN 'Germany' THEN 'DE-001' WHEN 'France' THEN 'FR-001'
            WHEN 'EIRE' THEN 'IE-001' WHEN 'Australia' THEN 'AU-001' WHEN 'Japan' THEN 'JP-001'
            WHEN 'USA' THEN 'US-001' ELSE 'CA-001' END AS store_id,
       CASE country WHEN 'United Kingdom' THEN 'Europe/London' WHEN 'Germany' THEN 'Europe/Berlin'
            WHEN 'France' THEN 'Europe/Paris' WHEN 'EIRE' THEN 'Europe/Dublin' WHEN 'Australia' THEN 'Australia/Sydney'
            WHEN 'Japan' THEN 'Asia/Tokyo' WHEN 'USA' THEN 'America/New_York' ELSE 'America/Toronto' END AS timezone,
       true AS is_active, CAST(NULL AS DATE) AS opened_date,
       CAST(sum(line_total) AS DECIMAL(14,2)) AS revenue, count(*) AS lines
FROM silver WHERE country NOT LIKE 'NATION%' GROUP BY country""",
    "rfm_histogram": """
SELECT r AS rfm_recency_score, f AS rfm_frequency_score, m AS rfm_monetary_score, n FROM hist""",
    "rfm_standardised": """
SELECT r AS rfm_recency_score, f AS rfm_frequency_score, m AS rfm_monetary_score, n,
       round(zr, 6) AS z_recency, round(zf, 6) AS z_frequency, round(zm, 6) AS z_monetary
FROM standard_hist""",
    "segment_assign_fixed": """
SELECT customer_id, cluster_id, customer_segment FROM c360
JOIN cells ON rfm_recency_score = r AND rfm_frequency_score = f AND rfm_monetary_score = m
JOIN labels_fixed USING (cluster_id)""",
    "segment_silhouette": "SELECT round(silhouette_score, 6) AS silhouette_score FROM silhouette",
    "segment_labels": """
SELECT cluster_id, customers, round(composite_score, 6) AS composite_score, customer_segment
FROM labels_fixed""",
    "segment_distribution": "SELECT customer_segment, customers FROM labels_fixed",
    "customer_360_segments": """
SELECT c360.*, customer_segment, CAST(NULL AS FLOAT) AS churn_risk_score FROM c360
LEFT JOIN (SELECT r, f, m, customer_segment FROM cells JOIN labels_fixed USING (cluster_id))
  ON rfm_recency_score = r AND rfm_frequency_score = f AND rfm_monetary_score = m""",
    "model_gate": """
SELECT 'segmentation' AS model, '2' AS version, 'run-2' AS run_id, 'silhouette_score' AS metric,
       '>=' AS op, CAST(0.05 AS DOUBLE) AS threshold, round(silhouette_score, 6) AS value,
       silhouette_score >= 0.05 AS passed, CAST(NULL AS VARCHAR) AS error FROM silhouette
UNION ALL
SELECT 'demand_forecast', '10', 'run-10', 'mean_mape', '<=', 5.0, round(avg(mape), 6),
       avg(mape) <= 5.0, CAST(NULL AS VARCHAR) FROM backtest""",
    "gate_summary": """
SELECT silhouette_score >= 0.05 AND mape <= 5.0 AS all_passed,
       CAST(silhouette_score >= 0.05 AS BIGINT) + CAST(mape <= 5.0 AS BIGINT) AS passed_models,
       2 - CAST(silhouette_score >= 0.05 AS BIGINT) - CAST(mape <= 5.0 AS BIGINT) AS failed_models
FROM silhouette, (SELECT avg(mape) AS mape FROM backtest)""",
    "recent_errors": """
SELECT "timestamp", flow_name, batch_id, level, message FROM event_log
WHERE level IN ('ERROR', 'WARN') AND "timestamp" >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 720 MINUTE
ORDER BY "timestamp" DESC, message LIMIT 10""",
    "error_exceptions": """
SELECT "timestamp", level, flow_name, 'Outer' AS class_name, 'event ' || batch_id AS message
FROM event_log WHERE level = 'ERROR' AND NOT value < 10
UNION ALL
SELECT "timestamp", level, flow_name, 'Inner', 'user ' || CAST(user_id AS VARCHAR)
FROM event_log WHERE level = 'ERROR' AND NOT value < 10
UNION ALL
SELECT "timestamp", level, flow_name, NULL, 'broken ' || props FROM event_log
WHERE level = 'ERROR' AND value < 10""",
    "watermark_increment": """
SELECT * FROM tx WHERE invoice_date > TIMESTAMP '1998-07-01 00:00:00'""",
    "watermark_upsert": """
SELECT 'pl_ingest_transactions' AS pipeline_name, max(invoice_date) AS last_watermark_value FROM tx
UNION ALL SELECT 'pl_new', max(invoice_date) FROM tx
UNION ALL SELECT 'pl_other', TIMESTAMP '1998-07-01 00:00:00'""",
    "keep_last": """
SELECT * EXCLUDE (rn) FROM (SELECT * REPLACE (upper(trim(invoice_no)) AS invoice_no, upper(trim(stock_code)) AS stock_code),
  row_number() OVER (PARTITION BY upper(trim(invoice_no)), upper(trim(stock_code)) ORDER BY
  invoice_date DESC, quantity DESC, unit_price DESC, country DESC, customer_id DESC NULLS LAST,
  description DESC) AS rn FROM tx) WHERE rn = 1""",
    "duplicate_count": """
SELECT count(*) - count(DISTINCT invoice_no || '|' || stock_code) AS dropped_rows FROM tx""",
    "keep_last_observed": """
SELECT count(*) AS all_rows, count(DISTINCT upper(trim(invoice_no)) || '|' || upper(trim(stock_code))) AS kept_rows,
       count(*) - count(DISTINCT upper(trim(invoice_no)) || '|' || upper(trim(stock_code))) AS dropped_rows FROM tx""",
    "late_rows": "SELECT * FROM tx WHERE invoice_date IS NOT NULL",
    "stream_archive": "SELECT * FROM tx WHERE invoice_date IS NOT NULL",
    "landing_violations": """
SELECT '2001-07-31' AS run_date, 'missing column email; column customer_id is string, declared bigint' AS problems,
       CAST(0 AS BIGINT) AS read_rows
UNION ALL SELECT '2001-08-01', NULL, count(*) FROM cust1 UNION ALL SELECT '2001-08-02', NULL, count(*) FROM cust1""",
    "normalise_raw": """
SELECT invoice_no, stock_code, description, quantity, invoice_date,
       CAST(price AS DECIMAL(10,2)) AS unit_price, customer_id, country FROM extract
WHERE invoice_date IS NOT NULL AND stock_code IS NOT NULL""",
    "conform_types": """
SELECT invoice_no, stock_code, description, quantity, invoice_date,
       CAST(price AS DECIMAL(10,2)) AS unit_price, customer_id, country FROM extract""",
    "table_counts": """
SELECT 'transactions' AS table_name, count(*) AS row_count FROM tx
UNION ALL SELECT 'customers', count(*) FROM cust UNION ALL SELECT 'products', count(*) FROM prod
UNION ALL SELECT 'stores', 12 UNION ALL SELECT 'pipeline_watermarks', 2""",
    "transaction_profile": """
SELECT count(*) AS row_count, min(invoice_date) AS first_date, max(invoice_date) AS last_date,
       count(DISTINCT customer_id) AS customers, count(DISTINCT stock_code) AS skus,
       count(DISTINCT country) AS countries,
       CAST(sum(CASE WHEN invoice_no LIKE 'C%' THEN 1 ELSE 0 END) AS BIGINT) AS cancelled_lines FROM tx""",
    "contract_violations": """
SELECT 'invoice_no' AS column_name, count(*) FILTER (WHERE invoice_no IS NULL) AS null_rows
FROM extract
UNION ALL SELECT 'stock_code', count(*) FILTER (WHERE stock_code IS NULL) FROM extract
UNION ALL SELECT 'quantity', count(*) FILTER (WHERE quantity IS NULL) FROM extract
UNION ALL SELECT 'invoice_date', count(*) FILTER (WHERE invoice_date IS NULL) FROM extract
UNION ALL SELECT 'unit_price', count(*) FILTER (WHERE price IS NULL) FROM extract""",
    "csv_products": "SELECT * FROM product_dimension",
    "land_snapshot": "SELECT * EXCLUDE (ingested_at) FROM cust",
    "stream_bronze": "SELECT * FROM tx WHERE invoice_date IS NOT NULL",
    "stream_dedupe_keys": "SELECT invoice_no, stock_code FROM silver",
    "stream_dedupe_rows": """
SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id,
       country, line_total, invoice_year, invoice_month, invoice_week FROM silver""",
    "stream_dedupe_parts": """
SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id,
       country, line_total, invoice_year, invoice_month, invoice_week FROM silver""",
    "key_violations": """
SELECT 'raw' AS table_name, invoice_no, stock_code, count(*) AS rows FROM tx
GROUP BY invoice_no, stock_code HAVING count(*) > 1""",
    "stream_cancelled": """
SELECT invoice_no, original_invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id,
       country FROM cancelled WHERE invoice_date IS NOT NULL""",
    "stream_side_tables": """
SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country, route,
       CASE route WHEN 'cancelled' THEN substr(invoice_no, 2)
                  WHEN 'quarantine' THEN 'customer_id IS NULL' ELSE failed_rules END AS reason
FROM routed WHERE route <> 'valid' AND invoice_date IS NOT NULL""",
    "stream_scd1_backlog": """
SELECT customer_id, full_name, email, loyalty_tier, is_wholesaler, marketing_opt_in FROM customers""",
    "products_backlog": """
SELECT stock_code, trim(description) AS description,
       CASE WHEN category IS NULL OR trim(category) = '' THEN 'Uncategorized' ELSE category END AS category,
       avg_unit_price
FROM (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY day DESC) AS rn FROM (
        SELECT stock_code, description, 'EARLIER' AS category,
               CAST(avg_unit_price + 1 AS DECIMAL(10,2)) AS avg_unit_price, 1 AS day FROM prod
        UNION ALL SELECT stock_code, description, category, avg_unit_price, 2 FROM prod)
      WHERE avg_unit_price > 0) WHERE rn = 1""",
    "stream_products": """
SELECT stock_code, description, 'EARLIER' AS category, CAST(avg_unit_price + 1 AS DECIMAL(10,2)) AS avg_unit_price,
       DATE '2001-08-01' AS snapshot_date FROM prod
UNION ALL SELECT stock_code, description, category, avg_unit_price, DATE '2001-08-02' FROM prod""",
    "text_lengths": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, {n} AS max_length, max(length({c}))::INTEGER AS longest, "
        f"count(*) FILTER (WHERE length({c}) > {n}) AS too_long_rows FROM {table}"
        for name, table, limits in [
            ("transactions", "tx", {"invoice_no": 20, "stock_code": 20, "description": 255, "country": 100}),
            ("customers", "cust", {"full_name": 150, "email": 255, "loyalty_tier": 20}),
            ("products", "prod", {"stock_code": 20, "description": 255, "category": 100})]
        for c, n in limits.items()),
    "stream_lineage": """
SELECT CASE WHEN invoice_date <= TIMESTAMP '1998-07-01 00:00:00' THEN '1998-07-02' ELSE '2001-08-02' END AS run_date,
       count(*) AS row_count, count(*) AS stamped_rows FROM tx
WHERE invoice_date IS NOT NULL GROUP BY 1""",
    "snapshot_products": "SELECT * FROM prod",
    "snapshot_customers": """
SELECT * EXCLUDE (ingested_at) FROM cust WHERE ingested_at = TIMESTAMP '2001-08-02 00:00:00'""",
    "full_refresh_table": """
SELECT * FROM product_dimension""",
    "run_records": """
SELECT 'demand_forecast' AS model, '1' AS version, 'run' AS run_id, kind, key, value,
       TIMESTAMP '2024-01-31 00:00:00' AS logged_at
FROM (SELECT 'param' AS kind, 'n_skus' AS key, 'all' AS value
      UNION ALL SELECT 'param', 'forecast_horizon_weeks', '12'
      UNION ALL SELECT 'metric', 'n_skus_trained', CAST(count(*) AS VARCHAR) FROM backtest_all)""",
    "kmeans_check": """
SELECT count(*) AS customers, CAST(4 AS BIGINT) AS clusters, CAST(4 AS BIGINT) AS labels, true AS not_worse
FROM c360 WHERE rfm_recency_score IS NOT NULL""",
    "gate_promote": """
SELECT 'segmentation' AS model, 'champion' AS alias, '1' AS version, CAST(NULL AS TIMESTAMP) AS promoted_at,
       silhouette_score >= 1.1 AS passed FROM silhouette
UNION ALL SELECT 'demand_forecast', 'champion', '10', TIMESTAMP '2024-01-31 00:00:00', avg(mape) >= 0 FROM backtest_all
UNION ALL SELECT 'kept', 'champion', '7', NULL, false
UNION ALL SELECT 'rerun', 'champion', '4', TIMESTAMP '2024-01-31 00:00:00', true
UNION ALL SELECT 'weekly', 'champion', '2024w10', TIMESTAMP '2024-01-31 00:00:00', true""",
    "kmeans_segments": """
SELECT customer_id, cluster_id, customer_segment, 'run' AS run_id FROM c360
JOIN (SELECT * FROM lloyd_cells JOIN lloyd_best USING (start_no))
  ON rfm_recency_score = r AND rfm_frequency_score = f AND rfm_monetary_score = m
JOIN lloyd_labels USING (cluster_id)""",
    "stream_scd1_buckets": """
SELECT customer_id, full_name, email, loyalty_tier, is_wholesaler, marketing_opt_in FROM customers""",
    "stream_scd1": """
SELECT customer_id, full_name, email, loyalty_tier, is_wholesaler, marketing_opt_in FROM customers""",
}


def all_queries() -> dict[str, str]:
    return {name: query(select) for name, select in SELECTS.items()}
