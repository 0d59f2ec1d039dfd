"""Shared derived tables of the SQL side, in DuckDB SQL. Names start with x_."""

from tidemill import fixed_values as fv
from tidemill.plans import adapters as ad


def sql_list(values) -> str:
    return ", ".join("'" + str(v) + "'" for v in values)


def pick(values, index: str) -> str:
    return f"list_extract([{sql_list(values)}], CAST({index} AS INTEGER) + 1)"


def case_of(rules, otherwise: str | None) -> str:
    """CASE text from (condition, label) pairs."""
    body = " ".join(f"WHEN {cond} THEN '{label}'" for cond, label in rules)
    rest = "" if otherwise is None else f" ELSE '{otherwise}'"
    return f"CASE {body}{rest} END"


def segment_case(segments, otherwise: str, r: str, f: str, m: str) -> str:
    def within(c, bounds):
        return f"{c} BETWEEN {bounds[0]} AND {bounds[1]}"

    return case_of(
        [(" AND ".join([within(r, rr), within(f, ff), within(m, mm)]), n) for n, rr, ff, mm in segments], otherwise
    )


def micros(later: str, earlier: str) -> str:
    return f"CAST(epoch_us({later}) - epoch_us({earlier}) AS DOUBLE)"


def _price(c: str) -> str:
    return f"CAST({c} AS DECIMAL(12,2))"


_SERIES = list(ad.SERIES_SCALES)

TABLES: dict[str, str] = {}

# --- commerce -----------------------------------------------------------------------------

TABLES["x_ro"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'created' ELSE 'canceled' END AS order_status,
       o_orderdate AS bought,
       o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS approved,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS shipped,
       CASE WHEN o_orderstatus = 'F'
            THEN o_orderdate + to_days(CAST(2 + o_orderkey % 29 AS INTEGER)) + to_hours(CAST(o_orderkey % 7 AS INTEGER))
       END AS arrived,
       o_orderdate + INTERVAL 20 DAY AS promised
FROM orders
"""
TABLES["x_ri"] = """
SELECT l_orderkey AS order_id, l_linenumber AS item_seq, l_partkey AS product_id, l_suppkey AS seller_id,
       l_shipdate AS shipping_limit_at,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(10,2)) AS price,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS freight_value
FROM lineitem
"""
TABLES["x_c"] = """
SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id,
       lpad(CAST(c_custkey % 997 AS VARCHAR), 5, '0') AS zip_code,
       upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' Town' AS city,
       upper(n_name) AS state
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
TABLES["x_s"] = """
SELECT s_suppkey AS seller_id, lpad(CAST(s_suppkey % 1009 AS VARCHAR), 5, '0') AS zip_code,
       'Port ' || upper(n_name[1]) || lower(n_name[2:]) AS city, upper(n_name) AS state
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""
TABLES["x_p"] = f"""
SELECT p_partkey AS product_id, p_type AS category_pt,
       {case_of([(f"p_type = '{k}'", v) for k, v in ad.CATEGORY_NAMES.items()], None)} AS named,
       coalesce(named, p_type) AS category, length(p_name) AS name_length, p_size * 3 AS description_length,
       p_size % 5 AS photos_qty, p_size * 100 AS weight_g, p_size AS length_cm, p_size + 1 AS height_cm,
       p_size + 2 AS width_cm, p_size * (p_size + 1) * (p_size + 2) AS volume_cm3
FROM part
"""
TABLES["x_pay"] = """
SELECT o_orderkey AS order_id, 1 AS payment_seq, lower(o_orderpriority) AS payment_type,
       1 + o_custkey % 12 AS installments, CAST(o_totalprice AS DECIMAL(10,2)) AS payment_value
FROM orders
"""
TABLES["x_rev"] = """
SELECT o_orderkey * 2 + k AS review_id, o_orderkey AS order_id, 1 + (o_orderkey + k) % 5 AS review_score,
       CASE WHEN o_orderkey % 3 <> 0 THEN 'fine' END AS comment_title,
       CASE WHEN o_orderkey % 4 >= 2 THEN 'arrived' END AS comment_message,
       o_orderkey % 4 >= 2 AS has_comment,
       o_orderdate + INTERVAL 25 DAY AS created_at,
       o_orderdate + INTERVAL 25 DAY + to_hours(CAST(o_orderkey % 100 AS INTEGER)) AS answered_at,
       CAST(o_orderkey % 100 AS DOUBLE) AS response_time_hours
FROM orders JOIN (VALUES (1), (2)) AS copies(k)
  ON o_orderkey % 7 <> 0 AND (k = 1 OR o_orderkey % 10 = 0)
"""
TABLES["x_o"] = f"""
SELECT order_id, customer_id, order_status, bought AS purchased_at, approved AS approved_at, shipped AS shipped_at,
       arrived AS delivered_at, promised AS estimated_delivery_at,
       order_status = 'delivered' AS is_delivered, order_status = 'canceled' AS is_canceled,
       {micros('arrived', 'bought')} / 86400e6 AS days_to_deliver,
       {micros('approved', 'bought')} / 3600e6 AS hours_to_approve,
       {micros('promised', 'arrived')} / 86400e6 AS delivery_delta_days
FROM x_ro
"""
TABLES["x_revmean"] = "SELECT order_id, avg(review_score) AS score FROM x_rev GROUP BY order_id"
TABLES["x_enriched"] = """
SELECT o.*, coalesce(i.n, 0) AS total_items, coalesce(i.p, 0) AS total_product_value,
       coalesce(i.f, 0) AS total_freight, coalesce(i.p + i.f, 0) AS total_order_value,
       coalesce(i.np, 0) AS unique_products, coalesce(i.ns, 0) AS unique_sellers,
       coalesce(y.n, 0) AS payment_count, coalesce(y.v, 0) AS total_paid,
       y.t AS primary_payment_type, y.m AS max_installments,
       r.s AS avg_review_score, coalesce(r.n, 0) AS review_count, coalesce(r.c, FALSE) AS has_review_comment
FROM x_o o
LEFT JOIN (SELECT order_id, count(*) n, sum(price) p, sum(freight_value) f, count(DISTINCT product_id) np,
                  count(DISTINCT seller_id) ns FROM x_ri GROUP BY order_id) i USING (order_id)
LEFT JOIN (SELECT order_id, count(*) n, sum(payment_value) v, max(payment_type) t, max(installments) m
           FROM x_pay GROUP BY order_id) y USING (order_id)
LEFT JOIN (SELECT order_id, avg(review_score) s, count(*) n, bool_or(has_comment) c
           FROM x_rev GROUP BY order_id) r USING (order_id)
"""
TABLES["x_fact"] = """
SELECT e.*, c.customer_unique_id, CAST(e.purchased_at AS DATE) AS order_date
FROM x_enriched e LEFT JOIN x_c c USING (customer_id)
"""
TABLES["x_itemfact"] = """
SELECT i.*, i.price + i.freight_value AS total_item_value, CAST(o.purchased_at AS DATE) AS order_date,
       o.order_status, p.category AS product_category, s.state AS seller_state
FROM x_ri i JOIN x_o o USING (order_id) LEFT JOIN x_p p USING (product_id) LEFT JOIN x_s s USING (seller_id)
"""
TABLES["x_metrics"] = f"""
SELECT c.customer_unique_id, min(c.city) AS city, min(c.state) AS state, count(DISTINCT e.order_id) AS order_count,
       sum(e.total_order_value) AS total_spend,
       CAST(sum(e.total_order_value) AS DOUBLE) / count(e.total_order_value) AS avg_order_value,
       min(e.purchased_at) AS first_order_at, max(e.purchased_at) AS last_order_at,
       avg(e.avg_review_score) AS avg_review_score, sum(e.total_items) AS total_items_bought,
       avg(e.days_to_deliver) AS avg_delivery_days,
       {micros('max(e.purchased_at)', 'min(e.purchased_at)')} / 86400e6 AS customer_lifetime_days
FROM x_c c JOIN x_enriched e USING (customer_id) GROUP BY 1
"""
TABLES["x_tiers"] = """
SELECT m.*, CASE WHEN s >= cut[3] THEN 'Premium' WHEN s >= cut[2] THEN 'Regular' WHEN s >= cut[1] THEN 'Basic'
            ELSE 'Low' END AS customer_segment
FROM (SELECT *, CAST(total_spend AS DOUBLE) AS s FROM x_metrics) m,
     (SELECT quantile_cont(CAST(total_spend AS DOUBLE), [0.25, 0.5, 0.75]) AS cut FROM x_metrics WHERE total_spend > 0) q
"""
TABLES["x_daily"] = """
SELECT order_date, count(*) AS order_count, sum(total_order_value) AS gross_revenue,
       sum(total_product_value) AS net_revenue, sum(total_freight) AS total_freight,
       CAST(sum(total_order_value) AS DOUBLE) / count(*) AS avg_order_value, sum(total_items) AS items_sold,
       count(DISTINCT customer_unique_id) AS unique_customers, avg(avg_review_score) AS avg_review,
       count(*) FILTER (is_canceled) AS canceled_orders,
       100.0 * count(*) FILTER (is_canceled) / count(*) AS cancellation_rate_pct
FROM x_fact GROUP BY order_date
"""
TABLES["x_topcat"] = """
SELECT order_date, arg_max(c, (v, n)) AS top_category, max(v) AS top_category_revenue
FROM (SELECT order_date, product_category AS c, sum(total_item_value) AS v,
             -row_number() OVER (PARTITION BY order_date ORDER BY product_category) AS n
      FROM x_itemfact WHERE product_category IS NOT NULL GROUP BY 1, 2) GROUP BY 1
"""
TABLES["x_toppay"] = """
SELECT order_date, arg_max(c, (v, n)) AS top_payment_type, max(v) AS top_payment_total
FROM (SELECT f.order_date, p.payment_type AS c, sum(p.payment_value) AS v,
             -row_number() OVER (PARTITION BY f.order_date ORDER BY p.payment_type) AS n
      FROM x_fact f JOIN x_pay p USING (order_id) GROUP BY 1, 2) GROUP BY 1
"""
TABLES["x_logday"] = """
SELECT order_date, count(*) AS delivered_orders, avg(days_to_deliver) AS avg_delivery_days,
       quantile_cont(days_to_deliver, 0.5) AS median_delivery_days,
       quantile_cont(days_to_deliver, 0.95) AS p95_delivery_days,
       CAST(sum(total_freight) AS DOUBLE) / count(*) AS avg_freight, sum(total_freight) AS total_freight,
       100.0 * count(*) FILTER (delivery_delta_days >= 0) / count(*) AS on_time_rate_pct,
       avg(avg_review_score) AS avg_review, count(*) FILTER (delivery_delta_days < 0) AS late_deliveries,
       avg(-delivery_delta_days) FILTER (delivery_delta_days < 0) AS avg_late_days
FROM x_fact WHERE is_delivered GROUP BY order_date
"""

# --- market -------------------------------------------------------------------------------

TABLES["x_et"] = """
SELECT event_id AS trade_id, upper(event_type) AS symbol, CAST(value AS DECIMAL(18,8)) AS price,
       CAST(json_extract_string(props, '$.k') AS DECIMAL(18,8)) AS quantity, ts AS trade_time,
       user_id % 2 = 1 AS is_buyer_maker, ts + INTERVAL 5 SECOND AS ingested_at
FROM events
"""
TABLES["x_mt"] = f"""
SELECT (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey AS trade_id,
       {pick(ad.MARKET_SYMBOLS, 'l_suppkey % 5')} AS symbol,
       CAST(l_extendedprice AS DECIMAL(18,8)) AS price, CAST(l_quantity AS DECIMAL(18,8)) AS quantity,
       l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) + to_minutes(CAST(l_partkey % 60 AS INTEGER)) AS trade_time,
       l_returnflag = 'R' AS is_buyer_maker
FROM lineitem
"""
_STAGED = """
SELECT *, CAST(CAST(price AS DECIMAL(30,10)) * CAST(quantity AS DECIMAL(8,0)) AS DECIMAL(18,8)) AS trade_value_usd,
       CASE WHEN is_buyer_maker THEN 'sell' ELSE 'buy' END AS trade_side, CAST(trade_time AS DATE) AS trade_date,
       hour(trade_time) AS trade_hour, dayofweek(trade_time) + 1 AS trade_day_of_week
FROM {} WHERE price > 0 AND quantity > 0
"""
TABLES["x_est"] = _STAGED.format("x_et")
TABLES["x_mst"] = _STAGED.format("x_mt")
_DAYBARS = """
SELECT b.*, close_price - open_price AS price_change,
       (close_price - open_price) / open_price * 100 AS price_change_percentage,
       high_price - low_price AS price_range,
       (high_price - low_price) / avg_price * 100 AS volatility_percentage,
       CASE WHEN total_value_usd > 0 THEN (buy_volume_usd - sell_volume_usd) / total_value_usd ELSE 0 END AS buy_sell_pressure,
       total_value_usd / trade_count AS avg_trade_size_usd
FROM (SELECT symbol, trade_date, CAST(arg_min(price, (trade_time, trade_id)) AS DOUBLE) AS open_price,
             CAST(max(price) AS DOUBLE) AS high_price, CAST(min(price) AS DOUBLE) AS low_price,
             CAST(arg_max(price, (trade_time, trade_id)) AS DOUBLE) AS close_price,
             CAST(sum(price) AS DOUBLE) / count(*) AS avg_price, CAST(sum(quantity) AS DOUBLE) AS total_volume,
             CAST(sum(trade_value_usd) AS DOUBLE) AS total_value_usd, count(*) AS trade_count,
             CAST(coalesce(sum(trade_value_usd) FILTER (trade_side = 'buy'), 0) AS DOUBLE) AS buy_volume_usd,
             CAST(coalesce(sum(trade_value_usd) FILTER (trade_side = 'sell'), 0) AS DOUBLE) AS sell_volume_usd,
             min(trade_time) AS first_trade_at, max(trade_time) AS last_trade_at
      FROM {} GROUP BY symbol, trade_date) b
"""
TABLES["x_ebar"] = _DAYBARS.format("x_est")
TABLES["x_bar"] = _DAYBARS.format("x_mst")
TABLES["x_coin"] = f"""
SELECT {pick(ad.COIN_IDS, 'slot')} AS coin_id,
       lower(replace({pick(ad.MARKET_SYMBOLS, 'slot')}, 'USDT', '')) AS symbol,
       upper(coin_id[1]) || coin_id[2:] AS name, g.*,
       CAST(current_price * pct * 0.01 AS DECIMAL(18,4)) AS price_change_24h
FROM (SELECT o_custkey % 5 AS slot, o_orderdate AS last_updated, max({_price('o_totalprice')}) AS current_price,
             sum({_price('o_totalprice')}) * 10 AS market_cap, sum({_price('o_totalprice')}) AS total_volume,
             CAST(CAST((sum(o_orderkey) % 2001 - 1000) AS DECIMAL(10,4)) * 0.01 AS DECIMAL(10,4)) AS pct
      FROM orders GROUP BY 1, 2) g
"""
TABLES["x_sent"] = """
SELECT CAST(o_orderdate AS DATE) AS value_date, CAST(sum(o_orderkey) % 101 AS BIGINT) AS value FROM orders GROUP BY 1
"""

# --- macro --------------------------------------------------------------------------------

TABLES["x_series"] = f"""
SELECT series_id, date,
       (((cents - shift * 100 * n) * 100) // (n * scale)) / 10000.0 AS value,
       series_id || ' title' AS series_title, 'index' AS series_units, 'monthly' AS series_frequency,
       CAST(date AS TIMESTAMP) + INTERVAL 1 DAY AS ingested_at
FROM (SELECT *, list_extract([{', '.join(str(a) for a, _ in ad.SERIES_SCALES.values())}], slot + 1) AS shift,
             list_extract([{', '.join(str(b) for _, b in ad.SERIES_SCALES.values())}], slot + 1) AS scale,
             {pick(_SERIES, 'slot')} AS series_id
      FROM (SELECT CAST(o_custkey % {len(_SERIES)} AS INTEGER) AS slot,
                   CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
                   CAST(sum({_price('o_totalprice')}) * 100 AS BIGINT) AS cents, count(*) AS n
            FROM orders GROUP BY 1, 2))
"""
TABLES["x_wide"] = (
    "SELECT date AS observation_date, year(date) AS observation_year, month(date) AS observation_month, "
    "quarter(date) AS observation_quarter, "
    + ", ".join(f"max(value) FILTER (series_id = '{code}') AS {col}" for code, col in fv.SERIES_COLUMNS.items())
    + " FROM x_series GROUP BY date"
)
TABLES["x_yoy"] = """
SELECT *, inflation_rate_yoy AS _i, federal_funds_rate - inflation_rate_yoy AS real_interest_rate
FROM (SELECT *, lag(cpi_all_urban, 12) OVER w AS cpi_12m_ago, lag(gdp_real_chained, 4) OVER w AS gdp_4q_ago,
             lag(m2_money_supply, 12) OVER w AS m2_12m_ago,
             CASE WHEN cpi_12m_ago > 0 THEN (cpi_all_urban - cpi_12m_ago) / cpi_12m_ago * 100 END AS inflation_rate_yoy,
             CASE WHEN gdp_4q_ago > 0 THEN (gdp_real_chained - gdp_4q_ago) / gdp_4q_ago * 100 END AS gdp_growth_rate_yoy,
             CASE WHEN m2_12m_ago > 0 THEN (m2_money_supply - m2_12m_ago) / m2_12m_ago * 100 END AS m2_growth_rate_yoy
      FROM x_wide WINDOW w AS (ORDER BY observation_date))
"""
TABLES["x_wb"] = f"""
SELECT {pick(ad.COUNTRY_CODES, 'nk')} AS country_code, 'Country ' || nk AS country_name,
       ind AS indicator_code, 'name of ' || ind AS indicator_name, yr AS year, v AS value
FROM (SELECT nk, yr, unnest(['NY.GDP.MKTP.CD', 'SP.POP.TOTL', 'FP.CPI.TOTL.ZG', 'SL.UEM.TOTL.ZS', 'NE.TRD.GNFS.ZS']) AS ind,
             unnest([a, b, c, d, e]) AS v
      FROM (SELECT c_nationkey AS nk, year(o_orderdate) AS yr, CAST(sum({_price('o_totalprice')}) AS DOUBLE) AS a,
                   CAST(count(*) AS DOUBLE) AS b, CAST(sum(o_custkey) % 1000 AS DOUBLE) AS c,
                   CAST(sum(o_orderkey) % 200 AS DOUBLE) AS d, CAST(sum(o_orderkey) % 150 AS DOUBLE) AS e
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2))
"""
TABLES["x_yield"] = (
    "SELECT record_date, "
    + ", ".join(f"((s + {37 * j} * n) % 600) / 100.0 AS yield_{t}" for j, t in enumerate(fv.YIELD_TENORS))
    + " FROM (SELECT CAST(o_orderdate AS DATE) AS record_date, CAST(sum(o_custkey) AS BIGINT) AS s, count(*) AS n "
    "FROM orders GROUP BY 1)"
)
TABLES["x_debt"] = f"""
SELECT CAST(o_orderdate AS DATE) AS record_date, CAST(sum({_price('o_totalprice')}) AS DOUBLE) AS total,
       CAST(sum({_price('o_totalprice')}) FILTER (o_orderstatus = 'O') AS DOUBLE) AS intragov,
       CAST(sum({_price('o_totalprice')}) FILTER (o_orderstatus <> 'O') AS DOUBLE) AS held
FROM orders GROUP BY 1
"""
TABLES["x_rate"] = f"""
SELECT record_date, {pick(fv.SECURITY_TYPES, 'k')} AS security_type,
       {pick(['2-Year', '5-Year', '10-Year', '30-Year'], 'm')} || ' ' || {pick(fv.SECURITY_TYPES, 'k')} AS security_desc, avg_interest_rate
FROM (SELECT last_day(o_orderdate) AS record_date, o_custkey % 3 AS k, o_orderkey % 4 AS m,
             CAST(sum(o_custkey) % 900 AS DOUBLE) / 100 AS avg_interest_rate
      FROM orders GROUP BY 1, 2, 3)
"""
TABLES["x_chain"] = f"""
SELECT CAST(o_orderdate AS DATE) AS stat_date, CAST(sum(o_custkey) % 100000 + 1000 AS DOUBLE) AS hash_rate,
       CAST(count(*) * 1000000 AS DOUBLE) AS difficulty, max(o_orderkey) * 100000000 AS totalbc,
       count(*) AS n_blocks_total, count(*) * 1000 + 1 AS n_tx, CAST(sum(o_custkey) AS BIGINT) AS sats,
       CAST(sum({_price('o_totalprice')}) AS DOUBLE) AS rev_float,
       CAST(max({_price('o_totalprice')}) AS DOUBLE) AS top_price, min(o_orderkey) AS mempool_bytes, max(o_custkey) AS block_height,
       CAST(count(*) * 50 + 25 AS DOUBLE) AS btc_mined_daily
FROM orders GROUP BY 1
"""
TABLES["x_event"] = """
SELECT min(CAST(o_orderdate AS DATE)) AS event_date,
       'event_' || lower(o_orderstatus) || '_' || strftime(date_trunc('month', o_orderdate), '%Y%m') AS event_type
FROM orders GROUP BY date_trunc('month', o_orderdate), o_orderstatus
"""
TABLES["x_log"] = f"""
SELECT {pick(['shop', 'erp'], 'o_custkey % 2')} AS source_schema,
       lower(regexp_replace(o_orderpriority, '[^A-Za-z]', '', 'g')) AS source_table,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS run_date, count(*) AS row_count,
       max(o_orderdate) AS finished_at,
       CASE WHEN sum(o_orderkey) % 4 = 0 THEN 'failed' ELSE 'success' END AS status
FROM orders GROUP BY 1, 2, 3
"""
